"""Every registered query against its SQL."""

import subprocess
import sys
from pathlib import Path

import pytest
from compare import compare

from folioloom.registry import ORACLES, QUERIES

MAY_BE_EMPTY = {"document_text", "docs_by_year_range", "ids_by_year_open"}


@pytest.mark.parametrize("key", list(QUERIES))
def test_query(spark, sf_dir, key):
    count = []
    if key in ORACLES:
        assert compare(spark, key, QUERIES[key], ORACLES[key], sf_dir, count) is None
        assert count[0] or key in MAY_BE_EMPTY
    else:
        assert QUERIES[key](spark, sf_dir).count()


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).columns == ["doc_id", "title", "author", "text_uri", "preview", "year", "source"]
    assert __spark_entry__.queries().keys() >= QUERIES.keys()
    assert __spark_entry__.oracle_sql().keys() >= ORACLES.keys()


@pytest.mark.parametrize("missing", ["tiktoken", "xxhash", "folioloom.llm", "corpus_pipeline"])
def test_queries_without_what_the_subpackage_needs(missing):
    """In a process of its own, since modules stay imported."""
    code = f"import sys; sys.modules[{missing!r}] = None; import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    out = subprocess.run([sys.executable, "-c", code], cwd=Path(__file__).resolve().parent.parent, capture_output=True, text=True, check=True)
    assert out.stdout.split() == [str(len(QUERIES)), str(len(ORACLES))]
