"""Further columns of any name come through operators and stages as they are, also with nulls and in empty tables."""

import corpus_pipeline
import pytest
from folioloom.llm.common import set_aside
from folioloom.llm.middle import fill_in_middle
from folioloom.llm.perplexity import perplexity_filter
from folioloom.llm.quality import quality_rules
from folioloom.llm.secrets import secret_scan

NAMES = ["_text", "_base", "_long", "_assign", "_lang", "_limit", "_threshold", "_turn", "_digest", "turn", "text_digest", "leaks", "rest", "a.b", "n", "size"]
RESULTS = {"quality", "secrets", "fim", "perplexity", "threshold", "kept"}

OPERATORS = {
    "quality": quality_rules, "perplexity": perplexity_filter, "secrets": lambda d, labels: secret_scan(d), "middle": lambda d, labels: fill_in_middle(d),
}


@pytest.fixture(scope="module")
def clashing(docs):
    plain = docs.select("doc_id", "text", "lang", "source")
    return plain.selectExpr("*", *[f"concat('{name}', cast(doc_id AS string)) AS `{name}`" for name in NAMES])


def as_they_were(rows):
    for r in rows:
        for name in NAMES:
            assert r[name] == (None if r.doc_id is None else f"{name}{r.doc_id}")


@pytest.mark.parametrize("name", list(OPERATORS))
def test_operators(name, clashing, labels, rows):
    out = OPERATORS[name](clashing, labels)
    assert [c for c in out.columns if c not in RESULTS] == clashing.columns
    got = out.collect()
    assert len(got) == len(rows)
    as_they_were(got)
    assert OPERATORS[name](clashing.limit(0), labels).count() == 0


@pytest.fixture(scope="module")
def tables(spark, labels, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    labels.write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, "no passage of these"), (None, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES[:-1]])
def test_stages(name, spark, clashing, tables):
    stage = dict(corpus_pipeline.STAGES)[name]
    docs = clashing.selectExpr("*", "concat('q', cast(doc_id AS string)) AS quality")
    out = stage(spark, docs, tables)
    assert out.columns == docs.columns
    got = out.collect()
    as_they_were(got)
    assert got and all(r.quality == (None if r.doc_id is None else f"q{r.doc_id}") for r in got)
    empty = stage(spark, docs.limit(0), tables)
    assert empty.columns == docs.columns and empty.count() == 0


def test_last_stage(spark, clashing, tables):
    stage = corpus_pipeline.STAGES[-1][1]
    assert stage(spark, clashing, tables).count() == clashing.count()
    assert stage(spark, clashing.limit(0), tables).count() == 0


def test_nothing_aside(docs):
    held, back = set_aside(docs.select("doc_id", "text"), ["doc_id", "text", "lang"])
    assert held.columns == ["doc_id", "text", "rest"] and back(held).columns == ["doc_id", "text"]
