"""A small lake from JSONL to answers, through the handle a user has."""

import json

import pytest
from pyspark.sql import functions as F

from folioloom import CorpusLake, LakePaths, new_folder
from folioloom.operators.ann import IVFPQConfig
from folioloom.operators.embedding import HashEncoder
from folioloom.plans import jobs
from folioloom.schemas import CHUNKS, EMBEDDINGS, columns
from test_storage import METADATA, write_lines

CONFIG = IVFPQConfig(n_lists=4, m=16, n_bits=5, dim=64, code_iterations=3)
TOPICS = ["river water flows past the old mill", "engine steam drives the iron train", "baker bread rises in the warm oven", "violin music fills the quiet hall"]


@pytest.fixture(scope="module")
def lake(spark):
    paths = LakePaths(new_folder(spark, "lake"))
    records = [
        {"ia_id": f"d{i}", "text": " ".join(f"{TOPICS[i % 4]} {i} {k}" for k in range(6)), "source_uri": f"u{i}"} for i in range(40)]
    source = write_lines(spark, new_folder(spark, "raw"), [json.dumps(r) for r in records])
    md = spark.createDataFrame([(f"d{i}", 1800 + i, f"t{i}", "a") for i in range(0, 40, 2)], METADATA)
    jobs.ingest(spark, source, md, paths, source="books", run_id="r1")
    jobs.chunk(spark, paths, window=16, overlap=4)
    jobs.embed(spark, paths, HashEncoder())
    jobs.index_vectors(spark, paths, "hash-64", CONFIG, fraction=1.0)
    jobs.index_text(spark, paths)
    return CorpusLake(spark, paths, overlap=4, index_config=CONFIG)


def test_tables(lake):
    assert lake.documents.count() == 40 and lake.blobs.count() == 40
    assert lake.chunks.columns == columns(CHUNKS) and lake.embeddings.columns == columns(EMBEDDINGS)
    assert lake.chunks.count() == lake.embeddings.count() == lake.vector_meta.count() == lake.vector_index.postings.count()
    assert lake.paths.vector_index("one") != lake.paths.vector_index("two")


def test_vectors_that_do_not_fit_stay_out_and_are_counted(spark, lake):
    """Null, short and NaN vectors go to the rejects; the job's totals are those of its one write."""
    class Odd:
        dim, name = 64, "odd"

        def encode(self, text):
            whole = HashEncoder().encode(text)
            broken = F.transform(whole, lambda x: F.lit(float("nan")).cast("float"))
            return F.when(text.contains("river"), F.lit(None)).when(text.contains("steam"), F.slice(whole, 1, 3)).when(
                text.contains("bread"), broken).otherwise(whole)

    good = lake.chunks.filter("NOT text RLIKE 'river|steam|bread'").count()
    paths = LakePaths(new_folder(spark, "lake"))
    lake.chunks.write.partitionBy("year", "source").parquet(paths.chunks)
    n = lake.chunks.count()
    assert jobs.embed(spark, paths, Odd()) == {"n_chunks": n, "n_written": good, "n_rejected": n - good}
    assert 0 < good < n and spark.read.parquet(paths.embeddings).count() == good
    out = spark.read.parquet(paths.rejects("embeddings"))
    assert out.count() == n - good and {r.model for r in out.collect()} == {"odd"}
    assert jobs.embed(spark, paths, HashEncoder())["n_rejected"] == 0 and out.count() == n - good


def test_document(lake):
    text = lake.get_document_from_doc_id("d6").first().text
    assert text.startswith(TOPICS[2])
    assert lake.get_document_from_doc_id("zzz").count() == 0


def test_chunks_context_and_merge(lake):
    chunks = lake.get_chunks_from_doc_id("d6").orderBy("seq").collect()
    assert len(chunks) > 2
    chunk_id = chunks[1].chunk_id
    assert lake.get_chunk_from_chunk_id(chunk_id).first().text == chunks[1].text
    assert lake.get_chunk_from_chunk_id(chunk_id, ["text"]).columns == ["text"]
    around = lake.get_chunk_context(chunk_id, 1, 1)
    assert [r.seq for r in around.collect()] == [0, 1, 2]
    merged = lake.merge_sequences(lake.chunks.filter("doc_id = 'd6'")).first()
    assert merged.merge_ok and merged.text == lake.get_document_from_doc_id("d6").first().text


def test_date_range(lake):
    rows = lake.get_documents_by_date_range(1810, 1814)
    assert sorted(r.year for r in rows.collect()) == [1810, 1812, 1814]
    assert rows.columns == ["doc_id", "title", "author", "text_uri", "preview", "year", "source"]


def test_semantic_search(lake):
    with_text = lake.search("steam train engine", n=5, n_probe=4)
    assert with_text.columns == columns(CHUNKS) and with_text.count() == 5
    assert with_text.filter(F.col("text").contains("steam") | F.col("text").contains("train")).count() == 5
    plain = lake.search("steam train engine", n=5, n_probe=4, with_text=False)
    rows = plain.collect()
    assert plain.columns == ["distances", "labels", "chunk_id", "doc_id", "year", "source"]
    assert [r.distances for r in rows] == sorted(r.distances for r in rows)
    assert {r.chunk_id for r in rows} == {r.chunk_id for r in with_text.collect()}
    ranked = lake.search_with_text("steam train engine", n=5, n_probe=4).collect()
    assert [r["rank"] for r in ranked] == [1, 2, 3, 4, 5] and [r.chunk_id for r in ranked] == [r.chunk_id for r in rows]


def test_searches_open_the_folders_of_their_hits_only(lake):
    """Year and source of the hits prune the folders while the query runs, for any number of hits."""
    for answer in (lake.search("iron", n=3, n_probe=4), lake.search("iron", n=3, n_probe=4, with_text=False),
                   lake.search("iron", n=20_000, n_probe=4), lake.search_with_text("iron", n=3, n_probe=4)):
        assert "dynamicpruning" in answer._jdf.queryExecution().executedPlan().toString()
    assert lake.search("iron", n=20_000, n_probe=4).count() == lake.chunks.count()


def test_semantic_search_in_years(lake):
    rows = lake.search("steam train engine", n=50, year_min=1800, year_max=1804, n_probe=4, with_text=False, pad=True).collect()
    inside = lake.chunks.filter("year BETWEEN 1800 AND 1804").count()
    assert len(rows) == 50 and sum(r.labels != -1 for r in rows) == inside
    assert all(1800 <= r.year <= 1804 for r in rows if r.labels != -1)
    undated = lake.search("river", n=500, year_min=1900, n_probe=4, with_text=False).collect()
    assert undated and all(r.year == 9999 for r in undated)


def test_search_in_years_without_chunks(lake):
    for with_text in (True, False):
        assert lake.search("river", year_min=1000, year_max=1001, n_probe=4, with_text=with_text).count() == 0
    padded = lake.search("river", n=3, year_min=1000, year_max=1001, n_probe=4, with_text=False, pad=True).collect()
    assert [r.labels for r in padded] == [-1, -1, -1]


def test_full_text_search(lake):
    found = lake.search_chunks("violin music", limit=5)
    assert found.columns == ["chunk_id", "doc_id", "year", "source"] and found.count() == 5
    assert lake.search_chunks("violin bread").count() == 0
    assert lake.search_chunks("violin bread", mode="any", limit=1000).count() > 5
    assert lake.search_chunks("iron train", mode="phrase", year_from=1801, year_to=1821, limit=1000).count() == 0
    assert lake.search_chunks("old mill", mode="phrase", year_from=1800, year_to=1808, sources=["books"]).filter("year > 1808").count() == 0
    assert lake.search_chunks("old mill", sources=["other"]).count() == 0
    assert lake.search_chunks("warm oven", by_score=True, limit=3).count() == 3


def test_job_runner_reads_its_arguments():
    from folioloom.__main__ import parser

    args = parser().parse_args(["--base", "/lake", "chunk", "--window", "128"])
    assert (args.job, args.window, args.overlap) == ("chunk", 128, 64)
    args = parser().parse_args(["--base", "/lake", "index-vectors", "--model", "m"])
    assert (args.lists, args.m, args.bits, args.fraction) == (8192, 64, 8, 0.01)


def test_job_runner_runs_jobs(spark, lake):
    from folioloom.__main__ import main

    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        main(["--base", lake.paths.base, "export", "--docs-per-file", "50"])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert spark.read.text(lake.paths.search_export).count() == lake.chunks.count()
