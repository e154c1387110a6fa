import json

import pytest
from pyspark.sql import functions as F

from folioloom.operators.documents import build_documents
from folioloom.paths import LakePaths
from folioloom.plans import jobs, skew
from folioloom.schemas import DOCUMENTS, EMBEDDINGS, RECORD
from folioloom.session import new_folder
from folioloom.sources import blobs as bl
from folioloom.sources.ndjson import export_ndjson
from folioloom.sources.records import metadata_table, read_records, split_records
from folioloom.sources.sampling import sample_files
from folioloom.sources.tables import append, count_rows, count_stored, exists, scan
from folioloom.streaming import ingest as stream

METADATA = "ia_id STRING, year INT, title STRING, author STRING"


def write_lines(spark, folder, lines, name="part.json"):
    import pathlib

    path = pathlib.Path(folder.removeprefix("file:"))
    path.mkdir(parents=True, exist_ok=True)
    (path / name).write_text("".join(line + "\n" for line in lines), encoding="utf-8")
    return folder


def test_jsonl(spark, folder):
    lines = [json.dumps({"ia_id": "a", "text": "é\nx", "more": 1}), "", "   ", json.dumps({"text": None}), json.dumps({"ia_id": "b", "source_uri": "u"})]
    rows = read_records(spark, write_lines(spark, folder, lines)).collect()
    assert sorted((r.ia_id or "", r.text, r.source_uri) for r in rows) == [("", None, None), ("a", "é\nx", None), ("b", None, "u")]


def test_malformed_lines(spark, folder):
    path = write_lines(spark, folder, ['{"ia_id": "a", "text": "t"}', '{"ia_id": "b", "te'])
    with pytest.raises(Exception, match="(?i)malformed"):
        read_records(spark, path).collect()
    good, bad = split_records(spark, path)
    assert [r.ia_id for r in good.collect()] == ["a"]
    assert [r.bad_line for r in bad.collect()] == ['{"ia_id": "b", "te']


def test_ingest_with_rejects(spark, folder):
    source = write_lines(spark, f"{folder}/in", ['{"ia_id": "a", "text": "t"}', '{"ia_id": "b", "te', ""])
    md = spark.createDataFrame([("a", 1850, "T", "A")], METADATA)
    paths = LakePaths(f"{folder}/lake")
    jobs.ingest(spark, source, md, paths, rejects=f"{folder}/rejects")
    assert [r.doc_id for r in scan(spark, paths.documents, DOCUMENTS).collect()] == ["a"]
    assert spark.read.json(f"{folder}/rejects").first().bad_line == '{"ia_id": "b", "te'


def test_shuffles_are_sized_from_the_input(spark, folder, monkeypatch):
    from folioloom import session

    spark.range(100_000).select(F.sha2(F.col("id").cast("string"), 256).alias("x")).write.parquet(folder)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        assert session.fit_shuffles(spark, folder, "/nowhere") == 8
        monkeypatch.setattr(session, "BYTES_PER_TASK", 100_000)
        assert session.fit_shuffles(spark, folder) > 60
        monkeypatch.setattr(session, "BYTES_PER_TASK", 1)
        assert session.fit_shuffles(spark, folder) == session.MAX_TASKS
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def documents(spark, rows, run="r"):
    records = spark.createDataFrame(rows, f"{RECORD}, source STRING")
    md = metadata_table(spark.createDataFrame([("a", 1850, "T", "A")], METADATA))
    return build_documents(records, md, run)


def test_partition_values_stay_strings_and_appends_add_up(spark, folder):
    rows = documents(spark, [("a", "x", None, "007"), ("b", "y", None, "a b/c"), ("c", "z", None, "007")])
    append(rows, folder)
    append(rows, folder)
    got = scan(spark, folder, DOCUMENTS)
    assert sorted({(r.source, r.year) for r in got.collect()}) == [("007", 1850), ("007", 9999), ("a b/c", 9999)]
    assert count_rows(got).first().n_rows == 6
    append(rows, folder, mode="overwrite")
    assert count_rows(scan(spark, folder, DOCUMENTS)).first().n_rows == 3


def test_counts_come_from_the_footers(spark, folder):
    schema = "n BIGINT, year INT, source STRING"
    before = spark.conf.get("spark.sql.sources.useV1SourceList")
    append(spark.range(100).selectExpr("id AS n", "1800 + cast(id % 3 AS int) AS year", "'007' AS source"), folder)
    append(spark.range(7).selectExpr("id AS n", "1800 AS year", "'b' AS source"), folder)
    counted = count_stored(spark, folder, schema)
    assert counted.first().n_rows == 107
    assert "PushedAggregation: [COUNT(*)]" in counted._jdf.queryExecution().executedPlan().toString()
    by = count_stored(spark, folder, schema, ["year", "source"])
    assert {tuple(r) for r in by.collect()} == {(1800, "007", 34), (1801, "007", 33), (1802, "007", 33), (1800, "b", 7)}
    assert "PushedAggregation: [COUNT(*)]" in by._jdf.queryExecution().executedPlan().toString()
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == before


def test_a_heavy_folder_is_written_by_several_tasks(spark, folder):
    """Two thirds of the rows belong to one source; they must not go through one task."""
    wide = spark.range(60_000).select(
        F.col("id"), F.lit(1800).alias("year"), F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 50)).alias("source"),
        F.sha2(F.col("id").cast("string"), 512).alias("text")).repartition(8)
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1MB")
    try:
        append(wide, folder)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    files = spark.read.parquet(folder).filter("source = 'hot'").select(F.col("_metadata.file_path").alias("f")).distinct().count()
    assert files >= 3


def test_max_rows_per_file(spark, folder):
    append(spark.range(1000).select("id", F.lit(1).alias("year"), F.lit("s").alias("source")), folder, max_rows_per_file=300)
    per_file = spark.read.parquet(folder).groupBy(F.col("_metadata.file_path").alias("f")).count().collect()
    assert max(r["count"] for r in per_file) <= 300


def texts(spark, values):
    return spark.createDataFrame([(v,) for v in values], "text STRING")


def test_blobs_are_stored_once(spark, folder):
    store = bl.BlobStore(spark, folder)
    store.add_texts(texts(spark, ["a", "b", "a", ""]))
    store.add_texts(texts(spark, ["b", "c", "c"]))
    assert sorted(r.text for r in store.read().collect()) == ["", "a", "b", "c"]
    assert bl.new_blobs(texts(spark, ["a", "c"]), store.read()).count() == 0
    assert {r.text: r.n_bytes for r in store.read().collect()}["c"] == 1


def test_no_size_of_the_first_run_settles_the_blob_layout(spark, folder):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for parts, numbers in ((4, range(50)), (400, range(40, 90))):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            bl.BlobStore(spark, folder).add_texts(texts(spark, [str(i) for i in numbers]))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    store = bl.BlobStore(spark, folder)
    assert store.stored().count() == 90 and store.stored().rdd.getNumPartitions() <= 90
    digests = store.read().select(F.col("checksum").alias("text_checksum"), F.lit("d").alias("doc_id"))
    assert bl.with_text(digests, store.read()).count() == 90
    one = store.read().filter(F.col("text") == "77").first()
    assert store.read().filter(F.col("checksum") == one.checksum).count() == 1


def test_small_batches_leave_few_files(spark, folder, monkeypatch):
    """Fifty batches, put together on the way: few files in use, each digest once, and the same after the old files are deleted."""
    monkeypatch.setattr(bl, "PREFIX_DIGITS", 1)
    store = bl.BlobStore(spark, folder)

    def in_use():
        return store._rows().select("_file").distinct().count()

    for batch in range(50):
        store.add_texts(texts(spark, [f"{batch}-{i}" for i in range(3)] + ["shared"]))
        if batch % 25 == 24:
            before = in_use()
            assert store.compact(more_than=2) > 0
            assert in_use() < before
    assert in_use() <= 16 * 3
    rows = store.read().collect()
    assert len(rows) == 151 and len({r.text for r in rows}) == 151
    assert store.vacuum() > 0 and store.vacuum() == 0
    assert {(r.checksum, r.text, r.n_bytes) for r in store.read().collect()} == {(r.checksum, r.text, r.n_bytes) for r in rows}
    assert store.compact(more_than=10 ** 6) == 0


def test_a_compaction_that_breaks_off_loses_nothing(spark, folder, monkeypatch):
    """Broken off once the new files are written and before the old ones are listed: digests are in two files and read once; then it is done again."""
    store = bl.BlobStore(spark, folder)
    for batch in range(3):
        store.append(bl.distinct_texts(texts(spark, ["a", "b", f"c{batch}"])))
    want = {"a", "b", "c0", "c1", "c2"}

    def stop(*names):
        raise OSError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(bl.BlobStore, "_publish", stop)
        with pytest.raises(OSError):
            store.compact(more_than=1)
    assert sorted(r.text for r in store.read().collect()) == sorted(want)
    assert bl.new_blobs(texts(spark, ["a", "d"]), store.read()).first().text == "d"
    reader = store.read()
    assert store.compact(more_than=1) > 0
    for rows in (reader, store.read()):
        assert sorted(r.text for r in rows.collect()) == sorted(want)
    assert store.stored().filter("text = 'a'").count() == 1
    store.vacuum()
    assert sorted(r.text for r in store.read().collect()) == sorted(want)


def test_nothing_to_compact(spark, folder):
    store = bl.BlobStore(spark, folder)
    assert store.compact() == 0 and store.vacuum() == 0 and store.read().count() == 0


def test_with_text_spreads_a_text_many_documents_share(spark, folder):
    store = bl.BlobStore(spark, folder)
    store.add_texts(texts(spark, ["hot", "x", "y"]))
    store.append(bl.distinct_texts(texts(spark, ["x"])))  # a second writer's copy
    docs = spark.range(900).select(
        F.concat(F.lit("d"), "id").alias("doc_id"),
        F.sha2(F.when(F.col("id") % 3 > 0, "hot").when(F.col("id") == 3, "x").otherwise("y"), 256).alias("text_checksum"))
    sized = bl.with_text(docs.withColumn("text_bytes", F.lit(10).cast("bigint")), store.read(), bytes_per_slice=500)
    assert sized.count() == 900 and sized.filter("text = 'hot'").count() == 600
    joined = bl.with_text(docs, store.read(), rows_per_slice=50)
    assert joined.count() == 900
    assert {r.text: r.n for r in joined.groupBy("text").agg(F.count("*").alias("n")).collect()} == {"hot": 600, "x": 1, "y": 299}


def test_document_text_takes_the_earliest_row(spark, folder):
    paths = LakePaths(folder)
    bl.BlobStore(spark, paths.blobs).add_texts(texts(spark, ["new", "old"]))
    rows = documents(spark, [("a", "new", None, "s")], "r2").withColumn("created_at", F.lit("2024-02-02").cast("timestamp")).unionByName(
        documents(spark, [("a", "old", None, "s")], "r1").withColumn("created_at", F.lit("2024-01-01").cast("timestamp")))
    stored = bl.BlobStore(spark, paths.blobs).read()
    assert [r.text for r in bl.document_text(rows, stored, "a").collect()] == ["old"]
    assert bl.document_text(rows, stored, "none").collect() == []


def test_slices_follow_the_weight(spark):
    rows = spark.createDataFrame([("a", 100)] * 6 + [("b", 1000)] + [("c", 1)] * 5 + [(None, 500)] * 3, "k STRING, w BIGINT")
    got = {r.k: r.slices for r in skew.split_keys(rows, "k", 1000, weight="w", bytes_per_slice=150).collect()}
    assert got == {"a": 4}  # one row is never cut
    assert skew.split_keys(rows, "k", 1000).count() == 0


@pytest.mark.parametrize("how,n", [("inner", 60), ("left", 90)])
def test_salted_join(spark, how, n):
    left = spark.range(90).select("id", F.when(F.col("id") % 3 == 0, F.lit(None)).when(F.col("id") % 3 == 1, "hot").otherwise(F.col("id").cast("string")).alias("k"))
    right = spark.range(90).select(F.col("id").cast("string").alias("k"), (F.col("id") * 2).alias("v")).unionByName(
        spark.createDataFrame([("hot", -1)], "k STRING, v BIGINT"))
    joined = skew.salted_join(left, right, "k", "id", how, rows_per_slice=7)
    assert joined.count() == n and joined.filter("v = -1").count() == 30
    assert {r.k: r.slices for r in skew.split_keys(left, "k", 7).collect()} == {"hot": 5}
    with pytest.raises(ValueError):
        skew.salted_join(left, right, "k", "id", "full")


def test_export(spark, folder):
    rows = [(f"c{i}", "d", None if i == 3 else 1800, "s", "ä\n\"q\"" if i else None) for i in range(10)]
    chunks = spark.createDataFrame(rows, "chunk_id STRING, doc_id STRING, year INT, source STRING, text STRING")
    rejects = export_ndjson(chunks.coalesce(1), folder, docs_per_file=4)
    assert [r.chunk_id for r in rejects.collect()] == ["c3"]
    lines = [json.loads(r.value) for r in spark.read.text(folder).collect()]
    assert len(lines) == 9 and all(list(d) == ["chunk_id", "doc_id", "year", "source", "text"] for d in lines)
    assert {d["chunk_id"]: d["text"] for d in lines}["c1"] == "ä\n\"q\"" and {d["chunk_id"]: d["text"] for d in lines}["c0"] is None
    raw = spark.read.text(folder)
    assert raw.filter(F.col("value").contains("ä")).count() == 8
    per_file = raw.groupBy(F.col("_metadata.file_path").alias("f")).count().collect()
    assert sorted(r["count"] for r in per_file) == [1, 4, 4]


def test_sample_files(spark, folder):
    rows = spark.range(80).select(
        F.concat(F.lit("c"), "id").alias("chunk_id"), F.lit("d").alias("doc_id"), F.lit("m").alias("model"),
        F.array(F.lit(1.0).cast("float")).alias("vector"), F.lit(1).alias("dim"), F.current_timestamp().alias("created_at"),
        (1800 + F.col("id") % 8).cast("int").alias("year"), F.lit("s").alias("source"))
    append(rows, folder, keys=["model", "year", "source"])
    some = sample_files(spark, folder, EMBEDDINGS, 0.5)
    assert some.count() == 40 and some.select("year").distinct().count() == 4
    assert some.exceptAll(sample_files(spark, folder, EMBEDDINGS, 0.5)).count() == 0
    assert sample_files(spark, folder, EMBEDDINGS, 0.0001).count() == 10
    assert some.filter("source = 's' AND model = 'm'").count() == 40


def lake_rows(spark, paths):
    keep = ["doc_id", "source", "year", "title", "text_checksum", "text_bytes"]
    return sorted(tuple(r) for r in scan(spark, paths.documents, DOCUMENTS).select(*keep).collect())


FILES = [
    [{"ia_id": "a", "text": "one"}, {"text": "two", "source_uri": "u"}], [{"ia_id": "b", "text": "one"}],
    [{"ia_id": "c", "text": "three\r\n"}, {"ia_id": "a", "text": "one"}],
]


def test_stream_takes_in_new_files_and_equals_the_batch(spark, folder):
    md = spark.createDataFrame([("a", 1850, "T", "A")], METADATA)
    incoming, paths, batch = f"{folder}/in", LakePaths(f"{folder}/lake"), LakePaths(f"{folder}/batch")

    def take_in():
        stream.ingest_stream(spark, incoming, md, paths, f"{folder}/checkpoint", files_per_batch=1).awaitTermination()

    for n, records in enumerate(FILES[:2]):
        write_lines(spark, incoming, [json.dumps(r) for r in records], f"{n}.json")
    take_in()
    take_in()
    write_lines(spark, incoming, [json.dumps(r) for r in FILES[2]], "2.json")
    take_in()
    jobs.ingest(spark, incoming, md, batch)
    assert lake_rows(spark, paths) == lake_rows(spark, batch) and len(lake_rows(spark, paths)) == 5
    assert bl.BlobStore(spark, paths.blobs).read().count() == 3
    assert scan(spark, paths.documents, DOCUMENTS).select("ingest_run_id").distinct().count() == 3


def test_replayed_and_broken_off_batches(spark, folder):
    md = metadata_table(spark.createDataFrame([("a", 1850, "T", "A")], METADATA))
    paths = LakePaths(folder)
    records = spark.createDataFrame([("a", "one", None, "ia"), ("a", "one", None, "ia"), ("b", "two", None, "ia")], f"{RECORD}, source STRING")
    part = build_documents(records.limit(1), md, "s-0")
    append(part, paths.documents)  # what a run that broke off may have left
    stream._note(spark, "s-0", f"{paths.runs}/s-0.started")
    for _ in range(2):
        stream.write_batch(records, 0, md, paths, "s")
        assert len(lake_rows(spark, paths)) == 3
    assert exists(spark, f"{paths.runs}/s-0/_SUCCESS")
    stream.write_batch(records, 1, md, paths, "s")
    assert len(lake_rows(spark, paths)) == 6


def test_shared_folder_is_the_one_the_session_names(spark):
    assert new_folder(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_a_missing_text_stops_the_job(spark):
    from folioloom.sources.blobs import with_text

    documents = spark.createDataFrame([("d1", "aa"), ("d2", "bb"), ("d3", None)], "doc_id string, text_checksum string")
    blobs = spark.createDataFrame([("aa", "one"), ("bb", "two")], "checksum string, text string")
    assert sorted(r.text for r in with_text(documents, blobs).collect()) == ["one", "two"]
    for rows in (100, 1):
        with pytest.raises(Exception, match="no stored text"):
            with_text(documents.union(documents), blobs.filter("checksum = 'aa'"), rows_per_slice=rows).collect()


def test_files_are_sampled_under_one_folder(spark, folder):
    from folioloom.sources.sampling import sample_files

    rows = spark.range(60).selectExpr("id", "CASE WHEN id % 20 = 0 THEN 'small' ELSE 'large' END AS model").repartition(6)
    rows.write.partitionBy("model").parquet(folder)
    got = sample_files(spark, folder, "id long, model string", 0.01, under="model=small").collect()
    assert got and {r.model for r in got} == {"small"}
