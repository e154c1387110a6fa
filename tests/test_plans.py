"""What the planner makes of the operators."""

import re

from pyspark.sql import functions as F

from folioloom.operators import ann, chunks, documents, fulltext, knn, lookup
from folioloom.operators.semantic import chunks_of_hits
from folioloom.registry import inputs as i
from folioloom.schemas import CHUNKS, DOCUMENTS
from folioloom.session import new_folder
from folioloom.sources import blobs as bl
from folioloom.sources.tables import append, scan


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return plan(df)


def depth(line):
    return len(re.match(r"[ :+-]*", line).group())


def ancestors(lines, node):
    """The lines of a printed plan that ``node`` hangs from, nearest first."""
    found, level = [], depth(node)
    for line in reversed(lines[:lines.index(node)]):
        if depth(line) < level:
            found.append(line)
            level = depth(line)
    return found


def stored_documents(spark, sf_dir):
    path = new_folder(spark, "documents")
    append(i.documents(spark, sf_dir), path)
    return scan(spark, path, DOCUMENTS)


def test_years_prune_folders_and_columns(spark, sf_dir):
    text = plan(lookup.documents_between(stored_documents(spark, sf_dir), 1820, 1830))
    assert re.search(r"PartitionFilters: \[[^\]]*year#\d+ >= 1820", text)
    assert "text_checksum" not in re.search(r"ReadSchema: (\S+)", text).group(1)


def test_lookups_reach_the_parquet_reader(spark, sf_dir):
    path = new_folder(spark, "chunks")
    append(i.chunks(spark, sf_dir), path)
    rows = scan(spark, path, CHUNKS)
    assert "EqualTo(doc_id,d1)" in plan(lookup.chunks_of_document(rows, "d1"))
    assert "EqualTo(chunk_id,x)" in plan(lookup.chunk_by_id(rows, "x"))
    hits = i.vectors(spark, sf_dir).select("chunk_id", "year", "source").limit(5)
    pruned = plan(chunks_of_hits(rows, hits, few=True))
    assert "BroadcastHashJoin" in pruned and "LeftSemi" in pruned


def test_native_operators_stay_in_the_jvm(spark, sf_dir):
    rows = i.chunks(spark, sf_dir)
    index = fulltext.index_of(rows)
    for df in (
        i.documents(spark, sf_dir), rows, chunks.merge_chunks(rows, overlap=i.OVERLAP),
        chunks.neighbours(rows.select("chunk_id", "doc_id", "seq"), rows), fulltext.occurrences(rows), index.docs,
        documents.ingest_totals(i.documents(spark, sf_dir)), ann.vector_meta(i.vectors(spark, sf_dir)),
    ):
        assert not re.search(r"EvalPython|InArrow|InPandas", plan(df))


def test_cutting_and_posting_do_not_shuffle(spark, sf_dir):
    stored = new_folder(spark, "plain")
    i.plain_documents(spark, sf_dir).write.parquet(stored)
    rows = chunks.chunk_rows(spark.read.parquet(stored))
    assert "Exchange" not in plan(rows)
    assert "Exchange" not in plan(fulltext.postings(rows))
    assert "Exchange" not in plan(ann.assign_lists(i.vectors(spark, sf_dir), i.label_centroids(spark, sf_dir), ["chunk_id"]))


def test_texts_are_shuffled_once(spark, sf_dir):
    """On the usual way, and neither sorted nor grouped to find copies."""
    documents_ = stored_documents(spark, sf_dir)
    store = bl.BlobStore(spark, new_folder(spark, "blobs"))
    store.append(i.blobs(spark, sf_dir))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = final_plan(bl.with_text(documents_.select("doc_id", "text_checksum"), store.read()))
        fresh = plan(bl.new_blobs(i.records(spark, sf_dir), store.stored()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    final = text.split("Initial Plan")[0]
    scans = [line for line in final.splitlines() if "FileScan" in line and "text#" in line]
    assert len(scans) == 1  # the way for heavy texts is dropped where there are none
    above = ancestors(final.splitlines(), scans[0])
    assert sum("Exchange" in line for line in above) == 1 and not any("Aggregate" in line for line in above)
    assert fresh.count("Exchange") <= 3  # that of the texts, that of the stored digests, and the dealing out of a one-file input


def test_digest_lookup_opens_one_folder(spark, sf_dir):
    store = bl.BlobStore(spark, new_folder(spark, "blobs"))
    store.append(i.blobs(spark, sf_dir))
    some = store.read().first().checksum
    documents_ = spark.range(1).select(
        F.lit("d").alias("doc_id"), F.lit("r").alias("ingest_run_id"), F.current_timestamp().alias("created_at"), F.lit(some).alias("text_checksum"))
    found = bl.document_text(documents_, store.read(), "d")
    assert "EqualTo(checksum," in plan(found) and found.count() == 1
    assert re.search(r"PartitionFilters: \[[^\]]*prefix#\d+ = ", plan(found))


def test_digest_lookup_prunes_both_scans(spark, sf_dir):
    """The rows and the digests they are compared with: one folder, and filters on the digest, in each."""
    store = bl.BlobStore(spark, new_folder(spark, "blobs"))
    store.add_texts(i.table(spark, sf_dir, "documents"))
    store.append(store.stored().limit(3))
    some = store.stored().groupBy("checksum").count().filter("count > 1").first().checksum
    documents_ = spark.createDataFrame([("d", some)], "doc_id string, text_checksum string").selectExpr(
        "*", "current_timestamp() AS created_at", "'r' AS ingest_run_id")
    found = bl.document_text(documents_, store, "d")
    assert found.count() == 1
    scans = [line for line in final_plan(found.select("text")).split("\n") if "FileScan" in line and "checksum" in line]
    assert len(scans) >= 2
    assert all(f"= {some[:2]})" in line.split("PartitionFilters")[1].split("]")[0] for line in scans)
    assert all(f"EqualTo(checksum,{some[:9]}" in line for line in scans)


def test_bloom_filters_leave_row_groups_out(spark, folder):
    """Ids in no order in files of a folder: a lookup reads the files that may hold it, one for an id that is there and mostly none else."""
    rows = spark.range(40_000).selectExpr("sha2(string(id), 256) AS chunk_id", "sha2(string(-id), 256) AS text", "1800 AS year", "'a' AS source")
    for bloom, most in ((["chunk_id"], 2), (None, 8)):
        path = f"{folder}-{bool(bloom)}"
        append(rows.repartition(8), path, balance=False, bloom=bloom)
        read = spark.read.parquet(path)
        wanted = read.filter("chunk_id = sha2('77', 256)")
        assert wanted.count() == 1
        node = wanted.select("text")
        assert len(node.collect()) == 1
        scanned = node._jdf.queryExecution().executedPlan()
        while scanned.getClass().getSimpleName() != "FileSourceScanExec":
            scanned = scanned.finalPhysicalPlan() if scanned.getClass().getSimpleName() == "AdaptiveSparkPlanExec" else scanned.children().head()
        n = scanned.metrics().apply("numOutputRows").value()
        # Rows of whole row groups; a file has one.
        assert n <= most * 5_000 and (bloom or n > 5_000 * 4)


def test_top_n_is_limited_before_the_shuffle(spark, sf_dir):
    text = plan(knn.nearest(i.vector_queries(spark, sf_dir), i.vectors(spark, sf_dir), 5))
    assert text.count("WindowGroupLimit") == 2 and "CartesianProduct" not in text and "NestedLoop" not in text


def test_pages_sort_only_what_they_show(spark, sf_dir):
    hits = fulltext.match(fulltext.index_of(i.chunks(spark, sf_dir)), "the")
    assert "TakeOrderedAndProject" in plan(fulltext.page(hits, 5, 5))


def test_stored_postings_are_read_by_term(spark, sf_dir):
    path = new_folder(spark, "text-index")
    fulltext.write_text_index(i.chunks(spark, sf_dir), path)
    index = fulltext.read_text_index(spark, path)
    text = plan(fulltext.match(index, "the nation"))
    assert "In(term, [nation,the])" in text
    assert "positions" not in re.search(r"ReadSchema: (\S+)", text).group(1)


def test_a_rare_term_opens_two_files_at_most(spark, sf_dir):
    path = new_folder(spark, "text-index")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        fulltext.write_text_index(i.chunks(spark, sf_dir).repartition(4), path)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    index = fulltext.read_text_index(spark, path)
    files = index.files.collect()
    assert len(files) >= 6
    ordered = sorted(files, key=lambda f: (f.first_term, f.first_place))
    assert all((a.last_term, a.last_place) <= (b.first_term, b.first_place) for a, b in zip(ordered, ordered[1:]))
    for row in index.terms.filter("df <= 2").limit(5).collect():
        hits = fulltext.match(index, row.term)
        assert len(fulltext.postings_of(index, {row.term}).inputFiles()) <= 2
        assert hits.count() == row.df
        assert "text:" not in plan(hits)


def test_no_cross_join_in_any_search(spark, sf_dir):
    rows = i.chunks(spark, sf_dir)
    index = fulltext.index_of(rows)
    for df in (fulltext.bm25(index, "the nation"), fulltext.phrase(index, "of the"), fulltext.match(index, "the", "all")):
        assert "CartesianProduct" not in plan(df) and "NestedLoop" not in plan(df)
