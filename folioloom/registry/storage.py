"""Queries that write a table and read it back, under the session's shared folder."""

from __future__ import annotations

from pyspark.sql import functions as F

from folioloom.operators import ann
from folioloom.operators.chunks import chunk_rows
from folioloom.operators.documents import normalized
from folioloom.paths import LakePaths
from folioloom.plans import jobs
from folioloom.registry import inputs as i
from folioloom.registry.book import query
from folioloom.registry.ingest import DOC_COLUMNS, RECORD_COLUMNS
from folioloom.registry.inputs import with_ctes
from folioloom.schemas import CHUNKS, DOCUMENTS, EMBEDDINGS, RECORD, SEARCH_DOCUMENT
from folioloom.session import new_folder
from folioloom.sources import blobs as blob_ops
from folioloom.sources.ndjson import export_ndjson
from folioloom.sources.records import read_records
from folioloom.sources.sampling import sample_files
from folioloom.sources.tables import append, scan
from folioloom.streaming.ingest import ingest_stream


def write_jsonl(spark, sf_dir, parts: int = 0) -> str:
    """The records as JSONL files in a new folder."""
    folder = new_folder(spark, "jsonl")
    lines = i.records(spark, sf_dir).select(*RECORD_COLUMNS, "source")
    (lines.repartition(parts) if parts else lines).write.json(folder)
    return folder


@query("scan_jsonl", with_ctes(["rec"], "select ia_id, text, source_uri from rec"))
def scan_jsonl(spark, sf_dir):
    return read_records(spark, write_jsonl(spark, sf_dir))


def _written_documents(spark, sf_dir) -> str:
    folder = new_folder(spark, "documents")
    append(i.documents(spark, sf_dir), folder, sort_by=["doc_id"])
    return folder


@query("scan_partitioned", with_ctes(["docs"], f"select {', '.join(DOC_COLUMNS)} from docs"))
def scan_partitioned(spark, sf_dir):
    return scan(spark, _written_documents(spark, sf_dir), DOCUMENTS).select(*DOC_COLUMNS)


@query("scan_projected", with_ctes(["docs"], "select doc_id, year, source, text_uri, ingest_run_id from docs"))
def scan_projected(spark, sf_dir):
    read = scan(spark, _written_documents(spark, sf_dir), DOCUMENTS)
    return read.select("doc_id", "year", "source", "text_uri", "ingest_run_id")


@query("write_partitioned", with_ctes(["docs"], """
    select year, source, 2 * count(*) as n_docs, 2 as n_runs from docs group by year, source"""))
def write_partitioned(spark, sf_dir):
    """Two runs appended to one table, counted per folder."""
    folder = new_folder(spark, "documents")
    rows = i.documents(spark, sf_dir)
    for run in ("run-1", "run-2"):
        append(rows.withColumn("ingest_run_id", F.lit(run)), folder, sort_by=["doc_id"])
    return scan(spark, folder, DOCUMENTS).groupBy("year", "source").agg(
        F.count(F.lit(1)).alias("n_docs"), F.count_distinct("ingest_run_id").cast("int").alias("n_runs"))


@query("blob_store_new", with_ctes(["norm"], """
    select sha256(n.text) as checksum, any_value(n.text) as text, any_value(strlen(n.text))::bigint as n_bytes, true as is_new
    from norm n group by 1
    having sha256(n.text) not in (select sha256(p.text) from norm p join labels l on l.doc_id = p.n)"""))
def blob_store_new(spark, sf_dir):
    """Texts of the labelled documents are stored first; then only the others are new."""
    folder = new_folder(spark, "blobs")
    records = normalized(i.records(spark, sf_dir))
    labelled = records.join(i.table(spark, sf_dir, "labels").select(F.col("doc_id").alias("n")), "n", "left_semi")
    store = blob_ops.BlobStore(spark, folder)
    store.add_texts(labelled)
    fresh = blob_ops.new_blobs(records, store.read())
    return fresh.select("checksum", "text", "n_bytes", F.lit(True).alias("is_new"))


@query("blob_compact", with_ctes(["norm"], """
    select sha256(text) as checksum, any_value(text) as text, any_value(strlen(text))::bigint as n_bytes from norm group by 1"""))
def blob_compact(spark, sf_dir):
    """Texts stored in two runs, their files put together, the old files deleted: each text is there once."""
    records = normalized(i.records(spark, sf_dir))
    store = blob_ops.BlobStore(spark, new_folder(spark, "blobs"))
    for joined in ("left_semi", "left_anti"):
        store.add_texts(records.join(i.table(spark, sf_dir, "labels").select(F.col("doc_id").alias("n")), "n", joined))
    store.compact(more_than=1)
    store.vacuum()
    return store.read().select("checksum", "text", "n_bytes")


def _written_blobs(spark, sf_dir):
    store = blob_ops.BlobStore(spark, new_folder(spark, "blobs"))
    store.append(i.blobs(spark, sf_dir))
    return store


@query("blob_fetch", with_ctes(["docs"], "select doc_id, text_checksum, text from docs"))
def blob_fetch(spark, sf_dir):
    documents = i.documents(spark, sf_dir).select("doc_id", "text_checksum")
    return blob_ops.with_text(documents, _written_blobs(spark, sf_dir).read()).select("doc_id", "text_checksum", "text")


@query("document_text", with_ctes(["docs"], "select doc_id, text from docs where doc_id = 'd21'"))
def document_text(spark, sf_dir):
    documents = scan(spark, _written_documents(spark, sf_dir), DOCUMENTS)
    return blob_ops.document_text(documents, _written_blobs(spark, sf_dir), "d21")


@query("ndjson_export", with_ctes(["chunks"], "select chunk_id, doc_id, year::bigint as year, source, text from chunks"))
def ndjson_export(spark, sf_dir):
    folder = new_folder(spark, "ndjson")
    export_ndjson(i.chunk_texts(spark, sf_dir), folder)
    parsed = spark.read.text(folder).select(F.from_json("value", SEARCH_DOCUMENT).alias("d"))
    return parsed.select("d.chunk_id", "d.doc_id", "d.year", "d.source", "d.text")


@query("ndjson_export_batched", with_ctes(["chunks"], "select count(*) as n_docs, true as within_cap from chunks"))
def ndjson_export_batched(spark, sf_dir):
    folder = new_folder(spark, "ndjson")
    export_ndjson(i.chunk_texts(spark, sf_dir), folder, docs_per_file=500, gzip=True)
    per_file = spark.read.text(folder).groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("n"))
    return per_file.agg(F.sum("n").alias("n_docs"), (F.max("n") <= 500).alias("within_cap"))


@query("sample_files")
def sample(spark, sf_dir):
    folder = new_folder(spark, "embeddings")
    rows = i.vectors(spark, sf_dir).selectExpr(
        "chunk_id", "doc_id", "year", "source", "'given' AS model", "vector", "size(vector) AS dim",
        "current_timestamp() AS created_at")
    append(rows, folder, keys=["model", "year", "source"])
    return sample_files(spark, folder, EMBEDDINGS, 0.25).select("chunk_id", "year", "source")


CHUNK_SQL = """
    select chunk_id, doc_id, year, source, seq, start_token, end_token, text, text_checksum, token_count,
           ingest_run_id, tokens from lake_chunks"""


def shown_chunks(rows):
    return rows.drop("created_at").withColumn("tokens", i.joined(F.col("tokens")))


@query("chunks_build", with_ctes(["lake_chunks"], CHUNK_SQL))
def chunks_build(spark, sf_dir):
    """Documents and blobs on disk into chunks on disk."""
    paths = LakePaths(new_folder(spark, "lake"))
    append(i.documents(spark, sf_dir), paths.documents)
    blob_ops.BlobStore(spark, paths.blobs).append(i.blobs(spark, sf_dir))
    jobs.chunk(spark, paths, i.TOKENIZER, i.WINDOW, i.OVERLAP)
    return shown_chunks(scan(spark, paths.chunks, CHUNKS))


INGESTED_SQL = with_ctes(["docs"], """
    select doc_id, year, source, title, author, text_checksum, text_bytes, text from docs""")


def _ingested(spark, paths: LakePaths):
    stored = scan(spark, paths.documents, DOCUMENTS)
    return blob_ops.with_text(stored, blob_ops.BlobStore(spark, paths.blobs).read()).select(
        "doc_id", "year", "source", "title", "author", "text_checksum", "text_bytes", "text")


@query("ingest_job", INGESTED_SQL)
def ingest_job(spark, sf_dir):
    """JSONL files and a metadata table into documents and blobs."""
    paths = LakePaths(new_folder(spark, "lake"))
    records = spark.read.schema(f"{RECORD}, source STRING").option("mode", "FAILFAST").json(write_jsonl(spark, sf_dir))
    jobs.ingest_records(records, i.metadata(spark, sf_dir), paths, i.RUN_ID)
    return _ingested(spark, paths)


@query("stream_ingest", INGESTED_SQL)
def stream_ingest(spark, sf_dir):
    """The same input as a stream of files, in batches of two."""
    paths = LakePaths(new_folder(spark, "lake"))
    ingest_stream(
        spark, write_jsonl(spark, sf_dir, parts=5), i.raw_metadata(spark, sf_dir), paths,
        new_folder(spark, "stream"), schema=f"{RECORD}, source STRING", files_per_batch=2,
    ).awaitTermination()
    return _ingested(spark, paths)


@query("embeddings_build", with_ctes(["chunks", "chunk_vec"], """
    select chunk_id, doc_id, year, source, 'hash-64' as model, 64 as dim, b.d as component, round(vector[b.d + 1]::double, 6) as value
    from chunks join chunk_vec using (chunk_id), (select range::int as d from range(64)) as b"""))
def embeddings_build(spark, sf_dir):
    paths = LakePaths(new_folder(spark, "lake"))
    append(i.chunks(spark, sf_dir), paths.chunks)
    jobs.embed(spark, paths, i.ENCODER)
    written = scan(spark, paths.embeddings, EMBEDDINGS)
    return written.select(
        "chunk_id", "doc_id", "year", "source", "model", "dim", F.posexplode("vector").alias("component", "v"),
    ).withColumn("value", F.round(F.col("v").cast("double"), 6)).drop("v")


@query("ivf_roundtrip", with_ctes(["vecs"], "select year, source, count(*) as n_vectors, true as codes_whole from vecs group by 1, 2"))
def ivf_roundtrip(spark, sf_dir):
    """Train, encode, write and read back: every vector is posted once, with a code per sub-space."""
    from folioloom.registry.vectors import CONFIG

    folder = new_folder(spark, "index")
    ann.write_index(ann.build_index(i.vectors(spark, sf_dir), CONFIG), folder)
    posted = ann.read_index(spark, folder, CONFIG).postings
    return posted.groupBy("year", "source").agg(
        F.count_distinct("chunk_id").alias("n_vectors"),
        F.bool_and(F.octet_length("codes") == CONFIG.m).alias("codes_whole"))
