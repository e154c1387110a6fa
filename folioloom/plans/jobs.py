"""The jobs of the lake: each reads one table and appends to the next."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from folioloom.functions.tokens import WordTokenizer
from folioloom.functions.vectors import vector_ok
from folioloom.operators import ann, fulltext
from folioloom.operators.chunks import chunk_rows
from folioloom.operators.documents import build_documents, normalized
from folioloom.operators.embedding import embed_chunks
from folioloom.paths import LakePaths
from folioloom.schemas import CHUNKS, DOCUMENTS, EMBEDDINGS, PARTITION_KEYS
from folioloom.session import task_share
from folioloom.sources.blobs import BlobStore, with_text
from folioloom.sources.ndjson import export_ndjson
from folioloom.sources.records import metadata_table, read_records, split_records
from folioloom.sources.sampling import sample_files
from folioloom.sources.tables import append, balance_by, scan


def new_run_id() -> str:
    return uuid.uuid4().hex


def ingest_records(records: DataFrame, metadata: DataFrame, paths: LakePaths, run_id: str) -> None:
    """Append the new texts, then the documents that refer to them.

    The records are read once for each of the two tables instead of being kept: the text
    goes into one of them only, and nothing of the input's size is held by executors.
    """
    BlobStore(records.sparkSession, paths.blobs).add_texts(normalized(records))
    append(build_documents(records, metadata, run_id), paths.documents, sort_by=["doc_id"], bloom=["doc_id"])


def ingest(
    spark: SparkSession, jsonl: str | list[str], metadata: DataFrame, paths: LakePaths,
    source: str = "ia", run_id: str | None = None, rejects: str | None = None,
) -> str:
    """JSONL files into documents and blobs; returns the run id.

    A malformed line fails the job, unless ``rejects`` names a folder for such lines.
    """
    run_id = run_id or new_run_id()
    if rejects is None:
        records = read_records(spark, jsonl)
    else:
        records, bad = split_records(spark, jsonl)
        bad.write.mode("append").json(rejects)
    records = records.withColumn("source", F.lit(source))
    ingest_records(records, metadata_table(metadata), paths, run_id)
    return run_id


def chunk(spark: SparkSession, paths: LakePaths, tokenizer=WordTokenizer(), window: int = 512, overlap: int = 64) -> None:
    """Documents into chunks.

    The texts are dealt out by folder and size before they are cut: that moves less than
    moving the chunks, and a few very long documents do not end up in one task.
    """
    documents = scan(spark, paths.documents, DOCUMENTS).select(
        "doc_id", "year", "source", "text_checksum", "text_bytes", "ingest_run_id")
    texts = with_text(documents, BlobStore(spark, paths.blobs).read())
    rows = chunk_rows(balance_by(texts, *PARTITION_KEYS), tokenizer, window, overlap)
    with task_share(spark, paths.blobs):
        append(rows, paths.chunks, sort_by=["doc_id", "seq"], balance=False, bloom=["chunk_id"])


def embed(spark: SparkSession, paths: LakePaths, encoder) -> dict[str, int]:
    """Chunks into embeddings of one model. Chunks are read folder by folder, and embeddings
    are written to folders of the same keys, so nothing is shuffled.

    A vector that is null, of another length than the encoder's, or holds a null or NaN never reaches the table. How many do is
    observed on the write itself: ``n_chunks, n_written, n_rejected``. Only where some are rejected, a second pass
    appends their rows to the rejects of the lake.
    """
    seen = Observation()
    rows = embed_chunks(scan(spark, paths.chunks, CHUNKS), encoder).withColumn("fits", vector_ok(F.col("vector"), encoder.dim))
    counted = rows.observe(seen, F.count(F.lit(1)).alias("n_chunks"), F.count_if("fits").alias("n_written"))
    append(counted.filter("fits").drop("fits"), paths.embeddings, keys=["model", *PARTITION_KEYS], balance=False)
    totals = {**seen.get, "n_rejected": seen.get["n_chunks"] - seen.get["n_written"]}
    if totals["n_rejected"]:
        rows.filter(~F.col("fits")).drop("fits", "vector").write.mode("append").parquet(paths.rejects("embeddings"))
    return totals


def index_vectors(
    spark: SparkSession, paths: LakePaths, model: str, config: ann.IVFPQConfig, fraction: float = 0.01,
) -> None:
    """Embeddings of one model into an index and its metadata, trained on a share of the files."""
    embeddings = scan(spark, paths.embeddings, EMBEDDINGS).filter(F.col("model") == model)
    training = sample_files(spark, paths.embeddings, EMBEDDINGS, fraction, under=f"model={model}")
    index = ann.build_index(embeddings, config, training)
    ann.write_index(index, paths.vector_index(model))
    ann.write_vector_meta(embeddings, f"{paths.vector_index(model)}/vector_meta")


def index_text(spark: SparkSession, paths: LakePaths) -> None:
    """Chunks into the full-text index."""
    with task_share(spark, paths.chunks):
        fulltext.write_text_index(scan(spark, paths.chunks, CHUNKS), paths.text_index)


def export(spark: SparkSession, paths: LakePaths, docs_per_file: int = 0, gzip: bool = False) -> DataFrame:
    """Chunks as newline-delimited JSON; returns the rows that cannot be exported."""
    return export_ndjson(scan(spark, paths.chunks, CHUNKS), paths.search_export, docs_per_file, gzip)
