"""Ingest of a folder that JSONL files keep arriving in."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from folioloom.operators.documents import build_documents, normalized, stamp
from folioloom.paths import LakePaths
from folioloom.schemas import DOCUMENTS, PARTITION_KEYS, RECORD, columns
from folioloom.sources.blobs import BlobStore
from folioloom.sources.records import metadata_table
from folioloom.sources.tables import append, exists, scan


UNTIMED = [c for c in columns(DOCUMENTS) if c not in ("created_at", "updated_at")]


def write_batch(records: DataFrame, batch_id: int, metadata: DataFrame, paths: LakePaths, stream: str) -> None:
    """One batch into the lake, with the run id ``<stream>-<batch>``.

    Replaying a batch changes nothing: its texts are already stored, and a finished run is
    on record. If a run was started and broke off, the documents it left are taken off
    first, each as often as it is there. Batches come one at a time.
    """
    spark = records.sparkSession
    run_id = f"{stream}-{batch_id}"
    started, finished = f"{paths.runs}/{run_id}.started", f"{paths.runs}/{run_id}"
    if exists(spark, f"{finished}/_SUCCESS"):
        return
    again = exists(spark, started)
    _note(spark, run_id, started)
    BlobStore(spark, paths.blobs).add_texts(normalized(records))
    documents = build_documents(records, metadata, run_id)
    if again and exists(spark, paths.documents):
        written = scan(spark, paths.documents, DOCUMENTS).filter(F.col("ingest_run_id") == run_id).select(*UNTIMED)
        documents = stamp(documents.select(*UNTIMED).exceptAll(written), run_id).select(*columns(DOCUMENTS))
    append(documents, paths.documents, keys=PARTITION_KEYS, sort_by=["doc_id"])
    _note(spark, run_id, finished)


def _note(spark: SparkSession, run_id: str, path: str) -> None:
    spark.range(1).select(F.lit(run_id).alias("run_id")).coalesce(1).write.mode("overwrite").json(path)


def ingest_stream(
    spark: SparkSession, folder: str, metadata: DataFrame, paths: LakePaths, checkpoint: str,
    source: str = "ia", stream: str = "stream", schema: str = RECORD, files_per_batch: int = 1000,
) -> StreamingQuery:
    """Start a query that takes in all files present, in batches, and then ends.

    ``schema`` may add a ``source`` column to the record; without one all records get ``source``.
    """
    keyed = metadata_table(metadata)
    records = (
        spark.readStream.schema(schema).option("mode", "FAILFAST")
        .option("maxFilesPerTrigger", files_per_batch).json(folder)
    )
    if "source" not in records.columns:
        records = records.withColumn("source", F.lit(source))
    return (
        records.writeStream.foreachBatch(lambda df, batch_id: write_batch(df, batch_id, keyed, paths, stream))
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
