"""From records and metadata to document rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioloom.functions import text as tx
from folioloom.plans.skew import sliced_left_join
from folioloom.schemas import DOCUMENTS, columns


def normalized(records: DataFrame) -> DataFrame:
    """Records with their text normalised in place."""
    return records.withColumn("text", tx.norm_text(F.col("text")))


def describe_texts(records: DataFrame) -> DataFrame:
    """The text-derived document columns. The text itself is left behind here, so that
    joins and writes further down move short rows only."""
    read = normalized(records).withColumn("text_checksum", tx.content_digest(F.col("text")))
    return read.select(
        "ia_id",
        "source",
        tx.document_id(F.col("ia_id"), F.col("text"), F.col("source_uri")).alias("doc_id"),
        tx.blob_uri(F.col("text_checksum")).alias("text_uri"),
        tx.text_bytes(F.col("text")).alias("text_bytes"),
        "text_checksum",
        tx.preview(F.col("text")).alias("preview"),
    )


def join_metadata(records: DataFrame, metadata: DataFrame, spread_by: list[str]) -> DataFrame:
    """Every record, with year, title and author where the metadata knows its id."""
    return sliced_left_join(records, metadata.select("ia_id", "year", "title", "author"), "ia_id", spread_by)


def stamp(df: DataFrame, run_id: str) -> DataFrame:
    """Run id and the time of the run, one value for all rows."""
    now = F.current_timestamp()
    return df.withColumns({"ingest_run_id": F.lit(run_id), "created_at": now, "updated_at": now})


def build_documents(records: DataFrame, metadata: DataFrame, run_id: str) -> DataFrame:
    """Document rows of ``records`` (with a ``source`` column) and a keyed metadata table."""
    joined = join_metadata(describe_texts(records), metadata, ["doc_id", "text_checksum"])
    dated = joined.withColumn("year", tx.year_or_unknown(F.col("year")))
    return stamp(dated, run_id).select(*columns(DOCUMENTS))


def ingest_totals(documents: DataFrame) -> DataFrame:
    """Documents and bytes per run."""
    return documents.groupBy("ingest_run_id").agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum("text_bytes").alias("n_bytes"))
