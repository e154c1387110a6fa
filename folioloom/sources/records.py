"""Input of the lake: JSONL records and the metadata table beside them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioloom.schemas import RECORD


def read_records(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """JSONL records. Blank lines are skipped, other keys ignored, a malformed line fails the job."""
    return spark.read.schema(RECORD).option("mode", "FAILFAST").json(paths)


def split_records(spark: SparkSession, paths: str | list[str]) -> tuple[DataFrame, DataFrame]:
    """The records that parse, and the raw lines that do not."""
    lines = spark.read.text(paths).filter(F.btrim("value") != "")
    fields = F.from_json("value", f"{RECORD}, bad_line STRING", {"columnNameOfCorruptRecord": "bad_line"})
    parsed = lines.select(fields.alias("r"), F.col("_metadata.file_path").alias("file"))
    good = parsed.filter(F.col("r.bad_line").isNull()).select("r.*").drop("bad_line")
    return good, parsed.filter(F.col("r.bad_line").isNotNull()).select("r.bad_line", "file")


def metadata_table(raw: DataFrame) -> DataFrame:
    """One metadata row per ``ia_id``: the earliest year, then the first title and author.

    A plain aggregate, so copies of one key are combined before the shuffle.
    """
    year = F.col("year").try_cast("int")
    first = F.min(F.struct(
        year.isNull().alias("no_year"), year.alias("year"),
        F.col("title").isNull().alias("no_title"), F.col("title"),
        F.col("author").isNull().alias("no_author"), F.col("author"),
    )).alias("m")
    return (
        raw.filter(F.col("ia_id").isNotNull()).groupBy("ia_id").agg(first)
        .select("ia_id", "m.year", "m.title", "m.author")
    )
