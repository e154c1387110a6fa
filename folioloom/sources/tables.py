"""Hive-partitioned Parquet tables: scan, append, count."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioloom.schemas import PARTITION_KEYS, columns


def located(spark: SparkSession, path: str):
    """The file system a path belongs to, and the path as it takes it."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    """Whether something has been written under ``path``; asked of the file system it belongs to."""
    files, at = located(spark, path)
    return files.exists(at)


def scan(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Lazy scan with a fixed schema; partition folders are never type-guessed."""
    return spark.read.schema(schema).parquet(path).select(*columns(schema))


def spread(scanned: DataFrame, key: str) -> DataFrame:
    """A scan dealt out by ``key`` where it has fewer splits than there are cores.

    For small tables kept in one file. A table of many splits is passed on as it is.
    """
    cores = scanned.sparkSession.sparkContext.defaultParallelism
    return scanned.repartition(cores, key) if scanned.rdd.getNumPartitions() < cores else scanned


def balance_by(df: DataFrame, *keys: str) -> DataFrame:
    """Rows of one key combination together, in as many tasks as their size asks for.

    Adaptive execution sizes the tasks from the shuffled bytes: it merges small
    combinations and splits one that holds a large share of the rows.
    """
    return df.hint("rebalance", *keys)


def append(
    df: DataFrame,
    path: str,
    keys: list[str] = PARTITION_KEYS,
    mode: str = "append",
    max_rows_per_file: int = 0,
    sort_by: list[str] | None = None,
    balance: bool = True,
    bloom: list[str] | None = None,
) -> None:
    """Write under ``key=value`` folders, few files per folder, file names unique per run.

    Rows that already lie together by ``keys`` are written without ``balance``, which is a
    shuffle of all of them.

    ``sort_by`` orders the rows inside each file, so that row-group statistics let a
    lookup on those columns skip most of the table. ``bloom`` names columns that are looked up by value but not
    sorted by, or in files that overlap: each row group gets a Bloom filter for them, as large as its distinct values ask for.
    """
    out = balance_by(df, *keys) if balance else df
    if sort_by:
        out = out.sortWithinPartitions(*keys, *sort_by)
    writer = out.write.mode(mode).partitionBy(*keys).option("compression", "zstd")
    if max_rows_per_file:
        writer = writer.option("maxRecordsPerFile", max_rows_per_file)
    for column in bloom or []:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true").option("parquet.bloom.filter.adaptive.enabled", "true")
    writer.parquet(path)


def count_stored(spark: SparkSession, path: str, schema: str, by: list[str] | None = None) -> DataFrame:
    """``n_rows`` of a table, or for each combination of the partition columns ``by``, from the footers of its files: no column is read.

    For that the table is read by the source that takes aggregates. A session without ``spark.sql.parquet.aggregatePushdown``
    (``build_session`` sets it) counts rows of no columns instead.
    """
    key = "spark.sql.sources.useV1SourceList"
    before = spark.conf.get(key)
    spark.conf.set(key, ",".join(name for name in before.split(",") if name != "parquet"))
    try:
        rows = spark.read.schema(schema).parquet(path)
    finally:
        spark.conf.set(key, before)
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows")) if by else count_rows(rows)


def count_rows(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


def union_all(*parts: DataFrame) -> DataFrame:
    """Rows of all parts, matched by column name, duplicates kept."""
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
