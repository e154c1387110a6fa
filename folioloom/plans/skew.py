"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A key is split once it has more rows than this, or more bytes where a weight is given. All such
# keys are; Spark chooses by its size how their list is joined.
ROWS_PER_SLICE = 100_000
BYTES_PER_SLICE = 256 * 1024 * 1024
NULL_SLICES = 1_024


def split_keys(
    df: DataFrame, key: str, rows_per_slice: int = ROWS_PER_SLICE,
    weight: str | None = None, bytes_per_slice: int = BYTES_PER_SLICE,
) -> DataFrame:
    """Heavy keys, and the slices each is to be cut into: by rows, and by the sum of a
    ``weight`` column where a row stands for that many bytes. No slice without a row.
    """
    total = F.count(F.lit(1)) / rows_per_slice
    if weight is not None:
        total = F.greatest(total, F.sum(weight) / bytes_per_slice)
    return (
        df.groupBy(key).agg(F.least(F.ceil(total), F.count(F.lit(1))).cast("int").alias("slices"))
        .filter((F.col("slices") > 1) & F.col(key).isNotNull())
    )


def salted_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    spread_by: str,
    how: str = "inner",
    rows_per_slice: int = ROWS_PER_SLICE,
    weight: str | None = None,
    bytes_per_slice: int = BYTES_PER_SLICE,
) -> DataFrame:
    """Equi-join on ``key``, inner or left, for a right side with one row per key.

    A heavy key of the left side is cut into slices by a hash of ``spread_by``, and the one
    matching right row is repeated per slice. All other keys have the single slice 0. The
    slices are dealt out by number: adaptive execution, which sees how short the left rows
    are but not what they are joined with, would put them together again.
    """
    if how not in ("inner", "left"):
        raise ValueError("the right side is repeated, so only inner and left joins are whole")
    heavy = split_keys(left, key, rows_per_slice, weight, bytes_per_slice)
    slice_of = F.when(F.col("slices").isNull(), F.lit(0)).otherwise(
        F.pmod(F.xxhash64(spread_by), F.col("slices")).cast("int"))
    if how == "left":
        slice_of = F.when(F.col(key).isNull(), F.pmod(F.xxhash64(spread_by), F.lit(NULL_SLICES)).cast("int")).otherwise(slice_of)
    cut = left.join(heavy, key, "left").withColumn("_slice", slice_of).drop("slices")
    repeated = right.join(heavy, key, "left").withColumn(
        "_slice", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("slices"), F.lit(1)) - 1))
    ).drop("slices")
    parts = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = cut.repartition(parts, key, "_slice"), repeated.repartition(parts, key, "_slice")
    return dealt[0].join(dealt[1], [key, "_slice"], how).drop("_slice")


def sliced_left_join(left: DataFrame, right: DataFrame, key: str, spread_by: list[str]) -> DataFrame:
    """Left join on a key that is nearly unique where it is known, and often null or empty.

    For a left side that is costly to scan twice: no count of its keys is taken. Rows whose key is null,
    which match nothing, or empty are spread over all tasks; of the right side, with one row per key, only the
    row of the empty key is repeated. Should another key be frequent, adaptive execution splits its rows.
    """
    slices = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    unknown = F.col(key).isNull() | (F.col(key) == "")
    cut = left.withColumn("_slice", F.when(unknown, F.pmod(F.xxhash64(*spread_by), F.lit(slices))).otherwise(F.lit(0)).cast("int"))
    known = right.filter(F.col(key) != "").withColumn("_slice", F.lit(0))
    empty = right.filter(F.col(key) == "").withColumn("_slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))
    return cut.join(known.unionByName(empty), [key, "_slice"], "left").drop("_slice")
