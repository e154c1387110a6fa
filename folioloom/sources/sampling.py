"""Samples of a table."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

from folioloom.schemas import columns


def sample_files(spark: SparkSession, path: str, schema: str, fraction: float, seed: int = 42, under: str = "") -> DataFrame:
    """All rows of a seeded sample of the table's files, at least one file.

    ``under`` names a folder of the table, such as ``model=x``, whose files alone are drawn from.

    The names come from the file listing the driver holds for any scan; no row is read to
    find them. The same files and seed give the same sample.
    """
    folder = f"{path}/{under}" if under else path
    names = sorted(spark.read.schema(schema).option("basePath", path).parquet(folder).inputFiles())
    if not names:
        return spark.createDataFrame([], schema)
    picked = random.Random(seed).sample(names, max(1, int(len(names) * fraction)))
    return spark.read.schema(schema).option("basePath", path).parquet(*picked).select(*columns(schema))
