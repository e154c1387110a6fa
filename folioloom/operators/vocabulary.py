"""A dictionary of words with dense ids, kept as a table and extended by later runs.

No two words share an id, and ids of a run are the places of its new words in their order. The words are sorted by ranges; each task
counts its own, and the ranges are put behind each other by their totals, so no task sees all words.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioloom.functions.tokens import FIRST_WORD_ID, words
from folioloom.plans.lookups import looked_up
from folioloom.session import new_folder
from folioloom.sources.tables import exists

DICTIONARY = "word STRING, token_id BIGINT"
# Bits of a numbered row that hold its place inside its task.
PLACE_BITS = 33


def numbered_words(found: DataFrame, first: int) -> DataFrame:
    """Rows (word, token_id) of distinct words: gapless ids from ``first`` in the order of the words.

    The sorted words are written once with their place in their range, which fixes both. The driver gets one count for each range.
    """
    spark = found.sparkSession
    path = new_folder(spark, "words")
    ordered = found.select("word").repartitionByRange("word").sortWithinPartitions("word")
    ordered.withColumn("at", F.monotonically_increasing_id()).write.parquet(path)
    placed = spark.read.schema("word STRING, at BIGINT").parquet(path).select(
        "word", F.shiftright("at", PLACE_BITS).alias("part"), F.col("at").bitwiseAND(F.lit((1 << PLACE_BITS) - 1)).alias("place"))
    ranges = placed.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.min("word").alias("least")).orderBy("least").collect()
    starts, at = [], first
    for r in ranges:
        starts.append((r.part, at))
        at += r.n
    offsets = F.broadcast(spark.createDataFrame(starts, "part BIGINT, start BIGINT"))
    return placed.join(offsets, "part").select("word", (F.col("start") + F.col("place")).alias("token_id"))


@dataclass(frozen=True)
class Vocabulary:
    """The dictionary under ``path``. One run extends it at a time; ids that were given never change."""

    spark: SparkSession
    path: str

    def read(self) -> DataFrame:
        if not exists(self.spark, self.path):
            return self.spark.createDataFrame([], DICTIONARY)
        return self.spark.read.schema(DICTIONARY).parquet(self.path)

    def extend(self, texts: DataFrame, text: str = "text") -> None:
        """Give ids to the words of ``texts`` that have none. Null texts and texts without a word add nothing; the same texts again change nothing."""
        known = self.read()
        new = texts.select(F.explode(words(F.col(text))).alias("word")).distinct().join(known.select("word"), "word", "left_anti")
        last = known.agg(F.max("token_id")).first()[0]
        rows = numbered_words(new, FIRST_WORD_ID if last is None else last + 1)
        rows.sortWithinPartitions("word").write.mode("append").parquet(self.path)

    def encode(self, texts: DataFrame, key: str, text: str = "text") -> DataFrame:
        """``key, tokens``: the ids of each text's words in their order. ``key`` is unique; a word without an id stops the job.

        Texts look up their distinct words slice by slice, so no frequent word brings its places to one task.
        """
        spelled = texts.select(key, words(F.col(text)).alias("words"))
        found = looked_up(spelled, key, "words", self.read(), "word", "token_id", missing="no id for word")
        return found.select(key, F.col("found").alias("tokens"))
