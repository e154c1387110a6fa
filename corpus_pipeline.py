"""A corpus from raw documents to shards: five stages, each over all rows that the one before has kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folioloom.llm.common import set_aside, stored, table
from folioloom.llm.decontaminate import without_leaks
from folioloom.llm.jaccard import similar_documents
from folioloom.llm.mixing import mix
from folioloom.llm.quality import quality_rules
from folioloom.llm.queries import SHARDS
from folioloom.llm.sharding import kd_shards

# Near copies of the pipeline: word shingles of five and a similarity of 0.8 or more. op2's query has its own values.
SHINGLE_WORDS, SIMILAR_PERCENT = 5, 80

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules, base rules and likelihood ratio alike. Null and empty texts fail them; repeated rows stay or go together."""
    held, back = set_aside(docs, ["doc_id", "text", "lang"])
    return back(quality_rules(held, table(spark, sf_dir, "labels")).filter("quality.kept"))


def keep_one_of_similar(spark: SparkSession, docs: DataFrame, sf_dir: str, width: int = 3, percent: int = 90) -> DataFrame:
    """One document of each group of similar ones: the one with the smallest id, or any where no id is known.

    Groups are told apart by their own key, so ids may be null or stand for several texts. Documents without words are in no group and stay. Only ids and digests take part in the choice; the texts are joined to the list of
    chosen ones once. Rows that repeat id and text are one document.
    """
    groups = stored(similar_documents(docs, width, percent).filter("n_shingles > 0"), "groups")
    chosen = groups.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "digest")).alias("kept")).select("kept.doc_id", "kept.digest")
    held, back = set_aside(docs, ["doc_id", "text"])
    keyed = held.withColumn("text_digest", F.unhex(F.md5("text"))).alias("d")
    wordless = keyed.filter(~F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False)))
    worded = keyed.filter(F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    found = worded.join(chosen.alias("c"), (F.col("d.text_digest") == F.col("c.digest")) & F.col("d.doc_id").eqNullSafe(F.col("c.doc_id")), "left_semi")
    # Rows that repeat both id and text lie together after the join.
    first = found.withColumn("turn", F.row_number().over(Window.partitionBy("text_digest", "doc_id").orderBy("text_digest"))).filter("turn = 1")
    return back(first).unionByName(back(wordless))


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The stage: ``keep_one_of_similar`` by the pipeline's own values."""
    return keep_one_of_similar(spark, docs, sf_dir, SHINGLE_WORDS, SIMILAR_PERCENT)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark. Null and empty texts stay; without a benchmark all do."""
    return without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them; a document taken twice has two rows. A null source is a source."""
    return mix(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row's shard and its place there. Null texts count as empty ones, repeated rows each have a place."""
    return kd_shards(docs, SHARDS)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", keep_good),
    ("ngram_jaccard_join", keep_one_of_near_copies),
    ("benchmark_decontamination", drop_leaks),
    ("mixing", mix_sources),
    ("sharding", shard),
]

# The likelihood ratio, the cube method and the tree are not SQL; tests hold each stage against a plain version of its decision.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each result written and read again. An empty table has no rows at any stage."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
