"""The thirteen operators as queries over the given tables, with the parameters they are meant to run with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioloom.llm import oracles
from folioloom.llm.common import table
from folioloom.llm.decontaminate import benchmark_leaks
from folioloom.llm.divergence import source_divergence
from folioloom.llm.jaccard import similar_documents
from folioloom.llm.licences import licence_scan
from folioloom.llm.materialise import training_order, write_training_order
from folioloom.llm.middle import fill_in_middle, restored
from folioloom.llm.mixing import mix_plan
from folioloom.llm.perplexity import perplexity_filter
from folioloom.llm.quality import quality_rules
from folioloom.llm.repeats import without_repeats
from folioloom.llm.secrets import digest_text, secret_scan
from folioloom.llm.sharding import kd_shards
from folioloom.llm.toxicity import toxicity
from folioloom.session import new_folder

SHARDS = 24


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality_rules(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"), table(spark, sf_dir, "labels"))
    q = "quality."
    return rows.select("doc_id", *[q + c for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")],
                       F.round("quality.llr", 4).alias("llr"))


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_documents(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op3_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "training")
    write_training_order(table(spark, sf_dir, "documents"), folder)
    return training_order(spark, folder)


def op4_perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return perplexity_filter(docs, table(spark, sf_dir, "labels")).select("doc_id", "lang", "perplexity", "threshold", "kept")


def op5_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return benchmark_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = toxicity(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))
    held_out = F.coalesce(F.expr("crc32(cast(doc_id AS string)) % 5 = 0"), F.lit(False))
    return rows.select("doc_id", held_out.alias("held_out"), F.col("toxicity").alias("score"),
                       (F.col("toxicity") >= 0.5).cast("int").alias("predicted"))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = secret_scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    rows = rows.select("doc_id", "secrets", F.filter("secrets", lambda x: x["kind"] != "entropy").alias("base"))
    counts = [F.size(F.filter("base", lambda x: x["kind"] == F.lit("assign"))).cast("long").alias("n_assign"),
              F.size(F.filter("base", lambda x: x["kind"] == F.lit("access"))).cast("long").alias("n_access"),
              F.size(F.filter("base", lambda x: x["kind"] == F.lit("hex"))).cast("long").alias("n_hex")]
    return rows.select("doc_id", *counts, F.sha2(digest_text(F.col("base")), 256).alias("base_sha256"),
                       digest_text(F.col("secrets")).alias("spans"))


def op8_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = licence_scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select("doc_id", *["licence." + c for c in (
        "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")])


def op9_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = kd_shards(table(spark, sf_dir, "documents"), SHARDS)
    return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"), "slot",
                       F.lit(None).cast("int").alias("grown_shard"))


def op10_cube_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_plan(table(spark, sf_dir, "documents"))


def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(table(spark, sf_dir, "documents").select("text", "lang", "source"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "fim.*")
    rows = rows.withColumn("restored", restored(F.col("output"), F.col("form")))
    return rows.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2("restored", 256).alias("restored_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_quality_rules, op2_ngram_jaccard_join, op3_training_order, op4_perplexity, op5_benchmark_leaks, op6_toxicity,
    op7_secret_scan, op8_licence_scan, op9_kd_shards, op10_cube_mix, op11_substring_dedup, op12_source_divergence,
    op13_fill_in_middle)}
ORACLES: dict[str, str] = oracles.ORACLES
