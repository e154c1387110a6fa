"""Mixing sources to target weights by balanced sampling with the cube method.

A source's target over its size says how often each of its documents is taken on average. The whole part is taken as
it is. The fractional part is an inclusion probability, and the cube method rounds these to 0 or 1 so that the tokens and the
number of documents taken stay what they were: it moves three open probabilities at a time along the direction that changes neither
total, until one of them is 0 or 1. This is done in blocks of bounded size; what two open probabilities
a block has left meet in blocks of the next level, until at most two are open in a source. These land where the totals are closest.
"""

from __future__ import annotations

import random

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folioloom.llm.common import stored

# Documents in a block of the first level, and open ones in a block of the next ones.
BLOCK = 2048
SEED = 20
MAX_FACTOR = 3.0
WEIGHTS = [1.0, 2.0, 3.0]
EPSILON = 1e-9

WORDS = "size(filter(split(translate(text, '\\t\\n\\u000b\\u000c\\r', '     '), ' '), w -> w != ''))"
UNIT = "source string, doc_id string, size long, copies long, m long, pi double, turn long"


def with_size(docs: DataFrame) -> DataFrame:
    """``size``: words of the text, cut at ASCII white space; 0 for a null text."""
    return docs.withColumn("size", F.when(F.col("text").isNull(), 0).otherwise(F.expr(WORDS)).cast("long"))


def source_targets(sized: DataFrame, weights: list[float] | None = None, share: float = 1.0, factor: float = MAX_FACTOR) -> DataFrame:
    """Rows (source, source_size, target): words to be taken from each source.

    Sources in the order of their code points, null last, have the weights in turn. They share ``share`` of all words by weight,
    but none more than ``factor`` times its size; the excess is shared again among the others. With the sources in the order in which they
    reach their limits, those before some place are at their limit and the others share the rest, so one running sum finds it.
    """
    weights = weights or WEIGHTS
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn % len(weights) + 1).cast("int"))
    limit = F.col("source_size") * F.lit(float(factor))
    rows = stored(sums.select("source", "source_size", weight.alias("w"), limit.alias("limit")), "sources")
    order = Window.orderBy(F.col("limit") / F.col("w"), F.col("source").asc_nulls_last())
    upto = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    rows = rows.select(
        "*", (F.sum("source_size").over(everything) * share).alias("all"), F.sum("w").over(everything).alias("all_w"),
        F.coalesce(F.sum("limit").over(upto), F.lit(0.0)).alias("limits"), F.coalesce(F.sum("w").over(upto), F.lit(0.0)).alias("w_before"))
    # The level if all before this source are at their limits; it is the true one at the first source that it does not push over its own.
    rows = rows.withColumn("level", (F.col("all") - F.col("limits")) / (F.col("all_w") - F.col("w_before")))
    fits = F.when(F.col("level") * F.col("w") <= F.col("limit"), F.col("level"))
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.withColumn("level", F.first(fits, ignorenulls=True).over(whole))
    target = F.when(F.col("level").isNull(), F.col("limit")).otherwise(F.least(F.col("limit"), F.col("level") * F.col("w")))
    return rows.select("source", "source_size", target.alias("target"))


def flight(sizes: np.ndarray, pi: np.ndarray, rng: random.Random) -> np.ndarray:
    """Inclusion probabilities moved to 0 or 1 but for at most two, with their sum and their sum weighted by size kept."""
    pi = pi.astype(float).copy()
    held: list[int] = []
    for k in range(len(pi)):
        if not EPSILON < pi[k] < 1 - EPSILON:
            pi[k] = round(pi[k])
            continue
        held.append(k)
        while len(held) == 3:
            a, b, c = held
            x, y, z = sizes[a], sizes[b], sizes[c]
            u = (z - y, x - z, y - x) if not x == y == z else (1.0, -1.0, 0.0)
            up = min(((1 - pi[i]) / d if d > 0 else -pi[i] / d) for i, d in zip(held, u, strict=True) if d)
            down = min((pi[i] / d if d > 0 else (pi[i] - 1) / d) for i, d in zip(held, u, strict=True) if d)
            move = up if rng.random() * (up + down) < down else -down
            for i, d in zip(held, u, strict=True):
                pi[i] += move * d
                if pi[i] < EPSILON or pi[i] > 1 - EPSILON:
                    pi[i] = round(pi[i])
            held = [i for i in held if 0 < pi[i] < 1]
    return pi


def landing(sizes: np.ndarray, pi: np.ndarray) -> np.ndarray:
    """The 0/1 rounding of the last open probabilities that keeps tokens, then documents, closest to what they were."""
    at = [k for k in range(len(pi)) if EPSILON < pi[k] < 1 - EPSILON]
    best = min(range(1 << len(at)), key=lambda bits: (
        abs(sum(sizes[k] * ((bits >> j & 1) - pi[k]) for j, k in enumerate(at))),
        abs(sum((bits >> j & 1) - pi[k] for j, k in enumerate(at))), bits))
    out = np.round(pi)
    for j, k in enumerate(at):
        out[k] = best >> j & 1
    return out


def _moved(units: DataFrame, block: int, level: int, seed: int) -> DataFrame:
    counts = units.groupBy("source").agg(F.ceil(F.count(F.lit(1)) / block).alias("blocks"))
    keyed = units.alias("u").join(counts.alias("c"), F.col("u.source").eqNullSafe(F.col("c.source"))).select(
        "u.*", F.pmod(F.xxhash64("turn", F.lit(level)), "blocks").alias("block"), F.col("blocks"))

    def move(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["turn", "doc_id", "size"], kind="stable", na_position="last").reset_index(drop=True)
        rng = random.Random(f"{seed} {level} {rows.source.iloc[0]} {rows.block.iloc[0]}")
        sizes, pi = rows["size"].to_numpy(float), flight(rows["size"].to_numpy(float), rows.pi.to_numpy(), rng)
        if rows.blocks.iloc[0] == 1:
            pi = landing(sizes, pi)
        rows["pi"] = pi
        return rows[[x.split()[0] for x in UNIT.split(", ")]]

    return keyed.groupBy("source", "block").applyInPandas(move, UNIT)


def mixed(docs: DataFrame, weights: list[float] | None = None, share: float = 1.0, factor: float = MAX_FACTOR,
          seed: int = SEED, block: int = BLOCK) -> DataFrame:
    """Rows (doc_id, source, size, m, copies, extra, source_size, target), one for each distinct (doc_id, source, size).

    m rows of the input are alike in these; each of them is taken ``copies`` times, and ``extra`` of them once more.
    """
    kind = dict(docs.dtypes)["doc_id"]
    sized = with_size(docs.select("doc_id", F.col("source").cast("string").alias("source"), "text")).drop("text")
    units = stored(sized.groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("m")), "units")
    targets = stored(source_targets(units.withColumn("size", F.col("size") * F.col("m")), weights, share, factor), "targets")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    rows = units.alias("u").join(targets.alias("t"), F.col("u.source").eqNullSafe(F.col("t.source"))).select(
        "u.*", F.floor(rate + EPSILON).cast("long").alias("copies"), rate.alias("rate"))
    some = F.greatest(F.lit(0.0), F.col("rate") - F.col("copies")) * F.col("m")
    whole = F.floor(some + EPSILON).cast("long")
    rows = rows.select(
        "source", F.col("doc_id").cast("string").alias("doc_id"), "size",
        (F.col("copies") * F.col("m") + whole).alias("copies"), "m", F.greatest(F.lit(0.0), some - whole).alias("pi"),
        F.xxhash64("doc_id", "size", F.lit(seed)).alias("turn"))
    done, level, left = [], 0, rows
    while True:
        moved = stored(_moved(left, block, level, seed), "cube")
        done.append(moved.filter("pi = 0 OR pi = 1"))
        left = moved.filter("pi > 0 AND pi < 1")
        level += 1
        if left.isEmpty():
            break
    out = done[0]
    for part in done[1:]:
        out = out.union(part)
    taken = F.col("copies") + F.col("pi").cast("long")
    named = out.alias("o").join(targets.alias("t"), F.col("o.source").eqNullSafe(F.col("t.source")))
    return named.select(
        F.col("doc_id").cast(kind).alias("doc_id"), "o.source", "size", "m", taken.alias("taken"),
        "source_size", "target").select(
        "doc_id", "source", "size", "m", F.expr("taken div m").alias("copies"), F.expr("taken % m").alias("extra"), "source_size", "target")


def mix_plan(docs: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken (words the mix takes of it, repeats counted).

    ``docs`` needs doc_id, source and text. Size is the number of words cut at ASCII white space (null: 0). A null source is a
    source. Documents without words are taken or not like others, for 0 words. Rows alike in doc_id, source and size are handled
    together and each come out. What is taken depends on the rows alone, so reruns agree. An empty table has no rows.
    """
    rows = mixed(docs, **options)
    piece = 1_000_000
    rows = rows.withColumn("_a", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(m - 1) div {piece}"))))
    rows = rows.withColumn("_b", F.explode(F.sequence(
        F.col("_a") * piece, F.least((F.col("_a") + 1) * piece, F.col("m")) - 1)))
    often = F.col("copies") + (F.col("_b") < F.col("extra")).cast("long")
    return rows.select("doc_id", "size", "source_size", "target", (F.col("size") * often).alias("taken"))


def mix(docs: DataFrame, **options) -> DataFrame:
    """The rows of the mix: each row of ``docs`` as often as it is taken, all columns kept. See ``mix_plan``."""
    columns = docs.columns
    often = mixed(docs, **options).selectExpr(
        "doc_id AS _id", "source AS _source", "size AS _size", "m AS _m", "copies AS _copies", "extra AS _extra")
    sized = with_size(docs.select(*[F.col(f"`{c}`").alias(f"_c_{c}") for c in columns], "text")).drop("text").withColumnRenamed("size", "_size")
    joined = sized.join(often, sized["_c_doc_id"].eqNullSafe(often["_id"]) & sized["_c_source"].cast("string").eqNullSafe(often["_source"])
                        & (sized["_size"] == often["_size"])).drop(often["_size"])
    alike = Window.partitionBy("_c_doc_id", "_c_source", "_size").orderBy(F.xxhash64("_c_text"))
    turn = F.when(F.col("_m") == 1, F.lit(0)).otherwise(F.row_number().over(alike) - 1)
    times = (F.col("_copies") + (turn < F.col("_extra")).cast("long")).cast("int")
    repeated = joined.withColumn("_times", times).filter("_times > 0")
    repeated = repeated.withColumn("_time", F.explode(F.sequence(F.lit(1), F.col("_times"))))
    return repeated.select(*[F.col(f"`_c_{c}`").alias(c) for c in columns])
