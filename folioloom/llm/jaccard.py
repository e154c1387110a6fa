"""N-gram Jaccard join: documents whose word-shingle sets are nearly equal.

Prefix filtering: in an order of all shingles that puts rare ones first, two sets that are similar
enough share a shingle in the first few of each. So only those prefixes are joined. The order comes
from a counter array of fixed size (a shingle's bucket count, then its hash), which is a total
order whatever the counts are.

A candidate pair has to pass, at a shared prefix shingle: the length filter (sizes), the
positional filter (what can still follow behind the shingle in either set; exact at the first shared
shingle, where no true pair fails) and the suffix filter (a lower bound of the symmetric difference from
counts in eight cells of the hash space). Each surviving pair is verified once on its whole sets.

Groups of near copies are joined to components without all their pairs: every prefix shingle first pairs its
holders with one pivot only. Pairs of one component need no further look; those between different
components are then all tried, each side against what the pivot's component does not hold.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioloom.llm.common import WordHashes, binaries, components, counter_array, shingle_hashes, small_batches, stored

SKETCH_BITS = 24
CELLS = 8


def _sets(width: int):
    """A function from text bytes to the sorted distinct shingle hashes."""
    hashes = WordHashes()

    def of(text: bytes | None) -> np.ndarray:
        words = text.lower().split() if text else []
        return np.unique(shingle_hashes(hashes.of(words), width))

    return of


def _fresh(batches, digest: int = 0, text: int = 1):
    """(digest, text) of the texts this task has not seen yet."""
    seen = set()
    for batch in batches:
        rows = []
        for key, value in zip(batch.column(digest).to_pylist(), binaries(batch, text), strict=True):
            if key not in seen:
                seen.add(key)
                rows.append((key, value))
        yield rows


def _texts(docs: DataFrame) -> DataFrame:
    return docs.filter("text IS NOT NULL").select(F.unhex(F.md5("text")).alias("digest"), "text")


def _ordered(shingles: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The shingles under the global order: a byte of frequency, then the hash."""
    first = rank[(shingles >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)].astype(np.uint64)
    return (first << np.uint64(56)) | (shingles & np.uint64((1 << 56) - 1))


def _profiles(texts: DataFrame, width: int, percent: int) -> DataFrame:
    """One row per text: digest, n (set size), cells, prefix (its first shingles in the global order)."""
    def buckets(batch):
        of = _sets(width)
        for text in binaries(batch, 1):
            yield (of(text) >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)

    rank = texts.sparkSession.sparkContext.broadcast(counter_array(texts, buckets, SKETCH_BITS))

    def describe(batches):
        of = _sets(width)
        for rows in _fresh(batches):
            sizes, cells, prefixes, keys = [], [], [], []
            for digest, text in rows:
                found = of(text)
                n = len(found)
                if not n:
                    continue
                length = n - -(-percent * n // 100) + 1
                order = _ordered(found, rank.value)
                if length < n:
                    order = np.partition(order, length - 1)[:length]
                in_cells = np.minimum(np.bincount((found >> np.uint64(20)).astype(np.int64) & (CELLS - 1), minlength=CELLS), 255)
                keys.append(digest)
                sizes.append(n)
                cells.append(int.from_bytes(in_cells.astype(np.uint8).tobytes(), "little", signed=True))
                prefixes.append(np.sort(order).view(np.int64))
            offsets = np.concatenate([[0], np.cumsum([len(p) for p in prefixes])]).astype(np.int32)
            values = np.concatenate(prefixes) if prefixes else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([
                pa.array(keys, pa.binary()), pa.array(sizes, pa.int64()), pa.array(cells, pa.int64()),
                pa.ListArray.from_arrays(pa.array(offsets), pa.array(values)),
            ], ["digest", "n", "cells", "prefix"])

    found = texts.mapInArrow(describe, "digest binary, n long, cells long, prefix array<long>").dropDuplicates(["digest"])
    profiles = stored(found.withColumn("pid", F.monotonically_increasing_id()), "profiles")
    rank.destroy()
    return profiles


def _needed(percent: int):
    """The smallest shared count of two sets of sizes na and nb that makes them similar."""
    return F.expr(f"({percent} * (na + nb) + {99 + percent}) div {100 + percent}")


def _checked(pairs: DataFrame, profiles: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs (a, b, needed), a < b, that pass the filters; columns a, na, pa, b, nb, pb of a shared prefix shingle.

    Cells are joined on only for the pairs that the length and positional filters have left.
    """
    length = f"100 * least(na, nb) >= {percent} * greatest(na, nb)"
    sided = pairs.withColumn("needed", _needed(percent)).filter(f"({length}) AND least(na - pa, nb - pb) >= needed")
    sided = sided.select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), (F.col("na") + F.col("nb")).alias("both"), "needed").distinct()
    cells = profiles.select("pid", "cells")
    sided = sided.join(cells.select(F.col("pid").alias("a"), F.col("cells").alias("ca")), "a")
    sided = sided.join(cells.select(F.col("pid").alias("b"), F.col("cells").alias("cb")), "b")
    differing = " + ".join(
        f"abs((shiftrightunsigned(ca, {8 * i}) & 255) - (shiftrightunsigned(cb, {8 * i}) & 255))" for i in range(CELLS))
    return sided.filter(f"{differing} <= both - 2 * needed").select("a", "b", "needed")


def _verified(texts: DataFrame, profiles: DataFrame, pairs: DataFrame, width: int) -> DataFrame:
    """The pairs whose whole sets share enough. Sets are made again for the texts in question only."""
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("pid")).distinct()
    wanted = stored(nodes.join(profiles.select("pid", "digest"), "pid"), "wanted")

    def place(batch):
        yield np.array([int.from_bytes(d[:3], "big") for d in batch.column(0).to_pylist()], np.int64)

    bitmap = texts.sparkSession.sparkContext.broadcast(np.packbits(counter_array(wanted.select("digest"), place, 24) > 0))

    def remake(batches):
        of = _sets(width)
        bits = bitmap.value
        for rows in _fresh(batches):
            keys, sets = [], []
            for digest, text in rows:
                at = int.from_bytes(digest[:3], "big")
                if bits[at >> 3] >> (7 - (at & 7)) & 1:
                    keys.append(digest)
                    sets.append(of(text).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(sets, pa.binary())], ["digest", "shingles"])

    sets = texts.mapInArrow(remake, "digest binary, shingles binary")
    sets = sets.join(wanted, "digest").dropDuplicates(["pid"]).select("pid", "shingles")

    @F.arrow_udf("long")
    def shared(left: pa.Array, right: pa.Array) -> pa.Array:
        counts = [
            len(np.intersect1d(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), assume_unique=True))
            for x, y in zip(left.to_pylist(), right.to_pylist(), strict=True)]
        return pa.array(counts, pa.int64())

    one = pairs.join(sets.select(F.col("pid").alias("a"), F.col("shingles").alias("sa")), "a")
    two = one.join(sets.select(F.col("pid").alias("b"), F.col("shingles").alias("sb")), "b")
    found = stored(two.filter(shared("sa", "sb") >= F.col("needed")).select("a", "b"), "links")
    bitmap.destroy()
    return found


def links(docs: DataFrame, width: int = 3, percent: int = 90) -> tuple[DataFrame, DataFrame]:
    """Profiles (digest, n, pid) of all distinct texts with words, and their components (id, root) by pid.

    The components are those of all pairs with ``100 * shared >= percent * union``; a text without a
    partner is in none.
    """
    small_batches(docs.sparkSession)
    texts = _texts(docs)
    profiles = _profiles(texts, width, percent)
    entries = profiles.select("pid", F.col("n").cast("int").alias("n"), F.posexplode("prefix").alias("pos", "key"))
    pivots = entries.groupBy("key").agg(
        F.min(F.struct("pos", "pid", "n")).alias("pivot"), F.count(F.lit(1)).alias("holders")).filter("holders > 1")
    met = entries.join(pivots, "key")
    met = stored(met.select("key", "pid", "n", "pos", "pivot"), "prefixes")
    sided = met.filter("pid != pivot.pid").selectExpr(
        "pid AS a", "cast(n AS long) AS na", "pos AS pa", "pivot.pid AS b", "cast(pivot.n AS long) AS nb", "pivot.pos AS pb")
    tried = stored(_checked(sided, profiles, percent), "pairs")
    edges = _verified(texts, profiles, tried, width)
    roots = components(edges)

    def labelled(df: DataFrame, pid: str, name: str) -> DataFrame:
        named = roots.select(F.col("id").alias(pid), F.col("root").alias("_root"))
        return df.join(named, pid, "left").withColumn(name, F.coalesce("_root", pid)).drop("_root")

    spread = labelled(met.withColumn("pivot_pid", F.col("pivot.pid")), "pid", "root")
    spread = labelled(spread, "pivot_pid", "pivot_root")
    spread = stored(spread.select("key", "pid", F.col("n").cast("long").alias("n"), "pos", "root", "pivot_root"), "rooted")
    outer = spread.filter("root != pivot_root").selectExpr(
        "key", "pid AS a", "n AS na", "pos AS pa", "root AS ra")
    inner = spread.selectExpr("key", "pid AS b", "n AS nb", "pos AS pb", "root AS rb", "pivot_root")
    rest = outer.join(inner, "key").filter("ra != rb AND (rb = pivot_root OR a < b)")
    rest = stored(_checked(rest, profiles, percent).join(tried, ["a", "b"], "left_anti"), "pairs")
    if not rest.isEmpty():
        edges = edges.union(_verified(texts, profiles, rest, width))
        roots = components(edges)
    return profiles.select("digest", "n", "pid"), roots


def similar_documents(docs: DataFrame, width: int = 3, percent: int = 90) -> DataFrame:
    """One row per document: doc_id, digest (md5 of the text), n_shingles, component_id, component.

    ``docs`` needs doc_id and text; other columns are ignored. Words are cut at ASCII white space after
    lower-casing A-Z. Two documents are linked when their sets of ``width``-word shingles overlap by
    ``percent`` or more of the union; component_id is the smallest doc_id reachable. Null and wordless texts have no
    shingles and stay alone. A null doc_id is no candidate for the smallest, and a component of only null ids has a null
    component_id. Since ids may be null or clash, component is the component's own key: one number for all its rows, in no other
    component, null for texts without shingles. Repeated rows each come out. A text of any length is taken whole; an empty
    table gives an empty result.
    """
    docs = docs.select("doc_id", "text")
    profiles, roots = links(docs, width, percent)
    classes = profiles.join(roots.withColumnRenamed("id", "pid"), "pid", "left").select(
        "digest", "n", F.coalesce("root", "pid").alias("root"))
    rows = docs.select("doc_id", F.unhex(F.md5("text")).alias("digest"))
    least = rows.filter("digest IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("least"))
    named = classes.join(least, "digest")
    lowest = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = named.join(lowest, "root").select("digest", "n", "root", "component_id")
    return rows.join(named, "digest", "left").select(
        "doc_id", "digest", F.coalesce("n", F.lit(0)).cast("long").alias("n_shingles"),
        F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.col("root").alias("component"))
