"""How far the sources of a language differ in their words, pair by pair and term by term.

Terms are counted per language and source in each task and added up in one shuffle. A source's share of a term depends on its
count alone, so the terms of a language, as one indicator column per (source, count level), give by X^T X how many terms have each level in one
source and each in another: the joint tables of all pairs of sources. The product is taken over blocks of terms, in whole numbers, row
by row (a term has one level in each source, and so adds one to one cell of each table). Cells are priced once and counted as often as they occur;
sums over the blocks are added in the shuffle.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioloom.llm.common import binaries, small_batches, stored

# Fixed values of the contract.
MIN_DOCUMENTS, SCALE, TOP_TERMS = 3, 1_000_000_000, 200
# Terms: runs of ASCII letters, in lower case, and of all that is not ASCII.
TERMS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 else 32 for c in range(256))
# Entries a task counts before it hands them on, cells of one block's matrix, and sources of one tile of the product.
HELD_ENTRIES, BLOCK_CELLS, TILE = 400_000, 1 << 18, 16

COUNTED = "lang string, source string, term string, n long, docs long"


def _count(batches):
    """Partial counts (lang, source, term, n, docs); a row with a null term for every group."""
    counts: dict[tuple, tuple[Counter, Counter]] = {}

    def handed_on():
        for (lang, source), (n, docs) in counts.items():
            terms = [None, *(t.decode() for t in n)]
            yield pa.RecordBatch.from_pydict({
                "lang": pa.array([lang] * len(terms), pa.string()), "source": pa.array([source] * len(terms), pa.string()),
                "term": pa.array(terms, pa.string()), "n": pa.array([0, *n.values()], pa.int64()),
                "docs": pa.array([0, *(docs[t] for t in n)], pa.int64())})
        counts.clear()

    for batch in batches:
        for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), binaries(batch, 2), strict=True):
            terms = text.translate(TERMS).split()
            held = counts.setdefault((lang, source), (Counter(), Counter()))
            held[0].update(terms)
            held[1].update(set(terms))
        if sum(len(n) for n, _ in counts.values()) >= HELD_ENTRIES:
            yield from handed_on()
    yield from handed_on()


def share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (count + 1) / (total + terms)), exact."""
    part = (count + 1).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)")
    return F.call_function("div", part, (total + terms).cast("decimal(20,0)")).cast("long") + 1


def _price(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / q); shares are at most SCALE + 1, so the square is a long."""
    return F.call_function("div", (p - q) * (p - q), q)


def joint_tables(levels: np.ndarray, left: range, right: range):
    """The product of the indicator columns of some sources with those of others: (source, source, level, level, terms).

    ``levels`` has a row a term and a column a source. Only cells that occur are listed; all numbers are exact.
    """
    def columns(sources: range):
        """Values of the indicator columns, the source of each, and the column in which each term has its one."""
        values, owners, ones, first = [], [], [], 0
        for g in sources:
            found, inverse = np.unique(levels[:, g], return_inverse=True)
            values.append(found)
            owners.append(np.full(len(found), g))
            ones.append(inverse + first)
            first += len(found)
        return np.concatenate(values), np.concatenate(owners), np.stack(ones, axis=1)

    value_a, owner_a, one_a = columns(left)
    value_b, owner_b, one_b = columns(right)
    cells = (one_a[:, :, None] * len(value_b) + one_b[:, None, :]).ravel()
    cells, terms = np.unique(cells, return_counts=True)
    a, b = cells // len(value_b), cells % len(value_b)
    return owner_a[a], owner_b[b], value_a[a], value_b[b], terms


def _priced(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def _block(table: pa.Table) -> pa.Table:
    """Sums over the terms of one block, for every ordered pair of sources of its language.

    Rows without a term give each source and its share of a term that it does not have.
    """
    listed = table.filter(pc.is_null(table["term"])).sort_by("source")
    sources, none = listed["source"].to_pylist(), listed["p"].to_numpy()
    entries = table.filter(pc.is_valid(table["term"]))
    sums = np.zeros((len(sources), len(sources)), np.int64)
    if len(entries):
        place = {s: i for i, s in enumerate(sources)}
        at = np.array([place[s] for s in entries["source"].to_pylist()])
        coded = entries["term"].combine_chunks().dictionary_encode()
        levels = np.tile(none, (len(coded.dictionary), 1))
        levels[coded.indices.to_numpy(), at] = entries["p"].to_numpy()
        for i in range(0, len(sources), TILE):
            for j in range(i, len(sources), TILE):
                a, b, p, q, terms = joint_tables(levels, range(i, min(i + TILE, len(sources))), range(j, min(j + TILE, len(sources))))
                np.add.at(sums, (a, b), terms * _priced(p, q))
                if i != j:
                    np.add.at(sums, (b, a), terms * _priced(q, p))
    left, right = np.nonzero(~np.eye(len(sources), dtype=bool))
    names = pa.array(sources, pa.string())
    lang = table["lang"][0].as_py()
    return pa.table({"lang": pa.array([lang] * len(left), pa.string()), "source": names.take(pa.array(left)),
                     "item": names.take(pa.array(right)), "value": pa.array(sums[left, right], pa.int64())})


def source_divergence(docs: DataFrame, min_documents: int = MIN_DOCUMENTS, top_terms: int = TOP_TERMS) -> DataFrame:
    """Rows lang, source, part, item, value, rank for every group (lang, source) of ``docs``.

    Part ``pair``: every other source of the language, by how far it is from the group over all kept terms. Part ``term``: the ``top_terms`` terms
    by which the group stands out from its language. ``docs`` needs text, lang and source; nulls count as ''. A language keeps the terms that at
    least ``min_documents`` of its rows hold. A language without kept terms has pairs of value 0 and no term; one with a single source no pair.
    Equal values are ranked by item. Repeated rows count each; texts are taken whole, terms of any length too; an empty table has no rows.

    The result has a row for every two sources of a language, and so has each block while it is summed: it is meant for sources, not
    for hosts by the million.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    counted = rows.mapInArrow(_count, COUNTED).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    counted = stored(counted, "term-counts")
    groups = counted.filter("term IS NULL").select("lang", "source")
    kept = counted.filter("term IS NOT NULL").groupBy("lang", "term").agg(
        F.sum("n").alias("in_lang"), F.sum("docs").alias("in_docs")).filter(F.col("in_docs") >= min_documents).drop("in_docs")
    entries = stored(counted.filter("term IS NOT NULL").drop("docs").join(kept, ["lang", "term"]), "kept-terms")

    kept = entries.groupBy("lang", "term").agg(F.first("in_lang").alias("in_lang"))
    languages = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("in_lang").alias("lang_total"))
    totals = entries.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    sizes = groups.join(totals, ["lang", "source"], "left").join(languages, "lang", "left")
    sizes = stored(sizes.select("lang", "source", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("total", "terms", "lang_total")]), "sizes")

    priced = entries.join(sizes, ["lang", "source"]).withColumn("p", share(F.col("n"), F.col("total"), F.col("terms")))
    standing = priced.withColumn("q", share(F.col("in_lang"), F.col("lang_total"), F.col("terms"))).filter("p > q")
    standing = standing.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), _price(F.col("p"), F.col("q")).alias("value"))
    order = Window.partitionBy("lang", "source", "part").orderBy(F.col("value").desc(), "item")
    standing = standing.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top_terms)

    # As many blocks as keep a block's matrix of terms and sources in bounds.
    wide = sizes.groupBy("lang").agg(F.count(F.lit(1)).alias("sources"), F.max("terms").alias("terms"))
    most = wide.agg(F.max(F.col("sources") * F.col("terms"))).first()[0] or 0
    blocks = max(1, -(-most // BLOCK_CELLS))
    absent = F.when(F.col("terms") > 0, share(F.lit(0).cast("long"), F.col("total"), F.col("terms"))).otherwise(F.lit(1).cast("long"))
    listed = sizes.select("lang", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(None).cast("string").alias("term"), "source", absent.alias("p"))
    cells = priced.select("lang", F.pmod(F.xxhash64("lang", "term"), F.lit(blocks)).cast("int").alias("block"), "term", "source", "p")
    pairs = listed.unionByName(cells).groupBy("lang", "block").applyInArrow(_block, "lang string, source string, item string, value long")
    pairs = pairs.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value").withColumn("rank", F.row_number().over(order))
    return pairs.unionByName(standing)
