"""Quality classifier: perplexity under an interpolated modified Kneser-Ney model over the words of trusted text.

The model has word pairs and single words. The logarithm of a text's probability is a sum of one value for each of its pairs and words:
``log p(w)`` against that of an unknown word, the logarithm of what its history leaves to the order below, and what a pair that was seen
has beyond that. Pairs that were never seen have the value 0. So a text needs each of its grams looked up once, and nothing for those that
find no partner.

Counts, values and lookups are dealt into shards by the hash of the gram, as many as the words of the corpus ask for. Grams are counted
inside tasks before they move, and move packed: sorted, as differences, by byte planes. A shard's values meet the lookups of the documents
as a stream, so no task holds more than the values of one shard. The documents come in WAVES parts, and each part's lookups, and the tables
written on the way, are dropped when they have been used. Grams that very many documents have, at most ``HEAD`` of them, are looked
up in the tasks that read the documents, so no shard gets more than its share.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioloom.llm.common import LETTERS, WordHashes, binaries, discard, mixed, rows_with_ids, set_aside, stored
from folioloom.session import shuffles_dropped

# Stand-ins for words: the first of a pair that is a single word, the start and the end of a text.
SINGLE, START, END = (np.uint64(i) for i in (0, 1, 2))
# Values are whole numbers of this part of a natural logarithm, so that sums do not depend on their order.
UNIT = 1 << 16
# Words of the corpus per shard, and the fewest shards.
WORDS_PER_SHARD = 1 << 22
LEAST_SHARDS = 32
# Words put together in a task before their grams are handed on, and documents at most.
WORDS_HELD = 1 << 20
DOCS_HELD = 1 << 16
ROWS_HELD = 1 << 20
# Grams looked up where the documents are read, and candidates for these from each lot of documents.
HEAD = 1 << 16
CANDIDATES = 1 << 12
# Parts of the documents, by a hash of the text, that are looked up one after another.
WAVES = 4
# Bits of a gram's hash behind those that name its shard.
KEY_BITS = 40
# One trusted text in so many is not learned from but sets the thresholds.
HELD_OUT = 4
# A document is kept up to this quantile of its language's held-out perplexities; one clean document in a hundred may go.
QUANTILE = 0.99
# Perplexities are compared in steps of this size of their natural logarithm.
STEP = 0.002


def gram_hashes(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mixed(mixed(first + np.uint64(0x5851F42D4C957F2D)) + second)


def pairs(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The word pairs of a text, from the start to the end."""
    return np.concatenate([[START], words]), np.concatenate([words, [END]])


def grams(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Its pairs, and its single words with the start and the end."""
    first, second = pairs(words)
    return np.concatenate([first, np.full(len(words) + 2, SINGLE)]), np.concatenate([second, [START], second])


def split_words(text: bytes | None, hashes: WordHashes) -> np.ndarray:
    """Hashes of the words: letters and digits, ASCII in lower case."""
    return hashes.of((text or b"").translate(LETTERS).split())


def packed(*arrays: np.ndarray) -> bytes:
    """Arrays of one length, by byte planes."""
    planes = [np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T).tobytes() for a in arrays]
    return zstandard.ZstdCompressor(level=3).compress(b"".join(planes))


def unpacked(data: bytes, *kinds) -> list[np.ndarray]:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    sizes = [np.dtype(k).itemsize for k in kinds]
    n, at, out = len(raw) // sum(sizes), 0, []
    for kind, size in zip(kinds, sizes, strict=True):
        out.append(np.ascontiguousarray(raw[at:at + n * size].reshape(size, n).T).view(kind).reshape(-1))
        at += n * size
    return out


def by_shard(hashes: np.ndarray, bits: int):
    """Shard and the places of its hashes, which have to be sorted."""
    shards = (hashes >> np.uint64(64 - bits)).astype(np.int64)
    cuts = np.flatnonzero(np.diff(shards)) + 1
    for low, high in zip([0, *cuts], [*cuts, len(shards)], strict=True):
        if high > low:
            yield int(shards[low]), slice(low, high)


def keys_of(hashes: np.ndarray, bits: int) -> np.ndarray:
    """The bits of a hash that tell grams of a shard apart."""
    return (hashes << np.uint64(bits)) >> np.uint64(64 - KEY_BITS)


def distinct(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted order, where each distinct hash begins in it, and how often it is there."""
    order = np.argsort(hashes, kind="stable")
    held = hashes[order]
    starts = np.flatnonzero(np.concatenate([[True], held[1:] != held[:-1]])) if len(held) else np.zeros(0, np.int64)
    return order, starts, np.diff(np.concatenate([starts, [len(held)]]))


def lots(batches, columns: int):
    """Words of many texts at a time, with the other columns: lists [(words, other values)] that are bounded in words and texts."""
    hashes, lot, n = WordHashes(), [], 0
    for batch in batches:
        others = [batch.column(i).to_pylist() for i in range(1, columns)]
        for row, text in enumerate(binaries(batch)):
            words = split_words(text, hashes)
            if not len(words):
                continue
            lot.append((words, tuple(o[row] for o in others)))
            n += len(words)
            if n >= WORDS_HELD or len(lot) >= DOCS_HELD:
                yield lot
                lot, n = [], 0
    if lot:
        yield lot


def _joined(found: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    return np.concatenate([f for f, _ in found]), np.concatenate([s for _, s in found])


def common_grams(docs: DataFrame) -> tuple[DataFrame, int]:
    """Grams that occur most often, as rows (first, second), at most HEAD; and the number of words in all documents."""
    def count(batches):
        for lot in lots(batches, 1):
            first, second = _joined([grams(words) for words, _ in lot])
            order, starts, n = distinct(gram_hashes(first, second))
            top = np.argsort(-n, kind="stable")[:CANDIDATES]
            at = order[starts[top]]
            yield pa.RecordBatch.from_pydict({
                "first": first[at].view(np.int64), "second": second[at].view(np.int64), "n": n[top].astype(np.int64),
                "words": np.concatenate([[sum(len(w) for w, _ in lot)], np.zeros(len(top) - 1, np.int64)])})

    counted = stored(docs.select("text").mapInArrow(count, "first long, second long, n long, words long").groupBy("first", "second").agg(
        F.sum("n").alias("n"), F.sum("words").alias("words")), "candidates")
    return counted.orderBy(F.desc("n"), "first", "second").limit(HEAD).select("first", "second"), counted.agg(F.sum("words")).first()[0] or 0


def pair_counts(texts: DataFrame, bits: int) -> DataFrame:
    """Rows (first, second, c): how often each pair occurs in all texts."""
    def count(batches):
        for lot in lots(batches, 1):
            first, second = _joined([pairs(words) for words, _ in lot])
            hashes = gram_hashes(first, second)
            order, starts, n = distinct(hashes)
            at = order[starts]
            for shard, part in by_shard(hashes[at], bits):
                # Pairs in the order of their words, which repeat, with the words themselves kept once.
                rows = at[part]
                words, codes = np.unique(np.concatenate([first[rows], second[rows]]), return_inverse=True)
                front, back = np.split(codes.astype(np.uint32), 2)
                by = np.lexsort((back, front))
                steps = np.diff(front[by], prepend=np.uint32(0))
                yield pa.RecordBatch.from_pydict({
                    "shard": pa.array([shard], pa.int64()), "words": pa.array([packed(np.diff(words, prepend=np.uint64(0)))], pa.binary()),
                    "data": pa.array([packed(steps, back[by], n[part][by].astype(np.uint32))], pa.binary())})

    def add(group: pa.Table) -> pa.Table:
        firsts, seconds, counts = [], [], []
        for words, data in zip(group["words"].to_pylist(), group["data"].to_pylist(), strict=True):
            held = np.cumsum(unpacked(words, np.uint64)[0], dtype=np.uint64)
            steps, back, n = unpacked(data, np.uint32, np.uint32, np.uint32)
            firsts.append(held[np.cumsum(steps, dtype=np.int64)])
            seconds.append(held[back])
            counts.append(n.astype(np.int64))
        first, second, n = (np.concatenate(x) for x in (firsts, seconds, counts))
        by = np.lexsort((second, first))
        first, second, n = first[by], second[by], n[by]
        starts = np.flatnonzero(np.concatenate([[True], (first[1:] != first[:-1]) | (second[1:] != second[:-1])]))
        return pa.table({"first": first[starts].view(np.int64), "second": second[starts].view(np.int64), "c": np.add.reduceat(n, starts)})

    parts = texts.select("text").mapInArrow(count, "shard long, words binary, data binary")
    return parts.groupBy("shard").applyInArrow(add, "first long, second long, c long")


def discounts(counts: DataFrame) -> list[float]:
    """The three discounts of modified Kneser-Ney, from the counts of counts."""
    n = {r.c: r["n"] for r in counts.filter("c <= 4").groupBy("c").agg(F.count(F.lit(1)).alias("n")).collect()}
    n1, n2, n3, n4 = (n.get(i, 0) for i in (1, 2, 3, 4))
    if not (n1 and n2):
        return [0.5, 0.75, 0.9]
    y = n1 / (n1 + 2 * n2)
    found = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 0.9]
    return [min(max(d, 0.05), i + 0.95) for i, d in enumerate(found)]


def _cut(by: list[float]):
    return F.when(F.col("c") == 1, by[0]).when(F.col("c") == 2, by[1]).otherwise(by[2])


def _with_word(rows: DataFrame, words: DataFrame, top: DataFrame, key: str, column: str) -> DataFrame:
    """A column of ``words`` for the word under ``key``: from the frequent ones where the rows lie, which is most of them, else by a join."""
    def of(table: DataFrame) -> DataFrame:
        return table.select(F.col("word").alias(key), column).filter(F.col(column).isNotNull())

    tried = rows.join(F.broadcast(of(top)), key, "left")
    return tried.filter(F.col(column).isNotNull()).unionByName(tried.filter(F.col(column).isNull()).drop(column).join(of(words), key))


def model(texts: DataFrame, bits: int) -> tuple[DataFrame, float] | None:
    """Rows (first, second, value) of all grams, and the logarithm of an unknown word's probability. None without any word.

    p(w2 | w1) = (c - d) / n + left / n * p(w2), with the discounted counts of the pairs of w1 and what is left by the discounts. p(w) has
    the number of words seen in front of w as its count, and leaves its discounts to the words of the vocabulary and an unknown one alike.
    """
    counts = stored(pair_counts(texts, bits), "pairs")
    if counts.isEmpty():
        return None
    high = discounts(counts)
    histories = counts.groupBy("first").agg(F.sum("c").alias("n"), F.sum(_cut(high)).alias("left"))
    fronts = stored(counts.groupBy("second").agg(F.count(F.lit(1)).alias("c")), "fronts")
    low = discounts(fronts)
    total, left, kinds = fronts.agg(F.sum("c"), F.sum(_cut(low)), F.count(F.lit(1))).first()
    unknown = left / total / (kinds + 1)
    single = fronts.select(F.col("second").alias("word"), "c", ((F.col("c") - _cut(low)) / total + unknown).alias("p"))
    words = stored(single.join(histories.withColumnRenamed("first", "word"), "word", "full"), "words")
    discard(fronts)
    own = words.select(
        F.lit(int(SINGLE)).cast("long").alias("first"), F.col("word").alias("second"),
        (F.coalesce(F.log("p") - math.log(unknown), F.lit(0.0)) + F.coalesce(F.log(F.col("left") / F.col("n")), F.lit(0.0))).alias("v"))
    top = stored(words.orderBy(F.desc(F.coalesce("n", F.lit(0)) + F.coalesce("c", F.lit(0))), "word").limit(HEAD), "top")
    seen = _with_word(_with_word(counts, words, top, "first", "left"), words, top, "second", "p")
    both = seen.select("first", "second", F.log1p((F.col("c") - _cut(high)) / (F.col("left") * F.col("p"))).alias("v")).union(own)
    return both.select("first", "second", F.round(F.col("v") * UNIT).cast("int").alias("value")), math.log(unknown)


# What moves between the steps: the values of a shard come first (kind 0), then lookups (1). Documents of a lot have a shard of their own (2).
MOVED = "shard long, kind int, lot long, data binary"


def _moved(shard: int, kind: int, lot: int, data: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({
        "shard": pa.array([shard], pa.int64()), "kind": pa.array([kind], pa.int32()), "lot": pa.array([lot], pa.int64()),
        "data": pa.array([data], pa.binary())})


def gathered(batches):
    """Batches put together up to ROWS_HELD rows."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= ROWS_HELD:
            yield pa.Table.from_batches(held)
            held, n = [], 0
    if n:
        yield pa.Table.from_batches(held)


def shard_values(values: DataFrame, bits: int) -> DataFrame:
    def pack(batches):
        for held in gathered(batches):
            first, second, value = (held.column(i).to_numpy() for i in range(3))
            hashes = gram_hashes(first.view(np.uint64), second.view(np.uint64))
            order = np.argsort(hashes)
            hashes, value = hashes[order], value[order].astype(np.int32)
            for shard, part in by_shard(hashes, bits):
                yield _moved(shard, 0, 0, packed(np.diff(keys_of(hashes[part], bits), prepend=np.uint64(0)), value[part]))

    return values.mapInArrow(pack, MOVED)


def common_values(common: DataFrame, packs: DataFrame, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of the common grams and their values, 0 for those without; at most HEAD."""
    rows = common.toArrow()
    hashes = np.sort(gram_hashes(*(rows[c].to_numpy().astype(np.int64).view(np.uint64) for c in ("first", "second"))))
    shared = packs.sparkSession.sparkContext.broadcast({shard: (part.start, keys_of(hashes[part], bits)) for shard, part in by_shard(hashes, bits)})

    def find(batches):
        for batch in batches:
            for shard, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if shard in shared.value:
                    start, wanted = shared.value[shard]
                    steps, value = unpacked(data, np.uint64, np.int32)
                    keys = np.cumsum(steps, dtype=np.uint64)
                    place = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
                    hit = np.flatnonzero(keys[place] == wanted)
                    yield pa.RecordBatch.from_pydict({"at": (hit + start).astype(np.int64), "value": value[place[hit]].astype(np.int64)})

    values = np.zeros(len(hashes), np.int64)
    if len(hashes):
        found = packs.select("shard", "data").mapInArrow(find, "at long, value long").toArrow()
        values[found["at"].to_numpy()] = found["value"].to_numpy()
    shared.destroy()
    return hashes, values


def lookups(docs: DataFrame, head: tuple[np.ndarray, np.ndarray], bits: int) -> DataFrame:
    """From (text, k1, k2): for each lot of documents its keys with what the common grams give, and the other grams by shard."""
    shared = docs.sparkSession.sparkContext.broadcast(head)

    def look(batches):
        common, values = shared.value
        for lot in lots(batches, 3):
            found = [gram_hashes(*grams(words)) for words, _ in lot]
            places = np.repeat(np.arange(len(lot)), [len(f) for f in found])
            found = np.concatenate(found)
            sums = np.zeros(len(lot), np.int64)
            if len(common):
                at = np.minimum(np.searchsorted(common, found), len(common) - 1)
                here = common[at] == found
                np.add.at(sums, places[here], values[at[here]])
                found, places = found[~here], places[~here]
            keys = np.array([k for _, k in lot], np.int64)
            name = xxhash.xxh3_64_intdigest(keys.tobytes()) >> 1
            yield _moved(-1 - name, 2, name, packed(
                keys[:, 0].copy(), keys[:, 1].copy(), sums, np.array([len(w) for w, _ in lot], np.int64)))
            order, starts, n = distinct(found)
            # A gram takes one byte for how often it is there; more often than that, it is there again.
            again = (n - 1) // 255
            for shard, part in by_shard(found[order[starts]], bits):
                copies = again[part] + 1
                grams_at = np.repeat(np.arange(part.start, part.stop), copies)
                sizes = np.full(len(grams_at), 255, np.uint8)
                sizes[np.cumsum(copies) - 1] = n[part] - 255 * again[part]
                held = keys_of(found[order[starts[grams_at]]], bits)
                low = starts[part.start]
                rows = places[order[low:low + int(n[part].sum())]].astype(np.uint16)
                piece = packed(np.diff(held, prepend=np.uint64(0)), sizes)
                yield _moved(shard, 1, name, len(piece).to_bytes(8, "little") + piece + packed(rows))

    return docs.mapInArrow(look, MOVED)


def met(moved: DataFrame) -> DataFrame:
    """Lookups with the values of their shard: rows (lot, own, data), sums for each document of a lot; ``own`` marks the lot's documents."""
    def meet(batches):
        shard, pieces, table = None, [], None
        for batch in batches:
            for at, kind, lot, data in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if kind == 2:
                    yield _sums(lot, True, data)
                    continue
                if at != shard:
                    shard, pieces, table = at, [], None
                if kind == 0:
                    steps, value = unpacked(data, np.uint64, np.int32)
                    pieces.append((np.cumsum(steps, dtype=np.uint64), value))
                    continue
                if table is None:
                    table, pieces = _table(pieces), []
                keys, values = table
                if not len(keys):
                    continue
                size = int.from_bytes(data[:8], "little")
                steps, sizes = unpacked(data[8:8 + size], np.uint64, np.uint8)
                rows, = unpacked(data[8 + size:], np.uint16)
                wanted = np.cumsum(steps, dtype=np.uint64)
                place = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
                value = np.where(keys[place] == wanted, values[place], 0).astype(np.int64)
                sums = np.zeros(int(rows.max()) + 1, np.int64)
                np.add.at(sums, rows, np.repeat(value, sizes))
                some = np.flatnonzero(sums)
                yield _sums(lot, False, packed(some.astype(np.uint16), sums[some]))

    ready = moved.repartition("shard").sortWithinPartitions("shard", "kind")
    return ready.mapInArrow(meet, "lot long, own boolean, data binary")


def _table(pieces: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    if not pieces:
        return np.zeros(0, np.uint64), np.zeros(0, np.int32)
    keys, values = (np.concatenate(x) for x in zip(*pieces, strict=True))
    # The pieces are sorted runs, which a stable sort merges. Of grams with one key the least value counts.
    order = np.argsort(keys, kind="stable")
    keys, values = keys[order], values[order]
    starts = np.flatnonzero(np.concatenate([keys[:1] == keys[:1], keys[1:] != keys[:-1]]))
    return keys[starts], np.minimum.reduceat(values, starts) if len(starts) else values


def _sums(lot: int, own: bool, data: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"lot": pa.array([lot], pa.int64()), "own": pa.array([own]), "data": pa.array([data], pa.binary())})


def perplexities(docs: DataFrame, values: DataFrame, common: DataFrame, unknown: float, bits: int, used: tuple[DataFrame, ...] = ()) -> DataFrame:
    """Rows (k1, k2, perplexity), one for each key of ``docs`` (text, k1, k2) whose text has a word; stored. What ``used`` is read from is
    discarded once the values are packed."""
    packs = stored(shard_values(values, bits), "values")
    head = common_values(common, packs, bits)
    discard(*used)

    def add(group: pa.Table) -> pa.Table:
        rows = list(zip(group["own"].to_pylist(), group["data"].to_pylist(), strict=True))
        whole = [data for own, data in rows if own]
        known = dict(zip(("k1", "k2", "sums", "n"), unpacked(whole[0], *[np.int64] * 4), strict=True))
        total = np.zeros(len(known["n"]), np.int64)
        for own, data in rows:
            if not own:
                places, sums = unpacked(data, np.uint16, np.int64)
                total[places] += sums
        # The same documents may be there as several lots, with each part as often.
        total = known["sums"] + total // len(whole)
        predicted = known["n"] + 1
        measure = np.exp(-(total / UNIT + predicted * unknown) / predicted)
        return pa.table({"k1": known["k1"], "k2": known["k2"], "perplexity": measure})

    parts = []
    for wave in range(WAVES):
        some = docs.select("text", "k1", "k2").filter(F.pmod("k1", F.lit(WAVES)) == wave)
        found = met(packs.union(lookups(some, head, bits))).groupBy("lot").applyInArrow(add, "k1 long, k2 long, perplexity double")
        parts.append(stored(found.dropDuplicates(["k1", "k2"]), "perplexities"))
    discard(packs)
    return reduce(DataFrame.union, parts)


def thresholds(scored: DataFrame, quantile: float = QUANTILE) -> DataFrame:
    """Rows (lang, threshold, margin): the quantile of all perplexities of a language, from a histogram.

    A quantile of few texts is uncertain, and mostly too low. The margin is the factor for that: the quantile over the median to the power
    of one over the root of the number of texts; and where all languages together reach further above their medians, a part of that
    difference, which is a half where one text is expected beyond the quantile. It goes to 1 as the texts grow in number.
    """
    steps = scored.filter("perplexity IS NOT NULL").groupBy(
        "lang", F.ceil(F.log("perplexity") / STEP).alias("step")).agg(F.count(F.lit(1)).alias("n"))
    steps = steps.selectExpr("lang", "step", "n", "sum(n) OVER (PARTITION BY lang ORDER BY step) AS upto", "sum(n) OVER (PARTITION BY lang) AS total")

    def at(part: float):
        return F.min(F.when(F.col("upto") >= F.col("total") * part, F.col("step")))

    found = steps.groupBy("lang").agg(at(quantile).alias("high"), at(0.5).alias("middle"), F.first("total").alias("total"))
    # Steps above the median of the own language, all languages together: as many rows as there are steps.
    above = steps.select("lang", "step", "n").alias("s").join(found.alias("f"), F.expr("s.lang <=> f.lang")).groupBy(
        F.expr("step - middle").alias("step")).agg(F.sum("n").alias("n"))
    above = above.selectExpr("step", "sum(n) OVER (ORDER BY step) AS upto", "sum(n) OVER () AS total").agg(at(quantile).alias("wide"))
    doubt = f"greatest(0, wide - (high - middle)) / (1 + total * {1 - quantile!r}) + (high - middle) / sqrt(total)"
    return found.join(F.broadcast(above)).selectExpr("lang", f"exp(high * {STEP}) AS threshold", f"exp(({doubt}) * {STEP}) AS margin")


def perplexity_filter(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE) -> DataFrame:
    """Rows of ``docs`` with perplexity (per word), threshold and kept.

    ``docs`` needs doc_id, text and lang, ``labels`` doc_id and quality. Trusted are all documents with quality 1. Three of four of their texts, by a
    hash of the text, make the model. The others were never seen by it, and the threshold of a language is the quantile of their perplexities with its margin (see ``thresholds``). A language
    without such texts, a null one included, takes the highest threshold of the others; without any of these, everything with a word is kept. Without a model
    there is no perplexity, and everything with a character is kept. Words are letters and digits, ASCII letters in lower case. Null texts and texts without a word have no
    perplexity and are not kept. Texts are taken whole. Repeated rows each come out; columns called perplexity, threshold
    or kept are replaced.
    """
    with shuffles_dropped(docs.sparkSession):
        return _perplexity_filter(docs, labels, quantile)


def _perplexity_filter(docs: DataFrame, labels: DataFrame, quantile: float) -> DataFrame:
    docs, back = set_aside(docs.drop("perplexity", "threshold", "kept"), ["doc_id", "text", "lang"])
    # What a text is known by: twice 64 bits of hash of its row.
    docs = docs.withColumn("k1", F.xxhash64("doc_id", "text")).withColumn("k2", F.xxhash64(F.lit(1), "text", "doc_id"))
    unseen = F.pmod(F.xxhash64(F.lit(2), "text"), F.lit(HELD_OUT)) == 0
    good = labels.filter("quality = 1")
    common, n_words = common_grams(docs)
    bits = max(LEAST_SHARDS - 1, math.ceil(n_words / WORDS_PER_SHARD) - 1).bit_length()
    made = model(rows_with_ids(docs.filter(~unseen).select("doc_id", "text"), good), bits)
    if made is None:
        none = F.lit(None).cast("double")
        held = docs.select("*", none.alias("perplexity"), none.alias("threshold"), (F.coalesce(F.length("text"), F.lit(0)) > 0).alias("kept"))
        return back(held, "perplexity", "threshold", "kept")
    scores = perplexities(docs, made[0], common, made[1], bits, (common, made[0]))
    scored = docs.join(scores, ["k1", "k2"], "left")
    known = rows_with_ids(docs.filter(unseen).select("doc_id", "lang", "k1", "k2"), good).join(scores, ["k1", "k2"])
    by_lang = thresholds(known.select("lang", "perplexity"), quantile)
    by_lang = stored(by_lang.select("lang", (F.col("threshold") * F.col("margin")).alias("threshold")), "thresholds")
    overall = by_lang.agg(F.max("threshold").alias("t")).first().t
    joined = scored.alias("d").join(by_lang.withColumnRenamed("lang", "_lang"), F.col("lang").eqNullSafe(F.col("_lang")), "left")
    limit = F.coalesce("threshold", F.lit(overall).cast("double"))
    kept = F.col("perplexity").isNotNull() & F.coalesce(F.col("perplexity") <= limit, F.lit(True))
    return back(joined.select("d.*", limit.alias("threshold"), kept.alias("kept")), "perplexity", "threshold", "kept")
