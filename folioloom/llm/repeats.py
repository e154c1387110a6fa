"""Substring deduplication by seed and extend: word runs that also stand elsewhere, in any document, are found and removed.

Seeds are winnowed: of every ``length - GRAM + 1`` neighbouring GRAM-word hashes the smallest (the last of equals) is an anchor. A window of ``length``
words holds exactly so many, so two equal windows have the same anchor at the same place: each window belongs to one anchor, and
documents need to be joined on anchors only.

An anchor is extended both ways over the words that any of its windows can cover, its context. Anchors that stand only once in the corpus go first. The
rest meet by (anchor, context): where both are equal, the match extends over all windows of the anchor, and every one of them repeats.
So a group of copies of any size is one entry with a count, never a list of pairs. An anchor whose context is its own may still match others for
a part of it: the windows of such anchors, and of one representative of each larger class, are compared by (anchor, window hash).
Windows that repeat are joined to maximal runs, and the words in them are removed.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioloom.llm.common import WordHashes, binaries, counter_array, mixed, small_batches, stored

LENGTH = 35
GRAM = 12
# Bitmaps that let most rows without a partner stay where they are; joins behind them are exact at any size.
BITMAP_BITS = 24
# A hash in place of the words before the first and after the last.
NO_WORD = np.uint64(0x51ED_270B_0A5F_D1CE)

RANGES = "array<struct<first: long, last: long>>"
SPANS = "array<struct<start: long, end: long>>"
FOUND = f"struct<n_words: long, n_removed: long, spans: {SPANS}, text: string>"


class RunHashes:
    """Hashes of runs of any width from one running sum: the polynomial in an odd base, modulo 2**64, of the words of a run."""

    def __init__(self, base: int) -> None:
        self.base, self.inverse = np.uint64(base), np.uint64(pow(base, -1, 1 << 64))
        self.powers = self.backs = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        while len(self.powers) < n:
            size = len(self.powers)
            self.powers = np.concatenate([self.powers, self.powers * np.uint64(pow(int(self.base), size, 1 << 64))])
            self.backs = np.concatenate([self.backs, self.backs * np.uint64(pow(int(self.inverse), size, 1 << 64))])

    def sums(self, words: np.ndarray) -> np.ndarray:
        self._grow(len(words) + 1)
        return np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * self.powers[:len(words)])])

    def of(self, sums: np.ndarray, starts: np.ndarray | slice, width: int) -> np.ndarray:
        """Hashes of the runs at some places, or at every ``slice(0, n)``."""
        if isinstance(starts, slice):
            ends = slice(starts.start + width, starts.stop + width)
        else:
            ends = starts + width
        return mixed((sums[ends] - sums[starts]) * self.backs[starts])


def _bases() -> tuple[RunHashes, RunHashes, RunHashes]:
    """For anchors, contexts and windows."""
    return RunHashes(0x9E3779B97F4A7C15), RunHashes(0xD6E8FEB86659FD93), RunHashes(0xA0761D6478BD642F)


def anchors(words: np.ndarray, length: int, grams: RunHashes, contexts: RunHashes):
    """Of a text of ``length`` words or more: hash and context of each anchor, and the first and last window that belong to it."""
    gram = min(GRAM, length)
    width, around = length - gram + 1, length - gram
    hashes = grams.of(grams.sums(words), slice(0, len(words) - gram + 1), gram)
    turned = np.lib.stride_tricks.sliding_window_view(hashes, width)[:, ::-1]
    chosen = np.arange(len(turned)) + width - 1 - turned.argmin(axis=1)
    # The last of the smallest hashes never moves back, so windows of one anchor lie together.
    first = np.flatnonzero(np.concatenate([[True], chosen[1:] != chosen[:-1]]))
    last = np.concatenate([first[1:] - 1, [len(chosen) - 1]])
    places = chosen[first]
    edge = np.full(around, NO_WORD, np.uint64)
    padded = contexts.sums(np.concatenate([edge, words, edge]))
    return hashes[places], contexts.of(padded, places, gram + 2 * around), first, last


def _at(values: np.ndarray) -> np.ndarray:
    return (mixed(values.view(np.uint64)) >> np.uint64(64 - BITMAP_BITS)).astype(np.int64)


def _digest_at(digests: list[bytes]) -> np.ndarray:
    return np.array([int.from_bytes(d[:3], "big") for d in digests], np.int64)


def _listed(bits: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)


def _bitmap(df: DataFrame, places):
    """A broadcast bitmap of 2**BITMAP_BITS places that the first column of some rows takes."""
    def found(batch):
        yield places(batch)

    return df.sparkSession.sparkContext.broadcast(np.packbits(counter_array(df, found, BITMAP_BITS) > 0))


def _hash_bitmap(hashes: DataFrame):
    return _bitmap(hashes, lambda batch: _at(batch.column(0).to_numpy()))


def _digest_bitmap(digests: DataFrame):
    return _bitmap(digests, lambda batch: _digest_at(batch.column(0).to_pylist()))


def _fresh(batches):
    """(digest, text) of the texts that this task has not seen."""
    seen = set()
    for batch in batches:
        rows = []
        for digest, text in zip(batch.column(0).to_pylist(), binaries(batch, 1), strict=True):
            if digest not in seen:
                seen.add(digest)
                rows.append((digest, text))
        yield rows


def _lists(arrays: list[np.ndarray], kind) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    values = np.concatenate(arrays).astype(kind) if arrays else np.zeros(0, kind)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def _ranges(arrays: list[np.ndarray]) -> pa.Array:
    """Lists of (first, last) from arrays of two columns."""
    offsets = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    values = np.concatenate(arrays) if arrays else np.zeros((0, 2), np.int64)
    both = pa.StructArray.from_arrays([pa.array(values[:, 0], pa.int64()), pa.array(values[:, 1], pa.int64())], ["first", "last"])
    return pa.ListArray.from_arrays(pa.array(offsets), both)


PROFILE = f"digest binary, anchors array<long>, contexts array<long>, firsts array<int>, lasts array<int>, inner {RANGES}"


def _profiles(texts: DataFrame, length: int) -> DataFrame:
    """One row per distinct text of at least ``length`` words: digest, its anchors, and pid.

    Anchors that share their context inside the text are one entry, of weight 2 (``firsts`` is below 0: -1 - first); the windows of
    the others of them are ``inner``.
    """
    def describe(batches):
        hashes, (grams, contexts, _) = WordHashes(), _bases()
        for rows in _fresh(batches):
            digests, columns, inner = [], ([], [], [], []), []
            for digest, text in rows:
                words = text.split()
                if len(words) < length:
                    continue
                anchor, context, first, last = anchors(hashes.of(words), length, grams, contexts)
                again = np.zeros((0, 2), np.int64)
                _, one, counts = np.unique(context, return_index=True, return_counts=True)
                if len(one) < len(context):
                    more = np.ones(len(context), bool)
                    more[one] = False
                    again = np.stack([first[more], last[more]], axis=1)
                    anchor, context, last = anchor[one], context[one], last[one]
                    first = np.where(counts > 1, -1 - first[one], first[one])
                digests.append(digest)
                inner.append(again)
                for column, values in zip(columns, (anchor.view(np.int64), context.view(np.int64), first, last), strict=True):
                    column.append(values)
            yield pa.RecordBatch.from_arrays([
                pa.array(digests, pa.binary()), *[_lists(c, k) for c, k in zip(columns, (np.int64, np.int64, np.int32, np.int32), strict=True)], _ranges(inner),
            ], ["digest", "anchors", "contexts", "firsts", "lasts", "inner"])

    found = texts.mapInArrow(describe, PROFILE).dropDuplicates(["digest"])
    return stored(found.withColumn("pid", F.monotonically_increasing_id()), "anchors", "zstd")


def _seeds(profiles: DataFrame) -> DataFrame:
    """Anchors that stand more than once, as rows (anchor, context, pid, first, last, weight); a few others may be among them."""
    hashes = profiles.select(F.explode(F.arrays_zip("anchors", "firsts")).alias("a"))
    hashes = hashes.groupBy(F.col("a.anchors").alias("anchor")).agg(F.sum(F.when(F.col("a.firsts") < 0, 2).otherwise(1)).alias("n"))
    bitmap = _hash_bitmap(hashes.filter("n > 1").select("anchor"))

    def kept(batches):
        for batch in batches:
            pids = np.repeat(batch.column(0).to_numpy(), batch.column(1).value_lengths().to_numpy())
            anchor, context, first, last = (batch.column(i).flatten().to_numpy() for i in range(1, 5))
            at = np.flatnonzero(_listed(bitmap.value, _at(anchor)))
            first = first[at].astype(np.int64)
            weight = np.where(first < 0, 2, 1)
            yield pa.RecordBatch.from_pydict({
                "anchor": pa.array(anchor[at]), "context": pa.array(context[at]), "pid": pa.array(pids[at]),
                "first": pa.array(np.where(first < 0, -1 - first, first)), "last": pa.array(last[at].astype(np.int64)), "weight": pa.array(weight, pa.int64())})

    return profiles.select("pid", "anchors", "contexts", "firsts", "lasts").mapInArrow(
        kept, "anchor long, context long, pid long, first long, last long, weight long")


def _chosen(texts: DataFrame, bitmap) -> DataFrame:
    """Rows (digest, text) of the texts whose digest a bitmap knows, each once; only these are moved."""
    def chosen(batches):
        for rows in _fresh(batches):
            listed = _listed(bitmap.value, _digest_at([d for d, _ in rows])) if rows else []
            rows = [r for r, known in zip(rows, listed, strict=True) if known]
            yield pa.RecordBatch.from_arrays([pa.array([d for d, _ in rows], pa.binary()), pa.array([t for _, t in rows], pa.binary())], ["digest", "text"])

    # Each task hands on a text once; those that several tasks hold meet here.
    return texts.mapInArrow(chosen, "digest binary, text binary").dropDuplicates(["digest"])


def _spread(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All whole numbers of some ranges, and the number of the range of each."""
    counts = last - first + 1
    of = np.repeat(np.arange(len(first)), counts)
    return np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts) + first[of], of


def _windows(moved: DataFrame, length: int) -> DataFrame:
    """Rows (anchor, window, pid, start, weight) of the windows of the marked anchors that are compared one by one."""
    def compare(batches):
        hashes, (_, _, runs) = WordHashes(), _bases()
        for batch in batches:
            marks = batch.column("marks")
            each = marks.flatten()
            bounds = np.concatenate([[0], np.cumsum(marks.value_lengths().to_numpy())])
            anchor, first, last, whole = (each.field(f).to_numpy(zero_copy_only=False) for f in ("anchor", "first", "last", "whole"))
            compared = each.field("compared").to_numpy(zero_copy_only=False)
            out: list[list[np.ndarray]] = [[np.zeros(0, np.int64)] for _ in range(5)]
            for i, (pid, text) in enumerate(zip(batch.column("pid").to_pylist(), binaries(batch, 1), strict=True)):
                own = np.arange(bounds[i], bounds[i + 1])
                own = own[compared[own]]
                starts, of = _spread(first[own], last[own])
                found = runs.of(runs.sums(hashes.of(text.split())), starts, length)
                for column, values in zip(out, (anchor[own][of], found.view(np.int64), np.full(len(starts), pid), starts, 1 + whole[own][of]), strict=True):
                    column.append(values)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), pa.int64()) for c in out], ["anchor", "window", "pid", "start", "weight"])

    return moved.select("pid", "text", "marks").mapInArrow(compare, "anchor long, window long, pid long, start long, weight long")


def removed_words(n: int, first: np.ndarray, last: np.ndarray, length: int) -> np.ndarray:
    """Which of n words the windows from each ``first`` to its ``last`` cover."""
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, first, 1)
    np.add.at(steps, last + length, -1)
    return np.cumsum(steps[:n]) > 0


def _results(moved: DataFrame, length: int) -> DataFrame:
    """Rows (digest, found): what is removed from each text and what stays. A text with copies repeats as a whole."""
    def cut(batches):
        kinds = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            counts, gone, spans, texts = [], [], [], []
            columns = [binaries(batch, 1), *[batch.column(c).to_pylist() for c in ("ranges", "starts", "copied")]]
            for text, ranges, starts, copied in zip(*columns, strict=True):
                words = text.split()
                whole = [(0, len(words) - length)] if copied and len(words) >= length else [(r["first"], r["last"]) for r in ranges or []]
                at = np.array([*whole, *[(s, s) for s in starts or []]], np.int64).reshape(-1, 2)
                removed = removed_words(len(words), at[:, 0], at[:, 1], length)
                edges = np.flatnonzero(np.diff(np.concatenate([[False], removed, [False]]).astype(np.int8)))
                counts.append(len(words))
                gone.append(int(removed.sum()))
                spans.append([{"start": a, "end": b} for a, b in edges.reshape(-1, 2).tolist()])
                texts.append(b" ".join([w for w, r in zip(words, removed.tolist(), strict=True) if not r]).decode())
            found = pa.StructArray.from_arrays(
                [pa.array(counts, pa.int64()), pa.array(gone, pa.int64()), pa.array(spans, kinds), pa.array(texts, pa.string())],
                ["n_words", "n_removed", "spans", "text"])
            yield pa.RecordBatch.from_arrays([batch.column("digest"), found], ["digest", "found"])

    return moved.select("digest", "text", "ranges", "starts", "copied").mapInArrow(cut, f"digest binary, found {FOUND}")


def without_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, spans and text, without the words that repeated windows cover.

    ``docs`` needs doc_id and text; other columns are ignored. Words are cut at ASCII white space and not changed. A window is ``length``
    neighbouring words of one document; a word goes if one of its windows also starts anywhere else, in this document or another, all windows
    being judged on the input. spans are the removed runs of words (start and end, the end exclusive), which are the maximal repeats; text is the rest, joined by
    one space. Texts with fewer words than a window stay whole. Null, empty and wordless texts have no word and an empty text.
    Equal texts are copies of each other, whether their ids are equal, null or not, so repeated rows lose all their windows. Texts are taken whole
    whatever their length; an empty table has no rows.
    """
    small_batches(docs.sparkSession)
    rows = docs.select("doc_id", F.unhex(F.md5("text")).alias("digest"), "text")
    texts = rows.filter("text IS NOT NULL").select("digest", "text")
    profiles = _profiles(texts, length)
    copied = rows.filter("digest IS NOT NULL").groupBy("digest").agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1").select("digest")

    seeds = _seeds(profiles)
    classes = seeds.groupBy("anchor", "context").agg(F.sum("weight").alias("n"), F.min("pid").alias("one")).filter("n > 1")
    # Written, so that the join behind it can split a class that very many texts hold.
    classes = stored(classes.select("anchor", "context", "one"), "classes", "zstd")
    whole = F.col("one").isNotNull()
    mark = F.struct("anchor", "first", "last", whole.alias("whole"), (~whole | (F.col("one") == F.col("pid"))).alias("compared"))
    marks = seeds.join(classes, ["anchor", "context"], "left").select("pid", mark.alias("mark")).groupBy("pid").agg(F.collect_list("mark").alias("marks"))
    marks = stored(marks.join(profiles.select("pid", "digest", "inner"), "pid"), "marks", "zstd")

    singly = marks.filter(F.exists("marks", lambda m: m["compared"])).select("digest", "pid", "marks")
    moved = _chosen(texts, _digest_bitmap(singly.select("digest"))).join(singly, "digest")
    windows = stored(_windows(moved, length), "windows", "zstd")
    repeated = windows.groupBy("anchor", "window").agg(F.sum("weight").alias("n")).filter("n > 1").select("anchor", "window")
    starts = windows.filter("weight = 1").join(stored(repeated, "repeated", "zstd"), ["anchor", "window"])
    starts = starts.groupBy("pid").agg(F.collect_list("start").alias("starts"))

    ranges = F.concat("inner", F.transform(F.filter("marks", lambda m: m["whole"]), lambda m: F.struct(m["first"], m["last"])))
    touched = marks.select("digest", "pid", ranges.alias("ranges")).join(starts, "pid", "left").filter("size(ranges) > 0 OR starts IS NOT NULL")
    touched = stored(touched.select("digest", "ranges", "starts"), "repeats", "zstd")
    bitmap = _digest_bitmap(touched.select("digest").union(copied))
    moved = _chosen(texts, bitmap).join(touched, "digest", "left").join(copied.withColumn("copied", F.lit(True)), "digest", "left")
    found = stored(_results(moved, length), "results", "zstd")

    @F.arrow_udf("boolean")
    def listed(digests: pa.Array) -> pa.Array:
        keys = digests.to_pylist()
        return pa.array(_listed(bitmap.value, _digest_at([k or bytes(3) for k in keys])) & np.array([k is not None for k in keys], bool))

    # Texts that the bitmap does not know stay whole and are finished where they lie; all others meet their result by digest.
    rows = rows.withColumn("listed", listed("digest"))
    words = F.filter(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    own = F.struct(F.size(words).cast("long").alias("n_words"), F.lit(0).cast("long").alias("n_removed"),
                   F.array().cast(SPANS).alias("spans"), F.array_join(words, " ").alias("text"))
    alone = rows.filter("NOT listed").select("doc_id", own.alias("found"))
    met = rows.filter("listed").select("doc_id", "digest").join(found, "digest").select("doc_id", "found")
    return alone.union(met).select("doc_id", "found.*")
