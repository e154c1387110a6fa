"""Benchmark decontamination by spaced seeds.

A mask picks some of a few neighbouring words and ignores the others, so a window keeps its hash when
ignored words are replaced. Hashes of all windows of a text are looked up among those of the
benchmark; around each hit the two texts are laid side by side. Any stretch there with enough equal
words and few enough replaced ones decides, whatever surrounds it; the one with most equal words is told.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioloom.llm.common import LETTERS, WEIGHTS, WordHashes, mixed, set_aside

# Fixed masks: 1 is a word that counts, 0 one that is ignored. Every stretch that counts (see MIN_EQUAL) holds a shorter one of
# at most 20 words that counts too, and each of those is met by one of these masks whatever words of it are replaced.
MASKS = ["1110111", "11100001011", "110110011"]
SPAN = 10
# Items of fewer words than the span are looked for as a whole; below this they say nothing.
MIN_ITEM_WORDS = 6
# A stretch counts with so many equal words (or the whole of a shorter item) and at most one in five replaced.
MIN_EQUAL = 10
MIN_SHARE = 0.8
# A replaced word against an equal one: sums of zero and more are exactly the stretches with MIN_SHARE equal words.
MISMATCH = round(MIN_SHARE / (1 - MIN_SHARE))
# Benchmark words held by a worker at a time; larger benchmarks are gone through in blocks.
BLOCK_WORDS = 2_000_000

HITS = "array<struct<item: long, start: int, end: int, equal: int>>"


def _seed_hashes(words: np.ndarray, mask: str, number: int) -> np.ndarray:
    count = len(words) - len(mask) + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    total = np.full(count, WEIGHTS[40 + number % 16], np.uint64)
    for i, bit in enumerate(mask):
        if bit == "1":
            total += words[i:i + count] * WEIGHTS[i]
    return mixed(total)


def _words(text: bytes | None, hashes: WordHashes) -> np.ndarray:
    return hashes.of(text.translate(LETTERS).split() if text else [])


class Seeds:
    """All windows of a block of benchmark items, ordered by hash."""

    def __init__(self, items: list[tuple[int, bytes]]):
        hashes = WordHashes()
        self.items = [(key, _words(text, hashes)) for key, text in items]
        lengths = {len(w) for _, w in self.items if MIN_ITEM_WORDS <= len(w) < SPAN}
        self.masks = [(m, i) for i, m in enumerate(MASKS)] + [("1" * n, len(MASKS) + n) for n in sorted(lengths)]
        keys, item, place = [], [], []
        for mask, number in self.masks:
            whole = number >= len(MASKS)
            for at, (_, words) in enumerate(self.items):
                if whole and len(words) != len(mask):
                    continue
                found = _seed_hashes(words, mask, number)
                keys.append(found)
                item.append(np.full(len(found), at, np.int64))
                place.append(np.arange(len(found), dtype=np.int64))
        keys = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
        order = np.argsort(keys, kind="stable")
        self.keys = keys[order]
        self.item = np.concatenate(item)[order] if item else np.zeros(0, np.int64)
        self.place = np.concatenate(place)[order] if place else np.zeros(0, np.int64)
        bits = np.zeros(1 << 24, bool)
        bits[(self.keys >> np.uint64(40)).astype(np.int64)] = True
        self.bits = np.packbits(bits)

    def find(self, words: np.ndarray) -> list[tuple[int, int, int, int]]:
        """(item, first word, end word, equal words) of the stretch with most equal words per item."""
        lines: set[tuple[int, int]] = set()
        for mask, number in self.masks:
            found = _seed_hashes(words, mask, number)
            slot = (found >> np.uint64(40)).astype(np.int64)
            at = np.flatnonzero(self.bits[slot >> 3] >> (7 - (slot & 7)).astype(np.uint8) & 1)
            if not len(at):
                continue
            low, high = np.searchsorted(self.keys, found[at], "left"), np.searchsorted(self.keys, found[at], "right")
            for position, a, b in zip(at.tolist(), low.tolist(), high.tolist(), strict=True):
                for k in range(a, b):
                    lines.add((int(self.item[k]), position - int(self.place[k])))
        best: dict[int, tuple[int, int, int]] = {}
        for item, shift in sorted(lines):
            key, wanted = self.items[item]
            stretch = agreement(wanted, words, shift)
            if stretch and stretch[2] > best.get(key, (0, 0, 0))[2]:
                best[key] = stretch
        return [(key, *stretch) for key, stretch in sorted(best.items())]


def agreement(item: np.ndarray, words: np.ndarray, shift: int) -> tuple[int, int, int] | None:
    """The stretch with most equal words that is enough, of item against words at a shift: (start, end, equal) in words of the text.

    Of several the first. It starts and ends with an equal word.
    """
    first, last = max(0, -shift), min(len(item), len(words) - shift)
    if last <= first:
        return None
    equal = item[first:last] == words[first + shift:last + shift]
    if np.count_nonzero(equal) < min(MIN_EQUAL, len(item)):
        return None
    sums = np.concatenate([[0], np.cumsum(np.where(equal, 1, -MISMATCH))])
    counts = np.concatenate([[0], np.cumsum(equal)])
    # The earliest start for each end: the first sum that is not above the one at the end.
    starts = np.searchsorted(-np.minimum.accumulate(sums), -sums, "left")
    held = counts - counts[starts]
    end = int(np.argmax(held))
    count = int(held[end])
    if count < min(MIN_EQUAL, len(item)):
        return None
    at = np.flatnonzero(equal[starts[end]:end]) + int(starts[end])
    return first + shift + int(at[0]), first + shift + int(at[-1]) + 1, count


def benchmark_blocks(benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> Iterator[Seeds]:
    """Distinct benchmark texts with their smallest item_id, in blocks of about ``block_words`` words."""
    items = benchmark.filter("text IS NOT NULL").groupBy("text").agg(F.min("item_id").alias("item_id"))
    items = items.filter("item_id IS NOT NULL")
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = 1 + size // (4 * block_words)
    for block in range(blocks):
        part = items.filter(F.pmod(F.xxhash64("text"), F.lit(blocks)) == block).select("item_id", "text").toArrow()
        yield Seeds([(k, t.encode()) for k, t in zip(part["item_id"].to_pylist(), part["text"].to_pylist(), strict=True)])


def with_leaks(docs: DataFrame, seeds: Seeds) -> DataFrame:
    """All columns of ``docs`` and ``leaks``: per benchmark item of a block the stretch found, in words of the text."""
    shared = docs.sparkSession.sparkContext.broadcast(seeds)

    @F.arrow_udf(HITS)
    def find(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        hashes = WordHashes()
        kind = pa.list_(pa.struct([("item", pa.int64()), ("start", pa.int32()), ("end", pa.int32()), ("equal", pa.int32())]))
        for part in parts:
            rows = [[dict(zip(("item", "start", "end", "equal"), hit, strict=True)) for hit in shared.value.find(_words(x, hashes))]
                    for x in part.cast(pa.binary()).to_pylist()]
            yield pa.array(rows, kind)

    return docs.withColumn("leaks", find("text"))


def benchmark_leaks(docs: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Pairs of a document and a benchmark item it contains: doc_id, item_id, start_word, end_word, n_equal.

    ``docs`` needs doc_id and text, ``benchmark`` item_id and text. Words are letters and digits in lower case, so punctuation and case do
    not matter. Items of under six words match nothing; those of six to nine only as a whole; longer ones by
    stretches of ten equal words or more (the one with most equal words per item), of which at most one word in five is replaced. Equal items count as the one with
    the smallest id, and items without id or text are left out. Null and empty texts leak nothing; texts of any length are taken
    whole. Repeated rows each come out, also those with a null doc_id. An empty benchmark gives an empty result.
    """
    parts = [with_leaks(docs.select("doc_id", "text"), seeds) for seeds in benchmark_blocks(benchmark, block_words)]
    out = None
    for part in parts:
        rows = part.select("doc_id", F.explode("leaks").alias("leak")).selectExpr(
            "doc_id", "leak.item AS item_id", "leak.start AS start_word", "leak.end AS end_word", "leak.equal AS n_equal")
        out = rows if out is None else out.union(rows)
    return out


def without_leaks(docs: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The rows and columns of ``docs`` that share no passage with the benchmark, by the law of ``benchmark_leaks``.

    Null and empty texts stay, repeated rows stay or go together, an empty benchmark leaves everything as it is and an empty table has no rows.
    """
    held, back = set_aside(docs, ["text"])
    for seeds in benchmark_blocks(benchmark, block_words):
        held = with_leaks(held, seeds).filter(F.size("leaks") == 0).drop("leaks")
    return back(held)
