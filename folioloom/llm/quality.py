"""Quality rules: plain text statistics, and a hashed n-gram log-likelihood ratio of trusted to raw text.

Two multinomials over hashed word 1- and 2-grams are counted, one from the trusted texts and one from all. A
document's score is the mean over its n-grams of log(p_trusted / p_raw). A language's threshold is a low quantile of
the scores its trusted texts would have if they were not trusted themselves: each with its own n-grams taken out of the trusted counts.
Counts and thresholds are the same for all documents, so equal texts of a language always get the same verdict.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioloom.llm.common import CONTINUATION, WHITE, WordHashes, binaries, counter_array, mixed, rows_with_ids, set_aside, shingle_hashes, stored

# Fixed values of the base rules: the symbols that are counted, and the two limits.
SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 10
MAX_REPEATED_PERCENT = 20
WINDOW = 5

BITS = 20
# Added to every count, so an n-gram's ratio follows from how often it was seen and not from the size of the corpus.
ALPHA = 0.1
# The part of a language's clean documents that may go.
QUANTILE = 0.01
# Scores are compared in steps of this size.
STEP = 0.005

METRICS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def _ngrams(hashes: np.ndarray) -> np.ndarray:
    """Buckets of the single words and of the pairs of neighbours."""
    both = [mixed(hashes)]
    if len(hashes) > 1:
        both.append(shingle_hashes(hashes, 2))
    return (np.concatenate(both) >> np.uint64(64 - BITS)).astype(np.int64)


def _repeated(hashes: np.ndarray) -> int:
    """Words inside windows of five that occur twice or more."""
    if len(hashes) <= WINDOW:
        return 0
    windows = shingle_hashes(hashes, WINDOW)
    order = np.argsort(windows, kind="stable")
    same = windows[order][1:] == windows[order][:-1]
    if not same.any():
        return 0
    twice = np.zeros(len(windows) + WINDOW, np.int64)
    starts = np.zeros(len(windows), bool)
    starts[order[1:][same]] = True
    starts[order[:-1][same]] = True
    at = np.flatnonzero(starts)
    twice[at] += 1
    twice[at + WINDOW] -= 1
    return int((np.cumsum(twice) > 0).sum())


def _dup_lines(text: bytes) -> int:
    lines = [line for line in text.split(b"\n") if line and not line.isspace()]
    return len(lines) - len(set(lines))


@dataclass
class Counts:
    """How often each of 2**BITS buckets occurs in the trusted and in all texts."""

    trusted: np.ndarray
    raw: np.ndarray

    def __post_init__(self):
        # Buckets that occur: those never seen take no part of the probability.
        self.kinds = np.count_nonzero(self.raw)

    def logs(self, counts: np.ndarray, total: float) -> np.ndarray:
        return np.log((counts + ALPHA) / (total + ALPHA * self.kinds))

    def ratios(self) -> np.ndarray:
        """log(p_trusted / p_raw) per bucket; 0 without any trusted text."""
        if not self.trusted.any():
            return np.zeros(len(self.raw), np.float32)
        return (self.logs(self.trusted, self.trusted.sum()) - self.logs(self.raw, self.raw.sum())).astype(np.float32)

    def without(self, found: np.ndarray, total: float, raw_total: float) -> float:
        """Mean log ratio of a trusted text's buckets when it is not counted as trusted."""
        at, counts = np.unique(found, return_counts=True)
        ratios = self.logs(np.maximum(self.trusted[at] - counts, 0), max(total - len(found), 0)) - self.logs(self.raw[at], raw_total)
        return float(np.dot(ratios, counts) / len(found))


def ngram_counts(docs: DataFrame, trusted: DataFrame) -> Counts:
    """Counts of fixed size, whatever the input."""
    def buckets(batch):
        hashes = WordHashes()
        for text in binaries(batch):
            if text:
                words = text.split()
                if words:
                    yield _ngrams(hashes.of(words))

    raw = counter_array(docs.select("text"), buckets, BITS, exact=True).astype(np.float64)
    return Counts(counter_array(trusted.select("text"), buckets, BITS, exact=True).astype(np.float64), raw)


def thresholds(trusted: DataFrame, counts: Counts, quantile: float = QUANTILE) -> DataFrame:
    """Rows (lang, threshold): the quantile of the scores of a language's trusted texts, each scored without itself.

    A quantile of few texts is uncertain: it is lowered by its distance from the median over the root of their number, which vanishes as
    they grow in number. Texts that fail the base rules say nothing about clean ones and do not count.
    """
    shared = trusted.sparkSession.sparkContext.broadcast(counts)

    @F.arrow_udf("double")
    def score(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        hashes, held = WordHashes(), shared.value
        total, raw_total = held.trusted.sum(), held.raw.sum()
        for part in parts:
            out = []
            for value in part.cast(pa.binary()).to_pylist():
                found = hashes.of((value or b"").split())
                failed = len(found) < MIN_WORDS or 100 * _repeated(found) > MAX_REPEATED_PERCENT * len(found)
                out.append(None if failed else held.without(_ngrams(found), total, raw_total))
            yield pa.array(out, pa.float64())

    steps = trusted.select("lang", F.floor(score("text") / STEP).alias("step")).filter("step IS NOT NULL").groupBy("lang", "step").agg(
        F.count(F.lit(1)).alias("n"))
    steps = steps.selectExpr(
        "lang", "step", "sum(n) OVER (PARTITION BY lang ORDER BY step) AS upto", "sum(n) OVER (PARTITION BY lang) AS total")
    def at(part: float) -> Column:
        return F.min(F.when(F.col("upto") >= F.col("total") * part, F.col("step"))) * STEP

    found = steps.groupBy("lang").agg(at(quantile).alias("low"), at(0.5).alias("middle"), F.first("total").alias("total"))
    found = found.selectExpr("lang", "low - (middle - low) / sqrt(total) AS threshold")
    found = stored(found, "thresholds")
    shared.destroy()
    return found


def measured(docs: DataFrame, table: np.ndarray, text: str | Column = "text", threshold: Column | None = None) -> DataFrame:
    """All columns of ``docs`` but ``_threshold`` and ``quality``: a struct of the base metrics, llr, base_failed and kept."""
    shared = docs.sparkSession.sparkContext.broadcast(table)

    @F.arrow_udf(METRICS + ", llr double")
    def measure(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        hashes = WordHashes()
        for part in parts:
            out = []
            for value in part.cast(pa.binary()).to_pylist():
                value = value or b""
                words = value.split()
                found = hashes.of(words)
                llr = float(np.mean(shared.value[_ngrams(found)], dtype=np.float64)) if words else 0.0
                out.append((
                    len(words), len(value.translate(None, CONTINUATION + WHITE)), len(value) - len(value.translate(None, SYMBOLS)),
                    _dup_lines(value), _repeated(found), llr))
            columns = list(zip(*out, strict=True)) if out else [[]] * 6
            yield pa.StructArray.from_arrays(
                [pa.array(c, pa.int64()) for c in columns[:5]] + [pa.array(columns[5], pa.float64())],
                ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "llr"])

    failed = f"m.n_words < {MIN_WORDS} OR 100 * m.n_repeat_words > {MAX_REPEATED_PERCENT} * m.n_words"
    kept = [c for c in docs.columns if c != "_threshold"]
    limit = F.lit(None).cast("double") if threshold is None else threshold
    measures = docs.withColumn("_limit", limit).withColumn("quality", measure(F.col(text) if isinstance(text, str) else text))
    return measures.select(*[F.col(f"`{c}`") for c in kept], F.expr(
        f"transform(array(quality), m -> named_struct('n_words', m.n_words, 'word_chars', m.word_chars, 'n_symbols', m.n_symbols, "
        f"'n_dup_lines', m.n_dup_lines, 'n_repeat_words', m.n_repeat_words, 'llr', m.llr, 'base_failed', ({failed}), "
        f"'kept', NOT ({failed}) AND m.llr >= coalesce(_limit, m.llr)))[0]").alias("quality"))


def trusted_texts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents whose label says quality 1: all of them. Their lang is null where ``docs`` has none."""
    lang = F.col("lang") if "lang" in docs.columns else F.lit(None).cast("string").alias("lang")
    return rows_with_ids(docs.select("doc_id", "text", lang), labels.filter("quality = 1"))


def quality_rules(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE) -> DataFrame:
    """All rows and columns of ``docs`` and a struct ``quality`` (see ``measured``).

    ``docs`` needs doc_id and text, ``labels`` doc_id and quality; without a column lang in ``docs`` all are of one language. Words are runs
    of anything but ASCII white space. A null or empty text has no words: its metrics are 0, its ratio 0, and it fails the base rules. Rows of
    ``labels`` without id or quality do not count; a document trusted by any of its label rows is trusted once. A language without
    trusted texts, a null one included, takes the lowest threshold of the others. Without any trusted text
    the ratio is 0 for all, so the base rules decide alone. Texts are taken whole. Repeated rows are counted and come out as often as
    they are there. A column called ``quality`` in ``docs`` is replaced.
    """
    docs, back = set_aside(docs.drop("quality"), ["doc_id", "text", "lang"])
    trusted = trusted_texts(docs, labels)
    counts = ngram_counts(docs, trusted)
    by_lang = thresholds(trusted, counts, quantile)
    lowest = F.lit(by_lang.agg(F.min("threshold").alias("t")).first().t).cast("double")
    if "lang" not in docs.columns:
        return back(measured(docs, counts.ratios(), threshold=lowest), "quality")
    by_lang = by_lang.select(F.col("lang").alias("_lang"), F.col("threshold").alias("_threshold"))
    held = docs.alias("d").join(F.broadcast(by_lang), F.col("d.lang").eqNullSafe(F.col("_lang")), "left").select("d.*", "_threshold")
    return back(measured(held, counts.ratios(), threshold=F.coalesce("_threshold", lowest)), "quality")
