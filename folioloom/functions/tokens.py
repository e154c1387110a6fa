"""Tokenizers and token windows.

A tokenizer has ``encode(column) -> array<int>`` and ``cut(df, text, window, overlap)``,
which turns each row into its overlapping windows. ``WordTokenizer`` is plain column
expressions; ``ModelTokenizer`` runs a sub-word model over Arrow batches.
"""

from __future__ import annotations

from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Reserved ids and the width of a hashed word id in hex digits.
PAD_ID = 0
BOS_ID = 1
EOS_ID = 2
FIRST_WORD_ID = 4
WORD_ID_HEX_DIGITS = 7

WORD_PATTERN = r"([^ \t\n\r]+)"


def check_window(window: int, overlap: int) -> None:
    if window <= 0:
        raise ValueError(f"window is {window}, it has to be positive")
    if not 0 <= overlap < window:
        raise ValueError(f"overlap is {overlap}, it has to lie in [0, {window})")


def token_windows(n_tokens: Column, window: int, overlap: int) -> Column:
    """array<struct<seq, start_token, end_token>> covering ``n_tokens`` tokens.

    The count is closed form: one window, plus one per started stride beyond it. No
    tokens still give the one span (0, 0).
    """
    check_window(window, overlap)
    stride = window - overlap
    extra = F.ceil((n_tokens - window) / F.lit(stride)).cast("int")
    return F.transform(
        F.sequence(F.lit(0), F.greatest(F.lit(0), extra)),
        lambda i: F.struct(
            i.alias("seq"),
            (i * stride).alias("start_token"),
            F.least(n_tokens, i * stride + window).alias("end_token"),
        ),
    )


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD_PATTERN), F.lit(1))


def word_id(word: Column) -> Column:
    digits = F.substring(F.sha2(word, 256), 1, WORD_ID_HEX_DIGITS)
    return (F.conv(digits, 16, 10).cast("int") + FIRST_WORD_ID).cast("int")


def word_ids(found: pa.Array) -> np.ndarray:
    """``word_id`` of an array of words, inside a task."""
    digests = (sha256(w.encode()).hexdigest() for w in found.to_pylist())
    return np.array([int(d[:WORD_ID_HEX_DIGITS], 16) + FIRST_WORD_ID for d in digests], dtype=np.int64)


def truncate(ids: Column, max_length: int, specials: bool = True) -> Column:
    """First ``max_length`` ids. With specials the closing id stays last, as models expect."""
    if not specials:
        return F.slice(ids, 1, max_length)
    cut = F.concat(F.slice(ids, 1, max_length - 1), F.slice(ids, -1, 1))
    return F.when(F.size(ids) > max_length, cut).otherwise(ids)


def pad(ids: Column, max_length: int, pad_id: int = PAD_ID) -> Column:
    return F.concat(ids, F.array_repeat(F.lit(pad_id), F.greatest(F.lit(0), F.lit(max_length) - F.size(ids))))


def attention_mask(ids: Column, max_length: int) -> Column:
    """1 per real token of the unpadded ``ids``, then 0 up to ``max_length``."""
    missing = F.greatest(F.lit(0), F.lit(max_length) - F.size(ids))
    return F.concat(F.array_repeat(F.lit(1), F.size(ids)), F.array_repeat(F.lit(0), missing))


@dataclass(frozen=True)
class WordTokenizer:
    """Blank-separated words with hashed ids, framed by an opening and a closing id."""

    specials: bool = True

    @property
    def frame(self) -> int:
        return 1 if self.specials else 0

    def _framed(self, ids: Column) -> Column:
        if not self.specials:
            return ids
        return F.concat(F.array(F.lit(BOS_ID)), ids, F.array(F.lit(EOS_ID)))

    def encode(self, text: Column, max_length: int | None = None) -> Column:
        """Ids of a text; beyond ``max_length`` words are left out, the closing id is not."""
        found = words(text)
        if max_length is not None:
            found = F.slice(found, 1, max_length - 2 * self.frame)
        return self._framed(F.transform(found, word_id))

    merges_on = "text"

    def units(self, text: Column) -> Column:
        """What merging works on: the words themselves, since a hashed id has no way back."""
        return words(text)

    def join(self, units: Column) -> Column:
        return F.array_join(units, " ")

    def cut(self, df: DataFrame, text: str, window: int, overlap: int, tokens: bool = True) -> DataFrame:
        """One row per window, with seq, start_token, end_token, text and, unless left out, tokens.

        Words and ids are worked out once per document, below the generator. A window of
        words encodes to the slice of the document's ids, so nothing is hashed twice.
        """
        keep = [c for c in df.columns if c != text]
        read = df.select(*keep, words(F.col(text)).alias("_words"))
        if tokens:
            read = read.withColumn("_ids", F.transform("_words", word_id))
        spans = token_windows(F.size("_words") + 2 * self.frame, window, overlap)

        def window_row(span: Column) -> Column:
            first = F.greatest(span["start_token"] - self.frame, F.lit(0))
            last = F.least(span["end_token"] - self.frame, F.size("_words"))
            length = F.greatest(last - first, F.lit(0))
            ids = [self._framed(F.slice("_ids", first + 1, length)).alias("tokens")] if tokens else []
            return F.struct(
                span["seq"].alias("seq"),
                span["start_token"].alias("start_token"),
                span["end_token"].alias("end_token"),
                self.join(F.slice("_words", first + 1, length)).alias("text"),
                *ids,
            )

        return read.select(*keep, F.inline(F.transform(spans, window_row)))


@dataclass(frozen=True)
class ModelTokenizer:
    """A sub-word tokenizer given as the text of its ``tokenizer.json``.

    The text travels with the function, so no executor needs the file; each Python worker
    builds the tokenizer once and keeps it.
    """

    definition: str

    @classmethod
    def from_file(cls, path: str) -> ModelTokenizer:
        with open(path, encoding="utf-8") as handle:
            return cls(handle.read())

    def encode(self, text: Column, max_length: int | None = None) -> Column:
        definition = self.definition

        def run(texts: pa.Array) -> pa.Array:
            batch = _tokenizer(definition, max_length).encode_batch([t or "" for t in texts.to_pylist()])
            return pa.array([e.ids for e in batch], pa.list_(pa.int32()))

        return F.arrow_udf(run, "array<int>")(text)

    def decode(self, ids: Column) -> Column:
        definition = self.definition

        def run(rows: pa.Array) -> pa.Array:
            return pa.array(_tokenizer(definition).decode_batch(rows.to_pylist(), skip_special_tokens=True), pa.string())

        return F.arrow_udf(run, "string")(ids)

    merges_on = "tokens"

    def units(self, tokens: Column) -> Column:
        return F.slice(tokens, 2, F.greatest(F.size(tokens) - 2, F.lit(0)))

    def join(self, units: Column) -> Column:
        return self.decode(units)

    def cut(self, df: DataFrame, text: str, window: int, overlap: int, tokens: bool = True) -> DataFrame:
        keep = [c for c in df.columns if c != text]
        read = df.select(*keep, self.encode(F.col(text)).alias("_ids"))
        spans = token_windows(F.size("_ids"), window, overlap)
        rows = F.transform(spans, lambda s: F.struct(
            s["seq"].alias("seq"), s["start_token"].alias("start_token"), s["end_token"].alias("end_token"),
            F.slice("_ids", s["start_token"] + 1, s["end_token"] - s["start_token"]).alias("_span"),
        ))
        spread = read.select(*keep, F.inline(rows)).withColumn("text", self.decode(F.col("_span")))
        if tokens:
            spread = spread.withColumn("tokens", self.encode(F.col("text")))
        return spread.drop("_span")


_LOADED: dict[tuple[str, int | None], object] = {}


def _tokenizer(definition: str, max_length: int | None = None):
    """The tokenizer of this worker process, built on first use."""
    key = (definition, max_length)
    if key not in _LOADED:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_str(definition)
        tokenizer.no_padding()
        if max_length is None:
            tokenizer.no_truncation()
        else:
            tokenizer.enable_truncation(max_length)
        _LOADED[key] = tokenizer
    return _LOADED[key]
