"""Fill-in-middle: texts cut into prefix, middle and suffix, and written in an order in which the middle comes last.

All texts of a batch lie in one byte array. White space is found by one table lookup, the ends of units by comparing
neighbours, and the cuts by counting ends. Every segment (prefix, middle, suffix of each text) moves as one, so the
distance its bytes move is put into a difference array at its first byte; the running sum is the displacement of each
byte. One scatter by place plus displacement writes all outputs of the batch; the gather by the same places, worked out
from the marks in an output, restores the texts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioloom.llm.common import binaries, small_batches

# Fixed values of the format.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
MARK = 3
SEED = 42
# Per cent of texts that are rearranged, and of these per cent that put the suffix first.
RATE, SUFFIX_FIRST = 50, 80
# Texts of one scatter hold so many bytes (one longer text is taken alone), and displacements are summed for so many bytes at a time.
SCATTER_BYTES, STEP = 4 << 20, 1 << 20

WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
INNER = np.zeros(256, bool)
INNER[0x80:0xC0] = True

RESULT = "n long, form string, prefix_chars long, middle_chars long, output string"


def _starts(lengths: np.ndarray) -> np.ndarray:
    """Places of the pieces in their concatenation, and its length at the end."""
    return np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)


def unit_ends(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ends (exclusive, in the whole array) of the units of all texts, and the number of units before each text.

    A unit is a word with the white space before it; white space that ends a text is a unit of its own.
    """
    white = WHITE[data]
    ends = np.empty(len(data), bool)
    ends[:-1] = ~white[:-1] & white[1:]
    ends[starts[1:][np.diff(starts) > 0] - 1] = True
    found = np.flatnonzero(ends) + 1
    return found, np.searchsorted(found, starts, side="right")


def _moves(first: np.ndarray, to: np.ndarray, total: int):
    """Displacements of a byte array whose segments start at ``first`` and go to ``to``, as (low, high, displacements).

    Both are listed in the order of the array; empty segments may be among them.
    """
    shift = to - first
    steps = np.diff(shift, prepend=0)
    carried = 0
    for low in range(0, total, STEP):
        high = min(low + STEP, total)
        a, b = np.searchsorted(first, [low, high])
        difference = np.zeros(high - low, np.int64)
        np.add.at(difference, first[a:b] - low, steps[a:b])
        difference[0] += carried
        moved = np.cumsum(difference)
        carried = moved[-1]
        yield low, high, moved


def _scattered(data: np.ndarray, first: np.ndarray, to: np.ndarray, out: np.ndarray) -> None:
    for low, high, moved in _moves(first, to, len(data)):
        out[np.arange(low, high) + moved] = data[low:high]


def _gathered(data: np.ndarray, first: np.ndarray, to: np.ndarray, total: int) -> np.ndarray:
    out = np.empty(total, np.uint8)
    for low, high, moved in _moves(first, to, total):
        out[low:high] = data[np.arange(low, high) + moved]
    return out


def _targets(at: np.ndarray, p: np.ndarray, m: np.ndarray, s: np.ndarray, psm: np.ndarray, spm: np.ndarray) -> np.ndarray:
    """Where prefix, middle and suffix of each text lie in its output, which starts at ``at``: an array of three columns."""
    prefix = at + np.where(psm, MARK, np.where(spm, s + 2 * MARK, 0))
    middle = at + np.where(psm | spm, p + s + 3 * MARK, p)
    suffix = at + np.where(psm, p + 2 * MARK, np.where(spm, MARK, p + m))
    return np.stack([prefix, middle, suffix], axis=1)


def _slices(lengths: np.ndarray):
    """Ranges of texts of at most SCATTER_BYTES; a longer text is a range of its own."""
    low, held = 0, 0
    for i, n in enumerate(lengths.tolist()):
        if held and held + n > SCATTER_BYTES:
            yield low, i
            low, held = i, 0
        held += n
    if low < len(lengths):
        yield low, len(lengths)


def _strings(data: np.ndarray, starts: np.ndarray) -> pa.Array:
    offsets = pa.py_buffer(starts.astype(np.int64))
    return pa.Array.from_buffers(pa.large_string(), len(starts) - 1, [None, offsets, pa.py_buffer(data)]).cast(pa.string())


def _characters(data: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Code points of the segments."""
    begun = np.concatenate([[0], np.cumsum(~INNER[data])])
    return begun[last] - begun[first]


def arranged(texts: list[bytes], h: np.ndarray, rate: int = RATE, suffix_first: int = SUFFIX_FIRST) -> pa.StructArray:
    """The texts of one scatter in their new order; ``h`` has a row of four numbers a text."""
    starts = _starts(np.array([len(t) for t in texts], np.int64))
    data = np.frombuffer(b"".join(texts), np.uint8)
    ends, before = unit_ends(data, starts) if len(data) else (np.zeros(0, np.int64), np.zeros(len(starts), np.int64))
    n = np.diff(before)
    one, two = h[:, 0] % (n + 1), h[:, 1] % (n + 1)
    marked = np.array([PREFIX in t or SUFFIX in t or MIDDLE in t for t in texts], bool)
    plain = (np.diff(starts) == 0) | marked | (h[:, 2] % 100 >= rate)
    spm = ~plain & (h[:, 3] % 100 < suffix_first)
    psm = ~plain & ~spm

    def cut(units: np.ndarray) -> np.ndarray:
        at = starts[:-1].copy()
        inner = units > 0
        at[inner] = ends[(before[:-1] + units - 1)[inner]]
        return at

    begin, left, right, end = starts[:-1], cut(np.minimum(one, two)), cut(np.maximum(one, two)), starts[1:]
    p, m, s = left - begin, right - left, end - right
    offsets = _starts(end - begin + np.where(plain, 0, 3 * MARK))
    at = offsets[:-1]
    to = _targets(at, p, m, s, psm, spm)
    out = np.empty(offsets[-1], np.uint8)
    _scattered(data, np.stack([begin, left, right], axis=1).ravel(), to.ravel(), out)
    moved = ~plain
    for column, mark in enumerate((PREFIX, MIDDLE, SUFFIX)):
        out[to[moved, column][:, None] - MARK + np.arange(MARK)] = np.frombuffer(mark, np.uint8)
    form = np.where(plain, "plain", np.where(spm, "spm", "psm"))
    return pa.StructArray.from_arrays(
        [pa.array(n, pa.int64()), pa.array(form.tolist(), pa.string()), pa.array(_characters(data, begin, left), pa.int64(), mask=plain),
         pa.array(_characters(data, left, right), pa.int64(), mask=plain), _strings(out, offsets)],
        ["n", "form", "prefix_chars", "middle_chars", "output"])


def put_back(outputs: list[bytes], forms: list[str]) -> pa.Array:
    """The texts that outputs of the given forms were made from."""
    offsets = _starts(np.array([len(t) for t in outputs], np.int64))
    spans = []
    for text, form in zip(outputs, forms, strict=True):
        if form == "plain":
            spans.append((len(text), 0, 0))
        elif form == "psm":
            two, three = text.index(SUFFIX), text.rindex(MIDDLE)
            spans.append((two - MARK, len(text) - three - MARK, three - two - MARK))
        else:
            two, three = text.index(PREFIX), text.rindex(MIDDLE)
            spans.append((three - two - MARK, len(text) - three - MARK, two - MARK))
    p, m, s = np.array(spans, np.int64).reshape(-1, 3).T
    psm, spm = np.array([f == "psm" for f in forms], bool), np.array([f == "spm" for f in forms], bool)
    to = _targets(offsets[:-1], p, m, s, psm, spm)
    starts = _starts(p + m + s)
    first = np.stack([starts[:-1], starts[:-1] + p, starts[:-1] + p + m], axis=1)
    data = np.frombuffer(b"".join(outputs), np.uint8)
    return _strings(_gathered(data, first.ravel(), to.ravel(), int(starts[-1])), starts)


def _joined(parts: list[pa.Array], kind: pa.DataType) -> pa.Array:
    return pa.concat_arrays(parts) if parts else pa.array([], kind)


def fill_in_middle(docs: DataFrame, seed: int = SEED, rate: int = RATE, suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """All rows and columns of ``docs`` and ``fim``: struct of n (units), form, prefix_chars, middle_chars and output.

    ``docs`` needs doc_id and text. A text is cut between units (a word with the white space before it; white space at the end
    is one more), at two places that four numbers from the digest of seed and id decide, as they do the form: plain (the text as it
    is), psm or spm. Both counts of characters are null if plain. A null text counts as an empty one, and empty texts and texts that hold
    a mark are plain. A null id counts as an empty string of digits. Rows that repeat an id are cut at the same shares of their units,
    repeated rows come out alike. Texts of any length are taken whole; an empty table has no rows. A column ``fim`` is replaced.
    """
    small_batches(docs.sparkSession)

    @F.arrow_udf(RESULT)
    def arrange(texts: pa.Array, h1: pa.Array, h2: pa.Array, h3: pa.Array, h4: pa.Array) -> pa.Array:
        rows = [t or b"" for t in binaries(pa.record_batch([texts], ["t"]))]
        h = np.stack([x.to_numpy(zero_copy_only=False) for x in (h1, h2, h3, h4)], axis=1).astype(np.int64)
        lengths = np.array([len(t) for t in rows], np.int64)
        parts = [arranged(rows[low:high], h[low:high], rate, suffix_first) for low, high in _slices(lengths)]
        return _joined(parts, pa.struct([("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()),
                                         ("middle_chars", pa.int64()), ("output", pa.string())]))

    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    numbers = [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]
    kept = [F.col(f"`{c}`") for c in docs.columns if c != "fim"]
    return docs.select(*kept, arrange("text", *numbers).alias("fim"))


def restored(output: Column, form: Column) -> Column:
    """The text that an output of a form was made from."""
    @F.arrow_udf("string")
    def restore(outputs: pa.Array, forms: pa.Array) -> pa.Array:
        rows = [t or b"" for t in binaries(pa.record_batch([outputs], ["t"]))]
        kinds = forms.to_pylist()
        lengths = np.array([len(t) for t in rows], np.int64)
        return _joined([put_back(rows[low:high], kinds[low:high]) for low, high in _slices(lengths)], pa.string())

    return restore(output, form)
