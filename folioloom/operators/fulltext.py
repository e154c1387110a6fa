"""Full-text search over an inverted index kept as tables: segments, postings, terms, corpus, files.

A segment is a bounded number of chunks that one task reads one after another. Its chunks are numbered and stored once; each of its terms
has one row, with the numbers, frequencies and positions of its postings as bytes. One pass over the texts writes them. The rows of terms
are then put in the order of (term, segment), cut into files by sampled ranges; a small table holds the first and last of each file. That is
done in waves over parts of the terms, by hash, and each wave drops what the pass wrote of its parts, so the terms are never there twice. A
search looks at the small table first and opens the files of its terms only. Postings are put together with their chunks by segment. Rows move
in bundles, many packed into one. Blocks are ranges of places,
the same for all terms, with the highest score a term has there: a page of the best chunks leaves out blocks that cannot reach it.
"""

from __future__ import annotations

import os
import zlib
from bisect import bisect_right
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import groupby
from operator import or_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from folioloom.operators.knn import rank_ids
from folioloom.operators.lookup import source_clause, year_clause
from folioloom.schemas import SEARCH_DOCUMENT, TEXT_CORPUS, TEXT_DOCS, TEXT_FILES, TEXT_LISTS, TEXT_POSTINGS, TEXT_SEGMENTS, TEXT_TERMS, columns
from folioloom.session import shuffles_dropped, stored_bytes
from folioloom.sources.tables import exists, located, scan

# The analyzer's token class and length limit, and the BM25 constants.
TOKEN_PATTERN = r"([\p{IsAlphabetic}\p{N}]+)"
MAX_TOKEN_BYTES = 255
BM25_K1 = 1.2
BM25_B = 0.75
SCORE_DIGITS = 6

# A chunk's place: the first hex digits of the digest of its id. A block shares so many of them that it holds PER_BLOCK chunks or more.
PLACE_DIGITS = 8
PER_BLOCK = 4
# A ranked page of terms with fewer postings scores all of them; blocks are only worth their while beyond that.
FREQUENT = 1_024
# Scores are rounded; a block that comes this near the page is read.
SLACK = 2 * 10.0 ** -SCORE_DIGITS

STORED = ["chunk_id", "doc_id", "year", "source"]

# What a score needs of a posting.
SCORED = ["term", *STORED, "tf", "doc_len"]

# A segment is closed at so many tokens. Chunks come to it in slices of so many rows, and their numbers fit two bytes.
SEGMENT_TOKENS = 1 << 22
SLICE_ROWS = 4_096
SEGMENT_ROWS = 1 << 16
# Rows of one batch that postings come back in.
UNPACKED_ROWS = 1 << 15
# Bytes of rows put together before they are bundled.
BUNDLED_BYTES = 1 << 24
# Bytes of packed terms a file is to get, and terms sampled for the ranges of the files.
RANGE_BYTES = 1 << 25
RANGE_SAMPLE = 1 << 16
# Parts of the terms by hash, a fixed value of the stored form; and bytes of packed terms that are put in ranges at once.
PARTS = 16
WAVE_BYTES = 1 << 25


@dataclass(frozen=True)
class TextIndex:
    postings: DataFrame
    terms: DataFrame
    docs: DataFrame
    corpus: DataFrame
    # Of a stored index: the chunks of all segments by number, their terms, the range of terms in each file, and the folder.
    chunks: DataFrame | None = None
    lists: DataFrame | None = None
    files: DataFrame | None = None
    path: str | None = None


def token_runs(text: Column) -> Column:
    """Runs of letters and digits, as written."""
    return F.regexp_extract_all(text, F.lit(TOKEN_PATTERN), F.lit(1))


def short_enough(run: Column) -> Column:
    """Over-long runs are no terms; their position stays empty."""
    return F.octet_length(run) < MAX_TOKEN_BYTES


def analyze(text: Column) -> Column:
    """array<struct<pos, term>> of one text, terms in lower case."""
    placed = F.transform(token_runs(text), lambda t, i: F.struct(i.alias("pos"), t.alias("run")))
    kept = F.filter(placed, lambda t: short_enough(t["run"]))
    return F.transform(kept, lambda t: F.struct(t["pos"].alias("pos"), F.lower(t["run"]).alias("term")))


def strict_rows(rows: DataFrame, extra_ok: bool = True) -> tuple[DataFrame, DataFrame]:
    """Search documents of ``rows``, and the rows without an id or a year.

    A missing field is an error; so is an unknown one unless ``extra_ok``.
    """
    wanted = columns(SEARCH_DOCUMENT)
    missing = [c for c in wanted if c not in rows.columns]
    unknown = [c for c in rows.columns if c not in wanted]
    if missing:
        raise ValueError(f"missing fields {missing}, found {rows.columns}")
    if unknown and not extra_ok:
        raise ValueError(f"unknown fields {unknown}")
    typed = rows.select(*wanted).withColumn("year", F.col("year").cast("bigint"))
    return typed.filter(is_whole()), typed.filter(~is_whole())


def is_whole() -> Column:
    return F.col("chunk_id").isNotNull() & F.col("year").isNotNull()


def analyzed(chunks: DataFrame) -> DataFrame:
    """Stored fields, raw token runs and field length of every indexable chunk."""
    rows, _ = strict_rows(chunks)
    read = rows.select(*STORED, F.coalesce(token_runs(F.col("text")), F.array().cast("array<string>")).alias("runs"))
    return read.withColumn("doc_len", F.size(F.filter("runs", short_enough)))


def occurrences(chunks: DataFrame) -> DataFrame:
    """One row per token: stored fields, ``pos`` and ``term``."""
    # the outer form, since Spark would analyze each text a second time to skip empty ones
    spread = analyzed(chunks).select(*STORED, F.posexplode_outer("runs").alias("pos", "run"))
    return spread.filter(F.col("run").isNotNull() & short_enough(F.col("run"))).select(
        *STORED, "pos", F.lower("run").alias("term"))


def _chunk_terms(chunks: DataFrame) -> DataFrame:
    """Per chunk its stored fields, place, and its terms in their order, with null for an over-long run; those that are not null are counted later."""
    runs = F.coalesce(token_runs(F.col("text")), F.array().cast("array<string>"))
    terms = F.transform(runs, lambda r: F.when(short_enough(r), F.lower(r)))
    place = F.substring(F.sha2("chunk_id", 256), 1, PLACE_DIGITS)
    return strict_rows(chunks)[0].select(*STORED, place.alias("place"), terms.alias("terms"))


def postings(chunks: DataFrame) -> DataFrame:
    """One row per term and chunk, with positions. Narrow: no shuffle.

    All tokens of a chunk are in its row, so they are grouped inside the task, batch by
    batch. Grouping token rows with ``collect_list`` gives the same at four times the cost,
    most of it for sorting and shuffling them. What all postings of a chunk share goes to Python and back once.
    """
    rows = _chunk_terms(chunks)
    fields = "ARRAY<STRUCT<term: STRING, tf: INT, positions: ARRAY<INT>>>"
    head = [*STORED, "place"]
    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.select(*head).schema)
    grouped = rows.mapInArrow(_group_tokens, f"{kept}, doc_len INT, entries {fields}")
    return grouped.select(*head, "doc_len", F.inline("entries")).select(*columns(TEXT_POSTINGS))


def _tokens(terms: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """Row, position and code of every term in a list of lists, and the terms of the codes; nulls have a position only."""
    lengths = np.diff(terms.offsets.to_numpy())
    row = np.repeat(np.arange(len(terms), dtype=np.int32), lengths)
    pos = np.arange(len(row), dtype=np.int32) - np.repeat((np.cumsum(lengths) - lengths).astype(np.int32), lengths)
    coded = terms.flatten().dictionary_encode()
    known = coded.indices.is_valid().to_numpy(zero_copy_only=False)
    code = coded.indices.fill_null(0).to_numpy(zero_copy_only=False)
    return row[known], pos[known], code[known].astype(np.int64), coded.dictionary


def _lengths(row: np.ndarray, rows: int) -> pa.Array:
    """How many terms each row has."""
    return pa.array(np.bincount(row, minlength=rows), pa.int32())


def _cuts(keys: np.ndarray) -> np.ndarray:
    """Where runs of equal keys begin, and the end."""
    return np.flatnonzero(np.r_[True, keys[1:] != keys[:-1], True]) if len(keys) else np.zeros(1, int)


def _group_tokens(batches):
    for batch in batches:
        row, pos, code, words = _tokens(batch["terms"])
        group = row.astype(np.int64) * max(1, len(words)) + code
        order = np.argsort(group, kind="stable")  # positions of one group stay in order
        bounds = _cuts(group[order])
        first = order[bounds[:-1]]
        places = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(pos[order].astype(np.int32)))
        entries = pa.StructArray.from_arrays(
            [words.take(pa.array(code[first])), pa.array(np.diff(bounds).astype(np.int32)), places], names=["term", "tf", "positions"])
        ends = np.r_[0, np.cumsum(np.bincount(row[first], minlength=batch.num_rows))].astype(np.int32)
        head = batch.select([*STORED, "place"])
        yield pa.RecordBatch.from_arrays(
            [*head.columns, _lengths(row, batch.num_rows), pa.ListArray.from_arrays(pa.array(ends), entries)], names=[*head.schema.names, "doc_len", "entries"])


# --- segments -----------------------------------------------------------------------------


def segments(chunks: DataFrame) -> DataFrame:
    """Rows of TEXT_SEGMENTS: of each segment its chunks and its terms. Narrow: no shuffle."""
    return _chunk_terms(chunks).mapInArrow(_to_segments, TEXT_SEGMENTS)


def _to_segments(batches):
    held, rows, tokens = [], 0, 0
    for batch in batches:
        for low in range(0, batch.num_rows, SLICE_ROWS):
            part = batch.slice(low, SLICE_ROWS)
            if rows + part.num_rows > SEGMENT_ROWS or tokens >= SEGMENT_TOKENS:
                yield from _segment(pa.Table.from_batches(held))
                held, rows, tokens = [], 0, 0
            held.append(part)
            rows, tokens = rows + part.num_rows, tokens + len(part["terms"].flatten())
    if held:
        yield from _segment(pa.Table.from_batches(held))


def _segment(rows: pa.Table):
    """The chunks of one segment, and its terms with their postings by number of the chunk."""
    # One task writes a segment as a whole, so an id that another attempt gives anew does no harm.
    block = int.from_bytes(os.urandom(8), "little") >> 1
    every = np.arange(rows.num_rows)
    fields = {c: rows[c].combine_chunks() for c in [*STORED, "place"]}
    row, pos, code, words = _tokens(pa.concat_arrays(rows["terms"].chunks))
    yield _segment_rows(rows.num_rows, block, number=pa.array(every, pa.int32()), doc_len=_lengths(row, rows.num_rows), **fields)
    key = code * rows.num_rows + row
    order = np.argsort(key, kind="stable")
    bounds = _cuts(key[order])
    del key
    first = order[bounds[:-1]]
    lists = _cuts(code[first])
    if len(lists) > 1:
        steps = np.diff(row[first], prepend=0)
        steps[lists[:-1]] = row[first][lists[:-1]]
        yield _segment_rows(
            len(lists) - 1, block, term=words.take(pa.array(code[first][lists[:-1]])), n=pa.array(np.diff(lists), pa.int32()),
            steps=_packed(steps, lists), tf=_packed(np.diff(bounds), lists), positions=_packed(pos[order], bounds[lists]))


def _segment_rows(rows: int, block: int, **given) -> pa.RecordBatch:
    given["block"] = pa.array(np.full(rows, block), pa.int64())
    given["kind"] = pa.array(["terms" if "term" in given else "chunks"] * rows)
    kinds = {"term": pa.string(), "n": pa.int32(), "steps": pa.binary(), "tf": pa.binary(), "positions": pa.binary(), "number": pa.int32(),
             "chunk_id": pa.string(), "doc_id": pa.string(), "year": pa.int64(), "source": pa.string(), "doc_len": pa.int32(), "place": pa.string()}
    names = columns(TEXT_SEGMENTS)
    return pa.RecordBatch.from_arrays([given[c] if c in given else pa.nulls(rows, kinds[c]) for c in names], names=names)


def _packed(numbers: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Numbers between the bounds as bytes, all of one width: the least that the largest fits."""
    small = _small(numbers)
    offsets = pa.py_buffer((bounds * small.itemsize).astype(np.int32).tobytes())
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, offsets, pa.py_buffer(small.tobytes())])


def _by_byte(column: pa.ChunkedArray, count: int) -> bytes:
    """The bytes of ``count`` packed numbers: the lowest of all of them, then the next ones, which are alike and shrink well."""
    held = b"".join(column.to_pylist())
    return np.frombuffer(held, np.uint8).reshape(count, -1).T.tobytes()


def _unpacked(held: bytes, count: int) -> np.ndarray:
    """Numbers out of ``_by_byte``."""
    return np.ascontiguousarray(np.frombuffer(held, np.uint8).reshape(-1, count).T).view(f"<u{len(held) // count}").ravel().astype(np.int64)


def _lean_lists(rows: pa.Table) -> pa.Table:
    """Terms of one segment in one row, their numbers put together: how many belong to a term is known from ``n`` and ``tf``."""
    total = int(pc.sum(rows["n"]).as_py())
    counts = {"steps": total, "tf": total}
    if "positions" in rows.column_names:
        counts["positions"] = int(_unpacked(_by_byte(rows["tf"], total), total).sum())
    whole = {c: pa.ListArray.from_arrays(pa.array([0, rows.num_rows], pa.int32()), rows[c].combine_chunks()) for c in ("term", "n")}
    return pa.table(whole | {c: pa.array([_by_byte(rows[c], count)], pa.binary()) for c, count in counts.items()})


def _gathered(batches) -> Iterator[pa.Table]:
    """Batches put together up to BUNDLED_BYTES."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= BUNDLED_BYTES:
            yield pa.Table.from_batches(held)
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def bundles(rows: DataFrame, key: Callable[[pa.Table], np.ndarray], kind: int = 0, lean: Callable[[pa.Table], pa.Table] | None = None) -> DataFrame:
    """Rows of one key (a whole number) that lie near each other, packed into one: ``key, kind, size, data``. ``lean`` makes them smaller before."""
    def run(batches):
        for held in _gathered(batches):
            keys = key(held)
            order = np.argsort(keys, kind="stable")
            ends = _cuts(keys[order])
            for low, high in zip(ends[:-1], ends[1:]):
                part = held.take(pa.array(order[low:high])).combine_chunks()
                part = lean(part) if lean else part
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, part.schema) as out:
                    out.write_table(part)
                raw = sink.getvalue()
                yield pa.RecordBatch.from_pydict({
                    "key": pa.array([int(keys[order[low]])], pa.int64()), "kind": pa.array([kind], pa.int32()),
                    "size": pa.array([raw.size], pa.int64()), "data": pa.array([pa.compress(raw, "zstd", asbytes=True)], pa.binary())})

    return rows.mapInArrow(run, "key BIGINT, kind INT, size BIGINT, data BINARY")


def _opened(batches) -> Iterator[tuple[int, int, pa.Table]]:
    """Key, kind and rows of bundles."""
    for batch in batches:
        for i in range(batch.num_rows):
            key, kind, size, data = (batch.column(c)[i] for c in range(4))
            raw = pa.decompress(data.as_buffer(), size.as_py(), "zstd")
            yield key.as_py(), kind.as_py(), pa.ipc.open_stream(raw).read_all()


def _of_block(rows: pa.Table) -> np.ndarray:
    return rows["block"].to_numpy()


def unpacked(terms: DataFrame, chunks: DataFrame, wanted: list[str]) -> DataFrame:
    """Postings with the ``wanted`` columns of TEXT_POSTINGS, of terms of segments, in such of ``chunks`` (``block, number`` and what is wanted).

    Both meet by segment, and its postings come back chunk by chunk: what they share goes to Python and back once, and the rows of a
    chunk, next to one another, shrink well wherever they are written.
    """
    names = [c for c in columns(TEXT_POSTINGS) if c in wanted]
    hits = chunk_hits(terms, chunks, wanted)
    return hits.select(*[c for c in hits.columns if c != "entries"], F.inline("entries")).select(*names)


def _by_segment(terms: DataFrame, chunks: DataFrame, wanted: list[str]) -> DataFrame:
    """Bundles of the chunks of a segment, then of its terms, one segment after another."""
    held = chunks.select("block", "number", *[c for c in wanted if c in (*STORED, "doc_len", "place")])
    lists = terms.select("block", "term", "n", "steps", "tf", *[c for c in ("positions",) if c in wanted])
    moved = bundles(held, _of_block).union(bundles(lists, _of_block, 1, _lean_lists))
    return moved.repartition("key").sortWithinPartitions("key", "kind")


def _met(batches) -> Iterator[tuple[int, pa.Table, np.ndarray, pa.Table]]:
    """Of ``_by_segment`` each bundle of terms, with its segment, the chunks of it, and the row there for the number of a chunk, or -1."""
    block, parts, found = None, [], None
    for key, kind, rows in _opened(batches):
        if key != block:
            block, parts, found = key, [], None
        if kind == 0:
            parts.append(rows)
        elif parts or found:
            if parts:
                held = pa.concat_tables(parts).combine_chunks()
                number = held["number"].to_numpy()
                place = np.full(int(number.max()) + 1, -1)
                place[number] = np.arange(len(number))
                parts, found = [], (held, place)
            yield block, *found, rows


def _small(numbers: np.ndarray) -> np.ndarray:
    """Numbers in the least width that the largest fits."""
    return numbers.astype(np.min_scalar_type(int(numbers.max()))) if len(numbers) else numbers.astype(np.uint8)


def _places_in(lists: pa.Table, place: np.ndarray, positions: bool) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray, np.ndarray | None]:
    """The terms, and of each of their postings in the chunks at hand the term's row, the chunk's row, the frequency, and all positions."""
    (terms, n), blobs = (lists[c].combine_chunks().flatten() for c in ("term", "n")), {c: lists[c][0].as_py() for c in lists.column_names[2:]}
    n = n.to_numpy().astype(np.int64)
    total = int(n.sum())
    tf, passed = _unpacked(blobs["tf"], total), np.cumsum(_unpacked(blobs["steps"], total))
    # steps begin anew in each row
    ends = np.cumsum(n)
    at = passed - np.repeat(np.r_[0, passed[ends[:-1] - 1]], n)
    keep = at < len(place)
    keep[keep] = place[at[keep]] >= 0
    every = _small(_unpacked(blobs["positions"], int(tf.sum()))[np.repeat(keep, tf)]) if positions else None
    return terms, np.repeat(np.arange(len(n), dtype=np.int32), n)[keep], _small(place[at[keep]]), _small(tf[keep]), every


def chunk_hits(terms: DataFrame, chunks: DataFrame, wanted: list[str]) -> DataFrame:
    """Per chunk with one of the terms its ``wanted`` columns and ``entries``, its postings in the order of the terms.

    For the terms of a query: a segment's postings are put together in the task that meets them, so nothing is shuffled after that.
    """
    listed = ["term", "tf", *[c for c in ("positions",) if c in wanted]]
    types = dict(f.split() for f in TEXT_POSTINGS.split(", "))
    names = [c for c in types if c in wanted and c not in listed]
    fields = ", ".join(f"{c}: {types[c]}" for c in listed)

    def run(batches):
        for _, met in groupby(_met(batches), key=lambda m: m[0]):
            yield from _entries_in([m[1:] for m in met], names, listed)

    return _by_segment(terms, chunks, wanted).mapInArrow(run, ", ".join([*(f"{c} {types[c]}" for c in names), f"entries ARRAY<STRUCT<{fields}>>"]))


def _entries_in(met: list[tuple[pa.Table, np.ndarray, pa.Table]], names: list[str], listed: list[str]) -> Iterator[pa.RecordBatch]:
    """Chunks of one segment with their postings of all bundles of terms. These are held as narrow numbers and come back a part at a time."""
    words, rows, known = [], [], 0
    for _, place, lists in met:
        terms, row, *numbers = _places_in(lists, place, "positions" in listed)
        rows.append((row + np.int32(known), *numbers))
        words.append(terms)
        known += len(terms)
    code, at, tf, every = (None if part[0] is None else np.concatenate(part) for part in zip(*rows))
    del rows
    words = pa.concat_arrays(words)
    order = np.argsort(at.astype(np.int64) * known + rank_ids(words)[code].astype(np.int64) - 1)
    starts = np.cumsum(tf, dtype=np.int64) - tf
    bounds = _cuts(at[order])
    held = met[0][0].select(names)
    low = 0
    while low < len(bounds) - 1:
        high = max(low + 1, int(np.searchsorted(bounds, bounds[low] + UNPACKED_ROWS, "right")) - 1)
        part = order[bounds[low]:bounds[high]]
        fields = {"term": words.take(pa.array(code[part])), "tf": pa.array(tf[part].astype(np.int32))}
        if every is not None:
            n = tf[part].astype(np.int64)
            ends = np.cumsum(n)
            places = every[np.arange(ends[-1]) + np.repeat(starts[part] - ends + n, n)]
            fields["positions"] = pa.ListArray.from_arrays(pa.array(np.r_[0, ends].astype(np.int32)), pa.array(places.astype(np.int32)))
        entries = pa.StructArray.from_arrays([fields[c] for c in listed], names=listed)
        found = held.take(pa.array(at[order[bounds[low:high]]]))
        offsets = pa.array((bounds[low:high + 1] - bounds[low]).astype(np.int32))
        yield pa.RecordBatch.from_arrays(
            [*(found[c].combine_chunks() for c in names), pa.ListArray.from_arrays(offsets, entries)], names=[*names, "entries"])
        low = high


def _in_ranges(listed: DataFrame, n: int) -> DataFrame:
    """Rows of TEXT_LISTS in ``n`` ranges of (term, block) of about equal size, in order.

    A sample decides where a range ends, weighted by the size of its rows, and nothing else.
    """
    rows = listed.count()
    weighted = listed.select("term", "block", (F.lit(24) + 4 * F.col("n")).alias("weight"))
    sample = sorted(tuple(r) for r in weighted.sample(min(1.0, RANGE_SAMPLE / max(1, rows)), seed=1).collect())
    upto = np.cumsum([weight for *_, weight in sample]) if sample else np.zeros(0)
    ends = [sample[int(np.searchsorted(upto, upto[-1] * i / n))][:2] for i in range(1, n)] if sample else []

    def range_of(held: pa.Table) -> np.ndarray:
        keys = zip(held["term"].to_pylist(), held["block"].to_pylist())
        return np.fromiter((bisect_right(ends, key) for key in keys), np.int64, held.num_rows)

    def opened(batches):
        for *_, rows in _opened(batches):
            yield from rows.to_batches(max_chunksize=UNPACKED_ROWS)

    dealt = bundles(listed, range_of).repartitionById(n, F.col("key").cast("int"))
    return dealt.mapInArrow(opened, TEXT_LISTS).sortWithinPartitions("term", "block")


def text_docs(chunks: DataFrame) -> DataFrame:
    return analyzed(chunks).select(*columns(TEXT_DOCS))


def text_terms(posted: DataFrame) -> DataFrame:
    return posted.groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def text_corpus(docs: DataFrame) -> DataFrame:
    """One row: number of chunks, their mean length, and the digits of a place that make a block."""
    figures = docs.agg(F.count(F.lit(1)).cast("double").alias("n"), F.avg(F.col("doc_len").cast("double")).alias("avg_len"))
    digits = sum((F.col("n") >= float(PER_BLOCK * 16 ** d)).cast("int") for d in range(1, PLACE_DIGITS + 1))
    return figures.withColumn("digits", digits)


def has_copies(docs: DataFrame) -> bool:
    """Whether stored fields may come twice, told by their hashes; all different hashes mean that none does."""
    again = docs.groupBy(F.xxhash64(*STORED).alias("hash")).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    return again.agg(F.count(F.lit(1))).first()[0] > 0


def one_row_each(index: TextIndex) -> bool:
    """Whether the index is stored and knows that no chunk comes twice; an index that was written without that knowledge does not."""
    return index.files is not None and index.corpus.select("copies").first().copies is False


def impact(avg_len: Column, tf: Column | None = None) -> Column:
    """What a posting adds to a BM25 score for each unit of its term's weight."""
    tf = F.col("tf") if tf is None else tf
    norm = BM25_K1 * (1 - BM25_B + BM25_B * F.col("doc_len") / avg_len)
    return tf * (BM25_K1 + 1) / (tf + norm)


def rarity(n: Column, df: Column) -> Column:
    return F.log(1 + (n - df + 0.5) / (df + 0.5))


def in_block(digits: Column) -> Column:
    return F.substring("place", F.lit(1), digits)


def index_of(chunks: DataFrame) -> TextIndex:
    """The index of ``chunks`` as lazy tables."""
    posted, docs = postings(chunks), text_docs(chunks)
    return TextIndex(posted, text_terms(posted), docs, text_corpus(docs))


def write_text_index(chunks: DataFrame, path: str) -> None:
    """The index as tables under ``path``; rows without id or year go to ``rejects`` there.

    The texts are read once. How many rows are rejected is observed on that pass; only where some are, a second one writes them.
    """
    spark = chunks.sparkSession
    with shuffles_dropped(spark):
        _write_text_index(spark, chunks, path)


def _write_text_index(spark: SparkSession, chunks: DataFrame, path: str) -> None:
    seen = Observation()
    rows = chunks.observe(seen, F.count_if(~is_whole()).alias("n_rejected"))
    parted = segments(rows).withColumn("part", F.coalesce(part_of(F.col("term")), F.lit(0)))
    written = parted.sortWithinPartitions("kind", "part", "term").write.mode("overwrite").partitionBy("kind", "part")
    written.option("compression", "zstd").parquet(f"{path}/segments")
    bad = strict_rows(chunks)[1] if seen.get["n_rejected"] else spark.createDataFrame([], SEARCH_DOCUMENT)
    bad.write.mode("overwrite").parquet(f"{path}/rejects")
    unordered = f"{path}/segments/kind=terms"
    size = stored_bytes(spark, unordered)
    waves = min(PARTS, 1 << max(0, -(-size // WAVE_BYTES) - 1).bit_length())
    cores = spark.sparkContext.defaultParallelism
    n = max(cores if waves > 1 else 2 * cores, -(-size // (waves * RANGE_BYTES)))
    for wave in range(waves):
        parts = range(wave * PARTS // waves, (wave + 1) * PARTS // waves)
        listed = _kind(spark, path, "terms", parts).select(*columns(TEXT_LISTS))
        _in_ranges(listed, n).write.mode("append" if wave else "overwrite").option("compression", "zstd").parquet(f"{path}/postings")
        for part in parts:
            files, at = located(spark, f"{unordered}/part={part}")
            files.delete(at, True)
    files, at = located(spark, unordered)
    files.delete(at, True)
    index = read_text_index(spark, path)
    index.lists.groupBy("term").agg(F.sum("n").alias("df")).sort("term").write.mode("overwrite").parquet(f"{path}/terms")
    text_corpus(index.docs).withColumn("copies", F.lit(has_copies(index.docs))).write.mode("overwrite").parquet(f"{path}/corpus")
    name = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)
    ends = spark.read.schema(TEXT_LISTS).parquet(f"{path}/postings").groupBy(name.alias("file")).agg(
        F.min(F.struct("term", "block")).alias("first"), F.max(F.struct("term", "block")).alias("last"),
        F.min(part_of(F.col("term"))).alias("first_part"), F.max(part_of(F.col("term"))).alias("last_part"))
    ends.select("file", F.col("first.term").alias("first_term"), F.col("last.term").alias("last_term"), F.col("first.block").alias("first_place"),
                F.col("last.block").alias("last_place"), "first_part", "last_part").sort("first_term", "first_place").write.mode("overwrite").parquet(f"{path}/files")


def part_of(term: Column) -> Column:
    return F.pmod(F.crc32(term.cast("binary")), F.lit(PARTS)).cast("int")


def _kind(spark: SparkSession, path: str, kind: str, parts: range | None = None) -> DataFrame:
    """Rows of one kind, of all parts or of some. Segments that were written without parts are read as they are."""
    rows = scan(spark, f"{path}/segments", f"{TEXT_SEGMENTS}, part INT").filter(F.col("kind") == kind)
    return (rows if parts is None else rows.filter(F.col("part").isin(*parts))).drop("part")


def read_text_index(spark: SparkSession, path: str) -> TextIndex:
    """The stored index, lazily and with given schemas; tables that are not written yet are None."""
    tables = {"lists": ("postings", TEXT_LISTS), "terms": ("terms", TEXT_TERMS), "corpus": ("corpus", TEXT_CORPUS), "files": ("files", TEXT_FILES)}
    found = {name: scan(spark, f"{path}/{folder}", schema) if exists(spark, f"{path}/{folder}") else None for name, (folder, schema) in tables.items()}
    if found["lists"] is None:
        return TextIndex(postings=None, docs=None, path=path, **found)
    chunks = _kind(spark, path, "chunks").select("block", "number", *STORED, "doc_len", "place")
    posted = unpacked(found["lists"], chunks, columns(TEXT_POSTINGS))
    return TextIndex(posted, docs=chunks.select(*columns(TEXT_DOCS)), chunks=chunks, path=path, **found)


def postings_of(index: TextIndex, terms: set[str]) -> DataFrame:
    """Postings of some terms. Of a stored index the terms of its segments, still packed, and only the files that hold one of them are opened."""
    wanted = F.col("term").isin(sorted(terms))
    if index.files is None:
        return index.postings.filter(wanted)
    # an index that was written in one wave, before there were parts, has none in the table
    first, last = F.coalesce("first_part", F.lit(0)), F.coalesce("last_part", F.lit(PARTS - 1))

    def may_hold(term: str) -> Column:
        return (F.col("first_term") <= term) & (F.col("last_term") >= term) & F.lit(zlib.crc32(term.encode()) % PARTS).between(first, last)

    within = reduce(or_, map(may_hold, sorted(terms)), F.lit(False))
    names = sorted(r.file for r in index.files.filter(within).select("file").collect())
    if not names:
        return index.lists.limit(0)
    rows = index.lists.sparkSession.read.schema(TEXT_LISTS).parquet(*[f"{index.path}/postings/{name}" for name in names])
    return rows.filter(wanted)


def query_terms(spark: SparkSession, query: str) -> list[tuple[int, str]]:
    """(position, term) of a query text, by the same analyzer; one constant row, no job over data."""
    row = spark.sql("SELECT :q AS q", args={"q": query}).select(analyze(F.col("q")).alias("t")).first()
    return [(t["pos"], t["term"]) for t in row["t"]]


def _posted(index: TextIndex, terms: set[str], year_from, year_to, sources, blocks: DataFrame | None = None, wanted: list[str] | None = None,
            put=unpacked) -> DataFrame:
    """Postings of the terms under the filters, which hold for the whole query, and in the ``blocks`` if they are given. ``put`` meets terms and chunks."""
    def kept(rows: DataFrame) -> DataFrame:
        rows = source_clause(year_clause(rows, year_from, year_to), sources)
        if blocks is None:
            return rows
        placed = rows.withColumn("digits", index.corpus.select("digits").scalar()).withColumn("of_block", in_block(F.col("digits")))
        return placed.join(blocks.select(F.col("block").alias("of_block")), "of_block", "left_semi").drop("digits", "of_block")

    if index.files is None:
        return kept(postings_of(index, terms))
    return put(postings_of(index, terms), kept(index.chunks), wanted or columns(TEXT_POSTINGS))


def raw_match(chunks: DataFrame, field: str, value: str) -> DataFrame:
    """Chunks whose id field equals the value exactly."""
    if field not in ("chunk_id", "doc_id", "source"):
        raise ValueError(f"{field} is not a raw field")
    return chunks.filter(F.col(field) == value).select(*STORED)


def match(
    index: TextIndex, query: str, mode: str = "any",
    year_from: int | None = None, year_to: int | None = None, sources: list[str] | None = None,
) -> DataFrame:
    """Chunks with any or all terms of the query, and how many of the distinct terms they have."""
    if mode not in ("any", "all"):
        raise ValueError("mode is 'any' or 'all'")
    terms = {t for _, t in query_terms(index.postings.sparkSession, query)}
    if one_row_each(index):
        hits = _posted(index, terms, year_from, year_to, sources, wanted=STORED, put=chunk_hits)
        found = hits.select(*STORED, F.size("entries").cast("bigint").alias("n_terms"))
    else:
        found = _posted(index, terms, year_from, year_to, sources, wanted=["term", *STORED]).groupBy(*STORED).agg(F.count(F.lit(1)).alias("n_terms"))
    return found.filter(F.col("n_terms") == len(terms)) if mode == "all" else found


def phrase(
    index: TextIndex, query: str,
    year_from: int | None = None, year_to: int | None = None, sources: list[str] | None = None,
) -> DataFrame:
    """Chunks with the query's terms next to one another, and the number of such places."""
    spark = index.postings.sparkSession
    asked = query_terms(spark, query)
    if not asked:
        return index.docs.select(*STORED, F.lit(0).cast("bigint").alias("n_places")).limit(0)
    terms = {t for _, t in asked}
    if one_row_each(index):
        hit = _posted(index, terms, year_from, year_to, sources, wanted=[*STORED, "positions"], put=chunk_hits)
        starts = reduce(F.array_intersect, (_starts(term, offset) for offset, term in asked))
        return hit.filter(F.size("entries") == len(terms)).select(*STORED, F.size(starts).cast("bigint").alias("n_places")).filter("n_places > 0")
    # as many rows as the query has words
    offsets = F.broadcast(spark.createDataFrame(asked, "offset INT, term STRING"))
    hit = _posted(index, terms, year_from, year_to, sources, wanted=["term", *STORED, "positions"]).join(offsets, "term")
    starts = hit.select(*STORED, F.explode(F.transform("positions", lambda p: p - F.col("offset"))).alias("start"))
    whole = starts.groupBy(*STORED, "start").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") == len(asked))
    return whole.groupBy(*STORED).agg(F.count(F.lit(1)).alias("n_places"))


def _starts(term: str, offset: int) -> Column:
    """Where a phrase with the term at ``offset`` would begin in a chunk of ``chunk_hits``; null without the term."""
    entry = F.try_element_at(F.filter("entries", lambda e: e["term"] == term), F.lit(1))
    return F.transform(entry["positions"], lambda p: p - offset)


def bm25(
    index: TextIndex, query: str,
    year_from: int | None = None, year_to: int | None = None, sources: list[str] | None = None,
) -> DataFrame:
    """Chunks with any term of the query and their BM25 ``score``.

    Corpus figures come from the whole index, whatever the filters. The score is rounded, so
    that ties do not depend on the order in which a task adds terms up.
    """
    known = _weighted(index, query)
    return _scored(index, known, {"year_from": year_from, "year_to": year_to, "sources": sources})


def _weighted(index: TextIndex, query: str) -> list[tuple[str, int, int]]:
    """(term, how often the query has it, chunks that have it) of the query's terms that the index has: no more rows than the query has words."""
    weights: dict[str, int] = {}
    for _, term in query_terms(index.postings.sparkSession, query):
        weights[term] = weights.get(term, 0) + 1
    rows = index.terms.filter(F.col("term").isin(sorted(weights))).collect()
    return sorted((r.term, weights[r.term], r.df) for r in rows)


def _with_weight(index: TextIndex, rows: DataFrame, known: list[tuple[str, int, int]]) -> DataFrame:
    """Rows of the terms with ``weight`` (of the term in the query, by its rarity) and ``c``, the corpus figures."""
    asked = rows.sparkSession.createDataFrame(known, "term STRING, times INT, df BIGINT")
    found = rows.join(F.broadcast(asked), "term").withColumn("c", index.corpus.select(F.struct("n", "avg_len", "digits").alias("c")).scalar())
    return found.withColumn("weight", F.col("times") * rarity(F.col("c.n"), F.col("df")))


def _scored(index: TextIndex, known: list[tuple[str, int, int]], filters: dict, blocks: DataFrame | None = None) -> DataFrame:
    """Stored fields and score of the chunks under the filters, and in the ``blocks`` if they are given."""
    under, terms = {"year_from": None, "year_to": None, "sources": None, **filters, "blocks": blocks}, {t for t, *_ in known}
    if not known or not one_row_each(index):
        part = F.col("weight") * impact(F.col("c.avg_len"))
        hit = _with_weight(index, _posted(index, terms, **under, wanted=SCORED), known)
        return hit.groupBy(*STORED).agg(F.round(F.sum(part), SCORE_DIGITS).alias("score"))
    hit = _posted(index, terms, **under, wanted=[*STORED, "doc_len"], put=chunk_hits)
    hit = hit.withColumn("c", index.corpus.select(F.struct("n", "avg_len").alias("c")).scalar())
    weights = F.create_map(*[x for term, times, df in known for x in (F.lit(term), F.lit(times) * rarity(F.col("c.n"), F.lit(df)))])
    score = F.aggregate("entries", F.lit(0.0), lambda total, e: total + weights[e["term"]] * impact(F.col("c.avg_len"), e["tf"]))
    return hit.select(*STORED, F.round(score, SCORE_DIGITS).alias("score"))


def block_bounds(index: TextIndex, known: list[tuple[str, int, int]]) -> DataFrame:
    """Per block with a term of the query the highest score that a chunk in it can have: ``block, bound``.

    Of the chunks only places and lengths are read.
    """
    figures = index.corpus.select(F.struct("avg_len", "digits").alias("c"))
    rows = _posted(index, {t for t, *_ in known}, None, None, None, wanted=["term", "tf", "doc_len", "place"]).withColumn("c", figures.scalar())
    best = rows.groupBy("term", in_block(F.col("c.digits")).alias("block")).agg(F.max(impact(F.col("c.avg_len"))).alias("best"))
    return _with_weight(index, best, known).groupBy("block").agg(F.sum(F.col("weight") * F.col("best")).alias("bound"))


def score_to_reach(index: TextIndex, query: str, wanted: int, **filters) -> tuple[list, DataFrame, float]:
    """The query's known terms, the bounds of all blocks, and a score that ``wanted`` chunks have or exceed for certain (0 if not so many do).

    The ``wanted`` blocks of highest bound are scored for that; each holds at least one chunk with a term.
    """
    known = _weighted(index, query)
    bounds = block_bounds(index, known)
    first = bounds.orderBy(F.desc("bound"), "block").limit(wanted).select("block")
    best = _scored(index, known, filters, first).orderBy(F.desc("score"), "chunk_id").limit(wanted)
    with shuffles_dropped(best.sparkSession):
        reached = best.agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least")).first()
    return known, bounds, reached.least if reached.n == wanted else 0.0


def ranked_page(
    index: TextIndex, query: str, offset: int = 0, limit: int = 20,
    year_from: int | None = None, year_to: int | None = None, sources: list[str] | None = None,
) -> DataFrame:
    """A page of the chunks with the highest BM25 score, the same as of the whole ranking: stored fields in order.

    Blocks whose chunks cannot reach the page are left out before anything in them is scored. Terms with few postings are scored whole.
    """
    filters = {"year_from": year_from, "year_to": year_to, "sources": sources}
    if sum(df for *_, df in _weighted(index, query)) < FREQUENT:
        return page(bm25(index, query, **filters), offset, limit, by_score=True)
    known, bounds, least = score_to_reach(index, query, offset + limit, **filters)
    reaching = bounds.filter(F.col("bound") >= least - SLACK)
    return page(_scored(index, known, filters, reaching), offset, limit, by_score=True)


def page(hits: DataFrame, offset: int = 0, limit: int = 20, by_score: bool = False) -> DataFrame:
    """Stored fields of one page of hits, by chunk id or by falling score."""
    order = [F.desc("score"), F.asc("chunk_id")] if by_score else [F.asc("chunk_id")]
    return hits.orderBy(*order).offset(offset).limit(limit).select(*STORED)


def hit_count(hits: DataFrame) -> DataFrame:
    return hits.agg(F.count(F.lit(1)).alias("num_hits"))
