"""What several operators share: words, hashes, bounded counter arrays, written tables, numbering, components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folioloom.session import new_folder, ship_package
from folioloom.sources.tables import located

# ASCII white space as the contracts define it: space and \x09-\x0D. bytes.split() cuts at exactly these.
WHITE = b" \t\n\x0b\x0c\r"
CONTINUATION = bytes(range(0x80, 0xC0))
# Bytes of a text as words of letters and digits: ASCII letters in lower case, other ASCII a blank, the rest as it is.
LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
CACHED_WORDS = 1 << 16


class WordHashes(dict):
    """64-bit hashes of words, computed once for words that come again. Emptied when full."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def _odd(n: int) -> np.uint64:
    return np.uint64(xxhash.xxh3_64_intdigest(f"weight {n}".encode()) | 1)


WEIGHTS = [_odd(i) for i in range(64)]


def mixed(values: np.ndarray) -> np.ndarray:
    """All bits of a 64-bit value made to depend on all others."""
    values = values ^ (values >> np.uint64(31))
    values = values * np.uint64(0x9E3779B97F4A7C15)
    values = values ^ (values >> np.uint64(29))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    return values ^ (values >> np.uint64(32))


def shingle_hashes(words: np.ndarray, width: int, salt: int = 0) -> np.ndarray:
    """A 64-bit hash for each run of ``width`` words; one for the whole sequence where it is shorter."""
    if not len(words):
        return words
    length = min(width, len(words))
    count = len(words) - length + 1
    total = np.full(count, WEIGHTS[63 - length] * np.uint64(salt + 1), np.uint64)
    for i in range(length):
        total += words[i:i + count] * WEIGHTS[i]
    return mixed(total)


def binaries(batch: pa.RecordBatch, column: int = 0) -> list[bytes | None]:
    """Strings of a column as UTF-8 bytes, with no decoding."""
    return batch.column(column).cast(pa.binary()).to_pylist()


# Rows of one batch between the JVM and Python; texts are long, and a worker holds some copies of a batch.
BATCH_ROWS = 500


def small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def stored(df: DataFrame, label: str, codec: str | None = None) -> DataFrame:
    """The rows written to the shared folder and read again: lineage ends there, lost executors cost nothing.

    The session's compression, unless ``codec`` names one.
    """
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path, compression=codec)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete what ``stored`` has written, and these tables are read from; nothing may read it any more. Other files stay."""
    for rows in tables:
        folders = {name.rsplit("/", 1)[0] for name in rows.inputFiles()}
        for folder in (f for f in folders if f.rsplit("/", 1)[1].startswith("folioloom-")):
            files, at = located(rows.sparkSession, folder)
            files.delete(at, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def set_aside(docs: DataFrame, needed: list[str]) -> tuple[DataFrame, Callable[..., DataFrame]]:
    """The columns an operator needs, with all others of ``docs`` in one column ``rest``, so that no name clashes with those used inside;
    and a function that gives the rows of a result the columns of ``docs`` again, in their order, and some more."""
    needed = [c for c in docs.columns if c in needed]
    others = [F.col(f"`{c}`") for c in docs.columns if c not in needed] or [F.lit(None).cast("boolean").alias("none")]
    columns = docs.columns

    def back(rows: DataFrame, *more: str) -> DataFrame:
        return rows.select(*[F.col(c) if c in needed else F.col(f"rest.`{c}`") for c in columns], *more)

    return docs.select(*needed, F.struct(*others).alias("rest")), back


def levels(counts: np.ndarray) -> np.ndarray:
    """Counts as one byte: exact up to 64, then eighths of a doubling. Keeps their order."""
    counts = counts.astype(np.float64)
    big = 64 + np.floor(8 * np.log2(np.maximum(counts, 64) / 64))
    return np.where(counts < 64, counts, np.minimum(big, 255)).astype(np.uint8)


CHUNK_BITS = 16
# Places counted at once; fewer than what two bytes hold, so that none passes its limit unseen.
COUNTED_AT_ONCE = 1 << 15


def count_in(counts: np.ndarray, found: np.ndarray) -> None:
    """Add 1 at each found place. Counts that pass what their type holds stay at its largest value."""
    for low in range(0, len(found), COUNTED_AT_ONCE):
        at = found[low:low + COUNTED_AT_ONCE]
        before = counts[at]
        np.add.at(counts, at, 1)
        counts[at[counts[at] < before]] = np.iinfo(counts.dtype).max


def counter_array(
    df: DataFrame, buckets: Callable[[pa.RecordBatch], Iterator[np.ndarray]], bits: int, exact: bool = False,
) -> np.ndarray:
    """How often each of ``2**bits`` buckets occurs in all rows: as ``levels``, or exactly.

    Each task counts into one array of fixed size and hands it on in compressed chunks; the
    chunks are added up in the shuffle. The driver gets ``2**bits`` bytes (eight times that if
    exact), whatever the input.
    """
    chunk_bits = min(bits, CHUNK_BITS)
    size, kind = 1 << chunk_bits, np.uint64 if exact else np.uint16

    def count(batches):
        counts = np.zeros(1 << bits, kind)
        for batch in batches:
            for found in buckets(batch):
                count_in(counts, found)
        packed = zstandard.ZstdCompressor(level=1)
        for chunk in range(1 << (bits - chunk_bits)):
            part = counts[chunk * size:(chunk + 1) * size]
            if part.any():
                data = packed.compress(part.tobytes())
                yield pa.RecordBatch.from_pydict({"chunk": pa.array([chunk], pa.int32()), "data": pa.array([data], pa.binary())})

    def add(batches):
        totals: dict[int, np.ndarray] = {}
        unpacked = zstandard.ZstdDecompressor()
        for batch in batches:
            for chunk, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                part = np.frombuffer(unpacked.decompress(data), kind)
                if chunk in totals:
                    totals[chunk] += part
                else:
                    totals[chunk] = part.astype(np.uint64)
        for chunk, total in totals.items():
            data = (total if exact else levels(total)).tobytes()
            yield pa.RecordBatch.from_pydict({"chunk": pa.array([chunk], pa.int32()), "data": pa.array([data], pa.binary())})

    parts = df.mapInArrow(count, "chunk int, data binary").repartition("chunk").mapInArrow(add, "chunk int, data binary")
    out = np.zeros(1 << bits, np.uint64 if exact else np.uint8)
    for row in parts.collect():
        out[row.chunk * size:(row.chunk + 1) * size] = np.frombuffer(row.data, out.dtype)
    return out


def _places(ids) -> np.ndarray:
    values = np.asarray(ids, np.int64).view(np.uint64)
    return (mixed(values) >> np.uint64(40)).astype(np.int64)


def rows_with_ids(docs: DataFrame, ids: DataFrame, column: str = "doc_id") -> DataFrame:
    """Semi-join of wide rows with a long list of ids (64-bit integers) that moves few of the wide rows.

    A bitmap of 2 MB, made from the ids, drops most rows without a partner where they lie; the join
    that follows drops the rest, so the result is exact at any size of the list.
    """
    ids = ids.select(F.col(column).cast("long").alias("_id")).filter("_id IS NOT NULL").distinct()

    def place(batch):
        yield _places(batch.column(0).to_numpy())

    bitmap = docs.sparkSession.sparkContext.broadcast(np.packbits(counter_array(ids, place, 24) > 0))

    @F.arrow_udf("boolean")
    def listed(keys: pa.Array) -> pa.Array:
        at = _places(keys.fill_null(0).to_numpy(zero_copy_only=False))
        return pa.array((bitmap.value[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool))

    kept = docs.filter(F.col(column).isNotNull()).filter(listed(F.col(column).cast("long")))
    # The same join at every size: a short list would be broadcast, a long one not.
    ids = ids.hint("shuffle_hash")
    return kept.join(ids, kept[column].cast("long") == ids["_id"], "left_semi")


NUMBER_BUCKETS = 256


def numbered(df: DataFrame, name: str, within: list[str], order: list[str], weight: str | None = None) -> DataFrame:
    """Rows with a gapless number from 0 (or the running sum of ``weight`` before the row) inside each ``within``.

    The order is by a hash bucket of ``order`` and then by ``order``, so no task gets a whole
    group: a group of any size is counted in ``NUMBER_BUCKETS`` pieces, and the pieces are put
    behind each other by their totals. Rows alike in ``order`` may change places.
    """
    amount = F.lit(1).cast("long") if weight is None else F.col(weight).cast("long")
    df = df.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(NUMBER_BUCKETS)).cast("int"))
    totals = df.groupBy(*within, "_bucket").agg(F.sum(amount).alias("_total"))
    before = Window.partitionBy(*within).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.withColumn("_before", F.coalesce(F.sum("_total").over(before), F.lit(0))).drop("_total")
    inside = Window.partitionBy(*within, "_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    df = df.withColumn("_inside", F.coalesce(F.sum(amount).over(inside), F.lit(0)))
    keys = [F.col(f"_l.{c}").eqNullSafe(F.col(f"_r.{c}")) for c in [*within, "_bucket"]]
    joined = df.alias("_l").join(totals.alias("_r"), keys)
    return joined.select(*[f"_l.{c}" for c in df.columns if c not in ("_bucket", "_inside")],
                         (F.col("_inside") + F.col("_before")).alias(name))


def components(edges: DataFrame) -> DataFrame:
    """Connected components of the edges (a, b): rows (id, root), root the smallest id; nodes with an edge only.

    Alternates large-star and small-star steps until the edges no longer change. Every step is
    a grouped minimum and a join, and its edges are written to the shared folder.
    """
    def stars(e: DataFrame) -> DataFrame:
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a != b").distinct()
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        lowest = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(lowest, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a != b")
        return small.union(lowest.select("a", F.col("m").alias("b"))).distinct()

    def mark(e: DataFrame):
        return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    now = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a != b").distinct(), "edges")
    seen = mark(now)
    while seen[0]:
        after = stored(stars(now), "edges")
        now, before, seen = after, seen, mark(after)
        if seen == before:
            break
    rooted = now.select(F.col("a").alias("id"), F.col("b").alias("root"))
    return rooted.union(rooted.select(F.col("root").alias("id"), "root")).distinct()
