"""Exact nearest neighbours by squared L2 distance.

Each task compares its vectors with a wave of queries by matrix product and hands on only
rows that can be among the k nearest of a query; a window then picks the k best per query.
No table of all pairs is built, and no vector moves.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioloom.functions.vectors import matrix
from folioloom.session import new_folder, shuffles_dropped

# Bytes of queries, with what is kept for each of them, that go to every task at once.
WAVE_BYTES = 32 << 20
# Query rows of one stored file; waves are made up of whole files.
FILE_ROWS = 4_096
# Bytes kept for a query besides its vector: its id, and three arrays for each of its k best distances.
ROW_BYTES, PLACE_BYTES = 64, 24
# Query rows compared at once, which bounds the distance matrix of an Arrow batch.
QUERY_TILE = 256
# Elements of the exact re-computation held at once.
EXACT_ELEMENTS = 4_000_000


class Nearest:
    """The k smallest distances seen so far, for each query of a block."""

    def __init__(self, n_queries: int, k: int):
        self.k = k
        self.best = np.full((n_queries, k), np.inf, dtype=np.float32)

    def limit(self) -> np.ndarray:
        return self.best[:, -1]

    def admit(self, queries: np.ndarray, cols: np.ndarray, dist: np.ndarray, order: np.ndarray):
        """Of the candidates (query, batch row, distance), those still among the k best.

        ``order`` ranks the batch rows by id and decides between equal distances.
        """
        by = np.lexsort((order[cols], dist, queries))
        queries, cols, dist = queries[by], cols[by], dist[by]
        starts = np.flatnonzero(np.r_[True, queries[1:] != queries[:-1]]) if len(queries) else np.empty(0, int)
        place = np.arange(len(queries)) - np.repeat(starts, np.diff(np.r_[starts, len(queries)]))
        first = place < self.k
        queries, cols, dist, place = queries[first], cols[first], dist[first], place[first]
        seen = np.full_like(self.best, np.inf)
        seen[queries, place] = dist
        self.best = np.sort(np.concatenate([self.best, seen], axis=1), axis=1)[:, : self.k]
        alive = dist <= self.limit()[queries]
        return queries[alive], cols[alive], dist[alive]


def exact_distances(a: np.ndarray, b: np.ndarray, rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
    """Squared L2 distance of the given pairs, summed in double precision."""
    out = np.empty(len(rows), dtype=np.float32)
    step = max(1, EXACT_ELEMENTS // max(1, a.shape[1]))
    for lo in range(0, len(rows), step):
        diff = a[rows[lo:lo + step]].astype(np.float64) - b[cols[lo:lo + step]]
        out[lo:lo + step] = np.square(diff).sum(axis=1)
    return out


def rough_distances(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squared L2 distances by one single-precision product, and a bound on the error per row of ``a``."""
    a2 = np.square(a).sum(axis=1)
    b2 = np.square(b).sum(axis=1)
    rough = a2[:, None] + b2[None, :] - 2 * (a @ b.T)
    error = (a.shape[1] + 8) * 2.0 ** -22 * (a2 + (b2.max() if len(b2) else 0))
    return rough, error


def near_pairs(tile: np.ndarray, vectors: np.ndarray, limit: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row of the tile, row of the vectors) of all pairs that can be within the limits and among the k nearest of the vectors."""
    rough, error = rough_distances(tile, vectors)
    limit = limit + error
    if k <= len(vectors):
        limit = np.minimum(limit, np.partition(rough, k - 1, axis=1)[:, k - 1] + 2 * error)
    return np.nonzero(rough <= limit[:, None])


def scan_batch(queries: np.ndarray, vectors: np.ndarray, order: np.ndarray, near: Nearest):
    """Candidates of one batch: (query, batch row, distance) arrays."""
    found = []
    for lo in range(0, len(queries), QUERY_TILE):
        tile = queries[lo:lo + QUERY_TILE]
        rows, cols = near_pairs(tile, vectors, near.limit()[lo:lo + QUERY_TILE], near.k)
        found.append((rows + lo, cols, exact_distances(tile, vectors, rows, cols)))
    rows, cols, dist = (np.concatenate(part) for part in zip(*found))
    return near.admit(rows, cols, dist, order)


def rank_ids(ids: pa.Array) -> np.ndarray:
    return pc.rank(ids, sort_keys="ascending", tiebreaker="dense").to_numpy(zero_copy_only=False)


def hits_batch(query_ids: pa.Array, batch: pa.RecordBatch, payload: list[str], rows, cols, dist) -> pa.RecordBatch:
    taken = batch.select(payload).take(pa.array(cols))
    return pa.RecordBatch.from_arrays(
        [query_ids.take(pa.array(rows)), pa.array(dist, pa.float32()), *taken.columns],
        names=["query_id", "distance", *payload],
    )


def hits_schema(queries: DataFrame, vectors: DataFrame, payload: list[str]) -> T.StructType:
    return T.StructType(
        [T.StructField("query_id", queries.schema["query_id"].dataType), T.StructField("distance", T.FloatType())]
        + [T.StructField(c, vectors.schema[c].dataType) for c in payload]
    )


def waves_of(files: list[tuple[str, int]], rows: int) -> list[list[str]]:
    """Files (name, rows) put together into waves of at most ``rows`` rows, or of one file."""
    waves, held = [], 0
    for name, n in sorted(files, key=lambda f: (-f[1], f[0])):
        if not waves or held + n > rows:
            waves.append([])
            held = 0
        waves[-1].append(name)
        held += n
    return waves


def in_waves(
    queries: DataFrame, run: Callable[[pa.Table], tuple[DataFrame, list]], per_query: int, wave_rows: int | None = None,
) -> DataFrame:
    """What ``run`` finds for all queries, some of them at a time.

    A wave has at most WAVE_BYTES: the vectors of its queries and ``per_query`` bytes for each. It goes to every task, and the
    searched table stays where it lies. ``run`` gives the rows of a wave and its broadcasts. Queries that fill one wave are answered
    lazily. More of them are written to the shared folder first, in files of bounded rows; each wave's rows are written, and what it
    shuffled is dropped, before the next one starts, so the driver, the tasks and the disk hold one wave, however many queries there
    are. ``wave_rows`` replaces the bound.
    """
    spark = queries.sparkSession
    head = queries.limit(FILE_ROWS + 1).toArrow()
    dim = len(head["vector"][0]) if head.num_rows and head["vector"][0].is_valid else 0
    rows = wave_rows or max(1, WAVE_BYTES // (4 * dim + per_query))
    file_rows = min(rows, FILE_ROWS)
    if head.num_rows <= file_rows:
        return run(head)[0]
    asked, answered = new_folder(spark, "queries"), new_folder(spark, "hits")
    queries.write.option("maxRecordsPerFile", file_rows).parquet(asked)
    stored = spark.read.schema(queries.schema).parquet(asked)
    files = [tuple(r) for r in stored.groupBy(F.col("_metadata.file_path")).count().collect()]
    for names in waves_of(files, rows):
        with shuffles_dropped(spark):
            found, sent = run(spark.read.schema(queries.schema).parquet(*names).toArrow())
            found.write.mode("append").parquet(answered)
        for broadcast in sent:
            broadcast.destroy()
    return spark.read.schema(found.schema).parquet(answered)


def best_per_query(hits: DataFrame, k: int, tie: str) -> DataFrame:
    """The k nearest per query with their ``rank``; equal distances are ordered by id.

    Spark limits each task to k rows per query before it shuffles.
    """
    order = Window.partitionBy("query_id").orderBy("distance", tie)
    return hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def nearest(
    queries: DataFrame, vectors: DataFrame, k: int, id_column: str = "chunk_id", payload: list[str] | None = None,
    wave_rows: int | None = None,
) -> DataFrame:
    """k nearest vectors of each query: ``query_id, distance, rank`` and the payload columns.

    ``queries`` has ``query_id, vector``; ``vectors`` has ``vector`` and the payload, which
    holds the unique ``id_column``. Fewer than k rows come back where there are fewer vectors.
    Any number of queries goes through the vectors in waves (see ``in_waves``). A query without a vector has no distance to any
    of them, and is given the first ids.
    """
    if k <= 0:
        raise ValueError("k has to be positive")
    payload = payload or [id_column]
    queries = queries.select("query_id", "vector")
    schema = hits_schema(queries, vectors, payload)

    def run(wave: pa.Table) -> tuple[DataFrame, list]:
        blank = pc.is_null(wave["vector"])
        found, sent = nearest_of(wave.filter(pc.invert(blank)), vectors, k, id_column, payload, schema)
        if pc.any(blank).as_py():
            found = found.unionByName(first_of(wave.filter(blank).select(["query_id"]), vectors, k, id_column, payload))
        return found, sent

    return in_waves(queries, run, ROW_BYTES + PLACE_BYTES * k, wave_rows)


def first_of(asked: pa.Table, vectors: DataFrame, k: int, id_column: str, payload: list[str]) -> DataFrame:
    """The first k ids for each query, at no distance, as ``nearest`` has them."""
    order = F.asc_nulls_last(id_column)
    first = vectors.select(*payload).orderBy(order).limit(k).withColumn("rank", F.row_number().over(Window.orderBy(order)))
    blank = vectors.sparkSession.createDataFrame(asked)
    return blank.crossJoin(F.broadcast(first)).withColumn("distance", F.lit(None).cast("float"))


def nearest_of(
    wave: pa.Table, vectors: DataFrame, k: int, id_column: str, payload: list[str], schema: T.StructType,
) -> tuple[DataFrame, list]:
    """``nearest`` for the queries of one wave, and its broadcast."""
    sent = vectors.sparkSession.sparkContext.broadcast((wave["query_id"].combine_chunks(), matrix(wave["vector"])))

    def run(batches):
        query_ids, queries = sent.value
        near = Nearest(len(queries), k)
        for batch in batches:
            if not batch.num_rows or not len(queries):
                continue
            rows, cols, dist = scan_batch(queries, matrix(batch["vector"]), rank_ids(batch[id_column]), near)
            yield hits_batch(query_ids, batch, payload, rows, cols, dist)

    return best_per_query(vectors.select(*payload, "vector").mapInArrow(run, schema), k, id_column), [sent]
