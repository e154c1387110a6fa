"""Approximate nearest neighbours: inverted lists with product-quantised residuals, as tables.

``coarse_centroids`` (one row per list) and ``pq_codebooks`` (``m`` sub-spaces times
``2**n_bits`` codes) are model state, bounded by the configuration and sent to every task.
``ivf_postings`` has one row per vector and grows with the data; it is only ever scanned
in parallel.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioloom.functions.text import hash64
from folioloom.functions.vectors import list_column, matrix
from folioloom.operators.knn import (
    EXACT_ELEMENTS, PLACE_BYTES, QUERY_TILE, ROW_BYTES, Nearest, best_per_query, exact_distances, hits_batch, hits_schema, in_waves,
    near_pairs, nearest, nearest_of, rank_ids, rough_distances,
)
from folioloom.operators.lookup import between_years
from folioloom.schemas import COARSE_CENTROIDS, IVF_POSTINGS, PQ_CODEBOOKS, VECTOR_META, columns
from folioloom.sources.tables import append, scan

MAX_LISTS = 65_536
# Folders the postings are spread over: one per list, or several lists in one if there are more lists.
MAX_BANDS = 16_384
# Rows compared with all centroids at once.
ASSIGN_TILE = 1_024
# Bytes a wave of queries has for each list one of them probes.
PROBE_BYTES = 32
# Entries of distance tables a task keeps (64 MB).
MAX_KEPT_ENTRIES = 8_000_000
# Queries of a list from which on its codes are decoded once and compared by product; fewer of them look up their tables.
PRODUCT_QUERIES = 32
HIT_COLUMNS = ["faiss_id", "chunk_id", "year", "source"]


@dataclass(frozen=True)
class IVFPQConfig:
    n_lists: int
    m: int
    n_bits: int = 8
    dim: int = 1024
    seed: int = 42
    coarse_iterations: int = 20
    code_iterations: int = 10

    def __post_init__(self):
        if not 0 < self.n_lists <= MAX_LISTS:
            raise ValueError(f"n_lists has to lie in 1..{MAX_LISTS}")
        if self.m <= 0 or self.dim % self.m:
            raise ValueError("dim has to be a multiple of m")
        if not 1 <= self.n_bits <= 8:
            raise ValueError("n_bits has to lie in 1..8")

    @property
    def n_codes(self) -> int:
        return 2 ** self.n_bits

    @property
    def sub_dim(self) -> int:
        return self.dim // self.m

    @property
    def lists_per_band(self) -> int:
        return -(-self.n_lists // MAX_BANDS)


@dataclass(frozen=True)
class IVFPQIndex:
    config: IVFPQConfig
    centroids: DataFrame
    codebooks: DataFrame
    postings: DataFrame


def vector_meta(embeddings: DataFrame) -> DataFrame:
    """Numeric id and origin of every vector."""
    return embeddings.select(hash64(F.col("chunk_id")).alias("faiss_id"), "chunk_id", "doc_id", F.col("year").cast("int").alias("year"), "source")


def id_collisions(meta: DataFrame) -> DataFrame:
    """Numeric ids shared by several chunks."""
    return meta.groupBy("faiss_id").agg(F.min("chunk_id").alias("a"), F.max("chunk_id").alias("b")).filter(F.col("a") != F.col("b"))


# --- training -----------------------------------------------------------------------------


def train_coarse(sample: DataFrame, config: IVFPQConfig) -> DataFrame:
    """k-means over the training vectors; one centroid per list."""
    points = sample.select(array_to_vector(F.col("vector").cast("array<double>")).alias("features")).persist()
    try:
        if points.limit(config.n_lists).count() < config.n_lists:
            raise ValueError(f"training needs at least {config.n_lists} vectors")
        model = KMeans(k=config.n_lists, seed=config.seed, maxIter=config.coarse_iterations).fit(points)
    finally:
        points.unpersist()
    centers = [(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())]
    return sample.sparkSession.createDataFrame(centers, COARSE_CENTROIDS)


def model_rows(table: DataFrame, order: list[str], bound: int) -> np.ndarray:
    """Vectors of a model table in the given order; refuses a table beyond its bound."""
    rows = table.select(*order, "vector").limit(bound + 1).toArrow()
    if rows.num_rows > bound:
        raise ValueError(f"model table has more than {bound} rows")
    return matrix(rows.sort_by([(c, "ascending") for c in order])["vector"])


def list_vectors(centroids: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """List ids and their centroids."""
    rows = centroids.select("list_id", "vector").limit(MAX_LISTS + 1).toArrow().sort_by("list_id")
    if rows.num_rows > MAX_LISTS:
        raise ValueError(f"more than {MAX_LISTS} lists")
    return rows["list_id"].to_numpy(), matrix(rows["vector"])


def closest_lists(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row of the nearest centroid and its distance; of equally near ones the first."""
    rows, cols = [], []
    for lo in range(0, len(vectors), ASSIGN_TILE):
        rough, error = rough_distances(vectors[lo:lo + ASSIGN_TILE], centroids)
        r, c = np.nonzero(rough <= (rough.min(axis=1) + 2 * error)[:, None])
        rows.append(r + lo)
        cols.append(c)
    rows, cols = np.concatenate(rows), np.concatenate(cols)
    dist = exact_distances(vectors, centroids, rows, cols)
    by = np.lexsort((cols, dist, rows))
    first = by[np.r_[True, np.diff(rows[by]) > 0]]
    return cols[first], dist[first]


def assign_lists(vectors: DataFrame, centroids: DataFrame, payload: list[str]) -> DataFrame:
    """Nearest list of every vector: ``list_id, distance`` and the payload."""
    sent = vectors.sparkSession.sparkContext.broadcast(list_vectors(centroids))

    def run(batches):
        ids, centers = sent.value
        for batch in batches:
            if batch.num_rows:
                nearest_row, dist = closest_lists(matrix(batch["vector"]), centers)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[nearest_row], pa.int32()), pa.array(dist, pa.float32()), *batch.select(payload).columns],
                    names=["list_id", "distance", *payload])

    schema = T.StructType(
        [T.StructField("list_id", T.IntegerType()), T.StructField("distance", T.FloatType())]
        + [T.StructField(c, vectors.schema[c].dataType) for c in payload])
    return vectors.select(*payload, "vector").mapInArrow(run, schema)


def residuals(vectors: DataFrame, centroids: DataFrame) -> DataFrame:
    """Vectors minus the centroid of their list."""
    sent = vectors.sparkSession.sparkContext.broadcast(list_vectors(centroids)[1])

    def run(batches):
        centers = sent.value
        for batch in batches:
            if batch.num_rows:
                x = matrix(batch["vector"])
                yield pa.RecordBatch.from_arrays([list_column(x - centers[closest_lists(x, centers)[0]])], names=["vector"])

    return vectors.select("vector").mapInArrow(run, "vector ARRAY<FLOAT>")


def closest_codes(x: np.ndarray, books: np.ndarray) -> np.ndarray:
    """N x m codes of residuals; ``books`` is m x codes x sub_dim. In double precision, so that
    a code does not hang on which rows happen to share a batch."""
    m, _, sub = books.shape
    parts, books = x.astype(np.float64).reshape(len(x), m, sub), books.astype(np.float64)
    out = np.empty((len(x), m), dtype=np.uint8)
    for lo in range(0, len(x), ASSIGN_TILE):
        for j in range(m):
            rough, _ = rough_distances(parts[lo:lo + ASSIGN_TILE, j], books[j])
            out[lo:lo + ASSIGN_TILE, j] = rough.argmin(axis=1)
    return out


def train_codebooks(sample: DataFrame, centroids: DataFrame, config: IVFPQConfig) -> DataFrame:
    """Lloyd iterations for all sub-spaces at once, over all training vectors.

    Each task sums its vectors per (sub-space, code); Spark adds the sums up; only the new
    codebooks, whose size is fixed by the configuration, reach the driver.
    """
    spark = sample.sparkSession
    points = residuals(sample, centroids).persist()
    try:
        start = points.orderBy(F.xxhash64("vector", F.lit(config.seed)), "vector").limit(config.n_codes).toArrow()
        if start.num_rows < config.n_codes:
            raise ValueError(f"training needs at least {config.n_codes} vectors")
        books = matrix(start["vector"]).reshape(config.n_codes, config.m, config.sub_dim).transpose(1, 0, 2).copy()
        for _ in range(config.code_iterations):
            books = _move_codes(points, books)
    finally:
        points.unpersist()
    rows = [(j, c, [float(v) for v in books[j, c]]) for j in range(config.m) for c in range(config.n_codes)]
    return spark.createDataFrame(rows, PQ_CODEBOOKS)


def _move_codes(points: DataFrame, books: np.ndarray) -> np.ndarray:
    """Codebooks after one iteration; a code no vector is nearest to stays where it is."""
    m, n_codes, sub = books.shape
    sent = points.sparkSession.sparkContext.broadcast(books)

    def run(batches):
        current = sent.value
        count = np.zeros((m, n_codes), dtype=np.int64)
        total = np.zeros((m, n_codes, sub))
        for batch in batches:
            if batch.num_rows:
                x = matrix(batch["vector"])
                codes = closest_codes(x, current)
                for j in range(m):
                    count[j] += np.bincount(codes[:, j], minlength=n_codes)
                    np.add.at(total[j], codes[:, j], x[:, j * sub:(j + 1) * sub])
        j, c = np.nonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(j, pa.int32()), pa.array(c, pa.int32()), pa.array(count[j, c]), list_column(total[j, c])],
            names=["sub", "code", "n", "total"])

    sums = points.mapInArrow(run, "sub INT, code INT, n BIGINT, total ARRAY<DOUBLE>").groupBy("sub", "code").agg(
        F.sum("n").alias("n"), F.array(*[F.sum(F.col("total")[i]) for i in range(sub)]).alias("total"))
    moved = books.copy()
    rows = sums.toArrow()
    if rows.num_rows:
        at = rows["sub"].to_numpy(), rows["code"].to_numpy()
        moved[at] = matrix(rows["total"], np.float64) / rows["n"].to_numpy()[:, None]
    sent.unpersist()
    return moved


# --- encoding -----------------------------------------------------------------------------


def codebook_array(codebooks: DataFrame, config: IVFPQConfig) -> np.ndarray:
    flat = model_rows(codebooks, ["sub", "code"], config.m * config.n_codes)
    return flat.reshape(config.m, config.n_codes, config.sub_dim)


def binary_column(codes: np.ndarray) -> pa.Array:
    rows, width = codes.shape
    offsets = pa.py_buffer((np.arange(rows + 1, dtype=np.int32) * width).tobytes())
    return pa.Array.from_buffers(pa.binary(), rows, [None, offsets, pa.py_buffer(codes.tobytes())])


def code_matrix(column: pa.Array, width: int) -> np.ndarray:
    rows = len(column)
    first = column.offset * width
    return np.frombuffer(column.buffers()[2], dtype=np.uint8)[first:first + rows * width].reshape(rows, width)


def encode(vectors: DataFrame, centroids: DataFrame, codebooks: DataFrame, config: IVFPQConfig) -> DataFrame:
    """Postings of all vectors (``chunk_id, year, source, vector``). Narrow: no shuffle."""
    sent = vectors.sparkSession.sparkContext.broadcast(
        (*list_vectors(centroids), codebook_array(codebooks, config)))
    meta = ["faiss_id", "chunk_id", "year", "source"]

    def run(batches):
        ids, centers, books = sent.value
        for batch in batches:
            if batch.num_rows:
                x = matrix(batch["vector"])
                row, _ = closest_lists(x, centers)
                codes = closest_codes(x - centers[row], books)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[row], pa.int32()), *batch.select(meta).columns, binary_column(codes)],
                    names=["list_id", *meta, "codes"])

    read = vectors.select(
        hash64(F.col("chunk_id")).alias("faiss_id"), "chunk_id", F.col("year").cast("int").alias("year"), "source", "vector")
    coded = read.mapInArrow(run, "list_id INT, faiss_id BIGINT, chunk_id STRING, year INT, source STRING, codes BINARY")
    return coded.withColumn("list_band", F.floor(F.col("list_id") / config.lists_per_band).cast("int")).select(*columns(IVF_POSTINGS))


def build_index(embeddings: DataFrame, config: IVFPQConfig, sample: DataFrame | None = None) -> IVFPQIndex:
    """Train on ``sample`` (all vectors by default) and encode every vector."""
    training = embeddings if sample is None else sample
    centroids = train_coarse(training, config)
    codebooks = train_codebooks(training, centroids, config)
    return IVFPQIndex(config, centroids, codebooks, encode(embeddings, centroids, codebooks, config))


def write_index(index: IVFPQIndex, path: str) -> None:
    """Postings by band of lists, sorted by list inside the files; model tables in one file each."""
    append(index.postings, f"{path}/ivf_postings", keys=["list_band"], mode="overwrite", sort_by=["list_id"])
    index.centroids.coalesce(1).write.mode("overwrite").parquet(f"{path}/coarse_centroids")
    index.codebooks.coalesce(1).write.mode("overwrite").parquet(f"{path}/pq_codebooks")


def read_index(spark: SparkSession, path: str, config: IVFPQConfig) -> IVFPQIndex:
    return IVFPQIndex(
        config,
        scan(spark, f"{path}/coarse_centroids", COARSE_CENTROIDS),
        scan(spark, f"{path}/pq_codebooks", PQ_CODEBOOKS),
        scan(spark, f"{path}/ivf_postings", IVF_POSTINGS),
    )


def write_vector_meta(embeddings: DataFrame, path: str) -> None:
    append(vector_meta(embeddings), path, mode="overwrite", sort_by=["faiss_id"])


def read_vector_meta(spark: SparkSession, path: str) -> DataFrame:
    return scan(spark, path, VECTOR_META)


# --- search -------------------------------------------------------------------------------


def probe_lists(queries: DataFrame, centroids: DataFrame, n_probe: int) -> DataFrame:
    """The ``n_probe`` nearest lists of each query: ``query_id, list_id, distance, rank``."""
    return nearest(queries, centroids, n_probe, id_column="list_id")


def distance_table(residual: np.ndarray, books: np.ndarray) -> np.ndarray:
    """m x codes squared distances of one query residual to every code."""
    m, _, sub = books.shape
    return np.square(residual.reshape(m, 1, sub).astype(np.float64) - books).sum(axis=2)


class ListTables:
    """Distance tables of the queries of one list, kept from batch to batch where they are small."""

    def __init__(self, residuals: np.ndarray, books: np.ndarray):
        self.residuals, self.books = residuals, books
        small = len(residuals) * books.shape[0] * books.shape[1] <= MAX_KEPT_ENTRIES
        self.kept = [distance_table(r, books) for r in residuals] if small else None

    def __iter__(self):
        return iter(self.kept) if self.kept is not None else (distance_table(r, self.books) for r in self.residuals)


def score_list(tables: ListTables, codes: np.ndarray, near: Nearest, query_rows: np.ndarray):
    """Candidates of one list for its queries: (query, row in ``codes``, distance) arrays.

    Per query only rows within its current limit, and within the k best of this list, are kept.
    """
    sub = np.arange(codes.shape[1])
    found = []
    for table, query in zip(tables, query_rows):
        dist = table[sub, codes].sum(axis=1).astype(np.float32)
        limit = near.limit()[query]
        if near.k <= len(dist):
            limit = min(limit, np.partition(dist, near.k - 1)[near.k - 1])
        rows = np.flatnonzero(dist <= limit)
        found.append((np.full(len(rows), query), rows, dist[rows]))
    return tuple(np.concatenate(part) for part in zip(*found))


def code_distances(residuals: np.ndarray, decoded: np.ndarray, m: int, rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
    """Distances by code of the given pairs, added up as the tables of ``distance_table`` are."""
    out = np.empty(len(rows), dtype=np.float32)
    step = max(1, EXACT_ELEMENTS // residuals.shape[1])
    for lo in range(0, len(rows), step):
        diff = residuals[rows[lo:lo + step]].astype(np.float64) - decoded[cols[lo:lo + step]]
        out[lo:lo + step] = np.square(diff).reshape(len(diff), m, -1).sum(axis=2).sum(axis=1)
    return out


def score_decoded(residuals: np.ndarray, books: np.ndarray, codes: np.ndarray, near: Nearest, query_rows: np.ndarray):
    """``score_list`` for many queries: by a product with what the codes stand for, and by code for the pairs that may count."""
    m = books.shape[0]
    decoded = books[np.arange(m), codes].reshape(len(codes), -1)
    found = []
    for lo in range(0, len(query_rows), QUERY_TILE):
        tile, places = residuals[lo:lo + QUERY_TILE], query_rows[lo:lo + QUERY_TILE]
        rows, cols = near_pairs(tile, decoded, near.limit()[places], near.k)
        found.append((places[rows], cols, code_distances(tile, decoded, m, rows, cols)))
    return tuple(np.concatenate(part) for part in zip(*found))


def search(
    index: IVFPQIndex, queries: DataFrame, n: int = 10,
    year_min: int | None = None, year_max: int | None = None, n_probe: int = 64, wave_rows: int | None = None,
) -> DataFrame:
    """n nearest vectors per query within the probed lists and the year range.

    The years are filtered before ranking, so a narrow range still fills n where it can. Any number of queries is
    answered in waves (see ``knn.in_waves``); the postings stay where they lie.
    Returns ``query_id, distance, rank, faiss_id, chunk_id, year, source``.
    """
    queries = queries.select("query_id", "vector")
    return in_waves(queries, _wave_search(index, queries, n, year_min, year_max, n_probe), _bytes_per_query(n, n_probe), wave_rows)


def _bytes_per_query(n: int, n_probe: int) -> int:
    return ROW_BYTES + PLACE_BYTES * n + PROBE_BYTES * n_probe


def _wave_search(
    index: IVFPQIndex, queries: DataFrame, n: int, year_min: int | None, year_max: int | None, n_probe: int,
) -> Callable[[pa.Table], tuple[DataFrame, list]]:
    """What ``search`` finds for one wave of the queries, and its broadcasts."""
    postings = between_years(index.postings, year_min, year_max)
    schema = hits_schema(queries, postings, HIT_COLUMNS)
    probed = hits_schema(queries, index.centroids, ["list_id"])
    books = codebook_array(index.codebooks, index.config)

    def run(wave: pa.Table) -> tuple[DataFrame, list]:
        probes, sent = nearest_of(wave, index.centroids, n_probe, "list_id", ["list_id"], probed)
        found = probes.select("query_id", "list_id").toArrow()
        hits, also = _search_wave(index, wave, found, postings, books, n, schema)
        return best_per_query(hits, n, "chunk_id"), [*sent, *also]

    return run


def refine(candidates: DataFrame, vectors: DataFrame, queries: DataFrame, n: int) -> DataFrame:
    """The n nearest candidates per query by the distance of the vectors themselves: the columns of ``candidates``, distance and rank anew.

    Candidates meet the stored vectors by (year, source, chunk_id): folders without a candidate are pruned while the query runs, and
    the distances are worked out where the vectors lie. A candidate without a stored vector is left out.
    """
    keys = ["year", "source", "chunk_id"]
    stored = vectors.select(F.col("year").cast("int").alias("year"), "source", "chunk_id", F.col("vector").alias("stored"))
    asked = candidates.drop("distance", "rank").join(stored, keys).join(queries.select("query_id", "vector"), "query_id")
    rest = [c for c in candidates.columns if c not in ("query_id", "distance", "rank")]

    @F.arrow_udf("float")
    def distance(left: pa.Array, right: pa.Array) -> pa.Array:
        every = np.arange(len(left))
        return pa.array(exact_distances(matrix(left), matrix(right), every, every) if len(left) else [], pa.float32())

    measured = asked.select("query_id", distance("vector", "stored").alias("distance"), *rest)
    return best_per_query(measured, n, "chunk_id")


def refined_search(
    index: IVFPQIndex, vectors: DataFrame, queries: DataFrame, n: int = 10,
    year_min: int | None = None, year_max: int | None = None, n_probe: int = 64, factor: int = 8, wave_rows: int | None = None,
) -> DataFrame:
    """``search`` in two stages: ``factor * n`` candidates per query by their codes, of these the n nearest by their vectors.

    Both stages are done for one wave of queries after another, so the candidates of all queries are never there at once.
    ``vectors`` are the indexed embeddings with year, source, chunk_id and vector. Columns as in ``search``; the distance is the exact one.
    """
    if factor < 1:
        raise ValueError("factor is 1 or more")
    queries, stored = queries.select("query_id", "vector"), between_years(vectors, year_min, year_max)
    near = _wave_search(index, queries, n * factor, year_min, year_max, n_probe)

    def run(wave: pa.Table) -> tuple[DataFrame, list]:
        candidates, sent = near(wave)
        asked = F.broadcast(queries.sparkSession.createDataFrame(wave, queries.schema))
        return refine(candidates, stored, asked, n), sent

    return in_waves(queries, run, _bytes_per_query(n * factor, n_probe), wave_rows)


def queries_by_list(wave: pa.Table, probes: pa.Table) -> dict[int, np.ndarray]:
    """For each probed list the rows of ``wave`` that probe it, in their order."""
    places = pc.index_in(probes["query_id"], value_set=wave["query_id"].combine_chunks()).to_numpy()
    lists = probes["list_id"].to_numpy()
    by = np.lexsort((places, lists))
    places, lists = places[by], lists[by]
    cuts = np.flatnonzero(np.diff(lists)) + 1
    return {int(lists[low]): places[low:high] for low, high in zip([0, *cuts], [*cuts, len(lists)]) if high > low}


def _search_wave(
    index: IVFPQIndex, wave: pa.Table, probes: pa.Table, postings: DataFrame, books: np.ndarray, n: int, schema: T.StructType,
) -> tuple[DataFrame, list]:
    """Candidates of one wave of queries, whose probes and residual bases go to every task; and its broadcast."""
    spark = postings.sparkSession
    by_list = queries_by_list(wave, probes)
    ids, centers = list_vectors(index.centroids)
    bases = {i: centers[row] for row, i in enumerate(ids.tolist()) if i in by_list}
    sent = spark.sparkContext.broadcast((
        wave["query_id"].combine_chunks(), matrix(wave["vector"]), by_list, bases, books))
    bands = sorted({i // index.config.lists_per_band for i in by_list})
    wanted = F.broadcast(spark.createDataFrame([(i,) for i in sorted(by_list)], "list_id INT"))
    probed = postings.filter(F.col("list_band").isin(bands)).join(wanted, "list_id", "left_semi")

    def run(batches):
        query_ids, queries, probed_by, base, code_books = sent.value
        near = Nearest(len(queries), n)
        tables: dict[int, ListTables] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            codes = code_matrix(batch["codes"], code_books.shape[0])
            lists = batch["list_id"].to_numpy()
            found = []
            for list_id in np.unique(lists).tolist():
                rows = np.flatnonzero(lists == list_id)
                query_rows = probed_by[list_id]
                if len(query_rows) >= PRODUCT_QUERIES:
                    query, at, dist = score_decoded(queries[query_rows] - base[list_id], code_books, codes[rows], near, query_rows)
                else:
                    if list_id not in tables:
                        # files are sorted by list, so the tables of the last list are enough
                        tables = {list_id: ListTables(queries[query_rows] - base[list_id], code_books)}
                    query, at, dist = score_list(tables[list_id], codes[rows], near, query_rows)
                found.append((query, rows[at], dist))
            query, cols, dist = (np.concatenate(part) for part in zip(*found))
            yield hits_batch(query_ids, batch, HIT_COLUMNS, *near.admit(query, cols, dist, rank_ids(batch["chunk_id"])))

    return probed.select("list_id", *HIT_COLUMNS, "codes").mapInArrow(run, schema), [sent]
