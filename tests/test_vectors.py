import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from folioloom.functions import vectors as vx
from folioloom.operators import ann, embedding, knn, semantic
from folioloom.registry import inputs
from folioloom.session import new_folder

VEC = "chunk_id STRING, doc_id STRING, year INT, source STRING, vector ARRAY<FLOAT>"


def make(spark, x, parts=4):
    rows = [(f"v{i:04d}", f"d{i % 7}", 1800 + i % 10, f"s{i % 3}", [float(v) for v in row]) for i, row in enumerate(x)]
    return spark.createDataFrame(rows, VEC).repartition(parts, "chunk_id")


def asked(spark, q):
    return spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(q)], "query_id BIGINT, vector ARRAY<FLOAT>")


def brute(q, x, k, allowed=None):
    q, x = q.astype(np.float32).astype(np.float64), x.astype(np.float32).astype(np.float64)
    d = np.square(q[:, None] - x[None]).sum(axis=2).astype(np.float32)
    out = []
    for row in d:
        order = sorted((v, f"v{i:04d}") for i, v in enumerate(row) if allowed is None or allowed(i))
        out.append([name for _, name in order[:k]])
    return out


def found(hits):
    got = {}
    for r in sorted(hits.collect(), key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append(r.chunk_id)
    return got


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(7)
    x = rng.normal(size=(700, 16)).astype(np.float32)
    x[100:330] = x[100]  # a third of the vectors are copies of one
    return x, np.concatenate([x[[5, 100, 640]], rng.normal(size=(20, 16)).astype(np.float32)])


def test_exact_search_equals_brute_force(spark, data):
    x, q = data
    want = brute(q, x, 12)
    for parts in (1, 5):
        got = found(knn.nearest(asked(spark, q), make(spark, x, parts), 12))
        assert [got[i] for i in range(len(q))] == want


def test_waves_give_what_one_wave_gives(spark, data):
    x, q = data
    want = brute(q, x, 12)
    for rows in (1, 6, len(q) - 1, len(q)):
        got = found(knn.nearest(asked(spark, q).repartition(3), make(spark, x), 12, wave_rows=rows))
        assert [got[i] for i in range(len(q))] == want


def test_waves_are_bounded_in_bytes(spark, data, monkeypatch):
    """With room for five queries of 16 components, every pass over the vectors has five at most, and all queries are answered."""
    x, q = data
    sizes, one = [], knn.nearest_of
    monkeypatch.setattr(knn, "WAVE_BYTES", 5 * (4 * 16 + knn.ROW_BYTES + 12 * knn.PLACE_BYTES))
    monkeypatch.setattr(knn, "nearest_of", lambda wave, *rest: sizes.append(wave.num_rows) or one(wave, *rest))
    got = found(knn.nearest(asked(spark, q), make(spark, x), 12))
    assert [got[i] for i in range(len(q))] == brute(q, x, 12)
    assert sum(sizes) == len(q) and max(sizes) <= 5 and len(sizes) > 4


def test_waves_are_whole_files():
    files = [("c", 3), ("a", 5), ("b", 3), ("d", 2), ("e", 9)]
    waves = knn.waves_of(files, 6)
    assert sorted(f for w in waves for f in w) == list("abcde")
    assert all(len(w) == 1 or sum(dict(files)[f] for f in w) <= 6 for w in waves)
    assert knn.waves_of([], 6) == []


def test_vectors_do_not_move(spark, data):
    """The searched table is read and compared where it lies: nothing is exchanged below the step in Python."""
    x, q = data
    plan = knn.nearest(asked(spark, q), make(spark, x).select("*"), 3)._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("MapInArrow"):]
    assert "Join" not in plan and "Generate" not in plan and "Aggregate" not in below


def test_no_queries_and_no_vectors(spark, data):
    x, q = data
    assert knn.nearest(asked(spark, q[:0]), make(spark, x), 3).count() == 0
    assert knn.nearest(asked(spark, q), make(spark, x[:0], 1), 3, wave_rows=9).count() == 0


def test_fewer_vectors_than_asked_for(spark, data):
    x, q = data
    got = found(knn.nearest(asked(spark, q[:2]), make(spark, x[:4]), 10))
    assert [got[i] for i in range(2)] == brute(q[:2], x[:4], 10)


def test_year_range_is_applied_before_ranking(spark, data):
    x, q = data
    for low, high, allowed in ((1803, 1805, range(3, 6)), (1808, None, range(8, 10)), (None, 1801, range(0, 2)), (None, None, range(10))):
        got = found(semantic.exact_search(make(spark, x), asked(spark, q), 9, low, high))
        assert [got[i] for i in range(len(q))] == brute(q, x, 9, lambda i: i % 10 in allowed)


def test_one_open_bound_has_its_default(spark, data):
    x, q = data
    rows = make(spark, x).withColumn("year", F.when(F.col("chunk_id") == "v0005", 9999).otherwise(F.col("year")))
    assert found(semantic.exact_search(rows, asked(spark, q), 1, 1800, None))[0] == ["v0005"]
    assert found(semantic.exact_search(rows, asked(spark, q), 1, 1800, 1900))[0] != ["v0005"]


def test_padding_and_meta(spark, data):
    x, q = data
    rows = make(spark, x[:3])
    hits = knn.nearest(asked(spark, q[:1]), rows, 5).withColumn("faiss_id", ann.hash64(F.col("chunk_id")))
    padded = semantic.pad_hits(hits, asked(spark, q[:1]), 5)
    got = semantic.attach_meta(padded, ann.vector_meta(rows), few=True).orderBy("rank").collect()
    assert [r.labels == -1 for r in got] == [False] * 3 + [True] * 2
    assert [r.chunk_id is None for r in got] == [False] * 3 + [True] * 2
    assert got[4].distances == pytest.approx(3.4028234663852886e38)


def test_chunks_that_share_a_label_are_told_apart(spark, data):
    x, q = data
    rows = make(spark, x[:3])
    hits = knn.nearest(asked(spark, q[:1]), rows, 3).withColumn("faiss_id", F.lit(7).cast("bigint"))
    meta = ann.vector_meta(rows).withColumn("faiss_id", F.lit(7).cast("bigint"))
    got = semantic.attach_meta(semantic.pad_hits(hits, asked(spark, q[:1]), 3), meta).collect()
    assert len(got) == 3 and len({r.chunk_id for r in got}) == 3


def test_vector_expressions(spark):
    row = spark.sql("SELECT array(3D, 4D) AS v, array(0D, 0D) AS z, array(array(1D, 2D), array(3D, 6D), array(9D, 9D)) AS h, array(1, 1, 0) AS m, array(0, 0, 0) AS n").select(
        vx.l2_normalize(F.col("v")).alias("v"), vx.l2_normalize(F.col("z")).alias("z"),
        vx.masked_mean_pool(F.col("h"), F.col("m")).alias("pooled"), vx.masked_mean_pool(F.col("h"), F.col("n")).alias("nothing")).first()
    assert row.v == [0.6, 0.8] and row.z == [0.0, 0.0] and row.pooled == [2.0, 4.0] and row.nothing == [0.0, 0.0]


def test_check_vectors(spark):
    rows = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0]), (3, None), (4, [1.0, float("nan")]), (5, [1.0, None])], "n INT, vector ARRAY<FLOAT>")
    good, bad = embedding.check_vectors(rows, 2)
    assert [r.n for r in good.collect()] == [1]
    assert sorted(r.n for r in bad.collect()) == [2, 3, 4, 5]


def test_hash_encoder_has_unit_vectors_and_looks_at_512_tokens(spark):
    encoder = embedding.HashEncoder()
    head = " ".join(f"w{i}" for i in range(509))
    rows = spark.createDataFrame([("a", head), ("b", head + " more words beyond"), ("c", ""), ("d", "river")], "query_id STRING, text STRING")
    got = {r.query_id: np.array(r.vector) for r in embedding.embed_queries(rows, encoder).collect()}
    assert np.array_equal(got["a"], got["b"])
    assert all(abs(np.linalg.norm(v) - 1) < 1e-6 for v in got.values())


def test_passages_and_queries_differ_by_prefix(spark):
    rows = spark.createDataFrame([("a", "d", 1800, "s", "river sea")], "chunk_id STRING, doc_id STRING, year INT, source STRING, text STRING")
    encoder = embedding.HashEncoder(name="h")
    passage = embedding.embed_chunks(rows, encoder).first()
    query = embedding.embed_queries(rows.withColumnRenamed("chunk_id", "query_id"), encoder).first()
    assert passage.vector != query.vector and (passage.model, passage.dim) == ("h", 64)


def test_encode_ids_pools_under_the_mask():
    def states(ids, mask):
        return np.stack([ids, ids * 0 + 1], axis=2).astype(np.float32)

    got = embedding.encode_ids(states, [[3, 5], [2]], 4)
    want = np.array([[4, 1], [2, 1]], dtype=np.float64)
    assert np.allclose(got, want / np.linalg.norm(want, axis=1, keepdims=True), atol=1e-6)
    assert embedding.encode_ids(states, [[]], 4).tolist() == [[0.0, 0.0]]


def field(number, value):
    """One protobuf field: a varint for a number, else length and bytes."""
    def varint(n):
        out = bytearray()
        while n > 127:
            out.append(n & 127 | 128)
            n >>= 7
        return bytes([*out, n])

    if isinstance(value, int):
        return varint(number << 3) + varint(value)
    value = value.encode() if isinstance(value, str) else value
    return varint(number << 3 | 2) + varint(len(value)) + value


def lookup_model(table):
    """An ONNX model whose token states are rows of ``table``, picked by id."""
    def info(name, kind, axes):
        shape = b"".join(field(1, field(2, a) if isinstance(a, str) else field(1, a)) for a in axes)
        return field(1, name) + field(2, field(1, field(1, kind) + field(2, shape)))

    rows, dim = table.shape
    weights = field(1, rows) + field(1, dim) + field(2, 1) + field(8, "table") + field(9, table.astype("<f4").tobytes())
    node = field(1, "table") + field(1, "input_ids") + field(2, "last_hidden_state") + field(4, "Gather")
    graph = (field(1, node) + field(2, "g") + field(5, weights) + field(11, info("input_ids", 7, ["n", "t"]))
             + field(12, info("last_hidden_state", 1, ["n", "t", dim])))
    return field(1, 8) + field(7, graph) + field(8, field(1, "") + field(2, 13))


def test_a_real_model_runs_in_the_workers(spark, tmp_path, word_pieces):
    from folioloom.functions.tokens import ModelTokenizer

    table = np.random.default_rng(3).normal(size=(word_pieces.get_vocab_size(), 6)).astype(np.float32)
    path = tmp_path / "model.onnx"
    path.write_bytes(lookup_model(table))
    encoder = embedding.OnnxEncoder(str(path), ModelTokenizer(word_pieces.to_str()), 6, "lookup", max_tokens=12, batch=2)
    texts = ["the river", "the sea and the town", "", "river " * 40, "down"]
    rows = spark.createDataFrame([(str(n), "d", 1800, "s", t) for n, t in enumerate(texts)], "chunk_id STRING, doc_id STRING, year INT, source STRING, text STRING")
    got = {r.chunk_id: r for r in embedding.embed_chunks(rows, encoder).collect()}
    word_pieces.enable_truncation(12)
    for n, text in enumerate(texts):
        mean = table[word_pieces.encode(f"passage: {text}").ids].astype(np.float64).mean(axis=0)
        assert np.allclose(got[str(n)].vector, mean / np.linalg.norm(mean), atol=1e-5)
        assert (got[str(n)].dim, got[str(n)].model) == (6, "lookup")
    word_pieces.no_truncation()


# --- approximate search -------------------------------------------------------------------

CONFIG = ann.IVFPQConfig(n_lists=8, m=8, n_bits=6, dim=16, coarse_iterations=8, code_iterations=6)


@pytest.fixture(scope="module")
def built(spark, data):
    from folioloom.session import new_folder

    rows = make(spark, data[0]).persist()
    path = new_folder(spark, "index")
    ann.write_index(ann.build_index(rows, CONFIG), path)
    return rows, ann.read_index(spark, path, CONFIG)


def test_every_vector_is_posted_once(built):
    rows, index = built
    assert index.postings.count() == rows.count() == index.postings.select("chunk_id").distinct().count()
    assert index.postings.select(F.octet_length("codes")).distinct().collect()[0][0] == 8
    assert index.codebooks.count() == 8 * 64 and index.centroids.count() == 8


def test_recall(spark, built, data):
    rows, index = built
    x, q = data
    q = q[[0, 2, *range(3, 23)]]
    exact = found(knn.nearest(asked(spark, q), rows, 10))
    approximate = found(ann.search(index, asked(spark, q), 10, n_probe=8))
    shared = [len(set(exact[i]) & set(approximate[i])) / 10 for i in exact]
    assert np.mean(shared) > 0.6


def test_search_is_exact_for_the_coded_vectors(spark, built, data):
    """Distances are those to the vectors the codes stand for, and ranks follow them."""
    _, index = built
    x, q = data
    centers = dict(index.centroids.rdd.map(lambda r: (r.list_id, np.array(r.vector))).collect())
    books = ann.codebook_array(index.codebooks, CONFIG)
    coded = {}
    for r in index.postings.collect():
        coded[r.chunk_id] = (r.year, centers[r.list_id] + np.concatenate([books[j, c] for j, c in enumerate(r.codes)]))
    got = ann.search(index, asked(spark, q), 15, year_min=1802, year_max=1806, n_probe=8).collect()
    for i, query in enumerate(q):
        mine = sorted((r.rank, r.distance, r.chunk_id) for r in got if r.query_id == i)
        best = sorted(np.square(query.astype(np.float64) - v).sum() for y, v in coded.values() if 1802 <= y <= 1806)[:15]
        assert np.allclose([d for _, d, _ in mine], best, rtol=1e-4, atol=1e-5)
        assert all(1802 <= coded[c][0] <= 1806 for _, _, c in mine)


def test_search_waves_give_what_one_wave_gives(spark, built, data):
    _, index = built
    q = asked(spark, data[1])
    want = found(ann.search(index, q, 7, year_min=1801, n_probe=3))
    for rows in (1, 5, 22):
        assert found(ann.search(index, q, 7, year_min=1801, n_probe=3, wave_rows=rows)) == want


def test_queries_by_list():
    wave = pa.table({"query_id": pa.array(["c", "a", "b"])})
    probes = pa.table({"query_id": pa.array(["a", "b", "c", "c"]), "list_id": pa.array([4, 4, 4, 0], pa.int32())})
    got = {k: v.tolist() for k, v in ann.queries_by_list(wave, probes).items()}
    assert got == {0: [0], 4: [0, 1, 2]}
    assert ann.queries_by_list(wave, probes.slice(0, 0)) == {}


def test_large_distance_tables_are_not_kept(spark, built, data, monkeypatch):
    _, index = built
    q = asked(spark, data[1])
    want = found(ann.search(index, q, 7, n_probe=3))
    tables = ann.ListTables(np.zeros((2, 16), np.float32), np.zeros((8, 64, 2), np.float32))
    assert tables.kept is not None
    monkeypatch.setattr(ann, "MAX_KEPT_ENTRIES", 10)
    lazily = ann.ListTables(np.ones((2, 16), np.float32), np.zeros((8, 64, 2), np.float32))
    assert lazily.kept is None and [t.shape for t in lazily] == [(8, 64), (8, 64)]
    assert found(ann.search(index, q, 7, n_probe=3)) == want


@pytest.mark.parametrize("bad", [dict(n_lists=0, m=8, dim=16), dict(n_lists=4, m=5, dim=16), dict(n_lists=4, m=8, n_bits=9, dim=16)])
def test_bad_configurations_are_refused(bad):
    with pytest.raises(ValueError):
        ann.IVFPQConfig(**bad)


def test_too_few_training_vectors(spark, data):
    with pytest.raises(ValueError):
        ann.train_coarse(make(spark, data[0][:5]), CONFIG)


def test_no_id_collisions(spark, sf_dir):
    assert ann.id_collisions(ann.vector_meta(inputs.vectors(spark, sf_dir))).count() == 0


def test_vectors_of_different_length_are_refused():
    with pytest.raises(ValueError):
        vx.matrix(pa.array([[1.0, 2.0], [1.0]], pa.list_(pa.float32())))
    sliced = pa.array([[1.0, 2.0], [3.0, 4.0], [5.0, 6.0]], pa.list_(pa.float32())).slice(1, 2)
    assert vx.matrix(sliced).tolist() == [[3.0, 4.0], [5.0, 6.0]]


def test_refined_search_ranks_by_the_vectors(spark):
    """Candidates by code, then by distance; all of them where the factor is large enough, so that the exact ranking comes out."""
    rng = np.random.default_rng(8)
    rows = [(f"c{i:03d}", f"d{i}", 1800 + i % 5, f"s{i % 3}", [float(v) for v in rng.normal(size=8).astype(np.float32)]) for i in range(300)]
    vectors = spark.createDataFrame(rows, "chunk_id STRING, doc_id STRING, year INT, source STRING, vector ARRAY<FLOAT>")
    queries = vectors.filter("year = 1803").limit(7).select(F.col("chunk_id").alias("query_id"), "vector")
    config = ann.IVFPQConfig(n_lists=4, m=4, n_bits=4, dim=8)
    index = ann.build_index(vectors, config)
    path = new_folder(spark, "refined")
    vectors.write.partitionBy("year", "source").parquet(path)
    stored = spark.read.schema(vectors.schema).parquet(path)

    def listed(hits):
        return sorted((r.query_id, r["rank"], r.chunk_id, round(r.distance, 5)) for r in hits.collect())

    exact = listed(knn.nearest(queries, vectors.filter("year BETWEEN 1801 AND 1803"), 5))
    assert listed(ann.refined_search(index, stored, queries, 5, 1801, 1803, n_probe=4, factor=60)) == exact
    some = ann.refined_search(index, stored, queries, 5, 1801, 1803, n_probe=4, factor=1)
    coded = ann.search(index, queries, 5, 1801, 1803, n_probe=4)
    assert {(r.query_id, r.chunk_id) for r in some.collect()} == {(r.query_id, r.chunk_id) for r in coded.collect()}
    assert some.columns == coded.columns
    with pytest.raises(ValueError):
        ann.refined_search(index, stored, queries, 5, factor=0)


def test_refining_opens_the_folders_of_candidates_only(spark):
    path = new_folder(spark, "refined")
    spark.range(64).selectExpr("cast(id AS string) AS chunk_id", "array(cast(id AS float)) AS vector", "cast(1800 + id % 8 AS int) AS year",
                               "concat('s', id % 2) AS source").write.partitionBy("year", "source").parquet(path)
    stored = spark.read.schema("chunk_id STRING, vector ARRAY<FLOAT>, year INT, source STRING").parquet(path)
    near = spark.read.schema(stored.schema).parquet(path).filter("chunk_id = '3'").selectExpr(
        "1 AS query_id", "0f AS distance", "1 AS rank", "chunk_id", "year", "source")
    queries = spark.createDataFrame([(1, [2.0])], "query_id INT, vector ARRAY<FLOAT>")
    hits = ann.refine(near, stored, queries, 3)
    assert [(r.chunk_id, r.distance) for r in hits.collect()] == [("3", 1.0)]
    assert "dynamicpruning" in hits._jdf.queryExecution().toString()


def test_searches_ask_with_every_fiftieth_vector(spark, sf_dir):
    from folioloom.registry import inputs

    asked = {int(r.query_id[1:]) for r in inputs.vector_queries(spark, sf_dir).collect()}
    assert asked == {n for n in (int(r.chunk_id[1:]) for r in inputs.vectors(spark, sf_dir).collect()) if n % 50 == 0}


def test_words_are_hashed_once_a_batch(spark):
    """Vectors are those of the tokenizer's ids, which the plan no longer works out for every place of a word."""
    from folioloom.functions import tokens as tk
    from folioloom.operators.embedding import HashEncoder

    words = ["a", "b", "a", "\u00e9t\u00e9", "z" * 40]
    ids = spark.createDataFrame([(w,) for w in words], "w STRING").select(tk.word_id(F.col("w"))).collect()
    assert [r[0] for r in ids] == tk.word_ids(pa.array(words)).tolist()

    class Ids(tk.WordTokenizer):
        pass

    texts = spark.createDataFrame([("a b a " * 300,), ("",), ("\u00e9t\u00e9 z",), (None,)], "t STRING")
    fast, slow = HashEncoder(), HashEncoder(tokenizer=Ids())
    assert "sha2" not in texts.select(fast.encode(F.col("t")))._jdf.queryExecution().executedPlan().toString()
    assert texts.select(fast.encode(F.col("t"))).collect() == texts.select(slow.encode(F.col("t"))).collect()


@pytest.mark.parametrize("key", ["exact_knn", "ivf_probe", "ivfpq_search", "ivfpq_refined", "ivfpq_refined_recall"])
def test_every_vector_asks(spark, sf_dir, key):
    """Each given vector is a query of its own, and the SQL asks the same."""
    from folioloom.registry import ORACLES, QUERIES, inputs

    every = {r.chunk_id for r in inputs.vectors(spark, sf_dir).collect()}
    rows = QUERIES[key](spark, sf_dir)
    if "n_exact" in rows.columns:
        assert rows.first().n_exact == 10 * len(every)
    else:
        assert {r.query_id for r in rows.select("query_id").distinct().collect()} == every
    assert "% 50" not in ORACLES[key]


def test_codes_compared_by_product_give_what_tables_give():
    """The same candidates, to the last bit of their distances, batch after batch; equal codes tie."""
    rng = np.random.default_rng(4)
    books = rng.normal(size=(8, 16, 8)).astype(np.float32)
    residuals = rng.normal(size=(300, 64)).astype(np.float32)
    query_rows = np.sort(rng.choice(400, 300, replace=False))
    tables, product = knn.Nearest(400, 7), knn.Nearest(400, 7)
    for rows in (3, 500, 40):
        codes = rng.integers(0, 16, (rows, 8)).astype(np.uint8)
        codes[rows // 2:] = codes[:rows - rows // 2]
        order = rng.permutation(rows)
        want = tables.admit(*ann.score_list(ann.ListTables(residuals, books), codes, tables, query_rows), order)
        got = product.admit(*ann.score_decoded(residuals, books, codes, product, query_rows), order)
        assert all(np.array_equal(g, w) for g, w in zip(got, want)) and len(got[0])


def test_refined_search_in_waves_holds_one_wave_on_disk(spark, built, data):
    """The same hits in any waves; the candidates of a wave are dropped before the next."""
    rows, index = built
    q = asked(spark, data[1])

    def shuffled():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {name for name in (files.apply(i).getName() for i in range(files.size())) if name.startswith("shuffle_")}

    want = found(ann.refined_search(index, rows, q, 4, n_probe=3, factor=3))
    for wave_rows in (1, 5):
        before = shuffled()
        hits = ann.refined_search(index, rows, q, 4, n_probe=3, factor=3, wave_rows=wave_rows)
        left = shuffled() - before
        assert len(left) <= 12, left
        assert found(hits) == want


def test_a_query_without_a_vector_is_given_the_first_ids(spark, data):
    x, q = data
    queries = asked(spark, q[:2]).unionByName(spark.createDataFrame([(7, None), (8, None)], "query_id BIGINT, vector ARRAY<FLOAT>"))
    want = brute(q[:2], x, 3)
    for rows in (None, 1):
        hits = knn.nearest(queries, make(spark, x, 3), 3, wave_rows=rows)
        got = found(hits)
        assert [got[i] for i in (0, 1)] == want and got[7] == got[8] == ["v0000", "v0001", "v0002"]
        assert {r.distance is None for r in hits.filter("query_id > 1").collect()} == {True}
