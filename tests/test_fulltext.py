import math

import pytest
from pyspark.sql import functions as F

from folioloom.operators import fulltext as ft

CHUNK = "chunk_id STRING, doc_id STRING, year INT, source STRING, text STRING"
TEXTS = [
    ("c1", "d1", 1800, "a", "The river, the RIVER and the sea."),
    ("c2", "d1", 1810, "b", "A sea of rivers"),
    ("c3", "d2", 1820, "a", "sea river; river sea river"),
    ("c4", "d2", 9999, "c", ""),
    ("c5", "d3", 1830, "c", None),
    ("c6", "d3", 1840, "b", "naïve Straße 漢字 x" + "y" * 300 + " end"),
]


@pytest.fixture(scope="module")
def chunks(spark):
    return spark.createDataFrame(TEXTS, CHUNK)


@pytest.fixture(scope="module")
def index(spark, chunks):
    from folioloom.session import new_folder

    path = new_folder(spark, "text-index")
    ft.write_text_index(chunks, path)
    return ft.read_text_index(spark, path)


def ids(df):
    return sorted(r.chunk_id for r in df.collect())


def test_analyzer(spark):
    assert ft.query_terms(spark, "The RIVER--sea_42 naïve Straße") == [
        (0, "the"), (1, "river"), (2, "sea"), (3, "42"), (4, "naïve"), (5, "straße")]
    assert ft.query_terms(spark, " -- ") == []
    assert ft.query_terms(spark, "a " + "b" * 255 + " c") == [(0, "a"), (2, "c")]
    assert len(ft.query_terms(spark, "b" * 254)) == 1


def test_combining_marks_that_are_letters_stay_in_the_word(spark):
    assert [t for _, t in ft.query_terms(spark, "हिन्दी")] == ["हिन", "दी"]


def test_postings(chunks, index):
    for posted in (ft.postings(chunks), index.postings):
        got = {(r.term, r.chunk_id): (r.tf, list(r.positions), r.doc_len) for r in posted.collect()}
        assert got["river", "c1"] == (2, [1, 3], 7)
        assert got["the", "c1"] == (3, [0, 2, 5], 7)
        assert got["river", "c3"] == (3, [1, 2, 4], 5)
        assert got["end", "c6"] == (1, [4], 4)
        assert not any(c in ("c4", "c5") for _, c in got)
    assert {r.term: r.df for r in index.terms.collect()}["sea"] == 3
    assert {r.chunk_id: r.doc_len for r in index.docs.collect()} == {"c1": 7, "c2": 4, "c3": 5, "c4": 0, "c5": 0, "c6": 4}


def test_postings_equal_the_grouped_occurrences(spark, sf_dir):
    from folioloom.registry import inputs

    rows = inputs.chunks(spark, sf_dir)
    grouped = ft.occurrences(rows).groupBy("term", "chunk_id").agg(
        F.count(F.lit(1)).cast("int").alias("tf"), F.array_sort(F.collect_list("pos")).alias("positions"))
    posted = ft.postings(rows).select("term", "chunk_id", "tf", "positions")
    assert posted.exceptAll(grouped).count() == 0 and grouped.exceptAll(posted).count() == 0


def test_terms(index):
    assert ids(ft.match(index, "river")) == ["c1", "c3"]
    assert ids(ft.match(index, "river sea", "all")) == ["c1", "c3"]
    assert ids(ft.match(index, "rivers river", "any")) == ["c1", "c2", "c3"]
    assert ids(ft.match(index, "river river SEA", "all")) == ["c1", "c3"]
    assert ids(ft.match(index, "nowhere", "all")) == []
    assert ids(ft.match(index, "", "any")) == []


def test_filters_hold_for_the_whole_query(index):
    assert ids(ft.match(index, "sea rivers", "any", year_from=1805)) == ["c2", "c3"]
    assert ids(ft.match(index, "sea", "any", year_to=1810)) == ["c1", "c2"]
    assert ids(ft.match(index, "sea", "any", 1810, 1820, ["b"])) == ["c2"]
    assert ids(ft.match(index, "sea", sources=["a", "b"])) == ["c1", "c2", "c3"]
    assert ids(ft.match(index, "sea", sources=[])) == ["c1", "c2", "c3"]


def test_phrase(index):
    places = {r.chunk_id: r.n_places for r in ft.phrase(index, "river sea").collect()}
    assert places == {"c3": 1}
    assert {r.chunk_id: r.n_places for r in ft.phrase(index, "river").collect()} == {"c1": 2, "c3": 3}
    assert ids(ft.phrase(index, "sea river river")) == ["c3"] or ids(ft.phrase(index, "sea river river")) == []
    assert ids(ft.phrase(index, "river river")) == ["c3"]
    assert ids(ft.phrase(index, "the sea")) == ["c1"]
    assert ids(ft.phrase(index, "sea the")) == []
    assert ids(ft.phrase(index, "")) == []


def test_bm25_by_hand(index):
    n, avg = 6, (7 + 4 + 5 + 0 + 0 + 4) / 6

    def part(tf, df, length):
        return math.log(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * length / avg))

    got = {r.chunk_id: r.score for r in ft.bm25(index, "river sea").collect()}
    assert got["c1"] == pytest.approx(part(2, 2, 7) + part(1, 3, 7), abs=1e-6)
    assert got["c2"] == pytest.approx(part(1, 3, 4), abs=1e-6)
    assert got["c3"] == pytest.approx(part(3, 2, 5) + part(2, 3, 5), abs=1e-6)
    assert set(got) == {"c1", "c2", "c3"}
    only = {r.chunk_id: r.score for r in ft.bm25(index, "river sea", sources=["b"]).collect()}
    assert only == {"c2": got["c2"]}


def test_pages(index):
    hits = ft.match(index, "river sea rivers")
    assert [r.chunk_id for r in ft.page(hits, 0, 2).collect()] == ["c1", "c2"]
    assert [r.chunk_id for r in ft.page(hits, 2, 2).collect()] == ["c3"]
    assert ft.page(hits, 9, 2).count() == 0
    assert ft.page(hits).columns == ["chunk_id", "doc_id", "year", "source"]
    assert [r.chunk_id for r in ft.page(ft.bm25(index, "river sea"), by_score=True).collect()][0] == "c3"
    assert ft.hit_count(hits).first().num_hits == 3


def test_strict_rows(spark, chunks):
    good, bad = ft.strict_rows(chunks.withColumn("year", F.when(F.col("chunk_id") != "c2", F.col("year"))))
    assert ids(bad) == ["c2"] and good.count() == 5
    with pytest.raises(ValueError, match="missing"):
        ft.strict_rows(chunks.drop("text"))
    with pytest.raises(ValueError, match="unknown"):
        ft.strict_rows(chunks.withColumn("more", F.lit(1)), extra_ok=False)


def test_raw_match_is_exact(chunks):
    assert ids(ft.raw_match(chunks, "doc_id", "d2")) == ["c3", "c4"]
    assert ids(ft.raw_match(chunks, "source", "A")) == []
    with pytest.raises(ValueError):
        ft.raw_match(chunks, "text", "sea")


def test_ranked_pages_equal_the_whole_ranking(spark, monkeypatch):
    """Pages of any depth, with filters, few postings and stored blocks; and most blocks of a rare word's query are left out."""
    import random

    from folioloom.session import new_folder

    rng = random.Random(2)
    words = [f"w{i}" for i in range(60)]
    rows = [(f"c{i}", f"d{i % 40}", 1800 + i % 30, f"s{i % 4}", " ".join(rng.choices(words, [1 / (k + 1) for k in range(60)], k=rng.randint(1, 60)))) for i in range(900)]
    for frequent in (1, 10**6):
        monkeypatch.setattr(ft, "FREQUENT", frequent)
        path = new_folder(spark, "text-index")
        ft.write_text_index(spark.createDataFrame(rows, CHUNK).repartition(3), path)
        index = ft.read_text_index(spark, path)
        assert index.corpus.first().digits == 1
        for query in ("w0 w1 w2", "w50 w0", "w59", "w3 w3 w40 w41", "nowhere", "w5 nowhere"):
            for offset, limit, filters in ((0, 5, {}), (7, 10, {"year_from": 1805, "year_to": 1820, "sources": ["s1", "s2"]}), (880, 40, {})):
                whole = ft.page(ft.bm25(index, query, **filters), offset, limit, by_score=True)
                got = ft.ranked_page(index, query, offset, limit, **filters)
                assert [tuple(r) for r in got.collect()] == [tuple(r) for r in whole.collect()]


def test_rejects_are_written(spark, chunks):
    from folioloom.session import new_folder

    path = new_folder(spark, "text-index")
    ft.write_text_index(chunks.withColumn("year", F.when(F.col("chunk_id") != "c2", F.col("year"))), path)
    assert ids(spark.read.parquet(f"{path}/rejects")) == ["c2"]
    assert ids(ft.match(ft.read_text_index(spark, path), "sea")) == ["c1", "c3"]


def test_a_stored_posting_takes_few_bytes_and_keeps_copies_of_a_chunk(spark):
    """Stored fields lie with the chunk, not with each of its postings; segments end inside a task, and a chunk that comes twice stays twice."""
    import random

    from folioloom.session import new_folder, stored_bytes

    rng = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    rows = [(f"{rng.getrandbits(256):064x}", f"d{i}", 1800, "s", " ".join(rng.choices(words, k=60))) for i in range(3000)]
    rows += rows[:5]
    path = new_folder(spark, "text-index")
    ft.write_text_index(spark.createDataFrame(rows, CHUNK).coalesce(1), path)
    index = ft.read_text_index(spark, path)
    n = index.terms.agg(F.sum("df")).first()[0]
    assert stored_bytes(spark, f"{path}/postings") < 8 * n
    whole = ft.postings(spark.createDataFrame(rows, CHUNK))
    assert whole.exceptAll(index.postings).count() == 0 and index.postings.exceptAll(whole).count() == 0


def test_segments_are_bounded(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(ft, "SLICE_ROWS", 2)
    monkeypatch.setattr(ft, "SEGMENT_TOKENS", 6)
    texts = [["a", "b", "a"], [None, "b"], [], ["c"] * 300, ["a"]]
    batch = pa.RecordBatch.from_pydict({
        "chunk_id": list("vwxyz"), "doc_id": ["d"] * 5, "year": pa.array([1] * 5, pa.int64()), "source": ["s"] * 5, "doc_len": pa.array([3, 1, 0, 300, 1], pa.int32()),
        "place": list("vwxyz"), "terms": pa.array(texts, pa.list_(pa.string()))})
    out = pa.Table.from_batches([*ft._to_segments([batch])]).to_pylist()
    assert len({r["block"] for r in out}) == 2
    assert [(r["number"], r["chunk_id"]) for r in out if r["kind"] == "chunks"] == [(0, "v"), (1, "w"), (2, "x"), (3, "y"), (0, "z")]
    last = next(r for r in out if r["term"] == "c")
    assert (last["n"], last["steps"], len(last["positions"])) == (1, b"\x03", 600)


def test_writing_an_index_leaves_one_copy_of_the_postings_and_no_shuffles(spark, chunks):
    from folioloom.session import new_folder, stored_bytes

    def shuffled():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {name for name in (files.apply(i).getName() for i in range(files.size())) if name.startswith("shuffle_")}

    path, before = new_folder(spark, "text-index"), shuffled()
    ft.write_text_index(chunks.repartition(3), path)
    assert not shuffled() - before
    assert stored_bytes(spark, f"{path}/segments/kind=terms") == 0 < stored_bytes(spark, f"{path}/segments/kind=chunks")
    assert ft.read_text_index(spark, path).postings.count() == ft.postings(chunks).count()
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_bundles_keep_rows_and_ranges_their_order(spark, monkeypatch):
    """Rows of a term that no file could hold alone are split by segment; null fields stay null."""
    rows = [(f"t{i % 7}" if i % 2 else "the", i, 1 + i % 3, b"\x01", None if i == 5 else b"\x02", b"") for i in range(200)]
    lists = spark.createDataFrame(rows, "term STRING, block BIGINT, n INT, steps BINARY, tf BINARY, positions BINARY").repartition(3)
    ranged = ft._in_ranges(lists, 5).select("*", F.spark_partition_id().alias("at")).collect()
    assert sorted(tuple(r)[:6] for r in ranged) == sorted((t, b, n, bytearray(s), x and bytearray(x), bytearray(p)) for t, b, n, s, x, p in rows)
    assert [(r.term, r.block) for r in sorted(ranged, key=lambda r: r["at"])] == sorted((t, b) for t, b, *_ in rows)
    assert len({r["at"] for r in ranged if r.term == "the"}) > 1
    assert ft._in_ranges(lists.limit(0), 5).count() == 0


def test_runs_are_walked_once_and_positions_joined_without_a_lambda(chunks):
    """Lambdas are interpreted for each token; lengths are counted where the tokens are grouped."""
    from folioloom.registry import inputs

    posted = ft.postings(chunks)
    shown = posted.withColumn("positions", inputs.joined(F.col("positions")))
    for df in (posted, shown):
        assert df._jdf.queryExecution().optimizedPlan().toString().count("lambdafunction") == 1
    assert {r.positions for r in shown.filter("term = 'river'").collect()} == {"1,3", "1,2,4"}
    assert {(r.chunk_id, r.doc_len) for r in posted.collect()} == {("c1", 7), ("c2", 4), ("c3", 5), ("c6", 4)}


def test_packed_terms_are_never_there_twice(spark, monkeypatch):
    """They are put in ranges part by part, and what the pass wrote of a part is dropped before the next; a rare term still lies in two files at most."""
    import random

    from folioloom.session import new_folder, stored_bytes

    rng = random.Random(3)
    rows = [(f"c{i}", f"d{i}", 1800, "s", " ".join(f"w{rng.getrandbits(12)}" for _ in range(60))) for i in range(2000)]
    given, held, path = spark.createDataFrame(rows, CHUNK).repartition(3), [], new_folder(spark, "text-index")
    ranges = ft._in_ranges

    def watched(listed, n):
        held.append([stored_bytes(spark, f"{path}/{folder}") for folder in ("segments/kind=terms", "postings")])
        return ranges(listed, n)

    monkeypatch.setattr(ft, "WAVE_BYTES", 1)
    monkeypatch.setattr(ft, "_in_ranges", watched)
    ft.write_text_index(given, path)
    assert len(held) == ft.PARTS and [a for a, _ in held] == sorted((a for a, _ in held), reverse=True)
    assert held[-1][0] < held[0][0] / 8 and held[-1][1] > 0
    index, whole = ft.read_text_index(spark, path), ft.postings(given)
    assert whole.exceptAll(index.postings).count() == 0 and index.postings.exceptAll(whole).count() == 0
    for term in ("w1", "w77", "w4095"):
        assert len(ft.postings_of(index, {term}).inputFiles()) <= 2
        assert sorted(ids(ft.match(index, term))) == sorted(c for c, *_, text in rows if term in text.split())
    files = spark.read.parquet(f"{path}/files").drop("first_part", "last_part").localCheckpoint()
    files.write.mode("overwrite").parquet(f"{path}/files")  # as an index without parts has it
    assert sorted(ids(ft.match(ft.read_text_index(spark, path), "w77"))) == sorted(c for c, *_, text in rows if "w77" in text.split())


def _some_chunks(spark, copies):
    import random

    rng = random.Random(7)
    words = [f"w{i}" for i in range(30)]
    rows = [(f"{rng.getrandbits(256):064x}", f"d{i % 9}", 1800 + i % 30, f"s{i % 4}", " ".join(rng.choices(words, [1 / (k + 1) for k in range(30)], k=rng.randint(0, 50)))) for i in range(400)]
    return spark.createDataFrame(rows + rows[:copies], CHUNK).repartition(3)


def _stored(spark, chunks):
    from folioloom.session import new_folder

    path = new_folder(spark, "text-index")
    ft.write_text_index(chunks, path)
    return ft.read_text_index(spark, path)


def _shuffles(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange ")


@pytest.fixture(scope="module", params=[0, 40])
def both(request, spark):
    """A stored index without and with chunks that come twice, and the lazy tables of the same chunks."""
    given = _some_chunks(spark, request.param).localCheckpoint()
    stored = _stored(spark, given)
    assert ft.one_row_each(stored) == (request.param == 0)
    return stored, ft.index_of(given)


def _same(found, wanted):
    assert found.dtypes == wanted.dtypes
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, wanted.collect()))


def test_packed_terms_move_without_bounds_of_their_numbers():
    """Numbers of one segment lie together by byte, and what is known from other columns does not move."""
    import numpy as np
    import pyarrow as pa

    rng = np.random.default_rng(1)
    n, tf = rng.integers(1, 9, 500), []
    tf = rng.integers(1, 3, n.sum())
    steps, positions = rng.integers(0, 400, n.sum()), rng.integers(0, 70, tf.sum())
    lists, places = np.r_[0, np.cumsum(n)], np.r_[0, np.cumsum(tf)]
    rows = pa.table({
        "block": pa.array([7] * 500, pa.int64()), "term": [f"w{i}" for i in range(500)], "n": pa.array(n, pa.int32()), "steps": ft._packed(steps, lists),
        "tf": ft._packed(tf, lists), "positions": ft._packed(positions, places[lists])})
    lean = ft._lean_lists(rows)
    assert lean.num_rows == 1 and lean.nbytes < rows.nbytes - 500 * 12
    for name, numbers in (("steps", steps), ("tf", tf), ("positions", positions)):
        assert ft._unpacked(lean[name][0].as_py(), len(numbers)).tolist() == numbers.tolist()


def test_terms_are_counted_where_they_meet_their_chunks(both):
    """One shuffle, of what is stored; only chunks that come twice are put together by another."""
    stored, lazy = both
    for query, mode, filters in (("w1 w2 w9", "any", {}), ("w0 w1", "all", {}), ("w0 w3 nowhere", "any", {"year_from": 1810, "sources": ["s1", "s2"]}), ("", "any", {})):
        _same(ft.match(stored, query, mode, **filters), ft.match(lazy, query, mode, **filters))
        _same(ft.page(ft.match(stored, query, mode, **filters), 5, 20), ft.page(ft.match(lazy, query, mode, **filters), 5, 20))
    assert _shuffles(ft.match(stored, "w1 w2")) == (1 if ft.one_row_each(stored) else 2)


def test_scores_are_added_up_where_terms_meet_their_chunks(both):
    stored, lazy = both
    for query, filters in (("w1 w2 w9", {}), ("w0 w0 w25 nowhere", {"year_to": 1815, "sources": ["s1", "s3"]}), ("nowhere", {})):
        found, wanted = ({tuple(r)[:4]: r.score for r in ft.bm25(index, query, **filters).collect()} for index in (stored, lazy))
        assert found == pytest.approx(wanted, abs=2e-6)
    assert _shuffles(ft.bm25(stored, "w1 w2")) == 1 or not ft.one_row_each(stored)


def test_a_search_for_the_score_to_reach_leaves_no_shuffles(spark, both):
    def shuffled():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {name for name in (files.apply(i).getName() for i in range(files.size())) if name.startswith("shuffle_")}

    before = shuffled()
    _, _, least = ft.score_to_reach(both[0], "w1 w2", 5)
    assert least > 0 and not shuffled() - before


def test_phrases_are_found_where_terms_meet_their_chunks(both):
    stored, lazy = both
    for query, filters in (("w0 w1", {}), ("w0 w0", {}), ("w2 w0 w1", {"year_from": 1805}), ("w4", {"sources": ["s1"]}), ("w0 nowhere", {}), ("w1 w0 w1", {})):
        _same(ft.phrase(stored, query, **filters), ft.phrase(lazy, query, **filters))
    assert _shuffles(ft.phrase(stored, "w0 w1")) <= 1 or not ft.one_row_each(stored)


def test_an_index_that_does_not_know_of_copies_is_searched_as_before(spark):
    given = _some_chunks(spark, 0).localCheckpoint()
    stored = _stored(spark, given)
    corpus = stored.corpus.drop("copies").localCheckpoint()
    corpus.write.mode("overwrite").parquet(f"{stored.path}/corpus")
    index = ft.read_text_index(spark, stored.path)
    assert not ft.one_row_each(index)
    _same(ft.match(index, "w1 w2"), ft.match(ft.index_of(given), "w1 w2"))


def test_stored_postings_come_back_chunk_by_chunk(both):
    """The rows of a chunk lie next to one another, so what they share takes little room where they are written."""
    stored, lazy = both
    _same(stored.postings.withColumn("positions", F.col("positions").cast("string")), lazy.postings.withColumn("positions", F.col("positions").cast("string")))
    order = [r.chunk_id for r in stored.postings.select("chunk_id").collect()]
    assert 1 + sum(a != b for a, b in zip(order, order[1:])) <= stored.docs.filter("doc_len > 0").count()


def test_postings_of_a_segment_come_back_in_parts(monkeypatch):
    """Whole chunks in batches of a bounded number of postings, their terms in order however the bundles came; chunks that are left out stay out."""
    import random

    import numpy as np
    import pyarrow as pa

    rng = random.Random(5)
    texts = [[rng.choice(["of", "the", "sea", None, "a", "zinc"]) for _ in range(rng.randint(0, 9))] for _ in range(40)]
    shared = {c: [f"{c}{i}" for i in range(40)] for c in ("chunk_id", "doc_id", "source", "place")}
    rows = pa.table({**shared, "year": pa.array([1800] * 40, pa.int64()), "terms": pa.array(texts, pa.list_(pa.string()))})
    chunks, lists = (pa.Table.from_batches([b]) for b in ft._segment(rows))
    kept = [i for i in range(40) if i % 3]
    place = np.full(40, -1)
    place[kept] = np.arange(len(kept))
    met = [(chunks.take(pa.array(kept)), place, ft._lean_lists(lists.select(["term", "n", "steps", "tf", "positions"]).slice(*part))) for part in ((2, 9), (0, 2))]
    monkeypatch.setattr(ft, "UNPACKED_ROWS", 12)
    parts = list(ft._entries_in(met, ["chunk_id", "doc_len"], ["term", "tf", "positions"]))
    assert len(parts) > 3 and all(len(p["entries"].flatten()) <= 12 for p in parts)
    got = {r["chunk_id"]: (r["doc_len"], [(e["term"], e["tf"], e["positions"]) for e in r["entries"]]) for p in parts for r in p.to_pylist()}
    want = {}
    for i in kept:
        at = {t: [pos for pos, u in enumerate(texts[i]) if u == t] for t in sorted({t for t in texts[i] if t})}
        if at:
            want[f"chunk_id{i}"] = (sum(map(len, at.values())), [(t, len(p), p) for t, p in at.items()])
    assert got == want
