"""The Jaccard join against all pairs."""

import itertools
import random
import re

import corpus_pipeline
import numpy as np
from folioloom.llm.common import components, counter_array, numbered, rows_with_ids
from folioloom.llm.jaccard import similar_documents


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if len(words) < 3:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + 3]) for i in range(len(words) - 2)}


def plain(rows, percent=90):
    sets = [shingles(r[1]) for r in rows]
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
            root[max(top(i), top(j))] = min(top(i), top(j))
    ids = {}
    for i, r in enumerate(rows):
        ids.setdefault(top(i), []).append(r[0])
    least = {k: min((x for x in v if x is not None), default=None) for k, v in ids.items()}
    return sorted(((r[0], len(sets[i]), least[top(i)]) for i, r in enumerate(rows)), key=str)


def test_all_pairs(docs, rows):
    for percent in (90, 60):
        got = similar_documents(docs, percent=percent).select("doc_id", "n_shingles", "component_id").collect()
        assert sorted(map(tuple, got), key=str) == plain(rows, percent)


def test_empty(nothing):
    assert similar_documents(nothing).count() == 0


def test_links_between_copies_of_no_common_centre(spark, words):
    """A chain: each text is similar to the next one only."""
    text = [words[i] + str(i) for i in range(200)]
    rows = []
    for i in range(12):
        rows.append((i, " ".join(text), "en", "s"))
        text = text[:5 + 12 * i] + [f"new{i}"] + text[6 + 12 * i:]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = similar_documents(df, percent=97).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got), key=str) == plain(rows, 97)
    assert {r.component_id for r in got} == {0}


def test_one_of_each_group_stays(spark, docs, rows):
    kept = corpus_pipeline.keep_one_of_similar(spark, docs, "")
    assert kept.columns == docs.columns
    got = sorted((r.doc_id for r in kept.collect()), key=str)
    alone = [r[0] for r in rows if not shingles(r[1])]
    roots = {c for i, n, c in plain(rows) if n}
    assert got == sorted(list(roots) + alone, key=str)


def test_stage_takes_five_words_and_four_fifths(spark, words):
    """Pairs between op2's values and those of the stage: similar by 5 words and 0.8, not by 3 words and 0.9."""
    rng = random.Random(11)
    rows = []
    for i in range(6):
        text = [rng.choice(words) + f"{i}x{j}" for j in range(100)]
        other = list(text)
        other[30], other[70] = "changed", "twice"
        rows += [(2 * i, " ".join(text)), (2 * i + 1, " ".join(other))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.component_id for r in similar_documents(df).collect()} == set(range(12))
    stage = dict(corpus_pipeline.STAGES)["ngram_jaccard_join"]
    assert sorted(r.doc_id for r in stage(spark, df, "").collect()) == list(range(0, 12, 2))


def test_groups_of_null_and_clashing_ids(spark, words):
    """Two unlike texts under one id both stay; of near copies without ids one stays."""
    rng = random.Random(12)
    one, two, three = ([rng.choice(words) + f"{k}x{j}" for j in range(80)] for k in "abc")
    rows = [(1, " ".join(one)), (1, " ".join(two)), (2, " ".join(two) + " more")]
    rows += [(None, " ".join([*three, f"end{i}"])) for i in range(4)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = [r.text.split()[0] for r in corpus_pipeline.keep_one_of_similar(spark, df, "").collect()]
    assert sorted(got) == sorted([one[0], two[0], three[0]])


def test_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (101, 102), (7, 7)], "a long, b long")
    got = {r.id: r.root for r in components(edges).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100, 102: 100}
    assert components(edges.limit(0)).count() == 0


def test_counter_array(spark):
    def buckets(batch):
        yield batch.column(0).to_numpy() % 1024

    got = counter_array(spark.range(5000).repartition(3), buckets, 18, exact=True)
    assert (got == np.bincount(np.arange(5000) % 1024, minlength=1 << 18)).all()
    assert not counter_array(spark.range(0), buckets, 10).any()


def test_numbered(spark):
    df = spark.range(3000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN NULL ELSE id % 3 END AS g", "id % 5 AS w")
    got = numbered(df, "at", ["g"], ["id"]).toPandas()
    for _, part in got.groupby("g", dropna=False):
        assert sorted(part["at"]) == list(range(len(part)))
    sums = numbered(df, "at", [], ["id"], "w").toPandas().sort_values(["at", "w"])
    assert (sums["at"].to_numpy()[1:] - sums["at"].to_numpy()[:-1] <= 4).all()


def test_rows_with_ids(spark):
    docs = spark.range(2000).selectExpr("CASE WHEN id % 7 = 0 THEN NULL ELSE id END AS doc_id", "id AS x")
    ids = spark.range(0, 2000, 3).selectExpr("id AS doc_id").union(spark.sql("SELECT cast(NULL AS long)"))
    assert sorted(r.doc_id for r in rows_with_ids(docs, ids).collect()) == [i for i in range(0, 2000, 3) if i % 7]


def test_counts_of_two_bytes_stay_at_their_limit():
    """A task's counter array takes two bytes a bucket; a bucket that is full stays full, however it is filled."""
    from folioloom.llm.common import count_in

    rng = np.random.default_rng(4)
    found = [np.full(70_000, 3), rng.integers(0, 50, 40_000), np.full(65_535, 7), np.full(1, 7), np.zeros(0, np.int64), np.full(3, 9)]
    counts, wide = np.zeros(64, np.uint16), np.zeros(64, np.uint32)
    for part in found:
        count_in(counts, part)
        np.add.at(wide, part, 1)
    assert counts.tolist() == np.minimum(wide, 65_535).tolist() and wide.max() > 65_535


def test_memory_of_a_counting_task(spark):
    """The array of 2**24 buckets takes 32 MB in a task, not 64."""
    import tracemalloc

    from folioloom.llm import common

    held = []

    class Counted:
        def mapInArrow(self, f, schema):
            tracemalloc.start()
            for _ in f([np.array([5, 5, 8])]):
                pass
            held.append(tracemalloc.get_traced_memory()[1])
            tracemalloc.stop()
            return spark.range(0).selectExpr("cast(id as int) chunk", "cast('' as binary) data")

    common.counter_array(Counted(), lambda found: [found], 24)
    assert held[0] < 48 * 2**20
