"""Sharding, mixing, and the pipeline."""

import random
import zlib

import corpus_pipeline
import numpy as np
import pytest
from folioloom.llm import mixing, sharding
from folioloom.llm.queries import ORACLES, QUERIES
from folioloom.llm.sharding import kd_shards


def check_shards(got, rows, shards):
    sizes = [len((t or "").encode()) + 8 for _, t, *_ in rows]
    assert sorted((str(r.doc_id), r["size"], r.text_crc32) for r in got) == sorted(
        (str(i), len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t, *_ in rows)
    totals = np.zeros(shards)
    slots = {}
    for r in got:
        totals[r.shard] += r["size"]
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert np.abs(totals - sum(sizes) / shards).max() <= max(sizes) * 2
    return totals


def test_shards(docs, rows, nothing):
    check_shards(kd_shards(docs, 3).collect(), rows, 3)
    assert {r.shard for r in kd_shards(docs, 1).collect()} == {0}
    assert kd_shards(nothing, 24).count() == 0
    with pytest.raises(ValueError):
        kd_shards(docs)


def test_shards_of_many_alike(spark):
    """A third of the rows are copies, and a third of all share a source."""
    rng = random.Random(1)
    rows = [(i, "the same text" if i % 3 == 0 else "x" * rng.randint(1, 60), "en", "hot" if i % 3 == 1 else f"s{i % 11}") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    totals = check_shards(kd_shards(docs, 24).collect(), rows, 24)
    assert totals.max() / totals.min() < 1.1
    by_bytes = kd_shards(docs, target_bytes=int(totals.sum() / 7)).collect()
    assert {r.shard for r in by_bytes} >= set(range(7))


def plain_tree(rows, shards):
    """(shard of each row) by sorting whole nodes; rows are (dims, tie, size)."""
    count = len(rows[0][0])
    low = [min(r[0][i] for r in rows) for i in range(count)]
    wide = [max(1, max(r[0][i] for r in rows) - low[i]) for i in range(count)]
    out = {}

    def cut(held, first, n):
        if n == 1 or not held:
            out.update(dict.fromkeys(held, first))
            return
        spread = [(max(rows[k][0][i] for k in held) - min(rows[k][0][i] for k in held)) / wide[i] for i in range(count)]
        dim = spread.index(max(spread))
        keys = {}
        for k in held:
            keys.setdefault((rows[k][0][dim], rows[k][1]), []).append(k)
        target, below, left = sum(rows[k][2] for k in held) * (n // 2) / n, 0, []
        for key in sorted(keys):
            size = sum(rows[k][2] for k in keys[key])
            if below + size >= target:
                left += keys[key] if below + size - target <= target - below else []
                break
            left += keys[key]
            below += size
        cut(left, first, n // 2)
        cut([k for k in held if k not in set(left)], first + n // 2, n - n // 2)

    cut(list(range(len(rows))), 0, shards)
    return out


@pytest.mark.parametrize("bins", [1 << 16, 16])
def test_shards_of_a_plain_tree(spark, docs, rows, monkeypatch, bins):
    """Cuts found to the last bit are those of sorting every node, with many bins and with few."""
    monkeypatch.setattr(sharding, "TOLERANCE", -1)
    monkeypatch.setattr(sharding, "BINS", bins)
    more = spark.createDataFrame([(1000 + i, "x" * (i * i % 301), "en", f"s{i % 13}") for i in range(400)], "doc_id long, text string, lang string, source string")
    df = docs.select("doc_id", "text", "lang", "source").union(more)
    placed = sharding._placed(df, sharding.DIMENSIONS).collect()
    want = plain_tree([(r.dims, r.tie, r["size"]) for r in placed], 7)
    want = sorted((str(placed[k].doc_id), placed[k].text_crc32, shard) for k, shard in want.items())
    got = sorted((str(r.doc_id), r.text_crc32, r.shard) for r in kd_shards(df, 7).collect())
    assert [g for g in got if g[0] != "3"] == [w for w in want if w[0] != "3"]


def test_shards_follow_long_names(spark):
    """Names that differ behind a long common start, and a null among them: each shard holds neighbouring names only."""
    names = [f"commoncrawl-{2000 + i:04d}" for i in range(16)]
    rows = [(i, "x" * 50, None if i == 0 else names[i % 16]) for i in range(1601)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    held = {}
    for r in kd_shards(docs, 16, dimensions=["source"]).collect():
        held.setdefault(r.shard, set()).add(rows[r.doc_id][2])
    assert sorted(held) == list(range(16))
    for shard in held.values():
        at = sorted(-1 if name is None else names.index(name) for name in shard)
        assert len(at) <= 3 and at[-1] - at[0] <= 2


def plain_targets(sizes):
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: [1, 2, 3][i % 3] for i, s in enumerate(order)}
    target, free, left = {}, set(order), float(sum(sizes.values()))
    while free:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if weight[s] * level > 3 * sizes[s]}
        if not over:
            return target | {s: weight[s] * level for s in free}
        target |= {s: 3.0 * sizes[s] for s in over}
        left -= sum(target[s] for s in over)
        free -= over
    return target


def check_mix(got, rows):
    sizes, taken, largest = {}, {}, {}
    assert sorted((str(r.doc_id), r["size"]) for r in got) == sorted((str(i), len((t or "").split())) for i, t, *_ in rows)
    for i, t, _, s in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
        largest[s] = max(largest.get(s, 0), len((t or "").split()))
    target = plain_targets(sizes)
    source = {(i, len((t or "").split())): s for i, t, _, s in rows}
    for r in got:
        s = source[(r.doc_id, r["size"])]
        assert r.source_size == sizes[s] and r.target == pytest.approx(target[s]) and r.taken <= 3 * r["size"]
        taken[s] = taken.get(s, 0) + r.taken
    for s in sizes:
        assert abs(taken[s] - target[s]) <= largest[s]
    return taken


def test_mix(docs, rows, nothing):
    got = mixing.mix_plan(docs).collect()
    check_mix(got, rows)
    again = mixing.mix_plan(docs.repartition(5)).collect()
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, again), key=str)
    assert mixing.mix_plan(nothing).count() == 0 and mixing.mix(nothing).count() == 0
    whole = mixing.mix(docs)
    assert whole.columns == docs.columns
    assert sum(len((r.text or "").split()) for r in whole.collect()) == sum(r.taken for r in got)


def test_mix_of_many_small_blocks(spark):
    rng = random.Random(3)
    rows = [(i, "w " * int(rng.paretovariate(1.2) * 5), "en", rng.choice(["a", "b", "b", "b", "b", "c", "d", None])) for i in range(2500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = mixing.mix_plan(docs, block=64).collect()
    check_mix(got, rows)


def test_flight_keeps_both_totals():
    rng = random.Random(0)
    sizes, pi = np.array([rng.randint(0, 300) for _ in range(500)], float), np.array([rng.random() for _ in range(500)])
    out = mixing.flight(sizes, pi, rng)
    assert ((out > 0) & (out < 1)).sum() <= 2
    assert out.sum() == pytest.approx(pi.sum()) and (out * sizes).sum() == pytest.approx((pi * sizes).sum())
    landed = mixing.landing(sizes, out)
    assert set(landed) <= {0.0, 1.0}


def test_flight_takes_each_with_its_probability():
    sizes, pi = np.array([5.0, 9, 2, 7, 7, 1, 12, 3]), np.array([0.2, 0.5, 0.7, 0.4, 0.9, 0.3, 0.6, 0.4])
    total = np.zeros(8)
    for seed in range(4000):
        total += mixing.flight(sizes, pi, random.Random(seed))
    assert np.abs(total / 4000 - pi).max() < 0.04


@pytest.mark.parametrize("key", list(ORACLES))
def test_sql(spark, sf_dir, key):
    from compare import compare

    assert compare(spark, key, QUERIES[key], ORACLES[key], sf_dir) is None


def test_pipeline(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = docs
    ids = [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = corpus_pipeline.stored(stage(spark, kept, sf_dir), "test")
        assert kept.columns == docs.columns
        assert kept.join(docs, docs.columns, "left_anti").isEmpty()
        ids.append(kept.count())
    assert ids[0] > ids[1] > ids[2] >= ids[3] > 0
    out = corpus_pipeline.run(spark, sf_dir)
    assert out.count() == ids[-1] and out.columns == ["doc_id", "size", "text_crc32", "shard", "slot"]
