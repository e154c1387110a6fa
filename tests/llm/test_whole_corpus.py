"""Substring deduplication, the divergence audit and fill-in-middle against plain versions."""

import collections
import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from folioloom.llm import divergence, middle, repeats
from folioloom.llm.divergence import source_divergence
from folioloom.llm.middle import fill_in_middle, restored
from folioloom.llm.repeats import without_repeats
from pyspark.sql import functions as F

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def plain_repeats(rows, length):
    words = [WORD.findall(r[1] or "") for r in rows]
    starts = collections.Counter(tuple(w[i:i + length]) for w in words for i in range(len(w) - length + 1))
    out = []
    for r, w in zip(rows, words, strict=True):
        gone = {j for i in range(len(w) - length + 1) if starts[tuple(w[i:i + length])] > 1 for j in range(i, i + length)}
        out.append((r[0], len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return sorted(out, key=str)


def found_repeats(df, length):
    got = without_repeats(df, length)
    assert got.columns == ["doc_id", "n_words", "n_removed", "spans", "text"]
    got = got.collect()
    for r in got:
        assert sum(s.end - s.start for s in r.spans) == r.n_removed
        assert all(a.end < b.start for a, b in zip(r.spans, r.spans[1:], strict=False))
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.text) for r in got), key=str)


@pytest.mark.parametrize("length", [35, 5, 1])
def test_repeats(docs, rows, length):
    assert found_repeats(docs, length) == plain_repeats(rows, length)


def test_repeats_that_meet_in_part(spark, words):
    """Passages of 30 to 60 words in changing surroundings, inside one text and across; few words, so that anchors clash; runs of one word."""
    rng = random.Random(3)
    passages = [[rng.choice(words) for _ in range(rng.randint(30, 60))] for _ in range(6)]
    rows = []
    for i in range(120):
        text = []
        for _ in range(rng.randint(0, 4)):
            text += [rng.choice(words) for _ in range(rng.randint(0, 40))]
            passage = rng.choice(passages)
            low = rng.randint(0, 12)
            text += passage[low:len(passage) - rng.randint(0, 12)]
        rows.append((i, " ".join(text)))
    rows += [(200 + i, " ".join(rng.choice("ab") for _ in range(400))) for i in range(6)]
    rows += [(300, "x " * 34), (301, "x " * 35), (302, "x " * 36), (303, "y " * 90), (304, "z " * 34), (305, "z " * 34)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    assert found_repeats(df, 35) == plain_repeats(rows, 35)


def test_no_repeats(nothing, spark):
    assert without_repeats(nothing).count() == 0
    alone = spark.createDataFrame([(1, "a b  c"), (2, None)], "doc_id long, text string")
    assert found_repeats(alone, 35) == [(1, 3, 0, "a b c"), (2, 0, 0, "")]


def test_run_hashes():
    rng = np.random.default_rng(1)
    words = rng.integers(0, 2**63, 700).astype(np.uint64)
    runs = repeats._bases()[2]
    one = runs.of(runs.sums(words), slice(0, 660), 40)
    other = runs.of(runs.sums(words[13:]), slice(0, 600), 40)
    assert (one[13:613] == other).all() and len(set(one.tolist())) == 660


def plain_divergence(rows):
    rows = [(i, t or "", la or "", s or "") for i, t, la, s in rows]
    terms = [TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t)) for _, t, _, _ in rows]
    out = []
    for lang in {r[2] for r in rows}:
        held, counts = collections.Counter(), {r[3]: collections.Counter() for r in rows if r[2] == lang}
        for r, found in zip(rows, terms, strict=True):
            if r[2] == lang:
                held.update(set(found))
                counts[r[3]].update(found)
        kept = [t for t, n in held.items() if n >= 3]
        whole = sum(counts.values(), collections.Counter())

        def shares(count):
            total = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 1) // (total + len(kept)) for t in kept}

        q, p = shares(whole), {s: shares(c) for s, c in counts.items()}
        for s in counts:
            pairs = [(o, sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept)) for o in counts if o != s]
            near = [(t, (p[s][t] - q[t]) ** 2 // q[t]) for t in kept if counts[s][t] and p[s][t] > q[t]]
            for part, items, most in (("pair", pairs, None), ("term", near, 200)):
                ordered = sorted(items, key=lambda x: (-x[1], x[0].encode()))[:most]
                out += [(lang, s, part, item, value, i + 1) for i, (item, value) in enumerate(ordered)]
    return sorted(out)


def found_divergence(df):
    return sorted((r.lang, r.source, r.part, r.item, r.value, r["rank"]) for r in source_divergence(df).collect())


def test_divergence(docs, rows, monkeypatch):
    want = plain_divergence([(r[0], r[1], r[2], r[3]) for r in rows])
    assert found_divergence(docs) == want
    # Several blocks.
    monkeypatch.setattr(divergence, "BLOCK_CELLS", 200)
    assert found_divergence(docs) == want


def test_tiles_and_parts(monkeypatch):
    """What tasks do, with small bounds: a block in tiles, and counts handed on in parts."""
    rng = random.Random(4)
    block = [{"lang": "x", "block": 0, "term": None, "source": f"s{i}", "p": 5 + i} for i in range(7)]
    block += [{"lang": "x", "block": 0, "term": f"t{j}", "source": f"s{rng.randrange(7)}", "p": rng.randint(20, 30)} for j in range(40)]
    texts = [("x", f"s{i % 3}", "a b b c " * (i % 4) + f"own{i}") for i in range(30)]
    batches = [pa.RecordBatch.from_pylist([dict(zip(("lang", "source", "text"), t, strict=True)) for t in texts[i:i + 5]]) for i in range(0, 30, 5)]

    def counted():
        sums = collections.Counter()
        for batch in divergence._count(batches):
            for r in batch.to_pylist():
                sums[r["lang"], r["source"], r["term"], "n"] += r["n"]
                sums[r["lang"], r["source"], r["term"], "docs"] += r["docs"]
        return sums

    whole, tables = counted(), divergence._block(pa.Table.from_pylist(block)).to_pylist()
    assert whole["x", "s1", "b", "n"] == 2 * sum(i % 4 for i in range(30) if i % 3 == 1)
    monkeypatch.setattr(divergence, "TILE", 2)
    monkeypatch.setattr(divergence, "HELD_ENTRIES", 4)
    assert counted() == whole and divergence._block(pa.Table.from_pylist(block)).to_pylist() == tables


def test_divergence_without_terms(spark, nothing):
    assert source_divergence(nothing).count() == 0
    rows = [(1, None, "en", "a"), (2, "12 34", "en", "b"), (3, "xéX 中", "en", None), (4, "word", None, None), (5, "Word", None, None), (6, "wORD", None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    assert found_divergence(df) == plain_divergence(rows)


def test_joint_tables():
    rng = np.random.default_rng(2)
    levels = rng.integers(1, 5, (300, 6))
    got = {tuple(int(x) for x in row) for row in zip(*divergence.joint_tables(levels, range(0, 4), range(2, 6)), strict=True)}
    want = collections.Counter((a, b, int(r[a]), int(r[b])) for r in levels for a in range(4) for b in range(2, 6))
    assert got == {(*k, n) for k, n in want.items()}


def plain_middle(doc_id, text):
    text = text or ""
    units = UNIT.findall(text)
    h = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i:8 * i + 8], 16) for i in range(4))
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return doc_id, len(units), "plain", None, None, text
    if h4 % 100 < 80:
        return doc_id, len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def strange_texts():
    rng = random.Random(9)
    pieces = ["a", "é", "中文", "\U0001f600", " ", "\t", "\n\n", " ", "\x0b", "\x1f", "word", "<P", ">", "<M>"]
    return [(i, "".join(rng.choice(pieces) for _ in range(rng.randint(0, 30)))) for i in range(400)]


def test_middle(docs, rows, spark, nothing):
    strange = spark.createDataFrame(strange_texts(), "doc_id long, text string").selectExpr("*", "1 AS n", "2 AS form", "3 AS fim", "4 AS `a.b`")
    for given, df in ((rows, docs), (strange_texts(), strange)):
        out = fill_in_middle(df)
        assert out.columns == [c for c in df.columns if c != "fim"] + ["fim"]
        out = out.select("*", restored(F.col("fim.output"), F.col("fim.form")).alias("back")).collect()
        assert sorted(((r.doc_id, *r.fim) for r in out), key=str) == sorted((plain_middle(r[0], r[1]) for r in given), key=str)
        assert all(r.back == (r.text or "") for r in out)
    assert fill_in_middle(nothing).count() == 0


def test_scatter_in_steps(monkeypatch):
    """What tasks do, with small bounds on a scatter and on a step of the running sum."""
    monkeypatch.setattr(middle, "SCATTER_BYTES", 50)
    monkeypatch.setattr(middle, "STEP", 7)
    rows = strange_texts()
    texts = [t.encode() for _, t in rows]
    h = np.array([[int(hashlib.sha256(f"42:{i}".encode()).hexdigest()[8 * k:8 * k + 8], 16) for k in range(4)] for i, _ in rows], np.int64)
    slices = list(middle._slices(np.array([len(t) for t in texts])))
    assert len(slices) > 100 and [a for a, _ in slices[1:]] == [b for _, b in slices[:-1]]
    for a, b in slices:
        got = middle.arranged(texts[a:b], h[a:b]).to_pylist()
        assert [tuple(g.values()) for g in got] == [plain_middle(i, t)[1:] for i, t in rows[a:b]]
        assert middle.put_back([g["output"].encode() for g in got], [g["form"] for g in got]).to_pylist() == [t for _, t in rows[a:b]]


def test_every_text_rearranged(docs):
    out = fill_in_middle(docs, rate=100, suffix_first=0).filter("text != ''")
    assert {r.form for r in out.select("fim.form").distinct().collect()} == {"psm"}
    back = out.select("text", restored(F.col("fim.output"), F.col("fim.form")).alias("back"))
    assert back.filter("text != back").count() == 0
