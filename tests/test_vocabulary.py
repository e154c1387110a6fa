import re

import pytest
from pyspark.sql import functions as F

from folioloom.functions import tokens as tk
from folioloom.operators import chunks as ops
from folioloom.operators.vocabulary import Vocabulary, numbered_words

WORDS = re.compile(r"[^ \t\n\r]+")


def docs(spark, texts, first=0):
    return spark.createDataFrame([(first + i, t) for i, t in enumerate(texts)], "doc_id BIGINT, text STRING")


def ids(kept):
    rows = kept.read().collect()
    assert len({r.word for r in rows}) == len({r.token_id for r in rows}) == len(rows)
    return {r.word: r.token_id for r in rows}


def test_ids_are_the_places_of_the_words(spark):
    words = [f"w{(i * 7919) % 3000}" for i in range(3000)]
    for parts in (1, 7):
        found = spark.createDataFrame([(w,) for w in words], "word STRING").repartition(parts)
        got = {r.word: r.token_id for r in numbered_words(found, 4).collect()}
        assert got == {w: 4 + i for i, w in enumerate(sorted(words))}


def test_later_runs_add_and_keep(spark, folder):
    kept = Vocabulary(spark, folder)
    kept.extend(docs(spark, ["b a b", None, "", "  "]))
    assert ids(kept) == {"a": tk.FIRST_WORD_ID, "b": tk.FIRST_WORD_ID + 1}
    kept.extend(docs(spark, ["c a", "0 \u00e9"]))
    assert ids(kept) == {w: tk.FIRST_WORD_ID + i for i, w in enumerate(["a", "b", "0", "c", "\u00e9"])}
    before = ids(kept)
    kept.extend(docs(spark, ["c a", "b"]))
    kept.extend(docs(spark, []))
    assert ids(kept) == before


def test_every_word_comes_back_where_hashed_ids_collide(spark, folder, monkeypatch):
    """With ids of one hex digit, hashed words share ids and do not all come back; those of the dictionary do."""
    texts = [" ".join(f"word{i * 13 % 90 + j}" for j in range(12)) for i in range(40)] + ["the " * 500 + "end", "", None, " \t", "x  y\nz"]
    rows = docs(spark, texts)
    want = {i: " ".join(WORDS.findall(t or "")) for i, t in enumerate(texts)}
    kept = Vocabulary(spark, folder)
    kept.extend(rows)
    coded = kept.encode(rows, "doc_id")
    assert {r.doc_id: len(r.tokens) for r in coded.collect()} == {i: len(t.split()) for i, t in want.items()}
    back = ops.detokenize(coded, "doc_id", "tokens", kept.read())
    assert {r.doc_id: r.text for r in back.collect()} == want
    monkeypatch.setattr(tk, "WORD_ID_HEX_DIGITS", 1)
    hashed = rows.filter("text IS NOT NULL").select("doc_id", F.transform(tk.words(F.col("text")), tk.word_id).alias("tokens"))
    wrong = {r.doc_id: r.text for r in ops.detokenize(hashed, "doc_id", "tokens", ops.vocabulary(rows)).collect()}
    assert any(wrong[i] != want[i] for i in wrong)


def test_a_word_without_an_id_stops_the_job(spark, folder):
    kept = Vocabulary(spark, folder)
    kept.extend(docs(spark, ["a b"]))
    with pytest.raises(Exception, match="no id for word c"):
        kept.encode(docs(spark, ["a c"]), "doc_id").collect()


def test_places_of_words_do_not_move_one_by_one(spark, folder):
    """Rows are dealt out once, and a slice asks once for a word; rows of one key are taken together, and a null key finds nothing."""
    kept = Vocabulary(spark, folder)
    rows = docs(spark, ["the " * 400 + f"w{i}" for i in range(20)])
    kept.extend(rows)
    coded = kept.encode(rows, "doc_id")
    plan = coded._jdf.queryExecution().executedPlan().toString()
    assert "posexplode" not in plan and "collect_list" not in plan
    assert {r.doc_id: len(r.tokens) for r in coded.collect()} == dict.fromkeys(range(20), 401)
    vocab = spark.createDataFrame([(4, "a"), (5, "b"), (6, "c")], "token_id INT, word STRING")
    odd = spark.createDataFrame([("x", [4, 5]), ("x", [6, 9, 4]), (None, [4]), ("y", None), ("z", [1, 9, 5, 2])], "k STRING, t ARRAY<INT>")
    got = sorted((str(r.k), r.text) for r in ops.detokenize(odd, "k", "t", vocab).collect())
    assert got == [("None", ""), ("x", "a c b a"), ("x", "a c b a"), ("y", ""), ("z", "b")]
