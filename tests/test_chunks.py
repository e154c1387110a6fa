import hashlib

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from folioloom.functions import tokens as tk
from folioloom.operators import chunks as ops


def spans_by_loop(n, window, overlap):
    """Windows one after the other until the text is covered."""
    if not n:
        return [(0, 0)]
    out, start = [], 0
    while True:
        out.append((start, min(n, start + window)))
        if out[-1][1] == n:
            return out
        start += window - overlap


@pytest.mark.parametrize("window,overlap", [(64, 8), (512, 64), (5, 4), (3, 0), (1, 0), (7, 3)])
def test_window_count_is_the_loop(spark, window, overlap):
    rows = spark.range(0, 1500 if window > 1 else 200).select(F.col("id").cast("int").alias("n"))
    got = rows.select("n", tk.token_windows(F.col("n"), window, overlap).alias("w")).collect()
    for row in got:
        assert [(w.start_token, w.end_token) for w in row.w] == spans_by_loop(row.n, window, overlap)
        assert [w.seq for w in row.w] == list(range(len(row.w)))


@pytest.mark.parametrize("window,overlap", [(0, 0), (-1, 0), (4, 4), (4, 5), (4, -1)])
def test_bad_windows_are_refused(window, overlap):
    """Before anything runs, and whatever the texts are."""
    with pytest.raises(ValueError):
        tk.check_window(window, overlap)


def docs(spark, texts):
    rows = [(f"d{i}", 1800 + i, None if i % 2 else "s", "r", t) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id STRING, year INT, source STRING, ingest_run_id STRING, text STRING")


def test_chunk_rows_by_hand(spark):
    rows = ops.chunk_rows(docs(spark, ["a b c d e f g", "", "x"]), window=5, overlap=2).orderBy("doc_id", "seq").collect()
    assert [(r.doc_id, r.seq, r.start_token, r.end_token, r.text, r.token_count) for r in rows] == [
        ("d0", 0, 0, 5, "a b c d", 5), ("d0", 1, 3, 8, "c d e f g", 5), ("d0", 2, 6, 9, "f g", 3), ("d1", 0, 0, 2, "", 2), ("d2", 0, 0, 3, "x", 3)]
    first = rows[0]
    checksum = hashlib.sha256(b"a b c d").hexdigest()
    assert first.text_checksum == checksum
    assert first.chunk_id == hashlib.sha256(f"d0:0:0:5:{checksum}".encode()).hexdigest()
    assert rows[3].source == "" and first.source == "s"
    word = int(hashlib.sha256(b"a").hexdigest()[:7], 16) + tk.FIRST_WORD_ID
    assert first.tokens[:2] == [tk.BOS_ID, word] and first.tokens[-1] == tk.EOS_ID and len(first.tokens) == 6


def test_chunk_tokens_are_the_encoding_of_the_chunk_text(spark):
    tokenizer = tk.WordTokenizer()
    rows = ops.chunk_rows(docs(spark, ["one two three four five six seven", " lead  and\ttrail \n", "漢字 é"]), tokenizer, 4, 1)
    assert rows.filter(F.col("tokens") != tokenizer.encode(F.col("text"))).count() == 0


def test_without_specials_an_empty_text_has_one_empty_window(spark):
    rows = ops.chunk_rows(docs(spark, [""]), tk.WordTokenizer(specials=False), 4, 1).collect()
    assert [(r.start_token, r.end_token, r.text, list(r.tokens)) for r in rows] == [(0, 0, "", [])]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    texts=st.lists(st.text(alphabet="ab \n\tñ", max_size=120), min_size=1, max_size=6),
    window=st.integers(2, 9), data=st.data())
def test_merging_gives_the_words_back(spark, texts, window, data):
    overlap = data.draw(st.integers(0, window - 1))
    chunks = ops.chunk_rows(docs(spark, texts), window=window, overlap=overlap)
    merged = {r.doc_id: r for r in ops.merge_chunks(chunks, overlap=overlap).collect()}
    for i, text in enumerate(texts):
        assert merged[f"d{i}"].merge_ok and merged[f"d{i}"].text == " ".join(text.split())


def test_merge_reports_what_does_not_fit(spark):
    chunks = ops.chunk_rows(docs(spark, ["a b c d e f g h i j k l", "m n o p q r s t u v"]), window=5, overlap=2)
    broken = chunks.withColumn("text", F.when((F.col("doc_id") == "d0") & (F.col("seq") == 1), F.lit("z z z z z")).otherwise(F.col("text")))
    got = {r.doc_id: (r.merge_ok, r.text) for r in ops.merge_chunks(broken, overlap=2).collect()}
    assert got["d0"] == (False, None) and got["d1"] == (True, "m n o p q r s t u v")
    gap = chunks.filter(~((F.col("doc_id") == "d0") & (F.col("seq") == 1)))
    assert not {r.doc_id: r.merge_ok for r in ops.merge_chunks(gap, overlap=2).collect()}["d0"]
    other = chunks.withColumn("chunk_id", F.concat("chunk_id", F.lit("x"))).withColumn("text", F.lit("q"))
    two = chunks.unionByName(other.filter("doc_id = 'd0' AND seq = 1"))
    assert not {r.doc_id: r.merge_ok for r in ops.merge_chunks(two, overlap=2).collect()}["d0"]


def test_merge_takes_copies_of_a_chunk_once(spark):
    chunks = ops.chunk_rows(docs(spark, ["a b c d e f g h"]), window=5, overlap=2)
    merged = ops.merge_chunks(chunks.unionByName(chunks), overlap=2).collect()
    assert [(r.text, r.merge_ok) for r in merged] == [("a b c d e f g h", True)]


def test_part_of_a_document_merges_from_any_start(spark):
    chunks = ops.chunk_rows(docs(spark, ["a b c d e f g h i j k l m n"]), window=5, overlap=2).filter("seq BETWEEN 1 AND 2")
    assert ops.merge_chunks(chunks, overlap=2).first().text == "c d e f g h i j"


def test_context_stops_at_both_ends(spark):
    chunks = ops.chunk_rows(docs(spark, [" ".join("abcdefghijklmnop"), "q r s t u v w x y z"]), window=5, overlap=2)
    ids = {r.seq: r.chunk_id for r in chunks.filter("doc_id = 'd0'").collect()}
    last = max(ids)

    def seqs(seq, before, after):
        return [r.seq for r in ops.context(chunks, ids[seq], before, after).collect()]

    assert seqs(0, 1, 1) == [0, 1]
    assert seqs(2, 1, 2) == [1, 2, 3, 4]
    assert seqs(last, 2, 5) == [last - 2, last - 1, last]
    assert seqs(1, 0, 0) == [1]
    assert ops.context(chunks, "nothing").count() == 0


def test_pad_and_mask(spark):
    row = spark.createDataFrame([([1, 5, 6, 7, 2],)], "ids ARRAY<INT>").select(
        tk.truncate(F.col("ids"), 4).alias("t"), tk.truncate(F.col("ids"), 4, False).alias("u"),
        tk.pad(F.col("ids"), 7).alias("p"), tk.attention_mask(F.col("ids"), 7).alias("m"), tk.truncate(F.col("ids"), 5).alias("same")).first()
    assert (row.t, row.u) == ([1, 5, 6, 2], [1, 5, 6, 7])
    assert (row.p, row.m, row.same) == ([1, 5, 6, 7, 2, 0, 0], [1, 1, 1, 1, 1, 0, 0], [1, 5, 6, 7, 2])


def test_model_tokenizer_cuts_like_the_model(spark, word_pieces):
    tokenizer = tk.ModelTokenizer(word_pieces.to_str())
    texts = ["The river runs down to the sea", "", "town and sea " * 20]
    rows = ops.chunk_rows(docs(spark, texts), tokenizer, 8, 2).orderBy("doc_id", "seq").collect()
    for i, text in enumerate(texts):
        ids = word_pieces.encode(text).ids
        mine = [r for r in rows if r.doc_id == f"d{i}"]
        assert [(r.start_token, r.end_token) for r in mine] == spans_by_loop(len(ids), 8, 2)
        for r in mine:
            assert r.text == word_pieces.decode(ids[r.start_token:r.end_token], skip_special_tokens=True)
            assert list(r.tokens) == word_pieces.encode(r.text).ids


def test_model_tokenizer_merges_whole_words(spark, word_pieces):
    tokenizer = tk.ModelTokenizer(word_pieces.to_str())
    text = "the river the sea the town " * 6
    chunks = ops.chunk_rows(docs(spark, [text]), tokenizer, 8, 2)
    merged = ops.merge_chunks(chunks, tokenizer, 2).first()
    assert merged.merge_ok and merged.text == " ".join(text.split())


def test_model_tokenizer_truncates(spark, word_pieces):
    tokenizer = tk.ModelTokenizer(word_pieces.to_str())
    row = docs(spark, ["the river " * 50]).select(tokenizer.encode(F.col("text"), 10).alias("ids")).first()
    assert len(row.ids) == 10 and row.ids[-1] == 3


def test_detokenize(spark):
    documents = docs(spark, ["b a b", "", "x  y\nz"])
    coded = documents.select("doc_id", tk.WordTokenizer().encode(F.col("text")).alias("tokens"))
    got = {r.doc_id: r.text for r in ops.detokenize(coded, "doc_id", "tokens", ops.vocabulary(documents)).collect()}
    assert got == {"d0": "b a b", "d1": "", "d2": "x y z"}
