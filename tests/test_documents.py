import hashlib

import pytest
from pyspark.sql import functions as F

from folioloom.functions import text as tx
from folioloom.operators.documents import build_documents, join_metadata, normalized
from folioloom.sources.records import metadata_table

RECORD = "ia_id STRING, text STRING, source_uri STRING, source STRING"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_norm_text_matches_python_strip(spark):
    blanks = [chr(c) for c in range(0x110000) if chr(c).isspace()]
    assert len(blanks) == 29
    texts = [f"{b}word{b}" for b in blanks] + ["".join(blanks) + "a b" + "".join(blanks), "a\r\nb\rc\r\n", "", None, "​kept​"]
    rows = spark.createDataFrame(list(enumerate(texts)), "n INT, text STRING")
    got = {r.n: r.text for r in normalized(rows).collect()}
    assert got == {n: (t or "").replace("\r\n", "\n").strip() for n, t in enumerate(texts)}


def test_preview_and_size_count_code_points_and_bytes(spark):
    text = "é漢\U0001f600" * 500
    row = spark.createDataFrame([(text,)], "t STRING").select(
        tx.preview(F.col("t")).alias("p"), tx.text_bytes(F.col("t")).alias("b")).first()
    assert row.p == text[:1024]
    assert row.b == len(text.encode())


def test_document_row(spark):
    records = spark.createDataFrame([
        ("a", " one\r\ntwo ", "u:1", "007"), (None, "three", None, "007"), ("", "three", "u:3", "x"), ("b", None, "u:4", "x"), ("a", "one\ntwo", None, "y"),
    ], RECORD)
    raw = spark.createDataFrame([("a", 1850.0, "T", "A"), ("b", float("nan"), None, "B"), ("c", 0.0, "U", None)], "ia_id STRING, year DOUBLE, title STRING, author STRING")
    rows = build_documents(records, metadata_table(raw), "r1").collect()
    assert len(rows) == 5
    by = {(r.doc_id, r.source): r for r in rows}
    a = by["a", "007"]
    assert (a.year, a.title, a.author, a.text_bytes, a.preview, a.ingest_run_id) == (1850, "T", "A", 7, "one\ntwo", "r1")
    digest = sha("one\ntwo")
    assert a.text_uri == f"blob://sha256/{digest[:2]}/{digest[2:4]}/{digest}" and a.text_checksum == digest
    assert by["a", "y"].text_checksum == digest
    assert by[sha("three"), "007"].year == 9999
    assert (sha("threeu:3"), "x") in by
    b = by["b", "x"]
    assert (b.year, b.preview, b.text_bytes, b.author) == (9999, "", 0, "B")
    assert len({r.created_at for r in rows}) == 1


@pytest.mark.parametrize("value,expected", [("1850", 1850), ("0", 9999), (None, 9999), ("abc", 9999), ("99999999999", 9999), ("-5", -5)])
def test_year(spark, value, expected):
    row = spark.createDataFrame([(value,)], "y STRING").select(tx.year_or_unknown(F.col("y")).alias("y")).first()
    assert row.y == expected


def test_metadata_keeps_one_row_per_key(spark):
    raw = spark.createDataFrame([
        ("a", 1900, "late", "x"), ("a", 1850, "z", None), ("a", 1850, "b", None), ("a", None, "none", "x"), (None, 1, "t", "t"), ("b", None, None, None),
    ], "ia_id STRING, year INT, title STRING, author STRING")
    got = {r.ia_id: (r.year, r.title, r.author) for r in metadata_table(raw).collect()}
    assert got == {"a": (1850, "b", None), "b": (None, None, None)}


def test_join_keeps_every_record_of_a_heavy_or_missing_key(spark):
    records = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 3 == 1, F.lit(None)).otherwise(F.col("id").cast("string")).alias("ia_id"))
    md = spark.createDataFrame([("hot", 1800, "t", "a"), ("2", 1801, "u", "b")], "ia_id STRING, year INT, title STRING, author STRING")
    joined = join_metadata(records, md, ["id"])
    assert joined.count() == 3000
    assert joined.filter("year = 1800").count() == 1000
    assert joined.filter("year = 1801").count() == 1


def test_hash64_forms(spark):
    keys = ["a", "chunk-1", "漢", ""]
    rows = spark.createDataFrame([(k,) for k in keys], "k STRING").select(
        "k", tx.hash64(F.col("k")).alias("native"), tx.hash64_blake2b(F.col("k")).alias("blake")).collect()
    for row in rows:
        assert row.native == int(sha(row.k)[:15], 16)
        assert row.blake == int.from_bytes(hashlib.blake2b(row.k.encode(), digest_size=8).digest(), "little", signed=True)
