"""Records, metadata and document rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from folioloom.functions import text as tx
from folioloom.operators import documents as ops
from folioloom.operators.documents import normalized
from folioloom.registry import inputs as i
from folioloom.registry.book import query
from folioloom.registry.inputs import with_ctes
from folioloom.schemas import RECORD
from folioloom.session import new_folder
from folioloom.sources.records import metadata_table
from folioloom.sources.tables import append, count_rows, count_stored, union_all

DOC_COLUMNS = [
    "doc_id", "source", "year", "title", "author", "text_uri", "text_bytes", "text_checksum", "preview", "ingest_run_id",
]


@query("norm_text", with_ctes(["norm"], "select n, text from norm"))
def norm_text(spark, sf_dir):
    return normalized(i.records(spark, sf_dir)).select("n", "text")


@query("content_digest", with_ctes(["norm"], "select n, sha256(text) as digest from norm"))
def content_digest(spark, sf_dir):
    return normalized(i.records(spark, sf_dir)).select("n", tx.content_digest(F.col("text")).alias("digest"))


@query("text_bytes", with_ctes(["norm"], "select n, strlen(text)::bigint as text_bytes from norm"))
def text_bytes(spark, sf_dir):
    return normalized(i.records(spark, sf_dir)).select("n", tx.text_bytes(F.col("text")).alias("text_bytes"))


@query("doc_id_fallback", with_ctes(["docs"], "select n, doc_id from docs"))
def doc_id_fallback(spark, sf_dir):
    named = tx.document_id(F.col("ia_id"), F.col("text"), F.col("source_uri"))
    return normalized(i.records(spark, sf_dir)).select("n", named.alias("doc_id"))


@query("blob_uri", with_ctes(["docs"], "select n, text_uri from docs"))
def blob_uri(spark, sf_dir):
    digest = tx.content_digest(F.col("text"))
    return normalized(i.records(spark, sf_dir)).select("n", tx.blob_uri(digest).alias("text_uri"))


@query("preview", with_ctes(["norm"], "select n, left(text, 1024) as preview from norm"))
def preview(spark, sf_dir):
    return normalized(i.records(spark, sf_dir)).select("n", tx.preview(F.col("text")).alias("preview"))


@query("year_default", with_ctes(["md_raw"], """
    select ia_id, title, coalesce(nullif(year, 0), 9999)::int as year,
           coalesce(nullif(try_cast(title as int), 0), 9999)::int as from_text from md_raw"""))
def year_default(spark, sf_dir):
    return i.raw_metadata(spark, sf_dir).select(
        "ia_id", "title", tx.year_or_unknown(F.col("year")).alias("year"),
        tx.year_or_unknown(F.col("title")).alias("from_text"))


@query("run_stamp", with_ctes([], f"""
    select doc_id, '{i.RUN_ID}' as ingest_run_id, true as one_time, true as in_utc_now from documents"""))
def run_stamp(spark, sf_dir):
    stamped = ops.stamp(i.table(spark, sf_dir, "documents").select("doc_id"), i.RUN_ID)
    return stamped.select(
        "doc_id", "ingest_run_id", (F.col("created_at") == F.col("updated_at")).alias("one_time"),
        (F.col("created_at") == F.current_timestamp()).alias("in_utc_now"))


@query("metadata_lookup_table", with_ctes(["md"], "select ia_id, year, title, author from md"))
def metadata_lookup_table(spark, sf_dir):
    return metadata_table(i.raw_metadata(spark, sf_dir))


@query("metadata_left_join", with_ctes(["rec", "md"], """
    select r.n, r.ia_id, m.year, m.title, m.author from rec r left join md m on r.ia_id = m.ia_id"""))
def metadata_left_join(spark, sf_dir):
    records = i.records(spark, sf_dir).select("n", "ia_id")
    return ops.join_metadata(records, i.metadata(spark, sf_dir), ["n"]).select("n", "ia_id", "year", "title", "author")


@query("documents_build", with_ctes(["docs"], f"select {', '.join(DOC_COLUMNS)} from docs"))
def documents_build(spark, sf_dir):
    return i.documents(spark, sf_dir).select(*DOC_COLUMNS)


@query("docs_by_year_range", with_ctes(["docs"], """
    select doc_id, title, author, text_uri, preview, year, source from docs where year between 1820 and 1860"""))
def docs_by_year_range(spark, sf_dir):
    from folioloom.operators.lookup import documents_between

    return documents_between(i.documents(spark, sf_dir), 1820, 1860)


@query("ingest_totals", with_ctes(["docs"], """
    select ingest_run_id, count(*) as n_docs, sum(text_bytes)::bigint as n_bytes from docs group by 1"""))
def ingest_totals(spark, sf_dir):
    return ops.ingest_totals(i.documents(spark, sf_dir))


@query("distinct_texts", with_ctes(["norm"], """
    select sha256(text) as checksum, any_value(text) as text, any_value(strlen(text))::bigint as n_bytes
    from norm group by 1"""))
def distinct_texts(spark, sf_dir):
    return i.blobs(spark, sf_dir)


@query("union_batches", """
    select source, text from documents union all select 'benchmark', text from benchmark
    union all select role, text from conversations""")
def union_batches(spark, sf_dir):
    """Three inputs taken into one table."""
    return union_all(
        i.table(spark, sf_dir, "documents").select("source", "text"),
        i.table(spark, sf_dir, "benchmark").select("text", F.lit("benchmark").alias("source")),
        i.table(spark, sf_dir, "conversations").select(F.col("role").alias("source"), "text"))


@query("count_rows", "select count(*) as n_rows from documents")
def count(spark, sf_dir):
    return count_rows(i.table(spark, sf_dir, "documents"))


@query("count_stored", "select year::int as year, count(*) as n_rows from (select 1800 + doc_id % 7 as year from documents where doc_id is not null) group by year")
def count_of_folders(spark, sf_dir):
    """Rows of each folder of a written table, from the footers of its files."""
    path = new_folder(spark, "counted")
    rows = i.table(spark, sf_dir, "documents").filter("doc_id IS NOT NULL")
    append(rows.selectExpr("cast(doc_id AS long) AS doc_id", "cast(1800 + doc_id % 7 AS int) AS year"), path, keys=["year"])
    return count_stored(spark, path, "doc_id BIGINT, year INT", ["year"])


RECORD_COLUMNS = [field.split()[0] for field in RECORD.split(", ")]
