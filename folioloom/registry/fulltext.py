"""Full-text index and search over the chunks of all documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from folioloom.operators import fulltext as ft
from folioloom.operators import lookup
from folioloom.registry import inputs as i
from folioloom.registry.book import query
from folioloom.registry.inputs import with_ctes
from folioloom.session import new_folder
from folioloom.sources.tables import exists

STORED = "chunk_id, doc_id, year, source"
WORDS = "The nation with"
PHRASE = "of the"
SCORED = "nation with the"


_WRITTEN: dict[tuple[str, str], str] = {}


def _index(spark, sf_dir):
    """The stored index of the chunks of these tables. The first query of a session writes it, all read it."""
    key = spark.sparkContext.applicationId, sf_dir
    if key not in _WRITTEN or not exists(spark, f"{_WRITTEN[key]}/files"):
        path = new_folder(spark, "text-index")
        ft.write_text_index(i.chunk_texts(spark, sf_dir), path)
        _WRITTEN[key] = path
    return ft.read_text_index(spark, _WRITTEN[key])


@query("fts_analyze", with_ctes(["tokens"], "select chunk_id, term, pos from tokens"))
def fts_analyze(spark, sf_dir):
    return ft.occurrences(i.chunk_texts(spark, sf_dir)).select("chunk_id", "term", "pos")


@query("fts_strict_rows", with_ctes(["chunks"], f"""
    select chunk_id, doc_id, case when seq % 9 = 4 then null else year end::bigint as year, source, text, seq % 9 <> 4 as accepted from chunks"""))
def fts_strict_rows(spark, sf_dir):
    """Some chunks lose their year; they have to end up among the rejects."""
    undated = i.chunk_texts(spark, sf_dir).withColumn("year", F.expr("CASE WHEN seq % 9 = 4 THEN NULL ELSE year END"))
    good, bad = ft.strict_rows(undated)
    return good.withColumn("accepted", F.lit(True)).unionByName(bad.withColumn("accepted", F.lit(False)))


@query("fts_postings", with_ctes(["post"], f"select term, {STORED}, tf, array_to_string(positions, ',') as positions, doc_len from post"))
def fts_postings(spark, sf_dir):
    return ft.postings(i.chunk_texts(spark, sf_dir)).drop("place").withColumn("positions", i.joined(F.col("positions")))


@query("fts_roundtrip", with_ctes(["post"], f"""
    select term, {STORED}, tf, array_to_string(positions, ',') as positions, doc_len, substr(sha256(chunk_id), 1, 8) as place from post"""))
def fts_roundtrip(spark, sf_dir):
    """All postings as they are read from the stored index."""
    return _index(spark, sf_dir).postings.withColumn("positions", i.joined(F.col("positions")))


@query("fts_terms", with_ctes(["post"], "select term, count(*) as df from post group by term"))
def fts_terms(spark, sf_dir):
    return _index(spark, sf_dir).terms.select("term", "df")


@query("fts_docs", with_ctes(["lens"], f"select {STORED}, doc_len from lens"))
def fts_docs(spark, sf_dir):
    return _index(spark, sf_dir).docs


@query("fts_raw_match", with_ctes(["chunks"], f"select {STORED} from chunks where source = 'src3'"))
def fts_raw_match(spark, sf_dir):
    return ft.raw_match(i.chunk_texts(spark, sf_dir), "source", "src3")


@query("fts_year_clause", with_ctes(["chunks"], "select chunk_id, year from chunks where year >= 1850"))
def fts_year_clause(spark, sf_dir):
    return lookup.year_clause(i.chunk_texts(spark, sf_dir), year_from=1850).select("chunk_id", "year")


@query("fts_source_clause", with_ctes(["chunks"], "select chunk_id, source from chunks where source in ('src1', 'src4', 'src7')"))
def fts_source_clause(spark, sf_dir):
    return lookup.source_clause(i.chunk_texts(spark, sf_dir), ["src1", "src4", "src7"]).select("chunk_id", "source")


ANY_SQL = f"select {STORED}, count(*) as n_terms from post where term in ('the', 'nation', 'with') group by all"


@query("fts_any_term", with_ctes(["post"], ANY_SQL))
def fts_any_term(spark, sf_dir):
    return ft.match(_index(spark, sf_dir), WORDS, "any")


@query("fts_all_terms", with_ctes(["post"], f"""
    select {STORED}, count(*) as n_terms from post where term in ('the', 'with') and year between 1820 and 1870
      and source in ('src1', 'src2', 'src3', 'src5', 'src8') group by all having count(*) = 2"""))
def fts_all_terms(spark, sf_dir):
    return ft.match(_index(spark, sf_dir), "with THE", "all", 1820, 1870, ["src1", "src2", "src3", "src5", "src8"])


@query("fts_phrase", with_ctes(["tokens"], f"""
    select a.chunk_id, a.doc_id, a.year, a.source, count(*) as n_places
    from tokens a join tokens b on b.chunk_id = a.chunk_id and b.pos = a.pos + 1
    where a.term = 'of' and b.term = 'the' group by all"""))
def fts_phrase(spark, sf_dir):
    return ft.phrase(_index(spark, sf_dir), PHRASE)


BM25_CTES = {
    "corpus": "select count(*)::double as n, avg(doc_len::double) as avg_len from lens",
    "dfs": "select term, count(*)::double as df from post group by term",
    "scores": f"""
        select {STORED}, round(sum(ln(1 + (c.n - d.df + 0.5::double) / (d.df + 0.5::double)) * p.tf * 2.2::double
                     / (p.tf + 1.2::double * (0.25::double + 0.75::double * p.doc_len / c.avg_len))), 6) as score
        from post p join dfs d on d.term = p.term, corpus c where p.term in ('nation', 'with', 'the') group by all""",
}


@query("fts_bm25", with_ctes(["post", "lens"], f"select {STORED}, score from scores", BM25_CTES))
def fts_bm25(spark, sf_dir):
    return ft.bm25(_index(spark, sf_dir), SCORED)


@query("fts_count", with_ctes(["post"], f"select count(*) as num_hits from ({ANY_SQL})"))
def fts_count(spark, sf_dir):
    return ft.hit_count(ft.match(_index(spark, sf_dir), WORDS, "any"))


@query("fts_page", with_ctes(["post"], f"select {STORED} from ({ANY_SQL}) order by chunk_id limit 20 offset 40"))
def fts_page(spark, sf_dir):
    return ft.page(ft.match(_index(spark, sf_dir), WORDS, "any"), offset=40, limit=20)


@query("fts_page_ranked", with_ctes(["post", "lens"], f"select {STORED} from scores order by score desc, chunk_id limit 20 offset 20", BM25_CTES))
def fts_page_ranked(spark, sf_dir):
    return ft.ranked_page(_index(spark, sf_dir), SCORED, 20, 20)


BLOCK_CTES = {
    **BM25_CTES,
    "figures": f"select n, avg_len, (select coalesce(max(d), 0) from range(1, 9) as r(d) where n >= {ft.PER_BLOCK} * power(16, d)) as digits from corpus",
    "asked": f"""
        select p.term, substr(sha256(p.chunk_id), 1, f.digits) as block,
               ln(1 + (f.n - d.df + 0.5::double) / (d.df + 0.5::double)) as weight,
               p.tf * 2.2::double / (p.tf + 1.2::double * (0.25::double + 0.75::double * p.doc_len / f.avg_len)) as impact
        from post p join dfs d on d.term = p.term, figures f where p.term in ('nation', 'with', 'the')""",
    "bounds": """
        select block, sum(weight * best) as bound from (select term, block, max(weight) as weight, max(impact) as best from asked group by 1, 2) group by 1""",
    "reached": """
        select case when count(*) = 40 then min(score) else 0 end as least from (
            select s.score from scores s, figures f
            where substr(sha256(s.chunk_id), 1, f.digits) in (select block from bounds order by bound desc, block limit 40)
            order by s.score desc, s.chunk_id limit 40)""",
}


@query("fts_blocks_left_out", with_ctes(["post", "lens"], f"""
    select count(*) as n_blocks, count(*) filter (where bound < least - {ft.SLACK}) as n_left_out from bounds, reached""", BLOCK_CTES))
def fts_blocks_left_out(spark, sf_dir):
    """Blocks with a word of the query, and how many of them a page of the best forty does not read."""
    _, bounds, least = ft.score_to_reach(_index(spark, sf_dir), SCORED, 40)
    return bounds.agg(F.count(F.lit(1)).alias("n_blocks"), F.count(F.when(F.col("bound") < least - ft.SLACK, 1)).alias("n_left_out"))
