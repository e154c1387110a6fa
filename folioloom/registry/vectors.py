"""Vectors, exact and approximate search, and what a search returns."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import functions as F

from folioloom.functions import text as tx
from folioloom.functions import vectors as vx
from folioloom.operators import ann, lookup, semantic
from folioloom.operators.embedding import check_vectors
from folioloom.operators.knn import nearest
from folioloom.paths import LakePaths
from folioloom.plans import jobs
from folioloom.registry import inputs as i
from folioloom.registry.book import query
from folioloom.registry.inputs import distance_sql, with_ctes
from folioloom.schemas import CHUNKS, EMBEDDINGS, columns
from folioloom.session import new_folder
from folioloom.sources.tables import append, count_rows, scan

N = 10
CONFIG = ann.IVFPQConfig(n_lists=10, m=8, n_bits=4, dim=i.DIM)
HASH64_SQL = "('0x' || substr(sha256({}), 1, 15))::bigint"


def rounded(hits, *extra: str):
    return hits.select("query_id", "rank", F.round(F.col("distance").cast("double"), 6).alias("distance"), *extra)


def components(df, key: str, vector: str = "vector"):
    # the outer form: to skip empty vectors Spark would run the encoder a second time
    long = df.select(key, F.posexplode_outer(vector).alias("component", "v"))
    return long.select(key, "component", F.round(F.col("v").cast("double"), 6).alias("value"))


@query("hash64", with_ctes(["vecs"], f"select chunk_id, {HASH64_SQL.format('chunk_id')} as faiss_id from vecs"))
def hash64(spark, sf_dir):
    return i.vectors(spark, sf_dir).select("chunk_id", tx.hash64(F.col("chunk_id")).alias("faiss_id"))


@query("masked_mean_pool", """
    with h as (select vec_id, t.range as t, e.range as e, embedding[t.range * 8 + e.range + 1]::double as x, (vec_id + t.range) % 3 as m
               from embeddings, range(8) as t, range(8) as e)
    select vec_id, e::int as component,
           round(sum(case when m > 0 then x else 0.0::double end) / sum(case when m > 0 then 1.0::double else 0.0::double end), 6) as value
    from h group by vec_id, e""")
def masked_mean_pool(spark, sf_dir):
    """Each vector read as 8 tokens of 8 components, some of them masked."""
    steps = F.sequence(F.lit(0), F.lit(7))
    rows = i.table(spark, sf_dir, "embeddings").select(
        "vec_id",
        F.transform(steps, lambda t: F.slice(F.col("embedding").cast("array<double>"), t * 8 + 1, 8)).alias("hidden"),
        F.transform(steps, lambda t: F.when((F.col("vec_id") + t) % 3 > 0, 1).otherwise(0)).alias("mask"))
    return components(rows.select("vec_id", vx.masked_mean_pool(F.col("hidden"), F.col("mask")).alias("vector")), "vec_id")


@query("l2_normalize", """
    with s as (select vec_id, list_transform(embedding::double[], lambda z: z * (vec_id % 5)) as v from embeddings),
    n as (select vec_id, v, greatest(sqrt(list_sum(list_transform(v, lambda z: z * z))), 1e-12) as norm from s)
    select vec_id, d.range::int as component, round(v[d.range + 1] / norm, 6) + 0.0 as value from n, range(64) as d""")
def l2_normalize(spark, sf_dir):
    """Vectors stretched by 0 to 4 and brought back to unit length; zero vectors stay zero."""
    stretched = F.transform(F.col("embedding").cast("array<double>"), lambda x: x * (F.col("vec_id") % 5))
    unit = i.table(spark, sf_dir, "embeddings").select("vec_id", vx.l2_normalize(stretched).alias("vector"))
    return components(unit, "vec_id").withColumn("value", F.col("value") + F.lit(0.0))


@query("vector_check", """
    with v as (select vec_id, case when vec_id % 7 = 0 then list_slice(embedding, 1, 63) when vec_id % 11 = 0 then null else embedding end as vector
               from embeddings)
    select vec_id, coalesce(len(vector) = 64, false) as accepted from v""")
def vector_check(spark, sf_dir):
    """Some vectors are cut short or taken away; they have to end up among the rejects."""
    damaged = i.table(spark, sf_dir, "embeddings").selectExpr(
        "vec_id",
        "CASE WHEN vec_id % 7 = 0 THEN slice(embedding, 1, 63) WHEN vec_id % 11 = 0 THEN NULL ELSE embedding END AS vector")
    good, bad = check_vectors(damaged, i.DIM)
    return good.select("vec_id", F.lit(True).alias("accepted")).unionByName(bad.select("vec_id", F.lit(False).alias("accepted")))


@query("vector_meta", with_ctes(["vecs"], f"select {HASH64_SQL.format('chunk_id')} as faiss_id, chunk_id, doc_id, year, source from vecs"))
def vector_meta(spark, sf_dir):
    return ann.vector_meta(i.vectors(spark, sf_dir))


@query("ids_by_year_open", with_ctes(["vecs"], f"select {HASH64_SQL.format('chunk_id')} as faiss_id from vecs where year between 0 and 1840"))
def ids_by_year_open(spark, sf_dir):
    return lookup.between_years(ann.vector_meta(i.vectors(spark, sf_dir)), year_max=1840).select("faiss_id")


@query("meta_by_ids", with_ctes(["vecs"], f"""
    select {HASH64_SQL.format('chunk_id')} as faiss_id, chunk_id, doc_id, year, source from vecs
    where doc_id in (select 'd' || doc_id from labels)"""))
def meta_by_ids(spark, sf_dir):
    """Metadata of the vectors that belong to labelled documents."""
    meta = ann.vector_meta(i.vectors(spark, sf_dir))
    labelled = i.table(spark, sf_dir, "labels").select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("doc_id"))
    return lookup.members(meta, lookup.members(meta, labelled, "doc_id"), "faiss_id").select(*semantic_columns())


def semantic_columns():
    return ["faiss_id", *semantic.META]


def top_sql(queries: str, vectors: str, n: int, columns: str, where: str = "true") -> str:
    return f"""
        select query_id, rank, round(distance::double, 6) as distance, {columns} from (
            select q.query_id, v.*, {distance_sql('q.vector', 'v.vector')} as distance,
                   row_number() over (partition by q.query_id order by {distance_sql('q.vector', 'v.vector')}, v.chunk_id)::int as rank
            from {queries} q, {vectors} v where {where}) where rank <= {n}"""


VEC_QUERIES = {"vq": "select chunk_id as query_id, vector from vecs"}


@query("exact_knn", with_ctes(["vecs"], top_sql("vq", "vecs", N, "chunk_id"), VEC_QUERIES))
def exact_knn(spark, sf_dir):
    """Nearest vectors of every vector."""
    return rounded(nearest(i.all_vector_queries(spark, sf_dir), i.vectors(spark, sf_dir), N), "chunk_id")


# The vectors of labelled documents as queries, and waves of a third of them at most.
WAVES = 3
LABELLED = {"lvq": "select chunk_id as query_id, vector from vecs where doc_id in (select 'd' || doc_id from labels)"}


def labelled_queries(spark, sf_dir):
    labelled = i.table(spark, sf_dir, "labels").select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("doc_id"))
    asked = lookup.members(i.vectors(spark, sf_dir), labelled, "doc_id").selectExpr("chunk_id AS query_id", "vector")
    return asked, max(1, -(-asked.count() // WAVES))


@query("exact_knn_waves", with_ctes(["vecs"], top_sql("lvq", "vecs", N, "chunk_id"), LABELLED))
def exact_knn_waves(spark, sf_dir):
    """Nearest vectors of the vectors of labelled documents, which go through all vectors in three waves or more."""
    asked, rows = labelled_queries(spark, sf_dir)
    return rounded(nearest(asked, i.vectors(spark, sf_dir), N, wave_rows=rows), "chunk_id")


@query("knn_topk", with_ctes(["centroids", "vecs"], top_sql("lq", "vecs", 25, "chunk_id, source"),
                             {"lq": "select list_id as query_id, vector from centroids"}))
def knn_topk(spark, sf_dir):
    """The 25 vectors nearest to the mean of each label."""
    queries = i.label_centroids(spark, sf_dir).withColumnRenamed("list_id", "query_id")
    found = nearest(queries, i.vectors(spark, sf_dir), 25, payload=["chunk_id", "source"])
    return rounded(found, "chunk_id", "source")


@query("embed_hash", with_ctes(["chunk_vec"], """
    select chunk_id, d.range::int as component, round(vector[d.range + 1]::double, 6) as value from chunk_vec, range(64) as d"""))
def embed_hash(spark, sf_dir):
    return components(i.chunk_vectors(spark, sf_dir), "chunk_id")


@query("embed_query", with_ctes(["query_vec"], """
    select query_id, d.range::int as component, round(vector[d.range + 1]::double, 6) as value from query_vec, range(64) as d"""))
def embed_query(spark, sf_dir):
    return components(i.query_vectors(spark, sf_dir), "query_id")


@dataclass(frozen=True)
class ShortVectors:
    """The encoder of the queries, which gives a seventh of the texts, by their length, a vector that lacks a component."""

    dim: int = i.DIM
    name: str = "short"

    def encode(self, text):
        whole = i.ENCODER.encode(text)
        return F.when(F.length(text) % 7 == 0, F.slice(whole, 1, self.dim - 1)).otherwise(whole)


@query("embed_totals", with_ctes(["chunks"], """
    select count(*) as n_chunks, count(*) filter (not short) as n_written, count(*) filter (short) as n_rejected,
           count(*) filter (not short) as n_stored, count(*) filter (short) as n_kept_out
    from (select length('passage: ' || text) % 7 = 0 as short from chunks)"""))
def embed_totals(spark, sf_dir):
    """The embedding job where some vectors are cut short: its own totals, and the rows of the two tables it writes."""
    paths = LakePaths(new_folder(spark, "lake"))
    append(i.chunks(spark, sf_dir).select(*columns(CHUNKS)), paths.chunks)
    totals = jobs.embed(spark, paths, ShortVectors())
    stored = count_rows(scan(spark, paths.embeddings, EMBEDDINGS)).select(F.col("n_rows").alias("n_stored"))
    out = count_rows(spark.read.parquet(paths.rejects("embeddings"))).select(F.col("n_rows").alias("n_kept_out"))
    names = ["n_chunks", "n_written", "n_rejected"]
    return stored.select(*[F.lit(totals[n]).cast("bigint").alias(n) for n in names], "n_stored").join(out)


CHUNK_HITS = {
    "cv": "select c.chunk_id, c.doc_id, c.year, c.source, e.vector from chunks c join chunk_vec e on e.chunk_id = c.chunk_id",
}
FOUND = {
    **CHUNK_HITS,
    "hits": top_sql("query_vec", "cv", N, "chunk_id, doc_id, year, source", "v.year between 1820 and 10000"),
}


@query("exact_search_filtered", with_ctes(["chunks", "chunk_vec", "query_vec"], top_sql(
    "query_vec", "cv", N, "chunk_id, doc_id, year, source", "v.year between 1820 and 1860"), CHUNK_HITS))
def exact_search_filtered(spark, sf_dir):
    """Benchmark texts against all chunks of 1820 to 1860."""
    hits = semantic.exact_search(i.chunk_vectors(spark, sf_dir), i.query_vectors(spark, sf_dir), N, 1820, 1860)
    return rounded(hits, *semantic.META)


def chunk_hits(spark, sf_dir):
    """Hits of the benchmark texts from 1820 on, with the numeric id of each chunk."""
    hits = semantic.exact_search(i.chunk_vectors(spark, sf_dir), i.query_vectors(spark, sf_dir), N, 1820)
    return hits.withColumn("faiss_id", tx.hash64(F.col("chunk_id")))


@query("hits_left_join_meta", with_ctes(["chunks", "chunk_vec", "query_vec"], f"""
    select q.item_id as query_id, p.range::int as rank,
           coalesce(h.distance, round(3.4028234663852886e38::double, 6)) as distances,
           coalesce({HASH64_SQL.format('h.chunk_id')}, -1) as labels, h.chunk_id, h.doc_id, h.year, h.source
    from benchmark q cross join range(1, 13) as p
    left join hits h on h.query_id = q.item_id and h.rank = p.range""", FOUND))
def hits_left_join_meta(spark, sf_dir):
    """Twelve places per query for ten hits each: the last two have no chunk."""
    hits = chunk_hits(spark, sf_dir)
    padded = semantic.pad_hits(hits, i.text_queries(spark, sf_dir), 12)
    found = semantic.attach_meta(padded, ann.vector_meta(i.chunk_vectors(spark, sf_dir)))
    return found.select(
        "query_id", "rank", F.round(F.col("distances").cast("double"), 6).alias("distances"), "labels", *semantic.META)


@query("search_chunks_semi", with_ctes(["chunks", "chunk_vec", "query_vec"], """
    select chunk_id, doc_id, year, source, seq, text from chunks where chunk_id in (select chunk_id from hits)""", FOUND))
def search_chunks_semi(spark, sf_dir):
    found = semantic.chunks_of_hits(i.chunk_texts(spark, sf_dir), chunk_hits(spark, sf_dir))
    return found.select("chunk_id", "doc_id", "year", "source", "seq", "text")


@query("search_with_text", with_ctes(["chunks", "chunk_vec", "query_vec"], """
    select h.query_id, h.rank, h.distance, c.chunk_id, c.doc_id, c.year, c.source, c.seq, c.text
    from hits h join chunks c on c.chunk_id = h.chunk_id""", FOUND))
def search_with_text(spark, sf_dir):
    found = semantic.hits_with_text(i.chunk_texts(spark, sf_dir), chunk_hits(spark, sf_dir))
    return rounded(found, "chunk_id", "doc_id", "year", "source", "seq", "text")


# --- approximate search -------------------------------------------------------------------
#
# Trained models depend on how the data is split, so assignment, encoding and search are
# compared under models worked out from the tables: the mean vector of each label as lists,
# and the sub-vectors of sixteen group means as codes.

N_CODES = CONFIG.n_codes
SUB = CONFIG.sub_dim


def given_codebooks(spark, sf_dir):
    group = (F.substring("chunk_id", 2, 20).cast("bigint") % N_CODES).cast("int")
    means = [F.avg(F.col("vector")[d]).cast("float") for d in range(i.DIM)]
    by_code = i.vectors(spark, sf_dir).groupBy(group.alias("code")).agg(F.array(*means).alias("v"))
    subs = F.transform(F.sequence(F.lit(0), F.lit(CONFIG.m - 1)), lambda s: F.struct(
        s.alias("sub"), F.slice("v", s * SUB + 1, SUB).alias("vector")))
    return by_code.select("code", F.inline(subs)).select("sub", "code", "vector")


def given_index(spark, sf_dir):
    centroids, books = i.label_centroids(spark, sf_dir), given_codebooks(spark, sf_dir)
    return ann.IVFPQIndex(CONFIG, centroids, books, ann.encode(i.vectors(spark, sf_dir), centroids, books, CONFIG))


ASSIGNED = {
    "assigned": f"""
        select v.chunk_id, v.doc_id, v.year, v.source, v.vector, c.list_id, c.vector as base, {distance_sql('v.vector', 'c.vector')} as distance
        from vecs v, centroids c
        qualify row_number() over (partition by v.chunk_id order by {distance_sql('v.vector', 'c.vector')}, c.list_id) = 1""",
}


def encoded_ctes(config: ann.IVFPQConfig, books: str) -> dict[str, str]:
    """Lists and codes of all vectors under the given books."""
    sub = config.sub_dim
    return {
        **ASSIGNED,
        "books": books,
        "parts": f"""
            select chunk_id, s.range as sub, list_transform(range({sub}), lambda z: vector[s.range * {sub} + z + 1]::float - base[s.range * {sub} + z + 1]::float) as r
            from assigned, range({config.m}) as s""",
        "coded": f"""
            select p.chunk_id, p.sub, b.code from parts p join books b on b.sub = p.sub
            qualify row_number() over (partition by p.chunk_id, p.sub order by {distance_sql('p.r', 'b.vector')}, b.code) = 1""",
    }


ENCODED = encoded_ctes(CONFIG, f"""
    select code, d // {SUB} as sub, list(a order by d) as vector from (
        select (substr(chunk_id, 2)::bigint % {N_CODES})::int as code, d.range as d, avg(vector[d.range + 1]::double)::float as a
        from vecs, range({i.DIM}) as d group by 1, 2) group by 1, 2""")
PROBED = {
    "vq": VEC_QUERIES["vq"],
    "probes": f"""
        select query_id, list_id, vector, base, distance, rank from (
            select q.query_id, c.list_id, q.vector, c.vector as base, {distance_sql('q.vector', 'c.vector')} as distance,
                   row_number() over (partition by q.query_id order by {distance_sql('q.vector', 'c.vector')}, c.list_id)::int as rank
            from vq q, centroids c) where rank <= 3""",
}


@query("ivf_assign", with_ctes(["vecs", "centroids"], "select chunk_id, list_id, round(distance::double, 6) as distance from assigned", ASSIGNED))
def ivf_assign(spark, sf_dir):
    assigned = ann.assign_lists(i.vectors(spark, sf_dir), i.label_centroids(spark, sf_dir), ["chunk_id"])
    return assigned.select("chunk_id", "list_id", F.round(F.col("distance").cast("double"), 6).alias("distance"))


@query("ivf_encode", with_ctes(["vecs", "centroids"], f"""
    select a.list_id, {HASH64_SQL.format('a.chunk_id')} as faiss_id, a.chunk_id, a.year, a.source,
           string_agg(printf('%02X', c.code), '' order by c.sub) as codes
    from assigned a join coded c on c.chunk_id = a.chunk_id group by all""", ENCODED))
def ivf_encode(spark, sf_dir):
    posted = given_index(spark, sf_dir).postings
    return posted.select("list_id", "faiss_id", "chunk_id", "year", "source", F.hex("codes").alias("codes"))


@query("ivf_probe", with_ctes(["vecs", "centroids"], """
    select query_id, list_id, rank, round(distance::double, 6) as distance from probes""", PROBED))
def ivf_probe(spark, sf_dir):
    return rounded(ann.probe_lists(i.all_vector_queries(spark, sf_dir), i.label_centroids(spark, sf_dir), 3), "list_id")


def scored_ctes(config: ann.IVFPQConfig, encoded: dict[str, str]) -> dict[str, str]:
    """Distances by code of the probed vectors from 1820 on."""
    sub = config.sub_dim
    return {
        **encoded,
        **PROBED,
        "tables": f"""
            select p.query_id, p.list_id, b.sub, b.code, list_sum(list_transform(list_zip(p.r, b.vector), lambda z: power(z[1]::double - z[2]::double, 2))) as part
            from (select query_id, list_id, s.range as sub,
                         list_transform(range({sub}), lambda z: vector[s.range * {sub} + z + 1]::float - base[s.range * {sub} + z + 1]::float) as r
                  from probes, range({config.m}) as s) p
            join books b on b.sub = p.sub""",
        "scored": """
            select t.query_id, a.chunk_id, a.year, a.source, sum(t.part)::float as distance
            from assigned a join coded c on c.chunk_id = a.chunk_id
            join tables t on t.list_id = a.list_id and t.sub = c.sub and t.code = c.code
            where a.year between 1820 and 10000 group by all""",
    }


SCORED = scored_ctes(CONFIG, ENCODED)


@query("ivfpq_search", with_ctes(["vecs", "centroids"], f"""
    select query_id, rank, round(distance::double, 6) as distance, {HASH64_SQL.format('chunk_id')} as faiss_id, chunk_id, year, source from (
        select *, row_number() over (partition by query_id order by distance, chunk_id)::int as rank from scored) where rank <= {N}""", SCORED))
def ivfpq_search(spark, sf_dir):
    """Every vector as a query against three lists, from 1820 on."""
    hits = ann.search(given_index(spark, sf_dir), i.all_vector_queries(spark, sf_dir), N, year_min=1820, n_probe=3)
    return rounded(hits, "faiss_id", "chunk_id", "year", "source")


@query("ivfpq_search_waves", with_ctes(["vecs", "centroids"], f"""
    select query_id, rank, round(distance::double, 6) as distance, {HASH64_SQL.format('chunk_id')} as faiss_id, chunk_id, year, source from (
        select *, row_number() over (partition by query_id order by distance, chunk_id)::int as rank from scored
        where query_id in (select query_id from lvq)) where rank <= {N}""", {**SCORED, **LABELLED}))
def ivfpq_search_waves(spark, sf_dir):
    """The search by code for the vectors of labelled documents, in three waves or more."""
    asked, rows = labelled_queries(spark, sf_dir)
    hits = ann.search(given_index(spark, sf_dir), asked, N, year_min=1820, n_probe=3, wave_rows=rows)
    return rounded(hits, "faiss_id", "chunk_id", "year", "source")


# Finer codes for the two-stage search: the residuals of the first vectors themselves.
FINE = ann.IVFPQConfig(n_lists=10, m=16, n_bits=6, dim=i.DIM)
FACTOR = 8


def fine_index(spark, sf_dir):
    rows, centroids = i.vectors(spark, sf_dir), i.label_centroids(spark, sf_dir)
    first = rows.withColumn("code", F.substring("chunk_id", 2, 20).cast("int")).filter(F.col("code") < FINE.n_codes)
    listed = ann.assign_lists(first, centroids, ["chunk_id"]).drop("distance").join(first, "chunk_id").join(centroids.select("list_id", F.col("vector").alias("base")), "list_id")
    residual = listed.select("code", F.zip_with("vector", "base", lambda v, b: v.cast("float") - b.cast("float")).alias("v"))
    subs = F.transform(F.sequence(F.lit(0), F.lit(FINE.m - 1)), lambda s: F.struct(
        s.alias("sub"), F.slice("v", s * FINE.sub_dim + 1, FINE.sub_dim).alias("vector")))
    books = residual.select("code", F.inline(subs)).select("sub", "code", "vector")
    return ann.IVFPQIndex(FINE, centroids, books, ann.encode(rows, centroids, books, FINE))


REFINED = {
    **scored_ctes(FINE, encoded_ctes(FINE, f"""
        select substr(chunk_id, 2)::int as code, s.range as sub,
               list_transform(range({FINE.sub_dim}), lambda z: vector[s.range * {FINE.sub_dim} + z + 1]::float - base[s.range * {FINE.sub_dim} + z + 1]::float) as vector
        from assigned, range({FINE.m}) as s where substr(chunk_id, 2)::int < {FINE.n_codes}""")),
    "candidates": f"""
        select query_id, chunk_id from scored qualify row_number() over (partition by query_id order by distance, chunk_id) <= {FACTOR * N}""",
    "refined": f"""
        select c.query_id, v.chunk_id, v.year, v.source, {distance_sql('q.vector', 'v.vector')} as distance,
               row_number() over (partition by c.query_id order by {distance_sql('q.vector', 'v.vector')}, v.chunk_id)::int as rank
        from candidates c join vecs v on v.chunk_id = c.chunk_id join vq q on q.query_id = c.query_id""",
}


def refined_hits(spark, sf_dir, n_probe: int):
    return ann.refined_search(
        fine_index(spark, sf_dir), i.vectors(spark, sf_dir), i.all_vector_queries(spark, sf_dir), N, year_min=1820, n_probe=n_probe, factor=FACTOR)


@query("ivfpq_refined", with_ctes(["vecs", "centroids"], f"""
    select query_id, rank, round(distance::double, 6) as distance, {HASH64_SQL.format('chunk_id')} as faiss_id, chunk_id, year, source
    from refined where rank <= {N}""", REFINED))
def ivfpq_refined(spark, sf_dir):
    """The eighty nearest by code of three lists, and of these the ten nearest by vector."""
    return rounded(refined_hits(spark, sf_dir, 3), "faiss_id", "chunk_id", "year", "source")


@query("ivfpq_refined_recall", with_ctes(["vecs", "centroids"], f"""
    select count(*) as n_exact, count(r.chunk_id) as n_found, count(r.chunk_id) >= 0.9 * count(*) as enough
    from exact e left join (select * from refined where rank <= {N}) r on r.query_id = e.query_id and r.chunk_id = e.chunk_id""", {
        **{k: v.replace("where rank <= 3", "") if k == "probes" else v for k, v in REFINED.items()},
        "exact": f"""
            select q.query_id, v.chunk_id from vq q, vecs v where v.year between 1820 and 10000
            qualify row_number() over (partition by q.query_id order by {distance_sql('q.vector', 'v.vector')}, v.chunk_id) <= {N}"""}))
def ivfpq_refined_recall(spark, sf_dir):
    """How many of the ten exact neighbours the two-stage search finds, all lists probed."""
    found = refined_hits(spark, sf_dir, CONFIG.n_lists).select("query_id", "chunk_id", F.lit(1).alias("found"))
    dated = i.vectors(spark, sf_dir).filter(F.col("year").between(1820, 10_000))
    exact = nearest(i.all_vector_queries(spark, sf_dir), dated, N).select("query_id", "chunk_id")
    both = exact.join(found, ["query_id", "chunk_id"], "left").agg(F.count(F.lit(1)).alias("n_exact"), F.count("found").alias("n_found"))
    return both.withColumn("enough", F.col("n_found") >= 0.9 * F.col("n_exact"))


@query("ivfpq_search_trained")
def ivfpq_search_trained(spark, sf_dir):
    """The jobs from embeddings on disk to an index on disk, and a search: benchmark texts against all chunks."""
    paths = LakePaths(new_folder(spark, "lake"))
    append(i.chunk_vectors(spark, sf_dir), paths.embeddings, keys=["model", "year", "source"])
    jobs.index_vectors(spark, paths, i.ENCODER.name, CONFIG, fraction=0.5)
    index = ann.read_index(spark, paths.vector_index(i.ENCODER.name), CONFIG)
    hits = ann.search(index, i.query_vectors(spark, sf_dir), N, year_min=1820, year_max=1860, n_probe=4)
    return rounded(hits, "faiss_id", "chunk_id", "year", "source")


@query("ivf_train", with_ctes([], "select 10::bigint as n_lists, 640::bigint as n_components"))
def ivf_train(spark, sf_dir):
    """One centroid per list, each with all components; the values depend on the split of the data."""
    trained = ann.train_coarse(i.vectors(spark, sf_dir), CONFIG)
    return trained.agg(F.count_distinct("list_id").alias("n_lists"), F.sum(F.size("vector")).alias("n_components"))


@query("pq_train", with_ctes(["vecs"], """
    select s.range::int as sub, 16::bigint as n_codes, true as nearer_than_start from range(8) as s"""))
def pq_train(spark, sf_dir):
    """Codes per sub-space. Training may not leave the vectors farther from their codes than they were."""
    rows = i.vectors(spark, sf_dir)
    centroids = i.label_centroids(spark, sf_dir)
    trained = ann.train_codebooks(rows, centroids, CONFIG)
    untrained = ann.train_codebooks(rows, centroids, ann.IVFPQConfig(**{**CONFIG.__dict__, "code_iterations": 0}))
    left = ann.residuals(rows, centroids)

    def loss(books, name):
        parts = F.transform(F.sequence(F.lit(0), F.lit(CONFIG.m - 1)), lambda s: F.struct(
            s.alias("sub"), F.slice("vector", s * SUB + 1, SUB).alias("part")))
        by_sub = books.groupBy("sub").agg(F.collect_list("vector").alias("codes"))
        split = left.select(F.inline(parts)).join(F.broadcast(by_sub), "sub")
        best = F.array_min(F.transform("codes", lambda c: vx.squared_l2(F.col("part"), c)))
        return split.groupBy("sub").agg(F.sum(best).alias(name))

    counts = trained.groupBy("sub").agg(F.count(F.lit(1)).alias("n_codes"))
    both = loss(trained, "after").join(loss(untrained, "before"), "sub").join(counts, "sub")
    return both.select("sub", "n_codes", (F.col("after") <= F.col("before") + 1e-6).alias("nearer_than_start"))
