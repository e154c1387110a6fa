"""From hits (id and distance) to rows a reader can use."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioloom.operators.knn import nearest
from folioloom.operators.lookup import between_years

META = ["chunk_id", "doc_id", "year", "source"]

# Label and distance of a place no vector was found for.
NO_LABEL = -1
NO_DISTANCE = 3.4028234663852886e38


def exact_search(
    embeddings: DataFrame, queries: DataFrame, n: int = 10,
    year_min: int | None = None, year_max: int | None = None,
) -> DataFrame:
    """n nearest chunks per query in the year range, by comparing every vector."""
    return nearest(queries, between_years(embeddings, year_min, year_max), n, "chunk_id", META)


def pad_hits(hits: DataFrame, queries: DataFrame, n: int) -> DataFrame:
    """Exactly n places per query: ``query_id, rank, distances, labels, chunk_id``, and year and source where the hits have them; empty ones
    have label -1 and no chunk."""
    folder = [c for c in ("year", "source") if c in hits.columns]
    places = queries.select("query_id").distinct().select("query_id", F.explode(F.sequence(F.lit(1), F.lit(n))).alias("rank"))
    return places.join(hits.select("query_id", "rank", "distance", "faiss_id", "chunk_id", *folder), ["query_id", "rank"], "left").select(
        "query_id", "rank",
        F.coalesce("distance", F.lit(NO_DISTANCE).cast("float")).alias("distances"),
        F.coalesce("faiss_id", F.lit(NO_LABEL).cast("bigint")).alias("labels"),
        "chunk_id", *folder,
    )


def attach_meta(hits: DataFrame, meta: DataFrame, few: bool = False) -> DataFrame:
    """Hits (``labels, chunk_id``) with the chunk each stands for; places without one keep nulls. Joined on the chunk,
    since several chunks may share a label.

    The metadata is cut down to the labels first, so that what the hits are joined with has
    no more rows than they; hits with year and source leave out all folders but theirs. ``few`` states that the hits are a bounded
    top-n of few queries, which lets every task filter its part of the metadata without a shuffle.
    """
    keys = [c for c in ("chunk_id", "year", "source") if c in hits.columns]
    wanted = hits.select(*keys).distinct()
    found = meta.join(F.broadcast(wanted) if few else wanted, keys, "left_semi")
    return hits.drop("year", "source").join(found.drop("faiss_id"), "chunk_id", "left")


def chunks_of_hits(chunks: DataFrame, hits: DataFrame, few: bool = False) -> DataFrame:
    """Chunk rows that were hit, without rank or distance; year and source prune the folders."""
    keys = hits.select("chunk_id", "year", "source").distinct()
    found = chunks.join(F.broadcast(keys) if few else keys, ["chunk_id", "year", "source"], "left_semi")
    return found.select(*chunks.columns)


def hits_with_text(chunks: DataFrame, hits: DataFrame, few: bool = False) -> DataFrame:
    """Hits with the text of their chunk, rank and distance kept."""
    ranked = hits.select("query_id", "rank", "distance", "chunk_id", "year", "source")
    texts = chunks.select("chunk_id", "year", "source", "doc_id", "seq", "text")
    return texts.join(F.broadcast(ranked) if few else ranked, ["chunk_id", "year", "source"]).select(
        "query_id", "rank", "distance", "chunk_id", "doc_id", "year", "source", "seq", "text")
