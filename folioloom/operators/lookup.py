"""Point and range lookups. Filters come before projections, so any columns may be asked for."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DOCUMENT_COLUMNS = ["doc_id", "title", "author", "text_uri", "preview", "year", "source"]
DOC_CHUNK_COLUMNS = ["doc_id", "chunk_id", "seq", "text", "year", "source", "tokens"]
CHUNK_COLUMNS = ["doc_id", "chunk_id", "seq", "text", "year", "source"]

# What a missing year bound stands for when the other bound is given.
FIRST_YEAR = 0
LAST_YEAR = 10_000


def equals(df: DataFrame, column: str, value, select: list[str] | None = None) -> DataFrame:
    hit = df.filter(F.col(column) == value)
    return hit.select(*select) if select else hit


def chunks_of_document(chunks: DataFrame, doc_id: str, select: list[str] = DOC_CHUNK_COLUMNS) -> DataFrame:
    return equals(chunks, "doc_id", doc_id, select)


def chunk_by_id(chunks: DataFrame, chunk_id: str, select: list[str] = CHUNK_COLUMNS) -> DataFrame:
    return equals(chunks, "chunk_id", chunk_id, select)


def documents_between(documents: DataFrame, year_min: int, year_max: int) -> DataFrame:
    return documents.filter(F.col("year").between(year_min, year_max)).select(*DOCUMENT_COLUMNS)


def between_years(df: DataFrame, year_min: int | None = None, year_max: int | None = None) -> DataFrame:
    """Rows in an inclusive year range. Without bounds all rows; one bound opens the other side."""
    if year_min is None and year_max is None:
        return df
    low = FIRST_YEAR if year_min is None else year_min
    high = LAST_YEAR if year_max is None else year_max
    return df.filter(F.col("year").between(low, high))


def year_clause(df: DataFrame, year_from: int | None = None, year_to: int | None = None) -> DataFrame:
    """Half-open year filter of the full-text search: only the given bounds apply."""
    if year_from is not None:
        df = df.filter(F.col("year") >= year_from)
    if year_to is not None:
        df = df.filter(F.col("year") <= year_to)
    return df


def source_clause(df: DataFrame, sources: list[str] | None = None) -> DataFrame:
    return df.filter(F.col("source").isin(list(sources))) if sources else df


def members(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows whose key is in a table of ids. The engine broadcasts the ids only where they are small."""
    return df.join(ids.select(key).distinct(), key, "left_semi")
