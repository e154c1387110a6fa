"""Newline-delimited JSON for a search server."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioloom.operators.fulltext import strict_rows
from folioloom.schemas import SEARCH_DOCUMENT, columns


def ndjson_lines(chunks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One JSON object per chunk in column ``value``, and the rows that cannot be exported."""
    rows, rejects = strict_rows(chunks)
    return rows.select(json_line().alias("value")), rejects


def json_line() -> Column:
    return F.to_json(F.struct(*columns(SEARCH_DOCUMENT)), {"ignoreNullFields": "false"})


def export_ndjson(chunks: DataFrame, path: str, docs_per_file: int = 0, gzip: bool = False) -> DataFrame:
    """Write the lines as text files, one for each task of the scan, or of at most ``docs_per_file`` objects where given; returns the rejects."""
    lines, rejects = ndjson_lines(chunks)
    (
        lines.write.mode("append").option("maxRecordsPerFile", docs_per_file)
        .option("compression", "gzip" if gzip else "none").text(path)
    )
    return rejects
