"""Texts stored once per content digest, in folders by the first digits of the digest.

The layout is the same whatever the size of a run: fixed folders, files sorted by digest, as many
files as the bytes ask for. A lookup by digest opens one folder and, by row-group statistics, little of it.

Small batches leave small files. ``BlobStore.compact`` puts those of a folder together: the new files are written first, then
the list of the old ones is published by one rename, from when on readers leave these out. ``vacuum`` deletes them later. Wherever this
breaks off, every digest is still in some file, and one that is in two is read once.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folioloom.functions.text import content_digest, text_bytes
from folioloom.plans.skew import BYTES_PER_SLICE, ROWS_PER_SLICE, salted_join, split_keys
from folioloom.schemas import BLOBS, columns
from folioloom.sources.tables import append, exists, located

# Digits of the digest a folder is named by: 256 folders.
PREFIX_DIGITS = 2
STORED = f"{BLOBS}, prefix STRING"
# Files below this size are put together where a folder has more than so many of them.
SMALL_FILE = 64 * 1024 * 1024
SMALL_FILES = 8


def distinct_texts(texts: DataFrame, text: str = "text") -> DataFrame:
    """One row per digest. Copies are dropped inside each task before the shuffle."""
    digested = texts.select(content_digest(F.col(text)).alias("checksum"), F.col(text).alias("text"))
    return digested.dropDuplicates(["checksum"]).select(
        "checksum", "text", text_bytes(F.col("text")).alias("n_bytes"))


def new_blobs(texts: DataFrame, stored: DataFrame, text: str = "text") -> DataFrame:
    """Distinct texts whose digest is not stored yet; both steps share one shuffle of the texts."""
    return distinct_texts(texts, text).join(stored.select("checksum"), "checksum", "left_anti").select(*columns(BLOBS))


@dataclass(frozen=True)
class BlobStore:
    """The blob table under ``path``: ``checksum, text, n_bytes`` in folders by ``prefix``."""

    spark: SparkSession
    path: str

    def _rows(self) -> DataFrame:
        """Rows of the files in use with ``_file``, which is folder and name, however the path of the table is written, and ``_size``."""
        if not exists(self.spark, self.path):
            return self.spark.createDataFrame([], f"{STORED}, _file STRING, _size BIGINT")
        rows = self.spark.read.schema(STORED).parquet(self.path)
        file = F.concat(F.lit("prefix="), "prefix", F.lit("/"), "_metadata.file_name")
        rows = rows.select("*", file.alias("_file"), F.col("_metadata.file_size").alias("_size"))
        retired = self._retired()
        return rows if retired is None else rows.join(retired, F.col("_file") == F.col("retired"), "left_anti")

    def _retired(self) -> DataFrame | None:
        """``retired``: the files that compactions have replaced since the last vacuum."""
        files, at = located(self.spark, f"{self.path}/_retired")
        lists = [str(f.getPath()) for f in files.listStatus(at)] if files.exists(at) else []
        return self.spark.read.schema("retired STRING").json(lists).distinct() if lists else None

    def stored(self) -> DataFrame:
        """All rows of the files in use; a digest that two writers stored at the same time is there twice."""
        return self._rows().drop("_file", "_size")

    def read(self, digest: str | None = None) -> DataFrame:
        """One row per digest.

        Which digests are in several files is found from the digests alone. The texts are neither sorted nor
        grouped for that; a join by digest that follows uses the same partitioning. With a ``digest``, both scans open its folder only,
        and read the row groups that their statistics and Bloom filters leave.
        """
        return self._read(digest).drop("_file", "_size")

    def _read(self, digest: str | None = None) -> DataFrame:
        rows = self._rows()
        if digest is not None:
            rows = rows.filter((F.col("prefix") == digest[:PREFIX_DIGITS]) & (F.col("checksum") == digest))
        held = rows.groupBy("checksum").agg(F.min("_file").alias("first_file"), F.max("_file").alias("last_file"))
        twice = held.filter("first_file != last_file").select(F.col("checksum").alias("_twice"), "first_file")
        copy = (F.col("checksum") == F.col("_twice")) & (F.col("_file") != F.col("first_file"))
        return rows.join(twice, copy, "left_anti")

    def small_files(self, below: int = SMALL_FILE, more_than: int = SMALL_FILES) -> DataFrame:
        """``retired``: the small files of folders that have more than so many of them. No column is read."""
        small = self._rows().select("prefix", "_file", "_size").filter(F.col("_size") < below).select("prefix", "_file").distinct()
        crowded = small.groupBy("prefix").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > more_than)
        return small.join(crowded, "prefix", "left_semi").select(F.col("_file").alias("retired"))

    def compact(self, below: int = SMALL_FILE, more_than: int = SMALL_FILES) -> int:
        """Put the small files of crowded folders together; returns how many were retired. One compaction runs at a time, beside any writers."""
        name = uuid.uuid4().hex
        # Written before anything else: the new files may be small ones too.
        found, listed = f"{self.path}/_found/{name}", f"{self.path}/_retired/{name}"
        if exists(self.spark, self.path):
            self.small_files(below, more_than).write.json(found)
            old = self.spark.read.schema("retired STRING").json(found)
            n = old.count()
            if n:
                rows = self._read().join(old, F.col("_file") == F.col("retired"), "left_semi")
                self.append(rows)
                self._publish(found, listed)
                return n
        return 0

    def _publish(self, found: str, listed: str) -> None:
        files, at = located(self.spark, found)
        _, to = located(self.spark, listed)
        files.mkdirs(to.getParent())
        if not files.rename(at, to):
            raise OSError(f"cannot publish {listed}")

    def vacuum(self) -> int:
        """Delete the retired files; returns how many. For when no reader is left that began before the last compaction."""
        lists = self._retired()
        gone = [r.retired for r in lists.toLocalIterator()] if lists is not None else []
        for name in gone:
            files, at = located(self.spark, f"{self.path}/{name}")
            files.delete(at, False)
        for kept in ("_retired", "_found"):
            files, at = located(self.spark, f"{self.path}/{kept}")
            files.delete(at, True)
        return len(gone)

    def append(self, blobs: DataFrame) -> None:
        """Add blobs that are new, one row per digest."""
        rows = blobs.select(*columns(BLOBS), F.substring("checksum", 1, PREFIX_DIGITS).alias("prefix"))
        append(rows, self.path, keys=["prefix"], sort_by=["checksum"], bloom=["checksum"])

    def add_texts(self, texts: DataFrame, text: str = "text") -> None:
        """Store the texts that are not there yet."""
        self.append(new_blobs(texts, self.stored(), text))


def with_text(
    documents: DataFrame, blobs: DataFrame, rows_per_slice: int = ROWS_PER_SLICE, bytes_per_slice: int = BYTES_PER_SLICE,
) -> DataFrame:
    """Documents with their text, from blobs with one row per digest.

    Documents and texts are shuffled by digest, each once. A text that very many documents
    share would bring them all to one task, so those documents take another way: they are
    dealt out in slices, and only their texts are repeated. With a ``text_bytes`` column the
    slices are sized by what they will hold. A document whose text is not stored stops the job that reads
    its text; one without a digest has no text to look for and no row.
    """
    weight = "text_bytes" if "text_bytes" in documents.columns else None
    sizes = {"rows_per_slice": rows_per_slice, "weight": weight, "bytes_per_slice": bytes_per_slice}
    texts = blobs.select(F.col("checksum").alias("text_checksum"), "text")
    documents = documents.filter(F.col("text_checksum").isNotNull())
    heavy = split_keys(documents, "text_checksum", **sizes).select("text_checksum")
    usual = documents.join(heavy, "text_checksum", "left_anti").join(texts, "text_checksum", "left")
    copies = documents.join(heavy, "text_checksum", "left_semi")
    shared = texts.join(heavy, "text_checksum", "left_semi")
    found = usual.unionByName(salted_join(copies, shared, "text_checksum", "doc_id", how="left", **sizes))
    missing = F.raise_error(F.concat(F.lit("no stored text for digest "), "text_checksum"))
    return found.withColumn("text", F.when(F.col("text").isNull(), missing).otherwise(F.col("text")))


def document_text(documents: DataFrame, blobs: BlobStore | DataFrame, doc_id: str) -> DataFrame:
    """Text of one document: its earliest row, no row for an unknown id.

    The digest is looked up first, so that the plan over the blobs names it and opens one folder.
    """
    row = (
        documents.filter(F.col("doc_id") == doc_id)
        .orderBy("created_at", "ingest_run_id", "text_checksum").select("text_checksum").first()
    )
    digest = row["text_checksum"] if row else None
    if isinstance(blobs, BlobStore):
        blobs = blobs.read(digest)
    if "prefix" in blobs.columns and digest is not None:
        blobs = blobs.filter(F.col("prefix") == digest[:PREFIX_DIGITS])
    found = blobs.filter(F.col("checksum") == digest)
    return found.select(F.lit(doc_id).alias("doc_id"), "text").limit(1)
