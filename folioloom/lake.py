"""One handle for the tables of a lake and the questions asked of them."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioloom import schemas
from folioloom.functions.tokens import WordTokenizer
from folioloom.operators import ann, chunks, fulltext, lookup, semantic
from folioloom.operators.embedding import HashEncoder, embed_queries
from folioloom.paths import LakePaths
from folioloom.session import new_folder
from folioloom.sources import blobs
from folioloom.sources.tables import scan



class CorpusLake:
    """Lookups, semantic search and full-text search. Every method returns a DataFrame.

    The point lookups and the semantic search run their first step, which finds one row or
    at most n, when called; all else is lazy.
    """

    def __init__(
        self, spark: SparkSession, paths: LakePaths | str, tokenizer=WordTokenizer(),
        encoder=HashEncoder(), overlap: int = 64, index_config: ann.IVFPQConfig | None = None,
    ):
        self.spark = spark
        self.paths = LakePaths(paths) if isinstance(paths, str) else paths
        self.tokenizer = tokenizer
        self.encoder = encoder
        self.overlap = overlap
        self.index_config = index_config

    # tables

    @property
    def documents(self) -> DataFrame:
        return scan(self.spark, self.paths.documents, schemas.DOCUMENTS)

    @property
    def chunks(self) -> DataFrame:
        return scan(self.spark, self.paths.chunks, schemas.CHUNKS)

    @property
    def embeddings(self) -> DataFrame:
        return scan(self.spark, self.paths.embeddings, schemas.EMBEDDINGS)

    @property
    def blobs(self) -> DataFrame:
        return blobs.BlobStore(self.spark, self.paths.blobs).read()

    @property
    def vector_meta(self) -> DataFrame:
        return ann.read_vector_meta(self.spark, f"{self.paths.vector_index(self.encoder.name)}/vector_meta")

    @cached_property
    def vector_index(self) -> ann.IVFPQIndex:
        if self.index_config is None:
            raise ValueError("index_config is needed to read the vector index")
        return ann.read_index(self.spark, self.paths.vector_index(self.encoder.name), self.index_config)

    @cached_property
    def text_index(self) -> fulltext.TextIndex:
        return fulltext.read_text_index(self.spark, self.paths.text_index)

    # lookups

    def get_document_from_doc_id(self, doc_id: str) -> DataFrame:
        return blobs.document_text(self.documents, blobs.BlobStore(self.spark, self.paths.blobs), doc_id)

    def get_chunks_from_doc_id(self, doc_id: str, select_columns: list[str] = lookup.DOC_CHUNK_COLUMNS) -> DataFrame:
        return lookup.chunks_of_document(self.chunks, doc_id, select_columns)

    def get_chunk_from_chunk_id(self, chunk_id: str, select_columns: list[str] = lookup.CHUNK_COLUMNS) -> DataFrame:
        return lookup.chunk_by_id(self.chunks, chunk_id, select_columns)

    def get_chunk_context(self, chunk_id: str, chunks_before: int = 1, chunks_after: int = 1) -> DataFrame:
        around = chunks.context(self.chunks, chunk_id, chunks_before, chunks_after)
        return around.select(*lookup.DOC_CHUNK_COLUMNS)

    def get_documents_by_date_range(self, year_min: int, year_max: int) -> DataFrame:
        return lookup.documents_between(self.documents, year_min, year_max)

    def merge_sequences(self, sequences: DataFrame, by: str = "doc_id") -> DataFrame:
        """Text of neighbouring chunks, such as a chunk context, put together per document."""
        return chunks.merge_chunks(sequences, self.tokenizer, self.overlap, by)

    # semantic search

    def query_vectors(self, query: str) -> DataFrame:
        asked = self.spark.sql("SELECT 0 AS query_id, :q AS text", args={"q": query})
        return embed_queries(asked, self.encoder)

    def _top(self, asked: DataFrame, n: int, year_min: int | None, year_max: int | None, n_probe: int, refine: int = 0) -> DataFrame:
        """The hits of one query, written to the shared folder.

        So they are not searched for again in every branch of a plan that uses them. What is joined with them by year and source
        leaves out the folders without a hit while it runs, however many hits there are.
        """
        if refine:
            vectors = self.embeddings.filter(F.col("model") == self.encoder.name)
            hits = ann.refined_search(self.vector_index, vectors, asked, n, year_min, year_max, n_probe, refine)
        else:
            hits = ann.search(self.vector_index, asked, n, year_min, year_max, n_probe)
        kept = new_folder(self.spark, "hits")
        hits.write.parquet(kept)
        # Spark prunes by a side that has a condition.
        return self.spark.read.schema(hits.schema).parquet(kept).filter(F.col("rank") <= n)

    def search(
        self, query: str, n: int = 10, year_min: int | None = None, year_max: int | None = None,
        n_probe: int = 64, with_text: bool = True, pad: bool = False, refine: int = 0,
    ) -> DataFrame:
        """Chunks nearest in meaning. With text: the chunk rows. Without: distances and labels
        with their chunk, nearest first; ``pad`` fills up to n places. ``refine`` ranks that many times n
        candidates by their stored vectors."""
        asked = self.query_vectors(query)
        hits = self._top(asked, n, year_min, year_max, n_probe, refine)
        if with_text:
            return semantic.chunks_of_hits(self.chunks, hits)
        if pad:
            labelled = semantic.pad_hits(hits, asked, n)
        else:
            labelled = hits.select("rank", F.col("distance").alias("distances"), F.col("faiss_id").alias("labels"), "chunk_id", "year", "source")
        found = semantic.attach_meta(labelled, self.vector_meta)
        return found.orderBy("rank").select("distances", "labels", *semantic.META)

    def search_with_text(
        self, query: str, n: int = 10, year_min: int | None = None, year_max: int | None = None, n_probe: int = 64,
    ) -> DataFrame:
        """Chunks nearest in meaning with text, rank and distance, nearest first."""
        hits = self._top(self.query_vectors(query), n, year_min, year_max, n_probe)
        return semantic.hits_with_text(self.chunks, hits).orderBy("rank")

    # full-text search

    def search_chunks(
        self, query: str, year_from: int | None = None, year_to: int | None = None,
        sources: list[str] | None = None, offset: int = 0, limit: int = 20,
        mode: str = "all", by_score: bool = False,
    ) -> DataFrame:
        """One page of chunks that match the words of the query.

        ``mode`` is ``all``, ``any`` or ``phrase``; ``by_score`` orders by BM25 (any word).
        """
        filters = {"year_from": year_from, "year_to": year_to, "sources": sources}
        if by_score:
            return fulltext.ranked_page(self.text_index, query, offset, limit, **filters)
        if mode == "phrase":
            hits = fulltext.phrase(self.text_index, query, **filters)
        else:
            hits = fulltext.match(self.text_index, query, mode, **filters)
        return fulltext.page(hits, offset, limit)
