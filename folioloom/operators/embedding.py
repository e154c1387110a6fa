"""Vectors for texts."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioloom.functions.text import prefixed
from folioloom.functions.tokens import FIRST_WORD_ID, PAD_ID, ModelTokenizer, WordTokenizer, word_ids, words
from folioloom.functions.vectors import MIN_COUNT, MIN_NORM, list_column, vector_ok
from folioloom.schemas import EMBEDDINGS, columns

MAX_TOKENS = 512


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    norms = np.sqrt(np.square(vectors).sum(axis=1, keepdims=True))
    return (vectors / np.maximum(norms, MIN_NORM)).astype(np.float32)


@dataclass(frozen=True)
class HashEncoder:
    """Signed bag of hashed tokens, averaged over the text and brought to unit length.

    Deterministic and free of any model. A token id beyond the reserved ones adds +1 or -1
    (by the parity of ``id // dim``) to component ``id % dim``.
    """

    dim: int = 64
    max_tokens: int = MAX_TOKENS
    tokenizer: WordTokenizer = field(default_factory=WordTokenizer)
    name: str = "hash-64"

    def encode(self, text: Column) -> Column:
        dim = self.dim
        plain = type(self.tokenizer) is WordTokenizer

        def run(found: pa.Array) -> pa.Array:
            rows = len(found)
            lengths = np.diff(found.offsets.to_numpy())
            row = np.repeat(np.arange(rows), lengths)
            if plain:
                # a word of the batch is hashed once, however often it comes
                coded = found.flatten().dictionary_encode()
                token = word_ids(coded.dictionary)[coded.indices.to_numpy(zero_copy_only=False)]
            else:
                token = found.flatten().to_numpy(zero_copy_only=False)
            word = token >= FIRST_WORD_ID
            row, token = row[word], token[word] - FIRST_WORD_ID
            sign = 1.0 - 2.0 * ((token // dim) % 2)
            sums = np.bincount(row * dim + token % dim, weights=sign, minlength=rows * dim).reshape(rows, dim)
            counts = np.maximum(np.bincount(row, minlength=rows), MIN_COUNT)
            return list_column(unit_rows(sums / counts[:, None]))

        units = F.slice(words(text), 1, self.max_tokens - 2 * self.tokenizer.frame) if plain else self.tokenizer.encode(text, self.max_tokens)
        return F.arrow_udf(run, "array<float>")(units)


@dataclass(frozen=True)
class OnnxEncoder:
    """A transformer exported to ONNX: padded ids and mask in, token states out.

    States are averaged under the mask and brought to unit length. Each Python worker opens
    the model once. ``model`` is a path every executor can read; ``providers`` names the
    devices to run on, such as ``("CUDAExecutionProvider",)`` where executors have them.
    """

    model: str
    tokenizer: ModelTokenizer
    dim: int
    name: str
    max_tokens: int = MAX_TOKENS
    batch: int = 512
    providers: tuple[str, ...] = ("CPUExecutionProvider",)

    def encode(self, text: Column) -> Column:
        model, size, limit, providers = self.model, self.batch, self.max_tokens, self.providers
        dim = self.dim

        def run(ids: pa.Array) -> pa.Array:
            states = _model(model, providers)
            rows = ids.to_pylist()
            out = [encode_ids(states, rows[lo:lo + size], limit) for lo in range(0, len(rows), size)]
            return list_column(np.concatenate(out) if out else np.zeros((0, dim), np.float32))

        return F.arrow_udf(run, "array<float>")(self.tokenizer.encode(text, limit))


def encode_ids(states, rows: list[list[int]], limit: int) -> np.ndarray:
    """Unit mean vectors of token id lists; ``states(ids, mask)`` gives N x T x D token states."""
    ids = np.full((len(rows), limit), PAD_ID, dtype=np.int64)
    mask = np.zeros((len(rows), limit), dtype=np.int64)
    for i, row in enumerate(rows):
        ids[i, :len(row)] = row
        mask[i, :len(row)] = 1
    hidden = states(ids, mask)
    weights = mask[:, :, None].astype(hidden.dtype)
    return unit_rows((hidden * weights).sum(axis=1) / np.maximum(weights.sum(axis=1), MIN_COUNT))


_MODELS: dict[tuple[str, tuple[str, ...]], object] = {}


def _model(path: str, providers: tuple[str, ...]):
    """Token-state function of the model, opened on first use in this worker process."""
    key = (path, providers)
    if key not in _MODELS:
        import onnxruntime

        session = onnxruntime.InferenceSession(path, providers=list(providers))
        names = {i.name for i in session.get_inputs()}

        def states(ids, mask):
            feed = {"input_ids": ids, "attention_mask": mask, "token_type_ids": np.zeros_like(ids)}
            return session.run(None, {k: v for k, v in feed.items() if k in names})[0]

        _MODELS[key] = states
    return _MODELS[key]


def embed(df: DataFrame, encoder, role: str, text: str = "text") -> DataFrame:
    """``df`` with a ``vector`` for its text under the given role (``passage`` or ``query``)."""
    return df.withColumn("vector", encoder.encode(prefixed(F.col(text), role)))


def embed_chunks(chunks: DataFrame, encoder) -> DataFrame:
    """Embedding rows of chunks."""
    read = chunks.select("chunk_id", "doc_id", "year", "source", "text")
    return embed(read, encoder, "passage").select(
        "chunk_id", "doc_id", "year", "source", F.lit(encoder.name).alias("model"), "vector",
        F.size("vector").alias("dim"), F.current_timestamp().alias("created_at"),
    ).select(*columns(EMBEDDINGS))


def check_vectors(embeddings: DataFrame, dim: int) -> tuple[DataFrame, DataFrame]:
    """Rows whose vector is whole and of length ``dim``, and the others."""
    good = vector_ok(F.col("vector"), dim)
    return embeddings.filter(good), embeddings.filter(~good)


def embed_queries(queries: DataFrame, encoder, text: str = "text") -> DataFrame:
    """Query vectors: ``query_id, vector``."""
    return embed(queries, encoder, "query", text).select("query_id", "vector")
