"""Training-order materialisation of token sequences.

Texts become token ids and are cut into sequences of fixed length. All sequences are numbered without gaps, and a
keyed Feistel permutation of these numbers, walked on until it lands inside their range, is the training order: slot i is known
from a number and a key alone, and nothing has to be sorted to shuffle the corpus. Slots are
dealt out in ranges, one range a shard, and a shard holds its sequences in slot order, each in the same number of
bytes. So a reader takes shards in turn, and resumes at a slot by its shard and its place there.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioloom.llm.common import stored
from folioloom.sources.tables import exists

TOKENIZER_FILE = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed values of the tokenizer file: how it cuts texts before merging, and the free id that ends a document.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
END = 50256
PAD = 0xFFFF
SEQUENCE = 256
PER_SHARD = 32_768
KEY = 0x5EED_F00D
ROUNDS = 6

MANIFEST = "doc_id long, seq int, slot long, n_tokens int, tokens binary"


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def tokenizer(ranks: dict[bytes, int]) -> tiktoken.Encoding:
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def _rounded(right: np.ndarray, key: int, turn: int, mask: np.uint64) -> np.ndarray:
    x = right ^ np.uint64((key + turn * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x ^ (x >> np.uint64(31))) & mask


def permuted(numbers: np.ndarray, size: int, key: int = KEY, back: bool = False) -> np.ndarray:
    """A permutation of 0 .. size - 1 (its inverse with ``back``): a Feistel network over the next even number of bits, walked
    on from values outside the range until it comes back into it. The range is over a quarter of the network's."""
    half = max(1, -(-max(1, (size - 1).bit_length()) // 2))
    mask, shift = np.uint64((1 << half) - 1), np.uint64(half)
    out = numbers.astype(np.uint64)
    walking = np.ones(len(out), bool)
    while walking.any():
        left, right = out[walking] >> shift, out[walking] & mask
        for turn in (reversed(range(ROUNDS)) if back else range(ROUNDS)):
            if back:
                left, right = right ^ _rounded(left, key, turn, mask), left
            else:
                left, right = right, left ^ _rounded(right, key, turn, mask)
        out[walking] = (left << shift) | right
        walking = out >= np.uint64(size)
    return out.astype(np.int64)


def _encoder(ranks, length: int):
    """A function from text to its ids with the end id, as bytes, and the number of sequences they fill."""
    encoding = tokenizer(ranks)

    def encode(text: str | None) -> tuple[bytes, int]:
        if not text:
            return b"", 0
        ids = encoding.encode_to_numpy(text, disallowed_special=())
        found = ids.astype("<u2").tobytes() + END.to_bytes(2, "little")
        return found, -(-len(found) // (2 * length))

    return encode


def write_training_order(docs: DataFrame, folder: str, tokenizer_file: str = TOKENIZER_FILE, length: int = SEQUENCE,
                         per_shard: int = PER_SHARD, key: int = KEY) -> int:
    """Write all sequences of ``docs`` in training order under ``folder``; returns their number.

    ``docs`` needs doc_id (a number) and text; other columns are ignored. The folder holds one ``shard=n`` folder per range of ``per_shard``
    slots, with rows (doc_id, seq, slot, n_tokens, tokens) in slot order; ``tokens`` has 2 * length bytes, 16-bit ids, the last sequence of a
    document filled up with 0xFFFF. Every document ends in the end id, and sequences do not go beyond a document. Null and empty texts have no
    sequence; null ids and repeated rows are kept. An empty table writes no sequence. A folder that was finished before is left as it is.

    Texts are encoded once. Each task numbers the sequences it makes from 0 and writes the ids of its documents to the shared folder with
    these numbers; the counts of the tasks, one row each, put the tasks behind each other. What was written fixes the order, so a task that is
    run again later finds the same numbers, whatever ``docs`` came out of. A whole new run over the same files in the same splits gives the same order.
    """
    spark = docs.sparkSession
    if exists(spark, f"{folder}/_SUCCESS"):
        return spark.read.parquet(folder).count()
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    ranks = spark.sparkContext.broadcast(read_ranks(tokenizer_file))

    def encoded(batches):
        encode, part, at = _encoder(ranks.value, length), TaskContext.get().partitionId(), 0
        for batch in batches:
            ids, firsts, counts, found = [], [], [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                data, n = encode(text)
                if n:
                    ids.append(doc_id)
                    firsts.append(at)
                    counts.append(n)
                    found.append(data)
                    at += n
            yield pa.RecordBatch.from_pydict({
                "part": pa.array([part] * len(ids), pa.int32()), "first": pa.array(firsts, pa.int64()), "n": pa.array(counts, pa.int64()),
                "doc_id": pa.array(ids, pa.int64()), "data": pa.array(found, pa.binary())})

    texts = stored(docs.mapInArrow(encoded, "part int, first long, n long, doc_id long, data binary"), "encoded", codec="zstd")
    # One row per task of the scan.
    bases, size = {}, 0
    for row in sorted(texts.groupBy("part").agg(F.sum("n").alias("n")).collect()):
        bases[row.part] = size
        size += row.n
    shared = spark.sparkContext.broadcast(bases)

    def place(batches):
        for batch in batches:
            part, first, n = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("part", "first", "n"))
            documents = batch.column("doc_id").take(pa.array(np.repeat(np.arange(len(n)), n)))
            seqs = np.concatenate([np.arange(k) for k in n]) if len(n) else np.zeros(0, np.int64)
            bases = np.array([shared.value[p] for p in part.tolist()], np.int64) + first
            slots = permuted(np.repeat(bases, n) + seqs, size, key)
            pieces = [data[at:at + 2 * length] for data in batch.column("data").to_pylist() for at in range(0, len(data), 2 * length)]
            yield pa.RecordBatch.from_pydict({
                "doc_id": documents, "seq": pa.array(seqs, pa.int32()), "slot": pa.array(slots, pa.int64()),
                "n_tokens": pa.array([len(p) // 2 for p in pieces], pa.int32()),
                "tokens": pa.array([p.ljust(2 * length, b"\xff") for p in pieces], pa.binary())})

    rows = texts.mapInArrow(place, MANIFEST).withColumn("shard", F.expr(f"cast(slot div {per_shard} AS int)"))
    shards = max(1, -(-size // per_shard))
    dealt = rows.repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", "slot")
    dealt.write.partitionBy("shard").option("compression", "zstd").parquet(folder)
    return size


def read_from(spark: SparkSession, folder: str, slot: int = 0, per_shard: int = PER_SHARD) -> DataFrame:
    """The written sequences from a slot on; shards before it are not opened."""
    rows = spark.read.schema(MANIFEST + ", shard int").parquet(folder)
    return rows.filter((F.col("shard") >= slot // per_shard) & (F.col("slot") >= slot))


def training_order(spark: SparkSession, folder: str, per_shard: int = PER_SHARD, length: int = SEQUENCE) -> DataFrame:
    """One row per written sequence: doc_id, seq, slot, shard, offset (bytes into the shard's tokens), n_tokens, tokens_crc32."""
    return read_from(spark, folder).select(
        "doc_id", "seq", "slot", "shard", (F.col("slot") % per_shard * 2 * length).alias("offset"), "n_tokens",
        F.crc32("tokens").alias("tokens_crc32"))
