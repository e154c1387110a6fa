"""Cutting documents into token windows, and putting windows together again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioloom.functions.text import content_digest
from folioloom.functions.tokens import WordTokenizer
from folioloom.schemas import CHUNKS, columns


def chunk_rows(
    documents: DataFrame, tokenizer=WordTokenizer(), window: int = 512, overlap: int = 64, tokens: bool = True,
) -> DataFrame:
    """Chunk rows of documents that carry their text. Narrow: no shuffle.

    ``tokens=False`` leaves that column out, for plans that go on with the text only.
    """
    head = documents.select(
        "doc_id", "year",
        F.coalesce("source", F.lit("")).alias("source"),
        F.coalesce("ingest_run_id", F.lit("")).alias("ingest_run_id"),
        "text",
    )
    cut = tokenizer.cut(head, "text", window, overlap, tokens).withColumn("text_checksum", content_digest(F.col("text")))
    name = F.concat_ws(":", "doc_id", "seq", "start_token", "end_token", "text_checksum")
    return cut.select(
        "*",
        content_digest(name).alias("chunk_id"),
        (F.col("end_token") - F.col("start_token")).alias("token_count"),
        F.current_timestamp().alias("created_at"),
    ).select(*[c for c in columns(CHUNKS) if tokens or c != "tokens"])


def check_reach(before: int, after: int) -> None:
    if before < 0 or after < 0:
        raise ValueError("before and after count chunks, they cannot be negative")


def neighbours(targets: DataFrame, chunks: DataFrame, before: int = 1, after: int = 1) -> DataFrame:
    """Chunks around each target (``chunk_id, doc_id, seq``), the target among them.

    The wanted positions are listed per target and found by equality on document and
    position. That keeps a document with very many chunks spread over all tasks, where a
    range condition would bring the whole document together.
    """
    check_reach(before, after)
    wanted = targets.select(
        F.col("chunk_id").alias("target_id"), "doc_id",
        F.explode(F.sequence(F.greatest(F.lit(0), F.col("seq") - before), F.col("seq") + after)).alias("seq"),
    )
    return wanted.join(chunks, ["doc_id", "seq"])


def context(chunks: DataFrame, chunk_id: str, before: int = 1, after: int = 1) -> DataFrame:
    """Neighbours of one chunk, in order; none for an unknown id.

    The position of the chunk is looked up first, so that the scan for its neighbours is a
    filter on document and position that the Parquet reader can use.
    """
    check_reach(before, after)
    target = chunks.filter(F.col("chunk_id") == chunk_id).select("doc_id", "seq").orderBy("doc_id", "seq").first()
    doc_id, seq = (target["doc_id"], target["seq"]) if target else (None, 0)
    around = F.col("seq").between(max(0, seq - before), seq + after)
    return chunks.filter((F.col("doc_id") == F.lit(doc_id)) & around).orderBy("seq")


def merge_chunks(chunks: DataFrame, tokenizer=WordTokenizer(), overlap: int = 64, by: str = "doc_id") -> DataFrame:
    """Put the chunks of each ``by`` value back together: ``by, text, n_chunks, merge_ok``.

    Neighbouring chunks have to agree on their ``overlap`` tokens and each position has to
    occur with one content only. Where that fails ``merge_ok`` is false and ``text`` null.
    Copies of a position are folded first, inside each task; what is then collected is no
    more than one row per position of the document.
    """
    if overlap < 0:
        raise ValueError("overlap cannot be negative")
    per_seq = (
        chunks.groupBy(by, "seq")
        .agg(F.min(F.struct("chunk_id", tokenizer.merges_on)).alias("c"), F.max("chunk_id").alias("last_id"))
        .select(by, "seq", (F.col("c.chunk_id") == F.col("last_id")).alias("single"),
                tokenizer.units(F.col(f"c.{tokenizer.merges_on}")).alias("units"))
    )
    gathered = per_seq.groupBy(by).agg(
        F.array_sort(F.collect_list(F.struct("seq", "units"))).alias("parts"),
        F.bool_and("single").alias("single"),
    )
    checked = gathered.select(
        by, F.size("parts").alias("n_chunks"), "parts",
        (F.col("single") & _agree(F.col("parts"), overlap)).alias("merge_ok"),
    )
    tails = F.transform("parts", lambda p, i: F.slice(
        p["units"], F.when(i == 0, F.lit(1)).otherwise(F.lit(overlap + 1)), F.greatest(F.size(p["units"]), F.lit(1))))
    joined = checked.select(by, "n_chunks", "merge_ok", F.flatten(tails).alias("merged"))
    return joined.select(
        by, F.when(F.col("merge_ok"), tokenizer.join(F.col("merged"))).alias("text"), "n_chunks", "merge_ok")


def _agree(parts: Column, overlap: int) -> Column:
    """Positions follow one another, and each part opens with the end of the part before."""
    follows = F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0)))
    pairs = F.zip_with(F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0))), follows, lambda a, b: F.struct(
        a.alias("a"), b.alias("b")))

    def fits(pair: Column) -> Column:
        ordered = pair["b"]["seq"] == pair["a"]["seq"] + 1
        if overlap == 0:
            return ordered
        size = F.size(pair["a"]["units"])
        tail = F.slice(pair["a"]["units"], F.greatest(size - overlap + 1, F.lit(1)), F.lit(overlap))
        return ordered & (tail == F.slice(pair["b"]["units"], 1, overlap))

    return F.forall(pairs, fits)


def vocabulary(texts: DataFrame, text: str = "text") -> DataFrame:
    """Words and their hashed ids. Words sharing an id are kept as separate rows."""
    from folioloom.functions.tokens import word_id, words

    return (
        texts.select(F.explode(words(F.col(text))).alias("word")).distinct()
        .select(word_id(F.col("word")).alias("token_id"), "word")
    )


def detokenize(rows: DataFrame, key: str, tokens: str, vocab: DataFrame) -> DataFrame:
    """Text of each row's ids, looked up in a vocabulary: ``key, text``.

    ``key`` is unique. Rows look up their distinct ids slice by slice, so the places of the words do not
    move one by one. Of two words under one id the first in order is taken.
    """
    from folioloom.functions.tokens import FIRST_WORD_ID
    from folioloom.plans.lookups import looked_up

    names = vocab.groupBy("token_id").agg(F.min("word").alias("word"))
    real = rows.select(key, F.filter(tokens, lambda t: t >= FIRST_WORD_ID).cast(T.ArrayType(vocab.schema["token_id"].dataType)).alias("ids"))
    return looked_up(real, key, "ids", names, "token_id", "word").select(key, F.array_join("found", " ").alias("text"))
