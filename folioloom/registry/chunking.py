"""Tokens, windows, chunks and lookups of chunks."""

from __future__ import annotations

from pyspark.sql import functions as F

from folioloom.functions import tokens as tk
from folioloom.functions.text import prefixed
from folioloom.operators import chunks as ops
from folioloom.operators import lookup
from folioloom.operators.vocabulary import Vocabulary
from folioloom.registry import inputs as i
from folioloom.registry.book import query
from folioloom.registry.inputs import with_ctes
from folioloom.registry.storage import CHUNK_SQL, shown_chunks
from folioloom.session import new_folder
from folioloom.sources.tables import append

WORD_IDS = "list_transform(regexp_extract_all({text}, '[^ \\t\\n\\r]+'), lambda z: ('0x' || substr(sha256(z), 1, 7))::bigint + 4)"


@query("tokenize", with_ctes(["plain"], f"""
    select doc_id, array_to_string(list_concat([1], {WORD_IDS.format(text='text')}, [2]), ',') as tokens from plain"""))
def tokenize(spark, sf_dir):
    documents = i.plain_documents(spark, sf_dir)
    return documents.select("doc_id", i.joined(i.TOKENIZER.encode(F.col("text"))).alias("tokens"))


PLAIN_WORDS = "regexp_extract_all(text, '[^ \\t\\n\\r]+')"


@query("detokenize", with_ctes(["plain"], """
    select p.doc_id, coalesce(string_agg(v.word, ' ' order by w.pos), '') as text
    from plain p left join w on w.doc_id = p.doc_id left join v on v.id = substr(sha256(w.word), 1, 7) group by 1""", {
    "w": f"select doc_id, unnest({PLAIN_WORDS}) as word, unnest(range(len({PLAIN_WORDS}))) as pos from plain",
    "v": "select substr(sha256(word), 1, 7) as id, min(word) as word from w group by 1",
}))
def detokenize(spark, sf_dir):
    documents = i.plain_documents(spark, sf_dir)
    coded = documents.select("doc_id", i.TOKENIZER.encode(F.col("text")).alias("tokens"))
    return ops.detokenize(coded, "doc_id", "tokens", ops.vocabulary(documents))


def _dictionary(spark, sf_dir) -> Vocabulary:
    """Words of the labelled documents first, then what the others add."""
    documents = i.plain_documents(spark, sf_dir)
    labelled = i.table(spark, sf_dir, "labels").select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("doc_id"))
    kept = Vocabulary(spark, new_folder(spark, "vocabulary"))
    for joined in ("left_semi", "left_anti"):
        kept.extend(documents.join(labelled, "doc_id", joined))
    return kept


@query("vocabulary_extended", with_ctes(["plain"], """
    select word, 3 + row_number() over (order by later, word) as token_id from first_seen""", {
    "w": f"select doc_id not in (select 'd' || doc_id from labels) as later, unnest({PLAIN_WORDS}) as word from plain",
    "first_seen": "select word, min(later) as later from w group by 1",
}))
def vocabulary_extended(spark, sf_dir):
    """Dense ids: those of the first run in the order of its words, then those of the second run's new words."""
    return _dictionary(spark, sf_dir).read()


@query("vocabulary_round_trip", with_ctes(["plain"], f"""
    select doc_id, len({PLAIN_WORDS})::int as n_tokens, array_to_string({PLAIN_WORDS}, ' ') as text from plain"""))
def vocabulary_round_trip(spark, sf_dir):
    """Texts as dense ids and back: each word comes back as it was."""
    documents = i.plain_documents(spark, sf_dir)
    kept = _dictionary(spark, sf_dir)
    coded = kept.encode(documents, "doc_id")
    texts = ops.detokenize(coded, "doc_id", "tokens", kept.read())
    return coded.join(texts, "doc_id").select("doc_id", F.size("tokens").alias("n_tokens"), "text")


@query("prefix_text", with_ctes(["chunks"], "select chunk_id, 'passage: ' || text as text from chunks"))
def prefix_text(spark, sf_dir):
    return i.chunk_texts(spark, sf_dir).select("chunk_id", prefixed(F.col("text"), "passage").alias("text"))


@query("pad_truncate", with_ctes(["plain"], f"""
    select doc_id, array_to_string(list_concat(kept, list_transform(range(greatest(0, 32 - len(kept))), lambda z: 0)), ',') as ids,
           array_to_string(list_transform(range(32), lambda z: case when z < len(kept) then 1 else 0 end), ',') as mask
    from (select doc_id, list_concat([1], list_slice({WORD_IDS.format(text='text')}, 1, 30), [2]) as kept from plain)"""))
def pad_truncate(spark, sf_dir):
    coded = i.plain_documents(spark, sf_dir).select("doc_id", i.TOKENIZER.encode(F.col("text")).alias("ids"))
    kept = coded.select("doc_id", tk.truncate(F.col("ids"), 32).alias("kept"))
    return kept.select(
        "doc_id", i.joined(tk.pad(F.col("kept"), 32)).alias("ids"),
        i.joined(tk.attention_mask(F.col("kept"), 32)).alias("mask"))


@query("token_windows", with_ctes(["chunks"], "select doc_id, seq, start_token, end_token from chunks"))
def token_windows(spark, sf_dir):
    counted = i.plain_documents(spark, sf_dir).select("doc_id", (F.size(tk.words(F.col("text"))) + 2).alias("n"))
    return counted.select("doc_id", F.inline(tk.token_windows(F.col("n"), i.WINDOW, i.OVERLAP)))


@query("chunk_rows", with_ctes(["chunks"], CHUNK_SQL.replace("lake_chunks", "chunks")))
def chunk_rows(spark, sf_dir):
    return shown_chunks(i.chunks(spark, sf_dir))


@query("merge_sequences", with_ctes(["chunks", "plain"], """
    select p.doc_id, array_to_string(regexp_extract_all(p.text, '[^ \\t\\n\\r]+'), ' ') as text,
           c.n_chunks, true as merge_ok
    from plain p join (select doc_id, count(*)::int as n_chunks from chunks group by 1) c on c.doc_id = p.doc_id"""))
def merge_sequences(spark, sf_dir):
    return ops.merge_chunks(i.chunk_texts(spark, sf_dir), i.TOKENIZER, i.OVERLAP)


@query("chunks_by_doc", with_ctes(["chunks"], "select doc_id, chunk_id, seq, text, year, source, tokens from chunks where doc_id = 'd21'"))
def chunks_by_doc(spark, sf_dir):
    found = lookup.chunks_of_document(i.chunks(spark, sf_dir), "d21")
    return found.withColumn("tokens", i.joined(F.col("tokens")))


@query("chunk_by_id", with_ctes(["chunks"], """
    select doc_id, chunk_id, seq, text, year, source from chunks where chunk_id = (select min(chunk_id) from chunks)"""))
def chunk_by_id(spark, sf_dir):
    """The chunk with the first id in order."""
    chunks = i.chunk_texts(spark, sf_dir)
    return lookup.chunk_by_id(chunks, chunks.agg(F.min("chunk_id")).scalar())


@query("chunk_by_id_stored", with_ctes(["chunks"], """
    select doc_id, chunk_id, seq, text, year, source from chunks where chunk_id = (select min(chunk_id) from chunks)"""))
def chunk_by_id_stored(spark, sf_dir):
    """The same from a table on disk, whose files hold Bloom filters of the ids."""
    path = new_folder(spark, "chunks")
    append(i.chunk_texts(spark, sf_dir), path, sort_by=["doc_id", "seq"], bloom=["chunk_id"])
    chunks = spark.read.parquet(path)
    return lookup.chunk_by_id(chunks, chunks.agg(F.min("chunk_id")).scalar())


@query("chunk_context", with_ctes(["chunks"], """
    select t.chunk_id as target_id, c.doc_id, c.chunk_id, c.seq, c.text, c.year, c.source
    from chunks t join chunks c on c.doc_id = t.doc_id and c.seq between greatest(0, t.seq - 1) and t.seq + 2"""))
def chunk_context(spark, sf_dir):
    """One chunk before and two after, for every chunk."""
    chunks = i.chunk_texts(spark, sf_dir)
    around = ops.neighbours(chunks.select("chunk_id", "doc_id", "seq"), chunks, before=1, after=2)
    return around.select("target_id", "doc_id", "chunk_id", "seq", "text", "year", "source")
