"""Run one job of the lake: ``python -m folioloom <job> --base <folder> ...`` or under spark-submit."""

from __future__ import annotations

import argparse

from folioloom.functions.tokens import ModelTokenizer, WordTokenizer
from folioloom.operators.ann import IVFPQConfig
from folioloom.operators.embedding import HashEncoder, OnnxEncoder
from folioloom.paths import LakePaths
from folioloom.plans import jobs
from folioloom.session import build_session, fit_shuffles, new_folder, ship_package
from folioloom.streaming.ingest import ingest_stream


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="folioloom")
    top.add_argument("--base", required=True, help="root folder of the lake")
    todo = top.add_subparsers(dest="job", required=True)

    ingest = todo.add_parser("ingest", help="JSONL records into documents and blobs")
    ingest.add_argument("jsonl", nargs="+")
    ingest.add_argument("--metadata", required=True)
    ingest.add_argument("--source", default="ia")
    ingest.add_argument("--rejects", help="folder for malformed lines; without it such a line fails the job")
    ingest.add_argument("--stream", help="name of a stream: take in what is new in the one given folder")

    chunk = todo.add_parser("chunk", help="documents into chunks")
    chunk.add_argument("--window", type=int, default=512)
    chunk.add_argument("--overlap", type=int, default=64)
    chunk.add_argument("--tokenizer", help="tokenizer.json; words without it")

    embed = todo.add_parser("embed", help="chunks into embeddings")
    embed.add_argument("--onnx", help="model file on a path all executors can read; hashed words without it")
    embed.add_argument("--tokenizer")
    embed.add_argument("--name", help="model folder; hash-<dim> without it")
    embed.add_argument("--dim", type=int, default=64)

    index = todo.add_parser("index-vectors", help="embeddings into an index")
    index.add_argument("--model", required=True)
    index.add_argument("--dim", type=int, default=1024)
    index.add_argument("--lists", type=int, default=8192)
    index.add_argument("--m", type=int, default=64)
    index.add_argument("--bits", type=int, default=8)
    index.add_argument("--fraction", type=float, default=0.01)

    todo.add_parser("index-text", help="chunks into a full-text index")

    export = todo.add_parser("export", help="chunks as newline-delimited JSON")
    export.add_argument("--docs-per-file", type=int, default=0)
    export.add_argument("--gzip", action="store_true")
    return top


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = build_session(f"folioloom {args.job}")
    ship_package(spark)
    paths = LakePaths(args.base)
    tokenizer = ModelTokenizer.from_file(args.tokenizer) if getattr(args, "tokenizer", None) else WordTokenizer()
    sizes = {
        "ingest": getattr(args, "jsonl", []), "chunk": [paths.blobs], "embed": [paths.chunks],
        "index-vectors": [paths.embeddings], "index-text": [paths.chunks], "export": [paths.chunks],
    }
    fit_shuffles(spark, *sizes[args.job])
    if args.job == "ingest" and args.stream:
        ingest_stream(
            spark, args.jsonl[0], spark.read.parquet(args.metadata), paths,
            f"{args.base.rstrip('/')}/registry/streams/{args.stream}", args.source, args.stream,
        ).awaitTermination()
    elif args.job == "ingest":
        print(jobs.ingest(spark, args.jsonl, spark.read.parquet(args.metadata), paths, args.source, rejects=args.rejects))
    elif args.job == "chunk":
        jobs.chunk(spark, paths, tokenizer, args.window, args.overlap)
    elif args.job == "embed":
        name = args.name or f"hash-{args.dim}"
        encoder = OnnxEncoder(args.onnx, tokenizer, args.dim, name) if args.onnx else HashEncoder(args.dim, name=name)
        totals = jobs.embed(spark, paths, encoder)
        print(", ".join(f"{n} {name}" for name, n in totals.items()))
    elif args.job == "index-vectors":
        config = IVFPQConfig(args.lists, args.m, args.bits, args.dim)
        jobs.index_vectors(spark, paths, args.model, config, args.fraction)
    elif args.job == "index-text":
        jobs.index_text(spark, paths)
    elif args.job == "export":
        rejects = jobs.export(spark, paths, args.docs_per_file, args.gzip)
        kept = new_folder(spark, "rejects")
        rejects.write.json(kept)
        print(f"rows without an id or a year: {kept}")


if __name__ == "__main__":
    main()
