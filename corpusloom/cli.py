"""Command line: one subcommand per pipeline.

    python -m corpusloom.cli prepare --input_dir data_inputs --output chunks
"""

from __future__ import annotations

import argparse
import sys
from functools import partial

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

from corpusloom import fixed_values as fixed
from corpusloom.functions.models import LeadGenerator, PretrainedGenerator, SentenceEmbedder, embedder_or_none
from corpusloom.functions.tokens import hashed_words
from corpusloom.operators.generation import FAN_IN
from corpusloom.operators.review import split_list
from corpusloom.plans import pipelines


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="corpusloom")
    commands = parser.add_subparsers(dest="command", required=True)

    prepare = commands.add_parser("prepare", help="CSV files to chunk records")
    source = prepare.add_mutually_exclusive_group(required=True)
    source.add_argument("--input_dir")
    source.add_argument("--input_file")
    prepare.add_argument("--output", required=True)
    prepare.add_argument("--max_chars", type=int, default=fixed.MAX_CHARS)
    prepare.add_argument("--text_column", default="full_text")
    prepare.add_argument("--no_chunk", action="store_true")
    prepare.add_argument("--row_once", action="store_true", help="keep the source row on a text's first chunk only")
    prepare.add_argument("--html_mode", choices=("regex", "dom"), default="regex", help="how markup is dropped: tags deleted, or text nodes joined")
    prepare.add_argument("--step_cap", action="store_true", help="the historical bound on chunk steps, which can lose tails")

    examples = commands.add_parser("examples", help="mixed folder, or one CSV file, to training examples")
    examples.add_argument("--input_dir", default="data_inputs")
    examples.add_argument("--max_chars", type=int, default=fixed.MAX_CHARS)
    examples.add_argument("--csv", "--input", dest="csv")
    examples.add_argument("--text-column", default="full_text")
    examples.add_argument("--instruction")
    examples.add_argument("--filter-empty", action="store_true")
    examples.add_argument("--html_mode", choices=("regex", "dom"), default="regex", help="how markup is dropped: tags deleted, or text nodes joined")
    examples.add_argument("--output", default="sft_dataset.jsonl")

    generate = commands.add_parser("generate", help="chunk records to summaries")
    generate.add_argument("--input", required=True)
    generate.add_argument("--output", required=True)
    generate.add_argument("--model", default="llama3.1", help="kept for compatibility; has no effect")
    generate.add_argument("--use_hf_fallback", action="store_true", help="use a transformers model")
    generate.add_argument("--hf_fallback_model")
    generate.add_argument("--max_gen", type=int, default=fixed.MAX_NEW_TOKENS)
    generate.add_argument("--fan_in", type=int, default=FAN_IN, help="most summaries in a prompt, more being reduced in levels; by default a prompt takes all")
    generate.add_argument("--ledger", help="folder of answers; a later run over it asks only what has no answer yet")
    generate.add_argument("--max_chars", type=int, help="kept for compatibility; has no effect")

    merge = commands.add_parser("merge", help="summaries to one record per source")
    merge.add_argument("--input", required=True)
    merge.add_argument("--output", required=True)
    merge.add_argument("--parts", action="store_true", help="one record per chunk, for sources that no cell can hold")

    export = commands.add_parser("export", help="JSONL to a flat review CSV")
    export.add_argument("--input", "-i", required=True)
    export.add_argument("--output", "-o", required=True)
    export.add_argument("--output-columns")
    export.add_argument("--include-original", action="store_true", help="kept for compatibility; has no effect")

    review = commands.add_parser("review", help="quality gate: review CSV and training JSONL")
    review.add_argument("--input", required=True)
    review.add_argument("--review", required=True)
    review.add_argument("--train", required=True)
    review.add_argument("--emb-check", action="store_true")
    review.add_argument("--emb-threshold", type=float, default=fixed.SIMILARITY_THRESHOLD)
    review.add_argument("--required-headings", default=",".join(fixed.REQUIRED_HEADINGS))
    review.add_argument("--sample", type=int, default=0)

    validate = commands.add_parser("validate", help="profile a folder of inputs")
    validate.add_argument("--input_dir", default="data_inputs")
    validate.add_argument("--max_examples", type=int, default=3)

    tokens = commands.add_parser("tokens", help="training records to token arrays")
    tokens.add_argument("--train_file", "--dataset", dest="train_file", required=True)
    tokens.add_argument("--output", required=True)
    tokens.add_argument("--cutoff_len", "--max_length", dest="max_length", type=int, default=fixed.CUTOFF_LEN)
    tokens.add_argument("--response_max_length", type=int)
    tokens.add_argument("--micro_batch_size", type=int, help="pad to the longest of each batch of this size")
    return parser


def _validate(spark: SparkSession, args: argparse.Namespace) -> int:
    """Prints a profile per file; files are few and samples short, so they come to the driver one by one."""
    try:
        files = pipelines.profile_folder(spark, args.input_dir).orderBy("file")
    except AnalysisException as missing:
        print(f"Input directory {args.input_dir} not found: {missing.getCondition()}", file=sys.stderr)
        return 2
    bad, seen = [], 0
    for row in files.toLocalIterator():
        seen += 1
        print(f"=== File: {row['file']} ({row['source_type']})")
        if row["error"]:
            bad.append(row["file"])
            print("  ERROR:", row["error"])
        elif row["samples"] is not None:
            print("  count:", row["count"])
            for sample in row["samples"][: args.max_examples]:
                print("  sample:", sample.strip()[: fixed.PROFILE_ITEM] or "(empty)")
        else:
            print("  sample:", (row["sample"] or "").strip()[:1000] or "(empty)")
    return 2 if bad or not seen else 0


def run(spark: SparkSession, argv: list[str]) -> int:
    args = _parser().parse_args(argv)
    if args.command == "prepare":
        count = pipelines.prepare_chunks(
            spark, args.input_dir or args.input_file, args.output, args.text_column, args.max_chars, args.no_chunk,
            html_mode=args.html_mode, row_once=args.row_once, step_cap=args.step_cap,
        )
        print(f"Wrote {count} chunks" if count else "No entries created - no valid data found")
    elif args.command == "examples" and args.csv:
        counts = pipelines.convert_csv(
            spark, args.csv, args.output, args.text_column, args.instruction, args.filter_empty, args.html_mode
        )
        print("Converted {converted} entries (skipped {skipped})".format(**counts))
    elif args.command == "examples":
        count, rejects = pipelines.prepare_documents(spark, args.input_dir, args.output, args.max_chars, args.html_mode)
        print(f"Wrote {count} examples")
        for row in rejects.orderBy("file").toLocalIterator():
            print(f"Warning: failed to read {row['file']}: {row['error']}")
    elif args.command == "generate":
        load = partial(PretrainedGenerator, args.hf_fallback_model) if args.use_hf_fallback else LeadGenerator
        print(pipelines.generate_summaries(spark, args.input, args.output, load, args.max_gen, args.fan_in, args.ledger))
    elif args.command == "merge":
        print(pipelines.merge_summaries_per_source(spark, args.input, args.output, whole=not args.parts))
    elif args.command == "export":
        columns = split_list(args.output_columns) if args.output_columns else None
        count, rejects = pipelines.export_review(spark, args.input, args.output, columns)
        print(f"Wrote {count} rows")
        for row in rejects.orderBy("line_number").toLocalIterator():
            print(f"Warning: skipping invalid JSONL line {row['line_number']}")
    elif args.command == "review":
        embedder = embedder_or_none(SentenceEmbedder) if args.emb_check else None
        count = pipelines.prepare_review(
            spark, args.input, args.review, args.train, embedder, args.emb_threshold,
            split_list(args.required_headings), args.sample,
        )
        print(f"Wrote {count} training examples")
    elif args.command == "validate":
        return _validate(spark, args)
    elif args.command == "tokens":
        count = pipelines.prepare_tokens(
            spark, args.train_file, args.output, hashed_words, args.max_length, args.response_max_length,
            args.micro_batch_size,
        )
        print(f"Wrote {count} token records")
    return 0


def main() -> None:
    # Records may repeat a key inside; without this setting they would be rejected.
    spark = SparkSession.builder.appName("corpusloom").config("spark.sql.variant.allowDuplicateKeys", "true").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    sys.exit(run(spark, sys.argv[1:]))


if __name__ == "__main__":
    main()
