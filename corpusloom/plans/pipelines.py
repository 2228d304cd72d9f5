"""One function per command: files in, files out, counters back."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from corpusloom import fixed_values as fixed
from corpusloom.functions.classify import source_type
from corpusloom.functions.models import Embedder, LeadGenerator, TextGenerator
from corpusloom.functions.nested import JSON_OPTIONS
from corpusloom.functions.text import non_empty
from corpusloom.operators.chunks import chunk_rows
from corpusloom.operators.documents import examples_from_documents
from corpusloom.operators.export import exportable, flatten_record, header_names, ordered_headers
from corpusloom.operators.generation import FAN_IN, run_statistics, summarize_hierarchically
from corpusloom.operators.merging import merge_results, merge_statistics, record_pieces
from corpusloom.operators.profile import profile_records, record_sample, text_profile
from corpusloom.operators.review import review_rows, score, training_records
from corpusloom.operators.rows import map_fields, rows_to_examples
from corpusloom.operators.training import load_examples, pad_batches, tokenize_examples
from corpusloom.session import stored
from corpusloom.sources.csv_rows import read_csv_rows, with_unique_stems
from corpusloom.sources.directory import collect_documents, read_json_documents, read_text_files
from corpusloom.sources.lines import read_jsonl, read_jsonl_lenient
from corpusloom.sources.sinks import write_if, write_jsonl, write_long_records, write_map_csv, write_review_csv

CHUNK_SCHEMA = (
    "source_id string, chunk_index int, total_chunks int, prompt string, chunk_text string, "
    "original_row map<string,string>"
)
RESULT_SCHEMA = (
    "source_id string, generation_step string, chunk_index int, total_chunks int, chunk_summary string, "
    "chunk_summaries array<string>, final_summary string, source_metadata map<string,string>, "
    f"original_chunk struct<{', '.join(':'.join(field.split(' ', 1)) for field in CHUNK_SCHEMA.split(', '))}>"
)
EXAMPLE_SCHEMA = "instruction string, input string, output string, metadata variant"


class NothingToDo(ValueError):
    """The input holds nothing to process."""


def _counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Counts rows while they are written, without a further pass."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def prepare_chunks(
    spark: SparkSession,
    path: str,
    output: str,
    text_column: str = "full_text",
    max_chars: int = fixed.MAX_CHARS,
    no_chunk: bool = False,
    html_mode: str = "regex",
    row_once: bool = False,
    step_cap: bool = False,
) -> int:
    """CSV files to chunk records; no output if there is none."""
    rows, _ = read_csv_rows(spark, path)
    chunks = chunk_rows(with_unique_stems(rows, path), None, text_column, max_chars, no_chunk, html_mode, row_once=row_once, step_cap=step_cap)
    if chunks.isEmpty():
        return 0
    counted, seen = _counted(chunks, "chunks")
    write_jsonl(counted, output)
    return seen.get["rows"]


def prepare_documents(
    spark: SparkSession, path: str, output: str, max_chars: int = fixed.MAX_CHARS, html_mode: str = "regex"
) -> tuple[int, DataFrame]:
    """A folder of mixed files to training examples without outputs; (examples, rejects)."""
    documents, rejects = collect_documents(spark, path, html_mode)
    examples, seen = _counted(examples_from_documents(documents, max_chars=max_chars), "examples")
    write_jsonl(examples, output)
    return seen.get["rows"], rejects


def convert_csv(
    spark: SparkSession,
    path: str,
    output: str,
    text_column: str = "full_text",
    instruction: str | None = None,
    filter_empty: bool = False,
    html_mode: str = "regex",
) -> dict[str, int]:
    """A CSV file to training examples; counts of rows converted and skipped."""
    rows, _ = read_csv_rows(spark, path, glob="*")
    instruction = fixed.DEFAULT_INSTRUCTION if instruction is None else instruction

    def convert(source: DataFrame) -> DataFrame:
        return rows_to_examples(source, map_fields(), (), text_column, instruction, filter_empty, html_mode)

    if convert(rows).isEmpty():
        return {"converted": 0, "skipped": rows.count()}
    rows, read = _counted(rows, "rows")
    examples, written = _counted(convert(rows), "written")
    write_jsonl(examples, output)
    return {"converted": written.get["rows"], "skipped": read.get["rows"] - written.get["rows"]}


def generate_summaries(
    spark: SparkSession,
    path: str,
    output: str,
    load: Callable[[], TextGenerator] = LeadGenerator,
    max_gen: int = fixed.MAX_NEW_TOKENS,
    fan_in: int | None = FAN_IN,
    ledger: str | None = None,
) -> dict[str, int]:
    """Chunk records to chunk and final summaries; a run over the same ``ledger`` goes on where another one broke."""
    chunks = read_jsonl(spark, path, CHUNK_SCHEMA)
    results = summarize_hierarchically(chunks, load, max_gen, fan_in, ledger).drop("ordinal")
    write_jsonl(results, output, keep_nulls=False)
    return run_statistics(spark.read.schema("generation_step string").json(output)).first().asDict()


def merge_summaries_per_source(
    spark: SparkSession, path: str, output: str, whole: bool = True
) -> dict[str, int]:
    """Generation results to merged records, in order of source; as parts with a column ``part`` unless ``whole``.

    In either form no source is gathered: a whole record is written piece by piece.
    """
    results = read_jsonl(spark, path, RESULT_SCHEMA)
    if results.isEmpty():
        raise NothingToDo("No results found in input file")
    parts = stored(merge_results(results, whole=False), "merged-parts")
    if whole:
        write_long_records(record_pieces(parts), output, "source_id", ["section", "part"])
    else:
        write_jsonl(parts, output, order_by=["source_id", "part"], keep_nulls=False)
    return merge_statistics(parts).first().asDict()


def export_review(
    spark: SparkSession, path: str, output: str, columns: list[str] | None = None, strict: bool = False
) -> tuple[int, DataFrame]:
    """Any JSONL to a flat CSV; (rows, rejected lines). A record is exported whole or rejected."""
    records, rejects = read_jsonl_lenient(spark, path, usable=exportable)
    flat = records.select("ordinal", flatten_record("record", strict).alias("flat")).persist()
    count = flat.count()
    if count == 0:
        raise NothingToDo("No valid records found in input.")
    headers = columns or ordered_headers([row[0] for row in header_names(flat).collect()])  # a line holds them all
    write_map_csv(flat.orderBy("ordinal"), "flat", headers, output)
    flat.unpersist()
    return count, rejects


def prepare_review(
    spark: SparkSession,
    path: str,
    review_output: str,
    train_output: str,
    load_embedder: Callable[[], Embedder] | None = None,
    threshold: float = fixed.SIMILARITY_THRESHOLD,
    headings: list[str] | None = None,
    sample: int = 0,
) -> int:
    """Generated examples to a review CSV and the training records that pass the gate."""
    examples = read_jsonl(spark, path, EXAMPLE_SCHEMA, numbered=True).withColumnRenamed("ordinal", "idx")
    scored = score(examples, headings, load_embedder)
    if load_embedder:  # worth keeping for the second output; the headings are not
        scored = scored.persist()
    write_review_csv(review_rows(scored, sample), review_output, order_by=["idx"])
    training, seen = _counted(training_records(scored, threshold), "training")
    write_jsonl(training, train_output)
    scored.unpersist()
    return seen.get["rows"]


def prepare_tokens(
    spark: SparkSession,
    path: str,
    output: str,
    tokenizer,
    max_length: int,
    response_max: int | None = None,
    batch_size: int | None = None,
) -> int:
    """Training records to token arrays (Parquet), padded per batch if a batch size is given."""
    examples = load_examples(read_jsonl(spark, path, EXAMPLE_SCHEMA, numbered=batch_size is not None))
    return write_tokens(examples, output, tokenizer, max_length, response_max, batch_size)


def write_tokens(
    examples: DataFrame, output: str, tokenizer, max_length: int, response_max: int | None = None, batch_size: int | None = None
) -> int:
    """Token arrays as Parquet, published only if every example has an output; else the error names how many have none."""
    told = examples.withColumn("_empty", non_empty("output").isNull())
    tokens = tokenize_examples(told, tokenizer, max_length, response_max, ("ordinal", "_empty"))
    if batch_size:
        tokens = pad_batches(tokens, batch_size, idx="ordinal")
    message = "Found {empty} examples with empty 'output'. Provide targets before training."
    return write_if(tokens, output, {"empty": F.col("_empty")}, message, helpers=("_empty",))["rows"]


def profile_folder(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, source_type, count, samples, sample, length, error), one row per file of a folder."""
    records, json_rejects = read_json_documents(spark, path)
    texts = F.from_json("record", "map<string,string>", JSON_OPTIONS)
    sample = F.when(texts.isNull(), F.substring("record", 1, fixed.PROFILE_ITEM)).otherwise(record_sample(texts))
    lines, line_rejects = read_jsonl_lenient(spark, path, glob="*.[jJ][sS][oO][nN][lL]")
    structured = profile_records(records, sample).unionByName(profile_records(lines, sample, order="ordinal"))
    csv_rows, csv_rejects = read_csv_rows(spark, path, trim=False)
    tables = profile_records(csv_rows, record_sample("row"))
    files, text_rejects = read_text_files(spark, path)
    head, length = text_profile("text")
    plain = files.select("file", head.alias("sample"), length.alias("length"))
    bad_lines = line_rejects.groupBy("file").agg(
        F.concat(F.lit("invalid JSON in line "), F.min("line_number").cast("string")).alias("error")
    )
    errors = json_rejects.unionByName(bad_lines).unionByName(csv_rejects).unionByName(text_rejects)
    found = (
        structured.unionByName(tables)
        .unionByName(plain, allowMissingColumns=True)
        .unionByName(errors, allowMissingColumns=True)
    )
    one = [F.max(name).alias(name) for name in ("count", "samples", "sample", "length", "error")]
    return found.groupBy("file").agg(*one).withColumn("source_type", source_type("file", profile=True))
