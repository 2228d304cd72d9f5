"""Queries over the benchmark tables, one or more per operator.

The tables are no document collections, so each query first states how their
columns stand for the operator's input. Every query reads its tables whole.
"""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.functions.chunking import chunk_text
from corpusloom.functions.classify import instruction_for, is_error, is_transient, source_type
from corpusloom.functions.models import LeadGenerator, WordCountEmbedder
from corpusloom.functions.nested import response_text
from corpusloom.functions.prompts import build_prompt
from corpusloom.functions.sentences import dedup_text
from corpusloom.functions.similarity import cosine, jaccard
from corpusloom.functions.text import clean_field, clean_text, strip_html
from corpusloom.functions.titles import extract_title
from corpusloom.functions.tokens import hashed_words, token_budget
from corpusloom.operators.chunks import chunk_rows, explode_chunks
from corpusloom.operators.documents import examples_from_documents
from corpusloom.operators.export import flatten_record, header_names, output_field, parse_record, review_table
from corpusloom.operators.generation import run_statistics, summarize_hierarchically
from corpusloom.operators.groups import collect_ordered, final_prompts
from corpusloom.operators.merging import last_per_key, merge_results, merge_statistics, record_pieces
from corpusloom.operators.profile import profile_records, record_sample
from corpusloom.operators.review import input_output_similarity, missing_headings, review_rows, score, training_records
from corpusloom.operators.rows import chunk_source_text, column_fields, rows_to_examples
from corpusloom.operators.training import empty_outputs, load_examples, pad_batches, tokenize_examples
from corpusloom.plans.pipelines import profile_folder, write_tokens
from corpusloom.session import shared_folder, spread, stored
from corpusloom.sources.csv_rows import read_csv_rows
from corpusloom.sources.directory import collect_documents, documents_of_records, documents_of_rows
from corpusloom.sources.lines import parquet_ordinal, read_jsonl, read_jsonl_lenient
from corpusloom.sources.sinks import RuleBroken, write_jsonl, write_long_records, write_review_csv

HEADINGS = ["The", "der ", "la"]
GATE_HEADINGS = ["."]
FILE_WORDS = ["solutions", "experiments", "action_list", "work_plan", "blog_posts", "notes"]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(_table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"))


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(_table(spark, sf_dir, "pages"))


def _conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "conversations")


def _file_name() -> Column:
    """A file name per source, with words the source types are told by."""
    words = F.array(*map(F.lit, FILE_WORDS))
    number = F.regexp_extract("source", r"(\d+)", 1).cast("int")
    return F.concat("source", F.lit("_"), F.get(words, number % len(FILE_WORDS)), F.lit(".csv"))


# --- text functions -------------------------------------------------------------


def clean_documents(spark, sf_dir):
    return _documents(spark, sf_dir).select("doc_id", clean_text("text").alias("clean"))


def page_text_regex(spark, sf_dir):
    return _pages(spark, sf_dir).select("page_id", strip_html("html").alias("plain"), clean_field("html").alias("clean"))


def page_text_dom(spark, sf_dir):
    return _pages(spark, sf_dir).select("page_id", clean_field("html", "dom").alias("clean"))


def document_titles(spark, sf_dir):
    return _documents(spark, sf_dir).select("doc_id", extract_title("text").alias("title"))


def source_types(spark, sf_dir):
    names = _documents(spark, sf_dir).select("doc_id", _file_name().alias("file"))
    urls = _pages(spark, sf_dir).select(F.col("page_id").alias("doc_id"), F.col("url").alias("file"))
    kind = source_type("file").alias("source_type")
    profile = source_type("file", profile=True).alias("profile_type")
    return names.unionByName(urls).select("doc_id", "file", kind, profile, instruction_for(source_type("file")).alias("instruction"))


def turn_word_overlap(spark, sf_dir):
    """Shared words of each turn and the one after it."""
    words = _conversations(spark, sf_dir).select("conv_id", "turn", F.split(F.lower("text"), " ").alias("words"))
    following = words.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("words").alias("next"))
    pairs = words.join(following, ["conv_id", "turn"])
    return pairs.select("conv_id", "turn", F.round(jaccard("words", "next"), 6).alias("overlap"))


# --- chunking -------------------------------------------------------------------


def _chunks(max_chars: int, overlap: int, sentence_aware: bool = True, step_cap: bool = False):
    def query(spark, sf_dir):
        chunks = chunk_text("text", max_chars, overlap, sentence_aware, step_cap)
        return explode_chunks(_documents(spark, sf_dir), chunks, "doc_id")

    return query


def _document_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as rows of CSV files: (file, row_index, row)."""
    titled = _documents(spark, sf_dir).withColumn("title", extract_title("text"))
    row = F.create_map(F.lit("title"), "title", F.lit("lang"), "lang", F.lit("full_text"), "text")
    return titled.select(_file_name().alias("file"), F.col("doc_id").alias("row_index"), row.alias("row"))


def chunk_records(spark, sf_dir):
    row = F.col("original_row")
    lineage = row["title"].alias("row_title"), row["lang"].alias("row_lang"), F.md5(row["full_text"].cast("binary")).alias("row_text_md5")
    return chunk_rows(_document_rows(spark, sf_dir)).select("*", *lineage).drop("original_row")


def whole_text_records(spark, sf_dir):
    return chunk_rows(_document_rows(spark, sf_dir), no_chunk=True).select(
        "source_id", "chunk_index", "total_chunks", "prompt", F.col("original_row")["lang"].alias("lang")
    )


# --- rows and documents to examples -----------------------------------------------


def fallback_text_columns(spark, sf_dir):
    """Too short a ``full_text`` and an empty ``body`` fall through to later columns."""
    documents = _documents(spark, sf_dir)
    lang = F.col("lang")
    rows = documents.select(
        "doc_id",
        F.when(lang == "en", F.col("text")).otherwise(F.lit("<i>n/a</i>")).alias("full_text"),
        F.when(lang == "de", F.col("text")).otherwise(F.lit("")).alias("body"),
        F.when(lang != "fr", F.col("text")).alias("description"),
        F.concat(F.lit("<p>"), "text", F.lit("</p>")).alias("sections"),
    )
    return rows.select("doc_id", chunk_source_text(column_fields(rows)).alias("text"))


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a verbal label where there is one, and a title for some."""
    quality = F.when(F.col("quality") == 1, F.lit("<b>good</b>  text")).otherwise(F.lit("poor text"))
    labels = _table(spark, sf_dir, "labels").select("doc_id", quality.alias("label"))
    documents = _documents(spark, sf_dir).withColumn("title", F.when(F.col("lang") == "en", F.col("source")))
    return documents.withColumn("section", F.lit("ignored")).join(labels, "doc_id", "left")


def examples_from_rows(spark, sf_dir):
    rows = _labelled(spark, sf_dir)
    return rows_to_examples(rows, column_fields(rows), ("doc_id",))


def labelled_examples_only(spark, sf_dir):
    rows = _labelled(spark, sf_dir)
    return rows_to_examples(rows, column_fields(rows), ("doc_id",), filter_empty=True)


def examples_from_texts(spark, sf_dir):
    documents = _documents(spark, sf_dir).select(
        "doc_id", _file_name().alias("file"), extract_title("text").alias("title"), clean_text("text").alias("text")
    )
    examples = examples_from_documents(documents, ("doc_id",))
    return examples.select("doc_id", "instruction", "input", "output", "metadata.*")


def _page_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    record = F.to_json(F.struct("page_id", F.col("url").alias("name"), "html"))
    return _pages(spark, sf_dir).select(F.lit("pages.json").alias("file"), F.col("page_id").alias("row_index"), record.alias("record"))


def record_documents(spark, sf_dir):
    """Pages as free-form records: the longest string field is the text."""
    return documents_of_records(_page_records(spark, sf_dir))


def record_documents_dom(spark, sf_dir):
    return documents_of_records(_page_records(spark, sf_dir), "dom")


def nested_section_documents(spark, sf_dir):
    """Turns as records whose ``sections`` nest the text: JSON, JSON in a string, or plain."""
    inner = F.struct(F.col("role").alias("k"), F.col("text").alias("body"), F.struct(F.col("role").alias("title")).alias("z"))
    as_json = F.to_json(F.struct(F.array(inner).alias("sections")))
    as_string = F.to_json(F.struct(F.to_json(F.struct(F.lit("x").alias("lead"), F.to_json(inner).alias("html"))).alias("sections")))
    plain = F.to_json(F.struct(F.concat(F.lit("[not json "), "text").alias("sections")))
    record = F.when(F.col("role") == "user", as_json).when(F.col("role") == "assistant", as_string).otherwise(plain)
    rows = _conversations(spark, sf_dir).select(
        F.col("conv_id").cast("string").alias("file"), F.col("turn").alias("row_index"), record.alias("record")
    )
    return documents_of_records(rows)


def table_row_documents(spark, sf_dir):
    row = F.create_map(F.lit("name"), "source", F.lit("full_text"), F.when(F.col("lang") == "en", F.col("text")), F.lit("note"), "text")
    rows = _documents(spark, sf_dir).select(
        F.col("source").alias("file"), F.col("doc_id").alias("row_index"), row.alias("row")
    )
    return documents_of_rows(rows)


# --- groups, generation, merging ----------------------------------------------------


def _turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns as chunk summaries of their conversation, very short ones as failures."""
    summary = F.when(F.length("text") < 80, F.concat(F.lit("Error: "), "text")).otherwise(F.col("text"))
    return _conversations(spark, sf_dir).select(
        F.col("conv_id").cast("string").alias("source_id"),
        F.col("turn").cast("int").alias("chunk_index"),
        F.col("turn").alias("ordinal"),
        summary.alias("chunk_summary"),
        F.concat(F.lit("Conversation "), F.col("conv_id").cast("string")).alias("title"),
        F.when(F.col("turn") > 0, F.lit("chat.csv")).otherwise(F.lit("")).alias("source_filename"),
        "role",
    )


def ordered_turns(spark, sf_dir):
    grouped = collect_ordered(_turns(spark, sf_dir), "chunk_summary")
    return grouped.select("source_id", F.size("texts").alias("n"), F.array_join("texts", "\n").alias("texts"))


def ordered_turns_large(spark, sf_dir):
    grouped = collect_ordered(_turns(spark, sf_dir), "chunk_summary", whole=False)
    return grouped.select("source_id", F.col("part.chunk_index").alias("part"), F.array_join("texts", "\n").alias("texts"))


def final_prompt_per_source(spark, sf_dir):
    return final_prompts(_turns(spark, sf_dir)).select("source_id", "prompt")


def final_prompt_lines(spark, sf_dir):
    lines = final_prompts(_turns(spark, sf_dir), whole=False)
    return lines.withColumn("part", F.coalesce("part", F.lit(-1)))


def sentence_dedup(spark, sf_dir):
    return _documents(spark, sf_dir).select("doc_id", dedup_text("text").alias("text"))


def _results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Generation results: a system turn is the final summary (some empty), others are chunk summaries."""
    turns = _turns(spark, sf_dir)
    is_final = F.col("role") == "system"
    text = F.when(F.length("chunk_summary") > 150, F.col("chunk_summary")).otherwise(F.lit(""))
    row = F.create_map(F.lit("title"), "title", F.lit("role"), "role")
    return turns.select(
        "source_id",
        F.when(is_final, F.lit("final_summary")).otherwise(F.lit("chunk_summary")).alias("generation_step"),
        F.when(~is_final, F.col("chunk_index")).alias("chunk_index"),
        F.when(is_final, F.lit(99)).alias("total_chunks"),
        F.when(~is_final, F.col("chunk_summary")).alias("chunk_summary"),
        F.when(is_final, F.array("source_id", "title")).alias("chunk_summaries"),
        F.when(is_final, text).alias("final_summary"),
        F.when(is_final, row).alias("source_metadata"),
        F.when(~is_final, F.struct(row.alias("original_row"))).alias("original_chunk"),
        "ordinal",
    )


def _merged(merged: DataFrame) -> DataFrame:
    return merged.select(
        "source_id",
        "total_chunks",
        "final_summary",
        F.array_join("chunk_summaries", "|").alias("chunk_summaries"),
        F.coalesce(F.col("original_row")["role"], F.lit("")).alias("role"),
        "processing_step",
    )


def merged_results(spark, sf_dir):
    return _merged(merge_results(_results(spark, sf_dir)))


def merged_results_large(spark, sf_dir):
    """The same as parts, no source being gathered."""
    merged = merge_results(_results(spark, sf_dir), whole=False)
    return _merged(merged)


def merged_records_streamed(spark, sf_dir):
    """The same, written piece by piece as one JSON line per source and read back."""
    folder = f"{_scratch(spark)}/merged"
    parts = stored(merge_results(_results(spark, sf_dir), whole=False), "merged-parts")
    write_long_records(record_pieces(parts), folder, "source_id", ["section", "part"])
    schema = (
        "source_id string, total_chunks int, final_summary string, chunk_summaries array<string>, "
        "source_metadata map<string,string>, processing_step string, original_row map<string,string>"
    )
    return _merged(read_jsonl(spark, folder, schema))


def merged_totals(spark, sf_dir):
    return merge_statistics(merge_results(_results(spark, sf_dir)))


def last_event_per_user(spark, sf_dir):
    events = _table(spark, sf_dir, "events")
    return last_per_key(events, ["user_id", "event_type"], F.struct("ts", "event_id"), "event_id", "value")


def _chunk_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _documents(spark, sf_dir).select(
        F.col("source").alias("file"),
        F.col("doc_id").alias("row_index"),
        F.create_map(F.lit("title"), "lang", F.lit("full_text"), "text").alias("row"),
    )
    return chunk_rows(rows).withColumn("ordinal", F.col("chunk_index").cast("bigint"))


def hierarchical_summaries(spark, sf_dir):
    results = summarize_hierarchically(_chunk_input(spark, sf_dir), LeadGenerator, max_gen=30)
    text = F.when(F.col("generation_step") == "final_summary", F.col("final_summary")).otherwise(F.col("chunk_summary"))
    index = F.coalesce("chunk_index", F.lit(-1)).alias("chunk_index")
    return results.select("source_id", "generation_step", index, "total_chunks", text.alias("summary"))


def generation_totals(spark, sf_dir):
    return run_statistics(summarize_hierarchically(_chunk_input(spark, sf_dir), LeadGenerator, max_gen=30))


# --- review, gate, export -----------------------------------------------------------


def heading_check(spark, sf_dir):
    missing = missing_headings("text", HEADINGS)
    return _documents(spark, sf_dir).select("doc_id", F.array_join(missing, ";").alias("missing"))


def _examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns as examples in table order; only assistants give an output."""
    turns = parquet_ordinal(_conversations(spark, sf_dir))
    return turns.select(
        F.col("ordinal").alias("idx"),
        F.col("role").alias("instruction"),
        F.concat(F.lit("Turn "), F.col("turn").cast("string"), F.lit("\n"), "text").alias("input"),
        F.when(F.col("role") == "assistant", F.col("text")).alias("output"),
        F.create_map(F.lit("generated_by"), F.concat(F.lit("conv"), F.col("conv_id").cast("string"))).alias("metadata"),
    )


def review_table_rows(spark, sf_dir):
    return review_rows(score(_examples(spark, sf_dir), HEADINGS))


def review_table_sample(spark, sf_dir):
    return review_rows(score(_examples(spark, sf_dir), HEADINGS), sample=100)


def _neighbour_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    following = vectors.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("next"))
    return vectors.join(following, "vec_id").select("vec_id", cosine("embedding", "next").alias("similarity"))


def embedding_similarity(spark, sf_dir):
    return _neighbour_similarity(spark, sf_dir).select("vec_id", F.round("similarity", 4).alias("similarity"))


def training_gate(spark, sf_dir):
    """Documents as outputs; where vectors exist, their similarity counts too."""
    known = _neighbour_similarity(spark, sf_dir).withColumnRenamed("vec_id", "doc_id")
    scored = (
        _table(spark, sf_dir, "documents")
        .select("doc_id", F.lit("Summarize.").alias("instruction"), F.col("source").alias("input"), F.col("text").alias("output"))
        .withColumn("missing", missing_headings("output", GATE_HEADINGS))
        .join(known, "doc_id", "left")
        .withColumn("metadata", F.col("doc_id"))
    )
    return training_records(scored).withColumnRenamed("metadata", "doc_id")


def word_similarity(spark, sf_dir):
    """Similarity of input and output by the offline embedder."""
    turns = _examples(spark, sf_dir)
    return turns.select("idx", F.round(input_output_similarity(WordCountEmbedder), 4).alias("similarity"))


def _event_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as free-form records; their shape depends on the type of event."""
    events = spread(_table(spark, sf_dir, "events"))
    source = F.col("event_id").cast("string").alias("source_id")
    user = F.concat(F.lit("user "), F.col("user_id").cast("string"))
    kind = F.col("event_type")
    props = F.from_json("props", "struct<k:int>")
    shapes = {
        "view": F.struct(source, user.alias("output"), props.alias("original_row"), F.col("user_id").alias("k")),
        "click": F.struct(source, user.alias("label"), F.struct(F.lit("x").alias("source_id"), F.array(props).alias("list")).alias("metadata")),
        "purchase": F.struct(source, F.lit("").alias("generated"), F.lit("raw row").alias("original_row"), F.array(props).alias("dropped")),
        "signup": F.struct(source, F.lit("").alias("final_summary"), F.lit("merged").alias("processing_step"), F.lit(7).alias("original_row")),
    }
    record = F.to_json(F.struct(source, F.lit(True).alias("flag"), F.lit(0).alias("original_row"), props.alias("metadata")))
    for name, shape in shapes.items():
        record = F.when(kind == name, F.to_json(shape)).otherwise(record)
    return events.select("event_id", record.alias("record"))


def output_fields(spark, sf_dir):
    parsed = _event_records(spark, sf_dir).select("event_id", parse_record("record").alias("parsed"))
    return parsed.select(
        "event_id",
        output_field(F.col("parsed")).alias("field"),
        output_field(F.col("parsed"), strict=True).alias("strict_field"),
    )


def export_table(spark, sf_dir):
    flat = _event_records(spark, sf_dir).select(flatten_record("record").alias("flat"))
    return review_table(flat)


def export_headers(spark, sf_dir):
    return header_names(_event_records(spark, sf_dir).select(flatten_record("record").alias("flat")))


# --- responses, prompts, tokens -------------------------------------------------------


def response_texts(spark, sf_dir):
    """Turns as model responses in the known shapes, by role and turn."""
    text = F.col("text")
    nothing = F.lit(None).cast("string")
    chat = F.struct(F.array(F.struct(F.struct(F.concat(F.lit("  "), text).alias("content")).alias("message"))).alias("choices"))
    no_text = F.struct(nothing.alias("generated_text"), F.lit(1).alias("other"))
    late = F.struct(text.alias("generated_text"), nothing.cast("int").alias("other"))
    turn = F.col("turn")
    response = (
        F.when(turn == 0, F.to_json(F.struct(text.alias("response"))))
        .when(turn == 1, F.to_json(chat))
        .when(turn == 2, F.to_json(F.struct(F.array(F.struct(text.alias("text"))).alias("choices"))))
        .when(turn == 3, F.to_json(F.array(no_text, late)))
        .when(turn == 4, F.to_json(F.struct(F.lit(" ").alias("response"), text.alias("text"))))
        .when(turn == 5, F.to_json(F.struct(F.array(F.lit(1)).alias("choices"), text.alias("result"))))
        .when(turn == 6, text)
        .otherwise(nothing)
    )
    turns = _conversations(spark, sf_dir).select("conv_id", "turn", response.alias("response"))
    return turns.select("conv_id", "turn", response_text("response").alias("text"))


def chat_pairs(spark, sf_dir):
    """User turns with the assistant turn that follows, as prompt and target."""
    turns = _conversations(spark, sf_dir)
    asked = turns.where(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("input"))
    given = turns.where(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("output")
    )
    # Joined on the turn as well: a conversation with most of the turns is no hot key.
    pairs = asked.join(given, ["conv_id", "turn"], "left").withColumn("instruction", F.lit("Answer the user."))
    return load_examples(pairs).select(
        "conv_id", "turn", build_prompt("instruction", "input").alias("prompt"), "output"
    )


def outputs_missing(spark, sf_dir):
    return empty_outputs(_examples(spark, sf_dir))


def _joined(tokens: DataFrame, *keep: str) -> DataFrame:
    arrays = [F.array_join(name, " ").alias(name) for name in ("input_ids", "attention_mask", "labels")]
    return tokens.select(*keep, *arrays)


def masked_tokens(spark, sf_dir):
    return _joined(tokenize_examples(_examples(spark, sf_dir), hashed_words, 128, keep=("idx",)), "idx")


def masked_tokens_tail(spark, sf_dir):
    return _joined(tokenize_examples(_examples(spark, sf_dir), hashed_words, 256, 32, keep=("idx",)), "idx")


def gated_tokens(spark, sf_dir):
    """Tokens of the examples with an output, published by the gate that refused all examples, and how many it named."""
    examples = _examples(spark, sf_dir).withColumnRenamed("idx", "ordinal")
    folder = f"{_scratch(spark)}/tokens"
    try:
        write_tokens(load_examples(examples), folder, hashed_words, 128)
        refused = "0"
    except RuleBroken as broken:
        refused = str(broken)
    write_tokens(load_examples(examples.where(F.col("output") != "")), folder, hashed_words, 128)
    tokens = spark.read.parquet(folder).withColumnRenamed("ordinal", "idx")
    named = F.regexp_extract(F.lit(refused), r"(\d+)", 1).cast("bigint").alias("refused")
    return _joined(tokens, "idx").select("*", named)


def padded_batches(spark, sf_dir):
    tokens = tokenize_examples(_examples(spark, sf_dir), hashed_words, 64, keep=("idx",))
    return _joined(pad_batches(tokens, 8), "idx", "batch_id")


def token_budgets(spark, sf_dir):
    words = _documents(spark, sf_dir).select("doc_id", "lang", F.size(hashed_words("text")).alias("words"))
    window = F.when(F.col("lang") == "en", F.lit(256)).when(F.col("lang") == "de", F.lit(64)).when(F.col("lang") == "fr", F.lit(0))
    kept, allowed = token_budget(window, "words", F.lit(100))
    return words.select("doc_id", "words", kept.alias("prompt_tokens"), allowed.alias("new_tokens"))


def failures_by_user(spark, sf_dir):
    """Events as call outcomes: errors are failures, of which some are worth a retry."""
    number = F.from_json("props", "struct<k:int>")["k"]
    cause = F.when(number < 30, F.lit("Read TIMEOUT")).when(number < 60, F.lit("temporary outage")).otherwise(F.lit("bad request"))
    message = F.when(F.col("event_type") == "error", F.concat(F.lit("Error: "), cause)).otherwise(F.lit("fine"))
    outcomes = _table(spark, sf_dir, "events").select("user_id", message.alias("message"))
    return outcomes.groupBy("user_id").agg(
        F.count_if(is_error("message")).alias("failures"),
        F.count_if(is_transient("message")).alias("transient"),
        F.bool_or(~is_error("message")).alias("any_success"),
    )


# --- sources, sinks, profile -------------------------------------------------------------


def corpus_profile(spark, sf_dir):
    fields = F.create_map(F.lit("title"), F.when(F.col("lang") == "en", F.col("lang")), F.lit("note"), "text", F.lit("lang"), "lang")
    rows = _documents(spark, sf_dir).select("source", "doc_id", fields.alias("row"))
    profile = profile_records(rows, record_sample("row"), by="source", order="doc_id")
    return profile.select("source", "count", F.array_join("samples", "|").alias("samples"))


def _scratch(spark: SparkSession) -> str:
    """A fresh folder every executor can reach."""
    return f"{shared_folder(spark)}/corpusloom-{uuid4().hex}"


def jsonl_round_trip(spark, sf_dir):
    folder = f"{_scratch(spark)}/jsonl"
    documents = _documents(spark, sf_dir).withColumn("lang", F.when(F.col("lang") != "de", F.col("lang")))
    write_jsonl(documents, folder)
    return read_jsonl(spark, folder, "doc_id bigint, text string, lang string, source string").drop("ordinal")


def jsonl_lenient_read(spark, sf_dir):
    """Documents as lines, those of one language broken: the rest must come through."""
    folder = f"{_scratch(spark)}/lines"
    record = F.to_json(F.struct("doc_id", "lang", "text"))
    line = F.when(F.col("lang") == "fr", F.concat(record, F.lit("}"))).otherwise(record)
    _documents(spark, sf_dir).select(line).write.text(folder)
    records, rejects = read_jsonl_lenient(spark, folder)
    counted = records.select(F.get_json_object("record", "$.lang").alias("lang")).unionByName(
        rejects.select(F.lit("rejected").alias("lang"))
    )
    return counted.groupBy("lang").agg(F.count("*").alias("n"))


def csv_round_trip(spark, sf_dir):
    folder = f"{_scratch(spark)}/csv"
    write_review_csv(_documents(spark, sf_dir).select("doc_id", "lang", "text"), folder)
    rows, _ = read_csv_rows(spark, folder)
    row = F.col("row")
    return rows.select(row["doc_id"].cast("bigint").alias("doc_id"), row["lang"].alias("lang"), row["text"].alias("text"))


def csv_row_numbers(spark, sf_dir):
    """Every row of CSV files in order, with its number over all files: that in its file and the rows of the files before."""
    folder = f"{_scratch(spark)}/numbered"
    write_review_csv(_documents(spark, sf_dir).select("doc_id", "text"), folder, order_by=["doc_id"])
    rows, _ = read_csv_rows(spark, folder, trim=False)
    sizes = rows.groupBy("path").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("path").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    row = F.col("row")
    return rows.join(sizes.select("path", before.alias("before")), "path").select(
        row["doc_id"].cast("bigint").alias("doc_id"), (F.col("before") + F.col("row_index")).alias("number"),
        F.md5(row["text"].cast("binary")).alias("text_md5"),
    )


def _csv_folders(spark: SparkSession, sf_dir: str) -> list[str]:
    """Documents as CSV files of two layouts: by language, with different headers."""
    folder = _scratch(spark)
    documents = _documents(spark, sf_dir)
    english = documents.where("lang = 'en'").select("doc_id", F.col("source").alias("title"), F.col("text").alias("full_text"))
    others = documents.where("lang is distinct from 'en'").select(F.col("lang").alias("name"), F.col("text").alias("note"), "doc_id")
    write_review_csv(english, f"{folder}/english")
    write_review_csv(others, f"{folder}/others")
    return [f"{folder}/english", f"{folder}/others"]


def csv_chunk_records(spark, sf_dir):
    """CSV files to chunk records; files without a usual text column name theirs."""
    rows, _ = read_csv_rows(spark, _csv_folders(spark, sf_dir))
    chunks = chunk_rows(rows, text_column="note")
    doc_id = F.col("original_row")["doc_id"].cast("bigint").alias("doc_id")
    return chunks.select(doc_id, "chunk_index", "total_chunks", "chunk_text")


def folder_documents(spark, sf_dir):
    documents, rejects = collect_documents(spark, _csv_folders(spark, sf_dir))
    failed = rejects.select(F.lit("rejected").alias("title"), F.col("error").alias("text"))
    return documents.select("title", "text").unionByName(failed)


def _mixed_folders(spark: SparkSession, sf_dir: str) -> list[str]:
    """All documents as JSON files with a list inside, text files and CSV files, and all pages in broken JSON and text files."""
    folder, kind = _scratch(spark), F.coalesce(F.pmod("doc_id", F.lit(4)), F.lit(0))
    documents = _documents(spark, sf_dir).withColumn("block", F.floor(F.col("doc_id") / 200))
    record = F.struct("doc_id", F.col("source").alias("title"), F.col("text").alias("full_text"))
    lists = documents.where(kind == 1).groupBy("block").agg(F.array_sort(F.collect_list(record)).alias("items"))
    lists.select("block", "items").write.option("maxRecordsPerFile", 1).json(f"{folder}/lists")
    ordered = F.array_sort(F.collect_list(F.struct("doc_id", F.coalesce("text", F.lit("")).alias("text"))))
    texts = documents.where(kind == 2).groupBy("block").agg(F.array_join(F.transform(ordered, lambda d: d["text"]), "\n").alias("value"))
    texts.select("value").write.option("maxRecordsPerFile", 1).text(f"{folder}/texts")
    write_review_csv(documents.where(kind.isin(0, 3)).select(F.col("source").alias("title"), F.col("text").alias("full_text")), f"{folder}/rows")
    pages = _pages(spark, sf_dir).groupBy(F.floor(F.col("page_id") / 50).alias("block")).agg(F.collect_list("html").alias("items"))
    # Two lines are no JSON document; the byte is no UTF-8.
    twice = pages.select("block", "items", F.explode(F.array(F.lit(1), F.lit(2))).alias("line"))
    twice.write.option("maxRecordsPerFile", 2).json(f"{folder}/broken_lists")
    odd = F.concat(F.array_join("items", "\n").cast("binary"), F.unhex(F.lit("FF"))).cast("string")
    pages.select(odd.alias("value")).write.option("maxRecordsPerFile", 1).text(f"{folder}/broken_texts")
    return [f"{folder}/{name}" for name in ("lists", "texts", "rows", "broken_lists", "broken_texts")]


def mixed_folder_documents(spark, sf_dir):
    """JSON, text and CSV files to documents, every unreadable file told; text files are named at random, so their titles are left out."""
    documents, rejects = collect_documents(spark, _mixed_folders(spark, sf_dir))
    title = F.when(F.endswith("file", F.lit(".txt")), F.lit("")).otherwise(F.col("title"))
    failed = rejects.select(F.lit("rejected").alias("title"), F.split_part("error", F.lit(":"), F.lit(1)).alias("text"))
    return documents.select(title.alias("title"), "text").unionByName(failed)


def folder_profile(spark, sf_dir):
    """Files of a folder with their counts, samples and problems, summed up."""
    files = profile_folder(spark, _csv_folders(spark, sf_dir))
    return files.agg(
        F.sum("count").alias("records"),
        F.count_if(F.size("samples") > 5).alias("oversampled"),
        F.count_if(F.col("error").isNotNull()).alias("failed"),
        F.count_if(F.col("source_type") != "unknown").alias("typed"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        clean_documents, page_text_regex, page_text_dom, document_titles, source_types, turn_word_overlap,
        chunk_records, whole_text_records, fallback_text_columns, examples_from_rows, labelled_examples_only,
        examples_from_texts, record_documents, record_documents_dom, nested_section_documents, table_row_documents, ordered_turns,
        ordered_turns_large, final_prompt_per_source, final_prompt_lines, sentence_dedup, merged_results,
        merged_results_large, merged_records_streamed, merged_totals, last_event_per_user, hierarchical_summaries, generation_totals,
        heading_check, review_table_rows, review_table_sample, embedding_similarity, training_gate, word_similarity,
        output_fields, export_table, export_headers, response_texts, chat_pairs, outputs_missing, masked_tokens,
        masked_tokens_tail, gated_tokens, padded_batches, token_budgets, failures_by_user, corpus_profile, jsonl_round_trip,
        jsonl_lenient_read, csv_round_trip, csv_row_numbers, csv_chunk_records, folder_documents, folder_profile,
        mixed_folder_documents,
    )
} | {
    "chunks_2000_200": _chunks(2000, 200),
    "chunks_500_200": _chunks(500, 200),
    "chunks_250_200_capped": _chunks(250, 200, step_cap=True),
    "chunks_250_200_uncapped": _chunks(250, 200),
    "chunks_by_line_2000_200": _chunks(2000, 200, sentence_aware=False),
}
