"""Two-level summaries: one per chunk, then one per source."""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom import fixed_values as fixed
from corpusloom.functions.classify import is_error
from corpusloom.functions.models import TextGenerator, generated
from corpusloom.functions.prompts import fallback_chunk_prompt, final_prompt
from corpusloom.operators.groups import position, source_key
from corpusloom.session import cut_lineage, shared_folder

CHUNK_STEP, FINAL_STEP = "chunk_summary", "final_summary"
# No levels: a source's final prompt takes all its summaries, whatever their number.
FAN_IN = None


_LEDGER = "prompt_key string, text string, failed boolean"


def prompt_key(prompt: Column | str, max_gen: int) -> Column:
    """What a call is known by: its prompt and its bound."""
    return F.sha2(F.concat_ws("\n", F.lit(str(max_gen)), F.coalesce(prompt, F.lit(""))).cast("binary"), 256)


def answers(prompts: DataFrame, load: Callable[[], TextGenerator], max_gen: int, ledger: str) -> DataFrame:
    """(prompt_key, text, failed) of all prompts in a column ``prompt``, each distinct one asked once.

    Only keys and prompts are shuffled. Answers are added to the table ``ledger``, whose
    files every finished task leaves behind at once: after a crash, a run over the same
    folder asks only what has no answer yet, or failed. A folder belongs to one model.
    """
    spark = prompts.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spark.createDataFrame([], _LEDGER).write.mode("append").parquet(ledger)
    known = spark.read.schema(_LEDGER).parquet(ledger).where(~F.col("failed")).select("prompt_key").distinct()
    keyed = prompts.select(prompt_key("prompt", max_gen).alias("prompt_key"), "prompt").repartition(tasks, "prompt_key")
    open_prompts = keyed.groupBy("prompt_key").agg(F.min("prompt").alias("prompt")).join(known, "prompt_key", "left_anti")
    made = open_prompts.select("prompt_key", generated("prompt", load, max_gen).alias("answer")).select("prompt_key", "answer.*")
    made.write.mode("append").option("mapreduce.fileoutputcommitter.algorithm.version", "2").parquet(ledger)
    told = spark.read.schema(_LEDGER).parquet(ledger).groupBy("prompt_key")
    return told.agg(F.min_by(F.struct("text", "failed"), "failed").alias("answer"))


def summarize_chunks(
    chunks: DataFrame, load: Callable[[], TextGenerator], max_gen: int = fixed.MAX_NEW_TOKENS, ledger: str | None = None
) -> DataFrame:
    """Chunk results of (source_id, chunk_index, total_chunks, prompt, chunk_text, original_row, ordinal).

    With a ``ledger`` the answers are in that folder when this returns, and only joined.
    """
    prompt = fallback_chunk_prompt("prompt", "chunk_text")
    if ledger is None:
        answer = generated(prompt, load, max_gen)
    else:
        told = answers(chunks.select(prompt.alias("prompt")), load, max_gen, ledger)
        chunks = chunks.withColumn("prompt_key", prompt_key(prompt, max_gen)).join(told, "prompt_key")
        answer = F.col("answer")
    fields = ("source_id", "chunk_index", "total_chunks", "prompt", "chunk_text", "original_row")
    answered = chunks.select(
        source_key().alias("source_id"),
        F.coalesce("chunk_index", F.lit(0)).alias("chunk_index"),
        "total_chunks",
        "ordinal",
        answer.alias("answer"),
        F.struct(*fields).alias("original_chunk"),
    )
    return answered.select(
        "source_id",
        "chunk_index",
        F.when(~F.col("answer.failed"), F.col("total_chunks")).alias("total_chunks"),
        F.col("answer.text").alias("chunk_summary"),
        "original_chunk",
        F.lit(CHUNK_STEP).alias("generation_step"),
        "ordinal",
    )


def _with_defaults(row: Column) -> Column:
    """Row map that surely holds the two keys the final prompt needs."""
    row = F.coalesce(row, F.create_map().cast("map<string,string>"))
    named = {name: F.coalesce(row[name], F.lit("")) for name in ("source_filename", "title")}
    return F.map_concat(
        F.map_filter(row, lambda key, _: ~key.isin(*named)),
        F.create_map(*[part for name, value in named.items() for part in (F.lit(name), value)]),
    )


def _reduced(rows: DataFrame, load: Callable[[], TextGenerator], max_gen: int, fan_in: int) -> DataFrame:
    """The rows, with at most ``fan_in`` per source: consecutive ones are summarised until that holds."""
    if fan_in < 2:
        raise ValueError("fan_in must be at least 2")
    while True:
        counts = rows.groupBy("source_id").agg(F.count("*").alias("n")).where(F.col("n") > fan_in)
        many = cut_lineage(counts.select("source_id"))
        if many.isEmpty():
            return rows
        few = rows.join(many, "source_id", "left_anti")
        place = F.row_number().over(Window.partitionBy("source_id").orderBy("at")) - 1
        blocks = rows.join(many, "source_id", "left_semi").withColumn("block", F.floor(place / F.lit(fan_in)))
        grouped = blocks.groupBy("source_id", "block").agg(
            F.array_sort(F.collect_list(F.struct("at", "chunk_summary"))).alias("items"),
            F.min("at").alias("at"), F.sum("chunks").alias("chunks"), F.min_by("row", "at").alias("row"),
        )
        usable = F.filter(F.transform("items", lambda item: item["chunk_summary"]), lambda text: ~is_error(text))
        prompt = final_prompt(usable, F.col("row")["title"], F.col("row")["source_filename"])
        # A block of failures alone stays one.
        text = F.when(F.size(usable) > 0, generated(prompt, load, max_gen)["text"]).otherwise(F.col("items")[0]["chunk_summary"])
        rows = cut_lineage(few.unionByName(grouped.select("source_id", "at", text.alias("chunk_summary"), "chunks", "row")))


def summarize_sources(
    chunk_results: DataFrame,
    load: Callable[[], TextGenerator],
    max_gen: int = fixed.MAX_NEW_TOKENS,
    fan_in: int | None = FAN_IN,
    chunks: DataFrame | None = None,
) -> DataFrame:
    """Final results, one per source with any usable chunk summary; source rows come from ``chunks``, if given.

    A source's prompt takes all its usable summaries and its ``chunk_summaries`` are
    those of all its chunks, so one task gathers them and one cell (2 GB) must hold
    them. Only a caller who sets ``fan_in`` gets levels: a prompt then takes that many
    summaries at most, those of ``fan_in`` consecutive chunks are summarised first,
    and so on; ``chunk_summaries`` are then those of the last level, the total that of
    all chunks, and every chunk's own summary is in the chunk results alone.
    """
    narrow = chunk_results.select("source_id", position().alias("at"), "chunk_summary", F.lit(1).cast("long").alias("chunks"), "original_chunk")
    with_rows = narrow.withColumn("row", F.col("original_chunk.original_row")).drop("original_chunk")
    rows = narrow.drop("original_chunk") if fan_in is None else _reduced(with_rows, load, max_gen, fan_in)
    sources = with_rows if chunks is None else chunks.select(
        source_key().alias("source_id"), position().alias("at"), F.col("original_row").alias("row")
    )
    grouped = rows.groupBy("source_id").agg(
        F.array_sort(F.collect_list(F.struct("at", "chunk_summary"))).alias("items"), F.sum("chunks").cast("int").alias("total_chunks")
    )
    # A source's row may hold its whole text: one row per source and task is shuffled, apart from the summaries.
    metadata = sources.groupBy("source_id").agg(F.min_by(_with_defaults(F.col("row")), "at").alias("source_metadata"))
    grouped = grouped.join(metadata, "source_id")
    usable = F.filter("chunk_summaries", lambda text: ~is_error(text))
    sources = grouped.select(
        "source_id", "total_chunks", F.transform("items", lambda item: item["chunk_summary"]).alias("chunk_summaries"), "source_metadata"
    ).where(F.exists("chunk_summaries", lambda text: ~is_error(text)))
    metadata = F.col("source_metadata")
    prompt = final_prompt(usable, metadata["title"], metadata["source_filename"])
    return sources.select(
        "source_id",
        "total_chunks",
        "chunk_summaries",
        generated(prompt, load, max_gen * 2)["text"].alias("final_summary"),
        "source_metadata",
        F.lit(FINAL_STEP).alias("generation_step"),
    )


def summarize_hierarchically(
    chunks: DataFrame,
    load: Callable[[], TextGenerator],
    max_gen: int = fixed.MAX_NEW_TOKENS,
    fan_in: int | None = FAN_IN,
    ledger: str | None = None,
) -> DataFrame:
    """Chunk results and final results in one table, told apart by ``generation_step``.

    Chunk answers are dear and may come from a sampling model, and the final results
    must be made from the very texts that are returned: they are kept in ``ledger``, by
    default a new folder, and rows are joined with them late.
    """
    ledger = ledger or f"{shared_folder(chunks.sparkSession)}/ledger-{uuid4().hex}"
    chunk_results = summarize_chunks(chunks, load, max_gen, ledger)
    finals = summarize_sources(chunk_results, load, max_gen, fan_in, chunks)
    return finals.unionByName(chunk_results, allowMissingColumns=True)


def run_statistics(results: DataFrame) -> DataFrame:
    step = F.col("generation_step")
    return results.agg(
        F.count_if(step == FINAL_STEP).alias("final_summaries"),
        F.count_if(step == CHUNK_STEP).alias("chunk_summaries"),
    )
