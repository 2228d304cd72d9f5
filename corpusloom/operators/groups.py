"""Ordered collection per source, in one of two forms that the caller chooses.

``whole`` gives one row per source, which one task gathers and one cell (2 GB)
must hold. Otherwise no source is gathered: its rows stay apart, each named by
``part``, and together in order of ``part`` they are the whole. The form never
depends on the size of a source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom import fixed_values as fixed
from corpusloom.functions.classify import is_error
from corpusloom.functions.prompts import final_opening, final_prompt

_SECTION_BLOCK = 4096


def source_key(name: str = "source_id") -> Column:
    return F.coalesce(F.col(name), F.lit(fixed.MISSING_SOURCE))


def position() -> Column:
    """Place of a chunk in its source; a missing index counts as 0, ties keep input order."""
    return F.struct(F.coalesce("chunk_index", F.lit(0)).cast("int").alias("chunk_index"), F.col("ordinal").alias("ordinal"))


def collect_ordered(chunks: DataFrame, text: str, whole: bool = True) -> DataFrame:
    """(source_id, part, texts) from rows with source_id, chunk_index, ordinal and a text.

    ``texts`` is the array of a source in chunk order and ``part`` null, or, unless
    ``whole``, each row's own text with its place.
    """
    chunks = chunks.select(source_key().alias("source_id"), position().alias("at"), F.coalesce(text, F.lit("")).alias("text"))
    if not whole:
        return chunks.select("source_id", F.col("at").alias("part"), F.array("text").alias("texts"))
    ordered = F.array_sort(F.collect_list(F.struct("at", "text")))
    grouped = chunks.groupBy("source_id").agg(F.transform(ordered, lambda item: item["text"]).alias("texts"))
    return grouped.select("source_id", F.lit(None).cast(chunks.schema["at"].dataType).alias("part"), "texts")


def final_prompts(chunks: DataFrame, whole: bool = True) -> DataFrame:
    """(source_id, part, prompt) that asks for one summary of a source's chunk summaries.

    Expects source_id, chunk_index, ordinal, chunk_summary, title and
    source_filename. Failed summaries are left out and the rest numbered. Unless
    ``whole``, a prompt comes as lines of text, ``part`` 0 the opening, then one per
    section, then the closing.
    """
    usable = chunks.where(~is_error("chunk_summary")).select(
        source_key().alias("source_id"), position().alias("at"), F.coalesce("chunk_summary", F.lit("")).alias("summary"),
        F.col("title"), F.col("source_filename"),
    )
    first = F.min_by(F.struct("title", "source_filename"), "at").alias("first")
    if not whole:
        return _prompt_lines(usable, first)
    grouped = usable.groupBy("source_id").agg(F.array_sort(F.collect_list(F.struct("at", "summary"))).alias("items"), first)
    summaries = F.transform("items", lambda item: item["summary"])
    return grouped.select(
        "source_id",
        F.lit(None).cast("bigint").alias("part"),
        final_prompt(summaries, F.col("first.title"), F.col("first.source_filename")).alias("prompt"),
    )


def _prompt_lines(large: DataFrame, first: Column) -> DataFrame:
    """Prompt lines, sections numbered without gathering a source.

    Numbers come from counts per block plus a rank inside the block, so that no
    window spans more than one block: chunk indexes in steps, and within a step
    ordinals in steps, as rows without an index all count as 0.
    """
    zero = F.col("at.chunk_index") == 0
    block = F.struct(
        F.floor(F.col("at.chunk_index") / _SECTION_BLOCK).alias("step"), (~zero).alias("later"),
        F.when(zero, F.floor(F.col("at.ordinal") / _SECTION_BLOCK)).otherwise(F.lit(0)).alias("rows"),
    )
    blocks = large.withColumn("block", block)
    counts = blocks.groupBy("source_id", "block").agg(F.count("*").alias("n"))
    before = Window.partitionBy("source_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("source_id", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("source_id", "block").orderBy("at")
    numbered = blocks.withColumn("rank", F.row_number().over(inside)).join(offsets, ["source_id", "block"])
    number = (F.col("offset") + F.col("rank")).cast("bigint")
    sections = numbered.select(
        "source_id",
        number.alias("part"),
        F.concat(F.lit("Section "), number.cast("string"), F.lit(": "), "summary").alias("prompt"),
    )
    heads = large.groupBy("source_id").agg(first, F.count("*").alias("n"))
    opening = heads.select(
        "source_id",
        F.lit(0).cast("bigint").alias("part"),
        final_opening(F.col("first.title"), F.col("first.source_filename")).alias("prompt"),
    )
    closing = heads.select(
        "source_id", (F.col("n") + 1).alias("part"), F.lit("\n" + fixed.FINAL_CLOSING).alias("prompt")
    )
    return opening.unionByName(sections).unionByName(closing)
