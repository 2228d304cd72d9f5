"""Generation results to one merged record per source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions.classify import is_error
from corpusloom.functions.sentences import dedup_text, distinct_sentences, join_sentences
from corpusloom.functions.text import non_empty
from corpusloom.operators.generation import CHUNK_STEP, FINAL_STEP
from corpusloom.operators.groups import position, source_key
from corpusloom.operators.similar_sets import first_distinct
from corpusloom.session import stored

_FINAL_FIELDS = ("total_chunks", "chunk_summaries", "final_summary", "source_metadata")


def last_per_key(df: DataFrame, keys: list[str], order: Column | str, *fields: str) -> DataFrame:
    """The last row of each key by ``order``; combined before the shuffle, so no key is hot."""
    last = F.max_by(F.struct(*fields), order).alias("_last")
    return df.groupBy(*keys).agg(last).select(*keys, "_last.*")


def merge_results(results: DataFrame, whole: bool = True) -> DataFrame:
    """Merged records of generation results.

    Expects the columns of :func:`generation.summarize_hierarchically`. A source's
    last final result counts; where it is missing or empty and there are chunk
    results, the summary is rebuilt from those. A source rebuilt from chunks yields one
    record per chunk, in order of ``part``, its sentences being compared across tasks.
    ``whole`` then puts the parts of each source together in one task and one cell (2 GB).
    The choice is the caller's and holds for all sources alike.
    """
    step = F.col("generation_step")
    rows = results.select(
        source_key().alias("source_id"),
        (step == FINAL_STEP).alias("is_final"),
        position().alias("at"),
        F.col("ordinal"),
        F.struct(*_FINAL_FIELDS).alias("final"),
        F.coalesce("chunk_summary", F.lit("")).alias("summary"),
        F.col("original_chunk.original_row").alias("row"),
    ).where(step.isin(CHUNK_STEP, FINAL_STEP))
    parts = _merge_parts(rows)
    return _joined(parts) if whole else parts


def _record(df: DataFrame, part: Column, text: Column, part_type: T.DataType) -> DataFrame:
    metadata = F.coalesce("source_metadata", F.create_map().cast("map<string,string>"))
    return df.select(
        "source_id",
        part.cast(part_type).alias("part"),
        F.coalesce("total_chunks", F.lit(0)).alias("total_chunks"),
        text.alias("final_summary"),
        F.coalesce("chunk_summaries", F.array().cast("array<string>")).alias("chunk_summaries"),
        metadata.alias("source_metadata"),
        F.lit("merged").alias("processing_step"),
        F.when(F.size(metadata) > 0, metadata).alias("original_row"),
    )


def _joined(parts: DataFrame) -> DataFrame:
    """One record per source: its parts in order, put together as they are."""
    apart = parts.where(F.col("part").isNotNull())
    items = F.array_sort(F.collect_list(F.struct("part", "final_summary", "chunk_summaries")))
    first = F.min_by(F.struct("source_metadata", "original_row", "processing_step"), "part").alias("first")
    grouped = apart.groupBy("source_id").agg(items.alias("items"), F.sum("total_chunks").cast("int").alias("total_chunks"), first)
    texts = F.filter(F.transform("items", lambda item: item["final_summary"]), lambda text: text != "")
    whole = grouped.select(
        "source_id", F.lit(None).cast(parts.schema["part"].dataType).alias("part"), "total_chunks",
        F.array_join(texts, " ").alias("final_summary"),
        F.flatten(F.transform("items", lambda item: item["chunk_summaries"])).alias("chunk_summaries"), "first.*",
    )
    return parts.where(F.col("part").isNull()).unionByName(whole)


def _merge_parts(rows: DataFrame) -> DataFrame:
    """Records of sources of which nothing is gathered.

    The metadata of a source, which may hold its whole text, goes with its first part only.
    """
    part_type = rows.schema["at"].dataType
    chunks = rows.where(~F.col("is_final"))
    facts = chunks.groupBy("source_id").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    finals = last_per_key(rows.where("is_final"), ["source_id"], F.struct("ordinal"), "final").select("source_id", "final.*")
    finals = finals.join(facts, "source_id", "left")
    finals = finals.where(non_empty("final_summary").isNotNull() | F.col("n").isNull()).drop("n", "first")
    ready = _record(finals, F.lit(None), dedup_text("final_summary"), part_type)

    chunks = chunks.join(finals.select("source_id"), "source_id", "left_anti")
    chunks = chunks.select("source_id", "at", "summary", "row").join(facts, "source_id")
    usable = (F.col("n") == 1) | ~is_error("summary")
    sentences = chunks.where(usable).select(
        "source_id", "at", F.posexplode_outer(distinct_sentences("summary")).alias("number", "sentence")
    ).where(F.col("sentence").isNotNull())
    sentences = stored(sentences, "sentences")  # used twice
    items = sentences.select(
        F.col("source_id").alias("key"),
        F.struct("at", "number").alias("at"),
        F.split(F.lower("sentence"), " ").alias("words"),
    )
    kept = first_distinct(items).select(
        F.col("key").alias("source_id"), F.col("at.at").alias("at"), F.col("at.number").alias("number")
    )
    texts = (
        sentences.join(kept, ["source_id", "at", "number"], "left_semi")
        .groupBy("source_id", "at")
        .agg(F.array_sort(F.collect_list(F.struct("number", "sentence"))).alias("items"))
        .select("source_id", "at", F.transform("items", lambda item: item["sentence"]).alias("sentences"))
    )
    parts = chunks.join(texts, ["source_id", "at"], "left").select(
        "source_id",
        "at",
        F.lit(1).alias("total_chunks"),
        F.array("summary").alias("chunk_summaries"),
        F.when(F.col("at") == F.col("first"), F.col("row")).alias("source_metadata"),
        F.coalesce("sentences", F.array().cast("array<string>")).alias("sentences"),
    )
    return ready.unionByName(_record(parts, F.col("at"), join_sentences("sentences"), part_type))


def _json(*fields: Column | str) -> Column:
    """A JSON object's text without its braces; null fields are left out."""
    text = F.to_json(F.struct(*fields))
    return F.substring(text, F.lit(2), F.length(text) - 2)


def record_pieces(parts: DataFrame) -> DataFrame:
    """(source_id, section, part, value): the pieces of one JSON line per source, to be written in that order.

    Put together with a blank between them, the pieces of a source are its record: the
    blanks join the texts of the summary and stand between other values. No cell holds
    more than one part's text, so a record may be of any size.
    """
    apart = parts.where(F.col("part").isNotNull())
    text = F.when(F.col("final_summary") != "", F.col("part"))
    rest = F.struct("source_metadata", "processing_step", "original_row")
    facts = apart.groupBy("source_id").agg(
        F.sum("total_chunks").cast("int").alias("total_chunks"), F.min(text).alias("first_text"), F.max(text).alias("last_text"),
        F.min(F.when(F.size("chunk_summaries") > 0, F.col("part"))).alias("first_chunk"), F.min_by(rest, "part").alias("rest"),
    )
    places = facts.select("source_id", "total_chunks", "first_text", "last_text", "first_chunk")
    opening = F.concat(F.lit("{"), _json("source_id", "total_chunks"), F.lit(',"final_summary":"'))
    middle = F.lit('","chunk_summaries":[')
    no_part = F.lit(None).cast(parts.schema["part"].dataType).alias("part")
    nothing = F.lit("")
    known = apart.select("source_id", "part", "final_summary", "chunk_summaries").join(places, "source_id")
    escaped = F.to_json(F.array("final_summary"))
    escaped = F.substring(escaped, F.lit(3), F.length(escaped) - 4)
    texts = known.where(F.col("final_summary") != "").select(
        "source_id", F.lit(1).alias("section"), "part",
        F.concat(
            F.when(F.col("part") == F.col("first_text"), opening).otherwise(nothing), escaped,
            F.when(F.col("part") == F.col("last_text"), middle).otherwise(nothing),
        ).alias("value"),
    )
    textless = facts.where(F.col("first_text").isNull()).select("source_id", F.lit(1).alias("section"), no_part, F.concat(opening, middle).alias("value"))
    listed = F.to_json("chunk_summaries")
    listed = F.substring(listed, F.lit(2), F.length(listed) - 2)
    comma = F.when(F.col("part") == F.col("first_chunk"), nothing).otherwise(F.lit(","))
    chunks = known.where(F.size("chunk_summaries") > 0).select("source_id", F.lit(2).alias("section"), "part", F.concat(comma, listed).alias("value"))
    closing = F.concat(F.lit("],"), _json("rest.source_metadata", "rest.processing_step", "rest.original_row"), F.lit("}\n"))
    ends = facts.select("source_id", F.lit(3).alias("section"), no_part, closing.alias("value"))
    whole = parts.where(F.col("part").isNull()).drop("part")
    ready = whole.select("source_id", F.lit(0).alias("section"), no_part, F.concat(F.to_json(F.struct(*whole.columns)), F.lit("\n")).alias("value"))
    return ready.unionByName(texts).unionByName(textless).unionByName(chunks).unionByName(ends)


def merge_statistics(merged: DataFrame) -> DataFrame:
    """Chunks, sources and sources with a usable summary; the parts of a source count as one."""
    whole = F.col("part").isNull()
    good = (F.col("final_summary") != "") & ~is_error("final_summary")

    def sources(condition: Column) -> Column:
        return F.count_if(whole & condition) + F.count_distinct(F.when(~whole & condition, F.col("source_id")))

    return merged.agg(
        F.sum("total_chunks").alias("total_chunks"),
        sources(F.lit(True)).alias("sources"),
        sources(good).alias("successful"),
    )
