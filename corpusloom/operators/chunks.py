"""Table rows to chunk records with lineage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom import fixed_values as fixed
from corpusloom.functions.chunking import chunk_text
from corpusloom.functions.classify import file_stem
from corpusloom.functions.once import compute_where
from corpusloom.functions.prompts import chunk_prompt
from corpusloom.operators.rows import Fields, chunk_source_text, map_fields


def explode_chunks(df: DataFrame, chunks, *keep: str) -> DataFrame:
    """One row per chunk with its 0-based position and the number of chunks.

    Every text has a chunk; the outer form only keeps Catalyst from inferring a
    filter on the chunks, which would cut every text twice.
    """
    return df.select(*keep, chunks.alias("_chunks")).select(
        *keep,
        F.size("_chunks").alias("total_chunks"),
        F.posexplode_outer("_chunks").alias("chunk_index", "chunk_text"),
    )


def chunk_rows(
    rows: DataFrame,
    fields: Fields | None = None,
    text_column: str = "full_text",
    max_chars: int = fixed.MAX_CHARS,
    no_chunk: bool = False,
    html_mode: str = "regex",
    step_cap: bool = False,
    row_once: bool = False,
) -> DataFrame:
    """Chunk records of (file, row_index, row) rows; narrow, no shuffle.

    Rows with too little text are dropped after they were numbered, so the
    numbers in ``source_id`` keep the gaps. Each record repeats its whole row,
    which makes the output grow with the square of a text's length; with
    ``row_once`` only a text's first record carries it, all that merging needs. A column
    ``stem`` names the source in place of the file's own name.
    """
    fields = fields or map_fields()
    stem = F.col("stem") if "stem" in rows.columns else file_stem("file")
    named = rows.select(
        F.concat(stem, F.lit("_"), F.col("row_index").cast("string")).alias("source_id"),
        "file",
        F.col("row").alias("original_row"),
        fields("title").alias("_title"),
        "row",
    )
    texts = compute_where(
        named,
        ("source_id", "file", "original_row", "_title"),
        {"_text": chunk_source_text(fields, text_column, html_mode)},
        lambda made: F.length(made["_text"]) >= fixed.ROW_TEXT_MIN,
    )
    pieces = F.array("_text") if no_chunk else chunk_text("_text", max_chars, fixed.OVERLAP, step_cap=step_cap)
    exploded = explode_chunks(texts, pieces, "source_id", "file", "original_row", "_title")
    return exploded.select(
        "source_id",
        "chunk_index",
        "total_chunks",
        chunk_prompt("chunk_text", "_title", "file").alias("prompt"),
        "chunk_text",
        F.when(F.col("chunk_index") == 0, F.col("original_row")).alias("original_row") if row_once else "original_row",
    )
