"""Table rows: picking text, title and output columns; rows to training examples."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom import fixed_values as fixed
from corpusloom.functions.once import compute_where, let
from corpusloom.functions.prompts import row_input
from corpusloom.functions.text import clean_field, non_empty
from corpusloom.functions.titles import extract_title

Fields = Callable[[str], Column]


def map_fields(row: str = "row") -> Fields:
    """Fields of rows kept as a string map, as the CSV source yields them."""
    return lambda name: F.col(row)[name]


def column_fields(df: DataFrame) -> Fields:
    """Fields of rows kept as columns; a column the table lacks reads as null."""
    known = set(df.columns)
    return lambda name: F.col(name).cast("string") if name in known else F.lit(None).cast("string")


def chunk_source_text(fields: Fields, text_column: str = "full_text", html_mode: str = "regex") -> Column:
    """First of the requested and the usual columns whose clean text is long enough, else ''."""
    picks = []
    for name in dict.fromkeys([text_column, *fixed.CHUNK_TEXT_COLUMNS]):
        text = clean_field(fields(name), html_mode)
        picks.append(let(text, lambda value: F.when(F.length(value) > fixed.ROW_TEXT_MIN, value)))
    return F.coalesce(*picks, F.lit(""))


def _first_filled(fields: Fields, names: list[str]) -> Column:
    return F.coalesce(*[non_empty(fields(name)) for name in names])


def example_text(fields: Fields, text_column: str = "full_text", html_mode: str = "regex") -> Column:
    """Clean text of the first non-empty column; a short one does not fall through."""
    names = [name for name in (text_column, *fixed.CONVERT_TEXT_COLUMNS) if name != "section"]
    return clean_field(_first_filled(fields, names), html_mode)


def example_output(fields: Fields, html_mode: str = "regex") -> Column:
    return clean_field(_first_filled(fields, fixed.OUTPUT_COLUMNS), html_mode)


def rows_to_examples(
    rows: DataFrame,
    fields: Fields,
    keep: tuple[str, ...] = (),
    text_column: str = "full_text",
    instruction: str = fixed.DEFAULT_INSTRUCTION,
    filter_empty: bool = False,
    html_mode: str = "regex",
) -> DataFrame:
    """(instruction, input, output) per row with enough text; rows without are dropped.

    ``keep`` names columns to carry along, ``filter_empty`` also drops rows
    without an output.
    """
    title = non_empty(fields("title"))
    computed = {
        "_text": example_text(fields, text_column, html_mode),
        "_title": clean_field(title, html_mode),
        "_untitled": title.isNull(),
        "output": example_output(fields, html_mode),
    }

    def wanted(made: Column) -> Column:
        enough = F.length(made["_text"]) >= fixed.ROW_TEXT_MIN
        return enough & (made["output"] != "") if filter_empty else enough

    picked = compute_where(rows, keep, computed, wanted)
    title = F.when(F.col("_untitled"), extract_title("_text", html_mode=html_mode)).otherwise(F.col("_title"))
    titled = picked.select(*keep, "_text", "output", title.alias("_title"))
    return titled.select(
        *keep, F.lit(instruction).alias("instruction"), row_input("_title", "_text").alias("input"), "output"
    )
