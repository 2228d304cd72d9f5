"""Free-form records to documents, documents to training examples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom import fixed_values as fixed
from corpusloom.functions.chunking import chunk_text
from corpusloom.functions.classify import instruction_for, source_type
from corpusloom.functions.nested import nested_texts
from corpusloom.functions.once import let
from corpusloom.functions.prompts import document_input
from corpusloom.functions.text import as_col, clean_field, clean_text, strip, strip_html, strip_html_each
from corpusloom.operators.chunks import explode_chunks


def longest_field(values: Column | str, html_mode: str = "regex") -> Column:
    """Longest of an array of strings after clean-up, first of equals; null if none is long."""

    def long_enough(text: Column) -> Column:
        return F.length(text) > fixed.LONG_FIELD_MIN

    raw = F.filter(as_col(values), lambda value: long_enough(strip(value)))
    plain = F.transform(strip_html_each(raw, html_mode), strip)
    ranked = F.transform(
        F.filter(plain, long_enough),
        lambda value, at: F.struct(F.length(value).alias("size"), (-at).alias("before"), value.alias("value")),
    )
    return let(ranked, lambda found: F.when(F.size(found) > 0, clean_text(F.array_max(found)["value"])))


def sections_text(sections: Column, is_json_value: Column, html_mode: str = "regex") -> Column:
    """Text of a ``sections`` field, or null where it yields none.

    ``sections`` is the field's string, or its JSON text where it was no string
    (``is_json_value``). A string counts as JSON only if it opens like JSON; if
    it then fails to parse, it counts as plain text.
    """
    stripped = strip(sections)
    json_like = is_json_value | F.rlike(stripped, F.lit(r"^[\[{]"))
    texts = nested_texts(F.when(json_like, sections), html_mode)
    plain = strip_html(sections, html_mode)

    def choose(found: Column, plain: Column) -> Column:
        return F.when(F.size(found) > 0, clean_text(F.array_join(found, "\n\n"))).when(
            json_like & found.isNull() & (F.length(strip(plain)) > fixed.DOCUMENT_TEXT_MIN), clean_text(plain)
        )

    if html_mode == "dom":
        # A lambda cannot call Python: both texts are made before it.
        both = F.struct(texts.alias("found"), plain.alias("plain"))
        return let(both, lambda made: choose(made["found"], made["plain"]))
    return let(texts, lambda found: choose(found, plain))


def record_text(
    strings: Column | str, sections: Column | str, sections_is_json: Column | str, html_mode: str = "regex"
) -> Column:
    """Text of a free-form record: ``full_text``, else ``sections``, else its longest string.

    ``strings`` maps the names of the record's string fields to their values, in
    the record's order.
    """
    strings = as_col(strings)
    full_text = strings["full_text"]
    return F.coalesce(
        F.when(F.length(strip(full_text)) > fixed.DOCUMENT_TEXT_MIN, clean_field(full_text, html_mode)),
        sections_text(as_col(sections), as_col(sections_is_json), html_mode),
        longest_field(F.map_values(strings), html_mode),
        F.lit(""),
    )


def examples_from_documents(
    documents: DataFrame, keep: tuple[str, ...] = (), max_chars: int = fixed.MAX_CHARS, step_cap: bool = False
) -> DataFrame:
    """One training example per chunk of (file, title, text) documents; outputs stay empty."""
    chunks = chunk_text("text", max_chars, fixed.OVERLAP, step_cap=step_cap)
    exploded = explode_chunks(documents.withColumn("title", F.coalesce("title", F.lit(""))), chunks, *keep, "file", "title")
    return exploded.withColumn("_kind", source_type("file")).select(
        *keep,
        instruction_for("_kind").alias("instruction"),
        document_input("file", "title", "chunk_text").alias("input"),
        F.lit("").alias("output"),
        F.struct(
            F.col("_kind").alias("source_type"),
            F.col("file").alias("source_filename"),
            "title",
            "chunk_index",
            F.length("chunk_text").alias("chunk_chars"),
        ).alias("metadata"),
    )
