"""Prompt frames. Absent optional parts take their line and blank line with them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom import fixed_values as fixed
from corpusloom.functions.text import as_col


def _lines(*parts: Column) -> Column:
    """Newline-joined parts; null parts vanish."""
    return F.array_join(F.array(*parts), "\n")


def _optional(label: str, value: Column, shown: Column) -> Column:
    return F.when(shown, F.concat(F.lit(label), value, F.lit("\n")))


def chunk_prompt(chunk: Column | str, title: Column | str, source: Column | str) -> Column:
    title, source = F.coalesce(as_col(title), F.lit("")), as_col(source)
    return _lines(
        F.lit(fixed.DEFAULT_INSTRUCTION + "\n"),
        _optional("Title: ", title, title != ""),
        _optional("Source: ", source, source != fixed.MISSING_SOURCE),
        F.lit(fixed.CHUNK_LABEL),
        as_col(chunk),
    )


def fallback_chunk_prompt(prompt: Column | str, chunk: Column | str) -> Column:
    """The stored prompt, or a plain one around the chunk where it is missing."""
    prompt, chunk = F.coalesce(as_col(prompt), F.lit("")), F.coalesce(as_col(chunk), F.lit(""))
    plain = F.concat(F.lit(fixed.CHUNK_FALLBACK_OPENING + "\n\n"), chunk)
    return F.when((prompt == "") & (chunk != ""), plain).otherwise(prompt)


def sections(summaries: Column | str) -> Column:
    numbered = F.transform(
        as_col(summaries), lambda text, at: F.concat(F.lit("Section "), (at + 1).cast("string"), F.lit(": "), text)
    )
    return F.array_join(numbered, "\n\n")


def final_opening(title: Column | str, source: Column | str) -> Column:
    title, source = F.coalesce(as_col(title), F.lit("")), F.coalesce(as_col(source), F.lit(""))
    return _lines(
        F.lit("\n".join(fixed.FINAL_OPENING) + "\n"),
        _optional("Document Title: ", title, title != ""),
        _optional("Source: ", source, source != ""),
        F.lit(fixed.FINAL_LABEL),
    )


def final_prompt(summaries: Column | str, title: Column | str, source: Column | str) -> Column:
    return _lines(final_opening(title, source), sections(summaries), F.lit("\n" + fixed.FINAL_CLOSING))


def build_prompt(instruction: Column | str, input_text: Column | str, template: str = fixed.PROMPT_TEMPLATE) -> Column:
    """Fill ``{instruction}`` and ``{input}``; missing values become ''."""
    values = {"{instruction}": as_col(instruction), "{input}": as_col(input_text)}
    parts, rest = [], template
    while rest:
        hits = [(rest.find(mark), mark) for mark in values if mark in rest]
        at, mark = min(hits, default=(len(rest), ""))
        parts.append(F.lit(rest[:at].replace("{{", "{").replace("}}", "}")))
        if mark:
            parts.append(F.coalesce(values[mark], F.lit("")))
        rest = rest[at + len(mark) :]
    return F.concat(*parts)


def document_input(file: Column | str, title: Column | str, chunk: Column | str) -> Column:
    """Input text of a training example made from a document chunk."""
    return F.concat(
        F.lit("Source file: "), as_col(file),
        F.lit("\nTitle: "), F.coalesce(as_col(title), F.lit("")),
        F.lit("\n\nDocument:\n"), as_col(chunk),
    )


def row_input(title: Column | str, text: Column | str) -> Column:
    """Input text of a training example made from a table row."""
    title = as_col(title)
    return F.concat(
        F.when(title != "", F.concat(F.lit("Title: "), title, F.lit("\n\n"))).otherwise(F.lit("")),
        F.lit("Text: "), as_col(text),
    )


def summarize_prompt(text: Column | str) -> Column:
    return F.concat(
        F.lit(fixed.SUMMARIZE_OPENING + "\n\n"), as_col(text), F.lit("\n\n" + fixed.SUMMARIZE_CLOSING)
    )
