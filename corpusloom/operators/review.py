"""Quality gate: review table and training records."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom import fixed_values as fixed
from corpusloom.functions.models import Embedder, embedded
from corpusloom.functions.similarity import cosine
from corpusloom.functions.text import as_col, non_empty


def split_list(text: str) -> list[str]:
    """Items of a comma-separated option."""
    return [item.strip() for item in text.split(",") if item.strip()]


def missing_headings(text: Column | str, headings: list[str] | None = None) -> Column:
    """Required headings a text lacks, in order; letter case does not matter."""
    headings = fixed.REQUIRED_HEADINGS if headings is None else headings
    lowered = F.lower(F.coalesce(as_col(text), F.lit("")))
    missing = [F.when(~F.contains(lowered, F.lit(heading.lower())), F.lit(heading)) for heading in headings]
    return F.array_compact(F.array(*missing).cast("array<string>"))


def preview(text: Column | str, length: int = fixed.FIELD_PREVIEW) -> Column:
    return F.substring(F.coalesce(as_col(text), F.lit("")), 1, length)


def input_output_similarity(load: Callable[[], Embedder]) -> Column:
    """Cosine of the head of the input and the whole output; null without an output."""
    output = non_empty("output")
    return F.when(output.isNotNull(), cosine(embedded(preview("input"), load), embedded(output, load)))


def score(
    examples: DataFrame, headings: list[str] | None = None, load_embedder: Callable[[], Embedder] | None = None
) -> DataFrame:
    """Adds ``missing`` and ``similarity`` (null where not checked), computed once for both outputs."""
    similarity = input_output_similarity(load_embedder) if load_embedder else F.lit(None).cast("double")
    return examples.withColumns(
        {"missing": missing_headings("output", headings), "similarity": similarity.cast("double")}
    )


def _metadata(df: DataFrame, name: str) -> Column:
    kind = df.schema["metadata"].dataType if "metadata" in df.columns else None
    if isinstance(kind, T.VariantType):
        value = F.try_variant_get("metadata", f"$.{name}", "string")
    elif isinstance(kind, T.MapType) or (isinstance(kind, T.StructType) and name in kind.names):
        value = F.col("metadata")[name].cast("string")
    else:
        return F.lit("")
    return F.coalesce(value, F.lit(""))


def review_rows(scored: DataFrame, sample: int = 0) -> DataFrame:
    """Review columns of scored examples with their ordinal ``idx``; ``sample`` > 0 keeps the first rows."""
    rows = scored.where(F.col("idx") < sample) if sample > 0 else scored
    head = preview("output", fixed.OUTPUT_PREVIEW)
    return rows.select(
        "idx",
        preview("instruction").alias("instruction"),
        preview("input").alias("input"),
        F.replace(head, F.lit("\n"), F.lit("\\n")).alias("output_preview"),
        F.array_join("missing", ";").alias("missing_headings"),
        F.when(F.col("similarity").isNull(), F.lit(""))
        .otherwise(F.format_string("%.4f", "similarity"))
        .alias("embedding_similarity"),
        _metadata(scored, "generated_by").alias("generated_by"),
        _metadata(scored, "generated_at").alias("generated_at"),
        F.lit("").alias("note_review_status"),
    )


def passes_gate(threshold: float = fixed.SIMILARITY_THRESHOLD) -> Column:
    """An output with all headings whose similarity, where known, reaches the threshold."""
    return (
        non_empty("output").isNotNull()
        & (F.size("missing") == 0)
        & (F.col("similarity").isNull() | (F.col("similarity") >= threshold))
    )


def training_records(scored: DataFrame, threshold: float = fixed.SIMILARITY_THRESHOLD) -> DataFrame:
    """(instruction, input, output, metadata) of the examples that pass, '' or {} for what is missing."""
    texts = [F.coalesce(name, F.lit("")).alias(name) for name in ("instruction", "input", "output")]
    extra = []
    if "metadata" in scored.columns:
        nothing = {T.VariantType: F.parse_json(F.lit("{}")), T.MapType: F.create_map()}
        empty = nothing.get(type(scored.schema["metadata"].dataType), F.lit(None))
        extra = [F.coalesce("metadata", empty).alias("metadata")]
    return scored.where(passes_gate(threshold)).select(*texts, *extra)
