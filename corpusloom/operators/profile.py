"""Input profile: counts, samples and problems per file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom import fixed_values as fixed
from corpusloom.functions.text import as_col, non_empty


def record_sample(fields: Column | str) -> Column:
    """Sample text of a record given as an ordered string map.

    First non-empty candidate field, else every longer string with its name.
    """
    fields = as_col(fields)
    picked = F.coalesce(*[non_empty(fields[name]) for name in fixed.PROFILE_TEXT_COLUMNS])
    long_fields = F.filter(F.map_entries(fields), lambda item: F.length(item["value"]) > fixed.PROFILE_PIECE_MIN)
    pieces = F.transform(
        long_fields,
        lambda item: F.concat(item["key"], F.lit(": "), F.substring(item["value"], 1, fixed.PROFILE_FIELD)),
    )
    text = F.coalesce(picked, F.array_join(pieces, "\n\n"), F.lit(""))
    return F.substring(text, 1, fixed.PROFILE_SAMPLE)


def profile_records(records: DataFrame, sample: Column, by: str = "file", order: str = "row_index") -> DataFrame:
    """(file, count, samples) with the samples of each file's first records.

    Counts combine before the shuffle. The ranking sees short samples instead of
    whole records and keeps only the first rows of each task, so a file with most
    of the rows costs no more than any other.
    """
    counts = records.groupBy(by).agg(F.count("*").alias("count"))
    rank = F.row_number().over(Window.partitionBy(by).orderBy(order))
    short = records.select(by, order, sample.alias("sample"))
    first = short.withColumn("_rank", rank).where(F.col("_rank") <= fixed.PROFILE_ROWS)
    samples = first.groupBy(by).agg(
        F.array_sort(F.collect_list(F.struct("_rank", "sample"))).alias("items")
    )
    return counts.join(samples, by).select(
        by, "count", F.transform("items", lambda item: item["sample"]).alias("samples")
    )


def text_profile(text: Column | str) -> tuple[Column, Column]:
    """(head, length) of a whole text file."""
    text = as_col(text)
    return F.substring(text, 1, fixed.PROFILE_HEAD), F.length(text)
