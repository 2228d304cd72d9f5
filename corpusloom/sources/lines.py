"""Line-oriented files in input order, without a global sort.

Text files are split between tasks, and inside a split Spark numbers rows in
order. (file, split, row) therefore orders all lines, at no cost. Where lines need
consecutive numbers, a line's number is its place in the split plus the lines of
the splits before it: one more pass to count, one small row per split to sum up,
no shuffle of the lines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.functions.nested import JSON_OPTIONS, is_json
from corpusloom.functions.once import let
from corpusloom.session import spread

_SPLIT = ["file_path", "split_start"]


def file_name() -> Column:
    """Plain name of the file a row comes from; Spark's metadata has it percent-encoded."""
    return F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B")))


def _number(rows: DataFrame) -> DataFrame:
    """Adds ``line_number`` (1-based, per file) and ``ordinal`` (0-based, over all files in path order)."""
    splits = rows.groupBy(*_SPLIT).agg(F.count("*").alias("n"), F.min("_row").alias("_first"))
    in_file = Window.partitionBy("file_path").orderBy("split_start").rowsBetween(Window.unboundedPreceding, -1)
    overall = Window.orderBy("file_path", "split_start").rowsBetween(Window.unboundedPreceding, -1)
    offsets = splits.select(
        *_SPLIT,
        "_first",
        F.coalesce(F.sum("n").over(in_file), F.lit(0)).alias("_in_file"),
        F.coalesce(F.sum("n").over(overall), F.lit(0)).alias("_overall"),
    )
    place = F.col("_row") - F.col("_first")
    return (
        rows.join(offsets, _SPLIT)
        .withColumns({"line_number": F.col("_in_file") + place + 1, "ordinal": F.col("_overall") + place})
        .drop("_row", "_first", "_in_file", "_overall", "split_start")
    )


def read_lines(
    spark: SparkSession,
    path: str | list[str],
    glob: str | None = None,
    skip_blank: bool = False,
    numbered: bool = True,
) -> DataFrame:
    """(file_path, file, value, line_number, ordinal) of the lines; skipped lines are not counted.

    Not ``numbered``, lines come without ``line_number``, and ``ordinal`` is a
    struct that orders them.
    """
    reader = spark.read.option("pathGlobFilter", glob) if glob else spark.read
    lines = reader.text(path)
    lines = lines.where(~_is_blank()) if skip_blank else lines
    rows = lines.select(
        F.col("_metadata.file_path").alias("file_path"),
        file_name().alias("file"),
        F.col("_metadata.file_block_start").alias("split_start"),
        F.monotonically_increasing_id().alias("_row"),
        "value",
    )
    if numbered:
        return _number(rows)
    order = F.struct("file_path", "split_start", F.col("_row").alias("row"))
    return rows.withColumn("ordinal", order).drop("split_start", "_row")


def parquet_ordinal(df: DataFrame) -> DataFrame:
    """Adds ``ordinal``, the place of each row of a parquet table in path and file order.

    Rows carry their place in their file; only one row per file is summed up.
    """
    scan = df.select("*", F.col("_metadata.file_path").alias("_path"), F.col("_metadata.row_index").alias("_at"))
    rows = spread(scan)
    counts = scan.groupBy("_path").agg((F.max("_at") + 1).alias("n"))
    before = Window.orderBy("_path").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_path", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_offset"))
    return (
        rows.join(offsets, "_path").withColumn("ordinal", F.col("_offset") + F.col("_at")).drop("_path", "_at", "_offset")
    )


def _is_blank() -> Column:
    return F.rlike("value", F.lit(r"^[\s\x1c-\x1f\x85\p{Z}]*$"))


def read_jsonl(spark: SparkSession, path: str | list[str], schema: str, numbered: bool = False) -> DataFrame:
    """Typed records plus ``ordinal``; blank lines do not count, a bad line fails the job.

    Spark's parser ignores what follows a value. Inside a list anything but a
    closing bracket would be an error, and a line that ends in one is no object.
    """
    lines = read_lines(spark, path, skip_blank=True, numbered=numbered)
    in_list = F.concat(F.lit("["), F.col("value"), F.lit("]"))
    parsed = F.from_json(in_list, f"array<struct<{schema}>>", JSON_OPTIONS | {"mode": "FAILFAST"})
    is_object = F.rlike("value", F.lit(r"\}[\s\x1c-\x1f\x85\p{Z}]*$"))
    broken = F.raise_error(F.concat(F.lit("malformed JSON line: "), F.substring("value", 1, 200)))
    record = let(parsed, lambda items: F.when(is_object & (F.size(items) == 1), F.get(items, 0)).otherwise(broken))
    return lines.select(record.alias("_record"), "ordinal").select("_record.*", "ordinal")


def read_jsonl_lenient(
    spark: SparkSession, path: str | list[str], glob: str | None = None, usable: Callable[[str], Column] = is_json
) -> tuple[DataFrame, DataFrame]:
    """(records as JSON text, rejected lines with their numbers); only the rejects pay for numbers."""
    valid = usable("value")
    lines = read_lines(spark, path, glob, numbered=False).where(~_is_blank())
    rejects = read_lines(spark, path, glob).where(~_is_blank() & ~valid)
    records = lines.where(valid).select("file", "ordinal", F.col("value").alias("record"))
    return records, rejects.select("file", "line_number", "value")
