"""Writers for JSONL and review tables."""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator
from uuid import uuid4

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

_LINES = 64


def write_jsonl(df: DataFrame, path: str, order_by: list[str] | None = None, keep_nulls: bool = True) -> None:
    """One JSON object per line; without ``keep_nulls`` a null field is left out of its object.

    ``order_by`` range-partitions and sorts, so that part files in name order are in order.
    """
    ordered = df.orderBy(*order_by) if order_by else df
    ordered.write.mode("overwrite").option("ignoreNullFields", not keep_nulls).json(path)


def write_review_csv(df: DataFrame, path: str, order_by: list[str] | None = None) -> None:
    """CSV with a header per part file and quotes doubled; empty values stay empty."""
    ordered = df.orderBy(*order_by) if order_by else df
    ordered.write.mode("overwrite").options(header=True, quote='"', escape='"', emptyValue="").csv(path)


def write_map_csv(rows: DataFrame, column: str, headers: list[str], path: str) -> None:
    """CSV lines of string maps, in the order of the rows, with a header per part file.

    Cells are put in their places row by row, so the headers are no columns of a plan
    and may be as many as a line can hold. What a map lacks is empty.
    """
    names = rows.sparkSession.sparkContext.broadcast(headers)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        headers, place, begun = names.value, {name: at for at, name in enumerate(names.value)}, False

        def line(cells: list[str]) -> str:
            text = io.StringIO()
            csv.writer(text, lineterminator="").writerow(cells)
            return text.getvalue()

        for batch in batches:
            for at in range(0, batch.num_rows, _LINES):
                lines = [] if begun else [line(headers)]
                begun = True
                for row in batch[column].slice(at, _LINES).to_pylist():
                    cells = [""] * len(headers)
                    for name, value in row or ():
                        if name in place:
                            cells[place[name]] = value or ""
                    lines.append(line(cells))
                yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], names=["value"])

    rows.select(column).mapInArrow(run, "value string").write.mode("overwrite").text(path)


def _without_last_newline(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of a task; the last one loses the line end that would leave a line of a blank."""
    held = None
    for batch in batches:
        if batch.num_rows:
            if held is not None:
                yield held
            held = batch
    if held is not None:
        last = held["value"][-1].as_py().removesuffix("\n")
        yield held.slice(0, held.num_rows - 1)
        yield pa.RecordBatch.from_arrays([pa.array([last], pa.string())], names=["value"])


def write_long_records(pieces: DataFrame, path: str, key: str, order: list[str]) -> None:
    """Lines put together from pieces (key, order columns, value), in order of the key.

    The last piece of a line ends it. Pieces are range-partitioned by key, sorted with
    spilling, and streamed by Spark's text writer with a blank after each: nothing is
    gathered, so a line may be larger than a cell or a task's memory. One task writes
    all of a line, as it is one line of one file.
    """
    ordered = pieces.repartitionByRange(key).sortWithinPartitions(key, *order).select("value")
    streamed = ordered.mapInArrow(_without_last_newline, "value string")
    streamed.write.mode("overwrite").option("lineSep", " ").text(path)


class RuleBroken(ValueError):
    """What was written breaks a rule; nothing of it was published."""


def write_if(df: DataFrame, path: str, broken: dict[str, Column], message: str, helpers: tuple[str, ...] = ()) -> dict[str, int]:
    """Writes rows as Parquet and counts them in the same pass; publishes only if no count in ``broken`` is above 0.

    ``broken`` maps names to conditions, which may use columns that are not written
    (``helpers``); ``message`` may name the counts in braces. Rows go to a staging folder
    beside the target, which one rename puts in its place. On a broken rule, or on any
    error, the target stays as it was and the staging folder goes.
    """
    spark, seen = df.sparkSession, Observation()
    staging = f"{path.rstrip('/')}-staging-{uuid4().hex}"
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"), *(F.count_if(rule).alias(name) for name, rule in broken.items()))
    try:
        counted.drop(*helpers).write.parquet(staging)
        counts = seen.get
        if any(counts[name] for name in broken):
            raise RuleBroken(message.format(**counts))
        _replace(spark, staging, path)
        return counts
    finally:
        _delete(spark, staging)


def _file_system(spark, path: str):
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target, jvm


def _replace(spark, source: str, target: str) -> None:
    """The source folder in the target's place."""
    system, to, jvm = _file_system(spark, target)
    if system.exists(to):
        system.delete(to, True)
    if not system.rename(jvm.org.apache.hadoop.fs.Path(source), to):
        raise OSError(f"cannot move {source} to {target}")


def _delete(spark, path: str) -> None:
    system, target, _ = _file_system(spark, path)
    system.delete(target, True)
