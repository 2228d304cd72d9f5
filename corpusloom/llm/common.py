"""What the operators of this folder share: words, tables, label folds, state of Python workers."""

from __future__ import annotations

import ctypes
import gc
import itertools
import sys
import types
from collections.abc import Callable, Iterator
from uuid import uuid4

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.session import shared_folder

# White space between words; a word is a run of anything else.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(text: Column | str = "text") -> Column:
    """The text, a missing one being empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"{WORD}+"), F.lit(0))


def in_fold(doc_id: Column | str, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text leaves this remainder; a missing id is in no fold."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % folds == fold, F.lit(False))


def one_label(labels: DataFrame, label: str, usable: Column) -> DataFrame:
    """(doc_id, label 0 or 1) per usable labelled id; of several labels of an id the larger counts."""
    rows = labels.where(usable & F.col("doc_id").isNotNull() & F.col(label).isNotNull())
    return rows.groupBy("doc_id").agg(F.max(F.col(label).cast("int")).alias("label"))


def bounded_sample(rows: DataFrame, bound: int) -> DataFrame:
    """About ``bound`` rows, all if there are fewer: those whose hashed id is lowest, the same in each run.

    The share to keep comes from a count; a quarter above the bound is the most a
    hash of that many ids can deviate by, so the result may be broadcast or collected.
    """
    there = rows.count()
    if there <= bound:
        return rows
    share = int(bound / there * 2**32)
    return rows.where(F.xxhash64(F.col("doc_id"), F.lit(7)).bitwiseAND(2**32 - 1) < share)


def one_row(rows: DataFrame, *columns: str) -> DataFrame:
    """``columns`` of one row per doc_id, the least, so that as many rows as ids may be collected.

    What repeats is thinned before the shuffle, however many rows share an id.
    """
    return rows.groupBy("doc_id").agg(F.min(F.struct(*columns)).alias("_row")).select("_row.*")


def _give_back() -> None:
    """Freed memory goes back to the system, where the C library can do that."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def worker_state(name: str, make: Callable[[], object]) -> object:
    """An object that outlives the task in a Python worker, one at a time: another name lets the former go.

    Functions of this package travel by value, so their module globals are new in
    every task; what is dear to build hangs on a module that stays.
    """
    home = sys.modules.setdefault("_corpusloom_worker", types.ModuleType("_corpusloom_worker"))
    if getattr(home, "name", None) != name:
        home.kept, home.name = None, None
        _give_back()
        home.kept, home.name = make(), name
    return home.kept


def small_side(rows: DataFrame, bound: int) -> DataFrame:
    """The side of a join, to be broadcast only if a count finds at most ``bound`` rows; else Spark shuffles both sides.

    For stored rows of fixed width. Results are the same either way.
    """
    return F.broadcast(rows) if rows.limit(bound + 1).count() <= bound else rows


def slices(batches, rows: int = 256):
    """Arrow batches in slices, so that few whole texts are Python objects at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def stored(rows: DataFrame, name: str) -> DataFrame:
    """Rows written to the shared folder and read again: lost executors never force their remaking."""
    folder = f"{shared_folder(rows.sparkSession)}/{name}-{uuid4()}"
    rows.write.parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)


def folded(parts: DataFrame, fold: Callable[[Iterator[tuple]], tuple], fan_in: int = 32) -> tuple:
    """One tuple of all rows of ``parts``, which hold one state of a fixed size per task.

    Many states are folded in levels by tasks; at most ``fan_in`` reach the driver.
    """
    fields, left = parts.schema, parts.rdd.getNumPartitions()
    names, schema = fields.names, pa.schema([(f.name, {"bigint": pa.int64(), "binary": pa.binary()}[f.dataType.simpleString()]) for f in fields])

    def rows_of(batches):
        for batch in batches:
            yield from zip(*(batch[name].to_pylist() for name in names))

    def run(batches):
        rows = iter(rows_of(batches))
        first = next(rows, None)
        if first is not None:
            made = fold(itertools.chain([first], rows))
            yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(made, schema)], schema=schema)

    while left > fan_in:
        left = -(-left // fan_in)
        parts = parts.repartition(left).mapInArrow(run, fields)
    return fold(tuple(map(_plain, row)) for row in parts.collect())


def _plain(value):
    return bytes(value) if isinstance(value, bytearray) else value
