import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpusloom.functions.chunking import chunk_text
from corpusloom.functions.models import generated
from corpusloom.functions.sentences import distinct_sentences
from corpusloom.functions.slices import ROWS, TEXTS, by_slices
from corpusloom.sources import csv_rows


def numbering():
    """A generator, made here so that it travels by value, that tells how many calls its task made."""

    class Numbering:
        def __init__(self):
            self.calls = 0

        def generate(self, prompt, max_new_tokens):
            self.calls += 1
            if prompt == "7":
                raise ValueError("seven")
            return f"{prompt}:{self.calls}"

    return Numbering


@pytest.mark.parametrize("rows", [0, 1, ROWS, ROWS + 1, 5 * ROWS - 1])
def test_slices_keep_rows_and_order(spark, rows):
    """Values of a task's batch come one by one, in order, whatever its length; a null is a value."""
    doubled = by_slices(*TEXTS, lambda: lambda value: None if value is None else [value, value])
    value = F.when(F.col("id") % 5 != 3, F.col("id").cast("string"))
    made = spark.range(0, rows, 1, 1).select("id", doubled(value).alias("r")).collect()
    assert [(row["id"], row["r"]) for row in made] == [(i, [str(i)] * 2 if i % 5 != 3 else None) for i in range(rows)]


def test_generation_loads_once_per_task(spark):
    made = spark.range(0, 3 * ROWS, 1, 1).select(generated(F.col("id").cast("string"), numbering(), 5).alias("a")).select("a.*").collect()
    assert [row["text"] for row in made] == [f"{i}:{i + 1}" if i != 7 else "Error: seven" for i in range(3 * ROWS)]
    assert [i for i, row in enumerate(made) if row["failed"]] == [7]


@pytest.mark.parametrize("function", [distinct_sentences, chunk_text, lambda v: generated(v, numbering(), 5)])
def test_only_a_slice_of_a_batch_becomes_python_objects(spark, function):
    """The functions over whole texts are Arrow iterators: no series of all texts of a batch, nor of all lists made of them."""
    plan = spark.createDataFrame([("a. " * 2000,)], "v string").select(function(F.col("v")))._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan
    from pyspark.util import PythonEvalType

    assert f", {PythonEvalType.SQL_SCALAR_ARROW_ITER_UDF}" in plan.split("ArrowEvalPython", 1)[1]


def test_csv_lines_of_a_batch_become_python_objects_in_slices(monkeypatch):
    """10,000 lines arrive at once; no more than a slice of them is converted ahead of the parser."""
    columns = [["p"] * 10_000, [0] * 10_000, ["f"] * 10_000, [1] * 10_000, [b"line"] * 10_000]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["path", "start", "file", "size", "value"])
    seen = []

    class Counted:
        columns, num_rows = batch.columns, batch.num_rows

        def slice(self, at, size):
            seen.append(size)
            return batch.slice(at, size)

    ((*_, lines),) = ((*split[:4], list(split[4])) for split in csv_rows._splits(iter([Counted()])))
    assert lines == [b"line"] * 10_000
    assert seen and max(seen) <= 64
