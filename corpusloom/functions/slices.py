"""Python functions of one column, a slice of rows at a time.

Spark hands a Python worker up to 10,000 rows at once. As pandas series, a batch of
whole texts and the lists made of them are Python objects all at the same time, some
ten times its bytes. Here only a slice of it is, and each slice's results leave before
the next is made: a worker's memory is that of Spark's own batch, however many rows a
task has.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROWS = 64
TEXTS = T.ArrayType(T.StringType()), pa.list_(pa.string())


def by_slices(kind: T.DataType, arrow: pa.DataType, start: Callable[[], Callable[[object], object]]) -> Callable:
    """A function of a column with results of a type, given in Spark's and in Arrow's terms.

    ``start`` is called once per task and gives the function of one value, null being None.
    """

    @F.arrow_udf(kind)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        of_value = start()
        for batch in batches:
            for at in range(0, len(batch), ROWS):
                yield pa.array([of_value(value) for value in batch.slice(at, ROWS).to_pylist()], arrow)

    return run
