"""Evaluate an expensive expression once.

Catalyst copies a computed column into every filter it pushes down (also into
the one it infers from an inner ``explode``), and an expression used in several
branches is evaluated per branch. With regex chains and Python functions over
whole texts that multiplies the cost of a plan; measured here, by up to thirty.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once."""
    return F.get(F.transform(F.array(value), body), 0)


def compute_where(
    df: DataFrame, keep: tuple[str, ...], computed: dict[str, Column], condition: Callable[[Column], Column]
) -> DataFrame:
    """``keep`` and the computed columns of the rows that meet ``condition``.

    ``condition`` takes the struct of computed columns. The outer generator keeps
    the filter above the computation; filters on ``keep`` still reach the scan.
    """
    made = F.filter(F.array(F.struct(*[value.alias(name) for name, value in computed.items()])), condition)
    return (
        df.select(*keep, F.explode_outer(made).alias("_made"))
        .where(F.col("_made").isNotNull())
        .select(*keep, *[F.col("_made")[name].alias(name) for name in computed])
    )
