"""Combining single-row aggregates without joins.

Gates and measures often put several global aggregates side by side.  A join
on a constant key would plan as a nested-loop join; a scalar subquery
(``DataFrame.scalar()``) is evaluated once and attached as a literal-like
column, which is what the source's ``(SELECT …)`` and ``CROSS JOIN`` of
one-row CTEs mean.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


#: A side with at most so many rows may be broadcast.
BROADCAST_ROWS = 200_000


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``max_rows`` rows; a
    larger one is left to a shuffle join."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


#: Rows that one task sorts or groups at a time where whole rows are aggregated.
TASK_ROWS = 250_000


def tasks_of(df: DataFrame, rows: int | None = None) -> int:
    """How many tasks of about ``rows`` rows ``df`` needs."""
    return max(1, -(-df.count() // (rows or TASK_ROWS)))


def spread(df: DataFrame, *by: str, rows: int | None = None) -> DataFrame:
    """``df`` dealt out by ``by`` to tasks of about ``rows`` rows, if it has
    more than that.  An aggregation of whole rows sorts them, all of a file
    split at once, however well that split was compressed."""
    n = tasks_of(df, rows)
    return df.repartition(n, *by) if n > 1 else df


def beside(*dfs: DataFrame) -> DataFrame:
    """The columns of several one-row frames as one row (the first frame's
    row carries the others as scalar subqueries)."""
    out = dfs[0]
    for i, d in enumerate(dfs[1:]):
        s = d.select(F.struct(*[F.col(f"`{c}`") for c in d.columns]).alias("s")).scalar()
        out = out.select("*", s.alias(f"_b{i}")).select(*[F.col(f"`{c}`") for c in out.columns],
                                                         *[F.col(f"_b{i}").getField(c).alias(c) for c in d.columns])
    return out
