"""Top-k (K1-K4).

``orderBy(...).limit(n)`` plans as ``TakeOrderedAndProject``: every task keeps
its own n best rows and only those reach the final merge, so a top-k never
sorts or shuffles the whole table.  Every ordering gets a unique tie-break so
that the result is deterministic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _order(spec) -> Column:
    """``"price"`` ascending, ``"-price"`` descending, or a Column."""
    if isinstance(spec, Column):
        return spec
    if spec.startswith("-"):
        return F.col(spec[1:]).desc_nulls_last()
    return F.col(spec).asc_nulls_last()


def by(df: DataFrame, order: list, n: int, tie: list | None = None,
       fan_in: int | None = None) -> DataFrame:
    """K1/K2: the first ``n`` rows in ``order`` with ``tie`` as the tie-break.

    ``orderBy().limit(n)`` alone sends every map task's n best rows to one
    task.  With ``fan_in`` the map tasks are first merged in ``fan_in``
    groups (by partition id) with a map-side limited ``row_number() <= n``,
    which bounds the final merge to ``fan_in * n`` rows.  The result is the
    same for any grouping, so a retried task cannot change it; ask for it
    when ``n`` times the number of map tasks is more than one task should read."""
    cols = [_order(o) for o in order] + [_order(t) for t in (tie or [])]
    if fan_in:
        g = df.withColumn("__g", F.spark_partition_id() % F.lit(fan_in))
        ranked = g.withColumn("__r", F.row_number().over(Window.partitionBy("__g").orderBy(*cols)))
        df = ranked.where(F.col("__r") <= n).drop("__g", "__r")
    return df.orderBy(*cols).limit(n)


def latest(df: DataFrame, order_col: str, n: int, tie: str | None = None,
           where: Column | None = None) -> DataFrame:
    """K3: the newest ``n`` rows (by time or id), optionally of one type."""
    if where is not None:
        df = df.where(where)
    return by(df, ["-" + order_col], n, ["-" + tie] if tie else None)


def ordered(df: DataFrame, key: str, tie: list | None = None) -> DataFrame:
    """K4: a globally ordered result (range-partitioned sort, no single task)."""
    return df.orderBy(*([_order(key)] + [_order(t) for t in (tie or [])]))
