"""Balanced runs of an ordered axis, and lookups in sorted boundaries.

``(keys, order)`` is cut at sampled quantiles into runs of about equal numbers of
rows, whatever the values are and however many rows one key holds.  Rows go to their
run in one exchange (``repartitionById``); a window per ``(run, keys)`` needs no
further one.  What a key carries from run to run is a window over one total per run
and key, and only keys that lie in several runs carry anything: at most two rows for
each run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SAMPLED = 64            # rows sampled for each run
RUN = "__run"


def lower_slot(value: Column, bounds: Column, n: int) -> Column:
    """How many of the ``n`` sorted ``bounds`` (an array) are not above ``value``, by
    binary search: the work per row grows with the logarithm of ``n``."""
    steps = F.expr("array(" + ", ".join(str(1 << k) for k in reversed(range(max(1, n.bit_length())))) + ")")
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(
        (at + step <= n) & (F.get(bounds, at + step - 1) <= value), at + step).otherwise(at))


def literal_array(rows: list[tuple], types: list[str]) -> Column:
    """A constant array of structs of typed values given as text (None: NULL)."""
    def one(v, t):
        return f"cast(null as {t})" if v is None else "cast('" + v.replace("\\", "\\\\").replace("'", "\\'") + f"' as {t})"
    return F.expr("array(" + ", ".join("struct(" + ", ".join(map(one, r, types)) + ")" for r in rows) + ")")


def in_runs(df: DataFrame, part: list[str], order: str, runs: int | None = None) -> DataFrame:
    """``df`` with the number of the row's run in :data:`RUN`, not yet exchanged.

    The cuts are quantiles of a bounded uniform sample (``SAMPLED`` rows for each run, one
    pass over the key columns); a run holds about 1/``runs`` of the rows.
    Rows with equal ``(part, order)`` share a run."""
    runs = runs or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cols = [*part, order]
    types = [df.schema[c].dataType.simpleString() for c in cols]
    sample = (df.select(*cols, F.rand(7).alias("__r")).orderBy("__r").limit(SAMPLED * runs)
              .withColumn("__n", F.row_number().over(Window.orderBy(*cols))))
    cuts = (sample.where(F.col("__n") % SAMPLED == 0).orderBy("__n")
            .select(*[F.col(c).cast("string").alias(f"c{i}") for i, c in enumerate(cols)]).collect())   # at most `runs` rows
    if not cuts:
        return df.withColumn(RUN, F.lit(0))
    return df.withColumn(RUN, lower_slot(F.struct(*cols), literal_array(cuts, types), len(cuts)))


def dealt(df: DataFrame, runs: int | None = None) -> DataFrame:
    """The rows of :func:`in_runs`, each run in a task of its own."""
    runs = runs or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartitionById(runs + 1, F.col(RUN))


def carried(totals: DataFrame, part: list[str], carry: Column, out: str) -> DataFrame:
    """``carry``, an expression over a key's runs, for the keys that lie in several runs."""
    key = Window.partitionBy(*part)
    return (totals.withColumn("__runs", F.count(F.lit(1)).over(key)).where(F.col("__runs") > 1)
            .withColumn(out, carry).select(RUN, *part, out))


def with_carry(rows: DataFrame, carry: DataFrame, part: list[str]) -> DataFrame:
    """Left join of the few carried rows; NULL keys match each other."""
    names = [RUN, *part]
    r = carry.select(*[F.col(c).alias(f"__k{names.index(c)}") if c in names else F.col(c) for c in carry.columns])
    cond = [rows[c].eqNullSafe(r[f"__k{i}"]) for i, c in enumerate(names)]
    # at most two rows a run: a run's end can cut one key only
    return rows.join(F.broadcast(r), cond, "left").drop(*[f"__k{i}" for i in range(len(names))])
