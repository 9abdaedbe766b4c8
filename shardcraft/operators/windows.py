"""Window computations (W1-W4) that stay balanced when one key holds a large
share of the rows.

A plain ``Window.partitionBy(key)`` sends every row of a key to one task.
Here the rows are cut into balanced runs of (key, order) at sampled quantiles
(:mod:`.runs`): totals per run and key are reduced with a partial aggregate, carried across
runs by a window over those few rows, and the row-level window runs per
``(run, key)`` after the one exchange of rows.  Top-n per key uses
``row_number() <= n``, which Spark plans with a map-side ``WindowGroupLimit``,
so a hot key contributes at most n rows per map task to the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .runs import RUN, carried, dealt, in_runs, with_carry


def _list(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def suffix_sum(df: DataFrame, part, order: str, value: Column, out: str, inclusive: bool = True,
               runs: int | None = None) -> DataFrame:
    """``out`` = sum of ``value`` over the rows of the same ``part`` that follow this one by
    ``order`` (and this row's own, if ``inclusive``).  NULL keys are one key."""
    part = _list(part)
    d = in_runs(df.withColumn("__v", value), part, order, runs)
    totals = d.groupBy(RUN, *part).agg(F.sum("__v").alias("__tot"))
    after = Window.partitionBy(*part).orderBy(RUN).rowsBetween(1, Window.unboundedFollowing)
    later = carried(totals, part, F.sum("__tot").over(after), "__later")
    frame = (0 if inclusive else 1, Window.unboundedFollowing)
    local = dealt(d, runs).withColumn("__local", F.sum("__v").over(
        Window.partitionBy(RUN, *part).orderBy(order).rowsBetween(*frame)))
    zero = F.lit(0).cast(d.schema["__v"].dataType)
    return (with_carry(local, later, part)
            .withColumn(out, F.coalesce("__local", zero) + F.coalesce("__later", zero))
            .drop("__v", RUN, "__local", "__later"))


def ledger_balance(df: DataFrame, runs: int | None = None) -> DataFrame:
    """The balance column left by sequential replay of the transfers.
    Each debit inserts a 0-balance row and then subtracts its amount from every
    row of its account, so a row ends at minus the sum of its own and all
    later debits of the account (ordered by id); credits add nothing."""
    debit = F.when(F.col("transaction_type") == "DEBIT", F.col("amount")).otherwise(F.lit(0))
    s = suffix_sum(df, "account_id", "id", debit.cast("decimal(15,2)"), "__debits", runs=runs)
    return s.withColumn("balance", (-F.col("__debits")).cast("decimal(18,2)")).drop("__debits")


def latest_per_key(df: DataFrame, keys, order) -> DataFrame:
    """The newest row per key (largest ``order``; remaining columns break
    ties).  A ``max`` over a struct is a partial aggregate, so a key with many
    changes is reduced on the map side."""
    keys, order = _list(keys), _list(order)
    rest = [c for c in df.columns if c not in keys and c not in order]
    m = df.groupBy(*keys).agg(F.max(F.struct(*order, *rest)).alias("__m"))
    return m.select(*keys, *[F.col("__m")[c].alias(c) for c in order + rest])


def last_n(df: DataFrame, series, ts: str, n: int, value: str, avg_over: int = 5,
           tie: str | None = None) -> DataFrame:
    """The last ``n`` points of each series with a moving average over the
    last ``avg_over`` points.  ``n + avg_over - 1`` rows per series are kept
    (map-side limited), which is exactly what the averages need."""
    series = _list(series)
    order = [F.col(ts).desc()] + ([F.col(tie).desc()] if tie else [])
    keep = n + avg_over - 1
    ranked = df.withColumn("__rn", F.row_number().over(Window.partitionBy(*series).orderBy(*order)))
    kept = ranked.where(F.col("__rn") <= keep)
    w = Window.partitionBy(*series).orderBy(F.col("__rn").desc()).rowsBetween(-(avg_over - 1), 0)
    return (kept.withColumn("moving_avg", F.round(F.avg(value).over(w), 4))
                .where(F.col("__rn") <= n)
                .withColumn("recency", F.col("__rn").cast("long")).drop("__rn"))


def balanced_lag(df: DataFrame, part, order: str, value: str, out: str, runs: int | None = None) -> DataFrame:
    """``out`` = ``value`` of the previous row (by ``order``) within ``part``; a key's first
    row in a run takes the last value of the key's previous run.  NULL keys are one key."""
    part = _list(part)
    d = in_runs(df, part, order, runs)
    totals = d.groupBy(RUN, *part).agg(F.max_by(value, order).alias("__last"))
    carry = carried(totals, part, F.lag("__last").over(Window.partitionBy(*part).orderBy(RUN)), "__carry")
    w = Window.partitionBy(RUN, *part).orderBy(order)
    local = dealt(d, runs).withColumn("__lagv", F.lag(value).over(w)).withColumn("__first", F.row_number().over(w) == 1)
    return (with_carry(local, carry, part)
            .withColumn(out, F.when(F.col("__first"), F.col("__carry")).otherwise(F.col("__lagv")))
            .drop(RUN, "__lagv", "__first", "__carry"))


def counter_deltas(snapshots: DataFrame, keys=("node", "variable_name"), ts: str = "snapshot_ts",
                   value: str = "value") -> DataFrame:
    """Per counter, the increase since the previous snapshot.  A counter
    that went down was reset (server restart): the delta is then the new value."""
    keys = _list(keys)
    d = balanced_lag(snapshots, keys, ts, value, "__prev")
    delta = (F.when(F.col("__prev").isNull(), F.lit(None))
              .when(F.col(value) < F.col("__prev"), F.col(value))
              .otherwise(F.col(value) - F.col("__prev")))
    return d.withColumn("delta", delta).drop("__prev")


def hit_ratio(deltas: DataFrame, reads: str, requests: str, keys=("node",),
              ts: str = "snapshot_ts") -> DataFrame:
    """``1 - reads/requests`` per snapshot from counter deltas
    (the buffer-pool hit ratio; NULL when there were no requests)."""
    keys = _list(keys)
    p = (deltas.where(F.col("variable_name").isin(reads, requests))
               .groupBy(*keys, ts).pivot("variable_name", [reads, requests]).agg(F.first("delta")))
    from .aggregates import ratio_fixed
    return p.withColumn("hit_ratio", ratio_fixed(F.col(requests) - F.col(reads), F.col(requests), 6))
