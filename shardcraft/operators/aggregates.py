"""Grouped aggregations.

Every aggregate here is decomposable (count/sum/min/max/avg), so Spark plans a
partial aggregate before the exchange: a hot group costs one partial row per
map task, never a third of the table in one task.  Averages are reported as
``round(sum/count, digits)`` in double, from exact sums, so that engines agree on the digits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import topk


def ratio_fixed(num, den, digits: int = 4) -> Column:
    """``num / den`` for non-negative integer-valued columns, rounded half-up
    to ``digits`` with integer arithmetic (``(2·num·10^d + den) div 2·den``),
    so that every engine returns the same double; NULL when ``den`` is 0."""
    n = (F.col(num) if isinstance(num, str) else num).cast("decimal(38,0)")
    d = (F.col(den) if isinstance(den, str) else den).cast("decimal(38,0)")
    a = n * F.lit(2 * 10 ** digits) + d
    b = F.nullif(d, F.lit(0)) * F.lit(2)
    q = ((a - F.pmod(a, b)) / b).cast("decimal(38,0)")
    return q.cast("double") / F.lit(float(10 ** digits))


def avg_fixed(col, digits: int = 4) -> Column:
    """Average rounded half-up to ``digits``.  It comes from the exact sum of the
    values as decimals, so it doesn't depend on the order of addition; where
    values (beyond 1e26, not finite) or their sum don't fit a decimal, it is the plain
    average of the doubles."""
    c = F.col(col) if isinstance(col, str) else col
    exact = c.try_cast("decimal(38,12)")
    n = F.nullif(F.count(exact).cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)"))
    mean = F.round(F.try_sum(exact) / n, digits).cast("double")
    return F.when(F.count(exact) == F.count(c), F.coalesce(mean, F.round(F.avg(c.cast("double")), digits))) \
            .otherwise(F.round(F.avg(c.cast("double")), digits))


def top_users(df: DataFrame, since, min_orders: int, n: int,
              user_col: str = "user_id", date_col: str = "order_date",
              price_col: str = "price", qty_col: str = "quantity") -> DataFrame:
    """A2: per user count / avg price / total quantity of recent rows,
    ``HAVING count > min_orders``, top ``n`` by average price."""
    g = (df.where(F.col(date_col) >= since)
           .groupBy(user_col)
           .agg(F.count(F.lit(1)).alias("order_count"),
                avg_fixed(price_col).alias("avg_price"),
                F.sum(qty_col).cast("bigint").alias("total_quantity"))
           .where(F.col("order_count") > min_orders))
    return topk.by(g, ["-avg_price"], n, [user_col])


def status_summary(df: DataFrame, status_col: str = "status", price_col: str = "price",
                   qty_col: str | None = "quantity", where: Column | None = None) -> DataFrame:
    """A3/A4: count, avg/min/max price and total quantity per status,
    optionally after a predicate (A4 passes a JSON-number predicate)."""
    if where is not None:
        df = df.where(where)
    aggs = [F.count(F.lit(1)).alias("count"), avg_fixed(price_col).alias("avg_price"),
            F.min(price_col).alias("min_price"), F.max(price_col).alias("max_price")]
    if qty_col:
        aggs.append(F.sum(qty_col).cast("bigint").alias("total_quantity"))
    return df.groupBy(status_col).agg(*aggs)


def status_summary_by_order(items: DataFrame, orders: DataFrame, item_order: str, order_key: str,
                            status_col: str, price_col: str, qty_col: str) -> DataFrame:
    """A3 with the line items aggregated per order before the join (eager
    aggregation).  The join shuffles by order key anyway; aggregating first
    lets each map task merge the lines of an order, so the large side
    shuffles one partial row per order instead of one row per line.  The
    per-order partials (counts, exact price sum, min, max, quantity) combine
    exactly into the per-status result of :func:`status_summary`.  A decimal price keeps its
    scale; any other is summed with 12 decimals."""
    price, kind = F.col(price_col), items.schema[price_col].dataType
    if isinstance(kind, T.DecimalType):
        mean = ratio_fixed(F.sum("__sum") * F.lit(10 ** kind.scale), F.sum("__priced") * F.lit(10 ** kind.scale), 4)
        exact = price
    else:
        mean = F.round(F.sum("__sum") / F.nullif(F.sum("__priced"), F.lit(0)).cast("decimal(20,0)"), 4).cast("double")
        exact = price.cast("decimal(38,12)")
    per_order = items.groupBy(F.col(item_order).alias("__ok")).agg(
        F.count(F.lit(1)).alias("__n"), F.count(price).alias("__priced"), F.sum(exact).alias("__sum"),
        F.min(price).alias("__min"), F.max(price).alias("__max"),
        F.sum(F.col(qty_col).cast("int")).alias("__qty"))
    o = orders.select(F.col(order_key).alias("__ok"), F.col(status_col).alias("status"))
    j = per_order.join(o, "__ok")
    return j.groupBy("status").agg(
        F.sum("__n").alias("count"),
        mean.alias("avg_price"),
        F.min("__min").alias("min_price"), F.max("__max").alias("max_price"),
        F.sum("__qty").cast("bigint").alias("total_quantity"))


def json_number(json_col, path: str) -> Column:
    """A JSON number as double; malformed documents give NULL, not an error."""
    c = F.col(json_col) if isinstance(json_col, str) else json_col
    return F.get_json_object(c, path).try_cast("double")


def json_avg(df: DataFrame, group, json_col: str, path: str) -> DataFrame:
    """A5: average of a JSON number per group."""
    group = [group] if isinstance(group, str) else list(group)
    v = json_number(json_col, path)
    return df.groupBy(*group).agg(F.count(F.lit(1)).alias("n"),
                                  avg_fixed(v).alias("avg_value"))


def ledger_summary(df: DataFrame, n: int = 50) -> DataFrame:
    """Credits, debits, count and last date per account; accounts with
    more than one transaction; top ``n`` by credits."""
    amt = F.col("amount")
    typ = F.col("transaction_type")
    g = (df.groupBy("account_id")
           .agg(F.sum(F.when(typ == "CREDIT", amt).otherwise(F.lit(0))).cast("decimal(18,2)")
                 .alias("total_credits"),
                F.sum(F.when(typ == "DEBIT", amt).otherwise(F.lit(0))).cast("decimal(18,2)")
                 .alias("total_debits"),
                F.count(F.lit(1)).alias("transaction_count"),
                F.max("transaction_date").alias("last_transaction"))
           .where(F.col("transaction_count") > 1))
    return topk.by(g, ["-total_credits"], n, ["account_id"])


def text_profile(df: DataFrame, group: str, text_col: str, min_count: int = 10,
                 json_col: str | None = None, json_path: str | None = None,
                 where: Column | None = None) -> DataFrame:
    """Per group: count, average byte length of the text (MySQL LENGTH
    counts bytes), optional average of a JSON number as DECIMAL(10,6);
    groups with more than ``min_count`` rows."""
    if where is not None:
        df = df.where(where)
    aggs = [F.count(F.lit(1)).alias("count"),
            avg_fixed(F.octet_length(text_col)).alias("avg_text_length")]
    if json_col:
        aggs.append(avg_fixed(json_number(json_col, json_path).cast("decimal(10,6)"), 6)
                    .alias("avg_random_val"))
    return (df.groupBy(group).agg(*aggs)
              .where(F.col("count") > min_count))


def distribution(df: DataFrame, col: str) -> DataFrame:
    """Rows per value with its share of the total.  The total is an
    uncorrelated scalar subquery (computed once), not a global window."""
    total = df.select(F.count(F.lit(1))).scalar()
    return (df.groupBy(col).agg(F.count(F.lit(1)).alias("rows"))
              .withColumn("share_pct", ratio_fixed(F.col("rows") * 100, total, 4)))


def _stats(c: Column, prefix: str) -> list[Column]:
    return [F.count(c).alias(prefix + "n"), avg_fixed(c).alias(prefix + "avg"),
            F.round(F.min(c), 4).alias(prefix + "min"), F.round(F.max(c), 4).alias(prefix + "max"),
            F.round(F.stddev_pop(c), 4).alias(prefix + "stddev")]


def stats(df: DataFrame, group, col: str, prefix: str = "") -> DataFrame:
    """Avg / min / max / population stddev per group, rounded to 4 digits."""
    group = [group] if isinstance(group, str) else list(group)
    return df.groupBy(*group).agg(*_stats(F.col(col).cast("double"), prefix))


def stats_diff(a: DataFrame, b: DataFrame, group, col: str = "v") -> DataFrame:
    """Compare two samples per group in one aggregate over both; a missing or
    empty sample counts as zeros (as the reference's reducer returns zeros for an empty
    list).  Rows without a group are one group."""
    group = [group] if isinstance(group, str) else list(group)
    v, none = F.col(col).cast("double"), F.lit(None).cast("double")
    both = a.select(*group, v.alias("__a"), none.alias("__b")).unionAll(
        b.select(*group, none.alias("__a"), v.alias("__b")))
    j = both.groupBy(*group).agg(*_stats(F.col("__a"), "a_"), *_stats(F.col("__b"), "b_"))
    out = [F.col(g) for g in group]
    for m in ("n", "avg", "min", "max", "stddev"):
        ca, cb = (F.coalesce(F.col(s + m), F.lit(0)) for s in ("a_", "b_"))
        out += [ca.alias("a_" + m), cb.alias("b_" + m)]
        if m != "n":
            out.append(F.round(ca - cb, 4).alias("diff_" + m))
    return j.select(*out)
