"""Replication and service monitors.

Every function takes streaming or batch DataFrames alike: watermarks are
ignored by batch plans, so the batch form computes exactly what the stream
emits once the watermark has passed every window.

Late data: a row whose window was already emitted (its end is behind the
watermark of the previous micro-batch) is dropped by the windowed monitors
in append mode; until then it is still counted.  The change apply (T1)
never drops anything: it orders by log position instead.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.aggregates import avg_fixed, ratio_fixed
from ..operators.metrics import THRESHOLDS

# Replication-lag limit (seconds) and slow-statement threshold (ms).
MAX_LAG_SECONDS = 10
SLOW_MS = 2000.0


def _event_time(df: DataFrame, col: str, watermark: str) -> DataFrame:
    """Watermarks need TIMESTAMP; NTZ event times are read in the session zone."""
    if type(df.schema[col].dataType).__name__ == "TimestampNTZType":
        df = df.withColumn(col, F.col(col).cast("timestamp"))
    return df.withWatermark(col, watermark)


def _ntz(c):
    return c.cast("timestamp_ntz")


def _seconds(lo, hi):
    return F.timestamp_diff("MICROSECOND", lo, hi) / F.lit(1_000_000.0)


def replication_lag(source: DataFrame, applied: DataFrame, replicas: list[str],
                    max_lag_s: float = MAX_LAG_SECONDS, bound: str | None = None,
                    watermark: str = "1 minute") -> DataFrame:
    """One row per source change and replica of ``replicas``: seconds from
    commit to apply and a flag over ``max_lag_s``; a change that the replica
    never applied has a NULL apply time and is flagged.  A stream needs a
    ``bound`` (an interval such as ``"1 minute"``), after which a change counts
    as not applied, so that its state stays bounded; a batch needs none."""
    names = F.explode(F.array(*[F.lit(r) for r in replicas])).alias("replica")
    s = _event_time(source.select(F.col("pos").alias("s_pos"), "commit_ts"), "commit_ts", watermark) \
        .select("s_pos", "commit_ts", names)
    a = _event_time(applied.select(F.col("replica").alias("a_replica"), F.col("pos").alias("a_pos"), "apply_ts"),
                    "apply_ts", watermark)
    cond = ((F.col("s_pos") == F.col("a_pos")) & (F.col("replica") == F.col("a_replica"))
            & (F.col("apply_ts") >= F.col("commit_ts")))
    if bound:
        cond = cond & (F.col("apply_ts") <= F.col("commit_ts") + F.expr(f"INTERVAL {bound}"))
    j = s.join(a, cond, "leftOuter")
    lag = _seconds(F.col("commit_ts"), F.col("apply_ts"))
    return j.select(F.col("s_pos").alias("pos"), _ntz(F.col("commit_ts")).alias("commit_ts"), "replica",
                    _ntz(F.col("apply_ts")).alias("apply_ts"),
                    F.round(lag, 6).alias("lag_s"),
                    F.coalesce(lag > max_lag_s, F.lit(True)).alias("lagging"))


def sync_monitor(source: DataFrame, applied: DataFrame, window: str = "5 minutes",
                 watermark: str = "1 minute", replicas: list[str] | None = None) -> DataFrame:
    """Per tumbling interval, source changes vs applied changes and an
    in-sync flag; with ``replicas`` one applied count and flag per replica, and
    the interval is in sync if every replica applied every change.  One windowed aggregate over a
    tagged union, with conditional sums instead of a pivot, so it runs as a
    stream."""
    s = source.select(F.col("commit_ts").alias("ts"), F.lit(None).cast("string").alias("replica"),
                      F.lit(True).alias("is_source"))
    a = applied.select(F.col("apply_ts").alias("ts"), "replica", F.lit(False).alias("is_source"))
    u = _event_time(s.unionByName(a), "ts", watermark)
    aggs = [F.sum(F.col("is_source").cast("long")).alias("source_changes"),
            F.sum((~F.col("is_source")).cast("long")).alias("applied_changes")]
    for r in replicas or []:
        aggs.append(F.sum((~F.col("is_source") & (F.col("replica") == r)).cast("long")).alias(f"applied_{r}"))
    g = u.groupBy(F.window("ts", window).alias("w")).agg(*aggs)
    cols = [_ntz(F.col("w.start")).alias("window_start"), _ntz(F.col("w.end")).alias("window_end"),
            "source_changes", "applied_changes",
            reduce(lambda x, y: x & y, [F.col("source_changes") == F.col(f"applied_{r}") for r in replicas]
                   if replicas else [F.col("source_changes") == F.col("applied_changes")]).alias("in_sync")]
    for r in replicas or []:
        cols += [f"applied_{r}", (F.col("source_changes") == F.col(f"applied_{r}")).alias(f"in_sync_{r}")]
    return g.select(*cols)


def service_metrics(log: DataFrame, size: str, slide: str | None = None, by: str = "node",
                    watermark: str = "1 minute", ts: str = "ts", duration: str = "duration_ms",
                    ok: str = "ok") -> DataFrame:
    """T4: per window and node: statements, per second, avg/max ms, error rate."""
    seconds = F.timestamp_diff("SECOND", F.col("w.start"), F.col("w.end"))
    wnd = F.window(ts, size, slide) if slide else F.window(ts, size)
    g = (_event_time(log, ts, watermark)
            .groupBy(wnd.alias("w"), by)
            .agg(F.count(F.lit(1)).alias("statements"),
                 avg_fixed(duration).alias("avg_ms"),
                 F.round(F.max(duration), 4).alias("max_ms"),
                 F.sum((~F.col(ok)).cast("long")).alias("errors")))
    return g.select(_ntz(F.col("w.start")).alias("window_start"), _ntz(F.col("w.end")).alias("window_end"), by,
                    "statements", ratio_fixed("statements", seconds, 6).alias("per_second"),
                    "avg_ms", "max_ms", "errors",
                    ratio_fixed("errors", "statements", 6).alias("error_rate"))


def alerts(metrics: DataFrame, thresholds: dict | None = None) -> DataFrame:
    """T5: one row per metric row and breached rule: ``error_rate``,
    ``query_time`` and, where the metrics have ``avg_connect_ms``,
    ``connect_time``.  A NULL measure breaches nothing."""
    t = dict(THRESHOLDS, **(thresholds or {}))
    rules = [("error_rate", F.col("error_rate") > t["error_rate"]),
             ("query_time", F.col("avg_ms") > t["query_ms"])]
    if "avg_connect_ms" in metrics.columns:
        rules.append(("connect_time", F.col("avg_connect_ms") > t["connect_ms"]))
    breached = F.array_compact(F.array(*[F.when(cond, F.lit(name)) for name, cond in rules]))
    return metrics.withColumn("alert", F.explode(breached))


# The kinds of token of a statement, tried in this order at every place.  Repeats are
# possessive, so a literal of any length needs no deep matching stack; what isn't closed ends with the text.
_QUOTED = r"%(q)s[^%(q)s\\]*+(?:(?:\\.|%(q)s%(q)s)[^%(q)s\\]*+)*+%(q)s?+"
SPACE_TOKEN = r"(?:\s++|/\*(?:.*?\*/|.*+)|--(?=\s|\z)[^\n]*+|#[^\n]*+)++"
LITERAL_TOKEN = "|".join([
    "[xXbBnN]?+" + _QUOTED % {"q": "'"}, _QUOTED % {"q": '"'},
    r"0[xX][0-9A-Fa-f]++(?![\w$])", r"0[bB][01]++(?![\w$])",
    r"(?:[0-9]++(?:\.[0-9]*+)?+|\.[0-9]++)(?:[eE][+-]?+[0-9]++)?+(?![\w$])"])
OTHER_TOKEN = r"`[^`]*+`?+|[\w$\x{80}-\x{10FFFF}]++|."
TOKEN = f"(?s){SPACE_TOKEN}|{LITERAL_TOKEN}|{OTHER_TOKEN}"


def normalise(statement) -> F.Column:
    """Statement shape: a lexer cuts the statement into blanks and comments, literals, and
    anything else.  Literals (quoted text with escaped or doubled quotes, hex and
    bit strings, numbers with fraction and exponent) become ``?``, blanks and
    comments one space; names stay as they are, also where they hold digits or, in
    backticks, anything.  Then an IN list of any length is ``IN (?)``."""
    s = F.col(statement) if isinstance(statement, str) else statement
    s = F.array_join(F.transform(F.regexp_extract_all(s, F.lit(TOKEN), 0), _shape_of), "")
    for pattern, by in LIST_STEPS:
        s = F.regexp_replace(s, pattern, by)
    return F.trim(s)


def _shape_of(token) -> F.Column:
    """The token's part of the shape.  A token's first characters name its kind, except
    for names that begin like a literal."""
    blank = token.rlike(r"^(?:\s|#|/\*|--)")
    unsure = token.rlike(r"^[0-9.xXbBnN'\"]")
    return (F.when(blank, F.lit(" "))
             .when(unsure & token.rlike(rf"(?s)^(?:{LITERAL_TOKEN})\z"), F.lit("?")).otherwise(token))


LIST_STEPS = [
    (" ?, ?", ", "),
    (r"\( ?\?", "(?"),
    (r"(?i)\bIN ?\((?:\?, )*+\? ?\)", "IN (?)"),
]


def slow_queries(log: DataFrame, threshold_ms: float = SLOW_MS, window: str | None = None,
                 watermark: str = "1 minute", ts: str = "ts", statement: str = "statement",
                 duration: str = "duration_ms") -> DataFrame:
    """Statements slower than the threshold, grouped by shape with count,
    worst and average time (per tumbling window when ``window`` is given)."""
    slow = log.where(F.col(duration) > threshold_ms).withColumn("shape", normalise(statement))
    keys = ["shape"]
    if window:
        slow = _event_time(slow, ts, watermark)
        keys = [F.window(ts, window).alias("w"), "shape"]
    g = slow.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"),
                                F.round(F.max(duration), 4).alias("max_ms"),
                                avg_fixed(duration).alias("avg_ms"))
    if window:
        g = g.select(_ntz(F.col("w.start")).alias("window_start"), "shape", "count", "max_ms", "avg_ms")
    return g


def lag_summary(lag: DataFrame, max_lag_s: float = MAX_LAG_SECONDS) -> DataFrame:
    """T2 per replica: the lag of the newest applied change (the figure a
    replication monitor reports), the worst lag, how many changes were over
    the limit or never applied, and a flag: the newest applied change was over the
    limit, or the newest change was not applied.  Batch form (it aggregates the output of ``replication_lag``)."""
    return lag.groupBy("replica").agg(
        F.count(F.lit(1)).alias("changes"),
        F.max_by("lag_s", "pos").alias("newest_lag_s"),
        F.max("lag_s").alias("max_lag_s"),
        F.sum(F.col("lagging").cast("long")).alias("lagging_changes"),
        F.sum(F.col("apply_ts").isNull().cast("long")).alias("missing_changes"),
    ).withColumn("behind", F.coalesce(F.col("newest_lag_s") > max_lag_s, F.lit(True)))
