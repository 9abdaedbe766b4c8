"""Operation metrics, run comparison, error rates and run documents
(A14, A15, A16, IO5)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .aggregates import avg_fixed, ratio_fixed

# The sharding lab's monitoring thresholds.
THRESHOLDS = {"query_ms": 1000.0, "connect_ms": 500.0, "error_rate": 0.05}


def _span_seconds(lo: Column, hi: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", lo, hi) / F.lit(1_000_000.0)


def throughput(log: DataFrame, run: str, thread: str, ts: str, op: str,
               duration: str, ops: list[str]) -> DataFrame:
    """Per run and thread: operations, time span, operations per second
    over the thread's own span and over the whole run's span, average ms per
    operation, and a count per operation type (``ops`` lists the types, so the
    pivot needs no extra pass to find them)."""
    per_thread = log.groupBy(run, thread).agg(
        F.count(F.lit(1)).alias("total_ops"),
        F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"),
        avg_fixed(duration).alias("avg_ms_per_op"),
        *[F.sum((F.col(op) == o).cast("long")).alias(f"ops_{o}") for o in ops])
    per_run = log.groupBy(run).agg(F.min(ts).alias("run_first"), F.max(ts).alias("run_last"))
    own_us = F.timestamp_diff("MICROSECOND", F.col("first_ts"), F.col("last_ts"))
    whole_us = F.timestamp_diff("MICROSECOND", F.col("run_first"), F.col("run_last"))
    return (per_thread.join(per_run, run)
            .select(run, thread, "total_ops", F.round(own_us / F.lit(1_000_000.0), 6).alias("duration_s"),
                    ratio_fixed(F.col("total_ops") * 1_000_000, own_us, 4).alias("ops_per_sec"),
                    ratio_fixed(F.col("total_ops") * 1_000_000, whole_us, 4).alias("ops_per_sec_run"),
                    "avg_ms_per_op", *[f"ops_{o}" for o in ops]))


def error_rate(log: DataFrame, group, ok: str, duration: str,
               thresholds: dict | None = None, connect: str | None = None) -> DataFrame:
    """Success and error rate per group with threshold breach flags
    (error rate over the limit, average latency over the query limit and, when
    a ``connect`` time column is given, average connection time over its limit)."""
    t = dict(THRESHOLDS, **(thresholds or {}))
    group = [group] if isinstance(group, str) else list(group)
    aggs = [F.count(F.lit(1)).alias("total"),
            F.sum((~F.col(ok)).cast("long")).alias("errors"),
            avg_fixed(duration).alias("avg_ms"),
            F.round(F.max(duration), 4).alias("max_ms"),
            F.sum((F.col(duration) > t["query_ms"]).cast("long")).alias("slow")]
    if connect:
        aggs.append(avg_fixed(connect).alias("avg_connect_ms"))
    g = log.groupBy(*group).agg(*aggs)
    rate = F.col("errors") / F.nullif(F.col("total"), F.lit(0))
    out = (g.withColumn("success_rate", ratio_fixed(F.col("total") - F.col("errors"), "total", 6))
            .withColumn("error_rate", ratio_fixed("errors", "total", 6))
            .withColumn("error_breach", rate > t["error_rate"])
            .withColumn("latency_breach", F.col("avg_ms") > t["query_ms"]))
    if connect:
        out = out.withColumn("connect_breach", F.col("avg_connect_ms") > t["connect_ms"])
    return out


def compare_runs(runs: DataFrame, base: str, other: str, ignore_missing: bool = False) -> DataFrame:
    """Per measure the % gain of ``other`` over ``base``: for throughput
    ``(b-a)/a``, for time ``(a-b)/a``; the overall gain is the mean over the
    insert/update/select measures, a missing one counted as 0 unless
    ``ignore_missing``.  ``runs``: ``run_id, measure, kind ('throughput'|'time'), value``."""
    p = runs.groupBy("measure", "kind").agg(
        F.max(F.when(F.col("run_id") == base, F.col("value"))).alias("base_value"),
        F.max(F.when(F.col("run_id") == other, F.col("value"))).alias("other_value"))
    a, b = F.col("base_value"), F.col("other_value")
    gain = F.when(F.col("kind") == "throughput", (b - a) / F.nullif(a, F.lit(0)) * 100) \
            .otherwise((a - b) / F.nullif(a, F.lit(0)) * 100)
    per = p.withColumn("gain_pct", F.round(gain, 2))
    core = ["insert", "update", "select"]
    g = F.col("gain_pct")
    if ignore_missing:
        overall = F.avg(F.when(F.col("measure").isin(core), g))
    else:
        overall = F.sum(F.when(F.col("measure").isin(core), F.coalesce(g, F.lit(0.0)))) / F.lit(len(core))
    tot = per.agg(F.round(overall, 2).alias("gain_pct")).select(
        F.lit("overall").alias("measure"), F.lit("mixed").alias("kind"),
        F.lit(None).cast("double").alias("base_value"), F.lit(None).cast("double").alias("other_value"),
        "gain_pct")
    out = per.unionByName(tot)
    return out.withColumn("verdict", F.when(F.col("gain_pct") > 0, F.lit("IMPROVED"))
                                      .when(F.col("gain_pct") < 0, F.lit("DEGRADED"))
                                      .otherwise(F.lit("UNCHANGED")))


def write_runs(df: DataFrame, path: str, mode: str = "append") -> None:
    """IO5: run result documents as JSON lines (one document per run)."""
    df.write.mode(mode).json(path)


RUN_SCHEMA = ("container string, timestamp string, tests struct<select: struct<tests: array<struct<"
              "test_name: string, duration_ms: double, rows_returned: bigint, success: boolean>>>>")


def read_runs(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """IO5: read run documents back and flatten ``tests.select.tests[]`` to
    one row per test.  The schema is stated, so the files are read once."""
    docs = spark.read.schema(RUN_SCHEMA).option("multiLine", multi_line).json(path)
    t = docs.select("container", "timestamp",
                    F.explode_outer("tests.select.tests").alias("t"))
    return t.select("container", "timestamp", F.col("t.test_name").alias("test_name"),
                    F.col("t.duration_ms").cast("double").alias("duration_ms"),
                    F.col("t.rows_returned").cast("long").alias("rows_returned"),
                    F.col("t.success").cast("boolean").alias("success"))


def read_status_pairs(spark: SparkSession, path: str, section: str = "status",
                      multi_line: bool = False) -> DataFrame:
    """IO5: the ``metrics.initial`` / ``metrics.final`` snapshots of run
    documents as long rows ``container, timestamp, snapshot, variable_name,
    variable_value`` (input for counter deltas and configuration diffs)."""
    docs = spark.read.option("multiLine", multi_line).json(path)
    snaps = F.array(*[F.struct(F.lit(s).alias("snapshot"),
                               F.from_json(F.to_json(F.col(f"metrics.{s}.{section}")),
                                           "map<string,string>").alias("kv"))
                      for s in ("initial", "final")])
    e = docs.select("container", "timestamp", F.explode(snaps).alias("s"))
    return e.select("container", "timestamp", F.col("s.snapshot").alias("snapshot"),
                    F.explode_outer(F.col("s.kv")).alias("variable_name", "variable_value")) \
            .where(F.col("variable_name").isNotNull())
