"""The streaming jobs over the driver tables (T1-T6), as batches over the whole change log
and query log and, from the same functions, as streams: windowed append output and a
stream-stream outer join with watermarks, run to the end of the log.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import bindings as B
from ..session import scratch_path
from ..streaming import changes as CH
from ..streaming import monitors as MON
from ..streaming import replay
from .registry import register
from .sqlfrag import ratio_sql

# Statement shapes of the driver's log as plain replacements, which DuckDB understands;
# its statements hold quoted text and decimal numbers only
# (pattern, replacement) in order; understood alike by Java and RE2
SHAPE_STEPS = [
    (r"\\.", "_"),                               # an escaped character, so also an escaped quote
    (r"'[^']*'|\"[^\"]*\"", "?"),               # quoted text; a doubled quote leaves two pieces
    (r"\?+", "?"),                               # ... which are one literal
    (r"\b[0-9]+(\.[0-9]+)?\b", "?"),
    (r"\s+", " "),
    (r" ?, ?", ", "),
    (r"\( ?\?", "(?"),
    (r"(?i)\bIN ?\((\?, )*\? ?\)", "IN (?)"),
]

# Slow-statement threshold for the driver's query log, whose durations are
# 0-500 ms (the reference's 2 s limit would select nothing).
SLOW_MS = 200.0


REPLICAS = ["replica1", "replica2"]


def applied(spark, sf):
    """Applied-change log: both replicas apply every change, value/10 and
    value/5 seconds after commit, but replica2 misses the failed statements of
    every fifth user."""
    e = B.events(spark, sf)

    def one(name, per_value):
        return F.struct(F.lit(name).alias("replica"), F.timestamp_add(
            "MICROSECOND", F.floor(F.col("value") * per_value).cast("long"), F.col("ts")).alias("apply_ts"))
    both = e.select(F.col("event_id").alias("pos"),
                    ((F.col("event_type") == "error") & (F.col("user_id") % 5 == 0)).alias("missed"),
                    F.explode(F.array(one("replica1", 100000), one("replica2", 200000))).alias("a"))
    return both.where(~(F.col("missed") & (F.col("a.replica") == "replica2"))) \
               .select("a.replica", "pos", "a.apply_ts")


APPLIED_SQL = """
SELECT 'replica1' AS replica, event_id AS pos, ts + to_microseconds(CAST(floor(value * 100000) AS BIGINT)) AS apply_ts
FROM events
UNION ALL
SELECT 'replica2', event_id, ts + to_microseconds(CAST(floor(value * 200000) AS BIGINT))
FROM events WHERE event_type <> 'error' OR user_id % 5 <> 0"""


def _replica_target(spark, sf):
    return B.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("pk"), F.col("c_name").alias("row"),
        F.lit(-1).cast("long").alias("_pos"), F.lit(False).alias("_deleted"))


_T1_SQL = f"""WITH c AS ({B.CHANGES_SQL}),
t AS (SELECT c_custkey AS pk, c_name AS "row", CAST(-1 AS BIGINT) AS _pos, false AS _deleted FROM customer),
x AS (SELECT c.pk, c.pos, c.op, c."row", t.pk IS NOT NULL AND NOT t._deleted AS texists,
             lag(c.op) OVER (PARTITION BY c.pk ORDER BY c.pos) AS prev_op
      FROM c LEFT JOIN t ON c.pk = t.pk WHERE c.pos > coalesce(t._pos, -4611686018427387904)),
e AS (SELECT * FROM x
      WHERE {{effective}}),
l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY pk ORDER BY pos DESC) AS rn FROM e) WHERE rn = 1),
m AS (SELECT coalesce(t.pk, l.pk) AS pk,
             CASE WHEN l.pk IS NOT NULL THEN (CASE WHEN l.op = 'D' THEN NULL ELSE l."row" END) ELSE t."row" END AS "row",
             CASE WHEN l.pk IS NOT NULL THEN l.pos ELSE t._pos END AS _pos,
             CASE WHEN l.pk IS NOT NULL THEN l.op = 'D' ELSE t._deleted END AS _deleted
      FROM t FULL JOIN l ON t.pk = l.pk)
SELECT pk, "row", _pos FROM m WHERE NOT _deleted"""

_SKIP = ("NOT (op = 'I' AND CASE WHEN prev_op IS NULL THEN coalesce(texists, false) "
         "ELSE prev_op <> 'D' END)")


def _apply(spark, sf, policy):
    t = _replica_target(spark, sf)
    return CH.fold_changes(t, B.changes(spark, sf), "pk", policy).where(~F.col("_deleted")).drop("_deleted")


@register("t1_apply_changes", _T1_SQL.format(effective=_SKIP))
def t1_apply_changes(spark, sf):
    return _apply(spark, sf, "skip")


@register("t1_apply_changes_upsert", _T1_SQL.format(effective="true"))
def t1_apply_changes_upsert(spark, sf):
    return _apply(spark, sf, "upsert")


_LAG_SQL = f"""s AS ({B.CHANGES_SQL}), a AS ({APPLIED_SQL}),
j AS (SELECT s.pos, s.commit_ts, r.replica, a.apply_ts,
             date_diff('microsecond', s.commit_ts, a.apply_ts) / 1000000.0 AS lag
      FROM s CROSS JOIN (VALUES ('replica1'), ('replica2')) r(replica)
      LEFT JOIN a ON s.pos = a.pos AND r.replica = a.replica AND a.apply_ts >= s.commit_ts)"""


T2_SQL = f"""WITH {_LAG_SQL}
SELECT pos, commit_ts, replica, apply_ts, round(lag, 6) AS lag_s, coalesce(lag > 10, true) AS lagging
FROM j"""


@register("t2_replication_lag", T2_SQL)
def t2_replication_lag(spark, sf):
    return MON.replication_lag(B.changes(spark, sf), applied(spark, sf), REPLICAS)


T3_SQL = f"""WITH s AS ({B.CHANGES_SQL}), a AS ({APPLIED_SQL}),
u AS (SELECT commit_ts AS ts, NULL AS replica FROM s UNION ALL SELECT apply_ts, replica FROM a),
g AS (SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS window_start,
             count(*) FILTER (replica IS NULL) AS source_changes,
             count(*) FILTER (replica IS NOT NULL) AS applied_changes,
             count(*) FILTER (replica = 'replica1') AS applied_replica1,
             count(*) FILTER (replica = 'replica2') AS applied_replica2
      FROM u GROUP BY 1)
SELECT window_start, window_start + INTERVAL 5 MINUTE AS window_end, source_changes, applied_changes,
       source_changes = applied_replica1 AND source_changes = applied_replica2 AS in_sync,
       applied_replica1, source_changes = applied_replica1 AS in_sync_replica1,
       applied_replica2, source_changes = applied_replica2 AS in_sync_replica2
FROM g"""


@register("t3_sync_monitor", T3_SQL)
def t3_sync_monitor(spark, sf):
    return MON.sync_monitor(B.changes(spark, sf), applied(spark, sf), "5 minutes", replicas=REPLICAS)


_T4_AGG = """count(*) AS statements, {per_second} AS per_second,
       (CAST((sum(CAST(CAST(duration_ms AS DECIMAL(18,2)) * 100 AS BIGINT)) * 200 + count(duration_ms)) // (2 * count(duration_ms)) AS DOUBLE) / 10000.0) AS avg_ms, round(max(duration_ms), 4) AS max_ms,
       CAST(sum(CASE WHEN ok THEN 0 ELSE 1 END) AS BIGINT) AS errors,
       {error_rate} AS error_rate"""

T4_SQL = f"""WITH q AS ({B.QUERY_LOG_SQL})
SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start,
       time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end, node,
       {_T4_AGG.format(per_second=ratio_sql("count(*)", "3600", 6), error_rate=ratio_sql("sum(CASE WHEN ok THEN 0 ELSE 1 END)", "count(*)", 6))}
FROM q GROUP BY 1, 2, node"""


@register("t4_service_metrics", T4_SQL)
def t4_service_metrics(spark, sf):
    return MON.service_metrics(B.query_log(spark, sf), "1 hour")


@register("t4_service_metrics_sliding", f"""WITH q AS ({B.QUERY_LOG_SQL}),
w AS (SELECT unnest([time_bucket(INTERVAL 30 MINUTE, ts) - INTERVAL 30 MINUTE,
                     time_bucket(INTERVAL 30 MINUTE, ts)]) AS window_start, * FROM q)
SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, node, {_T4_AGG.format(per_second=ratio_sql("count(*)", "3600", 6), error_rate=ratio_sql("sum(CASE WHEN ok THEN 0 ELSE 1 END)", "count(*)", 6))}
FROM w GROUP BY 1, 2, node""")
def t4_service_metrics_sliding(spark, sf):
    return MON.service_metrics(B.query_log(spark, sf), "1 hour", "30 minutes")


# The driver's hourly averages lie around 50 ms, so a limit of 100 ms makes both rules fire.
@register("t5_alerts", f"""WITH m AS ({T4_SQL})
SELECT *, 'error_rate' AS alert FROM m WHERE error_rate > 0.05
UNION ALL SELECT *, 'query_time' FROM m WHERE avg_ms > 100.0""")
def t5_alerts(spark, sf):
    return MON.alerts(MON.service_metrics(B.query_log(spark, sf), "1 hour"), {"query_ms": 100.0})


def _shape_sql() -> str:
    s = "statement"
    for pattern, by in SHAPE_STEPS:
        s = "regexp_replace({}, '{}', '{}', 'g')".format(s, pattern.replace("'", "''"), by)
    return f"trim({s})"


_SHAPE_SQL = _shape_sql()


@register("t6_slow_queries", f"""WITH q AS ({B.QUERY_LOG_SQL})
SELECT {_SHAPE_SQL} AS shape, count(*) AS count, round(max(duration_ms), 4) AS max_ms,
       (CAST((sum(CAST(CAST(duration_ms AS DECIMAL(18,2)) * 100 AS BIGINT)) * 200 + count(duration_ms)) // (2 * count(duration_ms)) AS DOUBLE) / 10000.0) AS avg_ms
FROM q WHERE duration_ms > {SLOW_MS} GROUP BY 1""")
def t6_slow_queries(spark, sf):
    return MON.slow_queries(B.query_log(spark, sf), SLOW_MS)


T6_DAILY_SQL = f"""WITH q AS ({B.QUERY_LOG_SQL})
SELECT time_bucket(INTERVAL 1 DAY, ts) AS window_start, {_SHAPE_SQL} AS shape, count(*) AS count,
       round(max(duration_ms), 4) AS max_ms, (CAST((sum(CAST(CAST(duration_ms AS DECIMAL(18,2)) * 100 AS BIGINT)) * 200 + count(duration_ms)) // (2 * count(duration_ms)) AS DOUBLE) / 10000.0) AS avg_ms
FROM q WHERE duration_ms > {SLOW_MS} GROUP BY 1, 2"""


@register("t6_slow_queries_daily", T6_DAILY_SQL)
def t6_slow_queries_daily(spark, sf):
    return MON.slow_queries(B.query_log(spark, sf), SLOW_MS, window="1 day")


@register("t2_replication_lag_summary", f"""WITH {_LAG_SQL}
SELECT replica, count(*) AS changes, round(arg_max(lag, pos), 6) AS newest_lag_s, round(max(lag), 6) AS max_lag_s,
       CAST(sum(CASE WHEN coalesce(lag > 10, true) THEN 1 ELSE 0 END) AS BIGINT) AS lagging_changes,
       count(*) FILTER (lag IS NULL) AS missing_changes,
       coalesce(arg_max(round(lag, 6), pos) > 10, true) AS behind
FROM j GROUP BY replica""")
def t2_replication_lag_summary(spark, sf):
    return MON.lag_summary(MON.replication_lag(B.changes(spark, sf), applied(spark, sf), REPLICAS))


@register("t1_apply_changes_stream", _T1_SQL.format(effective=_SKIP))
def t1_apply_changes_stream(spark, sf):
    """IO7 + T1 as a stream: the change log written as files, read back with
    ``readStream`` and applied to a replica table until all of it is read."""
    log, target = scratch_path(spark, "changes"), scratch_path(spark, "replica")
    B.changes(spark, sf).write.parquet(log)
    CH.init_target(_replica_target(spark, sf).select("pk", "row"), target, "pk", buckets=8)
    CH.apply_changes(CH.read_changes(spark, log), target, scratch_path(spark, "apply"),
                     "pk", "skip", buckets=8).awaitTermination()
    return CH.read_target(spark, target).select("pk", "row", "_pos")


# ---------------------------------------------------------------- the monitors as streams

def _stream(spark, df, ts, name, **values):
    return replay.as_stream(df, ts, scratch_path(spark, name), values=values)


def _to_end(spark, stream, name, partitions=None):
    return replay.run_to_end(stream, scratch_path(spark, name), scratch_path(spark, f"{name}-checkpoint"), partitions)


@register("t2_replication_lag_stream", T2_SQL)
def t2_replication_lag_stream(spark, sf):
    """Stream-stream left outer join; a change counts as not applied after ten minutes."""
    s, a = replay.as_streams([(B.changes(spark, sf).select("pos", "commit_ts"), "commit_ts", {}),
                              (applied(spark, sf), "apply_ts", {"replica": "", "pos": -1})],
                             scratch_path(spark, "lag-logs"))
    return _to_end(spark, MON.replication_lag(s, a, REPLICAS, bound="10 minutes"), "lag",
                   spark.sparkContext.defaultParallelism)


@register("t3_sync_monitor_stream", T3_SQL)
def t3_sync_monitor_stream(spark, sf):
    """One windowed aggregate over the union of both streams."""
    s = _stream(spark, B.changes(spark, sf).select("pos", "commit_ts"), "commit_ts", "sync-source")
    a = _stream(spark, applied(spark, sf), "apply_ts", "sync-applied")
    return _to_end(spark, MON.sync_monitor(s, a, "5 minutes", replicas=REPLICAS), "sync")


@register("t4_service_metrics_stream", T4_SQL)
def t4_service_metrics_stream(spark, sf):
    log = B.query_log(spark, sf).select("ts", "node", "duration_ms", "ok")
    return _to_end(spark, MON.service_metrics(_stream(spark, log, "ts", "service-log"), "1 hour"), "service")


@register("t6_slow_queries_stream", T6_DAILY_SQL)
def t6_slow_queries_stream(spark, sf):
    log = B.query_log(spark, sf).select("ts", "statement", "duration_ms")
    return _to_end(spark, MON.slow_queries(_stream(spark, log, "ts", "slow-log", duration_ms=SLOW_MS + 1), SLOW_MS, window="1 day"), "slow")
