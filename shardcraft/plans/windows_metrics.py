"""Windows, text relevance and operation metrics over the driver tables
(W1-W4, A13, A14, A16)."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import bindings as B
from ..functions import text
from ..operators import metrics, windows
from .registry import register
from .sqlfrag import avg_sql, ratio_sql

@register("w1_ledger_balance", f"""WITH ledger AS ({B.LEDGER_SQL})
SELECT id, account_id, transaction_type, amount, transaction_date,
       CAST(-sum(CASE WHEN transaction_type = 'DEBIT' THEN amount ELSE 0 END)
            OVER (PARTITION BY account_id ORDER BY id
                  ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DECIMAL(18,2)) AS balance
FROM ledger""")
def w1_ledger_balance(spark, sf):
    return windows.ledger_balance(B.ledger(spark, sf))


@register("w2_latest_per_key", f"""WITH c AS ({B.CHANGES_SQL})
SELECT pk, pos, commit_ts, op, tbl, "row" FROM (
  SELECT *, row_number() OVER (PARTITION BY pk ORDER BY pos DESC) AS rn FROM c) WHERE rn = 1""")
def w2_latest_per_key(spark, sf):
    return windows.latest_per_key(B.changes(spark, sf), "pk", "pos")


@register("w3_last_n", f"""WITH q AS ({B.QUERY_LOG_SQL}),
r AS (SELECT node, ts, log_id, duration_ms,
             row_number() OVER (PARTITION BY node ORDER BY ts DESC, log_id DESC) AS recency FROM q),
k AS (SELECT * FROM r WHERE recency <= 24)
SELECT node, ts, log_id, duration_ms, recency,
       round(avg(duration_ms) OVER (PARTITION BY node ORDER BY recency DESC
                                    ROWS BETWEEN 4 PRECEDING AND CURRENT ROW), 4) AS moving_avg
FROM k QUALIFY recency <= 20""")
def w3_last_n(spark, sf):
    q = B.query_log(spark, sf).select("node", "ts", "log_id", "duration_ms")
    return windows.last_n(q, "node", "ts", 20, "duration_ms", avg_over=5, tie="log_id")


@register("w4_counter_deltas", f"""WITH s AS ({B.STATUS_SNAPSHOTS_SQL})
SELECT node, snapshot_ts, variable_name, value,
       CASE WHEN lag(value) OVER w IS NULL THEN NULL
            WHEN value < lag(value) OVER w THEN value
            ELSE value - lag(value) OVER w END AS delta
FROM s WINDOW w AS (PARTITION BY node, variable_name ORDER BY snapshot_ts)""")
def w4_counter_deltas(spark, sf):
    return windows.counter_deltas(B.status_snapshots(spark, sf))


@register("w4_hit_ratio", f"""WITH s AS ({B.STATUS_SNAPSHOTS_SQL}),
d AS (SELECT node, snapshot_ts, variable_name,
             value - lag(value) OVER (PARTITION BY node, variable_name ORDER BY snapshot_ts) AS delta
      FROM s),
p AS (SELECT node, snapshot_ts,
             max(CASE WHEN variable_name = '{B.DISK_READS}' THEN delta END) AS "{B.DISK_READS}",
             max(CASE WHEN variable_name = '{B.READ_REQUESTS}' THEN delta END) AS "{B.READ_REQUESTS}"
      FROM d GROUP BY node, snapshot_ts)
SELECT *, {ratio_sql(f'"{B.READ_REQUESTS}" - "{B.DISK_READS}"', f'"{B.READ_REQUESTS}"', 6)} AS hit_ratio
FROM p""")
def w4_hit_ratio(spark, sf):
    d = windows.counter_deltas(B.status_snapshots(spark, sf))
    return windows.hit_ratio(d, B.DISK_READS, B.READ_REQUESTS)


# ---------------------------------------------------------------- text relevance

QUERY = "tion ble que des"


def _relevance_sql() -> str:
    terms = text.query_terms(QUERY)
    tf = ", ".join(f"len(list_filter(toks, lambda x: x = '{t}')) AS tf{i}" for i, t in enumerate(terms))
    dfs = ", ".join(f"sum(CASE WHEN tf{i} > 0 THEN 1 ELSE 0 END) AS df{i}" for i in range(len(terms)))
    idf = [f"(CASE WHEN df{i} > 0 THEN log10(n / df{i}) ELSE 0.0 END)" for i in range(len(terms))]
    score = " + ".join(f"tf{i} * ({idf[i]} * {idf[i]})" for i in range(len(terms)))
    return f"""d AS (SELECT doc_id, lang,
                    regexp_extract_all(lower(text), '{text.TOKEN_PATTERN}') AS toks FROM documents),
tf AS (SELECT doc_id, lang, {tf} FROM d),
st AS (SELECT count(*) AS n, {dfs} FROM tf),
sc AS (SELECT doc_id, lang, round({score}, 6) AS score FROM tf, st)"""


@register("a13_relevance", f"""WITH {_relevance_sql()}
SELECT doc_id, score FROM sc""")
def a13_relevance(spark, sf):
    d = B.table(spark, sf, "documents").select("doc_id", "text")
    return text.relevance(d, "doc_id", "text", QUERY)


@register("a13_relevance_by_group", f"""WITH {_relevance_sql()}
SELECT lang, count(*) AS record_count, {avg_sql("score", 6, 4)} AS avg_relevance
FROM sc GROUP BY lang ORDER BY avg_relevance DESC, lang LIMIT 100""")
def a13_relevance_by_group(spark, sf):
    d = B.table(spark, sf, "documents").select("doc_id", "lang", "text")
    return text.relevance_by_group(d, "doc_id", "lang", "text", QUERY)


# ---------------------------------------------------------------- operation metrics

EVENT_TYPES = ["signup", "view", "error", "click", "purchase"]


@register("a14_throughput", f"""WITH e AS (SELECT CAST(ts AS DATE) AS run_day, user_id, ts, event_type, value FROM events),
t AS (SELECT run_day, user_id, count(*) AS total_ops, min(ts) AS first_ts, max(ts) AS last_ts,
             (CAST((sum(CAST(CAST(value AS DECIMAL(18,2)) * 100 AS BIGINT)) * 200 + count(value)) // (2 * count(value)) AS DOUBLE) / 10000.0) AS avg_ms_per_op,
             {", ".join(f"CAST(sum(CASE WHEN event_type = '{o}' THEN 1 ELSE 0 END) AS BIGINT) AS ops_{o}" for o in EVENT_TYPES)}
      FROM e GROUP BY run_day, user_id),
r AS (SELECT run_day, min(ts) AS run_first, max(ts) AS run_last FROM e GROUP BY run_day)
SELECT t.run_day, user_id, total_ops,
       round(date_diff('microsecond', first_ts, last_ts) / 1000000.0, 6) AS duration_s,
       {ratio_sql("total_ops * 1000000", "date_diff('microsecond', first_ts, last_ts)", 4)} AS ops_per_sec,
       {ratio_sql("total_ops * 1000000", "date_diff('microsecond', run_first, run_last)", 4)} AS ops_per_sec_run,
       avg_ms_per_op, {", ".join(f"ops_{o}" for o in EVENT_TYPES)}
FROM t JOIN r ON t.run_day = r.run_day""")
def a14_throughput(spark, sf):
    e = B.events(spark, sf).select(F.to_date("ts").alias("run_day"), "user_id", "ts",
                                   "event_type", "value")
    return metrics.throughput(e, "run_day", "user_id", "ts", "event_type", "value", EVENT_TYPES)


@register("a16_error_rate", f"""WITH q AS ({B.QUERY_LOG_SQL}),
g AS (SELECT node, count(*) AS total, CAST(sum(CASE WHEN ok THEN 0 ELSE 1 END) AS BIGINT) AS errors,
             (CAST((sum(CAST(CAST(duration_ms AS DECIMAL(18,2)) * 100 AS BIGINT)) * 200 + count(duration_ms)) // (2 * count(duration_ms)) AS DOUBLE) / 10000.0) AS avg_ms, round(max(duration_ms), 4) AS max_ms,
             CAST(sum(CASE WHEN duration_ms > 1000.0 THEN 1 ELSE 0 END) AS BIGINT) AS slow
      FROM q GROUP BY node)
SELECT *, {ratio_sql("total - errors", "total", 6)} AS success_rate, {ratio_sql("errors", "total", 6)} AS error_rate,
       errors / total > 0.05 AS error_breach, avg_ms > 1000.0 AS latency_breach
FROM g""")
def a16_error_rate(spark, sf):
    q = B.query_log(spark, sf)
    return metrics.error_rate(q, "node", "ok", "duration_ms")
