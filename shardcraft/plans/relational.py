"""Filters, top-k and grouped aggregates over the driver tables
(F2-F7, K1-K3, A2-A9)."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import bindings as B
from ..functions import filters
from ..operators import aggregates, topk
from .registry import register
from .sqlfrag import ratio_sql

SALES_CTE = f"WITH sales AS ({B.SALES_SQL})"
AS_OF = B.AS_OF_SQL


def _days_before(days: int) -> str:
    return f"CAST({AS_OF} - INTERVAL {days} DAY AS DATE)"


# ---------------------------------------------------------------- filters

@register("f2_key_range", f"""{SALES_CTE}
SELECT count(*) AS count FROM sales WHERE user_id BETWEEN 100 AND 500""")
def f2_key_range(spark, sf):
    return filters.key_range(B.sales(spark, sf), "user_id", 100, 500).agg(
        F.count(F.lit(1)).alias("count"))


@register("f3_date_band", f"""{SALES_CTE}
SELECT count(*) AS count FROM sales
WHERE order_date BETWEEN {_days_before(180)} AND {_days_before(90)}""")
def f3_date_band(spark, sf):
    return filters.date_band(B.sales(spark, sf), "order_date", B.AS_OF, 180, 90).agg(
        F.count(F.lit(1)).alias("count"))


@register("f4_recent_window", f"""{SALES_CTE}
SELECT order_id, line_no, user_id, product_id, quantity, price, order_date, status
FROM sales WHERE order_date >= {_days_before(30)}""")
def f4_recent_window(spark, sf):
    return filters.recent(B.sales(spark, sf), "order_date", B.AS_OF, "30 days")


@register("f4_recent_events", f"""
SELECT event_id, ts, user_id, event_type FROM events
WHERE ts >= {B.EVENTS_AS_OF_SQL} - INTERVAL 1 HOUR""")
def f4_recent_events(spark, sf):
    e = B.events(spark, sf).select("event_id", "ts", "user_id", "event_type")
    return filters.recent(e, "ts", B.EVENTS_AS_OF, "1 hour")


@register("f5_multi_filter", f"""{SALES_CTE}
SELECT order_id, line_no, user_id, product_id, quantity, price, order_date, status
FROM sales WHERE status IN ('O', 'P') AND price > 100 AND order_date >= {_days_before(30)}""")
def f5_multi_filter(spark, sf):
    return filters.multi_filter(B.sales(spark, sf, 100), "status", ["O", "P"], "price", 100,
                                "order_date", B.AS_OF, "30 days")


@register("f6_like_ci", """
SELECT c_custkey AS id, c_name AS username FROM customer
WHERE c_name ILIKE 'customer#0000001__'""")
def f6_like_ci(spark, sf):
    u = B.users(spark, sf).select("id", "username")
    return filters.like_ci(u, "username", "customer#0000001__")


@register("f7_mod_sample", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderkey % 10 = 0""")
def f7_mod_sample(spark, sf):
    o = B.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return filters.mod_sample(o, "o_orderkey", 10, 0)


# ---------------------------------------------------------------- top-k

_SALES_COLS = "order_id, line_no, user_id, product_id, quantity, price, order_date, status"


@register("k1_top_price", f"""{SALES_CTE}
SELECT order_id, line_no, user_id, product_id, price, status FROM sales
WHERE status = 'O' AND price > 100
ORDER BY price DESC, order_id, line_no, user_id, product_id LIMIT 1000""")
def k1_top_price(spark, sf):
    s = (B.sales(spark, sf, 100).where((F.col("status") == "O") & (F.col("price") > 100))
         .select("order_id", "line_no", "user_id", "product_id", "price", "status"))
    return topk.by(s, ["-price"], 1000, ["order_id", "line_no", "user_id", "product_id"])


@register("k2_top_multi_key", f"""{SALES_CTE}
SELECT {_SALES_COLS} FROM sales
WHERE status IN ('O', 'P') AND price > 100 AND order_date >= {_days_before(365)}
ORDER BY price DESC, order_date DESC, order_id, line_no, user_id, product_id, quantity LIMIT 5000""")
def k2_top_multi_key(spark, sf):
    s = filters.multi_filter(B.sales(spark, sf, 100), "status", ["O", "P"], "price", 100,
                             "order_date", B.AS_OF, "365 days")
    return topk.by(s, ["-price", "-order_date"], 5000,
                   ["order_id", "line_no", "user_id", "product_id", "quantity"])


@register("k3_latest_errors", """
SELECT event_id, ts, user_id, value FROM events WHERE event_type = 'error'
ORDER BY ts DESC, event_id DESC LIMIT 10""")
def k3_latest_errors(spark, sf):
    e = B.events(spark, sf)
    return topk.latest(e, "ts", 10, tie="event_id", where=F.col("event_type") == "error") \
        .select("event_id", "ts", "user_id", "value")


@register("k3_latest_prefix", """
SELECT c_custkey AS id, c_name AS username FROM customer
WHERE c_name ILIKE 'customer#00000002%' ORDER BY c_custkey DESC LIMIT 5""")
def k3_latest_prefix(spark, sf):
    u = B.users(spark, sf).select("id", "username")
    return topk.latest(u, "id", 5, where=F.col("username").ilike("customer#00000002%"))


# ---------------------------------------------------------------- aggregates

@register("a2_top_users", f"""{SALES_CTE}
SELECT user_id, count(*) AS order_count,
       (CAST((sum(CAST(CAST(price AS DECIMAL(18,2)) * 100 AS BIGINT)) * 200 + count(price)) // (2 * count(price)) AS DOUBLE) / 10000.0) AS avg_price,
       CAST(sum(quantity) AS BIGINT) AS total_quantity
FROM sales WHERE order_date >= {_days_before(90)}
GROUP BY user_id HAVING count(*) > 2
ORDER BY avg_price DESC, user_id LIMIT 1000""")
def a2_top_users(spark, sf):
    return aggregates.top_users(B.sales(spark, sf), F.date_sub(F.lit(B.AS_OF), 90), 2, 1000)


@register("a3_status_summary", f"""{SALES_CTE}
SELECT status, count(*) AS count, (CAST((sum(CAST(CAST(price AS DECIMAL(18,2)) * 100 AS BIGINT)) * 200 + count(price)) // (2 * count(price)) AS DOUBLE) / 10000.0) AS avg_price,
       min(price) AS min_price, max(price) AS max_price,
       CAST(sum(quantity) AS BIGINT) AS total_quantity
FROM sales GROUP BY status""")
def a3_status_summary(spark, sf):
    # same result as aggregates.status_summary(B.sales(spark, sf)), with the
    # line items aggregated per order before the join
    price = F.col("l_extendedprice").cast("decimal(12,2)").alias("l_extendedprice")
    return aggregates.status_summary_by_order(
        B.table(spark, sf, "lineitem").select("l_orderkey", price, "l_quantity"), B.table(spark, sf, "orders"),
        "l_orderkey", "o_orderkey", "o_orderstatus", "l_extendedprice", "l_quantity")


@register("a4_status_summary_json", """
SELECT event_type AS status, count(*) AS count,
       (CAST((sum(CAST(CAST(value AS DECIMAL(18,2)) * 100 AS BIGINT)) * 200 + count(value)) // (2 * count(value)) AS DOUBLE) / 10000.0) AS avg_price,
       min(CAST(value AS DECIMAL(12,2))) AS min_price, max(CAST(value AS DECIMAL(12,2))) AS max_price
FROM events WHERE CAST(json_extract(props, '$.k') AS DOUBLE) < 50
GROUP BY event_type""")
def a4_status_summary_json(spark, sf):
    e = B.events(spark, sf).select(F.col("event_type").alias("status"),
                                   F.col("value").cast("decimal(12,2)").alias("price"), "props")
    return aggregates.status_summary(e, qty_col=None,
                                     where=aggregates.json_number("props", "$.k") < 50)


@register("a5_json_avg", """
SELECT user_id, count(*) AS n, (CAST((sum(CAST(CAST(CAST(json_extract(props, '$.k') AS DOUBLE) AS DECIMAL(18,0)) * 1 AS BIGINT)) * 20000 + count(CAST(json_extract(props, '$.k') AS DOUBLE))) // (2 * count(CAST(json_extract(props, '$.k') AS DOUBLE))) AS DOUBLE) / 10000.0) AS avg_value
FROM events GROUP BY user_id""")
def a5_json_avg(spark, sf):
    return aggregates.json_avg(B.events(spark, sf), "user_id", "props", "$.k")


@register("a6_ledger_summary", f"""WITH ledger AS ({B.LEDGER_SQL})
SELECT account_id,
       CAST(sum(CASE WHEN transaction_type = 'CREDIT' THEN amount ELSE 0 END) AS DECIMAL(18,2)) AS total_credits,
       CAST(sum(CASE WHEN transaction_type = 'DEBIT' THEN amount ELSE 0 END) AS DECIMAL(18,2)) AS total_debits,
       count(*) AS transaction_count, max(transaction_date) AS last_transaction
FROM ledger GROUP BY account_id HAVING count(*) > 1
ORDER BY total_credits DESC, account_id LIMIT 50""")
def a6_ledger_summary(spark, sf):
    return aggregates.ledger_summary(B.ledger(spark, sf), 50)


@register("a7_text_profile", """
SELECT lang, count(*) AS count,
       (CAST((sum(CAST(CAST(strlen(text) AS DECIMAL(18,0)) * 1 AS BIGINT)) * 20000 + count(strlen(text))) // (2 * count(strlen(text))) AS DOUBLE) / 10000.0) AS avg_text_length
FROM documents GROUP BY lang HAVING count(*) > 10""")
def a7_text_profile(spark, sf):
    d = B.table(spark, sf, "documents").select("lang", "text")
    return aggregates.text_profile(d, "lang", "text", 10)


@register("a7_text_profile_json", f"""
SELECT event_type, count(*) AS count,
       (CAST((sum(CAST(CAST(strlen(props) AS DECIMAL(18,0)) * 1 AS BIGINT)) * 20000 + count(strlen(props))) // (2 * count(strlen(props))) AS DOUBLE) / 10000.0) AS avg_text_length,
       (CAST((sum(CAST(CAST(CAST(CAST(json_extract(props, '$.k') AS DOUBLE) / 100 AS DECIMAL(10,6)) AS DECIMAL(18,6)) * 1000000 AS BIGINT)) * 2 + count(CAST(CAST(json_extract(props, '$.k') AS DOUBLE) / 100 AS DECIMAL(10,6)))) // (2 * count(CAST(CAST(json_extract(props, '$.k') AS DOUBLE) / 100 AS DECIMAL(10,6)))) AS DOUBLE) / 1000000.0) AS avg_random_val
FROM events WHERE ts >= {B.EVENTS_AS_OF_SQL} - INTERVAL 72 HOUR
GROUP BY event_type HAVING count(*) > 10""")
def a7_text_profile_json(spark, sf):
    e = B.events(spark, sf).select(
        "event_type", "ts", "props",
        F.to_json(F.struct((aggregates.json_number("props", "$.k") / 100).alias("random")))
         .alias("meta"))
    return aggregates.text_profile(e, "event_type", "props", 10, "meta", "$.random",
                                   where=filters.recent_cond("ts", B.EVENTS_AS_OF, "72 hours"))


@register("a8_distribution", f"""WITH q AS ({B.QUERY_LOG_SQL})
SELECT node, count(*) AS rows, {ratio_sql("count(*) * 100", "(SELECT count(*) FROM q)", 4)} AS share_pct
FROM q GROUP BY node""")
def a8_distribution(spark, sf):
    return aggregates.distribution(B.query_log(spark, sf).select("node"), "node")


_STATS_SQL = """
SELECT node, count(v) AS {p}n, (CAST((sum(CAST(CAST(v AS DECIMAL(18,2)) * 100 AS BIGINT)) * 200 + count(v)) // (2 * count(v)) AS DOUBLE) / 10000.0) AS {p}avg, round(min(v), 4) AS {p}min,
       round(max(v), 4) AS {p}max, round(stddev_pop(v), 4) AS {p}stddev
FROM q WHERE op_type = '{t}' GROUP BY node"""


@register("a9_stats_diff", f"""WITH q AS (SELECT node, op_type, duration_ms AS v FROM ({B.QUERY_LOG_SQL})),
a AS ({_STATS_SQL.format(p='a_', t='view')}),
b AS ({_STATS_SQL.format(p='b_', t='click')})
SELECT coalesce(a.node, b.node) AS node,
       coalesce(a_n, 0) AS a_n, coalesce(b_n, 0) AS b_n,
       coalesce(a_avg, 0) AS a_avg, coalesce(b_avg, 0) AS b_avg,
       round(coalesce(a_avg, 0) - coalesce(b_avg, 0), 4) AS diff_avg,
       coalesce(a_min, 0) AS a_min, coalesce(b_min, 0) AS b_min,
       round(coalesce(a_min, 0) - coalesce(b_min, 0), 4) AS diff_min,
       coalesce(a_max, 0) AS a_max, coalesce(b_max, 0) AS b_max,
       round(coalesce(a_max, 0) - coalesce(b_max, 0), 4) AS diff_max,
       coalesce(a_stddev, 0) AS a_stddev, coalesce(b_stddev, 0) AS b_stddev,
       round(coalesce(a_stddev, 0) - coalesce(b_stddev, 0), 4) AS diff_stddev
FROM a FULL JOIN b ON a.node = b.node""")
def a9_stats_diff(spark, sf):
    q = B.query_log(spark, sf).select("node", "op_type", F.col("duration_ms").alias("v"))
    return aggregates.stats_diff(q.where(F.col("op_type") == "view"),
                                 q.where(F.col("op_type") == "click"), "node")


# ---------------------------------------------------------------- more statement shapes of the labs

@register("k3_latest_per_thread", """
SELECT event_id, ts, user_id, event_type FROM events WHERE user_id = 7
ORDER BY ts DESC, event_id DESC LIMIT 10""")
def k3_latest_per_thread(spark, sf):
    """Latest operations of one thread (op log bound to events, thread = user)."""
    e = B.events(spark, sf).select("event_id", "ts", "user_id", "event_type")
    return topk.latest(e, "ts", 10, tie="event_id", where=F.col("user_id") == 7)


@register("f6_like_count", """
SELECT count(*) AS count FROM events WHERE user_id <= 50 AND event_type ILIKE '%ur%'""")
def f6_like_count(spark, sf):
    """Count of operations of threads up to n whose type contains a fragment."""
    e = B.events(spark, sf).select("user_id", "event_type")
    return filters.like_ci(filters.key_range(e, "user_id", 0, 50), "event_type", "%ur%") \
        .agg(F.count(F.lit(1)).alias("count"))


@register("f6_like_one_char_wildcard", """
SELECT doc_id, source FROM documents WHERE source ILIKE 'SRC_'""")
def f6_like_one_char_wildcard(spark, sf):
    """``_`` matches exactly one character: 'src1' matches 'SRC_', 'src10' does not."""
    d = B.table(spark, sf, "documents").select("doc_id", "source")
    return filters.like_ci(d, "source", "SRC_")
