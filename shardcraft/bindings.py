"""Bindings of the reference's tables to the driver's parquet tables.

Each binding is given twice: as a DataFrame builder (what the engine runs)
and as a SQL text (what the DuckDB oracle runs).  Both read only the columns
they need, so the parquet scan prunes the rest.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the bindings (they must be identical on the Spark and SQL side).
AS_OF = _dt.date(2001, 8, 1)          # latest order date of the driver data
AS_OF_SQL = "DATE '2001-08-01'"
EVENTS_AS_OF = _dt.datetime(2024, 1, 31, 0, 0, 0)   # just after the last event
EVENTS_AS_OF_SQL = "TIMESTAMP '2024-01-31 00:00:00'"
NODE_COUNT = 3                        # query_log node = user_id % 3


_RELATIONS: dict = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The driver table as a DataFrame.  The relation (file listing and
    footer schema) is resolved once per session and path; the driver tables
    are read-only, so reusing it is safe and saves a listing per query."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    hit = _RELATIONS.get(path)
    if hit is not None and hit[0] is spark and hit[1] is spark._jsparkSession:
        return hit[2]
    df = spark.read.parquet(path)
    _RELATIONS[path] = (spark, spark._jsparkSession, df)
    return df


# --------------------------------------------------------------------------
# sales fact (test_select): lineitem joined to its order
# --------------------------------------------------------------------------

def sales(spark: SparkSession, sf_dir: str, min_price=None) -> DataFrame:
    """``min_price`` adds ``price > min_price`` on the raw column as well, which
    reaches the scan (the decimal cast does not): rounding to cents never lifts
    a price from at most ``min_price`` above it."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice")
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus")
    if min_price is not None:
        li = li.where(F.col("l_extendedprice") > F.lit(float(min_price)))
    return (li.join(o, li.l_orderkey == o.o_orderkey)
            .select(F.col("l_orderkey").alias("order_id"),
                    F.col("l_linenumber").alias("line_no"),
                    F.col("o_custkey").alias("user_id"),
                    F.col("l_partkey").alias("product_id"),
                    F.col("l_quantity").cast("int").alias("quantity"),
                    F.col("l_extendedprice").cast("decimal(12,2)").alias("price"),
                    F.col("o_orderdate").cast("date").alias("order_date"),
                    F.col("o_orderstatus").alias("status")))


SALES_SQL = """
SELECT l_orderkey AS order_id, l_linenumber AS line_no, o_custkey AS user_id,
       l_partkey AS product_id, CAST(l_quantity AS INTEGER) AS quantity,
       CAST(l_extendedprice AS DECIMAL(12,2)) AS price,
       CAST(o_orderdate AS DATE) AS order_date, o_orderstatus AS status
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
"""


# --------------------------------------------------------------------------
# users (customer) and shop orders
# --------------------------------------------------------------------------

def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("username"),
        F.col("c_nationkey").alias("nation_id"), F.col("c_mktsegment").alias("segment"))


USERS_SQL = """
SELECT c_custkey AS id, c_name AS username, c_nationkey AS nation_id, c_mktsegment AS segment
FROM customer
"""


def shop_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("user_id"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("total_amount"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderdate").cast("date").alias("created_at"))


SHOP_ORDERS_SQL = """
SELECT o_orderkey AS id, o_custkey AS user_id,
       CAST(o_totalprice AS DECIMAL(12,2)) AS total_amount,
       o_orderstatus AS status, CAST(o_orderdate AS DATE) AS created_at
FROM orders
"""


# --------------------------------------------------------------------------
# event-derived logs
# --------------------------------------------------------------------------

def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Double-entry ledger: purchases are debits, signups are credits."""
    e = events(spark, sf_dir).where(F.col("event_type").isin("purchase", "signup"))
    return e.select(
        F.col("event_id").alias("id"),
        F.col("user_id").alias("account_id"),
        F.when(F.col("event_type") == "purchase", F.lit("DEBIT")).otherwise(F.lit("CREDIT"))
         .alias("transaction_type"),
        F.col("value").cast("decimal(15,2)").alias("amount"),
        F.col("ts").alias("transaction_date"))


LEDGER_SQL = """
SELECT event_id AS id, user_id AS account_id,
       CASE WHEN event_type = 'purchase' THEN 'DEBIT' ELSE 'CREDIT' END AS transaction_type,
       CAST(value AS DECIMAL(15,2)) AS amount, ts AS transaction_date
FROM events WHERE event_type IN ('purchase', 'signup')
"""


def statement_expr(prefix: str = "") -> F.Column:
    """Deterministic SQL text per event, so that routing and normalisation
    have real statements to work on (same rule as ``STATEMENT_SQL``)."""
    c = lambda n: F.col(prefix + n)
    uid = c("user_id").cast("string")
    k = F.get_json_object(c("props"), "$.k")
    return (F.when(c("event_type") == "view",
                   F.concat(F.lit("SELECT * FROM users WHERE id = "), uid))
             .when(c("event_type") == "click",
                   F.concat(F.lit("SELECT * FROM orders WHERE user_id = "), uid,
                            F.lit(" AND status = 'k"), k, F.lit("'")))
             .when(c("event_type") == "purchase",
                   F.concat(F.lit("INSERT INTO orders (user_id, total_amount) VALUES ("), uid,
                            F.lit(", "), c("value").cast("decimal(12,2)").cast("string"), F.lit(")")))
             .when(c("event_type") == "signup",
                   F.concat(F.lit("INSERT INTO users (id, username) VALUES ("), uid,
                            F.lit(", 'user_"), uid, F.lit("')")))
             .otherwise(F.concat(F.lit("UPDATE users SET status = 'k"), k,
                                 F.lit("' WHERE id = "), uid)))


STATEMENT_SQL = """
CASE event_type
  WHEN 'view' THEN 'SELECT * FROM users WHERE id = ' || CAST(user_id AS VARCHAR)
  WHEN 'click' THEN 'SELECT * FROM orders WHERE user_id = ' || CAST(user_id AS VARCHAR)
       || ' AND status = ''k' || json_extract_string(props, '$.k') || ''''
  WHEN 'purchase' THEN 'INSERT INTO orders (user_id, total_amount) VALUES ('
       || CAST(user_id AS VARCHAR) || ', ' || CAST(CAST(value AS DECIMAL(12,2)) AS VARCHAR) || ')'
  WHEN 'signup' THEN 'INSERT INTO users (id, username) VALUES (' || CAST(user_id AS VARCHAR)
       || ', ''user_' || CAST(user_id AS VARCHAR) || ''')'
  ELSE 'UPDATE users SET status = ''k' || json_extract_string(props, '$.k')
       || ''' WHERE id = ' || CAST(user_id AS VARCHAR)
END
"""


def query_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir)
    return e.select(
        F.col("event_id").alias("log_id"), "ts",
        F.concat(F.lit("node"), F.pmod(F.col("user_id"), F.lit(NODE_COUNT)).cast("string")).alias("node"),
        F.col("event_type").alias("op_type"),
        statement_expr().alias("statement"),
        F.col("value").alias("duration_ms"),
        (F.col("event_type") != "error").alias("ok"))


QUERY_LOG_SQL = f"""
SELECT event_id AS log_id, ts, 'node' || CAST(user_id % {NODE_COUNT} AS VARCHAR) AS node,
       event_type AS op_type, {STATEMENT_SQL} AS statement,
       value AS duration_ms, event_type <> 'error' AS ok
FROM events
"""


def changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row-change log: ordered by event id, keyed by user."""
    e = events(spark, sf_dir)
    return e.select(
        F.col("event_id").alias("pos"), F.col("ts").alias("commit_ts"),
        F.when(F.col("event_type") == "signup", F.lit("I"))
         .when(F.col("event_type") == "error", F.lit("D"))
         .otherwise(F.lit("U")).alias("op"),
        F.lit("users").alias("tbl"),
        F.col("user_id").alias("pk"),
        F.col("props").alias("row"))


CHANGES_SQL = """
SELECT event_id AS pos, ts AS commit_ts,
       CASE WHEN event_type = 'signup' THEN 'I' WHEN event_type = 'error' THEN 'D' ELSE 'U' END AS op,
       'users' AS tbl, user_id AS pk, props AS "row"
FROM events
"""


def replica_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A drifted copy of ``orders``: some keys missing, some prices changed."""
    o = table(spark, sf_dir, "orders")
    return (o.where(F.pmod("o_orderkey", F.lit(97)) != 5)
             .withColumn("o_totalprice",
                         F.when(F.pmod("o_orderkey", F.lit(89)) == 3, F.col("o_totalprice") + 1)
                          .otherwise(F.col("o_totalprice"))))


REPLICA_ORDERS_SQL = """
SELECT * REPLACE (CASE WHEN o_orderkey % 89 = 3 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice)
FROM orders WHERE o_orderkey % 97 <> 5
"""

SOURCE_ORDERS_SQL = """
SELECT * FROM orders
"""


def source_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders")


def heavy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide-text table: documents, grouped by language."""
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"), F.col("lang").alias("group_id"),
        F.col("text").alias("large_text"))


def shard_count_sql() -> str:
    return "(SELECT count(*) FROM customer)"


# Counter names of the buffer-pool hit ratio.
READ_REQUESTS = "Innodb_buffer_pool_read_requests"
DISK_READS = "Innodb_buffer_pool_reads"


def status_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly status snapshots per node: two monotone counters derived from the
    query log (all statements = read requests, failed ones = disk reads).
    The running sum runs over hourly aggregate rows, not over events."""
    from pyspark.sql import Window
    q = query_log(spark, sf_dir)
    h = q.groupBy("node", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("snapshot_ts")).agg(
        F.count(F.lit(1)).alias(READ_REQUESTS),
        F.sum((~F.col("ok")).cast("long")).alias(DISK_READS))
    long = h.select("node", "snapshot_ts", F.explode(F.array(
        F.struct(F.lit(READ_REQUESTS).alias("variable_name"), F.col(READ_REQUESTS).alias("n")),
        F.struct(F.lit(DISK_READS).alias("variable_name"), F.col(DISK_READS).alias("n")))).alias("c"))
    long = long.select("node", "snapshot_ts", "c.variable_name", "c.n")
    w = Window.partitionBy("node", "variable_name").orderBy("snapshot_ts") \
              .rowsBetween(Window.unboundedPreceding, 0)
    return long.select("node", "snapshot_ts", "variable_name", F.sum("n").over(w).alias("value"))


STATUS_SNAPSHOTS_SQL = f"""
SELECT node, snapshot_ts, variable_name,
       CAST(sum(n) OVER (PARTITION BY node, variable_name ORDER BY snapshot_ts
                         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS value
FROM (SELECT node, date_trunc('hour', ts) AS snapshot_ts, '{READ_REQUESTS}' AS variable_name,
             count(*) AS n FROM ({QUERY_LOG_SQL}) GROUP BY 1, 2
      UNION ALL
      SELECT node, date_trunc('hour', ts), '{DISK_READS}',
             sum(CASE WHEN ok THEN 0 ELSE 1 END) FROM ({QUERY_LOG_SQL}) GROUP BY 1, 2)
"""
