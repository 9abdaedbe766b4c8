"""Deterministic, distributed row generation.

Rows come from ``spark.range`` (split over tasks by id range) and column
expressions; nothing is built on the driver.  Formulas use exact decimal
literals, as the SQL they mirror does.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The city cycle and the sales status cycle of the benchmark data.
CITIES = ["New York", "Los Angeles", "Chicago", "Houston", "Phoenix"]
SALES_STATUSES = ["pending", "processing", "shipped", "delivered"]


def numbers(spark: SparkSession, n: int, partitions: int | None = None) -> DataFrame:
    """G1: 0 .. n-1 as column ``n``."""
    return spark.range(0, n, 1, partitions).withColumnRenamed("id", "n")


def _cycle(col, values) -> F.Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]),
                        (F.pmod(col, F.lit(len(values))) + 1).cast("int"))


def people(spark: SparkSession, n: int) -> DataFrame:
    """``User_<n>``, ``user_<n>@example.com``, age ``18 + n % 50``, city by ``n % 5``."""
    x = numbers(spark, n)
    s = F.col("n").cast("string")
    return x.select("n", F.concat(F.lit("User_"), s).alias("name"),
                    F.concat(F.lit("user_"), s, F.lit("@example.com")).alias("email"),
                    (F.lit(18) + F.col("n") % 50).cast("int").alias("age"),
                    _cycle(F.col("n"), CITIES).alias("city"))


def accounts(spark: SparkSession, n: int) -> DataFrame:
    """G2 (account table variant): ids 1..n with id-suffixed names."""
    x = spark.range(1, n + 1).withColumnRenamed("id", "i")
    s = F.col("i").cast("string")
    return x.select(F.col("i").alias("id"), F.concat(F.lit("user_"), s).alias("username"),
                    F.concat(F.lit("user_"), s, F.lit("@example.com")).alias("email"),
                    F.concat(F.lit("FirstName_"), s).alias("first_name"),
                    F.concat(F.lit("LastName_"), s).alias("last_name"))


def sales(spark: SparkSession, n: int, as_of: _dt.date, seed: int | None = None) -> DataFrame:
    """Sales fact rows.  Formula variant (``seed=None``), for row i:
    user ``1 + 1000 i``, product ``1 + 10 i``, quantity ``1 + i % 10``, price
    ``10 + 0.1 i``, order date ``as_of - floor(0.365 i)`` days, status by ``i % 4``.
    Seeded variant: random user 1..1000, product 1..100, quantity 1..10,
    price 10..1010 and a JSON ``{"batch","record","random"}`` metadata column."""
    x = numbers(spark, n).withColumnRenamed("n", "i")
    a = F.lit(as_of).cast("date")
    if seed is None:
        return x.select(
            "i",
            (F.lit(1) + F.col("i") * 1000).alias("user_id"),
            (F.lit(1) + F.col("i") * 10).alias("product_id"),
            (F.lit(1) + F.col("i") % 10).cast("int").alias("quantity"),
            F.expr("CAST(10 + i * 0.1 AS DECIMAL(12,2))").alias("price"),
            F.date_sub(a, F.expr("CAST(FLOOR(i * 0.365) AS INT)")).alias("order_date"),
            _cycle(F.col("i"), SALES_STATUSES).alias("status"))
    r = lambda k: F.rand(seed + k)
    return x.select(
        "i",
        (F.floor(r(1) * 1000) + 1).cast("long").alias("user_id"),
        (F.floor(r(2) * 100) + 1).cast("long").alias("product_id"),
        (F.floor(r(3) * 10) + 1).cast("int").alias("quantity"),
        (r(4) * 1000 + 10).cast("decimal(10,2)").alias("price"),
        F.date_sub(a, F.floor(r(5) * 365).cast("int")).alias("order_date"),
        _cycle(F.floor(r(6) * 4), SALES_STATUSES).alias("status"),
        F.to_json(F.struct(F.floor(F.col("i") / 1000).cast("long").alias("batch"),
                           (F.col("i") % 1000).alias("record"),
                           r(7).alias("random"))).alias("metadata"))


def update_rows(spark: SparkSession, n: int) -> DataFrame:
    """Update-table rows: counter ``n``, data ``test_data_<n>_`` + ``x`` * (n % 100)."""
    x = numbers(spark, n)
    return x.select((F.col("n") + 1).alias("id"), F.col("n").cast("int").alias("counter"),
                    F.concat(F.lit("test_data_"), F.col("n").cast("string"), F.lit("_"),
                             F.repeat(F.lit("x"), (F.col("n") % 100).cast("int"))).alias("data"))


def wide(spark: SparkSession, n: int, seed: int, threads: int = 10) -> DataFrame:
    """Wide rows: padded text, JSON with a 10-element array, binary."""
    x = numbers(spark, n)
    rs = lambda k: F.substring(F.sha2(F.concat(F.col("n").cast("string"), F.lit(f"/{seed}/{k}")), 256), 1, 11)
    return x.select(
        F.col("n").alias("id"),
        (F.col("n") % threads + 1).cast("int").alias("thread_id"),
        F.concat(F.repeat(F.lit("Lorem ipsum "), 100), rs(0)).alias("large_text"),
        F.to_json(F.struct((F.col("n") % threads + 1).alias("thread"),
                           F.rand(seed).alias("random"),
                           F.array(*[rs(k) for k in range(1, 11)]).alias("data"))).alias("json_data"),
        F.encode(F.repeat(rs(11), 50), "UTF-8").alias("binary_data"))


def ledger(spark: SparkSession, n: int, seed: int) -> DataFrame:
    """N transfers, each a DEBIT on account a in 1..1000 and a CREDIT on
    a + 1000 of the same amount (10 .. 1010)."""
    x = numbers(spark, n)
    acct = (F.floor(F.rand(seed) * 1000) + 1).cast("int")
    amt = (F.rand(seed + 1) * 1000 + 10).cast("decimal(15,2)")
    t = x.select("n", acct.alias("a"), amt.alias("amount"))
    rows = F.explode(F.array(
        F.struct((F.col("n") * 2 + 1).alias("id"), F.col("a").alias("account_id"),
                 F.lit("DEBIT").alias("transaction_type"), F.col("amount").alias("amount")),
        F.struct((F.col("n") * 2 + 2).alias("id"), (F.col("a") + 1000).alias("account_id"),
                 F.lit("CREDIT").alias("transaction_type"), F.col("amount").alias("amount"))))
    return t.select(rows.alias("r")).select("r.*")
