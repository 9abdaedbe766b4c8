"""Joins (J1-J3, J5).

No join here carries a broadcast hint for data tables: dimension sizes grow
with the data, so the choice is left to AQE, which switches a join to
broadcast only when the runtime size of a side is under
``spark.sql.adaptive.autoBroadcastJoinThreshold`` and otherwise keeps the
shuffle join (with skewed partitions split).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import topk


def user_orders(users: DataFrame, orders: DataFrame) -> DataFrame:
    """Every user with each of their orders; users without orders kept
    once with NULL order columns."""
    u = users.select(F.col("id").alias("user_id"), "username")
    o = orders.select(F.col("id").alias("order_id"), F.col("user_id").alias("o_user_id"),
                      "total_amount", "status", "created_at")
    cols = ["user_id", "username", "order_id", "total_amount", "status", "created_at"]
    # inner join + users without orders, rather than one left outer join: a user
    # holding a large share of the orders sits on the orders side, which AQE
    # can split only in an inner join (a left join's right side cannot be split)
    matched = u.join(o, u.user_id == o.o_user_id, "inner").select(*cols)
    buyers = o.select("o_user_id").distinct()      # partial aggregate: a hot user shrinks map-side
    lonely = u.join(buyers, u.user_id == buyers.o_user_id, "left_anti").select(
        "user_id", "username", *[F.lit(None).cast(o.schema[c].dataType).alias(c)
                                 for c in ("order_id", "total_amount", "status", "created_at")])
    return matched.unionByName(lonely)


def order_details(orders: DataFrame, users: DataFrame, items: DataFrame,
                  products: DataFrame) -> DataFrame:
    """Orders joined to their user, items and products (inner joins).
    ``unit_price`` is the item's own where items have one, else the product's.
    The two large inputs (items, orders) are joined first on the order key."""
    oi = items.select(
        F.col("order_id").alias("i_order_id"), F.col("product_id").alias("i_product_id"),
        "quantity", "total_price", *[c for c in ("unit_price",) if c in items.columns])
    o = orders.select(F.col("id").alias("order_id"), F.col("user_id").alias("o_user_id"),
                      F.col("total_amount").alias("order_total"), "status", "created_at")
    u = users.select(F.col("id").alias("u_id"), "username")
    p = products.select(F.col("id").alias("p_id"), F.col("name").alias("product_name"),
                        *([] if "unit_price" in items.columns else [F.col("price").alias("unit_price")]))
    j = (oi.join(o, oi.i_order_id == o.order_id)
           .join(u, F.col("o_user_id") == F.col("u_id"))
           .join(p, F.col("i_product_id") == F.col("p_id")))
    return j.select("order_id", "username", "product_name", "quantity", "unit_price",
                    "total_price", "order_total", "status", "created_at")


def customer_spend(users: DataFrame, orders: DataFrame, min_total, n: int = 100,
                   user_filter: Column | None = None) -> DataFrame:
    """Per (selected) user: order count and total spent over a left join,
    ``HAVING total_spent > min_total``, top ``n`` by total spent.  Orders are
    aggregated per user before the join, so the join sees one row per user."""
    u = users if user_filter is None else users.where(user_filter)
    per_user = orders.groupBy(F.col("user_id").alias("o_user_id")).agg(
        F.count("id").alias("order_count"), F.sum("total_amount").alias("spent"))
    j = (u.select("id", "username")
          .join(per_user, F.col("id") == F.col("o_user_id"), "left")
          .select(F.col("id").alias("user_id"), "username",
                  F.coalesce(F.col("order_count"), F.lit(0)).alias("order_count"),
                  F.coalesce(F.col("spent"), F.lit(0)).cast("decimal(18,2)").alias("total_spent"))
          .where(F.col("total_spent") > F.lit(min_total)))
    return topk.by(j, ["-total_spent"], n, ["user_id"])


def orphans(child: DataFrame, parent: DataFrame, fk, pk) -> DataFrame:
    """Child rows whose (non-NULL) foreign key has no parent row."""
    fk = [fk] if isinstance(fk, str) else list(fk)
    pk = [pk] if isinstance(pk, str) else list(pk)
    p = parent.select(*[F.col(a).alias(f"__pk{i}") for i, a in enumerate(pk)])
    cond = None
    for i, a in enumerate(fk):
        c = child[a] == p[f"__pk{i}"]
        cond = c if cond is None else cond & c
    nonnull = None
    for a in fk:
        c = F.col(a).isNotNull()
        nonnull = c if nonnull is None else nonnull & c
    return child.where(nonnull).join(p, cond, "left_anti")
