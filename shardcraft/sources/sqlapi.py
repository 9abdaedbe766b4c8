"""Parameterised SQL over registered views (IO11).

Read statements only.  Spark's parser reads the statement, and it passes only if
every node of the parsed plan, of its common table expressions and of its subqueries, is on the
list of reading nodes.  Whatever the list doesn't name is rejected: commands, inserts in
any clause order, writes to a directory, EXECUTE IMMEDIATE, scripts, TRANSFORM.  So
are the functions that call any Java method, and names that are only known at
run time.  SHOW and DESCRIBE statements and EXPLAIN report and pass, by the class of
their plan.  Parameters are bound by Spark (``?`` or ``:name`` markers), never
spliced into the text.
"""

from __future__ import annotations

from pyspark.errors import ParseException
from pyspark.sql import DataFrame, SparkSession

#: classes of parsed plans that only read
READING = set("""
Project Filter Join Aggregate Sort GlobalLimit LocalLimit Offset Tail Distinct Union Intersect Except
SubqueryAlias UnresolvedSubqueryColumnAliases UnresolvedRelation UnresolvedWith UnresolvedHaving UnresolvedHint
UnresolvedInlineTable UnresolvedTableValuedFunction UnresolvedTVFAliases ResolvedInlineTable LocalRelation
OneRowRelation Range Generate LateralJoin AsOfJoin Pivot Unpivot Sample Window WithWindowDefinition Expand
UnresolvedOrdinal PipeOperator NameParameterizedQuery PosParameterizedQuery
""".split())
#: classes of plans that report, with what they name
REPORTING = set("""
ShowTables ShowTablesCommand ShowTableExtended ShowNamespaces ShowColumns ShowColumnsCommand ShowFunctions ShowCreateTable
ShowTableProperties ShowPartitions ShowViews ShowCatalogsCommand ShowCurrentNamespaceCommand
DescribeRelation DescribeColumn DescribeFunction DescribeNamespace DescribeTablePartition DescribeQueryCommand ExplainCommand
""".split())
NAMES = {"CurrentNamespace", "UnresolvedNamespace", "UnresolvedTableOrView", "UnresolvedTable", "UnresolvedView",
         "UnresolvedFunctionName"}
CALLING_OUT = {"reflect", "java_method", "try_reflect"}


class WriteRejected(ValueError):
    pass


def _each(seq):
    return (seq.apply(i) for i in range(seq.size()))


def _class(node) -> str:
    return node.getClass().getSimpleName().rstrip("$")


def _nodes(plan):
    """The plan's nodes with those of its common table expressions and subqueries."""
    yield plan
    for side in (plan.children(), plan.innerChildren()):
        for child in _each(side):
            yield from _nodes(child)


def _harmless(expression) -> bool:
    kind = _class(expression)
    if kind == "ExpressionWithUnresolvedIdentifier":
        return False
    if kind == "UnresolvedFunction" and expression.nameParts().last().lower() in CALLING_OUT:
        return False
    return all(map(_harmless, _each(expression.children())))


def statement_kind(spark: SparkSession, sql: str) -> str:
    """``"read"`` or ``"write"`` (all that isn't known to read); text that is not one
    statement is a ParseException."""
    plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(sql)
    allowed = REPORTING | NAMES if _class(plan) in REPORTING else READING
    reads = all(_class(n) in allowed and all(map(_harmless, _each(n.expressions()))) for n in _nodes(plan))
    return "read" if reads else "write"


def register_views(spark: SparkSession, tables: dict) -> None:
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def run_query(spark: SparkSession, sql: str, params=()) -> DataFrame:
    """Run one read statement; ``params`` is a list for ``?`` or a dict for ``:name``."""
    try:
        kind = statement_kind(spark, sql)
    except ParseException as e:
        raise WriteRejected(f"not a single read statement: {e.getMessage()}") from e
    if kind == "write":
        raise WriteRejected("only single read statements are accepted")
    if not params:
        return spark.sql(sql)
    return spark.sql(sql, args=params if isinstance(params, dict) else list(params))


def register_lab_views(spark: SparkSession, sf_dir: str) -> list[str]:
    """Register the labs' table names over the bound driver tables (and the
    two lab views), so statements written for the labs run unchanged through
    :func:`run_query`.  Returns the registered names."""
    from pyspark.sql import functions as F

    from .. import bindings as B
    from ..operators import joins
    li = B.table(spark, sf_dir, "lineitem")
    tables = {
        "users": B.users(spark, sf_dir),
        "orders": B.shop_orders(spark, sf_dir),
        "products": B.table(spark, sf_dir, "part").select(
            F.col("p_partkey").alias("id"), F.col("p_name").alias("name"),
            F.col("p_type").alias("category"), F.col("p_retailprice").cast("decimal(10,2)").alias("price")),
        "order_items": li.select(
            F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line_no"),
            F.col("l_partkey").alias("product_id"), F.col("l_quantity").cast("int").alias("quantity"),
            (F.col("l_extendedprice") / F.col("l_quantity")).cast("decimal(10,2)").alias("unit_price"),
            F.col("l_extendedprice").cast("decimal(10,2)").alias("total_price")),
        "perf_test_select": B.sales(spark, sf_dir),
        "stress_test_transactions": B.ledger(spark, sf_dir),
        "query_log": B.query_log(spark, sf_dir),
    }
    register_views(spark, tables)
    views = {
        "user_orders": joins.user_orders(tables["users"], tables["orders"]),
        "order_details": joins.order_details(*[tables[n] for n in ("orders", "users", "order_items", "products")]),
    }
    register_views(spark, views)
    return list(tables) + list(views)
