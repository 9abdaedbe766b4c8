"""Writers and table maintenance (IO3, IO6, IO9, versioned copy-on-write)."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import audit
from ..operators.runs import RUN, in_runs


def append(df: DataFrame, path: str, partition_by=None, fmt: str = "parquet") -> None:
    """IO3: batch append.  The batch size of the reference's multi-row inserts
    is Spark's task size here: every task writes its own files, the job
    commit makes them visible together."""
    w = df.write.mode("append").format(fmt)
    if partition_by:
        w = w.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    w.save(path)


def snapshot_copy(spark: SparkSession, tables: dict, dst: str, keys: dict) -> DataFrame:
    """IO6: full copy of a table set to ``dst/<table>``, then verification of
    the copy against the source: row counts (A1) and content diff (U2).
    Returns one report row per table."""
    reports = []
    for name, df in sorted(tables.items()):
        out = f"{dst.rstrip('/')}/{name}"
        df.write.mode("overwrite").parquet(out)
        copy = spark.read.parquet(out)
        cnt = audit.count_compare({"source": {name: df}, "copy": {name: copy}})
        diff_rows = audit.diff(df, copy, keys[name]).select(F.count(F.lit(1))).scalar()
        reports.append(cnt.withColumn("diff_rows", diff_rows))
    r = reduce(lambda a, b: a.unionByName(b), reports)
    return r.withColumn("verified", F.col("in_sync") & (F.col("diff_rows") == 0))


def z_order(df: DataFrame, cols: list[str], name: str = "__z") -> DataFrame:
    """Adds a space-filling key of several columns: each value's quantile (of 2**8, by a bounded sample,
    so skewed values and any sortable type spread alike), the quantiles' bits interleaved. Rows near
    each other in the key are near in every column. NULLs come first."""
    bits = 9                                       # quantile numbers are 0 to 256
    for i, c in enumerate(cols):
        df = in_runs(df, [], c, 1 << (bits - 1)).withColumnRenamed(RUN, f"{name}{i}")
    k = len(cols)
    if bits * k > 63:
        raise ValueError("at most 7 columns")
    terms = [F.shiftleft(F.shiftright(F.col(f"{name}{i}"), b).bitwiseAND(F.lit(1)).cast("long"), b * k + k - 1 - i)
             for b in range(bits) for i in range(k)]
    return df.withColumn(name, reduce(lambda x, y: x.bitwiseOR(y), terms)).drop(*[f"{name}{i}" for i in range(k)])


def sort_bytes(df: DataFrame):
    """Bytes of all rows in a sort's memory, about: fixed-width slots, variable parts rounded up,
    and the sort's own pointers (counted twice, since they grow by doubling). Nested values
    count by their JSON text, four times."""
    fixed = 8 * len(df.columns) + 8 * -(-len(df.columns) // 64) + 48
    parts = [F.lit(fixed)]
    for f in df.schema:
        col = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            parts.append(F.octet_length(col) + 8)
        elif isinstance(f.dataType, T.DecimalType):
            parts.append(F.lit(16))
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
            parts.append(F.octet_length(F.to_json(F.struct(col))) * 4)
    return F.sum(reduce(lambda a, b: a + b, [F.coalesce(p, F.lit(0)).cast("long") for p in parts]))


def compact(spark: SparkSession, path: str, out: str, target_mb: int = 256,
            cluster_by=None, fmt: str = "parquet", z_order_by: list[str] | None = None,
            sort_mb: int = 1024) -> int:
    """IO9: rewrite many small files as files of about ``target_mb``, range
    clustered and sorted by ``cluster_by`` so min/max statistics skip well.
    ``z_order_by`` clusters by several columns at once (:func:`z_order`): filters on
    any of them skip files, where ``cluster_by`` serves its first column.
    A file is sorted in one task, so rows that take over ``sort_mb`` in memory make a further
    file: rows that compress well would else fill a task's memory before they fill a file.
    Writes to a new path (the old one stays readable until it is swapped).
    Returns the number of output partitions."""
    df = spark.read.format(fmt).load(path)
    total = df.select(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_size").alias("s")) \
              .groupBy("f").agg(F.max("s").alias("s")).agg(F.coalesce(F.sum("s"), F.lit(0))).first()[0]
    n = max(1, math.ceil(total / (target_mb * 1024 * 1024)))
    cols = [cluster_by] if isinstance(cluster_by, str) else list(cluster_by or [])
    if cols and z_order_by:
        raise ValueError("either cluster_by or z_order_by")
    if cols or z_order_by:
        n = max(n, math.ceil((df.agg(sort_bytes(df)).first()[0] or 0) / (sort_mb * 1024 * 1024)))
    if z_order_by:
        tie = F.xxhash64(*[F.col(c) for c in df.columns])
        df = (z_order(df, z_order_by).repartitionByRange(n, "__z", tie)
              .sortWithinPartitions("__z", *z_order_by).drop("__z"))
    elif cols:
        # a deterministic row hash as the last range key lets one hot value of
        # the clustering key span several files, while keys stay globally ordered
        tie = F.xxhash64(*[F.col(c) for c in df.columns])
        df = df.repartitionByRange(n, *cols, tie).sortWithinPartitions(*cols)
    else:
        df = df.repartition(n)
    df.write.mode("overwrite").format(fmt).save(out)
    return n


def write_version(df: DataFrame, base: str, version: int) -> str:
    """Copy-on-write: each new table state goes to ``base/v=<version>``."""
    path = f"{base.rstrip('/')}/v={version:08d}"
    df.write.mode("errorifexists").parquet(path)
    return path
