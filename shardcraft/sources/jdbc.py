"""Partitioned JDBC source and sink (IO2).

The reference's only connector is a database client per node or shard.  Here
a table is read in ``parts`` parallel range slices of a numeric key, and the
filters and column selection of the plan are pushed into each slice's query.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_jdbc(spark: SparkSession, url: str, table: str, key: str | None = None,
              lo: int | None = None, hi: int | None = None, parts: int = 1,
              properties: dict | None = None, fetch_size: int = 10000) -> DataFrame:
    r = (spark.read.format("jdbc").option("url", url).option("dbtable", table)
         .option("fetchsize", str(fetch_size)))
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    if key is not None and parts > 1:
        r = (r.option("partitionColumn", key).option("lowerBound", str(lo))
              .option("upperBound", str(hi)).option("numPartitions", str(parts)))
    return r.load()


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append",
               batch_size: int = 1000, parts: int | None = None,
               properties: dict | None = None) -> None:
    """Each task writes its rows in multi-row batches of ``batch_size``;
    ``parts`` caps the number of concurrent connections.  The cap is a
    ``repartition`` (one shuffle), not ``coalesce``: coalescing would also run
    the whole upstream computation in only ``parts`` tasks."""
    if parts:
        df = df.repartition(parts)
    w = (df.write.format("jdbc").option("url", url).option("dbtable", table)
         .option("batchsize", str(batch_size)).mode(mode))
    for k, v in (properties or {}).items():
        w = w.option(k, v)
    w.save()
