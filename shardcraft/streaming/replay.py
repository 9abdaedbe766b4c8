"""A finished log as a stream, to its end.

Event-time operators in append mode give a window, or an unmatched row of an outer join,
only when the watermark has passed it.  A log that has ended never moves
the watermark past its own last rows, so :func:`as_stream` closes it with a sentinel row far
behind the last event, which no window of the log holds and which is itself never passed.

A join of logs keeps the rows of a micro-batch as state until the watermark of the next one, so
:func:`as_streams` gives logs that are joined in micro-batches of bounded size, in the order of time.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CLOSING = "36500 days"       # from the last event to the sentinel
FILE_ROWS = 100_000          # rows of all joined logs in a file; a micro-batch has a file for each core


def as_stream(df: DataFrame, ts: str, path: str, max_files_per_trigger: int | None = None,
              values: dict | None = None) -> DataFrame:
    """``df`` written under ``path`` and read as a stream, closed by a sentinel: a row an
    age after the last event, NULL in all other columns but those in ``values``, which take
    it through the filters before the watermark."""
    values = values or {}
    spark = df.sparkSession
    df.write.parquet(f"{path}/rows")
    written = spark.read.schema(df.schema).parquet(f"{path}/rows")
    _sentinel(written, ts, values).coalesce(1).write.parquet(f"{path}/sentinel")
    r = spark.readStream.schema(df.schema).option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.parquet(path)


def _sentinel(log: DataFrame, ts: str, values: dict) -> DataFrame:
    return log.agg(F.max(ts).alias(ts)).select(*[
        (F.coalesce(F.col(ts), F.lit("1970-01-01").cast(f.dataType)) + F.expr(f"INTERVAL {CLOSING}")).cast(f.dataType).alias(ts)
        if f.name == ts else F.lit(values.get(f.name)).cast(f.dataType).alias(f.name) for f in log.schema])


def as_streams(logs: list[tuple[DataFrame, str, dict]], path: str, file_rows: int | None = None,
               files_per_trigger: int | None = None) -> list[DataFrame]:
    """Each log (its rows, the name of their event time and what its sentinel has in other
    columns) as a stream, closed by a sentinel of its own.

    The logs are merged in the order of time into one table under ``path``, and every stream reads that table's
    files in the same order, as many at once as there are cores: streams stand at the same time whatever
    their densities, no row is late, and what a time-bounded join keeps is the rows of the bound and
    of two micro-batches, not the log.  Rows without an event time come first.  A join drops rows whose
    keys are null before their watermark is taken, so the sentinel of its inner side needs keys that
    match nothing.  A file source takes files by their modification time, so that is set in
    the order of the files; in a store that keeps no such time the log is one micro-batch."""
    spark = logs[0][0].sparkSession
    own = [f"log{i}" for i in range(len(logs))]

    def merged(rows: list[DataFrame]) -> DataFrame:
        return reduce(DataFrame.unionAll, [
            df.select(F.lit(i).alias("log"), F.col(ts).cast("timestamp").alias("at"),
                      *[(F.struct(*df.columns) if k == i else F.lit(None).cast(logs[k][0].schema)).alias(c)
                        for k, c in enumerate(own)])
            for i, (df, (_, ts, _)) in enumerate(zip(rows, logs))])

    whole = merged([df for df, _, _ in logs])
    files = -(-sum(df.count() for df, _, _ in logs) // (file_rows or FILE_ROWS))
    whole.repartitionByRange(max(1, files), "at").write.parquet(f"{path}/rows")
    written = spark.read.schema(whole.schema).parquet(f"{path}/rows")

    def of(df: DataFrame, i: int) -> DataFrame:
        return df.where(F.col("log") == i).select(f"{own[i]}.*")

    merged([_sentinel(of(written, i), ts, values) for i, (_, ts, values) in enumerate(logs)]) \
        .coalesce(1).write.parquet(f"{path}/sentinel")
    ordered = _in_order(spark, f"{path}/rows", f"{path}/sentinel")
    at_once = files_per_trigger or spark.sparkContext.defaultParallelism

    def stream() -> DataFrame:
        r = spark.readStream.schema(whole.schema).option("recursiveFileLookup", "true")
        return (r.option("maxFilesPerTrigger", str(at_once)) if ordered else r).parquet(path)

    return [of(stream(), i) for i in range(len(logs))]


def _in_order(spark: SparkSession, *folders: str) -> bool:
    """Set the modification times of the folders' data files to their order by folder and partition;
    whether the store has kept them."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    of = jvm.org.apache.hadoop.fs.Path
    fs = of(folders[0]).getFileSystem(conf)

    def files():
        return [f for folder in folders for f in sorted(
            (f for f in fs.listStatus(of(folder)) if f.getPath().getName().startswith("part-")),
            key=lambda f: int(re.match(r"part-(\d+)", f.getPath().getName())[1]))]

    found = files()
    first = max((f.getModificationTime() for f in found), default=0)
    for i, f in enumerate(found):
        fs.setTimes(f.getPath(), first + i, -1)
    return [f.getModificationTime() for f in files()] == [first + i for i in range(len(found))]


def run_to_end(stream: DataFrame, out: str, checkpoint: str, partitions: int | None = None) -> DataFrame:
    """Run a stream in append mode until all input is read and the watermark has moved;
    the result is the table it wrote.  ``partitions`` is the number of state partitions
    (that of the session's shuffles if not given, and at most): each writes files of its own with
    every micro-batch, and those of the last two stay."""
    conf = stream.sparkSession.conf
    before = {k: conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.streaming.minBatchesToRetain")}
    most, retained = map(int, before.values())
    for k, v in zip(before, (min(most, partitions or most), min(retained, 2))):
        conf.set(k, str(v))
    try:
        query = (stream.writeStream.outputMode("append").format("parquet").option("path", out)
                 .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    finally:                         # a query has its own copy of the settings
        for k, v in before.items():
            conf.set(k, v)
    query.awaitTermination()
    if query.exception():
        raise query.exception()
    return stream.sparkSession.read.schema(stream.schema).parquet(out)
