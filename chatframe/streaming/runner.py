"""Run a streaming query to completion (``availableNow``) into a table in
the shared checkpoint folder and read the result back."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from chatframe.session import work_dir

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
EMPTY_BATCHES = "spark.sql.streaming.noDataMicroBatches.enabled"
PARTITIONS = "spark.sql.shuffle.partitions"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def keep_state_in_rocksdb(spark: SparkSession) -> None:
    """Arbitrary state (lists, maps, timers) needs this store, for all queries
    of the session that start from now on."""
    spark.conf.set(PROVIDER, ROCKSDB)


def run_to_end(writer: DataStreamWriter, spark: SparkSession) -> StreamingQuery:
    """All that has arrived, then stop.  Timers would otherwise ask for one
    batch without data after another and keep the query from ending; they fire
    in the next run's batches.  State has at most two partitions a core: each is
    a store to open and a worker to start in every micro-batch.  (A query that
    goes on keeps the number it began with.)"""
    old = {k: spark.conf.get(k) for k in (EMPTY_BATCHES, PARTITIONS)}
    spark.conf.set(EMPTY_BATCHES, "false")
    spark.conf.set(PARTITIONS, str(min(int(old[PARTITIONS]), 2 * spark.sparkContext.defaultParallelism)))
    try:
        q = writer.trigger(availableNow=True).start()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    q.awaitTermination()
    return q


def run_append(stream: DataFrame, name: str, base: str | None = None) -> DataFrame:
    """Append-mode stream -> parquet file sink (exactly-once via its log).
    With the ``base`` of an earlier run the query goes on where that ended."""
    spark = stream.sparkSession
    base = base or work_dir(spark, name)
    run_to_end(stream.writeStream.format("parquet").outputMode("append")
               .option("path", f"{base}/out").option("checkpointLocation", f"{base}/ckpt"), spark)
    return spark.read.schema(stream.schema).parquet(f"{base}/out")


def run_update(stream: DataFrame, name: str, key: list[str], base: str | None = None,
               each: Callable[[DataFrame, int], None] | None = None) -> DataFrame:
    """Update-mode stream -> a table with the newest row of each ``key``.

    Every epoch writes the table anew: the rows of the epoch before whose key
    did not change, and the changed ones.  A repeated epoch overwrites itself.
    ``each(table, epoch)`` sees the table after every epoch."""
    spark = stream.sparkSession
    base = base or work_dir(spark, name)

    def path(epoch: int) -> str:
        return f"{base}/out/epoch={epoch}"

    def write(batch: DataFrame, epoch: int) -> None:
        new = batch.select(stream.columns)
        if epoch > 0:
            old = spark.read.schema(stream.schema).parquet(path(epoch - 1))
            same = None
            for k in key:
                same = (old[k].eqNullSafe(new[k])) if same is None else same & old[k].eqNullSafe(new[k])
            new = old.join(new, same, "left_anti").unionByName(new)
        new.write.mode("overwrite").parquet(path(epoch))
        if each is not None:
            each(spark.read.schema(stream.schema).parquet(path(epoch)), epoch)

    q = run_to_end(stream.writeStream.outputMode("update").foreachBatch(write)
                   .option("checkpointLocation", f"{base}/ckpt"), spark)
    last = q.lastProgress["batchId"] if q.lastProgress else -1
    newest = spark.read.parquet(f"{base}/out").agg(F.max("epoch")).first()[0] if last >= 0 else None
    if newest is None:
        return spark.createDataFrame([], stream.schema)
    return spark.read.schema(stream.schema).parquet(path(newest))
