"""Spark session helpers.

The library never creates hidden sessions inside operators; callers pass a
``SparkSession``.  ``get_spark`` is a convenience for tests, the bench and
scripts.  ``work_dir`` returns a unique sub-folder of the shared folder named
by ``spark.checkpoint.dir`` (set by the cluster); only when that setting is
absent *and* the master is local does it create one under the system temp
folder, as tests need.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark import SparkConf
from pyspark.sql import DataFrame, SparkSession

_CKPT_KEY = "spark.checkpoint.dir"


def get_spark(master: str | None = None, app: str = "chatframe",
              shuffle_partitions: int | None = None) -> SparkSession:
    """A session with the settings the operators expect.  What a submit command
    or an active session already set (master, shuffle partitions, memory) stays."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    given = SparkConf()
    builder = SparkSession.builder.appName(app)
    if master or not given.contains("spark.master"):
        builder = builder.master(master or f"local[{cpus}]")
    wanted = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # long texts: keep Arrow batches small for Python-side model calls
        "spark.sql.execution.arrow.maxRecordsPerBatch": "1024",
        "spark.driver.memory": os.environ.get("CHATFRAME_DRIVER_MEM", "16g"),
    }
    if shuffle_partitions or not given.contains("spark.master"):
        wanted["spark.sql.shuffle.partitions"] = str(shuffle_partitions or cpus)
    for k, v in wanted.items():
        if not given.contains(k) or (k == "spark.sql.shuffle.partitions" and shuffle_partitions):
            builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a local one only for local masters."""
    sc = spark.sparkContext
    current = spark.conf.get(_CKPT_KEY, None) or sc.getCheckpointDir()
    if current:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(current)
        return current.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError(
            f"{_CKPT_KEY} is not set; on a cluster it must name a shared folder")
    local = tempfile.mkdtemp(prefix="chatframe-ckpt-")
    spark.conf.set(_CKPT_KEY, local)
    sc.setCheckpointDir(local)
    return local


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a new table under the shared folder and read it back: the
    lineage ends there and survives lost executors."""
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession, size: int = 8 << 20) -> None:
    """From now on Arrow batches of this session end at ``size`` bytes (a row
    above it is alone), so that long texts don't fill a task's memory.  A
    smaller setting stays."""
    number, unit = re.fullmatch(r"(-?\d+)([kmgt]?)b?", spark.conf.get(ARROW_BYTES).lower()).groups()
    now = int(number) << 10 * " kmgt".index(unit or " ")
    if now < 0 or now > size:
        spark.conf.set(ARROW_BYTES, str(size))
