"""Spark-side helpers of the subpackage: shared scratch tables and bit sets
of fixed size."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chatframe.llm.kernels import BitSet
from chatframe.session import small_batches, work_dir  # noqa: F401 - operators import small_batches from here


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a new table under ``spark.checkpoint.dir`` and read it
    back: the lineage ends there and survives lost executors."""
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bit_set(df: DataFrame, hash_col: str | Column, bits: int) -> BitSet:
    """Fold a 64-bit hash column into a ``BitSet``.

    At most ``2**(bits - 6)`` rows of two longs reach the driver, whatever
    the number of rows of ``df``.
    """
    h = F.col(hash_col) if isinstance(hash_col, str) else hash_col
    slot = F.shiftrightunsigned(h, 64 - bits)
    rows = (df.select(F.shiftright(slot, 6).alias("w"), slot.alias("slot"))
            .groupBy("w")
            .agg(F.expr("bit_or(shiftleft(1L, cast(slot & 63L as int)))").alias("b"))
            .toPandas())
    out = BitSet(bits)
    if len(rows):
        out.words[rows["w"].to_numpy(np.int64)] = rows["b"].to_numpy(np.int64).view(np.uint64)
    return out


def past_each_group(batches: Iterator[pa.RecordBatch], make: Callable, ask: Callable, size: int) -> Iterator[pa.RecordBatch]:
    """Stream the rows of a partition sorted by shard, blk and kind: the rows of
    kinds 0 and 1 of a group are made into an object once (``make`` gets them as
    a table), the others come to ``ask(object, rows)``, at most ``size`` at a time."""
    here, parts, held = None, [], None
    for b in batches:
        shard, blk, kind = (b.column(c).to_numpy(zero_copy_only=False) for c in ("shard", "blk", "kind"))
        new = (shard[1:] != shard[:-1]) | (blk[1:] != blk[:-1]) | ((kind[1:] < 2) != (kind[:-1] < 2))
        cut = [0, *(np.flatnonzero(new) + 1).tolist(), b.num_rows]
        for s, e in zip(cut[:-1], cut[1:], strict=True):
            if s == e:
                continue
            if (shard[s], blk[s]) != here:
                here, parts, held = (shard[s], blk[s]), [], None
            if kind[s] < 2:
                parts.append(b.slice(s, e - s))
            elif parts or held is not None:
                if held is None:
                    held, parts = make(pa.Table.from_batches(parts)), []
                for at in range(s, e, size):
                    yield from ask(held, b.slice(at, min(size, e - at)))


def without_ids(df: DataFrame, gone: DataFrame, key: str, bits: int = 23) -> DataFrame:
    """Rows of ``df`` whose ``key`` is not in ``gone`` (null keys stay), with
    the columns of ``df`` whatever their names.

    A bit set of ``gone``, at most ``2**(bits - 6)`` rows of two longs, is
    broadcast; only rows that it can't clear are shuffled for the exact join.
    """
    def slot(c: Column) -> Column:
        return F.shiftrightunsigned(F.xxhash64(c), 64 - bits)

    def bit(c: Column) -> Column:
        return F.call_function("shiftleft", F.lit(1).cast("long"), c.bitwiseAND(63).cast("int"))

    left = gone.select(F.col(key).alias("k"))
    words = (left.select(slot(F.col("k")).alias("s")).select(F.shiftright("s", 6).alias("w"), bit(F.col("s")).alias("one"))
             .groupBy("w").agg(F.bit_or("one").alias("bits")))
    rows = df.select(F.struct("*").alias("row"))
    marked = (rows.select("row", slot(F.col("row")[key]).alias("slot"))
              .join(F.broadcast(words), F.shiftright("slot", 6) == F.col("w"), "left")
              .select("row", F.coalesce(F.col("bits").bitwiseAND(bit(F.col("slot"))) != 0, F.lit(False)).alias("maybe")))
    clear = marked.where(~F.col("maybe")).select("row.*")
    return clear.unionByName(marked.where("maybe").join(left, F.col("row")[key] == F.col("k"), "left_anti").select("row.*"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
