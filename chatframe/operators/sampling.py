"""Seeded exact-size samples, explicit id selection, keys and numbering
(C1-C3, T13, §1.3)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pyspark.sql.window import Window

from chatframe.session import stored, work_dir

COPY_STEP = 10_000  # copies of a row emitted by one task at a time
PREFIX_DIGITS = 4  # hash prefixes of a sample: 16**4 rows at most in one window


def sample_hash(seed: int, key: Column | str = "sample_id") -> Column:
    """md5 of ``"<seed>:<key>"`` (a null key is empty): depends on (seed, key)
    only, never on partitioning or read order, and is the same in every engine."""
    k = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(k.cast("string"), F.lit(""))))


def sample_k(df: DataFrame, k: int, seed: int = 42, key: str = "sample_id", position: str | None = None) -> DataFrame:
    """Exactly ``min(k, n)`` rows without replacement, reproducible; with
    ``position`` that column holds each row's place in the sample, from 1.

    The keys alone are read to count the rows of each hash prefix (a table of at
    most ``16**PREFIX_DIGITS`` rows, stored).  The rows are read once: those of
    the prefixes up to the one with the ``k``-th row are ranked inside their
    prefix, behind the rows of the prefixes before.  Runs jobs when called.
    """
    prefix = F.substring("h", 1, PREFIX_DIGITS)
    counts = (df.select(sample_hash(seed, key).alias("h")).groupBy(prefix.alias("p")).agg(F.count(F.lit(1)).alias("n")))
    upto = Window.orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    places = stored(counts.withColumn("before", F.coalesce(F.sum("n").over(upto), F.lit(0))).where(F.col("before") < k)
                    .select(F.col("p").alias("of"), "before"), "prefixes")
    last = places.agg(F.max("of")).first()[0] or ""
    rows = df.select(F.struct("*").alias("row"), sample_hash(seed, key).alias("h"), F.col(key).alias("key"))
    inside = Window.partitionBy("p").orderBy("h", "key")
    ranked = rows.withColumn("p", prefix).where(F.col("p") <= last).withColumn("r", F.row_number().over(inside))
    taken = (ranked.join(F.broadcast(places), F.col("p") == F.col("of"))  # of the size stated above
             .withColumn("place", F.col("before") + F.col("r")).where(F.col("place") <= k))
    out = taken.select("row.*", *([F.col("place").alias(position)] if position else []))
    return out


def select_ids(df: DataFrame, ids: DataFrame, key: str = "sample_id", position: str | None = None) -> DataFrame:
    """Rows whose key is in ``ids`` (semi join; AQE broadcasts ``ids``
    only when its measured size is under the broadcast threshold).  With
    ``position``, a column of ``ids``, a known list is replayed: that column is
    added and a key listed twice gives two rows."""
    if position is None:
        return df.join(ids.select(key), key, "left_semi")
    return df.join(ids.select(key, position), key)


def ensure_sample_id(df: DataFrame, cols=("instruction", "input", "output"),
                     key: str = "sample_id") -> DataFrame:
    """§1.3: content key when a source has none:
    ``md5(instruction 0x1f input 0x1f output)``, then ``:<row hash>:<copy>``.

    Exact copies are counted by an aggregate (map-side combined, so a group
    of copies holding a third of the table is not sent to one task) and
    re-emitted with a copy index, in two steps of at most ``COPY_STEP`` so no
    row becomes one huge array; no window, no read-order dependent id.
    """
    if key in df.columns:
        return df
    sep = F.lit("\x1f")
    parts = []
    for i, c in enumerate(cols):
        if i:
            parts.append(sep)
        parts.append(F.coalesce(F.col(c), F.lit("")))
    counted = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))
    full = F.xxhash64(*[F.col(c) for c in df.columns]).cast("string")
    steps = F.sequence(F.lit(0), F.floor((F.col("_copies") - 1) / COPY_STEP).cast("long"))
    inner = F.least(F.lit(COPY_STEP), F.col("_copies") - F.col("_step") * COPY_STEP) - 1
    return (counted.withColumn("_step", F.explode(steps)).repartition("_step", *df.columns)
                   .withColumn("_in", F.explode(F.sequence(F.lit(0).cast("long"), inner)))
                   .withColumn("_copy", F.col("_in") + F.col("_step") * COPY_STEP)
                   .withColumn(key, F.concat_ws(":", F.md5(F.concat(*parts)), full,
                                                F.col("_copy").cast("string")))
                   .drop("_copies", "_step", "_in", "_copy"))


def number_rows(df: DataFrame, order: str, name: str = "rn", start: int = 1) -> DataFrame:
    """``enumerate(..., start)`` over any orderable unique key, without
    the single-task window that an unpartitioned ``row_number`` needs.

    Rows are range-partitioned and sorted, written once with their place in
    the partition, and shifted by the rows of the partitions before (one
    number for each partition, broadcast: a shuffle by the partition's number
    would bring whole partitions together).  Runs one job when it is called.
    """
    spark = df.sparkSession
    path = work_dir(spark, "numbered")
    (df.repartitionByRange(order).sortWithinPartitions(order)
     .withColumn("_id", F.monotonically_increasing_id()).write.parquet(path))
    part = F.shiftright("_id", 33).cast("int")
    d = spark.read.parquet(path).withColumn("_part", part)
    before, shift = start, []
    for p, n in sorted((r["_part"], r["count"]) for r in d.groupBy("_part").count().collect()):
        shift.append((p, before))
        before += n
    offsets = spark.createDataFrame(shift, "_part int, _off long")
    place = F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    return d.join(F.broadcast(offsets), "_part").withColumn(name, place + F.col("_off")).select(*df.columns, name)
