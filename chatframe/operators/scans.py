"""Ordered scans inside groups, in the order of a range-partitioned table.

A plain ``Window.partitionBy(group)`` puts every row of a group into one task,
so one hot conversation holding a third of the table would run in one task.
Here rows are range-partitioned and sorted by ``(group, order)``, so a group of
any size is spread over neighbouring partitions, and every partition is scanned
once, in bounded batches, with the state of the current group only:

1. the scan writes each row with its place inside the partition, and one *edge*
   record a partition: first and last group and what they add up to there;
2. the driver folds the edges (one small record a partition, never a row of
   data) into what each partition's first group carries over from before it;
3. rows of these first groups get that carry by a join with one row a partition.

The source is read by one scan, nothing depends on dense or even numeric order
keys, and no row is lost: null groups are a group, null order keys come first,
and rows that tie in the order key are ordered by a hash of their content.
Spark samples the rows once more for the bounds of the range partitioning.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chatframe.session import stored

DEFAULT_CHUNK = 4096  # rows that a task works on at a time


# ----------------------------------------------------------------- partitions ---
def _hashable(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _hashable(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(_hashable(f.dataType) for f in kind.fields)
    return not isinstance(kind, (T.MapType, T.VariantType))


def in_order(df: DataFrame, keys: Sequence[Column], content: Sequence[str], partitions: int | None = None) -> DataFrame:
    """``df`` range-partitioned and sorted by ``keys``; ties by the hash of ``content``."""
    by = [*keys, F.xxhash64(*content)] if content else list(keys)
    ranged = df.repartitionByRange(partitions, *by) if partitions else df.repartitionByRange(*by)
    return ranged.sortWithinPartitions(*by)


def content_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if _hashable(f.dataType)]


def chunks(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """Non-empty batches of at most ``rows`` rows."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, min(rows, b.num_rows - at))


class Groups:
    """Running group numbers of consecutive rows, over the batches of a partition."""

    def __init__(self, n_keys: int):
        self.keys = n_keys
        self.number = -1
        self.first: list | None = None
        self.last: list | None = None

    def of(self, columns: Sequence[pa.Array]) -> np.ndarray:
        """Group number of every row, from 0 on; nulls are equal."""
        n = len(columns[0]) if columns else 0
        new = np.zeros(n, bool)
        for i, col in enumerate(columns):
            if self.last is not None:
                col = pa.concat_arrays([self.last[i], col])
            a, b = col.slice(0, len(col) - 1), col.slice(1)
            same = pc.or_(pc.fill_null(pc.equal(a, b), False), pc.and_(pc.is_null(a), pc.is_null(b)))
            new[n - len(same):] |= ~same.to_numpy(zero_copy_only=False)
        if self.last is None:
            self.first = [c.slice(0, 1) for c in columns]
            new[:1] = True
        out = self.number + np.cumsum(new)
        if n:
            self.number = int(out[-1])
            self.last = [c.slice(n - 1, 1) for c in columns]
        return out


def running(values: np.ndarray, group: np.ndarray, before: int, group_before: int) -> np.ndarray:
    """Running sums inside each group, from ``before`` on in ``group_before``."""
    total = np.cumsum(values)
    start = np.searchsorted(group, group)
    base = np.where(start > 0, total[start - 1], 0)
    return total - base + np.where(group == group_before, before, 0)


# ----------------------------------------------------------------------- scan ---
def ordered_scan(df: DataFrame, group: str | Sequence[str], order: str, *, sums: Mapping[str, Column] | None = None,
                 nexts: Sequence[str] = (), descending: bool = False, chunk_size: int = DEFAULT_CHUNK,
                 partitions: int | None = None) -> DataFrame:
    """Add ordered-scan columns to ``df``.

    ``pos`` (0-based rank by ``order`` inside the group), ``cum_<k>`` (inclusive
    running sum, long) for each entry of ``sums`` and ``next_<c>`` for each
    column in ``nexts`` (value on the next row of the group, null on the last).
    With ``descending`` the scan runs from the last row to the first.
    ``partitions`` fixes the number of range partitions.  Runs jobs when called.
    """
    groups, sums = [group] if isinstance(group, str) else list(group), dict(sums or {})
    g, v = [f"g{i}" for i in range(len(groups))], [f"v{i}" for i in range(len(sums))]
    lead = F.struct(*nexts) if nexts else F.lit(None).cast("boolean")
    by = F.col(order).desc() if descending else F.col(order).asc()
    ranged = in_order(df, [*[F.col(c).asc() for c in groups], by], content_columns(df), partitions)
    rows = ranged.select(F.struct(*df.columns).alias("row"), *[F.col(c).alias(a) for c, a in zip(groups, g, strict=True)],
                         *[F.coalesce(c.cast("long"), F.lit(0).cast("long")).alias(a) for a, c in zip(v, sums.values(), strict=True)],
                         lead.alias("here"))
    keys = T.StructType([rows.schema[a] for a in g])
    out = T.StructType([
        T.StructField("edge", T.BooleanType()), T.StructField("part", T.IntegerType()), T.StructField("head", T.BooleanType()),
        T.StructField("tail", T.BooleanType()), T.StructField("row", rows.schema["row"].dataType),
        T.StructField("pos", T.LongType()), *[T.StructField(a, T.LongType()) for a in v],
        T.StructField("next", rows.schema["here"].dataType), T.StructField("here", rows.schema["here"].dataType)])
    out = (out.add("first", keys).add("last", keys).add("one", T.BooleanType())
           .add("totals", T.ArrayType(T.ArrayType(T.LongType()))))
    leads = bool(nexts)

    def scan(batches):
        part, found = TaskContext.get().partitionId(), Groups(len(g))
        acc, first_total, first_here, held = np.zeros(len(v) + 1, np.int64), None, None, None
        at = None  # the current group's number
        schema = None

        def record(n, **cols):
            return pa.RecordBatch.from_arrays([cols.get(f.name, pa.nulls(n, f.type)) for f in schema], schema=schema)

        for b in chunks(batches, chunk_size):
            if schema is None:
                schema = _arrow(out, b.schema)
            n, number = b.num_rows, found.of([b.column(a) for a in g])
            here = b.column("here")
            if first_here is None:
                first_here = here.slice(0, 1)
            values = [np.ones(n, np.int64), *[b.column(a).to_numpy(zero_copy_only=False) for a in v]]
            sums_here = [running(x, number, int(acc[i]), at) for i, x in enumerate(values)]
            if first_total is None and number[-1] > 0:  # the first group ends in this batch
                end = int(np.searchsorted(number, 1)) - 1
                first_total = np.array([s[end] for s in sums_here]) if end >= 0 else acc.copy()
            acc, at = np.array([s[-1] for s in sums_here]), int(number[-1])
            last_one = np.append(number[1:] != number[:-1], True)
            follow = np.where(last_one, -1, np.arange(1, n + 1))
            batch = record(n, edge=pa.array(np.zeros(n, bool)), part=pa.array(np.full(n, part, np.int32)),
                           head=pa.array(number == 0), tail=pa.array(np.zeros(n, bool)), row=b.column("row"),
                           pos=pa.array(sums_here[0] - 1), **{a: pa.array(s) for a, s in zip(v, sums_here[1:], strict=True)},
                           next=here.take(pa.array(follow, mask=follow < 0)))
            if not leads:
                yield batch
                continue
            if held is not None:
                same = number[0] == held[1]
                yield _replaced(held[0], next=here.slice(0, 1) if same else pa.nulls(1, here.type))
            if n > 1:
                yield batch.slice(0, n - 1)
            held = batch.slice(n - 1, 1), at
        if held is not None:
            yield _replaced(held[0], tail=pa.array([True]))
        if at is not None:
            totals = [(acc if first_total is None else first_total).tolist(), acc.tolist()]
            yield record(1, edge=pa.array([True]), part=pa.array([part], pa.int32()), here=first_here,
                         first=pa.StructArray.from_arrays(found.first, fields=list(schema.field("first").type)),
                         last=pa.StructArray.from_arrays(found.last, fields=list(schema.field("last").type)),
                         one=pa.array([at == 0]), totals=pa.array([totals], pa.list_(pa.list_(pa.int64()))))

    table = stored(rows.mapInArrow(scan, out), "scan")
    edges = sorted(table.where("edge").select("part", "first", "last", "one", "totals").collect())  # a row a partition
    carry, follows = _fold(edges)
    result = table.where("NOT edge")
    spark = df.sparkSession
    if leads and follows:  # at most one row a partition has its next row in another one
        onto = spark.createDataFrame(list(follows.items()), "before int, source int")
        heads = table.where("edge").select(F.col("part").alias("of"), F.col("here").alias("onto"))
        ends = result.where("tail").join(F.broadcast(onto), F.col("part") == F.col("before"), "left").join(
            heads, F.col("source") == F.col("of"), "left").withColumn("next", F.coalesce("onto", "next"))
        result = result.where("NOT tail").unionByName(ends.select(result.columns))
    cols = {"pos": F.col("pos"), **{f"cum_{k}": F.col(a) for k, a in zip(sums, v, strict=True)}}
    if carry:  # as many rows as partitions at most
        names = [f"c{i}" for i in range(len(cols))]
        offsets = spark.createDataFrame([(p, *map(int, c)) for p, c in carry.items()],
                                        "of int, " + ", ".join(f"{c} long" for c in names))
        result = result.join(F.broadcast(offsets), F.col("head") & (F.col("part") == F.col("of")), "left")
        cols = {k: c + F.coalesce(F.col(o), F.lit(0)) for (k, c), o in zip(cols.items(), names, strict=True)}
    return (result.select("row", *[c.alias(k) for k, c in cols.items()], "next")
            .select("row.*", *cols, *[F.col(f"next.{c}").alias(f"next_{c}") for c in nexts]))


def _fold(edges: Sequence) -> tuple[dict[int, np.ndarray], dict[int, int]]:
    """What the first group of a partition carries over (rows, then sums), and
    for a partition whose last group goes on the one where it does."""
    carry, follows, before, acc = {}, {}, None, None
    for e in edges:
        goes_on = before is not None and before.last == e.first
        if goes_on:
            carry[e.part], follows[before.part] = acc, e.part
        own = np.array(e.totals[1], np.int64)
        acc = acc + own if goes_on and e.one else own
        before = e
    return carry, follows


def _replaced(batch: pa.RecordBatch, **cols) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([cols.get(f.name, batch.column(i)) for i, f in enumerate(batch.schema)],
                                      schema=batch.schema)


def _arrow(out: T.StructType, given: pa.Schema) -> pa.Schema:
    """Arrow schema of ``out``; columns that come from the input keep their type."""
    simple = {T.BooleanType: pa.bool_(), T.IntegerType: pa.int32(), T.LongType: pa.int64()}
    fields = []
    for f in out.fields:
        if f.name == "row" or f.name == "here":
            kind = given.field(f.name).type
        elif f.name == "next":
            kind = given.field("here").type
        elif f.name in ("first", "last"):
            kind = pa.struct([pa.field(x.name, given.field(x.name).type) for x in f.dataType.fields])
        elif f.name == "totals":
            kind = pa.list_(pa.list_(pa.int64()))
        else:
            kind = simple[type(f.dataType)]
        fields.append(pa.field(f.name, kind))
    return pa.schema(fields)
