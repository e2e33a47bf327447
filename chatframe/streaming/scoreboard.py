"""Running judge scoreboard over a stream of replies.

``stream_tallies`` keeps, per run and bucket of samples, the reply that counts
of every sample (the last successful one, else the last) and *retractable*
sums: a better reply takes the sample's old scores out again and puts its own
in.  Sums are exact fractions, so retraction leaves no rounding behind.  Samples
are dealt to ``buckets`` by hash, so a run is not one task's.  ``run_boards``
adds the buckets up after every micro-batch: the board of all replies so far.

State ends with its run: a reply without a sample (null ``sample_id``) ends its
run, and so does a timer where no reply came for ``idle_s``.  Then only the
totals stay, and later replies of the run are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from fractions import Fraction

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.types import StructType, TimestampNTZType, TimestampType

from chatframe.operators.judging import score_replies, scoreboard_long
from chatframe.schemas import SCORE_DIMS
from chatframe.session import work_dir
from chatframe.streaming.runner import keep_state_in_rocksdb, run_update

KEPT = ("base_is_a", "reply", "error")
BUCKETS = 16


def best_replies(replies: DataFrame, key: str = "sample_id", run: str = "run_id",
                 at: Column | None = None) -> DataFrame:
    """Per run and sample the reply that counts (``update`` or ``complete``
    output mode).  ``at`` orders replies; by default their arrival."""
    error = F.col("error") if "error" in replies.columns else F.lit(None).cast("string")
    d = replies.select(run, key, "base_is_a", "reply", error.alias("error"),
                       (F.current_timestamp() if at is None else at).alias("_at"))
    ok = score_replies(d.withColumn("_reply_kept", F.col("reply")).withColumn("_error_kept", F.col("error")))
    row = F.struct(F.col("error").isNull().alias("ok"), F.col("_at").alias("at"), "base_is_a",
                   F.col("_reply_kept").alias("reply"), F.col("_error_kept").alias("error"))
    best = ok.groupBy(run, key).agg(F.max(row).alias("b"))
    return best.select(run, key, *[f"b.{c}" for c in KEPT])


def _slots(dims: Sequence[str]) -> list[str]:
    return [f"{v}_{d}" for d in dims for v in ("base", "lora")]


class Tallies(StatefulProcessor):
    """What the replies that count add up to, for one bucket of a run."""

    def __init__(self, slots: Sequence[str], idle_ms: int | None):
        self.slots, self.idle_ms = list(slots), idle_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.best = handle.getMapState("best", "sample string", "ok boolean, at long, scores array<double>")
        self.total = handle.getValueState("total", "sums array<string>, counts array<long>, ok long, failed long, over boolean")

    def _load(self) -> tuple[list[Fraction], list[int], int, int, bool]:
        if not self.total.exists():
            return [Fraction(0)] * len(self.slots), [0] * len(self.slots), 0, 0, False
        sums, counts, ok, failed, over = self.total.get()
        return [Fraction(x) for x in sums], list(counts), ok, failed, over

    def _save(self, sums, counts, ok, failed, over) -> None:
        self.total.update(([str(x) for x in sums], counts, ok, failed, over))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        sums, counts, n_ok, n_failed, over = self._load()
        if over:
            for _ in rows:
                pass
            return
        for b in rows:
            over |= bool(b["ends"].any())
            for sample, ok, at, scores in _newest(b[~b["ends"]]):
                old = self.best.getValue((sample,))
                if old is not None and _rank(ok, at, scores) <= _rank(*old):
                    continue
                for reply, sign in ((old, -1), ((ok, at, scores), 1)):
                    if reply is None:
                        continue
                    n_ok, n_failed = n_ok + sign * bool(reply[0]), n_failed + sign * (not reply[0])
                    for i, x in enumerate(reply[2]):
                        if x is not None:
                            sums[i] += sign * Fraction(x)
                            counts[i] += sign
                self.best.updateValue((sample,), (ok, at, scores))
        if over:
            self.best.clear()
        elif self.idle_ms is not None:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.idle_ms)
        self._save(sums, counts, n_ok, n_failed, over)
        yield self._row(key, sums, counts, n_ok, n_failed, over)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        sums, counts, n_ok, n_failed, over = self._load()
        if over:
            return
        self.best.clear()
        self._save(sums, counts, n_ok, n_failed, True)
        yield self._row(key, sums, counts, n_ok, n_failed, True)

    def _row(self, key, sums, counts, n_ok, n_failed, over) -> pd.DataFrame:
        return pd.DataFrame([[key[0], key[1], *map(float, sums), *counts, n_ok, n_failed, over]],
                            columns=["run", "bucket", *[f"sum_{s}" for s in self.slots], *[f"n_{s}" for s in self.slots],
                                     "n_evaluated", "n_failed", "over"])

    def close(self) -> None:
        pass


def _rank(ok, at, scores) -> tuple:
    """Larger counts: success, then the later one; ties by scores."""
    return bool(ok), at, [(x is not None, x or 0.0) for x in scores]


def _newest(b: pd.DataFrame) -> list[tuple]:
    """(sample, ok, at, scores) of the best reply of every sample of a frame."""
    best: dict = {}
    for sample, ok, at, scores in zip(b["sample"], b["ok"], b["at"], b["scores"], strict=True):
        row = (bool(ok), int(at), [None if x is None or x != x else float(x) for x in scores])
        if sample not in best or _rank(*row) > _rank(*best[sample]):
            best[sample] = row
    return [(sample, *row) for sample, row in best.items()]


def stream_tallies(replies: DataFrame, dims: Sequence[str] = SCORE_DIMS, key: str = "sample_id", run: str = "run_id",
                   at: Column | None = None, buckets: int = BUCKETS, idle_s: float | None = None) -> DataFrame:
    """Streaming (or batch) replies -> <run, bucket, sum_*, n_*, n_evaluated,
    n_failed, over>, in ``update`` mode the newest row of a key counts.  ``at``
    (a long or timestamp) orders the replies of a sample; by default their arrival."""
    keep_state_in_rocksdb(replies.sparkSession)
    slots = _slots(dims)
    error = F.col("error") if "error" in replies.columns else F.lit(None).cast("string")
    d = replies.select(F.col(run).alias("run"), F.col(key).cast("string").alias("sample"), "base_is_a", "reply",
                       error.alias("error"), (F.current_timestamp() if at is None else at).alias("at"))
    moment = F.unix_micros(F.col("at").cast("timestamp")) if isinstance(
        d.schema["at"].dataType, (TimestampType, TimestampNTZType)) else F.col("at").cast("long")
    d = d.withColumn("at", F.coalesce(moment, F.lit(-1 << 62)))
    scored = score_replies(d, dims)
    mine = F.pmod(F.xxhash64("sample"), F.lit(buckets)).cast("int")
    every = F.sequence(F.lit(0), F.lit(buckets - 1))
    rows = scored.select("run", F.explode(F.when(F.col("sample").isNull(), every).otherwise(F.array(mine))).alias("bucket"),
                         "sample", F.col("sample").isNull().alias("ends"), F.col("error").isNull().alias("ok"), "at",
                         F.array(*slots).alias("scores"))
    out = StructType([rows.schema["run"]]).add("bucket", "integer")
    for s in slots:
        out = out.add(f"sum_{s}", "double")
    for s in (*[f"n_{s}" for s in slots], "n_evaluated", "n_failed"):
        out = out.add(s, "long")
    idle_ms = None if idle_s is None else int(idle_s * 1000)
    return rows.groupBy("run", "bucket").transformWithStateInPandas(
        Tallies(slots, idle_ms), out.add("over", "boolean"), "update", "none" if idle_ms is None else "processingTime")


def board(tallies: DataFrame, dims: Sequence[str] = SCORE_DIMS) -> DataFrame:
    """The board of every run from the newest tallies: the columns of
    ``scoreboard_wide`` by ``run``, and whether the run is ``over``."""
    slots = _slots(dims)
    t = tallies.groupBy("run").agg(*[F.sum(c).alias(c) for s in slots for c in (f"sum_{s}", f"n_{s}")],
                                   F.sum("n_evaluated").alias("n_evaluated"), F.sum("n_failed").alias("n_failed"),
                                   F.every("over").alias("over"))
    means = [F.when(F.col(f"n_{s}") > 0, F.col(f"sum_{s}") / F.col(f"n_{s}")).otherwise(F.lit(0.0)).alias(s) for s in slots]
    totals = [(sum((F.col(f"sum_{v}_{d}") for d in dims), F.lit(0.0))
               / (F.lit(float(len(dims))) * F.greatest(F.col(f"n_{v}_{dims[0]}"), F.lit(1)))).alias(f"{v}_total")
              for v in ("base", "lora")]
    return t.select("run", *means, *totals, "n_evaluated", "n_failed", "over")


def run_boards(replies: DataFrame, name: str = "boards", dims: Sequence[str] = SCORE_DIMS, base: str | None = None,
               **options) -> DataFrame:
    """Run the stream over what has arrived: ``epoch`` and ``board`` after each
    micro-batch.  With the ``base`` of an earlier run it goes on from there."""
    spark = replies.sparkSession
    base = base or work_dir(spark, name)
    tallies = stream_tallies(replies, dims, **options)

    def write(table: DataFrame, epoch: int) -> None:
        board(table, dims).write.mode("overwrite").parquet(f"{base}/board/epoch={epoch}")

    run_update(tallies, name, ["run", "bucket"], base, each=write)
    return spark.read.parquet(f"{base}/board")


def board_long(boards: DataFrame, dims: Sequence[str] = SCORE_DIMS) -> DataFrame:
    """One line per run and dimension of the newest board."""
    newest = boards.agg(F.max("epoch").alias("newest"))
    last = boards.join(F.broadcast(newest), F.col("epoch") == F.col("newest"))  # one row
    return scoreboard_long(last, dims, group=["run"])
