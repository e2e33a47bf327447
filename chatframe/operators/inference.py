"""Applying caller-supplied model, judge and encoder functions to a table
(H1-H5).

The functions themselves are per-row libraries (model runtimes, API
clients); here they run inside Arrow-batched iterators and get whole batches.
A factory builds them once for each Python process (``_made``), which Spark
reuses between tasks.  Everything around them (prompt
rendering, decoding, scoring) stays JVM-side.

Model calls get batches of similar length: rows are held over Arrow batches,
sorted by size and packed so that a call's padded size stays within a token
budget (``pack``); results come out in the rows' order.

Model and judge calls are expensive and not idempotent, so their results
should be materialised (``materialize``, or ``store_run`` by run) before anything
downstream reuses them: a task retry or a recomputed lineage would otherwise
call them again.  ``pending`` gives the rows still to do (anti join against what
is stored), so a rerun calls nothing twice; ``judge_stored`` goes on in rounds,
so a lost task repeats one round at most.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from typing import Protocol

import pandas as pd
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chatframe.session import small_batches, stored

TOKEN_BUDGET = 1 << 16   # padded tokens of a call
WINDOW_ROWS = 4096       # rows that are packed together
WINDOW_BYTES = 8 << 20   # of texts that are encoded together
ROUND_ROWS = 10_000      # judge calls between two writes


class Generator(Protocol):
    """What ``generate`` needs from a model runtime; lists go in and out, so
    the runtime can batch on its own device."""

    def encode(self, texts: list[str]) -> list[Sequence]: ...
    def generate(self, ids: list[Sequence], max_new_tokens: int) -> list[Sequence]: ...
    def decode(self, ids: list[Sequence]) -> list[str]: ...


_MADE: dict = {}


def _made(factory: Callable, token: str):
    """The factory's product, built once in this Python process."""
    if token not in _MADE:
        _MADE[token] = factory()
    return _MADE[token]


def map_batches(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema) -> DataFrame:
    """H1: ``dataset.map(fn, batched=True)``: ``fn`` gets column batches."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield fn(pdf)
    return df.mapInPandas(run, schema)


def _out_schema(df: DataFrame, keep: Sequence[str], extra: Sequence[T.StructField]) -> T.StructType:
    fields = [df.schema[c] for c in keep]
    return T.StructType(fields + list(extra))


def pack(sizes: Sequence[int], budget: int) -> list[list[int]]:
    """Deal items to batches of similar size: ``len(batch) * its largest size``
    stays within ``budget`` (an item above it is alone)."""
    order = sorted(range(len(sizes)), key=lambda i: (-sizes[i], i))
    out, at = [], 0
    while at < len(order):
        n = max(1, budget // max(1, sizes[order[at]]))
        out.append(order[at:at + n])
        at += n
    return out


def _windows(batches: Iterator[pd.DataFrame], rows: int = WINDOW_ROWS) -> Iterator[pd.DataFrame]:
    """Arrow batches joined or cut to frames of ``rows`` rows (the last: fewer)."""
    held, n = [], 0
    for b in batches:
        for at in range(0, len(b), rows):
            part = b.iloc[at:at + rows]
            held.append(part)
            n += len(part)
            if n >= rows:
                joined = pd.concat(held, ignore_index=True)
                yield joined.iloc[:rows].reset_index(drop=True)
                held, n = ([joined.iloc[rows:]], n - rows) if n > rows else ([], 0)
    if n:
        yield pd.concat(held, ignore_index=True)


def _tables(batches: Iterator[pa.RecordBatch], rows: int = WINDOW_ROWS, size: int = WINDOW_BYTES) -> Iterator[pa.Table]:
    """Arrow batches joined until they have ``rows`` rows or ``size`` bytes."""
    held, n, held_bytes = [], 0, 0
    for b in batches:
        held.append(b)
        n, held_bytes = n + b.num_rows, held_bytes + b.nbytes
        if n >= rows or held_bytes >= size:
            yield pa.Table.from_batches(held).combine_chunks()
            held, n, held_bytes = [], 0, 0
    if n:
        yield pa.Table.from_batches(held).combine_chunks()


def generate(df: DataFrame, model_factory: Callable[[], Generator], prompt: str = "prompt",
             out: str = "answer", max_new_tokens: int = 512,
             keep: Sequence[str] = ("sample_id",), token_budget: int = TOKEN_BUDGET) -> DataFrame:
    """H2: prompt -> stripped answer text, only the newly generated part.
    Null prompts get a null answer.  A call's prompts, padded to the longest,
    and the new tokens stay within ``token_budget``."""
    schema = _out_schema(df, keep, [T.StructField(out, T.StringType())])
    cols, token = list(keep), uuid.uuid4().hex

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = _made(model_factory, token)
        for pdf in _windows(batches):
            at = [i for i, p in enumerate(pdf[prompt]) if p is not None]
            ids = [list(x) for x in model.encode([pdf[prompt].iloc[i] for i in at])] if at else []
            answers: list[str | None] = [None] * len(pdf)
            for batch in pack([len(x) + max_new_tokens for x in ids], token_budget):
                full = model.generate([ids[k] for k in batch], max_new_tokens)
                new = [list(f)[len(ids[k]):] for f, k in zip(full, batch, strict=True)]
                for k, text in zip(batch, model.decode(new), strict=True):
                    answers[at[k]] = text.strip()
            yield pdf[cols].assign(**{out: answers})

    return df.select(*cols, prompt).mapInPandas(run, schema)


def generate_variants(df: DataFrame, factories: Mapping[str, Callable[[], Generator]],
                      prompt: str = "prompt", max_new_tokens: int = 512,
                      keep: Sequence[str] = ("sample_id",), token_budget: int = TOKEN_BUDGET) -> DataFrame:
    """H3: every row answered by every variant; long form
    ``<keep..., variant, answer>`` (pivot with ``attach_variants``)."""
    parts = [generate(df, f, prompt, "answer", max_new_tokens, keep, token_budget)
             .select(*keep, F.lit(v).alias("variant"), "answer") for v, f in factories.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def judge(df: DataFrame, client_factory: Callable[[], Callable[..., str]], model: str,
          messages: str = "messages", temperature: float = 0.0, max_tokens: int = 500,
          min_interval_s: float = 1.0, keep: Sequence[str] = ("sample_id",),
          concurrency: int | None = None) -> DataFrame:
    """H4: one judge call per row -> ``<keep..., reply, error>``.

    ``client_factory()`` returns ``call(messages, model=..., temperature=...,
    max_tokens=...) -> str``.  A failing call is captured per row (``error``
    holds the message) and the job goes on.  Calls of one task are spaced at
    least ``min_interval_s`` apart.

    ``concurrency`` bounds the calls at one time: the rows go to as many tasks
    (no more than the cluster has slots), which run as one *barrier* stage.  Such
    a stage has no speculative copies, and if a task is lost all of them stop
    before they start again, so old and new attempts never call side by side.
    Store the result; Spark does not run a part of a barrier stage (``limit``).
    Without ``concurrency`` every partition of ``df`` calls, as slots get free.
    """
    schema = _out_schema(df, keep, [T.StructField("reply", T.StringType()),
                                    T.StructField("error", T.StringType())])
    cols, token = list(keep), uuid.uuid4().hex

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        call = _made(client_factory, token)
        last = None
        for pdf in batches:
            replies, errors = [], []
            for msgs in pdf[messages]:
                if last is not None and min_interval_s > 0:
                    wait = min_interval_s - (time.monotonic() - last)
                    if wait > 0:
                        time.sleep(wait)
                last = time.monotonic()
                try:
                    plain = [{"role": m["role"], "content": m["content"]} for m in msgs]
                    replies.append(call(plain, model=model, temperature=temperature,
                                        max_tokens=max_tokens))
                    errors.append(None)
                except Exception as ex:  # noqa: BLE001 - per-row error capture
                    replies.append(None)
                    errors.append(f"{type(ex).__name__}: {ex}")
            res = pdf[cols].copy()
            res["reply"] = replies
            res["error"] = errors
            yield res

    calls = df.select(*cols, messages)
    if not concurrency:
        return calls.mapInPandas(run, schema)
    tasks = max(1, min(concurrency, df.sparkSession.sparkContext.defaultParallelism))
    return calls.repartition(tasks).mapInPandas(run, schema, barrier=True)


def judge_stored(todo: DataFrame, path: str, client_factory: Callable[[], Callable[..., str]], model: str,
                 key: str = "sample_id", keep: Sequence[str] = ("sample_id",), round_rows: int = ROUND_ROWS,
                 **options) -> DataFrame:
    """H4 with resume: judge what has no successful reply under ``path`` yet, in
    rounds of about ``round_rows`` rows that are stored one by one, and return
    all that is stored.  Repeated keys of ``todo`` count as one."""
    spark = todo.sparkSession
    schema = _out_schema(todo, keep, [T.StructField("reply", T.StringType()), T.StructField("error", T.StringType())])

    def done() -> DataFrame | None:
        try:
            return spark.read.schema(schema).parquet(path)
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    before = done()
    left = todo if before is None else pending(todo, before, key)
    left = stored(left.dropDuplicates([key]), "to-judge")
    rounds = -(-left.count() // round_rows)
    for r in range(rounds):
        part = left.where(F.pmod(F.xxhash64(key), F.lit(rounds)) == r)
        materialize(judge(part, client_factory, model, keep=keep, **options), path)
    now = done()
    return spark.createDataFrame([], schema) if now is None else now


def encode_tokens(df: DataFrame,
                  encoder_factory: Callable[[], Callable[[list[str]], list[Sequence[Sequence[float]]]]],
                  text: str = "text", keep: Sequence[str] = ("pair_id", "side"),
                  token_budget: int = TOKEN_BUDGET, size: Callable[[str], int] | None = None) -> DataFrame:
    """H5: text -> one row per token ``<keep..., tok_id, vec array<float>>``.

    Texts are packed by ``size`` (default: a token for each word, and for every
    four bytes at least) into calls of at most ``token_budget``, each one once.

    Token rows (not one array per text) keep a long text from becoming one
    huge row; the encoder gets the texts of a batch and must not emit special
    tokens.  Vectors go back to
    the JVM as one flat Arrow buffer per batch (``mapInArrow``), not as
    per-token Python objects.
    """
    import numpy as np

    schema = _out_schema(df, keep, [T.StructField("tok_id", T.LongType()),
                                    T.StructField("vec", T.ArrayType(T.FloatType()))])
    cols, token = list(keep), uuid.uuid4().hex

    size = size or (lambda t: 1 + max(len(t.split()), len(t.encode()) // 4))

    def run(batches):
        enc = _made(encoder_factory, token)
        for rows in _tables(batches):
            texts = rows.column(text).to_pylist()
            at = [i for i, t in enumerate(texts) if t is not None]
            for batch in pack([size(texts[i]) for i in at], token_budget):
                mats = [np.asarray(m, dtype=np.float32) for m in enc([texts[at[k]] for k in batch])]
                some = [(at[k], m.reshape(len(m), -1)) for k, m in zip(batch, mats, strict=True) if m.size]
                if not some:
                    continue
                count = np.array([len(m) for _, m in some])
                idx = pa.array(np.repeat([i for i, _ in some], count))
                mat = np.concatenate([m for _, m in some])
                offsets = pa.array(np.arange(0, mat.size + 1, mat.shape[1], dtype=np.int32))
                vec = pa.ListArray.from_arrays(offsets, pa.array(mat.reshape(-1), pa.float32()))
                arrays = [rows.column(c).combine_chunks().take(idx) for c in cols]
                tok = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                yield pa.RecordBatch.from_arrays([*arrays, pa.array(tok), vec], names=cols + ["tok_id", "vec"])

    small_batches(df.sparkSession)
    return df.select(*cols, text).mapInArrow(run, schema)


def pending(todo: DataFrame, done: DataFrame, key: str = "sample_id") -> DataFrame:
    """Rows of ``todo`` with no successful result in ``done`` (resume)."""
    ok = done.where(F.col("error").isNull()) if "error" in done.columns else done
    return todo.join(ok.select(key), key, "left_anti")


def materialize(df: DataFrame, path: str, mode: str = "append") -> DataFrame:
    """Write model/judge output once and read it back, cutting the lineage so
    nothing upstream is recomputed (or re-called) later."""
    df.write.mode(mode).parquet(path)
    return df.sparkSession.read.parquet(path)


def store_run(df: DataFrame, path: str, run_id: str) -> DataFrame:
    """Write the rows of one run into the table at ``path``, partitioned by
    ``run_id``: a repeated run replaces its own partition and no other (a run
    without rows leaves what is there)."""
    (df.drop("run_id").withColumn("run_id", F.lit(str(run_id))).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("run_id").parquet(path))
    return read_run(df.sparkSession, path, df.drop("run_id").schema, run_id)


def read_run(spark: SparkSession, path: str, schema: T.StructType, run_id: str | None = None) -> DataFrame:
    """The rows of one run, from its partition only, or of all runs."""
    fields = [*schema.fields, T.StructField("run_id", T.StringType())]
    df = spark.read.schema(T.StructType(fields)).parquet(path)
    return df if run_id is None else df.where(F.col("run_id") == str(run_id))
