"""BERTScore P/R/F1 by greedy cosine matching.

P = mean over candidate tokens of the best cosine against the reference
tokens, R = the same from the reference side, F1 = 2PR / (P + R); no idf
weighting, no baseline rescaling.  An empty side, or P + R = 0, scores 0.

Three physical forms with the same results:

* ``bertscore_rows``, row-local: both sides of a pair are arrays in one row.
  Native higher-order functions, no shuffle and no Python.  For texts that fit
  a row.
* ``bertscore``, blocks: tokens are rows.  Each side of a pair is cut into
  blocks of at most ``block`` token ids (``floor(tok_id / block)``), so no counts
  are joined, and every candidate block meets every reference block of the pair
  once.  The cosine matrix of a block pair is one numpy matmul in an
  Arrow-batched ``mapInPandas``, read row- and column-wise by the same call.
* ``bertscore`` with ``tile``, for pairs of any size: a pair is a grid of tiles,
  each a range of candidate blocks times a range of reference blocks.  A block
  is sent to the tiles of its row or column only, so for T tiles it travels
  sqrt(T) times instead of to every opposite block; each tile is a task's group
  that holds its reference blocks and streams the candidate blocks past them.

Per-token maxima are combined by partial aggregation.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chatframe.operators.scans import Groups
from chatframe.session import small_batches, stored

DEFAULT_BLOCK = 512


def _unit(ids, flat) -> tuple[np.ndarray, np.ndarray]:
    ids = np.asarray(ids, dtype=np.int64)
    m = np.asarray(flat, dtype=np.float64).reshape(len(ids), -1)
    norm = np.linalg.norm(m, axis=1, keepdims=True)
    return ids, np.divide(m, norm, out=np.zeros_like(m), where=norm > 0)


def _block_maxima(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per block pair: the best match of every candidate token (row maxima)
    and reference token (column maxima) of one cosine matrix."""
    for pdf in batches:
        out = {k: [] for k in ("tok", "m", "is_c")}
        for ci, cv, ri, rv in zip(pdf["c_tok"], pdf["c_vec"], pdf["r_tok"], pdf["r_vec"], strict=True):
            c_ids, c = _unit(ci, cv)
            r_ids, r = _unit(ri, rv)
            sim = c @ r.T
            out["tok"].append(np.concatenate([c_ids, r_ids]))
            out["m"].append(np.concatenate([sim.max(axis=1), sim.max(axis=0)]))
            out["is_c"].append(np.repeat([True, False], [len(c_ids), len(r_ids)]))
        yield pdf[["pair_id", "variant"]].assign(**out)


def _f1(p: Column, r: Column) -> Column:
    return F.when((p + r) == 0, F.lit(0.0)).otherwise(2 * p * r / (p + r))


def _dot(x: Column, y: Column) -> Column:
    return F.aggregate(F.zip_with(x, y, lambda a, b: a.cast("double") * b), F.lit(0.0), lambda s, v: s + v)


def _mean_of(values: Column) -> Column:
    return F.when(F.size(values) > 0, F.aggregate(values, F.lit(0.0), lambda s, v: s + v) / F.size(values)).otherwise(F.lit(0.0))


def bertscore_rows(pairs: DataFrame, candidates: Sequence[str] = ("base", "lora"), ref: str = "ref",
                   key: str = "pair_id") -> DataFrame:
    """K1 row-local: ``<pair_id, ref, base, lora>`` with one array of vectors a
    side -> ``<pair_id, variant, precision, recall, f1>``.  Null sides are empty,
    vectors of length 0 (norm) match with cosine 0."""
    def unit(side: str) -> Column:
        sizes = F.transform(F.col(side), lambda v: F.sqrt(_dot(v, v)))
        return F.zip_with(F.col(side), sizes, lambda v, n: F.transform(
            v, lambda x: F.when(n > 0, x.cast("double") / n).otherwise(F.lit(0.0))))

    sides = F.explode(F.array(*[F.struct(F.lit(c).alias("variant"), unit(c).alias("c")) for c in candidates]))
    d = pairs.select(key, unit(ref).alias("r"), sides.alias("s")).select(key, "s.variant", "s.c", "r")
    d = d.withColumn("cosine", F.transform("c", lambda x: F.transform("r", lambda y: _dot(x, y))))
    some = (F.size("c") > 0) & (F.size("r") > 0)
    best_r = F.transform(F.sequence(F.lit(0), F.size("r") - 1), lambda j: F.array_max(
        F.transform("cosine", lambda row: F.get(row, j))))
    d = d.select(key, "variant", F.when(some, _mean_of(F.transform("cosine", F.array_max))).otherwise(F.lit(0.0)).alias("precision"),
                 F.when(some, _mean_of(best_r)).otherwise(F.lit(0.0)).alias("recall"))
    return d.select(key, "variant", "precision", "recall", _f1(F.col("precision"), F.col("recall")).alias("f1"))


def tile_grid(blocks: DataFrame, candidates: Sequence[str], ref_side: str) -> DataFrame:
    """The blocks of every tile: ``<pair_id, variant, ct, rt, is_c, tok, vec>``.
    ``blocks``: pair_id, side, tile, tok, vec (a block's vectors, flattened)."""
    cand, ref = blocks.where(F.col("side").isin(*candidates)), blocks.where(F.col("side") == ref_side)
    columns = ref.groupBy(F.col("pair_id").alias("p")).agg(F.collect_set("tile").alias("tiles"))
    rows = cand.groupBy(F.col("pair_id").alias("p"), F.col("side").alias("variant")).agg(F.collect_set("tile").alias("tiles"))
    same = F.col("pair_id") == F.col("p")
    c = cand.join(columns, same).select("pair_id", F.col("side").alias("variant"), F.col("tile").alias("ct"),
                                        F.explode("tiles").alias("rt"), F.lit(True).alias("is_c"), "tok", "vec")
    r = ref.join(rows, same).select("pair_id", "variant", F.explode("tiles").alias("ct"), F.col("tile").alias("rt"),
                                    F.lit(False).alias("is_c"), "tok", "vec")
    return c.unionByName(r)


def _tile_maxima(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per candidate block its row maxima, per reference block its column maxima
    over one tile.  Rows come by tile, reference blocks first."""
    keys = ("pair_id", "variant", "ct", "rt")
    found, at, refs = Groups(len(keys)), None, []

    def out(row: pa.RecordBatch, ids, best, is_c: bool) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [row.column("pair_id"), row.column("variant"), pa.array([ids], pa.list_(pa.int64())),
             pa.array([best], pa.list_(pa.float64())), pa.array([[is_c] * len(ids)], pa.list_(pa.bool_()))],
            ["pair_id", "variant", "tok", "m", "is_c"])

    def done():
        for row, ids, _, best in refs:
            if best is not None:
                yield out(row, ids, best, False)

    for b in batches:
        number = found.of([b.column(k) for k in keys])
        for i in range(b.num_rows):
            if number[i] != at:
                yield from done()
                at, refs = number[i], []
            row = b.slice(i, 1)
            ids, m = _unit(row.column("tok")[0].values.to_numpy(), row.column("vec")[0].values.to_numpy())
            if not row.column("is_c")[0].as_py():
                refs.append([row, ids, m, None])
                continue
            best = np.full(len(ids), -np.inf)
            for ref in refs:
                cosine = m @ ref[2].T
                best = np.maximum(best, cosine.max(axis=1))
                top = cosine.max(axis=0)
                ref[3] = top if ref[3] is None else np.maximum(ref[3], top)
            if refs:
                yield out(row, ids, best, True)
    yield from done()


def bertscore(tokens: DataFrame, candidates: Sequence[str] = ("base", "lora"), ref_side: str = "ref",
              block: int = DEFAULT_BLOCK, pairs: DataFrame | None = None, tile: int | None = None) -> DataFrame:
    """K1 over ``<pair_id, side, tok_id, vec>`` rows, ``pair_id`` of any type.

    Returns ``<pair_id, variant, precision, recall, f1>`` for every pair of
    ``pairs`` (default: those with any token) and every candidate variant; an
    empty side scores 0.  ``tile`` (token ids a side of a tile, a multiple of
    ``block``) turns the tile grid on, which stores the blocks.  ``tokens`` is
    read once for each role: store it if an encoder made it.

    The kernels get Arrow batches of at most 8 MB: a row holds two blocks, and
    a batch of 10,000 of them would fill a task's memory.
    """
    small_batches(tokens.sparkSession)

    def blocks(rows: DataFrame, role: str) -> DataFrame:
        # both lists are filled row by row by one aggregate: their orders agree
        return (rows.select("pair_id", "side", "tok_id", F.col("vec").cast("array<float>").alias("vec"),
                            F.floor(F.col("tok_id") / block).alias("blk"))
                .groupBy("pair_id", "side", "blk")
                .agg(F.collect_list("tok_id").alias(f"{role}_tok"),
                     F.flatten(F.collect_list("vec")).alias(f"{role}_vec")).drop("blk"))

    out = T.StructType([tokens.schema["pair_id"], T.StructField("variant", T.StringType()),
                        T.StructField("tok", T.ArrayType(T.LongType())), T.StructField("m", T.ArrayType(T.DoubleType())),
                        T.StructField("is_c", T.ArrayType(T.BooleanType()))])
    if tile is None:
        cand = blocks(tokens.where(F.col("side").isin(*candidates)), "c").withColumnRenamed("side", "variant")
        ref = blocks(tokens.where(F.col("side") == ref_side), "r").drop("side")
        best = cand.join(ref, "pair_id").mapInPandas(_block_maxima, out)
    else:
        if tile % block:
            raise ValueError("a tile has to hold whole blocks")
        rows = tokens.where(F.col("side").isin(*candidates, ref_side)).select(
            "pair_id", "side", "tok_id", F.col("vec").cast("array<float>").alias("vec"), F.floor(F.col("tok_id") / block).alias("blk"))
        cut = stored(rows.groupBy("pair_id", "side", "blk").agg(
            F.collect_list("tok_id").alias("tok"), F.flatten(F.collect_list("vec")).alias("vec")).select(
            "pair_id", "side", F.floor(F.col("blk") * block / tile).alias("tile"), "tok", "vec"), "blocks")
        key = ["pair_id", "variant", "ct", "rt"]
        best = (tile_grid(cut, candidates, ref_side).repartition(*key).sortWithinPartitions(*key, "is_c")
                .mapInArrow(_tile_maxima, out))
    per_tok = (best.select("pair_id", "variant", F.explode(F.arrays_zip("tok", "m", "is_c")).alias("x"))
               .groupBy("pair_id", "variant", F.col("x.is_c").alias("is_c"), F.col("x.tok").alias("tok"))
               .agg(F.max("x.m").alias("m")).select("pair_id", "variant", "is_c", "m"))
    # every pair and variant, as rows without a score
    known = (tokens if pairs is None else pairs).select("pair_id")
    grid = known.select("pair_id", F.explode(F.array(*[F.lit(c) for c in candidates])).alias("variant"),
                        F.lit(None).cast("boolean").alias("is_c"), F.lit(None).cast("double").alias("m"))
    pr = per_tok.unionByName(grid).groupBy("pair_id", "variant").agg(
        F.coalesce(F.avg(F.when(F.col("is_c"), F.col("m"))), F.lit(0.0)).alias("precision"),
        F.coalesce(F.avg(F.when(~F.col("is_c"), F.col("m"))), F.lit(0.0)).alias("recall"))
    return pr.select("pair_id", "variant", "precision", "recall",
                     _f1(F.col("precision"), F.col("recall")).alias("f1"))


def f1_diffs(scores: DataFrame, base: str = "base", lora: str = "lora") -> DataFrame:
    """K2: one row per pair with ``<variant>_precision / _recall / _f1`` and
    ``f1_diff = lora - base``."""
    w = scores.groupBy("pair_id").agg(*[
        F.max(F.when(F.col("variant") == v, F.col(c))).alias(f"{n}_{c}")
        for n, v in (("base", base), ("lora", lora)) for c in ("precision", "recall", "f1")])
    return w.withColumn("f1_diff", F.col("lora_f1") - F.col("base_f1"))


def result_details(answers: DataFrame, scores: DataFrame) -> DataFrame:
    """I4: every answer row with the scores of its own tokens (``pair_id`` is
    its ``sample_id``)."""
    a = answers.select(F.col("sample_id").alias("pair_id"), "question", "reference",
                       F.col("base_answer").alias("base_pred"), F.col("lora_answer").alias("lora_pred"))
    return a.join(f1_diffs(scores), "pair_id")


def summary(scores: DataFrame, base: str = "base", lora: str = "lora",
            delta_label: str = "delta") -> DataFrame:
    """L1 + L2: mean P/R/F1 per variant (F1 is the mean of F1s) and the
    lora - base row, from one aggregate."""
    means = scores.groupBy("variant").agg(F.avg("precision").alias("precision"),
                                         F.avg("recall").alias("recall"), F.avg("f1").alias("f1"))
    cols = ("precision", "recall", "f1")
    delta = means.agg(*[(F.max(F.when(F.col("variant") == lora, F.col(c)))
                         - F.max(F.when(F.col("variant") == base, F.col(c)))).alias(c) for c in cols])
    return means.unionByName(delta.select(F.lit(delta_label).alias("variant"), *cols))
