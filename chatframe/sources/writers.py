"""Sinks (B1-B4).

Table form (default): one JSON/parquet row per sample, written in parallel,
plus a one-row ``config``.  Document form (the nested file the evaluation
scripts produce): a folder of parts which, joined in name order, are that JSON
document.  Many tasks write the rows, each a line; the first and the last line
hold what stands before and after them, so no value gathers the rows and any
number of them can be written.  ``join_parts`` makes one file of the parts.
"""

from __future__ import annotations

import json
import os
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatframe.operators.judging import scoreboard_wide
from chatframe.operators.reports import cut_fields
from chatframe.operators.sampling import number_rows
from chatframe.sources.documents import SPLIT_BYTES, local_path

ANSWER_COLS = ["sample_id", "instruction", "question", "reference", "base_answer", "lora_answer"]


def _write_config(df: DataFrame, config: Mapping, path: str) -> None:
    spark = df.sparkSession
    spark.createDataFrame([(json.dumps(dict(config), ensure_ascii=False),)], "value string") \
         .coalesce(1).write.mode("overwrite").text(f"{path}/config")


def _document(rows: DataFrame, order: str, cols: Sequence[str], head: Mapping, name: str, path: str) -> None:
    """``{<head>, "<name>": [<rows by order>]}`` in ordered parts (null fields
    are left out, so either-scores-or-error rows keep their shape)."""
    n = number_rows(rows, order, name="_no")
    body = F.to_json(F.struct(*cols), {"ignoreNullFields": "true"})
    lines = n.select(F.col("_no").cast("long").alias("no"),
                     F.concat(F.when(F.col("_no") > 1, F.lit(",")).otherwise(F.lit("")), body).alias("value"))
    before = json.dumps(dict(head), ensure_ascii=False)[:-1] + (", " if head else "") + json.dumps(name) + ": ["
    ends = rows.sparkSession.createDataFrame([(0, before), ((1 << 62), "]}")], "no long, value string")
    (lines.unionByName(ends).repartitionByRange("no").sortWithinPartitions("no")
     .select("value").write.mode("overwrite").text(path))


def _slices(sizes: Sequence[tuple[str, int]], split: int) -> list[tuple[int, list[tuple[str, int, int]]]]:
    """Ranges of at most ``split`` bytes of the files' concatenation: where a
    range begins, and its pieces ``(file, from, bytes)``."""
    out, to = [], 0
    for name, size in sizes:
        at = 0
        while at < size:
            if to % split == 0:
                out.append((to, []))
            n = min(size - at, split - to % split)
            out[-1][1].append((name, at, n))
            at, to = at + n, to + n
    return out


def join_parts(spark: SparkSession, parts: str, split: int = SPLIT_BYTES) -> str:
    """The document under ``parts`` as one file beside that folder: its path.

    Each task fills one range of at most ``split`` bytes of the file, so a task
    that is tried again writes the same bytes.  On a file system that tasks can't
    open, where a file has one writer, one task writes it."""
    path = f"{parts.rstrip('/')}.json"
    files = sorted(spark.read.format("binaryFile").load(parts).inputFiles())
    if local_path(files[0]) is None:
        kind = F.when(F.col("value") == "]}", 3).when(F.endswith("value", F.lit("[")), 0).otherwise(
            F.when(F.startswith("value", F.lit(",")), 2).otherwise(1))
        spark.read.text(parts).coalesce(1).sortWithinPartitions(kind).write.text(path)
        return spark.read.text(path).inputFiles()[0]
    names = [local_path(f) for f in files]
    target = f"{os.path.dirname(names[0])}.json"
    slices = _slices([(n, os.path.getsize(n)) for n in names], split)
    with open(target, "wb") as out:
        out.truncate(sum(n for _, pieces in slices for *_, n in pieces))

    def fill(piece: tuple[int, list[tuple[str, int, int]]]) -> None:
        with open(target, "r+b") as out:
            out.seek(piece[0])
            for name, at, n in piece[1]:
                with open(name, "rb") as part:
                    part.seek(at)
                    while n:
                        block = part.read(min(n, 1 << 20))
                        if not block:
                            raise EOFError(f"{name} has become shorter")
                        out.write(block)
                        n -= len(block)

    spark.sparkContext.parallelize(slices, max(1, len(slices))).foreach(fill)
    return path


def write_answers(df: DataFrame, config: Mapping, path: str, document: bool = False) -> None:
    """B1: answers (one row per sample), overwriting ``path``."""
    if document:
        _document(df.select(*ANSWER_COLS), "sample_id", ANSWER_COLS, {"config": dict(config)}, "answers", path)
        return
    df.select(*ANSWER_COLS).write.mode("overwrite").json(f"{path}/answers")
    _write_config(df, config, path)


def write_judge_results(scored: DataFrame, config: Mapping, path: str,
                        dims: Sequence[str] = ("correctness", "completeness"),
                        document: bool = False) -> None:
    """B2 from scored rows (``score_replies`` output plus ``question``):
    details carry either both score objects, with the judge's comment, or
    ``error`` (the failed call's message, else the code); ``num_evaluated``
    goes into ``config`` (L3-L6, L8)."""
    scores = {v: F.when(F.col("error").isNull(), F.struct(
        *[F.col(f"{v}_{d}").alias(d) for d in dims], F.col(f"{v}_comment").alias("comment"))) for v in ("base", "lora")}
    details = scored.select("sample_id", "question", scores["base"].alias("base_scores"),
                            scores["lora"].alias("lora_scores"),
                            F.coalesce("call_message", "error").alias("error"))
    wide = scoreboard_wide(scored, dims).first()
    config = {**config, "num_evaluated": wide["n_evaluated"]}
    summary = {d: {"base": wide[f"base_{d}"], "lora": wide[f"lora_{d}"], "diff": wide[f"lora_{d}"] - wide[f"base_{d}"]}
               for d in dims}
    total = {v: wide[f"{v}_total"] for v in ("base", "lora")}
    if document:
        _document(details, "sample_id", details.columns, {"config": config, "summary": summary, "total": total},
                  "details", path)
        return
    details.write.mode("overwrite").json(f"{path}/details")
    _write_config(scored, {"summary": summary, "total": total}, f"{path}/summary")
    _write_config(scored, config, path)


def write_bertscore_results(details: DataFrame, config: Mapping, path: str,
                            document: bool = False, cut: int = 200) -> None:
    """B3 from ``operators.bertscore.result_details``: text fields are stored
    cut to 200 characters, with the means per variant as ``summary``."""
    d = cut_fields(details, ["reference", "base_pred", "lora_pred"], cut)
    keep = ["question", "reference", "base_pred", "lora_pred", "base_f1", "lora_f1", "f1_diff"]
    means = details.agg(*[F.avg(f"{v}_{c}").alias(f"{v}_{c}")
                          for v in ("base", "lora") for c in ("precision", "recall", "f1")]).first()
    summary = {v: {c: means[f"{v}_{c}"] for c in ("precision", "recall", "f1")} for v in ("base", "lora")}
    if document:
        _document(d, "pair_id", keep, {"config": dict(config), "summary": summary}, "details", path)
        return
    d.select("pair_id", *keep).write.mode("overwrite").json(f"{path}/details")
    _write_config(details, {"summary": summary}, f"{path}/summary")
    _write_config(details, config, path)


def write_training_text(df: DataFrame, path: str) -> None:
    """The ``text``-only dataset handed to the trainer."""
    df.select("text").write.mode("overwrite").parquet(path)
