"""Joins, rankings and report tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatframe.functions.text import cut, preview
from chatframe.operators.sampling import number_rows

VARIANTS = ("base", "lora")

# Report labels as the evaluation prints them.
DIMENSION_LABELS = {"correctness": "正確性", "completeness": "完整性"}
TOTAL_LABEL = "總平均"
VARIANT_LABELS = {"base": "Base Model", "lora": "LoRA Model"}
DELTA_LABEL = "提升幅度"


def attach_variants(long: DataFrame, key: str = "sample_id", variant: str = "variant",
                    value: str = "answer", variants: Sequence[str] = VARIANTS) -> DataFrame:
    """I2 / H3 wide form: one row per key, one column per variant (null until
    that variant exists).  A pivot with fixed values: one aggregate on ``key``."""
    aggs = [F.max(F.when(F.col(variant) == v, F.col(value))).alias(f"{v}_{value}") for v in variants]
    return long.groupBy(key).agg(*aggs)


def side_by_side(answers: DataFrame, n: int = 200, key: str = "sample_id") -> DataFrame:
    """I3 + T8 + T13: numbered questions with both answers previewed."""
    numbered = number_rows(answers, key, name="question_no")
    return numbered.select(
        F.col("question_no").cast("int").alias("question_no"), key, "question",
        preview("base_answer", n).alias("base_preview"),
        preview("lora_answer", n).alias("lora_preview"))


def top_k(df: DataFrame, by: str, k: int = 3, descending: bool = True,
          tiebreak: str = "pair_id", rank: str = "rank") -> DataFrame:
    """J1/J2/J3 + T13: first ``k`` rows by ``by`` (ties by ``tiebreak``),
    numbered from 1.  ``orderBy().limit()`` plans as TakeOrderedAndProject;
    numbering happens after the limit, on at most ``k`` rows."""
    order = F.col(by).desc() if descending else F.col(by).asc()
    head = df.orderBy(order, F.col(tiebreak).asc()).limit(k)
    from pyspark.sql import Window
    w = Window.orderBy(order, F.col(tiebreak).asc())
    return head.withColumn(rank, F.row_number().over(w))


def format_fixed(col, digits: int, signed: bool = False):
    """``f"{x:.4f}"`` / ``f"{x:+.4f}"`` on doubles."""
    fmt = f"%{'+' if signed else ''}.{digits}f"
    return F.format_string(fmt, F.col(col).cast("double") if isinstance(col, str) else col.cast("double"))


def ranked_examples(diffs: DataFrame, questions: DataFrame, k: int = 3, descending: bool = True,
                    key: str = "pair_id") -> DataFrame:
    """M3: rank, signed diff, question preview (60 chars + '...'), both F1."""
    top = top_k(diffs, "f1_diff", k, descending, tiebreak=key)
    j = top.join(questions, key, "left")
    return j.select("rank", key,
                    format_fixed("f1_diff", 4, signed=True).alias("diff"),
                    preview("question", 60, always=True).alias("question"),
                    format_fixed("base_f1", 4).alias("base_f1"),
                    format_fixed("lora_f1", 4).alias("lora_f1"))


def cut_fields(df: DataFrame, cols: Sequence[str], n: int = 200) -> DataFrame:
    """B3 text fields stored cut to ``n`` characters."""
    for c in cols:
        df = df.withColumn(c, cut(c, n))
    return df


def bertscore_report_table(summary: DataFrame, delta_label: str = "delta") -> DataFrame:
    """M1: 4-decimal P/R/F1 per variant and a signed delta row, labelled."""
    labels = F.create_map(*[x for k, v in VARIANT_LABELS.items() for x in (F.lit(k), F.lit(v))])
    is_delta = F.col("variant") == delta_label
    label = F.when(is_delta, F.lit(DELTA_LABEL)).otherwise(labels[F.col("variant")])
    cols = [F.when(is_delta, format_fixed(c, 4, signed=True)).otherwise(format_fixed(c, 4)).alias(c)
            for c in ("precision", "recall", "f1")]
    return summary.select(label.alias("label"), *cols)


def judge_report_table(wide: DataFrame, dims: Sequence[str] = ("correctness", "completeness")) -> DataFrame:
    """M2: one line per dimension (localised label, 2 decimals, signed diff)
    and the total line."""
    rows = []
    for d in dims:
        rows.append(F.struct(F.lit(DIMENSION_LABELS.get(d, d)).alias("label"),
                             F.col(f"base_{d}").alias("base"), F.col(f"lora_{d}").alias("lora")))
    rows.append(F.struct(F.lit(TOTAL_LABEL).alias("label"), F.col("base_total").alias("base"),
                         F.col("lora_total").alias("lora")))
    long = wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    return long.select("label", format_fixed("base", 2).alias("base"), format_fixed("lora", 2).alias("lora"),
                       format_fixed(F.col("lora") - F.col("base"), 2, signed=True).alias("diff"))
