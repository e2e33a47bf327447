"""Derived views over the driver tables (definitions in FIXTURES.md §2).

Everything here is computed by Spark from the given tables, so each view
grows with them.  The stand-in answers and judge replies are formulas of the
sample key, which lets oracles check the pipeline without a model.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatframe.operators.context import conversations_to_sft
from chatframe.operators.judging import ab_coin
from chatframe.sources.tables import table


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations")


def sft(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Instruction rows from conversations; ``sample_id`` is ``conv_id:turn``."""
    return conversations_to_sft(conversations(spark, sf_dir))


def sample_number(sample_id=None) -> F.Column:
    """A number for the stand-ins' formulas (not a key)."""
    sid = F.col("sample_id") if sample_id is None else sample_id
    return (F.split_part(sid, F.lit(":"), F.lit(1)).cast("bigint") * 100
            + F.split_part(sid, F.lit(":"), F.lit(2)).cast("bigint"))


def answers_from_sft(s: DataFrame) -> DataFrame:
    out = F.col("output")
    n = F.length(out)
    return s.select(
        "sample_id", "instruction",
        F.col("input").alias("question"),
        out.alias("reference"),
        F.substring(out, F.lit(1), F.floor(n / 2).cast("int")).alias("base_answer"),
        F.concat(F.substring(out, F.lit(1), F.floor(n * 9 / 10).cast("int")), F.lit(" "),
                 F.substring(F.col("input"), 1, 20)).alias("lora_answer"),
    )


def answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return answers_from_sft(sft(spark, sf_dir))


def answers_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = F.array(*[F.struct(F.lit(v).alias("variant"), F.col(f"{v}_answer").alias("answer"))
                     for v in ("base", "lora")])
    return answers(spark, sf_dir).select("sample_id", F.explode(both).alias("a")).select("sample_id", "a.*")


def token_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    m = F.col("vec_id") % 20
    return e.select(
        F.floor(F.col("vec_id") / 20).cast("bigint").alias("pair_id"),
        F.when(m < 5, "base").when(m < 10, "lora").otherwise("ref").alias("side"),
        F.col("vec_id").alias("tok_id"),
        F.col("embedding").alias("vec"),
    )


def turns_with_exit(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = conversations(spark, sf_dir)
    user = F.col("role") == "user"
    return c.select(
        "conv_id", "turn", "role",
        F.when(user & (F.col("turn") == 2) & (F.col("conv_id") % 5 == 0), F.lit("  EXIT "))
         .when(user & (F.col("turn") == 4) & (F.col("conv_id") % 7 == 0), F.lit("   "))
         .otherwise(F.col("text")).alias("text"),
    )


def judge_truth_from_sft(s: DataFrame) -> DataFrame:
    n = F.col("n")
    return s.select("sample_id", sample_number().alias("n")).select(
        "sample_id",
        ab_coin(42, "sample_id").alias("base_is_a"),
        (n % 13).alias("kind"),
        (1 + ((n % 97) * 7) % 10).alias("bc"),
        (1 + ((n % 89) * 3 + 4) % 10).alias("lc"),
        (1 + ((n % 83) * 9 + 1) % 10).alias("bp"),
        (1 + ((n % 79) * 7 + 7) % 10).alias("lp"),
    )


def judge_truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_truth_from_sft(sft(spark, sf_dir))


def judge_replies_from_truth(t: DataFrame) -> DataFrame:
    """Reply text rendered from the truth table, incl. every failure class
    (built in stages so each piece of text is one column)."""
    kind = F.col("kind")
    s = lambda c: F.col(c).cast("string")
    nl = F.lit("\n")
    d = (t.withColumn("_b", F.concat(
              F.lit('{"correctness": '),
              F.when(kind == 5, F.concat(F.lit('"'), s("bc"), F.lit('"'))).otherwise(s("bc")),
              F.lit(', "completeness": '), s("bp"), F.lit(', "comment": "ok"}')))
          .withColumn("_l", F.concat(
              F.lit('{"correctness": '), s("lc"),
              F.when(kind == 3, F.lit("")).otherwise(F.concat(F.lit(', "completeness": '), s("lp"))),
              F.lit(', "comment": "ok"}')))
          .withColumn("_a_txt", F.when(F.col("base_is_a"), F.col("_b")).otherwise(F.col("_l")))
          .withColumn("_b_txt", F.when(F.col("base_is_a"), F.col("_l")).otherwise(F.col("_b")))
          .withColumn("_body", F.concat(F.lit('{"model_a": '), F.col("_a_txt"), F.lit(', "model_b": '),
                                        F.col("_b_txt"), F.lit("}"))))
    body = F.col("_body")
    reply = (F.when(kind == 0, F.concat(F.lit("```json"), nl, body, nl, F.lit("```")))
              .when(kind == 1, F.concat(F.lit("  ```"), nl, body, nl, F.lit("``` ")))
              .when(kind == 2, F.lit("cannot judge"))
              .when(kind == 4, F.concat(body, F.lit(" done")))
              .when(kind == 6, F.concat(F.lit('{"model_a": '), F.col("_a_txt"), F.lit("}")))
              .when(kind == 7, F.concat(body, F.lit("] the end")))
              .when(kind == 8, F.concat(body, F.lit("],[1")))
              .otherwise(body))
    return d.select("sample_id", "base_is_a", reply.alias("reply"))


def judge_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_replies_from_truth(judge_truth(spark, sf_dir))
