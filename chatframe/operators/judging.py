"""Blinded pairwise judging: A/B assignment, reply decoding, un-blinding,
prefix-counted scores and scoreboards (all narrow, native expressions).

Decoding rules (strict JSON like ``json.loads``):

* the reply is stripped; if it starts with a code fence the piece between the
  first and second fence is taken, a leading ``json`` tag dropped, stripped;
* the text is parsed as ``'[' + text + ',"' + md5(text) + '"]'`` and the second
  element must be that digest: this rejects trailing text, also after a ``]`` of
  the reply, and several values, which the lenient JSON readers accept;
* ``model_a`` / ``model_b`` must both be present (else ``missing_model``);
* scores are read in the order base.d1, lora.d1, base.d2, lora.d2, ...; on the
  first missing (``missing_score``) or non-numeric (``bad_score_type``) value
  the rest is skipped, but values read before it still count.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatframe.functions.text import py_strip
from chatframe.schemas import SCORE_DIMS

_NUMERIC_VARIANT = r"^(TINYINT|SMALLINT|INT|BIGINT|FLOAT|DOUBLE|DECIMAL.*)$"
FENCE = "```"


def ab_coin(seed: int, key: Column | str = "sample_id") -> Column:
    """Seeded coin per key: True when base is shown as model A."""
    k = F.col(key) if isinstance(key, str) else key
    h = F.md5(F.concat(F.lit(f"{seed}:ab:"), k.cast("string")))
    return F.substring(h, 1, 1) >= F.lit("8")


def assign_ab(df: DataFrame, seed: int = 42, key: str = "sample_id",
              base: str = "base_answer", lora: str = "lora_answer") -> DataFrame:
    """K3: add ``base_is_a``, ``answer_a`` and ``answer_b``."""
    coin = ab_coin(seed, key)
    return (df.withColumn("base_is_a", coin)
              .withColumn("answer_a", F.when(F.col("base_is_a"), F.col(base)).otherwise(F.col(lora)))
              .withColumn("answer_b", F.when(F.col("base_is_a"), F.col(lora)).otherwise(F.col(base))))


def score_replies(df: DataFrame, dims: Sequence[str] = SCORE_DIMS,
                  reply: str = "reply", call_error: str | None = "error",
                  atomic: bool = False) -> DataFrame:
    """K4-K8: decode ``reply`` and un-blind it with ``base_is_a``.

    All input columns stay, but for ``call_error``, whose message moves to
    ``call_message``.  Adds ``error`` (closed code set or NULL), ``base_comment``
    and ``lora_comment``, and ``base_<dim>`` / ``lora_<dim>`` doubles holding
    the values that count (prefix rule; with ``atomic=True`` only rows without
    error count).

    Built in stages of plain columns (the reply is parsed once; every later
    step refers to columns, so the plan stays linear in the number of
    dimensions and everything remains one narrow, codegen'd projection).
    """
    has_error = call_error is not None and call_error in df.columns
    made = {f"{v}_{x}" for v in ("base", "lora") for x in (*dims, "comment")} | {"call_message", "error"}
    kept = [c for c in df.columns if c != call_error and c not in made]
    message = F.col(call_error).cast("string") if has_error else F.lit(None).cast("string")
    d = df.select(F.struct(*kept).alias("_in"), F.col(reply).alias("_reply"), F.col("base_is_a").alias("_a"),
                  message.alias("call_message"))
    # K4 then K5, one column per step: each intermediate is computed once
    d = (d
           .withColumn("_failed", F.col("_reply").isNull() | F.col("call_message").isNotNull())
           .withColumn("_s", py_strip(F.col("_reply")))
           .withColumn("_inner", F.try_element_at(F.split("_s", FENCE, -1), F.lit(2)))
           .withColumn("_inner", F.when(F.startswith("_inner", F.lit("json")),
                                        F.substr("_inner", F.lit(5))).otherwise(F.col("_inner")))
           .withColumn("_body", F.when(F.startswith("_s", F.lit(FENCE)), py_strip("_inner"))
                                 .otherwise(F.col("_s")))
           .withColumn("_mark", F.md5("_body"))
           .withColumn("_v", F.try_parse_json(F.concat(F.lit("["), F.col("_body"), F.lit(',"'), F.col("_mark"),
                                                       F.lit('"]'))))
           .withColumn("_doc", F.when(F.try_variant_get("_v", "$[1]", "string") == F.col("_mark"),
                                      F.try_variant_get("_v", "$[0]", "variant"))))
    d = (d.withColumn("_base", F.when(F.col("_a"),
                                      F.try_variant_get("_doc", "$.model_a", "variant"))
                                 .otherwise(F.try_variant_get("_doc", "$.model_b", "variant")))
          .withColumn("_lora", F.when(F.col("_a"),
                                      F.try_variant_get("_doc", "$.model_b", "variant"))
                                 .otherwise(F.try_variant_get("_doc", "$.model_a", "variant"))))
    # reading order: base.d1, lora.d1, base.d2, lora.d2, ...
    slots = [(f"{v}_{dim}", f"_{v}", dim) for dim in dims for v in ("base", "lora")]
    for name, model, dim in slots:
        d = d.withColumn(f"_x_{name}", F.try_variant_get(model, f"$.{dim}", "variant"))
    for name, _, _ in slots:
        x = F.col(f"_x_{name}")
        d = d.withColumn(f"_ok_{name}", F.coalesce(F.schema_of_variant(x).rlike(_NUMERIC_VARIANT),
                                                   F.lit(False)))
    # first failing slot decides the code; values before it still count
    slot_error = None
    for name, _, _ in slots:
        code = F.when(F.col(f"_x_{name}").isNull(), F.lit("missing_score")).otherwise(F.lit("bad_score_type"))
        cond = ~F.col(f"_ok_{name}")
        slot_error = F.when(cond, code) if slot_error is None else slot_error.when(cond, code)
    error = (F.when(F.col("_failed"), F.lit("call_failed"))
              .when(F.col("_doc").isNull(), F.lit("bad_json"))
              .when(F.col("_base").isNull() | F.col("_lora").isNull(), F.lit("missing_model"))
              .otherwise(slot_error))
    d = d.withColumn("error", error)
    decoded = ~F.col("_failed") & F.col("_base").isNotNull() & F.col("_lora").isNotNull()
    prior = decoded & (F.col("error").isNull() if atomic else F.lit(True))
    outs = []
    for name, _, _ in slots:
        prior = prior & F.col(f"_ok_{name}")
        outs.append(F.when(prior, F.try_variant_get(f"_x_{name}", "$", "double")).alias(name))
    comments = [F.when(~F.col("_failed"), F.try_variant_get(f"_{v}", "$.comment", "string")).alias(f"{v}_comment")
                for v in ("base", "lora")]
    return d.select("_in.*", "call_message", "error", *outs, *comments)


def scoreboard_wide(scored: DataFrame, dims: Sequence[str] = SCORE_DIMS,
                    group: Sequence[str] = (), mean_of_means: bool = False) -> DataFrame:
    """L3, L5, L6 in one aggregate: means per dimension/variant (0 when
    nothing scored), totals with the correctness-count denominator (or, with
    ``mean_of_means``, the mean of the dimensions' means) and row counts.  Columns: ``<variant>_<dim>``, ``<variant>_total``, ``n_evaluated``,
    ``n_failed``."""
    aggs = []
    for dim in dims:
        for v in ("base", "lora"):
            aggs.append(F.coalesce(F.avg(f"{v}_{dim}"), F.lit(0.0)).alias(f"{v}_{dim}"))
    first = dims[0]
    for v in ("base", "lora"):
        total = sum((F.coalesce(F.sum(f"{v}_{d}"), F.lit(0.0)) for d in dims), F.lit(0.0))
        denom = F.lit(float(len(dims))) * F.greatest(F.count(f"{v}_{first}"), F.lit(1))
        if mean_of_means:
            total = sum((F.coalesce(F.avg(f"{v}_{d}"), F.lit(0.0)) for d in dims), F.lit(0.0))
            denom = F.lit(float(len(dims)))
        aggs.append((total / denom).alias(f"{v}_total"))
    aggs.append(F.count_if(F.col("error").isNull()).alias("n_evaluated"))
    aggs.append(F.count_if(F.col("error").isNotNull()).alias("n_failed"))
    return scored.groupBy(*group).agg(*aggs)


def scoreboard_long(wide: DataFrame, dims: Sequence[str] = SCORE_DIMS,
                    group: Sequence[str] = ()) -> DataFrame:
    """One line per dimension with ``base``, ``lora`` and ``diff``."""
    per_dim = [F.struct(F.lit(d).alias("dimension"), F.col(f"base_{d}").alias("base"),
                        F.col(f"lora_{d}").alias("lora")) for d in dims]
    return (wide.select(*group, F.explode(F.array(*per_dim)).alias("s"))
                .select(*group, "s.dimension", "s.base", "s.lora",
                        (F.col("s.lora") - F.col("s.base")).alias("diff")))
