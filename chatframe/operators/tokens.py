"""Token counting and length budgets."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatframe.functions.text import count_words, sanitize, truncate_ids
from chatframe.session import stored


def count_tokens(col, tokenizer_factory: Callable[[], Callable[[str], Sequence]] | None = None) -> Column:
    """Token count of a text column.

    Default is the whitespace word count (``len(s.split())``), fully
    JVM-side.  With ``tokenizer_factory`` the supplied tokenizer runs in an
    Arrow-batched iterator UDF, built once per task; a text the tokenizer
    cannot handle falls back to the word count.
    """
    c = F.col(col) if isinstance(col, str) else col
    if tokenizer_factory is None:
        return count_words(sanitize(c))

    @F.pandas_udf("bigint")
    def _count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tok = tokenizer_factory()

        def one(s):
            if s is None:
                return 0
            try:
                return len(tok(s))
            except Exception:  # noqa: BLE001 - same fallback as the chat loop
                return len(s.split())

        for batch in batches:
            yield batch.map(one).astype("int64")

    return _count(sanitize(c))


def count_table(texts: DataFrame, tokenizer_factory: Callable[[], Callable[[str], Sequence]], text: str = "text") -> DataFrame:
    """E1 by content: ``<text_sha256, n_tokens>`` of every different text, stored.

    Copies are combined before the shuffle, and each different text is one call
    of the tokenizer (two, if its task is tried again)."""
    t = texts.select(F.col(text).alias("text")).where("text IS NOT NULL").distinct()
    return stored(t.select(F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"),
                           count_tokens("text", tokenizer_factory).alias("n_tokens")), "token-counts")


def with_token_counts(turns: DataFrame, tokenizer_factory=None, text: str = "text") -> DataFrame:
    """``turns`` with ``n_tokens``: words, or what the supplied tokenizer says,
    looked up in a ``count_table`` so that later reads call nothing (null: 0)."""
    if tokenizer_factory is None:
        return turns.withColumn("n_tokens", count_tokens(text))
    counts = count_table(turns, tokenizer_factory, text).select(F.col("text_sha256").alias("_sha"), "n_tokens")
    same = F.sha2(F.col(text).cast("binary"), 256) == F.col("_sha")
    return turns.join(counts, same, "left").select(*turns.columns, F.coalesce("n_tokens", F.lit(0)).alias("n_tokens"))


def truncate_tokens(df: DataFrame, ids: str, max_len: int = 1024) -> DataFrame:
    """Keep the first ``max_len`` ids and flag the rows that were cut."""
    return (df.withColumn(f"{ids}_kept", truncate_ids(ids, max_len))
              .withColumn("truncated", F.size(ids) > max_len))


def length_profile(df: DataFrame, n: str, max_len: int = 1024,
                   quantiles: Sequence[float] = (0.5, 0.9, 0.99)) -> DataFrame:
    """How many rows a ``max_len`` cut affects, plus the length spread.

    Exact percentiles: Spark's ``percentile`` keeps a value->count map per
    partial aggregate, so its state grows with the number of *distinct*
    lengths (bounded by the longest text), not with the row count.
    """
    c = F.col(n)
    aggs = [F.count(F.lit(1)).alias("n_rows"),
            F.count_if(c > max_len).alias("n_over"),
            F.sum(F.greatest(c - max_len, F.lit(0))).alias("tokens_cut"),
            F.min(c).alias("min_len"), F.max(c).alias("max_len"),
            F.avg(c).alias("avg_len")]
    out = df.agg(*aggs, F.percentile(c, list(quantiles)).alias("_q"))  # one map for all quantiles
    return out.select(*[x for x in out.columns if x != "_q"],
                      *[F.col("_q")[i].alias(f"p{round(q * 100):02d}") for i, q in enumerate(quantiles)])
