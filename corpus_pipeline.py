"""From raw documents to token digests in five stages.

Each stage is ``(spark, docs, sf_dir) -> DataFrame`` and works on all that its
predecessor kept; all but the last return the columns of ``documents``.  Stages
bound the session's Arrow batches by bytes, as texts may be long.

1. language ID drops documents without a language: no letter, or a text that
   no language's context tree codes better than equal chances.
2. SimHash near-dedup keeps the smallest doc_id of each group.
3. Decontamination drops documents in which a window of a benchmark item occurs.
4. The secret scan replaces every span.
5. Byte-level BPE encodes and decodes what is left.

Rows that repeat a doc_id are one document, one row of which stays in stage 2.
Rows with a null doc_id can't be named by a decision: stages 2 and 3 keep them.
Null and empty texts have no language and go in stage 1; texts of any length
are worked on whole; copies and near copies tie by doc_id; an empty table gives
an empty result.  Columns besides doc_id and text may have any names and are
handed on unchanged, but ``n_chars``, where there is one, is counted anew by
stage 4.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatframe.llm import bpe_fst, decontam, langid, secret_scan, simhash
from chatframe.llm.spark_util import small_batches, stored, table, without_ids


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return langid.accepted(docs, langid.fit(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    rows = simhash.near_duplicates(docs.select("doc_id", "text"), shingle=4, distance=4)
    found = stored(rows.groupBy("doc_id").agg(F.min("component_id").alias("component_id"), F.count("*").alias("n")),
                   "groups")
    gone = found.where("doc_id <> component_id").select("doc_id")
    again = found.where("doc_id = component_id AND n > 1").select("doc_id")
    kept = without_ids(docs, gone, "doc_id")
    if again.isEmpty():
        return kept
    kept = stored(kept, "kept")
    return kept.join(again, "doc_id", "left_anti").select(docs.columns).unionByName(
        kept.join(again, "doc_id", "left_semi").select(docs.columns).dropDuplicates(["doc_id"]))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    rows = decontam.contamination(docs, table(spark, sf_dir, "benchmark"))
    gone = stored(rows.where("n_hit > 0 AND doc_id IS NOT NULL").select("doc_id").distinct(), "contaminated")
    return without_ids(docs, gone, "doc_id")


def remove_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    out = secret_scan.redacted(docs)
    if "n_chars" not in docs.columns:
        return out
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return bpe_fst.round_trip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("remove_secrets", remove_secrets),
    ("tokenize", tokenize),
]

#: SQL can't express context trees, XXH64 or merges: the tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
