"""The pipeline's stages on tables with clashing, missing and extra columns,
ties and very long texts."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline

CLASH = ("_slot", "_w", "_bits", "_maybe", "_t", "_l", "_s", "row", "k", "w", "bits", "slot", "maybe", "n", "h",
         "component_id", "n_hit", "found", "fp", "lang_pred")


def prose(seed, n):
    rng = random.Random(seed)
    words = [f"{a}{b}" for a in ("stone", "river", "cloud", "field", "light") for b in ("s", "ed", "ing", "less", "")]
    return " ".join(rng.choice(words) for _ in range(n))


@pytest.fixture
def table_dir(spark, tmp_path):
    spark.createDataFrame([("b1", " ".join(f"bench{i}" for i in range(14)))], "item_id string, text string") \
        .write.parquet(str(tmp_path / "benchmark.parquet"))
    return str(tmp_path)


def rows():
    leak = " ".join(f"bench{i}" for i in range(14))
    out = [(i, prose(i, 60), "en") for i in range(1, 21)]
    out += [(30, prose(3, 60), "en"), (31, prose(3, 60), "en")]     # copies of 3
    out += [(40, f"{prose(40, 30)} {leak} {prose(41, 30)}", "en")]  # benchmark passage
    out += [(50, f"{prose(50, 40)} password = hunter2secret", "en")]
    out += [(60, prose(60, 90_000), "en")]                           # very long
    out += [(70, None, None), (71, "", None), (72, "12345 678", None), (None, prose(80, 60), "en")]
    return out


def test_columns_of_any_name_come_through(spark, table_dir):
    base = spark.createDataFrame(rows(), "doc_id long, text string, lang string")
    docs = base.select("*", *[F.xxhash64("doc_id", F.lit(c)).alias(c) for c in CLASH]).repartition(3)
    want = {r["doc_id"]: [r[c] for c in CLASH] for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, table_dir)
        assert out.columns == docs.columns, name
        docs = out
    got = {r["doc_id"]: r for r in docs.collect()}
    assert set(got) == set(range(1, 21)) | {50, 60, None}
    assert all([r[c] for c in CLASH] == want[i] for i, r in got.items())
    assert "hunter2" not in got[50]["text"] and len(got[60]["text"]) == len(prose(60, 90_000))
    digests = corpus_pipeline.tokenize(spark, docs, table_dir).collect()
    assert {r["doc_id"] for r in digests} == set(got) and all(r["n_tokens"] > 0 for r in digests)


def test_n_chars_follows_the_text(spark, table_dir):
    docs = spark.createDataFrame([(1, "token = abcdefgh12", 18), (2, "plain", 5)], "doc_id long, text string, n_chars int")
    got = corpus_pipeline.remove_secrets(spark, docs, table_dir)
    assert got.schema["n_chars"].dataType == docs.schema["n_chars"].dataType
    assert all(r["n_chars"] == len(r["text"]) for r in got.collect())
