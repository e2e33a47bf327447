"""Ranked queries return all rows that their SQL names."""

from chatframe.operators import bertscore
from chatframe.plans import catalog


def test_ranked_few_has_no_row_cap(spark, monkeypatch):
    pairs = spark.range(0, 13 * 1500).selectExpr("id as pair_id", "cast(-(id div 26) as double) as f1_diff")
    monkeypatch.setattr(catalog, "pair_scores", lambda *_: None)
    monkeypatch.setattr(bertscore, "f1_diffs", lambda _: pairs)
    got = [tuple(r) for r in catalog.ranked_few(spark, "").orderBy("rank").collect()]
    want = sorted((-(i // 26), i) for i in range(13 * 1500))
    assert got == [(n, i, float(d)) for n, (d, i) in enumerate(want, 1)]


def test_more_rows_asked_than_there_are(spark):
    got = catalog.ranked_variants(spark, "/root/testdata/sf0.001").collect()
    assert [r["rank"] for r in got] == [1, 2, 3] and {r["variant"] for r in got} == {"base", "lora", "delta"}
