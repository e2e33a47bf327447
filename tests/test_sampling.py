"""Seeded exact-size sampling: independent of partitioning; every k gives
the exact ranking."""


from chatframe.operators import sampling as sp


def ids(df):
    return sorted(r["sample_id"] for r in df.select("sample_id").collect())


def test_sample_independent_of_partitioning(spark):
    df = spark.range(5000).withColumnRenamed("id", "sample_id")
    a = ids(sp.sample_k(df.repartition(3), 25, seed=42))
    b = ids(sp.sample_k(df.repartition(11), 25, seed=42))
    assert a == b and len(a) == 25
    assert ids(sp.sample_k(df, 10_000, seed=1)) == list(range(5000))  # k clamped to n


def test_sample_is_the_exact_ranking_for_every_k(spark, monkeypatch):
    import hashlib
    monkeypatch.setattr(sp, "PREFIX_DIGITS", 1)  # many rows in the last prefix
    df = spark.range(500).withColumnRenamed("id", "sample_id")
    ranked = sorted(range(500), key=lambda i: hashlib.md5(f"5:{i}".encode()).hexdigest())
    for k in (0, 1, 37, 499, 500, 600):
        assert ids(sp.sample_k(df, k, seed=5)) == sorted(ranked[:k])


def test_replay_keeps_positions(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "sample_id string, x int")
    known = spark.createDataFrame([("b", 0), ("a", 1), ("b", 2), ("z", 3)], "sample_id string, p int")
    got = sp.select_ids(df, known, position="p").orderBy("p").collect()
    assert [(r["sample_id"], r["x"], r["p"]) for r in got] == [("b", 2, 0), ("a", 1, 1), ("b", 2, 2)]


def test_number_rows_by_any_key(spark):
    for keys, kind in (([i * 7 for i in range(50)], "long"), ([f"k{i:03d}" for i in range(50)], "string"), ([], "long")):
        df = spark.createDataFrame([(k,) for k in keys], f"k {kind}").repartition(4)
        out = sp.number_rows(df, "k")
        assert sorted((r["k"], r["rn"]) for r in out.collect()) == [(k, i + 1) for i, k in enumerate(keys)]
        assert "SinglePartition" not in out._jdf.queryExecution().executedPlan().toString()


def test_many_copies_keep_distinct_keys(spark, monkeypatch):
    monkeypatch.setattr(sp, "COPY_STEP", 7)
    df = spark.createDataFrame([("i", "q", "a")] * 40, "instruction string, input string, output string")
    assert sp.ensure_sample_id(df).select("sample_id").distinct().count() == 40


def test_ensure_sample_id_copies(spark):
    df = spark.createDataFrame([("i", "q", "a")] * 3 + [("i", "q2", "a")],
                               "instruction string, input string, output string")
    out = sp.ensure_sample_id(df)
    assert out.select("sample_id").distinct().count() == 4 and out.count() == 4


def test_sample_positions_ties_and_null_keys(spark):
    """Rows that share a key or have none take part; places are gapless."""
    rows = [(str(i % 300) if i % 50 else None, i) for i in range(900)]
    df = spark.createDataFrame(rows, "sample_id string, h int").repartition(5)
    for k in (0, 1, 299, 900, 5000):
        out = sp.sample_k(df, k, position="at").collect()
        assert sorted(r["at"] for r in out) == list(range(1, min(k, 900) + 1))
    import hashlib
    want = sorted(hashlib.md5(f"42:{key or ''}".encode()).hexdigest() for key, _ in rows)
    got = {r["at"]: hashlib.md5(f"42:{r['sample_id'] or ''}".encode()).hexdigest()
           for r in sp.sample_k(df, 400, position="at").collect()}
    assert [got[i] for i in range(1, 401)] == want[:400]
    assert sp.sample_k(df.limit(0), 5).count() == 0


def test_a_sample_reads_its_rows_once(spark, tmp_path):
    spark.range(1000).selectExpr("cast(id as string) sample_id", "repeat('x', 50) text").write.parquet(str(tmp_path / "t"))
    plan = sp.sample_k(spark.read.parquet(str(tmp_path / "t")), 20)._jdf.queryExecution().executedPlan().toString()
    assert plan.split("== Initial Plan ==")[0].count(f"{tmp_path}") == 1 and "SinglePartition" not in plan


def test_numbered_rows_are_not_shuffled_by_their_partition(spark):
    from pyspark.sql import functions as F
    out = sp.number_rows(spark.range(1000).select((F.col("id") * 7 % 1000).alias("k")), "k", name="no")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as if the rows were too many to broadcast
    try:
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "hashpartitioning" not in plan and "SortMergeJoin" not in plan
    assert [tuple(r) for r in out.orderBy("k").collect()] == [(i, i + 1) for i in range(1000)]
