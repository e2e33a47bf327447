"""BERTScore: blocked relational form (forced into many blocks) against a
numpy brute force; identical texts score 1; an empty side scores 0."""

import numpy as np
import pytest

from chatframe.operators.bertscore import bertscore


def brute(c, r):
    if len(c) == 0 or len(r) == 0:
        return 0.0, 0.0, 0.0
    cn = c / np.linalg.norm(c, axis=1, keepdims=True)
    rn = r / np.linalg.norm(r, axis=1, keepdims=True)
    s = cn @ rn.T
    p, rr = s.max(1).mean(), s.max(0).mean()
    return p, rr, (0.0 if p + rr == 0 else 2 * p * rr / (p + rr))


def test_blocked_equals_brute_force(spark):
    rng = np.random.default_rng(0)
    rows, sides = [], {}
    tok = 0
    for pair in range(4):
        for side, n in (("base", 30 + pair), ("lora", 5), ("ref", 23)):
            vs = rng.normal(size=(n, 8)).astype(np.float32)
            sides[(pair, side)] = vs
            for v in vs:
                rows.append((pair, side, tok, v.tolist()))
                tok += 1
    df = spark.createDataFrame(rows, "pair_id long, side string, tok_id long, vec array<float>")
    got = {(r["pair_id"], r["variant"]): (r["precision"], r["recall"], r["f1"])
           for r in bertscore(df, block=4).collect()}
    for pair in range(4):
        for v in ("base", "lora"):
            want = brute(sides[(pair, v)].astype(np.float64), sides[(pair, "ref")].astype(np.float64))
            assert got[(pair, v)] == pytest.approx(want, abs=1e-9)


def test_identical_and_empty(spark):
    v = [[1.0, 0.0], [0.0, 1.0], [0.6, 0.8]]
    rows = [(0, "base", i, x) for i, x in enumerate(v)] + [(0, "ref", 10 + i, x) for i, x in enumerate(v)]
    rows += [(1, "ref", 20, [1.0, 0.0])]
    df = spark.createDataFrame(rows, "pair_id long, side string, tok_id long, vec array<float>")
    got = {(r["pair_id"], r["variant"]): (r["precision"], r["recall"], r["f1"]) for r in bertscore(df).collect()}
    assert got[(0, "base")] == pytest.approx((1.0, 1.0, 1.0))
    assert got[(0, "lora")] == (0.0, 0.0, 0.0)
    assert got[(1, "base")] == (0.0, 0.0, 0.0)


def test_blank_pairs_score_zero_and_keys_may_be_text(spark):
    df = spark.createDataFrame([("1:0", "base", 0, [1.0]), ("1:0", "ref", 0, [1.0])],
                               "pair_id string, side string, tok_id long, vec array<float>")
    known = spark.createDataFrame([("1:0",), ("2:2",)], "pair_id string")
    got = {(r["pair_id"], r["variant"]): r["f1"] for r in bertscore(df, pairs=known).collect()}
    assert got == {("1:0", "base"): 1.0, ("1:0", "lora"): 0.0, ("2:2", "base"): 0.0, ("2:2", "lora"): 0.0}


def test_plan_shuffles_and_one_kernel(spark):
    from chatframe.plans.catalog import bertscore_pairs
    plan = bertscore_pairs(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInPandas") == 1
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = bertscore_pairs(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") <= 6
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_every_text_is_encoded_once(spark):
    from chatframe.operators.inference import encode_tokens, materialize, pending
    from chatframe.session import work_dir
    calls = spark.sparkContext.accumulator(0)

    def factory():
        def enc(texts):
            calls.add(len(texts))
            return [np.ones((len(t.split()), 2), np.float32) for t in texts]
        return enc
    texts = spark.createDataFrame([(i, s, "a b") for i in range(20) for s in ("base", "lora", "ref")],
                                  "pair_id long, side string, text string")
    store = work_dir(spark, "toks")
    toks = materialize(encode_tokens(texts, factory), store)
    assert bertscore(toks).count() == 40 and calls.value == 60
    done = toks.select("pair_id").distinct()
    again = encode_tokens(pending(texts, done, "pair_id"), factory)
    assert again.count() == 0 and calls.value == 60


# ------------------------------------------------------------ physical forms ---
def random_pairs(seed, pairs=6, dims=5):
    rng = np.random.default_rng(seed)
    rows, sides = [], {}
    for p in range(pairs):
        for side in ("base", "lora", "ref"):
            n = int(rng.integers(0, 40)) if (p, side) != (0, "ref") else 0
            v = rng.normal(size=(n, dims)).astype(np.float32)
            sides[p, side] = v
            rows += [(p, side, int(i), x.tolist()) for i, x in zip(rng.permutation(200)[:n], v, strict=True)]
    return rows, sides


@pytest.mark.parametrize("block,tile", [(4, 4), (4, 16), (8, 64), (512, 512)])
def test_tiles_equal_brute_force(spark, block, tile):
    rows, sides = random_pairs(tile)
    df = spark.createDataFrame(rows, "pair_id long, side string, tok_id long, vec array<float>")
    pairs = spark.range(6).withColumnRenamed("id", "pair_id")
    got = {(r["pair_id"], r["variant"]): (r["precision"], r["recall"], r["f1"])
           for r in bertscore(df, block=block, tile=tile, pairs=pairs).collect()}
    assert len(got) == 12
    for (p, v), x in got.items():
        assert x == pytest.approx(brute(sides[p, v].astype(np.float64), sides[p, "ref"].astype(np.float64)), abs=1e-9)


def test_a_tile_holds_whole_blocks(spark):
    df = spark.createDataFrame([], "pair_id long, side string, tok_id long, vec array<float>")
    with pytest.raises(ValueError, match="whole blocks"):
        bertscore(df, block=4, tile=6)
    assert bertscore(df, block=4, tile=8).count() == 0


def test_blocks_travel_with_the_root_of_the_tiles(spark):
    """One pair of 64 x 64 blocks: rows sent for T tiles are 128 * sqrt(T)."""
    from pyspark.sql import functions as F

    from chatframe.operators.bertscore import tile_grid
    blocks = spark.range(128).select(F.lit(1).alias("pair_id"), F.when(F.col("id") < 64, "base").otherwise("ref").alias("side"),
                                     (F.col("id") % 64).alias("blk"), F.array(F.col("id")).alias("tok"),
                                     F.array(F.lit(1.0).cast("float")).alias("vec"))
    for root in (1, 2, 4, 8, 16):
        cut = blocks.withColumn("tile", F.floor(F.col("blk") * root / 64))
        grid = tile_grid(cut, ("base",), "ref")
        assert grid.count() == 128 * root and grid.select("ct", "rt").distinct().count() == root ** 2
        assert grid.groupBy("ct", "rt").count().agg(F.max("count")).first()[0] == 128 // root


def test_row_local_form_is_native(spark):
    from chatframe.operators.bertscore import bertscore_rows
    _, sides = random_pairs(3)
    rows = [(p, *[None if (p, s) == (1, "lora") else sides[p, s].tolist() for s in ("base", "lora", "ref")]) for p in range(6)]
    rows.append((9, [[0.0, 0.0], [1.0, 0.0]], [[3.0, 4.0]], [[3.0, 4.0]]))
    df = spark.createDataFrame(rows, "pair_id long, base array<array<float>>, lora array<array<float>>, ref array<array<float>>")
    out = bertscore_rows(df)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "MapIn" not in plan
    got = {(r["pair_id"], r["variant"]): (r["precision"], r["recall"], r["f1"]) for r in out.collect()}
    assert got[9, "lora"] == pytest.approx((1, 1, 1)) and got[9, "base"] == pytest.approx((0.3, 0.6, 0.4))
    for p in range(6):
        for v in ("base", "lora"):
            c = np.empty((0, 5)) if (p, v) == (1, "lora") else sides[p, v].astype(np.float64)
            assert got[p, v] == pytest.approx(brute(c, sides[p, "ref"].astype(np.float64)), abs=1e-9)


@pytest.mark.parametrize("tile", [None, 1024])
def test_kernels_get_small_batches(spark, tmp_path, monkeypatch, tile):
    """16 MB of block pairs in one task come in batches of about 8 MB at most."""
    from pyspark.sql import functions as F

    from chatframe.operators import bertscore as bs
    from chatframe.session import ARROW_BYTES
    toks = spark.range(40 * 2 * 512).select(
        F.floor(F.col("id") / 1024).alias("pair_id"), F.when(F.col("id") % 2 == 0, "base").otherwise("ref").alias("side"),
        (F.col("id") % 1024 / 2).cast("long").alias("tok_id"), F.array_repeat(F.lit(1.0).cast("float"), 96).alias("vec"))
    of, name = (bs._block_maxima, "_block_maxima") if tile is None else (bs._tile_maxima, "_tile_maxima")
    seen = str(tmp_path / "seen")

    def watched(batches):
        def each():
            for b in batches:
                n = b.nbytes if hasattr(b, "nbytes") else sum(v.nbytes for c in ("c_vec", "r_vec", "c_tok", "r_tok") for v in b[c])
                with open(seen, "a") as f:
                    f.write(f"{n}\n")
                yield b
        return of(each())
    monkeypatch.setattr(bs, name, watched)
    before = {k: spark.conf.get(k) for k in (ARROW_BYTES, "spark.sql.shuffle.partitions")}
    spark.conf.unset(ARROW_BYTES)
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        rows = bs.bertscore(toks, tile=tile).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(rows) == 80 and all(r["f1"] == pytest.approx(float(r["variant"] == "base")) for r in rows)
    sizes = [int(x) for x in open(seen)]
    assert sum(sizes) > 15 << 20 and max(sizes) < 10 << 20
