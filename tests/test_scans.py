"""Ordered scans and histories over range partitions, against plain loops:
null and sparse keys, ties, and conversations that fill many partitions."""

import random

import pytest
from pyspark.sql import functions as F

from chatframe.operators import context as ctx
from chatframe.operators.scans import ordered_scan

SCHEMA = "conv_id long, turn long, role string, text string"
LAYOUTS = [(None, 4096), (7, 5), (40, 1)]


def turns_with_nulls(seed, hot=250):
    """Epoch-millisecond turns, null turns and conversations, one hot conversation."""
    rng = random.Random(seed)
    rows = []
    for conv in [None, *range(12)]:
        seen = set()
        for i in range(hot if conv == 5 else rng.randint(1, 14)):
            at = rng.randrange(10 ** 12, 2 * 10 ** 12)
            if at in seen:
                continue
            seen.add(at)
            n = rng.choice([0, 0, 0, 1, 2, 3, 12])
            rows.append([conv, at, rng.choice(["user", "assistant", "system"]), " ".join(f"w{rng.randrange(9)}" for _ in range(n))])
        if rng.random() < 0.7:
            rows[-1][1] = None
    rng.shuffle(rows)
    return [tuple(r) for r in rows]


def conversations(rows):
    out = {}
    for r in rows:
        out.setdefault(r[0], []).append(r)
    for v in out.values():
        v.sort(key=lambda r: (r[1] is not None, r[1] or 0))
    return out


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("partitions,chunk", LAYOUTS)
def test_scan_keeps_every_row(spark, partitions, chunk, descending):
    rows = turns_with_nulls(1)
    rows += rows[:5]  # repeated rows
    df = spark.createDataFrame(rows, SCHEMA)
    out = ordered_scan(df, "conv_id", "turn", sums={"n": F.length("text")}, nexts=["role", "turn"],
                       descending=descending, chunk_size=chunk, partitions=partitions)
    assert out.columns == [*df.columns, "pos", "cum_n", "next_role", "next_turn"]
    got = {}
    for r in out.collect():
        got.setdefault(r["conv_id"], []).append(r)
    assert {k: len(v) for k, v in got.items()} == {k: len(v) for k, v in conversations(rows).items()}
    for rs in got.values():
        rs.sort(key=lambda r: r["pos"])
        assert [r["pos"] for r in rs] == list(range(len(rs)))
        turns = [-1 if r["turn"] is None else r["turn"] for r in rs]
        assert turns == sorted(turns, reverse=descending)
        total = 0
        for i, r in enumerate(rs):
            total += len(r["text"])
            follow = (rs[i + 1]["role"], rs[i + 1]["turn"]) if i + 1 < len(rs) else (None, None)
            assert r["cum_n"] == total and (r["next_role"], r["next_turn"]) == follow


def test_scan_by_several_keys_of_other_types(spark):
    rows = [(a, b, o) for a in ("x", None, "y") for b in (1.5, None) for o in ("k3", "k1", None, "k2")]
    df = spark.createDataFrame(rows, "a string, b double, o string").withColumn("extra", F.create_map(F.lit("m"), "b"))
    out = ordered_scan(df, ["a", "b"], "o", sums={"one": F.lit(1)}, partitions=9).collect()
    assert len(out) == 24 and all(r["pos"] == [None, "k1", "k2", "k3"].index(r["o"]) and r["cum_one"] == r["pos"] + 1 for r in out)


def test_empty_scans(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert ordered_scan(df, "conv_id", "turn", sums={"n": F.lit(1)}, nexts=["role"]).count() == 0
    assert ctx.context_at_turn(df, 5).count() == ctx.prompts_for_turns(df, 5).count() == 0
    assert ctx.conversations_to_sft(df).count() == 0


def loop(rows, budget, most, session=False):
    """The chat loop: append, then drop the oldest while over budget or too many."""
    out = {}
    for conv, rs in conversations(rows).items():
        held = []
        for _, turn, role, text in rs:
            if session and role == "user":
                text = text.strip()
                if text.lower() in ("exit", "quit"):
                    break
                if not text:
                    continue
            held.append((turn, role, text, len(text.split())))
            while held and (sum(h[3] for h in held) > budget or len(held) > most):
                held.pop(0)
            out[conv, turn] = list(held)
    return out


@pytest.mark.parametrize("partitions,chunk", LAYOUTS)
@pytest.mark.parametrize("budget,most", [(7, 4096), (30, 6), (10 ** 6, 4096)])
def test_contexts_equal_the_loop(spark, partitions, chunk, budget, most):
    rows = turns_with_nulls(budget)
    df = spark.createDataFrame(rows, SCHEMA)
    out = ctx.context_at_turn(df, budget, chunk_size=chunk, partitions=partitions, max_messages=most)
    got = {(r["conv_id"], r["turn"]): (r["first_turn"], r["n_messages"], r["n_tokens"]) for r in out.collect()}
    want = {k: (h[0][0] if h else None, len(h), sum(x[3] for x in h)) for k, h in loop(rows, budget, most).items()}
    assert got == want and out.count() == len(rows)


@pytest.mark.parametrize("partitions,chunk", LAYOUTS)
def test_messages_and_sessions_equal_the_loop(spark, partitions, chunk):
    rng = random.Random(3)
    rows = [(c, t, r, rng.choice(["exit", " Quit "]) if rng.random() < 0.02 else x) for c, t, r, x in turns_with_nulls(9)]
    df = spark.createDataFrame(rows, SCHEMA)
    layout = {"chunk_size": chunk, "partitions": partitions}
    want = loop(rows, 20, 50, session=True)
    out = ctx.prompts_for_turns(df, 20, max_messages=50, **layout).collect()
    users = {(c, t) for c, t, r, _ in rows if r == "user"} & set(want)
    assert {(r["conv_id"], r["turn"]): r["n_messages"] for r in out} == {k: len(want[k]) for k in users}
    for r in out:
        for _, _, text, _ in want[r["conv_id"], r["turn"]]:
            assert text in r["prompt"]
    plain = loop(rows, 20, 50)
    got = {}
    for r in ctx.context_messages(df, 20, max_messages=50, **layout).collect():
        got.setdefault((r["conv_id"], r["at_turn"]), []).append((r["pos"], r["turn"], r["role"], r["text"]))
    assert set(got) == set(plain)
    for k, held in plain.items():
        messages = [(len(held) - 1 - i, t, r, x) for i, (t, r, x, _) in enumerate(held)]
        assert sorted(got[k], key=str) == sorted(messages or [(None, None, None, None)], key=str)
    kept = {(r["conv_id"], r["turn"]) for r in ctx.session_filter(df, **layout).collect()}
    assert kept == set(want)
    clipped = {(r["conv_id"], r["turn"]) for r in ctx.clip_history(df, 20, **layout).collect()}
    assert clipped == {(c, h[0]) for c, rs in conversations(rows).items() for h in loop(rows, 20, 10 ** 6)[c, rs[-1][1]]}


@pytest.mark.parametrize("partitions,chunk", LAYOUTS)
def test_sft_pairs_equal_the_loop(spark, partitions, chunk):
    rows = turns_with_nulls(5)
    want = []
    for conv, rs in conversations(rows).items():
        system = max((x for _, _, r, x in rs if r == "system"), default="")
        want += [(":".join(str(k) for k in (conv, a[1]) if k is not None), system, a[3], b[3])
                 for a, b in zip(rs, rs[1:], strict=False) if (a[2], b[2]) == ("user", "assistant")]
    got = ctx.conversations_to_sft(spark.createDataFrame(rows, SCHEMA), chunk_size=chunk, partitions=partitions).collect()
    assert sorted(tuple(r) for r in got) == sorted(want)


def test_many_messages_without_tokens(spark):
    """3,001 of them are no 3,001-message prompt."""
    rows = [(1, i, "user" if i % 2 else "assistant", "!" if i % 2 else "") for i in range(3001)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("text", F.lit("​"))
    out = ctx.histories(df.withColumn("n_tokens", F.lit(0)), 10, max_messages=100, wanted=F.lit(True), partitions=6)
    sizes = [r[0] for r in out.selectExpr("size(items)").collect()]
    assert len(sizes) == 3001 and max(sizes) == 100


def test_one_scan_of_the_source_and_a_hot_conversation_is_spread(spark, tmp_path):
    rows = [(9, 10 ** 12 + 977 * t, "user" if t % 2 else "assistant", "x " * (t % 4)) for t in range(4000)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    out = ordered_scan(df, "conv_id", "turn", sums={"n": F.lit(1)}, partitions=8)
    part = spark.read.parquet(out.inputFiles()[0].rsplit("/", 1)[0]).where("NOT edge").groupBy("part").count().collect()
    assert len(part) == 8 and max(r["count"] for r in part) < 1500  # sampled bounds
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "Exchange hashpartitioning" not in plan
    from chatframe.operators import scans
    plan = scans.in_order(df, [F.col("conv_id").asc(), F.col("turn").asc()], df.columns)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange rangepartitioning") == 1


def test_a_tokenizer_is_called_once_a_text(spark, tmp_path):
    calls = str(tmp_path / "calls")

    def tokenizer():
        def split(text):
            with open(calls, "a") as f:
                f.write(text + "\n")
            return text.split("a")
        return split

    texts = ["banana", "a", "xyz", "data data", "banana"]
    rows = [(c, t, "user", texts[(c + t) % 5]) for c in range(6) for t in range(9)]
    df = spark.createDataFrame(rows, SCHEMA)
    out = ctx.prompts_for_turns(df, 9, tokenizer_factory=tokenizer, partitions=4).collect()
    assert len(out) == 54 and sorted(open(calls).read().split("\n")) == sorted({*texts, ""})
    n = {t: len(t.split("a")) for t in texts}
    got = {(r["conv_id"], r["turn"]): r["n_tokens"] for r in ctx.context_at_turn(df, 10 ** 6, tokenizer).collect()}
    assert got == {(c, t): sum(n[texts[(c + i) % 5]] for i in range(t + 1)) for c in range(6) for t in range(9)}
