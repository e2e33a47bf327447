"""Conversation operators against literal Python versions of the chat loop
on random conversations (zero-token and over-budget messages included), with
a tiny chunk size so the chunked scans cross many chunk boundaries."""

import random

from chatframe.operators import context as ctx
from chatframe.streaming.context import stream_context

BUDGET = 7


def random_turns(seed=7, convs=40):
    rng = random.Random(seed)
    rows = []
    for c in range(convs):
        n = rng.randint(1, 25)
        turns = sorted(rng.sample(range(0, 60), n))
        for i, t in enumerate(turns):
            words = rng.choice([0, 0, 1, 2, 3, 5, 8, 12])
            text = " ".join(f"w{j}" for j in range(words)) or rng.choice(["", "  "])
            rows.append((c, t, "user" if i % 2 == 0 else "assistant", text))
    return rows


def loop_context(rows, budget):
    """The chat loop: append, then drop oldest while over budget."""
    out = {}
    by_conv = {}
    for c, t, role, text in sorted(rows):
        by_conv.setdefault(c, []).append((t, len(text.split())))
    for c, msgs in by_conv.items():
        conv = []
        for t, n in msgs:
            conv.append((t, n))
            while conv and sum(x[1] for x in conv) > budget:
                conv.pop(0)
            out[(c, t)] = (conv[0][0] if conv else None, len(conv), sum(x[1] for x in conv))
    return out


def test_context_at_turn_equals_loop(spark):
    rows = random_turns()
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {(r["conv_id"], r["turn"]): (r["first_turn"], r["n_messages"], r["n_tokens"])
           for r in ctx.context_at_turn(df, BUDGET, chunk_size=4).collect()}
    assert got == loop_context(rows, BUDGET)


def test_stream_context_equals_loop(spark):
    """Turns arrive in three micro-batches (by turn range); the state carries
    each conversation's retained history across batches."""
    from chatframe.schemas import TURN
    from chatframe.session import work_dir
    from chatframe.streaming.runner import run_append
    rows = random_turns(seed=11)
    src = work_dir(spark, "turns")
    for k, (lo, hi) in enumerate([(0, 20), (20, 40), (40, 60)]):
        part = [r for r in rows if lo <= r[1] < hi]
        spark.createDataFrame(part, TURN).coalesce(1).write.parquet(f"{src}/part={k}")
    stream = spark.readStream.schema(TURN).option("maxFilesPerTrigger", 1) \
                  .option("recursiveFileLookup", "true").parquet(src)
    out = run_append(stream_context(stream, BUDGET), "ctx-test")
    got = {(r["conv_id"], r["turn"]): (r["first_turn"], r["n_messages"], r["n_tokens"])
           for r in out.where("status = 'ok'").collect()}
    kept = [r for r in rows if r[2] != "user" or r[3].strip()]
    assert got == loop_context(kept, BUDGET) and out.count() == len(rows)


def test_stream_session_rules_and_late_turns(spark):
    from chatframe.schemas import TURN
    from chatframe.session import work_dir
    from chatframe.streaming.runner import run_append
    src = work_dir(spark, "turns")
    for part in ([(1, 1, "assistant", "a b"), (1, 2, "user", "  "), (2, 0, "user", " Exit ")],
                 [(1, 0, "user", "x"), (1, 3, "user", None), (1, 4, "user", "c"), (2, 1, "user", "y")],
                 [(1, 5, "user", "QUIT"), (1, 6, "user", "z")]):
        spark.createDataFrame(part, TURN).coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(TURN).option("maxFilesPerTrigger", 1).parquet(src)
    out = run_append(stream_context(stream, BUDGET), "ctx-rules")
    got = {(r["conv_id"], r["turn"]): (r["status"], r["n_messages"], r["n_tokens"]) for r in out.collect()}
    assert {k: v[0] for k, v in got.items()} == {
        (1, 1): "ok", (1, 2): "blank", (2, 0): "ended", (1, 0): "late", (1, 3): "blank", (1, 4): "ok", (2, 1): "ended",
        (1, 5): "ended", (1, 6): "ended"}
    assert got[(1, 4)] == ("ok", 2, 3)


def test_stream_retry_counts_as_success(spark):
    from pyspark.sql import functions as F

    from chatframe.operators import judging as jd
    from chatframe.session import work_dir
    from chatframe.streaming.runner import run_update
    from chatframe.streaming.scoreboard import best_replies
    good = '{"model_a": {"correctness": 7, "completeness": 5}, "model_b": {"correctness": 3, "completeness": 9}}'
    schema, src = "run_id string, sample_id string, base_is_a boolean, reply string, error string, n int", work_dir(spark, "r")
    for part in ([("a", "1", True, None, "timeout", 0), ("a", "2", True, good, None, 0), ("b", "1", True, "no", None, 0)],
                 [("a", "1", True, good, None, 1), ("a", "2", True, None, "late failure", 1)]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
    best = run_update(best_replies(stream, at=F.col("n")), "best", ["run_id", "sample_id"])
    rows = {(r["run_id"], r["sample_id"]): r["error"] for r in jd.score_replies(best).collect()}
    assert rows == {("a", "1"): None, ("a", "2"): None, ("b", "1"): "bad_json"}


def test_clip_history_equals_loop(spark):
    rows = random_turns(seed=3)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {(r["conv_id"], r["turn"]) for r in ctx.clip_history(df, BUDGET, chunk_size=4).collect()}
    want = set()
    by_conv = {}
    for c, t, role, text in sorted(rows):
        by_conv.setdefault(c, []).append((t, len(text.split())))
    for c, msgs in by_conv.items():
        conv = list(msgs)
        while conv and sum(x[1] for x in conv) > BUDGET:
            conv.pop(0)
        want |= {(c, t) for t, _ in conv}
    assert got == want


def test_budget_examples(spark):
    df = spark.createDataFrame([(1, 0, "user", "a b c"), (1, 1, "assistant", "d e f"), (1, 2, "user", "g h"),
                                (2, 0, "user", "x"), (2, 1, "assistant", "1 2 3 4 5 6 7 8 9")],
                               "conv_id long, turn long, role string, text string")
    kept = sorted((r["conv_id"], r["turn"]) for r in ctx.clip_history(df, 5).collect())
    assert kept == [(1, 1), (1, 2)]


def test_session_filter(spark):
    df = spark.createDataFrame([(1, 0, "user", "hi"), (1, 1, "user", " Quit "), (1, 2, "user", "more"),
                                (2, 0, "user", "   "), (2, 1, "assistant", "ok")],
                               "conv_id long, turn long, role string, text string")
    got = sorted((r["conv_id"], r["turn"], r["text"]) for r in ctx.session_filter(df, chunk_size=2).collect())
    assert got == [(1, 0, "hi"), (2, 1, "ok")]


def test_sft_lead_across_chunks(spark):
    rows = [(1, t, "user" if t % 2 == 0 else "assistant", f"m{t}") for t in range(11)]
    rows.append((1, 11, "system", "sys"))
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = sorted((r["sample_id"], r["instruction"], r["input"], r["output"])
                 for r in ctx.conversations_to_sft(df, chunk_size=3).collect())
    want = [(f"1:{t}", "sys", f"m{t}", f"m{t + 1}") for t in range(0, 10, 2)]
    assert got == want


def test_sft_keys_are_injective(spark):
    rows = [(1, 100, "user", "a"), (1, 101, "assistant", "b"), (2, 0, "user", "c"), (2, 1, "assistant", "d")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert sorted(r["sample_id"] for r in ctx.conversations_to_sft(df).collect()) == ["1:100", "2:0"]


def test_null_user_text_is_blank(spark):
    rows = [(1, 0, "user", None), (1, 1, "assistant", None), (1, 2, "user", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert sorted(r["turn"] for r in ctx.session_filter(df).collect()) == [1, 2]


def test_hot_conversation_is_chunked(spark):
    """One conversation with thousands of turns (a hot key): the result still
    equals the loop, and the scan's per-chunk windows stay bounded."""
    import random as _r
    rng = _r.Random(5)
    rows = [(9, t, "user" if t % 2 == 0 else "assistant",
             " ".join("x" for _ in range(rng.choice([0, 1, 2, 3])))) for t in range(3000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {(r["conv_id"], r["turn"]): (r["first_turn"], r["n_messages"], r["n_tokens"])
           for r in ctx.context_at_turn(df, BUDGET, chunk_size=64).collect()}
    assert got == loop_context(rows, BUDGET)
    plan = ctx.context_at_turn(df, BUDGET, chunk_size=64)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = ctx.context_at_turn(df, BUDGET)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") <= 6
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_prompts_respect_session_rules(spark):
    """Blank user turns are skipped and 'exit' ends the session before the
    history clip, exactly like the chat loop."""
    rows = [(1, 0, "user", "a b"), (1, 1, "assistant", "c d e"), (1, 2, "user", "   "),
            (1, 3, "user", "f"), (1, 4, "assistant", "g h i j"), (1, 5, "user", " EXIT "),
            (1, 6, "user", "never")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r["turn"]: (r["n_messages"], r["prompt"]) for r in ctx.prompts_for_turns(df, 5, chunk_size=2).collect()}
    assert sorted(got) == [0, 3]
    assert got[0][0] == 1 and got[3][0] == 2          # [a b] ; [c d e, f] (a b evicted: 2+3+1 > 5)
    assert "c d e" in got[3][1] and "a b" not in got[3][1]
