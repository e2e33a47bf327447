"""State in streams: idle sessions, null turns, conversations larger than an
Arrow batch, and boards after every micro-batch."""

import random
import time

import pytest
from pyspark.sql import functions as F

from chatframe.operators import judging as jd
from chatframe.operators.context import context_at_turn
from chatframe.schemas import TURN
from chatframe.session import work_dir
from chatframe.streaming.context import stream_context
from chatframe.streaming.runner import run_append
from chatframe.streaming.scoreboard import board, best_replies, run_boards, stream_tallies


def arrive(spark, path, rows, schema=TURN):
    spark.createDataFrame(rows, schema).write.mode("append").parquet(path)
    return spark.readStream.schema(schema).parquet(path)


def by_turn(df):
    return {(r["conv_id"], r["turn"]): (r["status"], r["first_turn"], r["n_messages"], r["n_tokens"])
            for r in df.where("status <> 'idle'").collect()}


# ------------------------------------------------------------------- sessions ---
def test_null_turns_have_their_own_status(spark):
    src, base = work_dir(spark, "turns"), work_dir(spark, "nulls")
    run_append(stream_context(arrive(spark, src, [(1, None, "user", "exit"), (1, 5, "user", "a b"), (None, 1, "user", "c")]), 9), "s", base)
    out = run_append(stream_context(arrive(spark, src, [(1, 6, "assistant", "d"), (1, None, None, None), (None, 2, "user", "e")]), 9), "s", base)
    got = sorted(((r["conv_id"], r["turn"], r["status"], r["n_messages"]) for r in out.collect()), key=str)
    assert got == sorted([(1, None, "no_turn", None), (1, 5, "ok", 1), (None, 1, "ok", 1), (1, 6, "ok", 2),
                          (1, None, "no_turn", None), (None, 2, "ok", 2)], key=str)


def test_a_conversation_larger_than_an_arrow_batch(spark):
    """Unsorted turns of one conversation, over many batches of one micro-batch."""
    rng = random.Random(2)
    rows = [(7, t, "user" if t % 2 else "assistant", "x " * rng.choice([0, 1, 2, 5]) + ("y" if t % 2 else "")) for t in range(6000)]
    rng.shuffle(rows)
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        src, base = work_dir(spark, "turns"), work_dir(spark, "hot")
        first, second = [r for r in rows if r[1] < 4000], [r for r in rows if r[1] >= 4000]
        for part in (first, second):
            out = run_append(stream_context(arrive(spark, src, part), 11), "s", base)
        got = by_turn(out)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    want = {(r["conv_id"], r["turn"]): ("ok", r["first_turn"], r["n_messages"], r["n_tokens"])
            for r in context_at_turn(spark.createDataFrame(rows, TURN), 11).collect()}
    assert got == want


def test_idle_sessions_end(spark):
    """The timer reports the session and gives its state up; a later turn starts anew."""
    src, base = work_dir(spark, "turns"), work_dir(spark, "idle")
    run_append(stream_context(arrive(spark, src, [(1, 0, "user", "a b"), (1, 1, "assistant", "c"), (2, 0, "user", "quit")]),
                              9, idle_s=0.5), "s", base)
    time.sleep(1)
    out = run_append(stream_context(arrive(spark, src, [(3, 0, "user", "z")]), 9, idle_s=0.5), "s", base)
    idle = {r["conv_id"]: (r["turn"], r["first_turn"], r["n_messages"], r["n_tokens"]) for r in out.where("status = 'idle'").collect()}
    assert idle[1] == (1, 0, 2, 3) and idle[2] == (0, None, 0, 0) and 3 not in idle
    out = run_append(stream_context(arrive(spark, src, [(1, 2, "user", "again"), (2, 1, "user", "back")]), 9, idle_s=60), "s", base)
    got = by_turn(out)
    assert got[1, 2] == ("ok", 2, 1, 1) and got[2, 1] == ("ok", 1, 1, 1) and got[1, 1] == ("ok", 0, 2, 3)


def test_messages_are_bounded(spark):
    rows = [(1, t, "assistant", "") for t in range(50)]
    out = run_append(stream_context(arrive(spark, work_dir(spark, "turns"), rows), 9, max_messages=8), "s")
    assert max(v[2] for v in by_turn(out).values()) == 8


# --------------------------------------------------------------------- boards ---
REPLY = "run_id string, sample_id string, base_is_a boolean, reply string, error string, n int"
COLS = ["base_correctness", "lora_correctness", "base_completeness", "lora_completeness", "base_total", "lora_total"]


def reply(rng):
    def side():
        s = {"correctness": round(rng.uniform(0, 10), 2), "completeness": rng.randint(1, 10)}
        if rng.random() < 0.1:
            del s["completeness"]
        return "{" + ", ".join(f'"{k}": {v}' for k, v in s.items()) + "}"
    return rng.choice(["no json", None]) if rng.random() < 0.15 else f'{{"model_a": {side()}, "model_b": {side()}}}'


def batch_board(spark, rows):
    best = best_replies(spark.createDataFrame(rows, REPLY), at=F.col("n"))
    wide = jd.scoreboard_wide(jd.score_replies(best), group=["run_id"])
    return {r["run_id"]: [*[round(r[c], 9) for c in COLS], r["n_evaluated"], r["n_failed"]] for r in wide.collect()}


def test_the_board_after_each_micro_batch(spark):
    """Retries, better and worse replies, failures: retracted and added."""
    rng = random.Random(4)
    src, base, rows = work_dir(spark, "replies"), work_dir(spark, "boards"), []
    for n in range(3):
        new = [(rng.choice("ab"), str(s), rng.random() < 0.5, r := reply(rng), None if r else "timeout", n)
               for s in rng.sample(range(30), 22)]
        rows += new
        boards = run_boards(arrive(spark, src, new, REPLY), base=base, at=F.col("n"), buckets=3)
        last = boards.agg(F.max("epoch")).first()[0]
        got = {r["run"]: [*[round(r[c], 9) for c in COLS], r["n_evaluated"], r["n_failed"]]
               for r in boards.where(F.col("epoch") == last).collect()}
        assert got == batch_board(spark, rows)
    assert boards.select("epoch").distinct().count() == 3


def test_state_ends_with_its_run(spark):
    good = '{"model_a": {"correctness": 7, "completeness": 5}, "model_b": {"correctness": 3, "completeness": 9}}'
    src, base = work_dir(spark, "replies"), work_dir(spark, "ends")
    parts = [[("a", "1", True, good, None, 0), ("b", "1", True, good, None, 0)],
             [("a", "2", False, good, None, 1), ("a", None, None, None, None, 1)],
             [("a", "3", True, good, None, 2), ("b", "2", True, good, None, 2)]]
    for rows in parts:
        boards = run_boards(arrive(spark, src, rows, REPLY), base=base, at=F.col("n"), buckets=2)
    last = boards.agg(F.max("epoch")).first()[0]
    got = {r["run"]: (r["n_evaluated"], r["base_correctness"], r["over"]) for r in boards.where(F.col("epoch") == last).collect()}
    assert got == {"a": (2, 5.0, True), "b": (2, 7.0, False)}  # a's third reply came after its end


@pytest.mark.parametrize("buckets", [1, 5])
def test_tallies_of_a_batch(spark, buckets):
    rng = random.Random(9)
    rows = [("r", str(rng.randrange(12)), True, reply(rng), None, n) for n in range(60)]
    t = stream_tallies(spark.createDataFrame(rows, REPLY), at=F.col("n"), buckets=buckets)
    got = {r["run"]: [*[round(r[c], 9) for c in COLS], r["n_evaluated"], r["n_failed"]] for r in board(t).collect()}
    assert got == batch_board(spark, rows)
