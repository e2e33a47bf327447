"""Reply decoding truth table, prefix rule, A/B round trip
and the expected scoreboard on the fixture (FIXTURES §2.3)."""

import pytest

from chatframe.operators import judging as jd

OK = '{"model_a": {"correctness": 7, "completeness": 5}, "model_b": {"correctness": 3, "completeness": 9}}'


def score(spark, replies, base_is_a=True):
    df = spark.createDataFrame([(i, r, base_is_a) for i, r in enumerate(replies)],
                               "sample_id long, reply string, base_is_a boolean")
    return [r.asDict() for r in jd.score_replies(df, call_error=None).orderBy("sample_id").collect()]


def test_decode_truth_table(spark):
    replies = [
        OK,
        "```json\n" + OK + "\n```",
        "  ```\n" + OK + "\n``` ",
        OK + " extra",
        OK + " " + OK,
        OK.replace('"', "'"),
        '{"model_a": {"correctness": NaN}}',
        "",
        OK + "," + OK,
        '{"model_a": {"correctness": 1}}',
        None,
    ]
    rows = score(spark, replies)
    errs = [r["error"] for r in rows]
    assert errs == [None, None, None, "bad_json", "bad_json", "bad_json", "bad_json", "bad_json",
                    "bad_json", "missing_model", "call_failed"]
    assert (rows[0]["base_correctness"], rows[0]["lora_correctness"],
            rows[0]["base_completeness"], rows[0]["lora_completeness"]) == (7.0, 3.0, 5.0, 9.0)


def test_prefix_rule_and_types(spark):
    replies = [
        '{"model_a": {"correctness": 7, "completeness": 5}, "model_b": {"correctness": 3}}',
        '{"model_a": {"correctness": "8", "completeness": 5}, "model_b": {"correctness": 3, "completeness": 1}}',
        '{"model_a": {"correctness": true, "completeness": 5}, "model_b": {"correctness": 3, "completeness": 1}}',
        '{"model_a": {"correctness": 7.5, "completeness": null}, "model_b": {"correctness": 3, "completeness": 1}}',
    ]
    rows = score(spark, replies)
    assert rows[0]["error"] == "missing_score"
    assert (rows[0]["base_correctness"], rows[0]["lora_correctness"], rows[0]["base_completeness"],
            rows[0]["lora_completeness"]) == (7.0, 3.0, 5.0, None)
    assert rows[1]["error"] == "bad_score_type" and rows[1]["base_correctness"] is None
    assert rows[2]["error"] == "bad_score_type"
    assert rows[3]["error"] == "bad_score_type"
    assert (rows[3]["base_correctness"], rows[3]["lora_correctness"], rows[3]["base_completeness"]) == \
        (7.5, 3.0, None)


def test_unblind_round_trip(spark):
    a = score(spark, [OK], base_is_a=True)[0]
    b = score(spark, [OK], base_is_a=False)[0]
    assert (a["base_correctness"], a["lora_correctness"]) == (b["lora_correctness"], b["base_correctness"])


def test_fixture_scoreboard_sf0001(spark):
    from chatframe.plans.catalog import judge_scoreboard, judge_total
    from chatframe.sources import fixtures as fx
    got = {"base": {"correctness": [], "completeness": []}, "lora": {"correctness": [], "completeness": []}}
    evaluated = 0
    for r in fx.sft(spark, "/root/testdata/sf0.001").select("sample_id").collect():
        conv, turn = map(int, r["sample_id"].split(":"))
        n = conv * 100 + turn
        if n % 13 in (2, 4, 5, 6, 7, 8):  # nothing of these replies counts
            continue
        evaluated += n % 13 != 3
        got["base"]["correctness"].append(1 + ((n % 97) * 7) % 10)
        got["lora"]["correctness"].append(1 + ((n % 89) * 3 + 4) % 10)
        got["base"]["completeness"].append(1 + ((n % 83) * 9 + 1) % 10)
        if n % 13 != 3:
            got["lora"]["completeness"].append(1 + ((n % 79) * 7 + 7) % 10)
    for r in judge_scoreboard(spark, "/root/testdata/sf0.001").collect():
        for v in ("base", "lora"):
            x = got[v][r["dimension"]]
            assert r[v] == pytest.approx(sum(x) / len(x), abs=1e-6)
    assert judge_total(spark, "/root/testdata/sf0.001").first()["n_evaluated"] == evaluated


@pytest.mark.parametrize("tail", ["] the end", "],[1", "]]", '],"x"', ',"x"', "]//"])
def test_text_after_the_reply_is_an_error(spark, tail):
    row = score(spark, [OK + tail, "```\n" + OK + "]\nHope this helps\n```"])
    assert [r["error"] for r in row] == ["bad_json", "bad_json"] and row[0]["base_correctness"] is None


def test_input_columns_comments_and_messages_stay(spark):
    told = OK.replace('"correctness": 7', '"comment": "good", "correctness": 7')
    df = spark.createDataFrame([(1, told, True, None, "u", "v"), (2, None, True, "boom", "u", "v")],
                               "sample_id long, reply string, base_is_a boolean, error string, _s string, _doc string")
    a, b = jd.score_replies(df).orderBy("sample_id").collect()
    assert (a["_s"], a["_doc"], a["base_comment"], a["lora_comment"], a["error"]) == ("u", "v", "good", None, None)
    assert (b["error"], b["call_message"]) == ("call_failed", "boom")


def test_atomic_and_mean_of_means(spark):
    part = '{"model_a": {"correctness": 7, "completeness": 5}, "model_b": {"correctness": 3}}'
    df = spark.createDataFrame([(1, OK, True), (2, part, True)], "sample_id long, reply string, base_is_a boolean")
    strict = jd.score_replies(df, atomic=True).where("sample_id = 2").first()
    assert strict["base_correctness"] is None and strict["error"] == "missing_score"
    wide = jd.scoreboard_wide(jd.score_replies(df), mean_of_means=True).first()
    assert wide["lora_total"] == pytest.approx((3 + 9) / 2) and wide["base_total"] == pytest.approx(6)


def test_scoring_plan_is_narrow(spark):
    df = spark.createDataFrame([(1, OK, True)], "sample_id long, reply string, base_is_a boolean")
    plan = jd.score_replies(df, call_error=None)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
