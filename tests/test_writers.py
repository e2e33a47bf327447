"""Sinks: table and document forms, the either-scores-or-error detail shape,
the 200-character cut, keys from source to scores."""

import json

import pytest
from pyspark.sql import functions as F

from chatframe.operators import judging as jd
from chatframe.operators.bertscore import result_details
from chatframe.operators.reports import side_by_side
from chatframe.operators.sampling import sample_k
from chatframe.plans.catalog import text_scores
from chatframe.session import work_dir
from chatframe.sources import writers as w
from chatframe.sources.readers import questions, read_answers, read_sft

OK = '{"model_a": {"correctness": 7, "completeness": 5}, "model_b": {"correctness": 3, "completeness": 9}}'


def read_doc(spark, path):
    return json.loads("".join(r["value"] for r in spark.read.text(path).collect()))


def test_judge_document_shape(spark):
    df = spark.createDataFrame([(1, "q1", OK, True), (2, "q2", "nope", False)],
                               "sample_id long, question string, reply string, base_is_a boolean")
    scored = jd.score_replies(df, call_error=None)
    path = work_dir(spark, "judge-doc")
    w.write_judge_results(scored, {"judge_model": "stand-in", "seed": 42}, path, document=True)
    doc = read_doc(spark, path)
    assert list(doc)[:2] == ["config", "summary"]
    assert doc["summary"]["correctness"] == {"base": 7.0, "lora": 3.0, "diff": -4.0}
    assert doc["total"] == {"base": 6.0, "lora": 6.0} and doc["config"]["num_evaluated"] == 1
    ok, bad = doc["details"]
    assert set(ok) == {"sample_id", "question", "base_scores", "lora_scores"}
    assert set(bad) == {"sample_id", "question", "error"} and bad["error"] == "bad_json"


def test_bertscore_document_cut(spark):
    long = "字" * 300
    df = spark.createDataFrame([(0, "q", long, long, long, 0.5, 0.7, 0.2, 0.4, 0.6, 0.6, 0.8)],
                               "pair_id long, question string, reference string, base_pred string, "
                               "lora_pred string, base_f1 double, lora_f1 double, f1_diff double, "
                               "base_precision double, base_recall double, lora_precision double, "
                               "lora_recall double")
    path = work_dir(spark, "bs-doc")
    w.write_bertscore_results(df, {"seed": 42}, path, document=True)
    doc = read_doc(spark, path)
    assert len(doc["details"][0]["reference"]) == 200
    assert doc["summary"]["base"]["precision"] == pytest.approx(0.4)


def test_answers_round_trip(spark, tmp_path):
    rows = [(f"{i}:{i % 3}", "i", 'q "x"\n, y', "r", None if i == 4 else "b", "l") for i in range(300)]
    df = spark.createDataFrame(rows, "sample_id string, instruction string, question string, reference string, "
                               "base_answer string, lora_answer string").repartition(5)
    for document in (False, True):
        path = work_dir(spark, "answers")
        w.write_answers(df, {"seed": 42}, path, document=document)
        assert sorted(tuple(r) for r in read_answers(spark, path).collect()) == sorted(rows)
    doc = read_doc(spark, path)
    assert [a["sample_id"] for a in doc["answers"]] == sorted(r[0] for r in rows) and doc["config"] == {"seed": 42}
    one = tmp_path / "answers.json"
    one.write_text(json.dumps(doc, indent=2))
    assert sorted(tuple(r) for r in read_answers(spark, str(one)).collect()) == sorted(rows)


def test_empty_document(spark):
    df = spark.createDataFrame([], "sample_id string, instruction string, question string, reference string, "
                               "base_answer string, lora_answer string")
    path = work_dir(spark, "answers")
    w.write_answers(df, {}, path, document=True)
    assert read_doc(spark, path) == {"config": {}, "answers": []} and read_answers(spark, path).count() == 0


def test_read_sft_keeps_or_makes_keys(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"sample_id": "x", "instruction": "i", "input": "q", "output": "o"}\n'
                                     '{"instruction": "i", "input": "q2", "output": "o"}\n' * 1)
    (tmp_path / "b.csv").write_text('instruction,input,output\ni,"a ""b""\nc",o\ni,"a ""b""\nc",o\n')
    a = read_sft(spark, str(tmp_path / "a.json"), "json").collect()
    assert {r["sample_id"] for r in a if r["input"] == "q"} == {"x"} and all(r["sample_id"] for r in a) and len(a) == 2
    b = read_sft(spark, str(tmp_path / "b.csv"), "csv").collect()
    assert len({r["sample_id"] for r in b}) == 2 and {r["input"] for r in b} == {'a "b"\nc'}
    assert questions(spark, []).count() == 2 and [r["question"] for r in questions(spark, ["a"]).collect()] == ["a"]


def test_from_source_to_scores_without_ids(spark, tmp_path):
    """A dataset without keys runs through sample, answers, numbering and scores."""
    rows = "".join(json.dumps({"instruction": "i", "input": f"q{i}", "output": f"w{i} same"}) + "\n" for i in range(20))
    (tmp_path / "s.json").write_text(rows)
    s = sample_k(read_sft(spark, str(tmp_path / "s.json"), "json"), 8)
    a = s.select("sample_id", "instruction", F.col("input").alias("question"), F.col("output").alias("reference"),
                 F.lit("same").alias("base_answer"), F.col("output").alias("lora_answer"))
    path = work_dir(spark, "answers")
    w.write_answers(a, {}, path)
    back = read_answers(spark, path)
    assert sorted(r["question_no"] for r in side_by_side(back).collect()) == list(range(1, 9))
    d = result_details(back, text_scores(spark, "", back)).collect()
    assert len(d) == 8 and all(r["lora_f1"] == pytest.approx(1) for r in d)


# ------------------------------------------------------------ nested documents ---
TRICKY = ['{"', 'a {"', '"sample_id":', '{"sample_id": "x"}', "\\", '\\"', "ünï 日本 😀", "]}", "a\nb\t", "", '{ "question" : ', "x" * 70_000]


@pytest.mark.parametrize("indent", [None, 2])
@pytest.mark.parametrize("config_first", [True, False])
def test_nested_file_is_read_by_several_tasks(spark, tmp_path, monkeypatch, indent, config_first):
    from chatframe.sources import documents as d
    rows = [{"sample_id": str(i), "instruction": TRICKY[i % len(TRICKY)], "question": TRICKY[i * 5 % len(TRICKY)],
             "reference": None if i % 7 == 0 else "r", "base_answer": f"b{i}", "lora_answer": "l"} for i in range(240)]
    config = {"num_samples": 240, "adapter_path": 'x {"answers": [', "seed": 42}
    doc = {"config": config, "answers": rows} if config_first else {"answers": rows, "config": config}
    path = tmp_path / "answers.json"
    path.write_text(json.dumps(doc, ensure_ascii=False, indent=indent), encoding="utf-8")
    got = read_answers(spark, str(path))
    assert sorted((r.asDict() for r in got.collect()), key=lambda r: int(r["sample_id"])) == rows
    for split in (7, 1000, 50_000):  # every element begins in exactly one range
        reader = d.ElementReader(str(path), d.ANSWER, split)
        parts = reader.partitions()
        parts = parts if split > 7 else parts[:3000]
        found = [x[0] for p in parts for x in reader.read(p)]
        assert found == [r["sample_id"] for r in rows][:len(found)] and (split == 7 or len(found) == 240)
    df = spark.read.format("answers_document").option("split", 200_000).load(str(path))
    assert df.rdd.getNumPartitions() > 4 and df.count() == 240


def test_a_broken_document_fails(spark, tmp_path):
    path = tmp_path / "answers.json"
    path.write_text('{"answers": [{"sample_id": "1", "question": "q"')
    with pytest.raises(Exception, match="JSONDecodeError"):
        read_answers(spark, str(path)).collect()


def test_parts_are_joined_by_several_tasks(spark, monkeypatch):
    rows = spark.range(500).select(F.format_string("%04d", "id").alias("sample_id"), *[
        F.concat(F.lit("字\n[]}{,"), F.col("id").cast("string")).alias(c) for c in w.ANSWER_COLS[1:]])
    path = work_dir(spark, "parts")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # several parts of few rows
    try:
        w.write_answers(rows, {"seed": 42}, path, document=True)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    files = sorted(spark.read.format("binaryFile").load(path).collect(), key=lambda r: r["path"])
    whole = b"".join(bytes(r["content"]) for r in files)
    assert len(files) > 1 and len(whole) > 50_000
    spark.sparkContext.setJobGroup("join", "join")
    try:
        one = w.join_parts(spark, path, split=7_000)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    status = spark.sparkContext.statusTracker()
    tasks = [status.getStageInfo(s).numTasks for j in status.getJobIdsForGroup("join") for s in status.getJobInfo(j).stageIds]
    assert max(tasks) == -(-len(whole) // 7_000)  # none of them gets more than 7,000 bytes
    assert bytes(spark.read.format("binaryFile").load(one).first()["content"]) == whole
    doc = json.loads(whole)
    assert doc["config"] == {"seed": 42} and [r["sample_id"] for r in doc["answers"]] == [f"{i:04d}" for i in range(500)]
    assert {tuple(r) for r in read_answers(spark, one).collect()} == {tuple(r) for r in rows.collect()}

    again = work_dir(spark, "parts")
    w.write_answers(rows, {"seed": 42}, again, document=True)
    monkeypatch.setattr(w, "local_path", lambda _: None)  # as on a file system that only Spark can open
    doc = read_doc(spark, w.join_parts(spark, again))
    assert doc["config"] == {"seed": 42} and sorted(r["sample_id"] for r in doc["answers"]) == [f"{i:04d}" for i in range(500)]


def test_slices_hold_every_byte_once():
    for split in (1, 3, 10, 100):
        found = w._slices([("a", 7), ("b", 0), ("c", 25), ("d", 3)], split)
        assert [to for to, _ in found] == list(range(0, 35, split)) and all(sum(n for *_, n in p) <= split for _, p in found)
        assert [(f, at + i) for _, p in found for f, at, n in p for i in range(n)] == [
            (f, i) for f, size in (("a", 7), ("c", 25), ("d", 3)) for i in range(size)]


def test_the_nested_file_has_no_single_writer(spark, tmp_path, monkeypatch):
    """No step of the query brings all rows into one partition."""
    from chatframe.plans.catalog import answers_nested
    turns = [(c, t, ("user", "assistant")[t % 2], f"text {c} {t}") for c in range(40) for t in range(4)]
    spark.createDataFrame(turns, "conv_id long, turn int, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")

    def refused(*_):
        raise AssertionError("all rows in one task")
    monkeypatch.setattr(type(spark.range(1)), "coalesce", refused)
    assert answers_nested(spark, str(tmp_path)).count() == 80
