"""Small text cases (FIXTURES §4) and Python-equivalence of strip/split."""

from pyspark.sql import functions as F

from chatframe.functions import text as tx


def one(spark, expr, value, schema="s string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("x")).first()["x"]


def test_strip_matches_python(spark):
    cases = ["　 \n x y \t ", "\x1dab\x1c", "   ", "", "a ", "\xa0\x85z ", "x"]
    df = spark.createDataFrame([(c,) for c in cases], "s string")
    got = [r["x"] for r in df.select(tx.py_strip("s").alias("x")).collect()]
    assert got == [c.strip() for c in cases]


def test_cut_counts_code_points(spark):
    assert one(spark, tx.cut("s", 2), "a\U0001F600bc") == "a\U0001F600"


def test_preview(spark):
    s200, s201 = "x" * 200, "y" * 201
    assert one(spark, tx.preview("s", 200), s200) == s200
    assert one(spark, tx.preview("s", 200), s201) == "y" * 200 + "..."
    assert one(spark, tx.preview("s", 60, always=True), "abc") == "abc..."


def test_count_words(spark):
    assert one(spark, tx.count_words("s"), "") == 0
    assert one(spark, tx.count_words("s"), "  a  b ") == 2
    odd = "a\x1cb　c   d"
    assert one(spark, tx.count_words("s"), odd) == len(odd.split())


def test_new_tokens(spark):
    df = spark.createDataFrame([([7, 8, 9],), ([7, 8],)], "ids array<int>")
    got = [r["x"] for r in df.select(tx.new_tokens("ids", 2).alias("x")).collect()]
    assert got == [[9], []]


def test_sanitize_binary(spark):
    df = spark.createDataFrame([(bytearray(b"ok\xffx"),)], "b binary")
    assert df.select(tx.sanitize(F.col("b")).alias("x")).first()["x"] == "ok�x"
