"""Sources (A1-A4): instruction datasets, question lists, answers files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatframe.operators.sampling import ensure_sample_id, number_rows
from chatframe.schemas import ANSWER, ANSWERS_CONFIG
from chatframe.sources.documents import AnswersDocument, local_path

DEFAULT_QUESTIONS = ("What can you help me with?", "Explain the difference between a list and a set.")
SFT_COLS = ("instruction", "input", "output")


def read_sft(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A1: instruction rows (``sample_id, instruction, input, output``, all
    strings).  Keys of the source are kept; rows without one, or a source
    without that column, get a content key.  CSV files have a header."""
    reader = spark.read.format(fmt)
    if fmt == "json":
        reader = reader.schema(", ".join(f"{c} string" for c in ("sample_id", *SFT_COLS)))
    elif fmt == "csv":
        reader = reader.option("header", True).option("multiLine", True).option("escape", '"')
    df = reader.load(path)
    cols = [F.col(c).cast("string").alias(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in SFT_COLS]
    if "sample_id" not in df.columns:
        return ensure_sample_id(df.select(*cols)).select("sample_id", *SFT_COLS)
    df = df.select(F.col("sample_id").cast("string").alias("sample_id"), *cols)
    made = ensure_sample_id(df.where(F.col("sample_id").isNull()).select(*SFT_COLS))
    return df.where(F.col("sample_id").isNotNull()).unionByName(made)


def questions(spark: SparkSession, items: Sequence[str] | DataFrame | None = None, column: str = "question") -> DataFrame:
    """A2: the caller's questions, or the built-in list when none (an empty
    list or table also falls back); numbered from 1 in the given order.  Of a
    table the different texts of ``column`` count, numbered in their order."""
    if isinstance(items, DataFrame):
        found = items.select(F.col(column).alias("question")).where("question IS NOT NULL").distinct()
        numbered = number_rows(found, "question", name="question_id").select("question_id", "question")
        return questions(spark) if numbered.isEmpty() else numbered
    qs = list(items) if items else list(DEFAULT_QUESTIONS)
    return spark.createDataFrame([(i + 1, q) for i, q in enumerate(qs)],
                                 "question_id long, question string")


def _files(spark: SparkSession, path: str) -> list[str] | None:
    """The files under ``path`` (names only), or None if there is nothing."""
    try:
        return spark.read.format("binaryFile").load(path).inputFiles()
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def read_answers(spark: SparkSession, path: str) -> DataFrame:
    """A3: answers in table form (``<path>/answers`` JSON lines, one per
    sample), as a document in ordered parts (``writers``), or as one nested
    JSON file (``config`` + ``answers[]``), which several tasks read by byte
    ranges where they can open it.  Keys are strings."""
    if _files(spark, f"{path}/answers") is not None:
        return spark.read.schema(ANSWER).json(f"{path}/answers")
    files = _files(spark, path)
    if files is None:
        raise FileNotFoundError(f"answers not found: {path} (run the generate step first)")
    if len(files) != 1 or files[0].rstrip("/").rsplit("/", 1)[-1] != path.rstrip("/").rsplit("/", 1)[-1]:
        lines = spark.read.text(path).where(F.col("value").rlike(r'^,?\{"sample_id"'))
        row = F.from_json(F.regexp_replace("value", "^,", ""), ANSWER)
        return lines.select(row.alias("a")).select("a.*")
    if local_path(files[0]) is not None:
        spark.dataSource.register(AnswersDocument)
        return spark.read.format("answers_document").load(files[0])
    doc_schema = f"config {ANSWERS_CONFIG.simpleString()}, answers array<{ANSWER.simpleString()}>"
    doc = spark.read.schema(doc_schema).option("multiLine", True).json(path)
    return doc.select(F.explode("answers").alias("a")).select("a.*")


def row_count(df: DataFrame) -> int:
    """A4: number of rows (``len(dataset)``)."""
    return df.count()
