"""Explicit schemas of sources."""

from pyspark.sql import types as T

# conversation turns (batch and stream)
TURN = T.StructType([
    T.StructField("conv_id", T.LongType()),
    T.StructField("turn", T.LongType()),
    T.StructField("role", T.StringType()),
    T.StructField("text", T.StringType()),
])

# one answer row per sample (document form: answers[] of the answers file);
# a key of any type is written as it is and read back as text
ANSWER = T.StructType([
    T.StructField("sample_id", T.StringType()),
    T.StructField("instruction", T.StringType()),
    T.StructField("question", T.StringType()),
    T.StructField("reference", T.StringType()),
    T.StructField("base_answer", T.StringType()),
    T.StructField("lora_answer", T.StringType()),
])

ANSWERS_CONFIG = T.StructType([
    T.StructField("num_samples", T.LongType()),
    T.StructField("adapter_path", T.StringType()),
    T.StructField("max_new_tokens", T.LongType()),
    T.StructField("seed", T.LongType()),
])

SCORE_DIMS = ("correctness", "completeness")
