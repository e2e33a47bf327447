import pytest

DOC = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """Rows of (doc_id, text[, lang]) as a documents table."""
    def make(rows, extra=False):
        full = [(r[0], r[1], r[2] if len(r) > 2 else None, "s", len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, DOC)
        if extra:  # columns whose names clash with the operators' own
            for c in ("n", "key", "fp", "found", "spans", "rid", "tid", "score", "items", "ids", "value"):
                df = df.selectExpr("*", f"cast(null as string) as `{c}`")
        return df.repartition(3)
    return make


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}
