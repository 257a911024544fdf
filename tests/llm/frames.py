import pytest

WORDS = [f"word{i}" for i in range(400)]


@pytest.fixture
def frame(spark):
    """Rows of documents as a table, with columns whose names the operators use themselves."""

    def make(rows, extra=True):
        schema = "doc_id long, text string, lang string, source string, n_chars long"
        df = spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], schema)
        if extra:
            from pyspark.sql import functions as F

            for name in ("k", "h", "score", "n_words", "bucket", "c", "slot", "row", "t", "spans", "p", "block", "x", "id"):
                df = df.withColumn(name, F.lit("clash"))
        return df

    return make


@pytest.fixture
def odd_rows():
    """Nulls, empty, very long, tied and repeated rows."""
    long = " ".join(f"w{i % 997}x{i % 13}" for i in range(40_000))
    return [
        (1, None, "a"), (2, "", "a"), (3, "   \n", None), (4, "one two", "b"), (5, long, "a"), (5, long, "a"),
        (None, "no id here at all, only text", "b"), (6, "one two", "b"), (7, "é漢字🙂 <|endoftext|> it's they're", "c"),
    ]
