import pytest
from pyspark.sql import functions as F

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and very long texts, repeated rows, one id with two texts, columns with clashing names."""
    long = " ".join(f"w{i % 7919}x{i % 13}" for i in range(30_000))
    passage = " ".join(f"shared{i}" for i in range(60))
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "12 34 !!"), (5, long), (6, "same text here now"),
            (6, "same text here now"), (7, "first of two"), (7, "second of two other words"), (None, "no id at all here"),
            (8, f"alpha {passage} beta"), (9, f"gamma {passage} delta"), (10, "<|endoftext|> x y İ Σ"),
            (11, "one"), (12, "a b a b a b a b a b a b a b a b a b a b a b a b a b " * 9)]
    frame = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows],
                                  "doc_id bigint, text string, lang string, source string, n_chars bigint")
    for name in ("score", "n", "part", "token", "row", "held_out", "kept", "doc", "n_words", "start"):
        frame = frame.withColumn(name, F.lit("x"))
    return frame.repartition(3, "doc_id").cache()


@pytest.fixture(scope="session")
def nothing(odd):
    return odd.filter("false")
