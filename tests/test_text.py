import random
import re
import time

import pytest
from pyspark.sql import functions as F

from evenkeel.functions import text as T

WS_CHARS = [c for c in map(chr, range(0x110000)) if c.isspace()]


def run(spark, values, column):
    """Apply a column function to strings, keeping their order."""
    frame = spark.createDataFrame(list(enumerate(values)), "i int, s string")
    return [r[1] for r in sorted(frame.select("i", column(F.col("s")).alias("o")).collect())]


def py_clean(text):
    for pattern, to in ((r"\[([^\]]+)\]\(([^)]+)\)", r"\1"), (r"http\S+|www\.\S+", ""),
                        (r"<[^>]+>", ""), (r"(?m)^&gt;.*$", ""), (r"_{2,}", "")):
        text = re.sub(pattern, to, text)
    return " ".join(text.split())


GOLDEN = [
    ("x\n&gt; q\r\nw\n\n&gt;z", "x w"),
    ("[a](http://b) www.x.y　z __ _ ____", "a z _"),
    ("<p\n>hi</p> http://a<b>c", "hi"),
    ("![i](u) [n[m]](k) [](e)", "!i [n[m]](k) [](e)"),
    ("a<br>b", "ab"),
    ('go <a href="http://x.y/z">link</a> then <i>this</i> end', "go this end"),
    ("x\n&gt; q still q\ny\r\n&gt; z\r\nw", "x y w"),
    ("", ""),
    (None, ""),
]


def test_golden_cleaning(spark):
    assert run(spark, [g for g, _ in GOLDEN], T.clean_text) == [w for _, w in GOLDEN]


def test_every_whitespace_character_collapses(spark):
    assert len(WS_CHARS) == 29 and sorted(T.WS_CHARS) == WS_CHARS
    assert run(spark, [f"a{c}b{c}{c}c{c}" for c in WS_CHARS], T.clean_text) == ["a b c"] * 29
    assert run(spark, [f"{c}a{c}b{c}" for c in WS_CHARS], T.strip) == [f"a{c}b" for c in WS_CHARS]


def test_cleaning_and_normalising_match_python(spark):
    rng = random.Random(7)
    tokens = ["http", "www.", "x.y", "<", ">", "[", "](", ")", "]", "(", "&gt;", "_", "__", "\n", "\r", " ", "a",
              "É", "ß", "Word", "\U0001f600", "Σ", *WS_CHARS]
    texts = ["".join(rng.choices(tokens, k=rng.randint(0, 24))) for _ in range(4000)]
    assert run(spark, texts, T.clean_text) == [py_clean(t) for t in texts]
    assert run(spark, texts, T.normalise) == [" ".join(t.lower().split()) for t in texts]
    cleaned = [py_clean(t) for t in texts]
    assert run(spark, cleaned, T.normalise_cleaned) == run(spark, cleaned, T.normalise)


def test_strip_matches_python(spark):
    rng = random.Random(9)
    texts = ["".join(rng.choices(["a", "\0", "é", "\U0001f600", " ", *WS_CHARS], k=rng.randint(0, 12))) for _ in range(4000)]
    assert run(spark, [*texts, None], T.strip) == [t.strip() for t in texts] + [None]
    assert run(spark, texts, T.strip_edges) == [t.strip() for t in texts]


def test_strip_does_not_search_texts_without_blank_edges(spark):
    frame = spark.range(4, numPartitions=4).select(F.repeat(F.concat(F.lit("word "), "id"), 500_000).alias("s")).cache()
    frame.count()

    def seconds(column):
        start = time.monotonic()
        frame.select(column(F.col("s"))).write.format("noop").mode("overwrite").save()
        return time.monotonic() - start

    assert min(seconds(T.strip) for _ in range(3)) < min(seconds(T.collapse_whitespace) for _ in range(3)) / 1.5


def test_links_and_tags_match_python(spark):
    rng = random.Random(8)
    texts = ["".join(rng.choices("[]()<>ab", k=rng.randint(0, 30))) for _ in range(6000)]
    assert run(spark, texts, T.md_link_to_label) == [
        re.sub(r"\[([^\]]+)\]\(([^)]+)\)", r"\1", t) for t in texts]
    assert run(spark, texts, T.strip_tags) == [re.sub(r"<[^>]+>", "", t) for t in texts]


def test_unclosed_markup_takes_linear_time(spark):
    n = 300_000
    texts = ["<" * n, "[" * n, "[" * n + "]", "[a](" * n, "a < b " * n, "x" + " " * n + "x", "&gt;" * n,
             "_" * n, "http" * n, "[a](b" * n + ")"]
    start = time.monotonic()
    run(spark, texts, T.clean_text)
    run(spark, texts, T.strip)
    assert time.monotonic() - start < 60


@pytest.mark.parametrize("size,kept", [(19, False), (20, True), (16000, True), (16001, False)])
def test_length_gate(spark, size, kept):
    for char in ("x", "\U0001f600"):
        frame = spark.createDataFrame([(char * size,)], "text string")
        assert (T.clean_and_filter(frame).count() == 1) is kept


def py_truncate(text):
    if len(text) <= 4000:
        return text
    cut = text[:4000]
    at = cut.rfind(". ")
    return cut[:at + 1] if at > 2000 else cut


def test_truncation_boundaries(spark):
    rng = random.Random(3)
    texts = ["x" * 4000, "x" * 4001, "x" * 2000 + ". " + "y" * 3000, "x" * 2001 + ". " + "y" * 3000,
             "x" * 3998 + ". y", "x" * 3999 + ". y", "\U0001f600" * 3000 + ". " + "z" * 2000, ". " * 4000]
    texts += ["".join(rng.choices("ab. ", k=rng.randint(3900, 4300))) for _ in range(200)]
    assert run(spark, texts, T.truncate_sentence) == [py_truncate(t) for t in texts]


def test_truncated_text_normalises_alike(spark):
    texts = ["X " * 3000, "x" * 3999 + " yy", "x" * 2500 + ".  "]
    cut = [py_truncate(t) for t in texts]
    assert run(spark, cut, T.normalise_cleaned) == [" ".join(t.lower().split()) for t in cut]


def test_each_regex_runs_once(spark):
    frame = spark.createDataFrame([("a" * 30,)], "text string")
    plan = T.with_dedup_keys(T.clean_and_filter(frame), cleaned=True)._jdf.queryExecution(
    ).optimizedPlan().toString()
    assert plan.count(T.TAG) == 1 and plan.count("_{2,}") == 1
