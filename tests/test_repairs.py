"""Failures inside tasks, odd records and ids over the whole BIGINT range."""

import pytest
from pyspark.sql import functions as F

from evenkeel.operators import ranking
from evenkeel.operators.balance import balance_classes, stratified_split
from evenkeel.plans.build import load_splits, save_splits
from evenkeel.plans.raw_zone import load_partial, run_sources, save_partial
from evenkeel.plans.registry import Source
from evenkeel.sources.qa_xml import extract_pairs
from evenkeel.sources.webpages import _article


def _records(spark, n=10):
    return spark.range(n).select(F.concat(F.lit("text "), "id").alias("text"), F.lit(1).cast("bigint").alias("label"),
                                 F.lit("s").alias("source"), F.lit(None).cast("string").alias("subtopic"),
                                 F.col("id").alias("row_id"))


def _failing(spark):
    return _records(spark).withColumn("text", F.when(F.col("row_id") == 7, F.raise_error(F.lit("in a task")))
                                      .otherwise(F.col("text")))


def test_failed_rebuild_keeps_the_stored_rows(spark, tmp_path):
    root = str(tmp_path)
    save_partial(_records(spark), root, "s")

    def wrong(_):
        raise TypeError("not a source")

    report = run_sources(spark, [Source("s", 1, 10, _failing), Source("t", 1, 10, wrong),
                                 Source("u", 1, 10, _records)], root, force=True)
    assert [r.status for r in report] == ["failed", "failed", "built"]
    assert load_partial(spark, root, "s").count() == 10
    assert not [p.name for p in tmp_path.iterdir() if p.name.startswith("_")]


def test_failed_save_keeps_the_splits(spark, tmp_path):
    folder = f"{tmp_path}/final"
    save_splits(_records(spark).withColumn("split", F.lit("train")), folder)
    with pytest.raises(Exception, match="in a task"):
        save_splits(_failing(spark).withColumn("split", F.lit("train")), folder)
    assert load_splits(spark, folder).count() == 10


@pytest.mark.parametrize("ids", [range(-50, 50), [*range(-(1 << 63), -(1 << 63) + 50), *range((1 << 63) - 50, 1 << 63)]])
def test_ids_of_either_sign(spark, ids):
    rows = spark.createDataFrame([(i, int(k < 20), "s") for k, i in enumerate(ids)], "ord bigint, label bigint, source string")
    counts = {r["label"]: r["count"] for r in balance_classes(rows).groupBy("label").count().collect()}
    assert counts == {0: 20, 1: 20}
    split = {r["split"]: r["count"] for r in stratified_split(rows).groupBy("split").count().collect()}
    assert split == {"train": 80, "val": 10, "test": 10}


def test_ties_over_the_whole_range_are_divided(spark):
    ids = [*range(-(1 << 63), -(1 << 63) + 60), *range(-30, 30), *range((1 << 63) - 60, 1 << 63)]
    rows = spark.createDataFrame([(i,) for i in ids], "id bigint")
    got = ranking.first_n(rows, 77, F.lit(1).cast("bigint"), "id", rank_at_most=5, buckets=4)
    assert sorted(r["id"] for r in got.collect()) == sorted(ids)[:77]


def test_null_ids_are_an_error(spark):
    rows = spark.createDataFrame([(None if i < 5 else i, i % 3 // 2, "s") for i in range(50)],
                                 "ord bigint, label bigint, source string")
    with pytest.raises(Exception, match="null ord"):
        balance_classes(rows).collect()


def test_damaged_files_cost_themselves(spark):
    good = b"<a><QAPair><Question>q</Question><Answer>x</Answer></QAPair></a>"
    odd = [b'<?xml version="1.0" encoding="no-such"?>' + good, b'<?xml version="1.0" encoding="utf-7"?>' + good, b"<a>", None]
    files = spark.createDataFrame([(f"f{i}", c) for i, c in enumerate([good, *odd])], "path string, content binary")
    assert [tuple(r) for r in extract_pairs(files).collect()] == [("f0", 0, "q x")]


def test_odd_declarations_keep_the_text_around_them():
    assert _article("<article><p>one</p><![foo[bar]]><p>two</p></article>") == "one two"
    assert _article("<!DOCTYPE [<!x]><article><p>one</p><![if !IE]><p>two</p><![endif]></article>") == "one two"
