"""Shapes that must hold at any scale."""

import re

import pandas as pd
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
from evenkeel.functions.text import clean_and_filter, with_dedup_keys
from evenkeel.operators.dedup import dedup_groups
from evenkeel.plans import staging
from evenkeel.plans.staging import Pinned, look_up
from evenkeel.session import sized_shuffles, small_broadcasts

FOLDER = "/root/testdata/sf0.001"
PYTHON = {"article_text", "qa_pairs"}


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["flagship_split", "balance_classes", "stratified_split", "first_n",
                                  "robots_filter", "category_walk", "title_lookup", "link_extract",
                                  "template_fill", "unpivot_distinct", "clean_gate_truncate"])
def test_no_cross_join_and_no_python(spark, name):
    plan = plan_of(entry_point.queries()[name](spark, FOLDER))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert not re.search("BatchEvalPython|ArrowEvalPython|MapInPandas|MapInArrow|FlatMapGroups", plan)


def test_only_the_needed_columns_are_read(spark):
    plan = plan_of(entry_point.queries()["balance_classes"](spark, FOLDER))
    assert "ReadSchema: struct<doc_id:bigint,lang:string,source:string>" in plan
    # The text of the final corpus is read below the joins with the cuts, not before a shuffle.
    plan = plan_of(entry_point.queries()["flagship_split"](spark, FOLDER))
    assert "LocalTableScan" in plan and "Window" not in plan and "SortAggregate" not in plan


def test_dedup_aggregates_fixed_width_buffers(spark):
    frame = spark.createDataFrame([(1, "a" * 30)], "ord bigint, text string")
    plan = plan_of(dedup_groups(with_dedup_keys(clean_and_filter(frame), cleaned=True)))
    assert plan.count("HashAggregate") == 4 and "SortAggregate" not in plan and "Window" not in plan


def test_large_lookup_is_salted_not_broadcast(spark):
    big = spark.range(1000).selectExpr("id", "id % 3 as g")
    side = spark.range(3).selectExpr("id as g", "id * 10 as v")
    joined = look_up(big, Pinned(side, False), ["g"])
    assert "_salt" in joined._jdf.queryExecution().optimizedPlan().toString()
    assert {(r["g"], r["v"]) for r in joined.collect()} == {(0, 0), (1, 10), (2, 20)}
    assert joined.count() == 1000


def test_copies_for_salts_are_not_broadcast_however_small_their_table_seems(spark):
    big = spark.range(1000).selectExpr("id", "id % 3 as g")
    side = spark.range(3).selectExpr("id as g", "id * 10 as v")
    joined = look_up(big, Pinned(side, False), ["g"])
    joined.collect()
    assert "SortMergeJoin" in plan_of(joined) and "Broadcast" not in plan_of(joined)
    assert joined.agg({"v": "sum"}).first()[0] == sum(i % 3 * 10 for i in range(1000))


@pytest.mark.parametrize("configured,inside", [("10MB", 1000), ("-1", "-1"), ("500b", "500b")])
def test_broadcasts_are_bounded_inside_and_as_configured_after(spark, configured, inside):
    static, adaptive = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"
    before = spark.conf.get(static)
    spark.conf.set(static, configured)
    try:
        with small_broadcasts(spark, 1000):
            assert spark.conf.get(static) == str(inside)
            joined = spark.range(1000).join(spark.range(900).withColumnRenamed("id", "k"), F.col("id") == F.col("k"))
            joined.collect()
            assert "Broadcast" not in plan_of(joined)
        assert spark.conf.get(static) == configured and spark.conf.get(adaptive, None) is None
    finally:
        spark.conf.set(static, before)



def test_first_rows_reaches_the_scan(spark):
    plan = plan_of(entry_point.queries()["first_n"](spark, "/root/testdata/sf0.01"))
    assert re.search(r"PushedFilters: \[.*doc_id", plan), plan


def test_shuffle_partitions_grow_with_the_input(spark):
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    with sized_shuffles(spark, 10 << 40) as wanted:
        assert wanted == 40960 and spark.conf.get(name) == "40960"
    with sized_shuffles(spark, 1000) as wanted:
        assert wanted == int(before)
    assert spark.conf.get(name) == before


def test_staging_folder(spark, tmp_path, monkeypatch):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    assert configured is None or staging.shared_dir(spark) == configured.rstrip("/")
    monkeypatch.setattr(staging, "shared_dir", lambda _: str(tmp_path))
    with staging.staging_area(spark):
        assert staging.stage(spark.range(3), "three").count() == 3
        assert list(tmp_path.glob("evenkeel/run-*/three-*"))
    assert not list(tmp_path.glob("evenkeel/run-*"))


def test_small_batches_end_with_their_block(spark):
    from evenkeel.session import small_batches
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    with small_batches(spark, 10):
        assert spark.conf.get(name) == "10"
        sizes = spark.range(100, numPartitions=1).mapInPandas(
            lambda batches: (pd.DataFrame({"n": [len(b)]}) for b in batches), "n bigint").collect()
        assert {r["n"] for r in sizes} == {10}
    with pytest.raises(ValueError), small_batches(spark, 10):
        raise ValueError
    assert spark.conf.get(name) == before
