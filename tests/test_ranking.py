import random

import pytest
from pyspark.sql import functions as F

from evenkeel.functions.draws import order_key
from evenkeel.operators.ranking import first_n
from evenkeel.operators.sampling import first_rows, halves, sample_exact, topic_quota


def expected(rows, n, groups):
    out = []
    for g in {r[0] for r in rows} if groups else [None]:
        members = sorted((r for r in rows if g is None or r[0] == g), key=lambda r: (r[1], r[2]))
        out += members[:n]
    return sorted(out)


def skewed_rows(rng, size):
    """One group holds more than a third of the rows, and one key value many of its rows."""
    rows = []
    for i in range(size):
        group = "hot" if rng.random() < 0.4 else rng.choice("abcdefgh")
        key = 77 if rng.random() < 0.3 else rng.randint(0, 5000)
        rows.append((group, key, i))
    return rows


@pytest.mark.parametrize("rank_at_most,buckets,sizes", [
    (100000, 4096, (0, 1, 133, 5000)), (50, 16, (1, 400)), (1, 64, (133,))])
@pytest.mark.parametrize("groups", [[], ["g"]])
def test_first_n_matches_sorting(spark, rank_at_most, buckets, sizes, groups):
    rows = skewed_rows(random.Random(2), 1200)
    frame = spark.createDataFrame(rows, "g string, k bigint, id bigint").repartition(7)
    for n in sizes:
        got = first_n(frame, n, F.col("k"), "id", groups, rank_at_most=rank_at_most, buckets=buckets)
        assert sorted(map(tuple, got.collect())) == expected(rows, n, groups)


def test_first_n_with_many_groups(spark, many_groups):
    rows = skewed_rows(random.Random(4), 600)
    frame = spark.createDataFrame(rows, "g string, k bigint, id bigint")
    for groups in ([], ["g"]):
        got = first_n(frame, 37, F.col("k"), "id", groups, rank_at_most=40, buckets=64)
        assert sorted(map(tuple, got.collect())) == expected(rows, 37, groups)


def test_sample_is_exact_seeded_and_independent_of_partitions(spark):
    frame = spark.range(5000).withColumnRenamed("id", "row")
    picks = {parts: sorted(r[0] for r in sample_exact(frame.repartition(parts), 700, "row").collect())
             for parts in (1, 8, 64)}
    assert len(picks[1]) == 700 and picks[1] == picks[8] == picks[64]
    other = sorted(r[0] for r in sample_exact(frame, 700, "row", seed=7).collect())
    assert other != picks[1] and len(other) == 700
    assert 0 < len(set(other) & set(picks[1])) < 250  # about 98 by chance
    assert sample_exact(frame, 9000, "row").count() == 5000
    keyed = frame.select("row", order_key("sample", F.col("row")).alias("k")).collect()
    assert picks[1] == sorted(r["row"] for r in sorted(keyed, key=lambda r: (r["k"], r["row"]))[:700])


def test_null_group_and_empty_table(spark):
    frame = spark.createDataFrame([(None, 1), (None, 2), ("a", 3)], "g string, id bigint")
    assert sorted(r["id"] for r in first_rows(frame, 1, "id", ["g"]).collect()) == [1, 3]
    assert first_rows(frame.filter("id > 9"), 5, "id").count() == 0


def test_ungrouped_cut_is_a_plain_filter(spark):
    frame = spark.range(10000).withColumnRenamed("id", "row")
    plan = first_rows(frame, 10, "row")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan and "Join" not in plan


def test_quota_arithmetic():
    assert topic_quota(15000, 25) == 600 and topic_quota(3, 25) == 1
    assert halves(10000) == (5000, 5000) and halves(7) == (3, 4)
