import hashlib
import random
from collections import Counter

import pytest

from evenkeel.operators import balance


def frame_of(spark, strata, parts=4):
    """Rows for {(label, source): count}."""
    rows, i = [], 0
    for (label, source), count in strata.items():
        for _ in range(count):
            rows.append((i, label, source))
            i += 1
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, "ord bigint, label bigint, source string").repartition(parts)


def seats(sizes, drawn):
    """Largest remainder with ties by hash of the name."""
    total = sum(sizes.values())
    share = {s: n * drawn // total if total else 0 for s, n in sizes.items()}
    rest = sorted(sizes, key=lambda s: (-(sizes[s] * drawn % total if total else 0),
                                        hashlib.md5(f"42:{s}".encode()).hexdigest()))
    for s in rest[:drawn - sum(share.values())]:
        share[s] += 1
    return share


CASES = [
    {(1, "a"): 7, (0, "b"): 7},
    {(1, "a"): 1, (1, "b"): 2, (1, "c"): 3, (0, "d"): 7, (0, "e"): 40},
    {(1, "a"): 1},
    {(1, "a"): 2, (0, "b"): 1},
    {(0, f"s{i}"): 3 + i % 5 for i in range(30)} | {(1, "hot"): 113},
    {(1, None): 6, (0, "b"): 9},
]


@pytest.mark.parametrize("strata", CASES)
def test_split_sizes(spark, strata):
    frame = frame_of(spark, strata)
    rows = balance.stratified_split(frame).collect()
    assert len(rows) == len({r["ord"] for r in rows}) == sum(strata.values())
    folded = Counter()
    for (label, source), n in strata.items():
        folded[str(label) if n < 3 else f"{label}_{source or ''}"] += n
    total = sum(folded.values())
    train = seats(folded, total * 4 // 5)
    rest = {s: n - train[s] for s, n in folded.items()}
    val = seats(rest, (total - total * 4 // 5) // 2)
    got = Counter()
    for r in rows:
        n = strata[(r["label"], r["source"])]
        got[(str(r["label"]) if n < 3 else f"{r['label']}_{r['source'] or ''}", r["split"])] += 1
    want = Counter({(s, "train"): train[s] for s in folded})
    want.update({(s, "val"): val[s] for s in folded})
    want.update({(s, "test"): folded[s] - train[s] - val[s] for s in folded})
    assert got == +want


def test_balance_equalises_classes(spark):
    frame = frame_of(spark, {(1, "a"): 40, (1, "b"): 25, (0, "c"): 31, (2, "d"): 90})
    rows = balance.balance_classes(frame).collect()
    assert Counter(r["label"] for r in rows) == {0: 31, 1: 31, 2: 31}
    assert len({r["ord"] for r in rows}) == 93


@pytest.mark.parametrize("strata", [{(1, "a"): 9}, {(1, "a"): 5, (0, "b"): 5}, {(1, "a"): 1, (0, "b"): 30}])
def test_balance_edge_cases(spark, strata):
    counts = Counter(r["label"] for r in balance.balance_classes(frame_of(spark, strata)).collect())
    assert set(counts.values()) == {min(Counter({k[0]: v for k, v in strata.items()}).values())}


def test_same_result_for_any_partitioning(spark):
    strata = {(1, "a"): 60, (1, "b"): 2, (0, "c"): 90, (0, "d"): 8}
    results = []
    for parts in (1, 8, 64):
        balanced = balance.balance_classes(frame_of(spark, strata, parts))
        results.append(sorted(map(tuple, balance.stratified_split(balanced).collect())))
    assert results[0] == results[1] == results[2]


def test_many_strata_take_the_shuffle_join(spark, many_groups):
    strata = {(1, "a"): 13, (1, "b"): 2, (0, "c"): 20, (0, "d"): 8}
    frame = frame_of(spark, strata)
    balanced = balance.balance_classes(frame)
    assert Counter(r["label"] for r in balanced.collect()) == {1: 15, 0: 15}
    split = Counter(r["split"] for r in balance.stratified_split(balanced).collect())
    assert split == {"train": 24, "val": 3, "test": 3}


def test_empty(spark):
    frame = frame_of(spark, {(1, "a"): 1}).filter("ord < 0")
    assert balance.stratified_split(balance.balance_classes(frame)).count() == 0


def test_product_of_row_counts_does_not_overflow(spark):
    strata = spark.createDataFrame([("0_a", 10**11 + 3), ("1_b", 10**11 - 3)], "stratum string, rows bigint")
    rows = {r["stratum"]: r for r in balance.split_targets(strata).collect()}
    assert sum(r["train"] for r in rows.values()) == 16 * 10**10
    assert all(abs(r["val"] - r["test"]) <= 1 for r in rows.values())
