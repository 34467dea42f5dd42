import hashlib
import random

from pyspark.sql import functions as F

from evenkeel.functions.text import with_dedup_keys
from evenkeel.operators import dedup


def sequential(texts):
    """Kept positions and counters of one pass in order."""
    survivors, kept, exact, near = {}, [], 0, 0
    for i, text in enumerate(texts):
        norm = " ".join(text.lower().split())
        key = norm[:200]
        if key not in survivors:
            survivors[key] = norm
            kept.append(i)
        elif survivors[key] == norm:
            exact += 1
        else:
            near += 1
    return kept, exact, near


def adversarial(rng, rows):
    """A third of the rows share one prefix, half of those with ever different tails."""
    boiler = "Shared header " * 20
    pool = ["".join(rng.choices("ab ", k=rng.choice([3, 199, 200, 201, 220]))) for _ in range(40)]
    out = []
    for i in range(rows):
        kind = rng.random()
        if kind < 0.17:
            out.append(boiler + str(i))
        elif kind < 0.34:
            out.append(boiler.upper() + rng.choice(["x", " y"]))
        else:
            text = rng.choice(pool)
            out.append(rng.choice([text, text.upper(), text.replace(" ", "\t "), text + "!"]))
    return out


def test_matches_sequential_pass(spark):
    rng = random.Random(11)
    texts = adversarial(rng, 1500)
    kept, exact, near = sequential(texts)
    for parts in (1, 8, 64):
        frame = spark.createDataFrame(list(enumerate(texts)), "ord bigint, text string").repartition(parts)
        groups = dedup.dedup_groups(with_dedup_keys(frame))
        assert dedup.dedup_counters(groups).first().asDict() == {
            "before": 1500, "exact": exact, "near": near, "kept": len(kept)}
        result = dedup.deduplicate(frame)
        assert sorted(r["ord"] for r in result.collect()) == kept
        assert result.columns == frame.columns


def test_repeat_of_a_dropped_near_duplicate_is_near_again(spark):
    head = "p" * 200
    frame = spark.createDataFrame([(0, head + "a"), (1, head + "b"), (2, head + "b"), (3, head + "A")],
                                  "ord bigint, text string")
    counters = dedup.dedup_counters(dedup.dedup_groups(with_dedup_keys(frame))).first()
    assert (counters["exact"], counters["near"], counters["kept"]) == (1, 2, 1)


def test_idempotent_and_empty(spark):
    texts = adversarial(random.Random(5), 300)
    frame = spark.createDataFrame(list(enumerate(texts)), "ord bigint, text string")
    once = dedup.deduplicate(frame)
    assert dedup.deduplicate(once).count() == once.count()
    empty = dedup.dedup_counters(dedup.dedup_groups(with_dedup_keys(frame.filter(F.lit(False)))))
    assert empty.first().asDict() == {"before": 0, "exact": 0, "near": 0, "kept": 0}


def test_keys_are_md5_hex(spark):
    frame = spark.createDataFrame([("  Été  X\n" + "y" * 300,)], "text string")
    norm = "été x " + "y" * 300
    row = with_dedup_keys(frame).first()
    assert row["exact_key"] == hashlib.md5(norm.encode()).hexdigest()
    assert row["prefix_key"] == hashlib.md5(norm[:200].encode()).hexdigest()
