"""Every stage of the pipeline against a plain version of it, on nulls, repeated rows, clashing names and empty tables."""

import random
from collections import Counter

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from test_documents import _groups, _removed, _sets, _statistics
from test_tokens import _check_packing, _expected

import corpus_pipeline
from evenkeel.llm import quality_rules

STAGES = dict(corpus_pipeline.STAGES)
FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def mixed(spark, odd):
    """Documents with labels, rows under a null id or one id, exact and near copies, columns with clashing names."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").filter("doc_id < 260")
    rows = docs.collect()
    draw = random.Random(4)
    more = []
    for r in draw.sample([r for r in rows if len(r["text"].split()) > 60], 30):
        words = r["text"].split(" ")
        words[draw.randrange(len(words))] = "changed"
        more.append((draw.choice([None, r["doc_id"], 7000 + r["doc_id"]]), draw.choice([r["text"], " ".join(words)]), r["lang"], r["source"], 1))
    extra = spark.createDataFrame(more, docs.schema)
    frame = docs.union(extra).union(odd.select(*docs.columns))
    for name in ("score", "n", "part", "row", "kept", "doc", "n_words", "start", "component_id", "lang_pred", "_0", "shard"):
        frame = frame.withColumn(name, F.lit("x"))
    return frame.repartition(4, "text").cache()


def _of(frame, *columns):
    return Counter(tuple(r) for r in frame.select(*(columns or frame.columns)).collect())


def test_quality_stage(spark, mixed):
    kept = STAGES["quality_rules"](spark, mixed, FOLDER)
    assert kept.columns == mixed.columns
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    rules = quality_rules.learn(quality_rules.statistics(mixed), labels)
    failed = {t: (s := _statistics(t or ""))[0] < 20 or 100 * s[4] > 30 * s[0] for (t,) in _of(mixed, "text")}
    before, after = _of(mixed), _of(kept)
    at = mixed.columns.index("text")
    assert not after - before and all(not failed[row[at]] for row in after)
    if not rules.rules:  # the base rule alone decides
        assert after == Counter({row: n for row, n in before.items() if not failed[row[at]]})
    by_text = {}
    for row in before:  # equal texts have one fate, whatever their ids
        by_text.setdefault(row[at], set()).add(before[row] == after[row])
    assert all(len(fates) == 1 for fates in by_text.values())


def test_language_stage(spark, mixed):
    kept = STAGES["language_id"](spark, mixed, FOLDER)
    assert kept.columns == mixed.columns
    before, after = _of(mixed), _of(kept)
    at = mixed.columns.index("text")
    assert not after - before
    assert {row[at] for row in before if row[at] is None or not any(c.isalpha() for c in row[at])}.isdisjoint(row[at] for row in after)
    clean = _of(mixed.filter("doc_id < 260"))
    assert sum((clean & after).values()) > 0.95 * sum(clean.values())


def test_near_duplicate_stage(spark, mixed):
    rows = mixed.collect()
    groups = {}
    for i, _, group in _groups(_sets([{"doc_id": i, "text": r["text"]} for i, r in enumerate(rows)], 5), 80):
        groups.setdefault(group, []).append(rows[i])
    kept = STAGES["ngram_jaccard_join"](spark, mixed, FOLDER)
    assert kept.columns == mixed.columns
    # Of rows under one id the first stays, which equal rows do not tell: the ids and the groups' texts are compared.
    want = Counter(min(((r["doc_id"] is None, r["doc_id"] or 0) for r in g)) for g in groups.values())
    got = kept.collect()
    assert Counter((r["doc_id"] is None, r["doc_id"] or 0) for r in got) == want
    of_text = {r["text"]: group for group, g in groups.items() for r in g if (r["text"] or "").strip()}
    once = Counter(of_text[r["text"]] for r in got if r["text"] in of_text)
    assert set(once.values()) == {1} and set(once) == set(of_text.values())


def test_repeats_stage(spark, mixed):
    told = mixed.filter("doc_id IS NOT NULL AND doc_id NOT IN (6, 7)").dropDuplicates(["doc_id"]).cache()
    kept = STAGES["suffix_array_dedup"](spark, told, FOLDER)
    assert kept.columns == told.columns
    rows = [(r["doc_id"], (r["text"] or "").encode()) for r in told.collect()]
    removed = {w[0]: w for w in _removed(rows)}
    nulls = {r["doc_id"] for r in told.collect() if r["text"] is None}
    got = {r["doc_id"]: r["text"] for r in kept.collect()}
    for doc, raw in rows:
        left = len(raw) - removed[doc][2]
        if doc in nulls:
            assert got[doc] is None
        elif doc in got:  # a cut through a character takes the rest of it
            assert left - 6 * removed[doc][3] <= len(got[doc].encode()) <= left
        else:
            assert removed[doc][2] or not raw.strip()


def test_packing_stage(spark, mixed):
    placed = STAGES["best_fit_packing"](spark, mixed, FOLDER).collect()
    path = public_tokenizers.path("byte_bpe_50k.json")
    expected = _expected(mixed.select("doc_id", "text").collect(), path, [2])
    assert _check_packing(placed, expected, 1024) <= 1.02 * -(-sum(len(i) for _, i in expected) // 1024) + 1


@pytest.mark.parametrize("name", list(STAGES))
def test_empty_tables(spark, mixed, name):
    nothing = mixed.filter("false")
    out = STAGES[name](spark, nothing, FOLDER)
    assert out.isEmpty() and (name == "best_fit_packing" or out.columns == mixed.columns)


def test_run_on_an_empty_table(spark, tmp_path):
    for table in ("documents", "labels"):
        spark.read.parquet(f"{FOLDER}/{table}.parquet").filter("false").write.parquet(f"{tmp_path}/{table}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).isEmpty()
