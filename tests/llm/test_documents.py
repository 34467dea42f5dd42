import hashlib
import math
import random
import re
import time
import unicodedata
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from compare import differences, duck
from pyspark.sql import functions as F

import corpus_pipeline
from evenkeel.llm import (components, elias_fano, induced_sort, language_id, language_model, ngram_join, quality_rules, queries,
                          suffix_dedup, topk_blocks)
from evenkeel.llm.elias_fano import BigramTrie, EliasFano

FOLDER = "/root/testdata/sf0.001"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def test_languages(documents, odd, nothing):
    got = {r["doc_id"]: r for r in language_id.identify(documents).collect()}
    known = {r["doc_id"]: r["lang"] for r in documents.collect()}
    held = [d for d in got if got[d]["held_out"]]
    assert all(got[d]["held_out"] == (zlib.crc32(str(d).encode()) % 5 == 0) for d in got)
    assert np.mean([got[d]["lang_pred"] == known[d] for d in held]) > 0.95
    strange = language_id.identify(odd, profiles=language_id.learn(documents)).collect()
    assert len(strange) == odd.count() and all(0 <= r["score"] <= 1 for r in strange)
    assert {r["lang_pred"] for r in strange if r["doc_id"] in (1, 2, 3, 4)} == {"und"}
    assert language_id.identify(nothing).isEmpty()
    assert {r["lang_pred"] for r in language_id.identify(odd.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    kept = language_id.in_known_language(odd, 0.2)
    assert kept.columns == odd.columns


def _grams(text):
    words = "".join(c if unicodedata.category(c)[0] == "L" else " " for c in text.lower()).split()
    counts = Counter()
    for w in words:
        counts.update(w)
    line = f" {' '.join(words)} "
    for n in (2, 3):
        counts.update(g for g in (line[i:i + n] for i in range(len(line) - n + 1)) if g.strip() and g[1:-1] != " ")
    return counts


def test_distances_are_out_of_place(spark):
    """The prediction from a plain restatement of ranks and distances; ties of counts go by the n-gram's letters."""
    documents = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = documents.select("doc_id", "text", "lang").collect()
    totals = {}
    for r in rows:
        if r["lang"] and zlib.crc32(str(r["doc_id"]).encode()) % 5:
            totals.setdefault(r["lang"], Counter()).update(_grams(r["text"]))

    def key(gram):  # n-grams are numbers of three letters of 21 bits
        out = 0
        for c in gram:
            out = out << 21 | ord(c)
        return out

    def ranked(counts, most):
        return sorted(counts, key=lambda g: (-counts[g], key(g)))[:most]

    profiles = {lang: {g: i for i, g in enumerate(ranked(c, language_id.PROFILE))} for lang, c in totals.items()}
    got = {r["doc_id"]: r for r in language_id.identify(documents).collect()}
    for r in rows:
        top = ranked(_grams(r["text"] or ""), language_id.TEXT_GRAMS)
        cost = {lang: sum(abs(p[g] - i) if g in p else language_id.PROFILE for i, g in enumerate(top)) for lang, p in profiles.items()}
        best = min(sorted(cost), key=cost.get)
        assert got[r["doc_id"]]["lang_pred"] == best
        assert got[r["doc_id"]]["score"] == pytest.approx(1 - cost[best] / (language_id.PROFILE * len(top)))


def test_documents_stay_where_no_language_can_be_learned(spark, odd):
    unlabelled = odd.withColumn("lang", F.lit(None).cast("string"))
    kept = language_id.in_known_language(unlabelled, 0.2)
    texts = [r["text"] for r in odd.collect()]
    assert kept.columns == odd.columns
    assert sorted(r["text"] for r in kept.collect()) == sorted(
        t for t in texts if t and any(unicodedata.category(c)[0] == "L" for c in t))


def _statistics(text):
    words = WORDS.findall(text)
    lines = [line for line in text.split("\n") if WORDS.search(line)]
    windows = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    covered = {j for i in range(len(words) - 7) if windows[tuple(words[i:i + 8])] > 1 for j in range(i, i + 8)}
    return (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)),
            len(covered))


def test_quality(spark, documents, odd, nothing):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    for frame in (documents, odd):
        rows = quality_rules.judge(frame, labels).collect()
        want = [(r["doc_id"], *_statistics(r["text"] or "")) for r in frame.collect()]
        names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
        assert sorted(map(repr, want)) == sorted(repr(tuple(r[n] for n in names)) for r in rows)
        for r in rows:
            failed = r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"]
            assert r["base_failed"] == failed and not (failed and r["kept"])
    larger = "/root/testdata/sf0.01"  # enough labels to learn from
    known = spark.read.parquet(f"{larger}/labels.parquet")
    quality = {r["doc_id"]: r["quality"] for r in known.collect()}
    rows = quality_rules.judge(spark.read.parquet(f"{larger}/documents.parquet"), known).collect()
    good = [r["kept"] for r in rows if quality.get(r["doc_id"]) == 1 and not r["base_failed"]]
    bad = [r["kept"] for r in rows if quality.get(r["doc_id"]) == 0]
    assert np.mean(good) > 0.95 and np.mean(bad) < 0.5
    assert quality_rules.judge(nothing, labels).isEmpty()
    assert quality_rules.learn(quality_rules.statistics(documents), labels.filter("false")).rules == []
    plan = quality_rules.judge(documents, labels)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert quality_rules.good_documents(odd, labels).columns == odd.columns


def test_rules_are_learned_in_order(spark):
    stats = spark.range(3000).select(
        F.col("id").alias("doc_id"), *[F.lit(100).cast("bigint").alias(c) for c in quality_rules.STATISTICS]).withColumns(
        {"n_symbols": F.col("doc_id") % 10, "n_marks": F.col("doc_id") % 7, "n_repeat_words": F.lit(0)})
    labels = stats.select("doc_id", ((F.col("n_symbols") < 7) & (F.col("n_marks") < 6)).cast("int").alias("quality"))
    kept = stats.select("doc_id", quality_rules.learn(stats, labels).kept().alias("kept")).join(labels, "doc_id")
    assert kept.filter(F.col("kept") != (F.col("quality") == 1)).isEmpty()


def test_top_k_is_the_sql(spark):
    name = "op6_exact_top_k"
    assert differences(queries.QUERIES[name](spark, FOLDER), duck(FOLDER), queries.SQL[name]) is None


def test_top_k_of_odd_vectors(spark, monkeypatch):
    monkeypatch.setattr(topk_blocks, "BLOCK", 3)
    monkeypatch.setattr(topk_blocks, "SHARD_ROWS", 20)
    monkeypatch.setattr(topk_blocks, "RANGE", 4)
    monkeypatch.setattr(topk_blocks, "QUERY_ROWS", 3)
    random.seed(4)
    rows = [(i, [random.choice([-1.0, 0.5, 0.25, 2.0]) for _ in range(5)]) for i in range(60)]
    rows += [(60, None), (61, [1.0, None, 1.0, 1.0, 1.0]), (62, [float("nan")] * 5), (63, [float("inf")] * 5), (None, [1.0] * 5)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumn("score", F.lit(1)).repartition(3)
    whole = {i: [math.floor(256 * x) for x in v] for i, v in rows[:60]}
    want = []
    for q in range(0, 60, 7):
        best = sorted((-sum(a * b for a, b in zip(whole[q], v, strict=True)), i) for i, v in whole.items() if i != q)[:5]
        want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(best)]
    assert sorted(map(tuple, topk_blocks.top_k(frame, F.col("vec_id") % 7 == 0).collect())) == sorted(want)
    assert topk_blocks.top_k(frame.filter("false"), F.col("vec_id") % 7 == 0).isEmpty()
    twice = topk_blocks.top_k(frame.filter("vec_id in (0, 1)").union(frame.filter("vec_id = 1")), F.col("vec_id") == 0)
    assert [tuple(r)[:3] for r in twice.orderBy("rank").collect()] == [(0, 1, 1), (0, 2, 1)]


def _sets(rows, k):
    out = []
    for r in rows:
        w = WORDS.findall((r["text"] or "").translate(LOWER))
        out.append((r["doc_id"], frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else
                    frozenset([tuple(w)] if w else [])))
    return out


def _groups(sets, least):
    group = list(range(len(sets)))
    for i, (_, a) in enumerate(sets):
        for j, (_, b) in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= least * len(a | b):
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    least_id = {}
    for g, (d, _) in zip(group, sets, strict=True):
        least_id[g] = min(d, least_id.get(g, d))
    return [(d, len(s), least_id[g]) for g, (d, s) in zip(group, sets, strict=True)]


@pytest.mark.parametrize(("shingle", "least"), [(3, 90), (5, 80)])
def test_jaccard_groups(spark, documents, odd, nothing, shingle, least):
    random.seed(5)
    base = [f"t{i}" for i in range(80)]
    copies = []
    for i in range(40):
        words = list(base)
        for _ in range(random.randint(0, 6)):
            words[random.randrange(80)] = random.choice("xyz")
        copies.append((10_000 + i, " ".join(words[:random.randint(60, 80)])))
    near = spark.createDataFrame(copies, "doc_id bigint, text string")
    frame = documents.select("doc_id", "text").union(near).union(odd.filter("doc_id in (2, 3, 4, 11)").select("doc_id", "text"))
    frame = frame.groupBy("doc_id").agg(F.max("text").alias("text"))
    want = _groups(_sets(frame.collect(), shingle), least)
    assert sorted(map(tuple, ngram_join.link_groups(frame, shingle, least).collect())) == sorted(want)
    found = {(r["doc_id"], r["component_id"]) for r in ngram_join.link_groups(odd).collect()}
    assert len(found) > 10 and (None, None) in found
    assert ngram_join.link_groups(nothing).isEmpty()
    kept = ngram_join.one_of_each_group(frame, shingle, least)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(d for d, _, c in want if d == c)


@pytest.mark.parametrize("block", [4096, 5])
def test_jaccard_of_crowds(spark, monkeypatch, block):
    """Stars whose points do not link with each other, chains, near misses, lists longer than a block."""
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    random.seed(9)
    texts, base = [], [f"b{i}" for i in range(120)]
    for i in range(60):  # each a link from the base, few from each other
        words = list(base)
        for k in random.sample(range(120), random.randint(1, 3)):
            words[k] = f"own{i}x{k}"
        texts.append(words)
    texts.append(base)
    chain = [f"c{i}" for i in range(100)]
    for i in range(25):  # each like the one before, none like the one after next
        chain = [*chain[2:], f"new{i}a", f"new{i}b"]
        texts.append(list(chain))
    for i in range(40):  # the same line in texts that are else their own
        texts.append([*(f"line{k}" for k in range(12)), *(f"o{i}x{k}" for k in range(random.randint(0, 4)))])
    random.shuffle(texts)
    frame = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id bigint, text string")
    want = _groups(_sets(frame.collect(), 3), 90)
    assert sorted(map(tuple, ngram_join.link_groups(frame).collect())) == sorted(want)
    assert len({c for _, _, c in want}) > 10


def test_one_row_of_each_group_whatever_its_id(spark):
    near = [f"t{i}" for i in range(60)]
    other = " ".join(f"u{i}" for i in range(60))
    texts = [(1, " ".join(near)), (7, " ".join([*near[:59], "x"])), (7, "a text that no other row is like at all"),
             (8, other), (8, other), (8, other.upper()), (None, "null id and copies of one text"),
             (None, "null id and copies of one text"), (None, " ".join(["y", *near[1:]])), (None, "alone and without an id"),
             (9, "the same text under two ids here"), (3, "the same text under two ids here"), (4, None), (4, ""), (None, " ")]
    for seed in range(2):
        random.seed(seed)
        rows = [(d, t, i) for i, (d, t) in enumerate(random.sample(texts, len(texts)))]
        frame = spark.createDataFrame(rows, "doc_id bigint, text string, row int").coalesce(1)
        groups = {}
        sets = _sets([{"doc_id": i, "text": t} for _, t, i in rows], 5)
        for i, _, group in _groups(sets, 80):
            groups.setdefault(group, []).append(rows[i])
        want = [min(g, key=lambda r: (r[0] is None, r[0] or 0, r[2])) for g in groups.values()]
        got = [tuple(r) for r in ngram_join.one_of_each_group(frame, 5, 80).collect()]
        assert len(want) == 9 and sorted(got, key=repr) == sorted(want, key=repr)


def test_groups_are_found_without_broadcasts_of_tables_that_grow(spark, monkeypatch):
    """Tables that seem small to Spark are built in the driver, many times as large, and copies for salts 64 times that."""
    monkeypatch.setattr("evenkeel.plans.staging.PIN_ROWS", 0)
    thresholds, overlaps = [], ngram_join._overlaps

    def watched(pairs, sets):
        thresholds.append(int(spark.conf.get("spark.sql.autoBroadcastJoinThreshold")))
        return overlaps(pairs, sets)

    monkeypatch.setattr(ngram_join, "_overlaps", watched)
    near = [[f"{k}w{i}" for i in range(40)] for k in range(20)]
    rows = [(2 * k + late, " ".join([*w[:-1], "x"] if late else w)) for k, w in enumerate(near) for late in (0, 1)]
    kept = ngram_join.one_of_each_group(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert sorted(r["doc_id"] for r in kept.collect()) == list(range(0, 40, 2))
    assert "Broadcast" not in kept._jdf.queryExecution().executedPlan().toString()
    assert thresholds and max(thresholds) <= 256 << 10


def test_components_of_chains_and_hubs(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, 100 + i) for i in range(1, 20)] + [(119, 200), (5, 5)]
    got = {tuple(r) for r in components.components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    assert got == {(i, 0) for i in range(31)} | {(100 + i, 100) for i in range(20)} | {(200, 100)}


def _scores(rows, held_out=None):
    """The model in plain Python; it sums to one over the words and an unknown one."""
    words = [(r["doc_id"], WORDS.findall((r["text"] or "").translate(LOWER)) + ["\n"]) for r in rows]
    held = [held_out if held_out is not None else d is not None and zlib.crc32(str(d).encode()) % 7 == 2 for d, _ in words]
    one, two = Counter(), Counter()
    for (_, w), h in zip(words, held, strict=True):
        if not h:
            one.update(w)
            two.update(zip(["\n", *w[:-1]], w, strict=True))
    after, total, distinct = Counter(c for c, _ in two), sum(one.values()), len(one)

    def p1(w):
        return (one[w] + 1) / (total + distinct + 1)

    def p(c, w):
        return (max(two[c, w] - 0.75, 0) + 0.75 * after[c] * p1(w)) / one[c] if one[c] else p1(w)

    for c in ["\n", *list(one)[:20], "no such word"]:  # the last word is any unknown one
        assert sum(p(c, w) for w in [*one, "no such word"]) == pytest.approx(1)
    for (d, w), h in zip(words, held, strict=True):
        yield (d, h, len(w), sum(one[t] > 0 for t in w), total, sum(math.log10(p1(t)) for t in w),
               sum(math.log10(p(c, t)) for c, t in zip(["\n", *w[:-1]], w, strict=True)))


@pytest.mark.parametrize("part,bucket", [(600, 3_000), (2_000_000, 2_000_000), (5_000, 700)])
def test_language_model(documents, odd, nothing, part, bucket, monkeypatch):
    """Parts of few documents, ranges of few contexts, and contexts that are divided."""
    monkeypatch.setattr(language_model, "PART_TOKENS", part)
    monkeypatch.setattr(language_model, "BUCKET_TOKENS", bucket)
    some = documents.select("doc_id", "text").limit(120) if bucket < 10_000 else documents
    ends = documents.sparkSession.createDataFrame([(-(1 << 63), "an id as small as can be"), (None, "and none")],
                                                  "doc_id bigint, text string")
    for frame in (some.select("doc_id", "text").union(ends).cache(), odd):
        got = sorted(map(tuple, language_model.score(frame).collect()), key=repr)
        want = sorted(_scores(frame.collect()), key=repr)
        for g, w in zip(got, want, strict=True):
            assert g[:5] == w[:5] and g[5] == pytest.approx(w[5], rel=1e-9)
            assert abs(g[6] - w[6]) < g[2] / 2 / language_model.STEPS + 1e-6  # half a step a token
    assert language_model.score(nothing).isEmpty()
    assert {r["train_tokens"] for r in language_model.score(documents, F.lit(True)).collect()} == {0}


def test_language_model_leaves_no_shuffles_of_what_it_has_written(spark, documents):
    folders = list(spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString())

    def shuffles():
        return {path.name.split("_")[1] for folder in folders for path in Path(folder).glob("*/shuffle_*.data")}

    before = shuffles()
    language_model.score(documents)
    end = time.monotonic() + 20  # removal is asked for, not awaited
    while len(shuffles() - before) > 2 and time.monotonic() < end:
        time.sleep(0.2)
    assert len(shuffles() - before) <= 2  # of the two sums; the requests and the parts that asked are gone


@pytest.mark.parametrize("stretch", [1 << 18, 7, 1])
def test_elias_fano_and_trie(tmp_path, monkeypatch, stretch):
    monkeypatch.setattr(elias_fano, "STRETCH", stretch)
    rng = np.random.default_rng(2)
    for n, top in ((1, 1), (5, 3), (1000, 1 << 40), (5000, 900)):
        values = np.sort(rng.integers(0, top, n))
        assert (EliasFano.of(values)[np.arange(n)] == values).all()
        for a, b in [(0, n), (n // 3, n // 2), (n - 1, n), (n // 2, n // 2)]:
            assert (EliasFano.of(values).stretch(a, b) == values[a:b]).all()
    pairs = np.unique(rng.integers(0, 400, 300))
    context, word = np.divmod(pairs, 20)
    trie = BigramTrie(context, word, np.arange(len(pairs)).astype(np.uint16), 20, str(tmp_path))
    asked = np.arange(400)
    want = np.where(np.isin(asked, pairs), np.searchsorted(pairs, asked), -1)
    assert (trie.find(*np.divmod(asked, 20)) == want).all()


def test_induced_sorting_with_spills_and_recursion(tmp_path):
    random.seed(6)
    for k in range(120):
        text = [random.randint(1, random.choice([1, 2, 3, 20])) for _ in range(random.randint(1, 120))] + [0]
        order = induced_sort.suffix_order(np.array(text), str(tmp_path / str(k)), random.choice([1, 4, 30, 1 << 20]))
        assert order.tolist() == sorted(range(len(text)), key=lambda i: text[i:])


def _removed(rows):
    seen = set()
    for d, data in sorted(rows):
        gone = np.zeros(len(data), bool)
        for i in range(len(data) - 99):
            if data[i:i + 100] in seen:
                gone[i:i + 100] = True
            seen.add(data[i:i + 100])
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        kept = bytes(np.frombuffer(data, np.uint8)[~gone])
        yield d, len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()


def test_repeated_strings(spark, documents, odd, nothing, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PLACES", np.uint64(1 << 12))
    periodic = spark.createDataFrame(
        [(50_000 + i, t) for i, t in enumerate(["ab" * 300, "a" * 250, "xyz" * 50 + "ab" * 100, "é" * 99, "é" * 150 + "q"])],
        "doc_id bigint, text string")
    clean = odd.filter("doc_id IS NOT NULL AND doc_id <> 7").select("doc_id", "text").distinct()
    frame = documents.select("doc_id", "text").filter("doc_id > 12").union(periodic).union(clean)
    want = _removed((r["doc_id"], (r["text"] or "").encode()) for r in frame.collect())
    assert sorted(map(tuple, suffix_dedup.remove_repeats(frame).collect())) == sorted(want)
    assert suffix_dedup.remove_repeats(odd).count() == odd.count() and suffix_dedup.remove_repeats(nothing).isEmpty()
    assert suffix_dedup.without_repeats(odd).columns == odd.columns


def test_texts_under_one_id_or_none_are_told_apart(spark):
    """Equal checksums, null ids, the smallest id, repeated rows: of each string one copy stays, and only one."""
    seen, pair = {}, None
    while pair is None:
        text = "".join(random.choices("abcdefghij", k=10))
        other = seen.setdefault(zlib.crc32(text.encode()), text)
        pair = (other, text) if other != text else None
    tail = "".join(random.choices("klmnopqrst", k=300))
    for one, other in ((None, None), (4, 4), (-(1 << 63), None), (1, 2)):
        frame = spark.createDataFrame([(one, pair[0] + tail), (other, pair[1] + tail)], "doc_id bigint, text string")
        rows = suffix_dedup.remove_repeats(frame).collect()
        assert sorted(r["n_removed"] for r in rows) == [0, 300]
        if one != other:  # a null id comes first, then the smaller one
            assert [r["n_removed"] for r in rows if r["doc_id"] == min(filter(None, (one, other)))] == [300 if None in (one, other) else 0]
        kept = suffix_dedup.without_repeats(frame).collect()
        assert sorted(len(r["text"]) for r in kept) == [10, 310]
    # Null ids in any number against a restatement that numbers the texts as the operator orders them.
    texts = ["".join(random.choices("uvwxyz", k=40)) + tail[a:a + 120] + "".join(random.choices("uvwxyz", k=40))
             for a in [random.randrange(180) for _ in range(40)]]
    frame = spark.createDataFrame([(None if i % 2 else 7, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    total = sum(r["n_removed"] for r in suffix_dedup.remove_repeats(frame).collect())
    order = [(r["text"]) for r in frame.select("text", *suffix_dedup._keys("doc_id", "text")).orderBy(*suffix_dedup.KEYS).collect()]
    assert total == sum(w[2] for w in _removed((i, t.encode()) for i, t in enumerate(order))) > 1000


def test_a_hot_anchor_is_not_one_shard(spark, tmp_path, monkeypatch):
    random.seed(8)
    phrase = "the same phrase of some sixty bytes in each and every document "
    texts = ["".join(random.choices("abcdefgh", k=90)) + phrase * random.randint(1, 2) + random.choice(["x" * 50, "y" * 80])
             + "".join(random.choices("abcdefgh", k=90)) for _ in range(150)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    sizes, sort = str(tmp_path / "sizes"), suffix_dedup.sort_shard

    def sort_shard(pieces):
        with open(sizes, "a") as out:
            out.write(f"{pieces['bytes'].map(len).sum()}\n")
        return sort(pieces)

    monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", 4_000)
    monkeypatch.setattr(suffix_dedup, "sort_shard", sort_shard)
    want = list(_removed((i, t.encode()) for i, t in enumerate(texts)))
    assert sum(w[2] > 0 for w in want) > 100
    assert sorted(map(tuple, suffix_dedup.remove_repeats(frame).collect())) == want
    assert max([0, *map(int, open(sizes))] if (tmp_path / "sizes").exists() else [0]) < 16_000


def test_pipeline(spark, documents):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "language_id", "ngram_jaccard_join", "suffix_array_dedup", "best_fit_packing"]
    docs = documents
    for _, step in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, step(spark, docs, FOLDER).cache()
        assert docs.columns == documents.columns and 0 < docs.count() <= before.count()
    placed = corpus_pipeline.run(spark, FOLDER)
    assert {r["doc_id"] for r in placed.collect()} == {r["doc_id"] for r in docs.collect()}
