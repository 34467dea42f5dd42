"""Operators on conversations, and SimHash groups, against plain restatements of their contracts."""

import hashlib
import heapq
import random
import re
import zlib
from collections import defaultdict

import pytest
import xxhash
from compare import duck, differences
from pyspark.sql import functions as F

from evenkeel.llm import conversation_repair, prefix_trie, queries, simhash_join

FOLDER = "/root/testdata/sf0.001"
EMPTY = hashlib.sha256(b"").hexdigest()


@pytest.fixture(scope="module")
def conversations(spark):
    return spark.read.parquet(f"{FOLDER}/conversations.parquet")


@pytest.fixture(scope="module")
def strange(spark):
    """Nulls in any column, empty texts, repeated rows, shared and nested beginnings, clashing names."""
    draw = random.Random(7)
    rows = [(None, 0, "user", "no id"), (None, None, None, None), (-3, 0, "user", "negative."), (-100, 0, "user", "x!")]
    for conv in range(420):
        if conv % 100 == 0 and conv != 200:
            rows += [(conv, t, "user" if t % 2 == 0 else "assistant", f"{conv // 200} head {t}.") for t in range(draw.choice([2, 7]))]
            continue
        for t in range(draw.randrange(0, 9)):
            role = draw.choice(["user", "assistant", "system", "user", "assistant", None, "", "tool", "İx"])
            text = draw.choice(["Hi.", "Hi.", "well", " \t", "", None, "a b?", "x! \n", "é…", f"own {conv}.", "?!."])
            rows.append((conv, draw.choice([t, t, t, t + 3, None]), role, text))
        if conv % 50 == 7:
            rows += rows[-2:]
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    for name in ("depth", "rep", "copy", "fault", "n", "at", "conv", "path", "key", "a", "h"):
        frame = frame.withColumn(name, F.lit("y"))
    return frame.repartition(5, "text").cache()


def _by_turn(rows):
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            out[conv].append((turn, role, text))
    return out


def _first(turn):
    return (turn is not None, turn or 0)


def trie_brute_force(rows, tie=None):
    own = {c: [(r or "", t or "") for _, r, t in sorted(v, key=lambda x: (*_first(x[0]), x[1] or "", tie(x) if tie else 0))]
           for c, v in _by_turn(rows).items()}
    built = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        donor = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        built[c] = own.get(donor, [])[:h] + own[c][h:]
    members, children = defaultdict(list), defaultdict(set)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    for node in members:
        if node:
            children[node[:-1]].add(node)

    below = {}
    for node in sorted(members, key=len, reverse=True):
        leaves, saved = (0 if children[node] else 1), (len(members[node]) - 1) * (len(node[-1][1]) if node else 0)
        for child in children[node]:
            leaves, saved = leaves + below[child][0], saved + below[child][1]
        below[node] = leaves, saved
    out = []
    for node, convs in members.items():
        ends = ",".join(str(c) for c in sorted(convs) if len(built[c]) == len(node))
        out.append((min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), len(children[node]),
                    *below[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


TRIE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def _trie(frame):
    assert frame.columns == TRIE and [t for _, t in frame.dtypes] == ["bigint"] * 7 + ["string"]
    return sorted(map(tuple, frame.collect()), key=repr)


def _rows(frame):
    return [tuple(r) for r in frame.select("conv_id", "turn", "role", "text").collect()]


@pytest.mark.parametrize("shard", [prefix_trie.SHARD_TURNS, 40, 3])
def test_trie(conversations, shard):
    assert _trie(prefix_trie.rebuilt_nodes(conversations, shard)) == trie_brute_force(_rows(conversations))


def test_trie_of_odd_rows(strange, many_groups):
    one_order = strange.dropDuplicates(["conv_id", "turn", "role"])  # so that no tie is left to a hash
    assert _trie(prefix_trie.rebuilt_nodes(one_order, 25)) == trie_brute_force(_rows(one_order))
    again = [_trie(prefix_trie.rebuilt_nodes(f, n)) for f, n in ((strange, 30), (strange.repartition(2), 1 << 14))]
    assert again[0] == again[1]
    assert prefix_trie.rebuilt_nodes(strange.filter("false")).isEmpty()


def test_trie_of_hot_beginnings(spark):
    """A long beginning that all share, many copies of one conversation, one that ends inside the beginning."""
    head = [("user", f"h{i}") for i in range(9)]
    rows = [(c, t, r, x) for c in range(1, 300) for t, (r, x) in enumerate(
        head[:9 if c % 60 else 5] + ([("user", f"own {c % 40}"), ("user", f"more {c}")] if c % 3 else []))]
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").cache()
    sequences = prefix_trie.turn_sequences(frame)
    small, large = (_trie(prefix_trie.trie_nodes(sequences, n)) for n in (30, 1 << 14))
    assert small == large and small[0][3] == 299
    assert _trie(prefix_trie.rebuilt_nodes(frame, 30)) == trie_brute_force(rows)


def test_double_array():
    import numpy as np
    draw = random.Random(1)
    kinds = sorted({tuple(draw.choices(range(50), [1 / (i + 1) for i in range(50)], k=draw.randrange(1, 7)))
                    for _ in range(3000)})
    flat = np.array([x for k in kinds for x in k])
    lengths = np.array([len(k) for k in kinds])
    starts = np.cumsum(lengths) - lengths
    trie, dense = prefix_trie.pack_trie(flat, starts, lengths)
    nodes = {(): 0}
    for k in kinds:
        for d in range(1, len(k) + 1):
            at = int(trie.step(np.array([nodes[k[:d - 1]]]), np.array([dense[k[d - 1]]]))[0])
            assert at > 0 and nodes.setdefault(k[:d], at) == at
    assert len(set(nodes.values())) == len(nodes) == int((trie.check != prefix_trie.FREE).sum())
    assert trie.used < 2 * len(nodes)
    absent = int(trie.step(np.array([nodes[kinds[0]]]), np.array([49]))[0])
    assert (kinds[0] + (49,) in nodes) == (absent > 0)


# --- repair -------------------------------------------------------------------------------------

def damage(rows):
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is None:
            continue
        role, text = " " if role is None else role, " " if text is None else text
        hit = zlib.crc32(f"{conv}:{' ' if turn is None else turn}".encode()) % 20
        kept = out[conv]
        if hit == 0:
            continue
        text = "" if hit == 1 else re.sub("[.!?]", "", text) if hit == 2 else text
        kept += [(turn, "user" if hit == 4 else role, text)] * (2 if hit == 3 else 1)
    return {c: sorted(v, key=lambda x: (*_first(x[0]), x[1], x[2])) for c, v in out.items()}


def cheapest(rows):
    """Dijkstra over (cost, audit) from the first row on; ``rows`` of role, text, fault."""
    def state(at, initial):
        return {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}.get((at, initial))

    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, at, out = heapq.heappop(heap)
        if i == len(rows) and at in ("", "a"):
            return cost, audit, "\n".join(f"{r}:{t}" for r, t in out)
        if (i, at) in done:
            continue
        done.add((i, at))
        for role in ("user", "assistant"):
            if (to := state(at, role[0])):
                heapq.heappush(heap, (cost + 3, audit + "I", i, to, (*out, (role, ""))))
        if i < len(rows):
            role, text, fault = rows[i]
            heapq.heappush(heap, (cost + 4, audit + "D", i + 1, at, out))
            if fault not in ("blank", "duplicate"):
                extra = 3 * (fault == "truncated")
                if (to := state(at, role[:1])):
                    heapq.heappush(heap, (cost + extra, audit + "K", i + 1, to, (*out, (role, text))))
                for new in ("user", "assistant"):
                    if (to := state(at, new[0])):
                        heapq.heappush(heap, (cost + 3 + extra, audit + "R", i + 1, to, (*out, (new, text))))


def repair_brute_force(rows):
    out = []
    for conv, turns in damage(rows).items():
        seen, faults = set(), []
        for _, role, text in turns:
            inked = re.findall(r"[^\x20\x09-\x0D]", text)
            faults.append("blank" if not inked else "duplicate" if (role, text) in seen
                          else "truncated" if inked[-1] not in ".!?" else "")
            seen.add((role, text))
        known = [t for t, _, _ in turns if t is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        initials = [r[:1] for _, r, _ in turns]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit, text = cheapest([(r, t, f) for (_, r, t), f in zip(turns, faults)])
        out.append((conv, gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit,
                    hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out)


def test_cheapest_edits_are_the_least():
    """The program against an exhaustive search in (cost, audit) order, on short random rows."""
    draw = random.Random(3)
    for _ in range(400):
        rows = [(draw.choice(["system", "user", "assistant", "", "tool"]), f"t{i}", draw.choice(["", "", "", "blank", "truncated"]))
                for i in range(draw.randrange(0, 7))]
        program = conversation_repair.Repair(spill=16)
        program.start(1)
        for i, (role, text, fault) in reversed(list(enumerate(rows))):
            program.feed(i, role, text, ["", "blank", "duplicate", "truncated"].index(fault))
        cost, audit, text = cheapest(rows)
        assert program.result()[6:] == (cost, audit, hashlib.sha256(text.encode()).hexdigest()), rows


def test_repair(conversations, strange):
    for frame in (conversations, strange):
        got = conversation_repair.repair(frame)
        assert [t for _, t in got.dtypes] == ["bigint"] * 7 + ["string"] * 2
        assert sorted(map(tuple, got.collect())) == repair_brute_force(_rows(frame))
    assert conversation_repair.repair(strange.filter("false")).isEmpty()
    gone = [(c, 0, "user", "x.") for c in range(200) if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    frame = strange.sparkSession.createDataFrame(gone, "conv_id bigint, turn bigint, role string, text string")
    assert gone and {tuple(r)[1:] for r in conversation_repair.repair(frame).collect()} == {(0,) * 6 + ("", EMPTY)}


def test_repair_of_a_giant_conversation(spark):
    """More than an Arrow batch and more than the bound in memory; one shuffle, by conversation."""
    frame = spark.range(30_000).select(
        (F.floor(F.col("id") / 1000000) + 5).alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"),
        F.concat(F.lit("turn "), "id", F.when(F.col("id") % 7 == 0, "").otherwise(".")).alias("text"))
    faulty = conversation_repair.with_faults(conversation_repair.damaged(frame))
    small, large = (conversation_repair.repaired(faulty, n).collect() for n in (1000, 1 << 30))
    assert small == large and small[0]["truncated"] > 4000
    plan = conversation_repair.repair(frame)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


# --- SimHash ------------------------------------------------------------------------------------

def fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    grams = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)] if words else []
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def linked(prints):
    """The smallest index that each fingerprint reaches by links of at most three bits."""
    label = list(range(len(prints)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                a, b = find(i), find(j)
                label[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def test_simhash(documents, odd, nothing):
    for frame in (documents, odd):
        rows = frame.select("doc_id", "text").collect()
        prints = [fingerprint(r["text"]) for r in rows]
        group = defaultdict(list)
        for i, g in enumerate(linked(prints)):
            group[g].append(i)
        least = {i: min((rows[j]["doc_id"] for j in g if rows[j]["doc_id"] is not None), default=None)
                 for g in group.values() for i in g}
        want = sorted(repr((r["doc_id"], f"{p:016x}", least[i])) for i, (r, p) in enumerate(zip(rows, prints)))
        got = simhash_join.near_groups(frame)
        assert sorted(repr(tuple(r)) for r in got.collect()) == want
    assert simhash_join.near_groups(nothing).isEmpty()


def test_simhash_links_in_crowds(spark):
    """Very many fingerprints under one signature: they are cut again down to the last level, and no link is lost."""
    draw = random.Random(11)
    base, crowd = draw.getrandbits(64), set()
    for _ in range(900):  # half of them differ in one 32-bit half only, in few places of it
        other = base
        for b in draw.sample(range(32, 44) if draw.random() < 0.5 else range(64), draw.randrange(2, 9)):
            other ^= 1 << b
        crowd.add(other)
    crowd = sorted(crowd)
    signed = [p - (1 << 64) if p >> 63 else p for p in crowd]
    frame = spark.createDataFrame([(p,) for p in signed], "fp bigint")
    want = linked(crowd)
    for group in (1024, 8, 2):
        links = [(r["u"], r["v"]) for r in simhash_join.print_links(frame, group).collect()]
        label = {p: p for p in signed}

        def find(p):
            while label[p] != p:
                p = label[p]
            return p

        for u, v in links:
            label[find(u)] = find(v)
        got = [find(p) for p in signed]
        assert len(set(zip(got, want))) == len(set(got)) == len(set(want))


def test_queries_are_registered():
    assert {f"op{n}" for n in (11, 12, 13)} <= {name.split("_")[0] for name in queries.QUERIES}


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_queries_are_their_sql(spark, name):
    assert differences(queries.QUERIES[name](spark, FOLDER), duck(FOLDER), queries.SQL[name]) is None
