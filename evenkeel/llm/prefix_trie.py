"""The prefix trie of conversations, in double arrays of bounded shards.

A conversation is a sequence of turns, each known by a 128-bit hash of its role and text. Equal sequences are one
class with a number of members. Classes are dealt by a prefix: the first turn, or, where more than a shard's worth of
turns begins alike, as many turns as it takes to tell them apart. A task numbers the turns of its shard densely, packs
their trie into BASE and CHECK arrays and walks every sequence through them. Nodes below the prefix are
complete there; the few above it are shared by shards, and their sums are merged by the hash of their path.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenkeel.plans.staging import look_up, pin, stage

SHARD_TURNS = 1 << 14
WIDTH = 16  # bytes of a turn's hash
NO_ENDS = hashlib.sha256(b"").hexdigest()
DONORS, MOST_BORROWED = 100, 6
FREE = -1


def turn_sequences(conversations: DataFrame) -> DataFrame:
    """``conv, turns, chars`` per conversation: its turns' hashes and their texts' code points (4 bytes each).

    Rows are taken by ``turn``, nulls first; equal turns by role, then by hash. A null role or text is empty. Rows
    without a ``conv_id`` belong to no conversation. One task streams a conversation, at 20 bytes a turn.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv"), F.col("turn").alias("at"), role.alias("role"),
        F.xxhash64(role, text).alias("a"), F.xxhash64(F.lit("turn"), text, role).alias("b"),
        F.length(text).alias("chars"))
    ordered = rows.repartition("conv").sortWithinPartitions("conv", F.asc_nulls_first("at"), "role", "a", "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, pieces = None, []  # the conversation under way

        def ended() -> tuple:
            return last, b"".join(t for t, _ in pieces), b"".join(c for _, c in pieces)

        for batch in batches:
            conv = batch["conv"].to_numpy()
            turns = np.column_stack([batch["a"].to_numpy(), batch["b"].to_numpy()])
            chars = batch["chars"].to_numpy().astype("<u4")
            cuts = np.concatenate([[0], np.flatnonzero(conv[1:] != conv[:-1]) + 1, [len(conv)]]).tolist()
            done = []
            for i, j in zip(cuts, cuts[1:]):
                if i < j:
                    if pieces and conv[i] != last:
                        done.append(ended())
                        pieces = []
                    last = int(conv[i])
                    pieces.append((turns[i:j].tobytes(), chars[i:j].tobytes()))
            yield _sequence_batch(done)
        if pieces:
            yield _sequence_batch([ended()])

    return ordered.select("conv", "a", "b", "chars").mapInArrow(run, "conv bigint, turns binary, chars binary")


def _sequence_batch(rows: list[tuple]) -> pa.RecordBatch:
    conv, turns, chars = zip(*rows) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(conv, pa.int64()), pa.array(turns, pa.binary()), pa.array(chars, pa.binary())],
        ["conv", "turns", "chars"])


def rebuilt(sequences: DataFrame) -> DataFrame:
    """Every conversation c with its first h turns replaced by those of c - c % 100; h is crc32(c) % 6.

    A donor with fewer turns lends what it has, an absent one nothing. ``%`` is SQL's: it keeps the sign.
    """
    donor = F.col("conv") - F.col("conv") % DONORS
    heads = sequences.filter(F.col("conv") % DONORS == 0).select(
        F.col("conv").alias("donor"), F.expr(f"substring(turns, 1, {WIDTH * MOST_BORROWED})").alias("head"),
        F.expr(f"substring(chars, 1, {4 * MOST_BORROWED})").alias("head_chars"))
    borrowed = F.pmod(F.crc32(F.col("conv").cast("string").cast("binary")), F.lit(MOST_BORROWED)).cast("int")
    met = sequences.join(heads, donor == F.col("donor"), "left").withColumn("h", borrowed)

    def grafted(head: str, own: str, width: int) -> str:
        return f"concat(substring(coalesce({head}, X''), 1, {width} * h), substring({own}, {width} * h + 1))"

    return met.select("conv", F.expr(grafted("head", "turns", WIDTH)).alias("turns"),
                      F.expr(grafted("head_chars", "chars", 4)).alias("chars"))


def _path(turns: str, depth: str) -> F.Column:
    return F.unhex(F.md5(F.expr(f"substring({turns}, 1, {WIDTH} * {depth})")))


def _common_turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of the least and the greatest sequence of a prefix: the depth at which its sequences part."""
    for batch in batches:
        parted = []
        for low, high in zip(batch["low"].to_pylist(), batch["high"].to_pylist()):
            n = min(len(low), len(high)) // WIDTH
            same = (np.frombuffer(low, np.uint64, 2 * n) == np.frombuffer(high, np.uint64, 2 * n)).reshape(n, 2).all(axis=1)
            parted.append((n if same.all() else int(same.argmin())) + 1)
        yield pa.RecordBatch.from_arrays([batch["path"], pa.array(parted, pa.int32())], ["path", "parted"])


def _shard_prefixes(kinds: DataFrame, shard_turns: int) -> DataFrame:
    """``rep, top, path``: the depth and hash of the prefix that each class is dealt by.

    While a prefix has several classes and more turns than a shard, it is replaced by prefixes one turn longer than
    what all of them share. Only those classes are looked at again.
    """
    spark = kinds.sparkSession
    going = kinds.select("rep", "turns", F.lit(1).alias("top"))
    settled = []
    while True:
        named = going.withColumn("path", _path("turns", "top"))
        size = F.sum(F.length("turns") / WIDTH + 1)
        large = pin(named.groupBy("path").agg(size.alias("size"), F.count(F.lit(1)).alias("members")).filter(
            (F.col("size") > shard_turns) & (F.col("members") > 1)).select("path"), "large-prefixes")
        if large.rows == []:
            settled.append(named.select("rep", "top", "path"))
            break
        marked = stage(look_up(named, _marked(large), ["path"], "left"), "prefixes")
        settled.append(marked.filter("large is null").select("rep", "top", "path"))
        inside = marked.filter("large").select("rep", "turns", "path")
        ends = inside.groupBy("path").agg(F.min("turns").alias("low"), F.max("turns").alias("high"))
        parted = pin(ends.mapInArrow(_common_turns, "path binary, parted int"), "parted")
        going = look_up(inside, parted, ["path"]).select("rep", "turns", F.col("parted").alias("top"))
    out = settled[0]
    for more in settled[1:]:
        out = out.union(more)
    return out


def _marked(large):
    return type(large)(large.df.withColumn("large", F.lit(True)), large.small)


class DoubleArray:
    """BASE and CHECK: the child of node s under label c is t = BASE[s] + c where CHECK[t] = s. The root is 0."""

    def __init__(self) -> None:
        self.base, self.check, self.used, self.first_free = np.zeros(64, np.int64), np.full(64, FREE), 1, 1
        self.check[0] = 0

    def _room(self, last: int) -> None:
        if last >= len(self.check):
            more = max(last + 1, 2 * len(self.check)) - len(self.check)
            self.base = np.concatenate([self.base, np.zeros(more, np.int64)])
            self.check = np.concatenate([self.check, np.full(more, FREE)])
        self.used = max(self.used, last + 1)

    def _place(self, parent: int, labels: np.ndarray) -> None:
        """First fit over a few free slots near the front, else behind all."""
        spread = labels - labels[0]
        for slot in np.flatnonzero(self.check[self.first_free:self.used] == FREE)[:8] + self.first_free:
            at = slot + spread
            if at[-1] < self.used and (self.check[at] == FREE).all():
                break
        else:
            at = self.used + spread
            self._room(int(at[-1]))
        self.base[parent], self.check[at] = at[0] - labels[0], parent

    def add(self, parents: np.ndarray, labels: np.ndarray) -> None:
        """Children of nodes that have none, sorted by parent, then label."""
        starts = np.concatenate([[0], np.flatnonzero(parents[1:] != parents[:-1]) + 1])
        counts = np.diff(np.append(starts, len(parents)))
        for i in np.flatnonzero(counts > 1):
            self._place(int(parents[starts[i]]), labels[starts[i]:starts[i] + counts[i]])
        one = starts[counts == 1]  # these fit anywhere: they fill the gaps
        free = np.flatnonzero(self.check[self.first_free:self.used] == FREE)[:len(one)] + self.first_free
        if len(free) < len(one):
            begin = self.used
            self._room(begin + len(one) - len(free) - 1)
            free = np.concatenate([free, np.arange(begin, begin + len(one) - len(free))])
        self.base[parents[one]], self.check[free] = free - labels[one], parents[one]
        rest = np.flatnonzero(self.check[self.first_free:self.used] == FREE)
        self.first_free = self.first_free + int(rest[0]) if len(rest) else self.used

    def step(self, nodes: np.ndarray, labels: np.ndarray) -> np.ndarray:
        """The children, FREE where there is none."""
        at = self.base[nodes] + labels
        inside = (at > 0) & (at < self.used)
        return np.where(inside & (self.check[np.where(inside, at, 0)] == nodes), at, FREE)


def pack_trie(turns: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[DoubleArray, np.ndarray]:
    """The trie of sequences of turn numbers, level by level, and the dense label of each turn.

    Labels are given in the order of first sight, so that siblings are neighbours and pack closely.
    """
    trie, many = DoubleArray(), int(turns.max(initial=0)) + 1
    dense, known = np.full(many, FREE), 0
    nodes, level = np.zeros(len(starts), np.int64), 0
    active = np.flatnonzero(lengths > 0)
    while len(active):
        edges, which = np.unique(nodes[active] * many + turns[starts[active] + level], return_inverse=True)
        parents, seen = edges // many, edges % many
        fresh, first = np.unique(seen[dense[seen] == FREE], return_index=True)
        dense[fresh[np.argsort(first)]] = np.arange(known, known + len(fresh))
        known += len(fresh)
        order = np.lexsort((dense[seen], parents))
        trie.add(parents[order], dense[seen][order])
        nodes[active] = trie.step(parents, dense[seen])[which]
        level += 1
        active = active[lengths[active] > level]
    return trie, dense


def _shard_nodes(table: pa.Table) -> pa.Table:
    """All nodes of one shard; see ``NODES``."""
    rep, members, top = (table[c].to_numpy() for c in ("rep", "n", "top"))
    blobs, sizes = table["turns"].to_pylist(), table["chars"].to_pylist()
    lengths = np.array([len(b) // WIDTH for b in blobs], np.int64)
    starts = np.cumsum(lengths) - lengths
    _, turns = np.unique(np.frombuffer(b"".join(blobs), f"V{WIDTH}"), return_inverse=True)
    chars_of = np.frombuffer(b"".join(sizes), "<u4").astype(np.int64)
    trie, dense = pack_trie(turns, starts, lengths)

    n = trie.used
    convs, least, depth = np.zeros(n, np.int64), np.full(n, np.iinfo(np.int64).max), np.zeros(n, np.int64)
    chars, through, limit = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
    end, nodes, level = np.full(n, FREE), np.zeros(len(rep), np.int64), 0
    active = np.arange(len(rep))
    while len(active):
        at = nodes[active]
        np.add.at(convs, at, members[active])
        np.minimum.at(least, at, rep[active])
        depth[at], through[at], limit[at] = level, active, top[active]
        if level:
            chars[at] = chars_of[starts[active] + level - 1]
        over = lengths[active] == level
        end[at[over]] = active[over]
        active = active[~over]
        nodes[active] = trie.step(nodes[active], dense[turns[starts[active] + level]])
        level += 1

    real = np.flatnonzero(convs)
    parent, below = trie.check[:n], real[real > 0]
    children = np.bincount(parent[below], minlength=n)
    whole = depth >= limit  # the others are shared with other shards
    leaves = np.where(whole & (convs > 0) & (children == 0), 1, 0)
    saved = np.where(whole, (convs - 1) * chars, 0)
    by_depth = below[np.argsort(-depth[below], kind="stable")]
    for level_nodes in np.split(by_depth, np.flatnonzero(np.diff(depth[by_depth])) + 1):
        np.add.at(leaves, parent[level_nodes], leaves[level_nodes])
        np.add.at(saved, parent[level_nodes], saved[level_nodes])
    complete_children = np.bincount(parent[below[whole[below]]], minlength=n)

    paths: dict[int, list[bytes]] = {}
    for i in real[~whole[real]][np.argsort(depth[real[~whole[real]]], kind="stable")].tolist():
        own = hashlib.md5(blobs[through[i]][:WIDTH * int(depth[i])]).digest()
        paths[i] = [*(paths[int(parent[i])] if i else []), own]
    shared_parent = ~whole[parent] & (np.arange(n) > 0)
    ended = end[real] >= 0
    return pa.table([
        pa.array(least[real]), pa.array(depth[real]),
        pa.array(least[parent[real]], mask=shared_parent[real] | (real == 0)),
        pa.array([paths[int(parent[i])][-1] if shared_parent[i] else None for i in real.tolist()], pa.binary()),
        pa.array([paths.get(i) for i in real.tolist()], pa.list_(pa.binary())),
        pa.array(convs[real]), pa.array(np.where(whole, children, complete_children)[real]), pa.array(leaves[real]),
        pa.array(saved[real]), pa.array(chars[real]), pa.array(np.where(ended, rep[end[real]], 0), mask=~ended),
        pa.array(np.where(ended, members[end[real]], 0), pa.int64())],
        names=[c.split()[0] for c in NODES.split(", ")])


# path: hashes of the node's own and all higher prefixes, for shared nodes only. n_children, n_leaves and saved_tokens
# of a shared node are those of the complete nodes below it in this shard.
NODES = ("conv_id bigint, depth bigint, parent_conv_id bigint, parent_key binary, path array<binary>, n_convs bigint, "
         "n_children bigint, n_leaves bigint, saved_tokens bigint, chars bigint, end_rep bigint, n_ends bigint")


def _merged(parts: DataFrame) -> DataFrame:
    """The shared nodes of all shards: sums by path, then what each adds to itself and to all above it."""
    sums = ("n_convs", "n_children", "n_leaves", "saved_tokens", "n_ends")
    upper = stage(parts.withColumn("key", F.element_at("path", -1)).groupBy("key").agg(
        *[F.min(c).alias(c) for c in ("conv_id", "depth", "parent_key", "chars", "end_rep", "path")],
        *[F.sum(c).alias(c) for c in sums]), "upper-nodes")
    shared = upper.filter("parent_key is not null").groupBy(F.col("parent_key").alias("key")).agg(
        F.count(F.lit(1)).alias("n_shared"))
    known = upper.join(shared, "key", "left").withColumn(
        "n_children", F.col("n_children") + F.coalesce("n_shared", F.lit(0))).drop("n_shared")
    adds = known.select(F.explode("path").alias("key"), (F.col("n_children") == 0).cast("bigint").alias("leaf"),
                        ((F.col("n_convs") - 1) * F.col("chars")).alias("saved"))
    added = adds.groupBy("key").agg(F.sum("leaf").alias("leaf"), F.sum("saved").alias("saved"))
    parents = upper.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    return known.join(added, "key").join(parents, "parent_key", "left").withColumns({
        "n_leaves": F.col("n_leaves") + F.col("leaf"), "saved_tokens": F.col("saved_tokens") + F.col("saved")}).select(
        "key", *COLUMNS, "end_rep", "n_ends")


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]


def _end_hashes(sequences: DataFrame, classes: DataFrame) -> DataFrame:
    """``rep, ends_sha256`` of classes with several members: their ids in order, streamed through SHA-256.

    Ranges of ids are written out first, so that a class of a third of all conversations reaches the task that
    hashes it as long strings, a few thousand ids each.
    """
    several = pin(classes.filter("n > 1").select("path", "rep"), "repeated")
    members = stage(look_up(sequences.select("conv", F.unhex(F.md5("turns")).alias("path")), several, ["path"]).select(
        "rep", "conv"), "members")

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rep, conv = batch["rep"].to_numpy(), batch["conv"].to_numpy()
            cuts = np.concatenate([[0], np.flatnonzero(rep[1:] != rep[:-1]) + 1, [len(rep)]]).tolist()
            runs = [(i, j) for i, j in zip(cuts, cuts[1:]) if i < j]
            yield pa.RecordBatch.from_arrays(
                [pa.array([rep[i] for i, _ in runs], pa.int64()), pa.array([conv[i] for i, _ in runs], pa.int64()),
                 pa.array([",".join(map(str, conv[i:j].tolist())) for i, j in runs], pa.string())],
                ["rep", "first", "ids"])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, digest = None, None
        for batch in batches:
            done = []
            for rep, ids in zip(batch["rep"].to_pylist(), batch["ids"].to_pylist()):
                if rep == last:
                    digest.update(b"," + ids.encode())
                    continue
                if digest:
                    done.append((last, digest.hexdigest()))
                last, digest = rep, hashlib.sha256(ids.encode())
            yield _hash_batch(done)
        if digest:
            yield _hash_batch([(last, digest.hexdigest())])

    pieces = members.repartitionByRange("conv").sortWithinPartitions("rep", "conv").mapInArrow(
        written, "rep bigint, first bigint, ids string")
    return pieces.repartition("rep").sortWithinPartitions("rep", "first").mapInArrow(
        hashed, "rep bigint, ends_sha256 string")


def _hash_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r for r, _ in rows], pa.int64()), pa.array(
        [h for _, h in rows], pa.string())], ["rep", "ends_sha256"])


def trie_nodes(sequences: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """One row per node of the trie of ``sequences`` (``conv, turns, chars`` as of ``turn_sequences``, unique ``conv``).

    ``conv_id`` (smallest member), ``depth``, ``parent_conv_id`` (null for the root), ``n_convs``, ``n_children``,
    ``n_leaves``, ``saved_tokens``, ``ends_sha256``. A conversation without turns ends at the root. No conversations,
    no rows. A class larger than a shard is a shard of its own; its turns are held by one task.
    """
    sequences = stage(sequences, "sequences")
    classes = stage(sequences.groupBy(F.unhex(F.md5("turns")).alias("path")).agg(
        F.min("conv").alias("rep"), F.count(F.lit(1)).alias("n")), "classes")
    kinds = stage(sequences.join(classes, F.col("conv") == F.col("rep")).select("rep", "n", "turns", "chars"), "kinds")
    total = kinds.agg(F.sum(F.length("turns") / WIDTH + 1)).first()[0] or 0
    shards = int(-(-total // shard_turns)) or 1
    dealt = kinds.join(_shard_prefixes(kinds, shard_turns), "rep").withColumn(
        "shard", F.pmod(F.xxhash64("path"), F.lit(shards))).drop("path")
    nodes = stage(dealt.groupBy("shard").applyInArrow(_shard_nodes, NODES), "nodes")

    upper = stage(_merged(nodes.filter("path is not null")), "shared-nodes")
    tops = pin(upper.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("top_conv_id")), "tops")
    complete = nodes.filter("path is null")
    under = look_up(complete.filter("parent_key is not null"), tops, ["parent_key"]).withColumn(
        "parent_conv_id", F.col("top_conv_id"))
    columns = [*COLUMNS, "end_rep", "n_ends"]
    rows = stage(complete.filter("parent_key is null").select(*columns).union(under.select(*columns)).union(
        upper.select(*columns)), "trie")
    own = F.when(F.col("n_ends") == 0, F.lit(NO_ENDS)).otherwise(F.sha2(F.col("end_rep").cast("string"), 256))
    few = rows.filter("n_ends < 2").select(*COLUMNS, own.alias("ends_sha256"))
    hashes = _end_hashes(sequences, classes)
    many = rows.filter("n_ends > 1").join(hashes, F.col("end_rep") == F.col("rep")).select(*COLUMNS, "ends_sha256")
    return few.union(many)


def rebuilt_nodes(conversations: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """The trie of the rebuilt conversations of a table ``conv_id, turn, role, text``; other columns are not read."""
    return trie_nodes(rebuilt(stage(turn_sequences(conversations), "own-sequences")), shard_turns)
