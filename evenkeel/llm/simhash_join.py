"""SimHash near-duplicates by deletion-variant signatures.

Fingerprints of 64 bits that differ in at most three are cut into two halves, one of which then differs in at most
one bit. Each half is indexed as it is and with every single bit left out, so that an equality join on
(half, bit left out, rest) meets every such pair, and the whole fingerprints are compared. Where one signature
is shared by more fingerprints than a task compares at once, the fingerprints under it, which can still differ in the
other half only, are cut again in the same way: 32, 16, 8 and 4 bits. What meets on the last level is bounded by the
bits that are left, so no group is ever compared in full that the corpus could make large.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenkeel.llm.components import components
from evenkeel.plans.staging import stage

SHINGLE, SEED = 3, 42
MOST_BITS = 3
GROUP = 1024  # the square of this many fingerprints of one signature is compared at once
HELD = 1 << 18
AT_ONCE = 1 << 13  # hashes whose bits are laid out at once
LEVELS = (32, 16, 8, 4)


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Majority bits of the XXH64 hashes of a text's shingles, as a signed 64-bit number; 0 without words."""
    words = text.lower().split()  # of bytes: A-Z and ASCII white space only
    if not words:
        return 0
    count = max(1, len(words) - shingle + 1)
    found = zip(*(words[i:] for i in range(shingle))) if len(words) >= shingle else [words]
    h = np.fromiter((xxhash.xxh64_intdigest(b" ".join(w), SEED) for w in found), "<u8", count)
    ones = np.zeros(64, np.int64)
    for i in range(0, count, AT_ONCE):
        part = h[i:i + AT_ONCE].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > count, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, fp`` per row; a null or empty text, or one of white space, has 0."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(t.as_py() or b"", shingle) for t in batch["text"]]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(prints, pa.int64())], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("binary").alias("text")).mapInArrow(
        run, "doc_id bigint, fp bigint")


def _signatures(groups: DataFrame, width: int) -> DataFrame:
    """``key, low, fp``: the variants of both pieces of the span that may still differ.

    ``groups`` has ``key, low, fp``: fingerprints under one signature and the lowest bit of their open span of
    ``2 * width`` bits. The new ``low`` is where the piece begins that was not indexed.
    """
    piece = F.explode(F.expr(f"array(struct(low as own, low + {width} as low), struct(low + {width} as own, low as low))"))
    halves = groups.select("key", "fp", "low", piece.alias("p")).select("key", "fp", "p.own", "p.low")
    value = F.expr(f"shiftrightunsigned(fp, own) & {(1 << width) - 1}L")
    # Variant -1 is the piece itself; variant i is the piece without bit i.
    variants = F.explode(F.sequence(F.lit(-1), F.lit(width - 1))).alias("without")
    out = halves.select("key", "fp", "own", "low", value.alias("value"), variants)
    rest = F.when(F.col("without") < 0, F.col("value")).otherwise(
        F.expr("value & ~shiftleft(1L, greatest(without, 0))"))
    bit = F.when(F.col("without") >= 0, F.col("own") + F.col("without")).otherwise(-1).alias("bit")
    return out.select(F.xxhash64("key", "own", "without", rest).alias("key"), "low", bit, "fp")


def _spanning(some: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what is near across the two sides, one less than there are in each part."""
    near = np.bitwise_count(some[:, None] ^ others[None, :]) <= MOST_BITS
    n, both = len(some), np.concatenate([some, others])
    label, none = np.arange(len(both)), len(both)
    while True:
        least = label.copy()
        least[:n] = np.minimum(label[:n], np.where(near, label[None, n:], none).min(axis=1))
        least[n:] = np.minimum(label[n:], np.where(near, least[:n, None], none).min(axis=0))
        least = least[least]
        if (least == label).all():
            break
        label = least
    rest = np.flatnonzero(both[label] != both)
    return both[rest], both[label[rest]]


class _Group:
    """The fingerprints under one signature while its rows pass by.

    Under a piece as it is, all are compared with all. Under a piece without a bit, those that have the bit are
    compared with those that do not: the others have met under the piece as it is. ``most`` fingerprints square
    are compared at once; no more than ``HELD`` are held.
    """

    def __init__(self, key: int, bit: int, most: int | None) -> None:
        self.key, self.bit, self.most, self.held, self.count = key, bit, most, [], [0, 0]

    def add(self, fp: np.ndarray) -> None:
        if self.bit >= 0:
            ones = int(((fp >> self.bit) & 1).sum())
            self.count[0] += len(fp) - ones
            self.count[1] += ones
        else:
            self.count = [self.count[0] + len(fp)] * 2
        if not self.most or sum(map(len, self.held)) < HELD:
            self.held.append(fp)

    def settled(self) -> list[tuple]:
        """Links, or the signature alone if it has too many fingerprints."""
        zeros, ones = self.count
        if not zeros or not ones or self.bit < 0 and zeros < 2:
            return []
        if self.most and (zeros * ones > self.most ** 2 or max(zeros, ones) > HELD):
            return [(self.key, None)]
        own = np.concatenate(self.held).view(np.uint64)
        some, others = own, own
        if self.bit >= 0:
            has = (own >> np.uint64(self.bit)) & np.uint64(1) == 1
            some, others = own[~has], own[has]
        u, v = _spanning(some, others)
        return list(zip(u.view(np.int64).tolist(), v.view(np.int64).tolist()))


def _links(rows: list[tuple]) -> pa.RecordBatch:
    u, v = zip(*rows) if rows else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])


def _compare(signatures: DataFrame, most: int | None) -> DataFrame:
    """``u, v`` where fingerprints of one signature link, and ``u`` alone, the signature, where it has too many.

    Tasks read their signatures in order and hold one group at a time.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group = None
        for batch in batches:
            key, bit, fp = (batch[c].to_numpy() for c in ("key", "bit", "fp"))
            if not len(key):
                continue
            cuts = np.concatenate([[0], np.flatnonzero(key[1:] != key[:-1]) + 1, [len(key)]])
            several = np.diff(cuts) > 1  # one row alone has nothing to compare, unless the batch cuts its group
            several[0] = several[-1] = True
            out = []
            for i in np.flatnonzero(several).tolist():
                a, b = cuts[i], cuts[i + 1]
                if group is None or key[a] != group.key:
                    out += group.settled() if group else []
                    group = _Group(int(key[a]), int(bit[a]), most)
                group.add(fp[a:b])
            yield _links(out)
        yield _links(group.settled() if group else [])

    ordered = signatures.select("key", "bit", "fp").repartition("key").sortWithinPartitions("key", "fp")
    return ordered.mapInArrow(run, "u bigint, v bigint")


def print_links(prints: DataFrame, group: int = GROUP) -> DataFrame:
    """``u, v``: links that connect all distinct fingerprints ``fp`` within three bits of each other."""
    links = None
    groups = prints.select(F.lit(0).cast("bigint").alias("key"), F.lit(0).alias("low"), "fp")
    for width in LEVELS:
        signatures = _signatures(groups, width)
        found = stage(_compare(signatures, group if width > LEVELS[-1] else None), "met")
        new = found.filter("v is not null")
        links = new if links is None else links.union(new)
        large = found.filter("v is null").select(F.col("u").alias("key")).distinct()
        if large.isEmpty():
            break
        # Signatures with very many fingerprints: only these are cut again.
        groups = stage(signatures.join(large, "key").select("key", "low", "fp"), "large-groups")
    return links


def near_groups(docs: DataFrame, shingle: int = SHINGLE, group: int = GROUP) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every row of ``docs``; links are of at most three differing bits.

    Texts without words (null, empty, white space) have fingerprint zero and link like any other. Rows that repeat a
    ``doc_id`` are judged each by its text. A row with a null ``doc_id`` gets its fingerprint and, as it can be
    reached but has no id to give, the smallest id of its group, null if there is none. An empty table gives no rows.
    """
    rows = stage(fingerprints(docs, shingle), "fingerprints")
    kinds = stage(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "kinds")
    found = components(print_links(kinds.select("fp"), group)).withColumnRenamed("u", "fp")
    named = stage(kinds.join(found, "fp", "left").withColumn("component", F.coalesce("component", "fp")), "named")
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    known = named.join(least, "component").select("fp", "component_id")
    return rows.join(known, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
