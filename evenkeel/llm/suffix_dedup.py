"""Removal of repeated byte strings, decided by suffix sorting.

Every 100-byte window belongs to the run of windows around its anchor, the 32-byte string in it with the
smallest hash; equal windows have equal anchors. Runs are counted by anchor and content. A run's repeats are
repeated as a whole. Where one anchor has runs of different content, the first of each goes to the suffix
sorting of its shard, where equal windows are neighbours with a common prefix of 100 bytes; the earliest of
them stays and the others are removed. Anchors seen once cannot be part of a repeated window. An anchor whose
first runs are larger than a shard is not sorted: its windows are told apart one by one, by 128-bit digests.
"""

import hashlib
import tempfile
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenkeel.llm.induced_sort import suffix_order
from evenkeel.llm.words import joined
from evenkeel.plans.staging import Tables, stage
from evenkeel.session import small_batches

HOT = -1  # the shard of anchors that are too large for one
WINDOW = 100
ANCHOR = 32
SHARD_BYTES = 2 << 20
PLACES = np.uint64(1 << 20)  # windows whose runs are looked for at a time
# What tells texts apart, in the order of documents: null ids first, then ids, then hashes of the text (96 bits) that part
# the texts of a repeated id. A null id has 64 bits more in place of the id.
KEYS = ["has_id", "doc", "sub", "more"]
KEY_TYPES = "has_id boolean, doc bigint, sub bigint, more int"


def _string_hashes(data: np.ndarray, length: int) -> np.ndarray:
    """64-bit hashes of all strings of a length that is four times a power of two."""
    with np.errstate(over="ignore"):
        h = data.astype(np.uint64)
        h = h[:-3] | h[1:-2] << np.uint64(8) | h[2:-1] << np.uint64(16) | h[3:] << np.uint64(24)
        step = 4
        while step < length:
            h = joined(h[:-step], h[step:])
            step *= 2
    return h


def _sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every run of ``width`` values, from minima of runs of doubling length."""
    step, low = 1, values
    while step * 2 <= width:
        low = np.minimum(low[:len(low) - step], low[step:])
        step *= 2
    return np.minimum(low[:len(values) - width + 1], low[width - step:len(values) - step + 1])


def runs(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``start, n, anchor, content``: first window and number of windows of each run of a text, in order.

    A window's anchor is its leftmost string of smallest hash, so the windows of a run, at most as many as
    there are anchors in a window, are all different.
    """
    found = [_runs(data[at:at + int(PLACES) + WINDOW - 1], at)
             for at in range(0, max(len(data) - WINDOW + 1, 0), int(PLACES))]
    return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 4


def _runs(data: np.ndarray, at: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    grams = _string_hashes(data, ANCHOR)
    # A window has fewer strings than PLACES has numbers: the lowest bits tell equal hashes apart by place.
    placed = grams & ~(2 * PLACES - np.uint64(1)) | np.arange(len(grams), dtype=np.uint64)
    low = _sliding_minimum(placed, WINDOW - ANCHOR + 1)
    start = np.flatnonzero(np.append(True, low[1:] != low[:-1]))
    n = np.diff(np.append(start, len(low)))
    end = start + n + WINDOW - 1
    content = n.astype(np.uint64)  # these six strings cover the run
    for place in (start, start + ANCHOR, start + 2 * ANCHOR, end - ANCHOR, end - 2 * ANCHOR, end - 3 * ANCHOR):
        content = joined(content, grams[place])
    anchor = grams[(low[start] & (2 * PLACES - np.uint64(1))).astype(np.int64)]
    return start + at, n, anchor.view(np.int64), content.view(np.int64)


def _keys(doc_id: str, text: str) -> list[F.Column]:
    more = F.shiftrightunsigned(F.xxhash64(F.lit("more"), text), 33).cast("int")
    return [F.col(doc_id).isNotNull().alias("has_id"), F.coalesce(doc_id, F.xxhash64(F.lit("no id"), text)).alias("doc"),
            F.xxhash64(text).alias("sub"), more.alias("more")]


def _keyed(docs: DataFrame) -> DataFrame:
    """Texts under ``KEYS``; rows that agree in id and text are one document."""
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).select(*_keys("doc_id", "text"), "text")


def _taken(batch: pa.RecordBatch, of: pa.Array) -> list[pa.Array]:
    return [batch[k].take(of) for k in KEYS]


def text_runs(keyed: DataFrame) -> DataFrame:
    """``KEYS, start, n, anchor, content`` of the runs of all texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [runs(np.frombuffer(t.as_buffer(), np.uint8) if t.as_buffer().size else np.zeros(0, np.uint8))
                     for t in batch["text"]]
            sizes = [len(x[0]) for x in found]
            of = pa.array(np.repeat(np.arange(len(found)), sizes))
            start, n, anchor, content = (np.concatenate(x) for x in zip(*found, strict=True))
            yield pa.RecordBatch.from_arrays(
                [*_taken(batch, of), pa.array(start.astype(np.int32)), pa.array(n.astype(np.int16)), pa.array(anchor),
                 pa.array(content)], [*KEYS, "start", "n", "anchor", "content"])

    return keyed.mapInArrow(run, f"{KEY_TYPES}, start int, n smallint, anchor bigint, content bigint")


def _contents(keyed: DataFrame, wanted: DataFrame) -> DataFrame:
    """The bytes of wanted runs: ``KEYS, start, n, shard, bytes``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pieces = batch["pieces"]
            flat, of = pieces.flatten(), pc.list_parent_indices(pieces)
            start, n = (flat.field(c).to_numpy() for c in ("start", "n"))
            cut = []
            for text, at, size in zip(of.to_pylist(), start.tolist(), n.tolist()):
                cut.append(batch["text"][text].as_buffer()[at:at + size + WINDOW - 1].to_pybytes())
            yield pa.RecordBatch.from_arrays(
                [*_taken(batch, of), flat.field("start"), flat.field("n"), flat.field("shard"), pa.array(cut, pa.binary())],
                [*KEYS, "start", "n", "shard", "bytes"])

    by_text = wanted.groupBy(KEYS).agg(F.collect_list(F.struct("start", "n", "shard")).alias("pieces"))
    return keyed.join(by_text, KEYS).mapInArrow(
        run, f"{KEY_TYPES}, start int, n smallint, shard int, bytes binary")


def window_digests(pieces: DataFrame) -> DataFrame:
    """``KEYS, start, digest`` of every window of these runs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch["n"].to_numpy()
            of = pa.array(np.repeat(np.arange(len(sizes)), sizes))
            place = np.concatenate([np.arange(n) for n in sizes]) if len(sizes) else np.zeros(0, np.int64)
            digests = [hashlib.blake2b(data[i:i + WINDOW], digest_size=16).digest() for data, n in zip(
                batch["bytes"].to_pylist(), sizes.tolist(), strict=True) for i in range(n)]
            start = batch["start"].take(of).to_numpy() + place
            yield pa.RecordBatch.from_arrays(
                [*_taken(batch, of), pa.array(start, pa.int64()), pa.array(digests, pa.binary())], [*KEYS, "start", "digest"])

    return pieces.mapInArrow(run, f"{KEY_TYPES}, start bigint, digest binary")


def later_windows(pieces: DataFrame) -> DataFrame:
    """Spans of the windows of these runs that an earlier one of them equals; no task holds all of an anchor."""
    windows = stage(window_digests(pieces), "windows")
    place = F.struct(*KEYS, "start")
    firsts = windows.groupBy("digest").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("c")).filter(
        "c > 1").select("digest", "first")
    return windows.join(firsts, "digest").filter(place > F.col("first")).select(
        *KEYS, "start", (F.col("start") + WINDOW).alias("end"))


def sort_shard(pieces: pd.DataFrame) -> pd.DataFrame:
    """Spans ``KEYS, start, end`` of the windows of these runs that an earlier one of them equals."""
    pieces = pieces.drop_duplicates([*KEYS, "start"]).sort_values([*KEYS, "start"])
    lengths = pieces["bytes"].map(len).to_numpy()
    begin = np.cumsum(lengths + 1) - lengths - 1
    data = np.frombuffer(b"\x00".join(pieces["bytes"]) + b"\x00", np.uint8)
    text = data.astype(np.int16) + 2
    text[begin + lengths] = 1  # between runs
    text = np.append(text, np.int16(0))
    windows = np.zeros(len(text), bool)
    for b, n in zip(begin.tolist(), pieces["n"].tolist(), strict=True):
        windows[b:b + n] = True
    with tempfile.TemporaryDirectory() as folder:
        order = suffix_order(text, folder)
        ranked = np.array(order[windows[order]])
    # Common prefixes of neighbours, up to the window; equal windows follow each other.
    views = np.lib.stride_tricks.sliding_window_view(data, WINDOW)
    equal = np.zeros(len(ranked), bool)
    for a in range(1, len(ranked), 1 << 16):
        at = slice(a, a + (1 << 16))
        equal[at] = (views[ranked[at]] == views[ranked[a - 1:][:len(ranked[at])]]).all(axis=1)
    # Runs are laid in order of document and start, so the earliest of equal windows has the smallest position.
    group = np.flatnonzero(~equal)
    earliest = np.repeat(np.minimum.reduceat(ranked, group), np.diff(np.append(group, len(ranked))))
    later = np.zeros(len(text) + 1, bool)
    later[ranked[ranked != earliest]] = True
    edges = np.flatnonzero(np.diff(np.concatenate([[False], later]).astype(np.int8)))
    first, end = edges[0::2], edges[1::2]
    of = np.searchsorted(begin, first, side="right") - 1
    start = pieces["start"].to_numpy()[of] + first - begin[of]
    return pd.DataFrame({k: pieces[k].to_numpy()[of] for k in KEYS} | {
        "start": start, "end": start + end - first + WINDOW - 1})


def repeated_spans(keyed: DataFrame) -> DataFrame:
    """``KEYS, start, end`` of byte spans to remove; they may overlap."""
    with small_batches(keyed.sparkSession):
        return _repeated_spans(keyed)


def _repeated_spans(keyed: DataFrame) -> DataFrame:
    tables = Tables(keyed.sparkSession)
    found = tables.put(text_runs(keyed), "runs")
    anchors = found.groupBy("anchor").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("anchor")
    repeated = tables.put(found.join(anchors, "anchor"), "repeated")
    tables.drop("runs")
    place = F.struct(*KEYS, "start")
    firsts = stage(repeated.groupBy("anchor", "content", "n").agg(F.min(place).alias("first")), "firsts")
    again = stage(repeated.join(firsts, ["anchor", "content", "n"]).filter(place > F.col("first")).select(
        *KEYS, F.col("start").cast("bigint").alias("start"), (F.col("start") + F.col("n") + WINDOW - 1).cast(
            "bigint").alias("end")), "again")
    tables.drop("repeated")
    several = firsts.groupBy("anchor").agg(F.count(F.lit(1)).alias("c"), F.sum(F.col("n") + WINDOW).alias("size")
                                           ).filter("c > 1")
    several = several.withColumn("hot", F.col("size") > SHARD_BYTES)
    size, hot = several.agg(F.sum(F.when(~F.col("hot"), F.col("size"))), F.max("hot")).first()
    size = size or 0
    shards = -(-size // SHARD_BYTES) or 1
    dealt = F.when(F.col("hot"), HOT).otherwise(F.pmod(F.xxhash64("anchor"), F.lit(shards)).cast("int"))
    wanted = firsts.join(several.select("anchor", "hot"), "anchor").select("first.*", "n", dealt.alias("shard"))
    contents = tables.put(_contents(keyed, wanted), "contents")  # texts are moved once for all of them
    sorted_ = contents.filter(F.col("shard") != HOT).groupBy("shard").applyInPandas(
        sort_shard, f"{KEY_TYPES}, start bigint, end bigint")
    spans = again.union(stage(sorted_, "sorted"))
    if hot:
        spans = spans.union(stage(later_windows(contents.filter(F.col("shard") == HOT)), "later"))
    tables.drop("contents")
    return spans


def _merged(spans: list[dict]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted((s["start"], s["end"]) for s in spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def _cut(docs: DataFrame, others: tuple[str, ...]) -> DataFrame:
    """Rows of ``docs``, the columns named in ``others`` renamed by number, with the spans of each text."""
    keyed = _keyed(docs)
    by_text = repeated_spans(keyed).groupBy(KEYS).agg(F.collect_list(F.struct("start", "end")).alias("_spans"))
    rows = docs.select(F.col("doc_id").alias("_id"), F.coalesce("text", F.lit("")).alias("_text"),
                       F.col("text").isNull().alias("_null"), *[F.col(c).alias(f"_{i}") for i, c in enumerate(others)])
    rows = rows.select("*", *_keys("_id", "_text"))
    return rows.join(by_text, KEYS, "left").drop(*KEYS)


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of every whole text.

    A null or empty text has no bytes. A null ``doc_id`` comes before all others. Different texts under one
    ``doc_id`` are ordered by hash; rows that repeat both are one document and give equal rows.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, spans in zip(batch["_text"].to_pylist(), batch["_spans"].to_pylist(), strict=True):
                data, merged, digest, at = text.encode(), _merged(spans or []), hashlib.sha256(), 0
                for a, b in merged:
                    digest.update(data[at:a])
                    at = b
                digest.update(data[at:])
                out.append((len(data), sum(b - a for a, b in merged), len(merged), digest.hexdigest()))
            names = ["n_bytes", "n_removed", "n_spans", "kept_sha256"]
            types = [pa.int64()] * 3 + [pa.string()]
            yield pa.RecordBatch.from_arrays(
                [batch["_id"], *[pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)]],
                ["doc_id", *names])

    return _cut(docs, ()).mapInArrow(
        run, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string")


def without_repeats(docs: DataFrame) -> DataFrame:
    """The documents with their repeated byte strings cut out, in their own columns; null texts stay null.

    A cut through a character takes what is left of it too. Documents with no word left are dropped. Rows that agree in
    id and text are one document and are cut alike; null ids come first, texts of one id are ordered by hash. An empty
    table gives no rows.
    """
    others = tuple(c for c in docs.columns if c not in ("doc_id", "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, spans, null in zip(*[batch[c].to_pylist() for c in ("_text", "_spans", "_null")], strict=True):
                data, parts, at = text.encode(), [], 0
                for a, b in _merged(spans or []):
                    parts.append(data[at:a])
                    at = b
                parts.append(data[at:])
                out.append(None if null else b"".join(parts).decode("utf-8", "ignore") if spans else text)
            own = [n for n in batch.schema.names if n not in ("_text", "_spans", "_null")]
            yield pa.RecordBatch.from_arrays([*[batch[n] for n in own], pa.array(out, pa.string())], [*own, "_text"])

    cut = _cut(docs, others)
    kind = ", ".join([*[f"{n} {t}" for n, t in cut.dtypes if n not in ("_text", "_spans", "_null")], "_text string"])
    names = {"doc_id": "_id", "text": "_text"} | {c: f"_{i}" for i, c in enumerate(others)}
    kept = cut.mapInArrow(run, kind).filter(F.col("_text").isNull() | F.col("_text").rlike("[^\\x20\\x09-\\x0D]"))
    return kept.select(*[F.col(names[c]).alias(c) for c in docs.columns])
