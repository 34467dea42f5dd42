"""Language identification by rank-order profiles.

The most frequent character n-grams of a text, by rank, are compared with each language's profile; an n-gram
costs the difference of its ranks, or the profile's length where the profile lacks it. The language with the
smallest sum wins.
"""

import sys
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from evenkeel.functions.draws import order_key
from evenkeel.operators.ranking import HASH_RANGE, first_n
from evenkeel.plans.staging import stage

TRAIN_ROWS = 1000  # labelled rows per language that a profile is learned from, those with the smallest hash
PROFILE = 400
TEXT_GRAMS = 300
UNKNOWN = "und"
FOLDS = 5


@lru_cache(1)
def _letters() -> np.ndarray:
    return np.fromiter((unicodedata.category(chr(c))[0] == "L" for c in range(sys.maxunicode + 1)), bool,
                       sys.maxunicode + 1)


def grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the 1- to 3-grams of the words of a text and their counts; words are runs of letters."""
    code = np.frombuffer((" " + text.lower() + " ").encode("utf-32-le", "replace"), np.uint32).astype(np.int64)
    code = np.where(_letters()[code], code, 32)
    code = code[np.concatenate([[True], (code[1:] != 32) | (code[:-1] != 32)])]
    gap = code == 32
    pairs = code[:-1] << 21 | code[1:]
    threes = pairs[:-1] << 21 | code[2:]
    keys = np.concatenate([code[~gap], pairs, threes[~gap[1:-1]]])
    return np.unique(keys, return_counts=True) if len(code) > 1 else (keys[:0], keys[:0])


class Profiles:
    """Ranks of the profiles' n-grams in all languages."""

    def __init__(self, ranked: dict[str, list[int]], length: int):
        self.names = sorted(ranked)
        self.length = length
        self.keys = np.array(sorted({k for keys in ranked.values() for k in keys}), np.int64)
        self.ranks = np.full((len(self.keys) + 1, len(self.names)), -1, np.int64)
        for i, name in enumerate(self.names):
            self.ranks[np.searchsorted(self.keys, ranked[name]), i] = np.arange(len(ranked[name]))

    def predict(self, text: str | None) -> tuple[str, float]:
        keys, counts = grams(text or "")
        if not len(keys) or not self.names:
            return UNKNOWN, 0.0
        top = keys[np.argsort(-counts, kind="stable")[:TEXT_GRAMS]]
        at = np.minimum(np.searchsorted(self.keys, top), len(self.keys) - 1)
        ranks = np.where((self.keys[at] == top)[:, None], self.ranks[at], -1)
        cost = np.where(ranks < 0, self.length, np.minimum(
            np.abs(ranks - np.arange(len(top))[:, None]), self.length)).sum(axis=0)
        best = int(np.argmin(cost))
        return self.names[best], 1 - float(cost[best]) / (self.length * len(top))


def held_out() -> F.Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % FOLDS == 0, F.lit(False))


def learn(docs: DataFrame, train_rows: int = TRAIN_ROWS, profile: int = PROFILE) -> Profiles:
    """Profiles of every language among the labelled training rows.

    Each is learned from whole texts of at most ``train_rows`` rows, so the driver receives at most
    ``profile`` n-grams a language.
    """
    labelled = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull()
                           & ~held_out())
    ids = stage(labelled.select("doc_id", "lang").distinct(), "labelled")
    chosen = first_n(ids, train_rows, order_key("profiles", F.col("doc_id")), "doc_id", ["lang"], HASH_RANGE)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, lang in zip(batch["text"].to_pylist(), batch["lang"].to_pylist(), strict=True):
                keys, counts = grams(text)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(keys), pa.string()), pa.array(keys), pa.array(counts)],
                    ["lang", "gram", "n"])

    sample = labelled.select("doc_id", "text", "lang").join(
        F.broadcast(chosen.select("doc_id").distinct()), "doc_id", "left_semi")
    totals = (sample.mapInArrow(count, "lang string, gram bigint, n bigint")
              .groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    first = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    top = totals.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= profile).collect()
    ranked: dict[str, list[int]] = {}
    for r in sorted(top, key=lambda r: (r["lang"], r["rank"])):
        ranked.setdefault(r["lang"], []).append(r["gram"])
    return Profiles(ranked, profile)


def identify(docs: DataFrame, others: tuple[str, ...] = (), profiles: Profiles | None = None) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` and the columns named in ``others``.

    Learns from ``docs`` unless profiles are given. A null text, one without a letter, or a table without
    labelled training rows gives ``und`` and score 0. Equal distances go to the first name. A null ``doc_id``
    is not held out and not learned from. Repeated rows give repeated rows.
    """
    known = docs.sparkSession.sparkContext.broadcast(profiles or learn(docs))
    text = "text" if "text" in others else "_text"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [known.value.predict(t) for t in batch[text].to_pylist()]
            kept = [n for n in batch.schema.names if n != "_text"]
            yield pa.RecordBatch.from_arrays(
                [*[batch[n] for n in kept], pa.array([f[0] for f in found], pa.string()),
                 pa.array([f[1] for f in found], pa.float64())], [*kept, "lang_pred", "score"])

    rows = docs.select("doc_id", *[c for c in others if c != "doc_id"], held_out().alias("held_out"),
                       *([] if text == "text" else [F.col("text").alias("_text")]))
    kind = ", ".join(f"`{n}` {t}" for n, t in rows.dtypes if n != "_text")
    return rows.mapInArrow(run, kind + ", lang_pred string, score double")


def in_known_language(docs: DataFrame, least: float) -> DataFrame:
    """The documents whose language is found with at least the given score, in their own columns.

    Null texts and those without a letter go. Where nothing can be learned, as no training row has a language, no
    language can be unlike all others: every text with a letter stays.
    """
    profiles = learn(docs)
    if not profiles.names:
        return docs.filter(F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    own = {c: f"_own_{i}" for i, c in enumerate(docs.columns) if c not in ("doc_id", "text")}
    renamed = docs.withColumnsRenamed(own)
    found = identify(renamed, tuple(renamed.columns), profiles)
    return found.filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least)).select(
        *[F.col(own.get(c, c)).alias(c) for c in docs.columns])
