"""Token counts with a whole-token shortcut.

Offline, every vocabulary string is put through the pre-tokenization and the merges; those that come out as
their own single token are proven. In a text, a pre-token that is proven counts as one; only the others are
merged. Counts of distinct chunks are kept per worker, so a frequent word costs one lookup.
"""

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from evenkeel.llm.merge_rounds import merge_table
from evenkeel.llm.tokens import Encoder, byte_letters, sliced, texts, vocabulary


@lru_cache(4)
def proven_ids(path: str) -> np.ndarray:
    """Ids of the vocabulary strings that encode alone as one token, in ascending order."""
    vocab, table = vocabulary(path), merge_table(path)
    back = {c: b for b, c in byte_letters().items()}
    whole = []
    for token, i in vocab.ids.items():
        word = token.removesuffix(vocab.suffix) if vocab.suffix else token
        try:
            text = bytes(back[c] for c in word).decode()
        except (KeyError, UnicodeDecodeError):
            continue  # no text has it as a pre-token of its own
        if word and vocab.words(text) == [text]:
            whole.append((word, i))
    merged = table.encode([w for w, _ in whole])
    return np.sort(np.array([i for (_, i), ids in zip(whole, merged, strict=True) if ids == [i]], np.int64))


class Counter(Encoder):
    """An encoder that gives each pre-token as many zeros as it has tokens."""

    def __init__(self, path: str, proven: np.ndarray):
        vocab = vocabulary(path)
        names = {i: t for t, i in vocab.ids.items()}
        self.proven = {names[i].removesuffix(vocab.suffix) if vocab.suffix else names[i] for i in proven.tolist()}
        self.table = merge_table(path)
        super().__init__(vocab, self.count)

    def count(self, words: list[str]) -> list[list[int]]:
        rest = [w for w in words if w not in self.proven]
        counted = dict(zip(rest, self.table.encode(rest), strict=True))
        return [counted.get(w, (0,)) for w in words]


_counters: dict[str, Counter] = {}


def count_tokens(docs: DataFrame, path: str, limit: int = 1024) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every whole text.

    Null and empty texts have no bytes and no tokens. Repeated rows give repeated rows.
    """
    proven = proven_ids(path)  # bounded by the vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counters.setdefault(path, None) or Counter(path, proven)
        _counters[path] = counter
        for batch in sliced(batches):
            tokens = np.diff(counter.encode(batch["text"])[0])
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pc.binary_length(batch["text"]).cast(pa.int64()), pa.array(tokens),
                 pa.array(tokens > limit)], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return texts(docs).mapInArrow(run, "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean")
