"""BPE encoding and decoding: batched numpy merge rounds (``merge_rounds``), decoding by a table of tokens."""

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from evenkeel.llm.merge_rounds import merge_table
from evenkeel.llm.tokens import Encoder, sliced, texts, vocabulary


@lru_cache(4)
def encoder(path: str) -> Encoder:
    return Encoder(vocabulary(path), merge_table(path).encode)


@lru_cache(4)
def token_strings(path: str) -> list[bytes]:
    """UTF-8 of every id's token."""
    vocab = vocabulary(path)
    table = [b""] * (max([*vocab.ids.values(), *vocab.special.values()]) + 1)
    for token, i in (vocab.ids | vocab.special).items():
        table[i] = token.encode()
    return table


def decode(ids: list[int], path: str) -> bytes:
    """The text of ids for a vocabulary without a decoder: its tokens joined by a space, in UTF-8."""
    return b" ".join(map(token_strings(path).__getitem__, ids))


def encode(docs: DataFrame, path: str, decoded: bool = False) -> DataFrame:
    """``doc_id, ids`` (array of int) of every whole text, and with ``decoded`` its ``decoded`` text.

    A null or empty text has no ids and decodes to an empty text. Strings of special tokens become their ids,
    as the library does by default. Repeated rows give repeated rows; other columns are not looked at.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            bounds, ids = encoder(path).encode(batch["text"])
            columns = [batch["doc_id"], pa.ListArray.from_arrays(
                pa.array(bounds, pa.int32()), pa.array(ids.astype(np.int32)))]
            if decoded:
                columns.append(pa.array([decode(ids[a:b].tolist(), path).decode()
                                         for a, b in zip(bounds[:-1], bounds[1:], strict=True)], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "decoded"][:len(columns)])

    kind = "doc_id bigint, ids array<int>" + (", decoded string" if decoded else "")
    return texts(docs).mapInArrow(run, kind)


def digests(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of the ids and of the text decoded from them.

    Null and empty texts have no tokens; both digests are then those of the empty string.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = [str(i).encode() for i in range(len(token_strings(path)))]
        for batch in sliced(batches):
            bounds, ids = encoder(path).encode(batch["text"])
            coded, plain = [], []
            for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                own = ids[a:b].tolist()
                coded.append(hashlib.sha256(b" ".join(map(numbers.__getitem__, own))).hexdigest())
                plain.append(hashlib.sha256(decode(own, path)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(np.diff(bounds)), pa.array(coded, pa.string()),
                 pa.array(plain, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return texts(docs).mapInArrow(
        run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
