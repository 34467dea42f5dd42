"""Token-id files: frequency-ranked ids in byte-aligned variable-length coding.

The table of files has one row per segment, a run of documents in ascending ``doc_id``. A segment ranks its
own ids by frequency, so that the frequent ones take one byte; it holds the table of ids by rank, the control
bytes (two bits per id: its number of bytes less one) apart from the data bytes, and the documents' ids and
lengths. Segments decode alone, by table lookup in numpy.
"""

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evenkeel.llm.tokens import library_encoder, sliced, texts
from evenkeel.operators.numbering import running_sums
from evenkeel.plans.staging import look_up, pin

SEGMENT_BYTES = 16 << 20  # of text
# no_ids: how many of the documents, the first ones, have a null id.
SCHEMA = ("segment int, nth int, no_ids bigint, doc_ids binary, lengths binary, id_by_rank binary, control binary, "
          "data binary, n_ids bigint")
# Bytes of the four ids of a control byte.
SIZES = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3) + 1
MASKS = np.array([0, 0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], np.int64)


def pack_ids(ids: np.ndarray) -> tuple[bytes, bytes, bytes]:
    """Ids by rank, control bytes and data bytes of one segment."""
    if ids.max(initial=0) >> 24:  # too far apart to be counted in a table
        names, ids = np.unique(ids, return_inverse=True)
    else:
        names = None
    counts = np.bincount(ids)
    found = np.flatnonzero(counts)
    found = found[np.argsort(-counts[found], kind="stable")]
    rank = np.zeros(len(counts), np.int64)
    rank[found] = np.arange(len(found))
    values = rank[ids]
    size = 1 + (values > MASKS[1]) + (values > MASKS[2]) + (values > MASKS[3])
    codes = np.zeros(-(-len(values) // 4) * 4, np.uint8)
    codes[:len(values)] = size - 1
    control = codes.reshape(-1, 4) @ np.array([1, 4, 16, 64], np.uint8)
    wide = values.astype("<u4").view(np.uint8).reshape(-1, 4)
    data = wide[np.arange(4) < size[:, None]]
    return (found if names is None else names[found]).astype("<u4").tobytes(), control.astype(np.uint8).tobytes(), data.tobytes()


def unpack_ids(id_by_rank: bytes, control: bytes, data: bytes, n: int) -> np.ndarray:
    size = SIZES[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    end = np.cumsum(size)
    raw = np.frombuffer(data + bytes(4), np.uint8)
    at = end - size
    wide = raw[at].astype(np.int64)
    for k in (1, 2, 3):
        wide |= raw[at + k].astype(np.int64) << 8 * k
    return np.frombuffer(id_by_rank, "<u4")[wide & MASKS[size]]


def write_ids(docs: DataFrame, tokenizer: str, path: str, end_id: int = 2,
              segment_bytes: int = SEGMENT_BYTES) -> None:
    """Encode every whole text, add the end id and write the table of files.

    Texts are dealt by ranges of ``doc_id``, about one per ``segment_bytes`` of text, and encoded where they are written.
    Null ids come first. Rows of one id, or of none, are ordered by hashes of their texts, and a range may begin among
    them, so that an id with very many rows is no single segment. Null and empty texts have the end id alone. An
    empty table gives a table without rows.
    """
    size = docs.agg(F.sum(F.octet_length("text")).alias("b")).first()["b"] or 0
    order = [F.asc_nulls_first("doc_id"), F.xxhash64("text"), F.xxhash64(F.lit("more"), "text")]

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segment, nth, held, amount = TaskContext.get().partitionId(), 0, [], 0

        def block() -> pa.RecordBatch:
            table, control, data = pack_ids(np.concatenate([ids for _, _, ids in held]))
            doc = pa.concat_arrays([d for d, _, _ in held])
            lengths = np.concatenate([n for _, n, _ in held])
            blobs = (doc.fill_null(0).to_numpy().astype("<i8").tobytes(), lengths.astype("<u4").tobytes(), table, control, data)
            return pa.RecordBatch.from_arrays(
                [pa.array([segment], pa.int32()), pa.array([nth], pa.int32()), pa.array([doc.null_count], pa.int64()),
                 *[pa.array([x], pa.binary()) for x in blobs], pa.array([int(lengths.sum())], pa.int64())],
                ["segment", "nth", "no_ids", "doc_ids", "lengths", "id_by_rank", "control", "data", "n_ids"])

        for batch in sliced(batches):
            start, ids = library_encoder(tokenizer).encode(batch["text"])
            held.append((batch["doc_id"], np.diff(start) + 1, np.insert(ids, start[1:], end_id).astype(np.uint32)))
            amount += len(ids)
            if amount > segment_bytes // 4:  # ids, of some four bytes of text each
                yield block()
                nth, held, amount = nth + 1, [], 0
        if held:
            yield block()

    (texts(docs).repartitionByRange(size // segment_bytes + 1, *order).sortWithinPartitions(*order)
     .mapInArrow(write, SCHEMA).write.option("compression", "uncompressed").parquet(path))


def read_ids(spark: SparkSession, path: str, keep_ids: bool = False) -> DataFrame:
    """Read the files back: ``doc_id, start, n_tokens, ids_crc32`` and, on demand, ``ids``.

    ``start`` is the number of ids of all documents before it, ``ids_crc32`` the checksum of its ids as
    little-endian unsigned 32-bit integers.
    """
    table = spark.read.schema(SCHEMA).parquet(path)
    place = ["segment", "nth"]
    starts = running_sums(table.select(*place, "n_ids"), place, "n_ids").select(*place, "before")
    placed = look_up(table, pin(starts, "starts"), place)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                doc = np.frombuffer(row["doc_ids"], "<i8")
                length = np.frombuffer(row["lengths"], "<u4").astype(np.int64)
                ids = unpack_ids(row["id_by_rank"], row["control"], row["data"], row["n_ids"])
                end = np.cumsum(length)
                raw = memoryview(np.ascontiguousarray(ids, "<u4")).cast("B")
                crc = [zlib.crc32(raw[a * 4:b * 4]) for a, b in zip((end - length).tolist(), end.tolist(), strict=True)]
                columns = [pa.array(doc, mask=np.arange(len(doc)) < row["no_ids"]),
                           pa.array(end - length + row["before"]), pa.array(length), pa.array(crc, pa.int64())]
                if keep_ids:
                    columns.append(pa.ListArray.from_arrays(
                        pa.array(np.append(0, end).astype(np.int32)), pa.array(ids.astype(np.int32))))
                yield pa.RecordBatch.from_arrays(
                    columns, ["doc_id", "start", "n_tokens", "ids_crc32", "ids"][:len(columns)])

    kind = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + (", ids array<int>" if keep_ids else "")
    return placed.mapInArrow(run, kind)
