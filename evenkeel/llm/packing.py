"""Best-fit packing of token pieces into sequences.

Lengths are whole numbers up to the capacity, so the plan works on the number of pieces per length, a table
of at most ``capacity`` rows, whatever the corpus holds. Pieces above a third of the capacity are matched
greedily, at most two to a sequence; the smaller ones then go, longest first, to the tightest gap. The plan
says which ranks of a length go to which run of sequences; every piece finds its own place by its rank.
"""

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from evenkeel.llm.tokens import library_encoder, sliced, texts
from evenkeel.plans.staging import stage
from evenkeel.session import small_batches

END_ID = 2
CAPACITY = 1024


class Plan:
    """Rows ``(length, first rank, pieces per sequence, first sequence, offset)``, sorted by the first two."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.capacity, self.sequences = capacity, 0
        self.rows: list[tuple[int, int, int, int, int]] = []
        self.used = dict.fromkeys(range(capacity + 1), 0)  # pieces of a length that have a place
        self.gaps: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]
        left = [counts.get(n, 0) for n in range(capacity + 1)]
        self._match_large(left)
        self._fill_gaps(left)
        self.rows.sort()

    def _place(self, length: int, pieces: int, each: int, first: int, offset: int) -> None:
        self.rows.append((length, self.used[length], each, first, offset))
        self.used[length] += pieces

    def _open(self, sequences: int) -> int:
        self.sequences += sequences
        return self.sequences - sequences

    def _match_large(self, left: list[int]) -> None:
        """Each large length, longest first, takes the longest large partner that fits."""
        least = self.capacity // 3 + 1
        for n in range(self.capacity, least - 1, -1):
            while left[n]:
                m = next((m for m in range(min(n, self.capacity - n), least - 1, -1)
                          if left[m] > (m == n)), 0)
                pairs = left[n] if not m else left[n] // 2 if m == n else min(left[n], left[m])
                first = self._open(pairs)
                self._place(n, pairs, 1, first, 0)
                left[n] -= pairs
                if m:
                    self._place(m, pairs, 1, first, n)
                    left[m] -= pairs
                self.gaps[self.capacity - n - m].append((first, pairs))

    def _fill_gaps(self, left: list[int]) -> None:
        """Each small length, longest first, fills the tightest gaps, as often as it fits in each."""
        for n in range(self.capacity // 3, 0, -1):
            while left[n]:
                gap = next((g for g in range(n, self.capacity) if self.gaps[g]), self.capacity)
                each = min(gap // n, left[n])
                if gap == self.capacity:
                    first, room = self._open(left[n] // each), left[n] // each
                else:
                    first, room = self.gaps[gap].pop()
                taken = min(room, left[n] // each)
                self._place(n, taken * each, each, first, self.capacity - gap)
                left[n] -= taken * each
                self.gaps[gap - each * n].append((first, taken))
                if room > taken:
                    self.gaps[gap].append((first + taken, room - taken))

    def find(self, lengths: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of the pieces with these ranks among those of their length."""
        length, low, each, first, offset = np.array(self.rows, np.int64).reshape(-1, 5).T
        at = np.searchsorted(length << 48 | low, lengths << 48 | ranks, side="right") - 1
        inside = ranks - low[at]
        return first[at] + inside // each[at], offset[at] + inside % each[at] * lengths


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID,
           keep_ids: bool = False) -> DataFrame:
    """Token pieces of every whole text: ``doc_id, piece, start, length, ids_crc32``, and ``ids`` on demand.

    A document is its ids and the end id. If it is longer than the capacity, all its pieces but the first
    are full. ``part`` and ``nth`` number the pieces of one length within the task that made them.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in sliced(batches):
            bounds, ids = library_encoder(path).encode(batch["text"])
            rows = len(bounds) - 1
            total = np.diff(bounds) + 1
            begin = np.concatenate([[0], np.cumsum(total)])
            full = np.full(begin[-1], end_id, np.dtype("<u4"))
            full[np.arange(len(ids)) + np.repeat(np.arange(rows), total - 1)] = ids
            count = -(-total // capacity)
            doc = np.repeat(np.arange(rows), count)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
            head = (total - (count - 1) * capacity)[doc]
            start = np.where(piece == 0, 0, head + (piece - 1) * capacity)
            length = np.where(piece == 0, head, capacity)
            raw, at = memoryview(full).cast("B"), begin[doc] + start
            crc = [zlib.crc32(raw[a * 4:(a + n) * 4]) for a, n in zip(at.tolist(), length.tolist(), strict=True)]
            order = np.argsort(length, kind="stable")
            ordered = length[order]
            nth = np.empty(len(order), np.int64)
            nth[order] = np.arange(len(order)) - np.searchsorted(ordered, ordered) + seen[ordered]
            seen += np.bincount(length, minlength=capacity + 1)
            columns = {"doc_id": batch["doc_id"].take(pa.array(doc)), "piece": pa.array(piece.astype(np.int32)),
                       "start": pa.array(start), "length": pa.array(length), "ids_crc32": pa.array(crc, pa.int64()),
                       "part": pa.array(np.full(len(doc), part, np.int32)), "nth": pa.array(nth)}
            if keep_ids:
                columns["ids"] = pa.ListArray.from_arrays(
                    pa.array(np.append(at, begin[-1]).astype(np.int32)), pa.array(full.astype(np.int32)))
            yield pa.RecordBatch.from_pydict(columns)

    kind = ("doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, part int, nth bigint"
            + (", ids array<int>" if keep_ids else ""))
    return texts(docs).mapInArrow(run, kind)


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID,
         keep_ids: bool = False) -> DataFrame:
    """Pack all documents into sequences of at most ``capacity`` ids.

    Returns a row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` and, with
    ``keep_ids``, the ``ids`` to write there. A null or empty text is one piece with the end id alone.
    Repeated rows are packed as often as they come; an empty table gives no rows. Ties between equal lengths
    are settled by task and place, which changes no number of sequences.
    """
    with small_batches(docs.sparkSession):
        cut = stage(pieces(docs, path, capacity, end_id, keep_ids), "pieces")
    made = cut.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    before = made.select("part", "length", (F.sum("n").over(
        Window.partitionBy("length").orderBy("part")) - F.col("n")).alias("before"))
    totals = cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()  # at most `capacity` rows
    plan = cut.sparkSession.sparkContext.broadcast(Plan({r["length"]: r["n"] for r in totals}, capacity))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rank = batch["before"].to_numpy() + batch["nth"].to_numpy()
            sequence, offset = plan.value.find(batch["length"].to_numpy(), rank)
            kept = [n for n in batch.schema.names if n not in ("part", "nth", "before")]
            yield pa.RecordBatch.from_arrays(
                [*[batch[n] for n in kept], pa.array(sequence), pa.array(offset)], [*kept, "sequence_id", "offset"])

    kept = [f"{n} {t}" for n, t in cut.dtypes if n not in ("part", "nth")]
    return cut.join(before, ["part", "length"]).select(*cut.columns, "before").mapInArrow(
        run, ", ".join([*kept, "sequence_id bigint", "offset bigint"]))
