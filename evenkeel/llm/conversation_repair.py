"""Damage to conversations, faults found in them, and the cheapest repair of their structure.

Conversations are dealt by id and sorted by turn, last turn first; one pass over the sorted rows carries the state of
a dynamic program from Arrow batch to Arrow batch. The state is the least cost from here to the end for each of
four positions in a well-formed conversation. Every row leaves one byte: the best edit for each position. When the
first turn has been read, these bytes are followed from the start: they give the edits, which rebuild
the text. Bytes and texts of a giant conversation lie in a file of the task, not in its memory.
"""

import hashlib
import tempfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Faults, edit costs, word characters.
NO_BLANK = r"[^\x20\x09-\x0D]"
DAMAGES = 20
RETOUCH, DELETE, CUT_OFF = 3, 4, 3
SPILL = 4 << 20  # bytes of one conversation that stay in memory

# Positions: at the start, after a system turn, after a user turn, after an assistant turn. What may be written
# next, and where that leads: a system turn can only be kept.
START, SYSTEM, USER, ASSISTANT = range(4)
WRITTEN = (USER, USER, ASSISTANT, USER)
EDITS = b"DIKR"  # in the order of ties
NONE, BLANK, DUPLICATE, TRUNCATED = range(4)


def _chance(conv: str, turn: str) -> Column:
    """crc32 of "conv:turn", a null turn being one space, modulo 20."""
    name = F.concat(F.col(conv).cast("string"), F.lit(":"), F.coalesce(F.col(turn).cast("string"), F.lit(" ")))
    return F.crc32(name.cast("binary")) % DAMAGES


def damaged(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, copy, role, text`` after the damage; a dropped row stays, with ``copy`` -1.

    A null role or text is one space. Rows without a ``conv_id`` belong to no conversation.
    """
    space = F.lit(" ")
    rows = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        F.coalesce(F.col("role").cast("string"), space).alias("role"),
        F.coalesce(F.col("text").cast("string"), space).alias("text"), _chance("conv_id", "turn").alias("_hit"))
    hit = F.col("_hit")
    text = F.when(hit == 1, "").when(hit == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.when(hit == 0, F.array(F.lit(-1))).when(hit == 3, F.array(F.lit(0), F.lit(1))).otherwise(
        F.array(F.lit(0)))
    return rows.select("conv_id", "turn", F.when(hit == 4, "user").otherwise(F.col("role")).alias("role"),
                       text.alias("text"), F.explode(copies).alias("copy"))


def with_faults(rows: DataFrame) -> DataFrame:
    """Add ``fault``, the first of blank, duplicate and truncated that a row has, else 0.

    The rows stay where their conversation was dealt to: the search for earlier equals sorts there, too.
    """
    dealt = rows.withColumn("_same", F.xxhash64("role", "text")).repartition("conv_id")
    equal = Window.partitionBy("conv_id", "_same", "role", "text", F.col("copy") < 0).orderBy(
        F.asc_nulls_first("turn"), "copy")
    last = F.regexp_extract("text", rf"({NO_BLANK})[\x20\x09-\x0D]*\z", 1)
    fault = (F.when(F.col("copy") < 0, NONE).when(last == "", BLANK).when(F.row_number().over(equal) > 1, DUPLICATE)
             .when(~last.isin(".", "!", "?"), TRUNCATED).otherwise(NONE))
    return dealt.withColumn("fault", fault).drop("_same")


class _Store:
    """Bytes written in one order and read in the other: in memory, and beyond a bound in a file of the task."""

    def __init__(self, most: int) -> None:
        self.file, self.most = tempfile.SpooledTemporaryFile(max_size=most), most

    def clear(self) -> None:
        self.file.close()
        self.file = tempfile.SpooledTemporaryFile(max_size=self.most)

    def put(self, record: bytes) -> None:
        self.file.write(record)
        self.file.write(len(record).to_bytes(8, "little"))

    def last_first(self) -> Iterator[bytes]:
        at = self.file.tell()
        while at:
            self.file.seek(at - 8)
            size = int.from_bytes(self.file.read(8), "little")
            at -= 8 + size
            self.file.seek(at)
            yield self.file.read(size)


class Repair:
    """One conversation, fed from its last row to its first."""

    def __init__(self, spill: int = SPILL) -> None:
        self.store = _Store(spill)
        self.start(None)

    def start(self, conv: int | None) -> None:
        self.conv = conv
        self.rows = self.illegal = self.turns = 0
        self.faults = [0] * 4
        self.low = self.high = self.later = None  # smallest and largest turn, initial of the row after
        # After the last row: nothing at all and an answer are fine, what else is missing is inserted.
        self.cost = [0, 2 * RETOUCH, RETOUCH, 0]
        if self.store.file.tell():
            self.store.clear()

    def feed(self, turn: int | None, role: str, text: str, fault: int) -> None:
        self.rows += 1
        self.faults[fault] += 1
        initial = role[:1]
        if self.later is not None and initial + self.later not in ("su", "ua", "au"):
            self.illegal += 1
        self.later = initial
        if turn is not None:
            if turn != self.low:
                self.turns += 1
            self.low, self.high = turn, turn if self.high is None else self.high

        must_go, extra = fault in (BLANK, DUPLICATE), CUT_OFF if fault == TRUNCATED else 0
        after, cost, best = self.cost, [0] * 4, [0] * 4
        for at in range(4):
            cost[at], best[at] = after[at] + DELETE, 0
            if not must_go:
                kept = _kept(at, initial)
                if kept is not None and after[kept] + extra < cost[at]:
                    cost[at], best[at] = after[kept] + extra, 2
                if after[WRITTEN[at]] + extra + RETOUCH < cost[at]:
                    cost[at], best[at] = after[WRITTEN[at]] + extra + RETOUCH, 3
        without = cost[:]  # a second insert in a row never pays from these on, but for the first to answer
        for at in (USER, ASSISTANT):
            if _better(without[WRITTEN[at]] + RETOUCH, 1, cost[at], best[at]):
                cost[at], best[at] = without[WRITTEN[at]] + RETOUCH, 1
        for at in (START, SYSTEM):
            if _better(cost[USER] + RETOUCH, 1, cost[at], best[at]):
                cost[at], best[at] = cost[USER] + RETOUCH, 1
        self.cost = cost
        choice = best[0] | best[1] << 2 | best[2] << 4 | best[3] << 6
        name = role.encode()
        self.store.put(bytes((choice,)) + len(name).to_bytes(4, "little") + name + text.encode())

    def result(self) -> tuple:
        """The columns of ``repaired``; the repaired text is only ever hashed."""
        at, audit, digest, begun = START, bytearray(), hashlib.sha256(), False

        def write(role: bytes, text: bytes) -> None:
            nonlocal begun
            digest.update((b"\n" if begun else b"") + role + b":" + text)
            begun = True

        def insert() -> int:
            audit.append(ord("I"))
            write(b"user" if WRITTEN[at] == USER else b"assistant", b"")
            return WRITTEN[at]

        for record in self.store.last_first():
            while (edit := record[0] >> 2 * at & 3) == 1:
                at = insert()
            audit.append(EDITS[edit])
            if edit:
                names_end = 5 + int.from_bytes(record[1:5], "little")
                role, text = record[5:names_end], record[names_end:]
                if edit == 2:
                    write(role, text)
                    at = _kept(at, role[:1].decode())
                else:
                    at = WRITTEN[at]
                    write(b"user" if at == USER else b"assistant", text)
        while at in (SYSTEM, USER):
            at = insert()
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        return (self.conv, gaps, *self.faults[BLANK:], self.illegal, self.cost[START], audit.decode(), digest.hexdigest())


def _kept(at: int, initial: str) -> int | None:
    """Where keeping a row with this initial leads, None if it does not fit here."""
    if initial == "s":
        return SYSTEM if at == START else None
    if initial == "u":
        return USER if at != USER else None
    return ASSISTANT if initial == "a" and at == USER else None


def _better(cost: int, edit: int, than: int, its: int) -> bool:
    return cost < than or cost == than and edit < its


REPAIRED = ("conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, "
            "audit string, repaired_sha256 string")


def repaired(rows: DataFrame, spill: int = SPILL) -> DataFrame:
    """Faults, least cost, edits and the hash of the repaired text, per conversation of ``rows``.

    ``rows`` are as ``with_faults`` gives them. Rows of one turn are taken by role, then text, a repeat last.
    """
    ordered = rows.sortWithinPartitions("conv_id", F.desc_nulls_last("turn"), F.desc("role"), F.desc("text"),
                                        F.desc(F.col("fault") == DUPLICATE))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        going = Repair(spill)
        names = [c.split()[0] for c in REPAIRED.split(", ")]
        for batch in batches:
            done = []
            turns = [None if null else turn for turn, null in zip(batch["turn"].tolist(), batch["no_turn"].tolist())]
            for conv, turn, copy, role, text, fault in zip(
                    batch["conv_id"].tolist(), turns, batch["copy"].tolist(), batch["role"], batch["text"],
                    batch["fault"].tolist()):
                if conv != going.conv:
                    if going.conv is not None:
                        done.append(going.result())
                    going.start(conv)
                if copy >= 0:
                    going.feed(turn, role, text, fault)
            yield pd.DataFrame(done, columns=names)
        if going.conv is not None:
            yield pd.DataFrame([going.result()], columns=names)

    wire = ordered.select("conv_id", F.coalesce("turn", F.lit(0)).alias("turn"), F.col("turn").isNull().alias("no_turn"),
                          "copy", "role", "text", "fault")
    return wire.mapInPandas(run, REPAIRED)


def repair(conversations: DataFrame) -> DataFrame:
    """Damage a table ``conv_id, turn, role, text`` and report its repair, one row per conversation.

    A conversation of which every row is dropped has zeros, no edits and the hash of nothing. Repeated rows are
    rows like any other; other columns are not read; an empty table gives no rows.
    """
    return repaired(with_faults(damaged(conversations)))
