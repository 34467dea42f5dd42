"""External induced suffix sorting.

Suffixes are sorted from those of their leftmost S-type positions (LMS): first the LMS substrings are put in
order by induction and named, the string of names is sorted by recursion, then its order induces that of all
suffixes. The suffixes waiting to be placed are held in priority queues by first letter, which keep a bounded
number in memory and the rest in sorted runs on disk; text, types and the result are mapped files.
"""

import os
from itertools import count

import numpy as np

IN_MEMORY = 1 << 20  # queue entries in memory, and names that are sorted without further recursion


class DiskQueue:
    """Positions by letter, first in first out within a letter."""

    def __init__(self, folder: str, in_memory: int):
        self.folder, self.in_memory, self.held = folder, in_memory, 0
        self.memory: dict[int, list[np.ndarray]] = {}
        self.runs: list[tuple[np.ndarray, dict[int, tuple[int, int]]]] = []

    def insert(self, letters: np.ndarray, positions: np.ndarray) -> None:
        order = np.argsort(letters, kind="stable")
        letters, positions = letters[order], positions[order]
        cuts = np.flatnonzero(np.diff(letters)) + 1
        for letter, part in zip(letters[[0, *cuts]].tolist() if len(letters) else [], np.split(positions, cuts),
                                strict=False):
            self.memory.setdefault(letter, []).append(part)
        self.held += len(positions)
        if self.held > self.in_memory:
            self._spill()

    def _spill(self) -> None:
        index, start, parts = {}, 0, []
        for letter in sorted(self.memory):
            parts += self.memory[letter]
            end = start + sum(map(len, self.memory[letter]))
            index[letter], start = (start, end), end
        path = os.path.join(self.folder, f"run-{len(self.runs)}.npy")
        np.save(path, np.concatenate(parts))
        self.runs.append((np.load(path, mmap_mode="r"), index))
        self.memory, self.held = {}, 0

    def pop(self, letter: int) -> np.ndarray:
        """All positions that wait under the letter."""
        found = [run[slice(*index.pop(letter))] for run, index in self.runs if letter in index]
        waiting = self.memory.pop(letter, [])
        self.held -= sum(map(len, waiting))
        found += waiting
        return np.concatenate(found) if found else np.zeros(0, np.int64)


class _Level:
    """One string: letters above 0 but for the last, which is 0 and the only one."""

    def __init__(self, text: np.ndarray, folder: str, in_memory: int):
        self.text, self.folder, self.in_memory, self.n = text, folder, in_memory, len(text)
        os.makedirs(folder, exist_ok=True)
        self.numbers = count()
        self.small = self._types()
        starts = self.small.copy()
        starts[0] = False
        starts[1:] &= ~self.small[:-1]
        self.lms = np.flatnonzero(starts)
        self.letters, self.sizes = np.unique(text, return_counts=True)
        self.first = np.concatenate([[0], np.cumsum(self.sizes)])

    def _types(self) -> np.ndarray:
        """Whether a suffix is smaller than the next one: the first different letter to the right decides."""
        rise = np.sign(np.diff(self.text.astype(np.int64)))
        last = np.arange(self.n - 1)
        last[rise == 0] = self.n
        last = np.minimum.accumulate(last[::-1])[::-1]
        return np.append(rise[np.minimum(last, self.n - 2)] > 0, True) if self.n > 1 else np.ones(1, bool)

    def _queue(self) -> DiskQueue:
        folder = os.path.join(self.folder, f"queue-{next(self.numbers)}")
        os.makedirs(folder)
        return DiskQueue(folder, self.in_memory)

    def induce(self, seeds: np.ndarray) -> np.ndarray:
        """The order of all suffixes that follows from that of the LMS positions given."""
        path = os.path.join(self.folder, f"order-{next(self.numbers)}.npy")
        order = np.lib.format.open_memmap(path, "w+", np.int64, (self.n,))
        large_end = self._large(seeds, order)
        self._small(order, large_end)
        return order

    def _pass_on(self, batch: np.ndarray, small: bool, queue: DiskQueue) -> None:
        before = batch[batch > 0] - 1
        before = before[self.small[before] == small]
        queue.insert(self.text[before], before)

    def _large(self, seeds: np.ndarray, order: np.ndarray) -> np.ndarray:
        """From left to right, suffixes induce the larger ones before them."""
        queue, waiting = self._queue(), self._queue()
        waiting.insert(self.text[seeds], seeds)
        ends = self.first[:-1].copy()
        for k, letter in enumerate(self.letters.tolist()):
            while len(batch := queue.pop(letter)):
                order[ends[k]:ends[k] + len(batch)] = batch
                ends[k] += len(batch)
                self._pass_on(batch, False, queue)
            self._pass_on(waiting.pop(letter), False, queue)
        return ends

    def _small(self, order: np.ndarray, large_end: np.ndarray) -> None:
        """From right to left, suffixes induce the smaller ones before them."""
        queue = self._queue()
        for k in range(len(self.letters) - 1, -1, -1):
            at, letter = self.first[k + 1], int(self.letters[k])
            if letter == 0:
                order[0] = self.n - 1
                break
            while len(batch := queue.pop(letter)):
                order[at - len(batch):at] = batch[::-1]
                at -= len(batch)
                self._pass_on(batch, True, queue)
            self._pass_on(order[self.first[k]:large_end[k]][::-1], True, queue)

    def names(self) -> tuple[np.ndarray, np.ndarray]:
        """LMS positions in the order of their substrings, and the name of each in that order."""
        order = self.induce(self.lms)
        is_lms = np.zeros(self.n, bool)
        is_lms[self.lms] = True
        ranked = np.array(order[is_lms[order]])
        place = np.searchsorted(self.lms, ranked)
        length = np.append(np.diff(self.lms) + 1, 1)[place]
        differ = np.append(True, length[1:] != length[:-1])
        open_, k = np.flatnonzero(~differ), 0
        while len(open_):  # neighbours of one length, letter by letter (equal letters have equal types then)
            other = self.text[ranked[open_] + k] != self.text[ranked[open_ - 1] + k]
            differ[open_[other]] = True
            k += 1
            open_ = open_[~other & (length[open_] > k)]
        return ranked, np.cumsum(differ) - 1

    def sort(self) -> np.ndarray:
        ranked, names = self.names()
        if names[-1] + 1 < len(names):
            reduced = np.empty(len(names), np.int64)
            reduced[np.searchsorted(self.lms, ranked)] = names
            below = (doubled(reduced) if len(reduced) <= self.in_memory else
                     _Level(reduced, os.path.join(self.folder, "below"), self.in_memory).sort())
            ranked = self.lms[below]
        return self.induce(ranked)


def doubled(text: np.ndarray) -> np.ndarray:
    """Suffix order of a string that fits in memory, by doubling."""
    rank, n, step = text.astype(np.int64), len(text), 1
    while True:
        ahead = np.zeros(n, np.int64)
        ahead[:max(n - step, 0)] = rank[step:] + 1
        key = rank * (max(n, int(rank.max()) + 2) + 1) + ahead
        order = np.argsort(key, kind="stable")
        new = np.empty(n, np.int64)
        new[order] = np.cumsum(np.append(0, np.diff(key[order]) != 0))
        if new.max() == n - 1:
            return order
        rank, step = new, step * 2


def suffix_order(text: np.ndarray, folder: str, in_memory: int = IN_MEMORY) -> np.ndarray:
    """Start positions of all suffixes in order, as a mapped file in the folder.

    ``text`` has whole numbers above 0 and ends in its only 0.
    """
    return _Level(text, folder, in_memory).sort()
