"""Byte pair merges of many words at once, in numpy.

The symbols of all words lie in one flat array. In each round every word's lowest-ranked pair is found by
binary search over the sorted pair keys, and merged; words without a known pair leave the array.
"""

from functools import lru_cache

import numpy as np

from evenkeel.llm.tokens import Vocabulary, vocabulary

NEVER = np.iinfo(np.int64).max


class MergeTable:
    """The merges of a vocabulary as arrays sorted by pair key."""

    def __init__(self, vocab: Vocabulary):
        ids = vocab.ids
        left = np.array([ids[a] for a, _ in vocab.merges], np.int64)
        right = np.array([ids[b] for _, b in vocab.merges], np.int64)
        made = np.array([ids[a + b] for a, b in vocab.merges], np.int64)
        rank = np.arange(len(made))
        earliest = np.full(max(ids.values()) + 2, NEVER)
        np.minimum.at(earliest, left, rank)
        np.minimum.at(earliest, right, rank)
        order = np.argsort(left << 32 | right)
        self.keys = (left << 32 | right)[order]
        self.rank, self.made = rank[order], made[order]
        # A merge whose product only takes part in later merges may be applied all over a word at once.
        self.safe = (earliest[made] > rank)[order]
        self.suffix, self.ids = vocab.suffix, ids

    def symbols(self, word: str) -> list[int]:
        if not self.suffix:
            return [self.ids[c] for c in word]
        return [self.ids[c] for c in word[:-1]] + [self.ids[word[-1] + self.suffix]]

    def encode(self, words: list[str]) -> list[list[int]]:
        """The ids of each word; words are byte-level strings and not empty."""
        symbols = [self.symbols(w) for w in words]
        lengths = np.array([len(s) for s in symbols], np.int64)
        flat = np.array([s for word in symbols for s in word], np.int64)
        owner = np.repeat(np.arange(len(words)), lengths)
        done: list[list[int]] = [[]] * len(words)
        while len(flat):
            flat, owner, out, of = self._round(flat, owner)
            if len(out):
                cuts = np.flatnonzero(np.diff(of)) + 1
                starts = [0, *cuts.tolist(), len(out)]
                values = out.tolist()
                for i, w in enumerate(of[starts[:-1]].tolist()):
                    done[w] = values[starts[i]:starts[i + 1]]
        return done

    def _round(self, flat, owner):
        """One merge in every word; returns the symbols still open, and those of finished words."""
        same = np.zeros(len(flat), bool)
        same[:-1] = owner[1:] == owner[:-1]
        key = np.full(len(flat), -1, np.int64)
        key[:-1] = flat[:-1] << 32 | flat[1:]
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        rank = np.where(same & (self.keys[at] == key), self.rank[at], NEVER)
        first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        lengths = np.diff(np.append(first, len(flat)))
        lowest = np.minimum.reduceat(rank, first)
        best = np.repeat(lowest, lengths)
        finished = best == NEVER
        hit = (rank == best) & ~finished
        # Of overlapping pairs take every second from the left; of an unsafe merge the leftmost only.
        place = np.flatnonzero(hit)
        new_run = np.concatenate([[True], (np.diff(place) > 1)]) if len(place) else np.zeros(0, bool)
        run_start = place[np.maximum.accumulate(np.where(new_run, np.arange(len(place)), 0))] if len(place) else place
        leftmost = np.concatenate([[True], np.diff(owner[place]) != 0]) if len(place) else new_run
        take = place[np.where(self.safe[at[place]], (place - run_start) % 2 == 0, leftmost)]
        flat = flat.copy()
        flat[take] = self.made[at[take]]
        keep = ~finished
        keep[take + 1] = False
        return flat[keep], owner[keep], flat[finished], owner[finished]


@lru_cache(4)
def merge_table(path: str) -> MergeTable:
    return MergeTable(vocabulary(path))
