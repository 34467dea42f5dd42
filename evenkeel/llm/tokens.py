"""Whole texts to token ids in bulk, with a public tokenizer.

A text is cut into chunks at places where the tokenizer's own pre-tokenization always cuts, so that chunks
can be encoded apart. A batch has few distinct chunks compared with its length; only those are looked at in
Python, the rest is dictionary encoding in Arrow and gathering in numpy. The caches live in the worker and
are emptied at a fixed size, so memory does not grow with the table; they change no result.
"""

import json
import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

CACHED = 400_000  # pre-tokens, some 60 MB
AT_ONCE = 4 << 20  # bytes of text whose chunks are laid out at a time
MARK = "\x1f"

# Chunks of these characters are normalised and split by the plain patterns below, any other by the library's
# pre-tokenization. Plain chunks are split together: a white space that none of them has stands between them.
PLAIN = r"\A[\n\t -~À-ÖØ-öø-įĲ-ňŊ-ž]*\z"
BETWEEN = "\x1e"
_LETTERS = r"A-Za-zÀ-ÖØ-öø-ž"
_BYTE_WORDS = re.compile(rf"{BETWEEN}|'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTERS}]+| ?[0-9]+| ?[^\s{_LETTERS}0-9]+"
                         rf"|[^\S{BETWEEN}]+(?!\S)|[^\S{BETWEEN}]+")
_LOWER_WORDS = re.compile(rf"{BETWEEN}|'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[0-9]|[^\s{_LETTERS}0-9]+")
_ODD_SPACE = (r"[\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{180e}\x{2000}-\x{200f}\x{2028}\x{2029}\x{202f}\x{205f}"
              r"\x{3000}\x{feff}]")


def texts(docs: DataFrame, *others: str) -> DataFrame:
    """``doc_id, text`` and the named columns only; a null text is an empty one."""
    return docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"), *others)


def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of a few megabytes of ``text``, a longer text in one of its own."""
    for batch in batches:
        size = np.cumsum(pc.binary_length(batch["text"]).to_numpy(zero_copy_only=False).astype(np.int64))
        cuts = [0, *(np.flatnonzero(np.diff(size // AT_ONCE)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            if a < b:
                yield batch.slice(a, b - a)


@lru_cache(1)
def byte_letters() -> dict[int, str]:
    """The printable character that byte-level vocabularies write for each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


def byte_level(word: str) -> str:
    return word.encode().decode("latin-1").translate(byte_letters())


@lru_cache(1)
def _bytes_of_letters() -> dict[int, int]:
    return {ord(c): b for b, c in byte_letters().items()}


def plain_text(word: str) -> str:
    """The text that a byte-level string stands for."""
    return word.translate(_bytes_of_letters()).encode("latin-1").decode()


class Vocabulary:
    """A tokenizer file: the library's tokenizer, its pre-tokenization, and its merges as data."""

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.ids: dict[str, int] = spec["model"]["vocab"]
        self.merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        self.suffix = spec["model"]["end_of_word_suffix"] or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.lower = spec["normalizer"] is not None

    def words(self, chunk: str) -> list[str]:
        """The pre-tokens of a chunk by the library, as they stand in the normalised chunk."""
        if self.library.normalizer:
            chunk = self.library.normalizer.normalize_str(chunk)
        return [plain_text(w) for w, _ in self.library.pre_tokenizer.pre_tokenize_str(chunk)]

    def odd_words(self, text: str) -> list[str]:
        """The pre-tokens of a text that is not cut at spaces; a special string is one of its own, under a mark."""
        out = []
        for piece in re.split("(" + "|".join(map(re.escape, self.special)) + ")", text):
            out += [MARK + piece] if piece in self.special else self.words(piece) if piece else []
        return out

    def cut(self, column: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """A list of chunks per text, and which texts cannot be cut at spaces."""
        special = "|".join(re.escape(s) for s in self.special)
        if self.lower:  # white space is dropped: any space is a place to cut
            odd = pc.match_substring_regex(column, special)
            plain = pc.replace_substring(column, "\n", " ")
            return pc.split_pattern(pc.if_else(odd, "", plain), " "), odd.to_numpy(zero_copy_only=False)
        odd = pc.match_substring_regex(column, f"{special}|{_ODD_SPACE}")
        runs = pc.match_substring_regex(column, r"\s ")
        marked = pc.replace_substring(column, " ", MARK + " ")
        if pc.any(runs).as_py():  # white space in a row belongs to the word after it
            marked = pc.if_else(runs, pc.replace_substring_regex(column, r"(\S)(\s)", rf"\1{MARK}\2"), marked)
        return pc.split_pattern(pc.if_else(odd, "", marked), MARK), odd.to_numpy(zero_copy_only=False)


@lru_cache(4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def _gathered(values: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The stretches ``values[start:start + size]`` in a row."""
    ends = np.cumsum(size)
    return values[np.repeat(start - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)]


class Encoder:
    """Ids of whole texts. ``solve`` encodes new pre-tokens; it gets a list and returns one id list each.

    Distinct chunks of a batch are split in one pass over all of them; pre-tokens are numbered, and the ids of numbered
    pre-tokens lie in a row, so texts are put together by gathering.
    """

    def __init__(self, vocab: Vocabulary, solve: Callable[[list[str]], list]):
        self.vocab, self.solve = vocab, solve
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}  # numbers of pre-tokens, as they stand in a text
        self.ids, self.ends, self.used = np.zeros(1 << 16, np.uint32), np.zeros(1 << 16, np.int64), 0
        self._add([MARK + s for s in self.vocab.special], [[i] for i in self.vocab.special.values()])

    def _add(self, words: list[str], solved: list) -> None:
        size = np.fromiter(map(len, solved), np.int64, len(solved))
        total, first = int(size.sum()), len(self.known)
        while self.used + total > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while first + len(words) >= len(self.ends):
            self.ends = np.concatenate([self.ends, np.zeros_like(self.ends)])
        self.ids[self.used:self.used + total] = np.fromiter(chain.from_iterable(solved), np.uint32, total)
        self.ends[first + 1:first + len(words) + 1] = self.used + np.cumsum(size)
        self.used += total
        self.known.update(zip(words, range(first, first + len(words))))

    def _numbers(self, words: list[str]) -> np.ndarray:
        """Numbers of different pre-tokens."""
        new = [w for w in words if w not in self.known]
        if new:
            self._add(new, self.solve([w if w.isascii() and w.isalnum() else byte_level(w) for w in new]))
        return np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))

    def _all_numbers(self, words: list[str]) -> np.ndarray:
        """Numbers of pre-tokens in a row."""
        self._numbers(list(dict.fromkeys(words)))
        return np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))

    def _split(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Numbers of pre-tokens in a row; where those of each chunk start there and how many they are."""
        plain = pc.match_substring_regex(chunks, PLAIN).to_numpy(zero_copy_only=False)
        start, size = np.zeros(len(chunks), np.int64), np.zeros(len(chunks), np.int64)
        words = np.zeros(0, np.int64)
        if plain.any():
            easy = chunks.filter(pa.array(plain))
            whole = pa.ListArray.from_arrays(pa.array([0, len(easy)], pa.int32()), easy)
            joined = pc.binary_join(whole, BETWEEN)[0].as_py() + BETWEEN
            found = pa.array((_LOWER_WORDS.findall(joined.lower()) if self.vocab.lower else _BYTE_WORDS.findall(joined))
                             ).dictionary_encode()
            code, names = found.indices.to_numpy(), found.dictionary.to_pylist()
            between = names.index(BETWEEN)
            names[between] = MARK + next(iter(self.vocab.special))  # a name that is known
            ends = np.flatnonzero(code == between)
            ends -= np.arange(len(ends))
            start[plain], size[plain] = np.append(0, ends[:-1]), np.diff(ends, prepend=0)
            code = code[code != between]
            words = self._numbers(names)[code] if len(code) else words
        if not plain.all():
            others = [self.vocab.words(c) for c in chunks.filter(pa.array(~plain)).to_pylist()]
            count = np.array([len(o) for o in others])
            start[~plain], size[~plain] = len(words) + np.cumsum(count) - count, count
            words = np.concatenate([words, self._all_numbers(list(chain.from_iterable(others)))])
        return words, start, size

    def _of_words(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of numbered pre-tokens in a row, and where those of each start, one more at the end."""
        size = self.ends[words + 1] - self.ends[words]
        return _gathered(self.ids, self.ends[words], size), np.append(0, np.cumsum(size))

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Where each text's ids start (one more at the end), and all ids in a row; for some megabytes of text."""
        if len(self.known) > CACHED:
            self.forget()
        lists, odd = self.vocab.cut(column)
        found = lists.flatten().dictionary_encode()
        words, start, size = self._split(found.dictionary)
        flat, at = self._of_words(words)
        code = found.indices.to_numpy(zero_copy_only=False)
        first, many = at[start][code], (at[start + size] - at[start])[code]
        ids = _gathered(flat, first, many)
        cuts = lists.offsets.to_numpy()
        bounds = np.append(0, np.cumsum(many))[cuts - cuts[0]]
        return self._with_odd(column, odd, bounds, ids) if odd.any() else (bounds, ids)

    def _with_odd(self, column, odd, bounds, ids):
        pieces = [ids[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        for i in np.flatnonzero(odd):
            pieces[i] = self._of_words(self._all_numbers(self.vocab.odd_words(column[i].as_py())))[0]
        return np.concatenate([[0], np.cumsum([len(p) for p in pieces])]), np.concatenate(pieces)


@lru_cache(4)
def library_encoder(path: str) -> Encoder:
    """Pre-tokens are encoded by the library's own model."""
    vocab = vocabulary(path)
    model = vocab.library.model
    return Encoder(vocab, lambda words: [[t.id for t in model.tokenize(w)] for w in words])
