import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from evenkeel.llm import bpe, packing, token_counts, tokens, varbyte

BYTE, WORD = (public_tokenizers.path(f"{n}.json") for n in ("byte_bpe_50k", "word_bpe_49k"))
PIECES = ["a", "b", " ", "  ", "\n", "\t", "'s", "'ll", "é", "ß", "Σ", "İ", " ", "　", "\x1f", "\x0b", "1", "22",
          "½", "!", "??", "<|endoftext|>", "<|startoftext|>", "é", "日本", "😀", "the", "ing", " the", "ŉ", "\x85",
          "\r", "²", "_", "​", "aaaaaaa", "-" * 18, "thth"]


@pytest.fixture(scope="module")
def strings():
    random.seed(7)
    return ["".join(random.choices(PIECES, k=random.randint(0, 30))) for _ in range(1500)] + ["", "a" * 3000, "ab" * 2000]


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_ids_are_the_librarys(strings, path):
    library = Tokenizer.from_file(path)
    want = [e.ids for e in library.encode_batch(strings, add_special_tokens=False)]
    for encoder in (tokens.library_encoder(path), bpe.encoder(path)):
        bounds, ids = encoder.encode(pa.array(strings))
        assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)] == want
    counter = token_counts.Counter(path, token_counts.proven_ids(path))
    assert np.diff(counter.encode(pa.array(strings))[0]).tolist() == [len(w) for w in want]


def test_a_full_cache_changes_nothing(strings, monkeypatch):
    monkeypatch.setattr(tokens, "CACHED", 10)
    monkeypatch.setattr(tokens, "AT_ONCE", 100)
    encoder = tokens.Encoder(tokens.vocabulary(BYTE), bpe.merge_table(BYTE).encode)
    once = tokens.library_encoder(BYTE).encode(pa.array(strings))
    for _ in range(2):
        again = encoder.encode(pa.array(strings))
        assert all((a == b).all() for a, b in zip(once, again, strict=True))


def test_odd_texts_go_through_the_merges(strings, monkeypatch):
    """Special strings and odd spaces: the library splits, the dealt code encodes, whole texts are never handed over."""
    class Split:
        def __init__(self, library):
            self.normalizer, self.pre_tokenizer = library.normalizer, library.pre_tokenizer

    for path in (BYTE, WORD):
        vocab = tokens.Vocabulary(path)
        library, vocab.library = vocab.library, Split(vocab.library)
        encoder = tokens.Encoder(vocab, bpe.merge_table(path).encode)
        bounds, ids = encoder.encode(pa.array(strings))
        assert ids.tolist() == [i for e in library.encode_batch(strings, add_special_tokens=False) for i in e.ids]


def test_batches_are_cut_by_bytes(monkeypatch):
    monkeypatch.setattr(tokens, "AT_ONCE", 10)
    column = pa.array(["a" * n for n in (3, 30, 0, 0, 4, 4, 4, 9, 50)])
    batch = pa.RecordBatch.from_arrays([column, pa.array(range(9))], ["text", "n"])
    parts = list(tokens.sliced(iter([batch, batch.slice(0, 0)])))
    assert [n for p in parts for n in p["n"].to_pylist()] == list(range(9)) and len(parts) > 3


def test_decoding_is_the_librarys(strings):
    library = Tokenizer.from_file(WORD)
    for text in strings[:300]:
        ids = library.encode(text, add_special_tokens=False).ids
        assert bpe.decode(ids, WORD).decode() == library.decode(ids, skip_special_tokens=False)


def _expected(rows, path, end=()):
    library = Tokenizer.from_file(path)
    return [(r["doc_id"], library.encode(r["text"] or "", add_special_tokens=False).ids + list(end)) for r in rows]


def test_counts_and_digests(odd, nothing):
    rows = odd.collect()
    got = token_counts.count_tokens(odd, BYTE).collect()
    want = [(r["doc_id"], len((r["text"] or "").encode()), len(ids), len(ids) > 1024)
            for r, (_, ids) in zip(rows, _expected(rows, BYTE), strict=True)]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    library = Tokenizer.from_file(WORD)
    want = [(d, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(
        library.decode(ids, skip_special_tokens=False).encode()).hexdigest()) for d, ids in _expected(rows, WORD)]
    assert sorted(map(repr, map(tuple, bpe.digests(odd, WORD).collect()))) == sorted(map(repr, want))
    decoded = bpe.encode(odd, WORD, decoded=True).collect()
    assert all(r["decoded"] == library.decode(r["ids"], skip_special_tokens=False) for r in decoded)
    assert token_counts.count_tokens(nothing, BYTE).isEmpty() and bpe.digests(nothing, WORD).isEmpty()


def _check_packing(placed, expected, capacity):
    sequences, documents = {}, {}
    for r in placed:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        documents.setdefault(r["doc_id"], []).append(r)
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert 0 < at <= capacity
    left = sorted((d, i) for d, ids in expected for i in [tuple(ids)] if d is not None)
    for d, ids in left:
        ids = np.array(ids, "<u4")
        crcs = {(r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in documents[d]}
        first = len(ids) - capacity * (-(-len(ids) // capacity) - 1)
        cuts = [0, *range(first, len(ids) + 1, capacity)]
        assert {(k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(
            zip(cuts[:-1], cuts[1:], strict=True))} <= crcs
    assert sum(r["length"] for r in placed) == sum(len(i) for _, i in expected)
    return len(sequences)


@pytest.mark.parametrize("capacity", [7, 1024])
def test_packing(documents, odd, nothing, capacity):
    assert packing.pack(nothing, BYTE, capacity).isEmpty()
    for frame in (odd, documents):
        expected = _expected(frame.collect(), BYTE, [2])
        used = _check_packing(packing.pack(frame, BYTE, capacity).collect(), expected, capacity)
        if frame is documents and capacity == 1024:
            assert used <= 1.02 * -(-sum(len(i) for _, i in expected) // capacity)
    ids = packing.pack(odd, BYTE, capacity, keep_ids=True).collect()
    assert all(zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] for r in ids)


def test_plan_pairs_large_pieces_at_most_twice():
    random.seed(3)
    for capacity in (10, 97):
        counts = {n: random.randint(0, 5) for n in range(1, capacity + 1)}
        plan = packing.Plan(counts, capacity)
        lengths = np.repeat(list(counts), list(counts.values()))
        ranks = np.concatenate([np.arange(c) for c in counts.values()])
        sequence, offset = plan.find(lengths, ranks)
        for s in range(plan.sequences):
            mine = sorted(zip(offset[sequence == s], lengths[sequence == s], strict=True))
            assert all(a + n == b for (a, n), (b, _) in zip(mine, mine[1:])) and mine[0][0] == 0
            assert sum(n for _, n in mine) <= capacity and sum(n > capacity // 3 for _, n in mine) <= 2


def test_id_files(spark, documents, odd, nothing, tmp_path):
    least = spark.createDataFrame([(i, f"text {k} of an id") for k in range(40) for i in (-(1 << 63), None, 5, (1 << 63) - 1)],
                                  "doc_id bigint, text string")
    for k, (frame, size) in enumerate([(documents, 20_000), (odd, 1 << 20), (nothing, 100), (least, 300)]):
        varbyte.write_ids(frame, WORD, f"{tmp_path}/{k}", segment_bytes=size)
        got = sorted(varbyte.read_ids(spark, f"{tmp_path}/{k}", keep_ids=True).collect(), key=lambda r: r["start"])
        want = _expected(frame.collect(), WORD, [2])
        assert sorted((repr(r["doc_id"]), r["ids"]) for r in got) == sorted((repr(d), i) for d, i in want)
        order = [(r["doc_id"] is not None, r["doc_id"] or 0) for r in got]
        assert order == sorted((d is not None, d or 0) for d, _ in want)
        at = 0
        for r in got:
            assert r["start"] == at and r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
            at += r["n_tokens"]


def test_wide_ids_take_more_bytes():
    ids = np.random.default_rng(1).integers(0, 1 << 32, 70_000).astype(np.uint32)
    ids[:30_000] = ids[:3].repeat(10_000)
    table, control, data = varbyte.pack_ids(ids)
    assert (varbyte.unpack_ids(table, control, data, len(ids)) == ids).all() and len(data) > 100_000
