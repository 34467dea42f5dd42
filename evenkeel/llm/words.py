"""Words of whole texts in bulk: runs of characters other than ASCII white space, A-Z in lower case."""

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc

MIX = np.uint64(0x9E3779B97F4A7C15)


def word_codes(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where each text's words start (one more at the end), a number per word, and the distinct words' hashes."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(column.fill_null("")))
    flat = lists.flatten()
    full = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
    cuts = lists.offsets.to_numpy()
    bounds = np.concatenate([[0], np.cumsum(full)])[cuts - cuts[0]]
    found = flat.filter(pa.array(full)).dictionary_encode()
    return bounds, found.indices.to_numpy(zero_copy_only=False), hashes(found.dictionary)


def hashes(words: pa.Array) -> np.ndarray:
    """64-bit hashes of strings, the same on every machine."""
    return pd.util.hash_array(words.to_numpy(zero_copy_only=False), categorize=False) if len(words) else np.zeros(
        0, np.uint64)


def joined(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Hashes of pairs of hashes."""
    with np.errstate(over="ignore"):
        h = (first ^ (first >> np.uint64(29))) * MIX + second
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return h ^ (h >> np.uint64(31))
