"""BLAKE3-256 of a string column, for which Spark has no built-in.

An Arrow UDF hashes whole batches: every compression runs over all 1,024-byte chunks of the
batch at once, so Python does a fixed number of numpy calls per batch, not per row. The
algorithm is the published BLAKE3 specification; text of any length is hashed in full.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql.functions import pandas_udf

# Fixed values of the specification.
_IV = np.array(
    [0x6A09E667, 0xBB67AE85, 0x3C6EF372, 0xA54FF53A, 0x510E527F, 0x9B05688C, 0x1F83D9AB, 0x5BE0CD19],
    dtype=np.uint32,
)
_PERMUTATION = [2, 6, 3, 10, 7, 0, 4, 13, 1, 11, 12, 5, 9, 14, 15, 8]
_MIXES = [
    (0, 4, 8, 12), (1, 5, 9, 13), (2, 6, 10, 14), (3, 7, 11, 15),
    (0, 5, 10, 15), (1, 6, 11, 12), (2, 7, 8, 13), (3, 4, 9, 14),
]
_CHUNK_START, _CHUNK_END, _PARENT, _ROOT = 1, 2, 4, 8
_CHUNK_BYTES, _BLOCK_BYTES = 1024, 64

_SLICE_BYTES = 16 * 1024 * 1024

# Executors need not have this package installed to run the function.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _compress(chaining, words, counter, length, flags):
    """One compression for each column: (8, n) chaining and (16, n) words to (8, n)."""
    n = chaining.shape[1]
    state = np.empty((16, n), dtype=np.uint32)
    state[:8] = chaining
    state[8:12] = _IV[:4, None]
    state[12] = counter & 0xFFFFFFFF
    state[13] = counter >> np.uint64(32)
    state[14] = length
    state[15] = flags

    def turn(x, bits):
        return (x >> np.uint32(bits)) | (x << np.uint32(32 - bits))

    schedule = list(range(16))
    for _ in range(7):
        for i, (a, b, c, d) in enumerate(_MIXES):
            for word, right_d, right_b in ((2 * i, 16, 12), (2 * i + 1, 8, 7)):
                state[a] += state[b] + words[schedule[word]]
                state[d] = turn(state[d] ^ state[a], right_d)
                state[c] += state[d]
                state[b] = turn(state[b] ^ state[c], right_b)
        schedule = [schedule[p] for p in _PERMUTATION]
    return state[:8] ^ state[8:]


def _hash_batch(messages: list[bytes]) -> np.ndarray:
    """The (8, n) digest words of n messages."""
    sizes = np.array([len(m) for m in messages], dtype=np.int64)
    chunks = np.maximum(1, -(-sizes // _CHUNK_BYTES))
    owner = np.repeat(np.arange(len(messages)), chunks)
    first = np.cumsum(chunks) - chunks
    number = np.arange(len(owner)) - first[owner]
    held = np.clip(sizes[owner] - number * _CHUNK_BYTES, 0, _CHUNK_BYTES)
    blocks = np.maximum(1, -(-held // _BLOCK_BYTES))

    # Only as many block columns as the fullest chunk needs; short texts stay small.
    width = int(blocks.max()) * _BLOCK_BYTES
    padded = np.zeros((len(owner), width), dtype=np.uint8)
    data = np.frombuffer(b"".join(messages), dtype=np.uint8)
    filled = np.arange(width) < held[:, None]
    padded[filled] = data
    words = padded.view("<u4").reshape(len(owner), width // _BLOCK_BYTES, 16)

    single = chunks[owner] == 1
    values = np.repeat(_IV[:, None], len(owner), axis=1)
    for block in range(int(blocks.max())):
        live = np.flatnonzero(blocks > block)
        last = blocks[live] == block + 1
        flags = (
            _CHUNK_START * (block == 0) + _CHUNK_END * last + _ROOT * (last & single[live])
        )
        values[:, live] = _compress(
            values[:, live],
            words[live, block].T,
            number[live].astype(np.uint64),
            np.minimum(held[live] - block * _BLOCK_BYTES, _BLOCK_BYTES),
            flags,
        )

    # Neighbours merge level by level; an odd last one moves up as it is.
    while len(owner) > len(messages):
        counts = np.bincount(owner, minlength=len(messages))
        first = np.cumsum(counts) - counts
        place = np.arange(len(owner)) - first[owner]
        left = np.flatnonzero((place % 2 == 0) & (place + 1 < counts[owner]))
        kept = np.flatnonzero(place % 2 == 0)
        merged = _compress(
            np.repeat(_IV[:, None], len(left), axis=1),
            np.concatenate([values[:, left], values[:, left + 1]]),
            np.zeros(len(left), dtype=np.uint64),
            _BLOCK_BYTES,
            _PARENT + _ROOT * (counts[owner[left]] == 2),
        )
        values[:, left] = merged
        values, owner = values[:, kept], owner[kept]
    return values


def blake3_hex(texts: pd.Series) -> pd.Series:
    """64 hex digits per text; an absent text stays absent."""
    messages = [t.encode("utf-8") for t in texts.dropna()]
    # Long texts are hashed in slices of a batch, to keep the padded blocks small.
    ends = np.cumsum([len(m) for m in messages]) // _SLICE_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(ends)) + 1), len(messages)]
    digests = []
    for start, stop in zip(cuts, cuts[1:]):
        if start < stop:
            words = _hash_batch(messages[start:stop])
            raw = np.ascontiguousarray(words.T.astype("<u4")).tobytes().hex()
            digests += [raw[i : i + 64] for i in range(0, len(raw), 64)]
    result = pd.Series([None] * len(texts), index=texts.index, dtype=object)
    result[texts.notna()] = digests
    return result


def fingerprint_blake3(text: Column) -> Column:
    return pandas_udf(blake3_hex, "string")(text)
