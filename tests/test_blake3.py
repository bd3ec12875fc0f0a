"""BLAKE3 against published digests and a plain restatement of the specification."""

import random

import duckdb
import pandas as pd
import pytest

from checks.oracle import _blake3
from entigrid.functions import blake3

# Digests of the bytes 0, 1, .., 250, 0, 1, .. from the published test vectors.
VECTORS = {
    0: "af1349b9f5f9a1a6a0404dea36dcc9499bcb25c9adc112b7cc9a93cae41f3262",
    1: "2d3adedff11b61f14c886e35afa036736dcd87a74d27b5c1510225d0f592e213",
    1024: "42214739f095a406f3fc83deb889744ac00df831c10daa55189b5d121c855af7",
    1025: "d00278ae47eb27b34faecf67b4fe263f82d5412916c1ffd97c8cb7fb814b8444",
    2048: "e776b6028c7cd22a4d0ba182a8bf62205d2ef576467e838ed6f2529b85fba24a",
    2049: "5f4d72f40d7a5f82b15ca2b2e44b1de3c2ef86c426c95c1af0b6879522563030",
}


def digest(words, i):
    return words[:, i].astype("<u4").tobytes().hex()


def test_published_vectors_in_one_batch():
    messages = [bytes(i % 251 for i in range(n)) for n in VECTORS]
    words = blake3._hash_batch(messages)
    assert [digest(words, i) for i in range(len(messages))] == list(VECTORS.values())


def plain(message):
    """One message at a time, the tree by recursion."""
    mask = 0xFFFFFFFF
    iv = [int(x) for x in blake3._IV]

    def compress(cv, block, counter, size, flags):
        words = [int.from_bytes(block[i : i + 4], "little") for i in range(0, 64, 4)]
        s = cv + iv[:4] + [counter & mask, counter >> 32, size, flags]
        for _ in range(7):
            for i, (a, b, c, d) in enumerate(
                [(0, 4, 8, 12), (1, 5, 9, 13), (2, 6, 10, 14), (3, 7, 11, 15),
                 (0, 5, 10, 15), (1, 6, 11, 12), (2, 7, 8, 13), (3, 4, 9, 14)]
            ):
                for w, r1, r2 in ((words[2 * i], 16, 12), (words[2 * i + 1], 8, 7)):
                    s[a] = (s[a] + s[b] + w) & mask
                    s[d] ^= s[a]
                    s[d] = (s[d] >> r1 | s[d] << (32 - r1)) & mask
                    s[c] = (s[c] + s[d]) & mask
                    s[b] ^= s[c]
                    s[b] = (s[b] >> r2 | s[b] << (32 - r2)) & mask
            words = [words[p] for p in [2, 6, 3, 10, 7, 0, 4, 13, 1, 11, 12, 5, 9, 14, 15, 8]]
        return [x ^ y for x, y in zip(s[:8], s[8:])]

    def pad(block):
        return block + bytes(64 - len(block))

    def chunk(data, counter, root):
        cv, blocks = iv, [data[i : i + 64] for i in range(0, len(data), 64)] or [b""]
        for i, block in enumerate(blocks):
            last = i == len(blocks) - 1
            flags = (i == 0) * 1 + last * 2 + (last and root) * 8
            cv = compress(cv, pad(block), counter, len(block), flags)
        return cv

    def tree(data, first, root):
        if len(data) <= 1024:
            return chunk(data, first, root)
        half = 1024
        while half * 2 < len(data):
            half *= 2
        pair = tree(data[:half], first, False) + tree(data[half:], first + half // 1024, False)
        block = b"".join(x.to_bytes(4, "little") for x in pair)
        return compress(iv, block, 0, 64, 4 + root * 8)

    return b"".join(x.to_bytes(4, "little") for x in tree(message, 0, True)).hex()


def test_mixed_lengths_against_the_plain_form(monkeypatch):
    monkeypatch.setattr(blake3, "_SLICE_BYTES", 9000)
    rng = random.Random(5)
    lengths = [0, 1, 63, 64, 65, 1023, 1024, 1025, 3071, 3072, 3073, 7 * 1024 + 5, 16 * 1024, 20000]
    texts = ["".join(chr(rng.randint(32, 900)) for _ in range(n)) for n in lengths]
    series = pd.Series([texts[0], None, *texts[1:]], index=range(5, 6 + len(texts)))
    got = blake3.blake3_hex(series)
    assert list(got.index) == list(series.index)
    assert got.iloc[1] is None
    assert [g for g in got if g] == [plain(t.encode()) for t in texts]


@pytest.mark.parametrize("texts", [[], [None, None]])
def test_nothing_to_hash(texts):
    assert list(blake3.blake3_hex(pd.Series(texts, dtype=object))) == texts


def test_sql_equals_the_function():
    """Lengths around the block borders, up to one chunk."""
    texts = ["abé" * (n // 4) + "x" * (n % 4) for n in (0, 1, 3, 4, 63, 64, 65, 127, 128, 129, 500, 960, 1023, 1024)]
    connection = duckdb.connect()
    connection.execute("CREATE TABLE texts (k INT, t VARCHAR)")
    connection.executemany("INSERT INTO texts VALUES (?, ?)", list(enumerate(texts)))
    ctes = _blake3("texts", "k", "t").removeprefix(",")
    got = connection.execute(f"WITH RECURSIVE {ctes} SELECT digest FROM blake3 ORDER BY key").fetchall()
    assert [d for d, in got] == blake3.blake3_hex(pd.Series(texts)).tolist()
