"""Spelling variants: words one edit apart, grouped under their commonest neighbour.

Runs of letters are counted over all documents. Two words are near if one code point is inserted,
deleted or replaced; that is so if and only if the lengths of their common prefix and common suffix
reach the longer length minus one. Words lie in padded code-point matrices, and blocks of words
are compared with each other for these two lengths at once.

A block holds words that can be near at all: for an edit in the positions [lo, hi) of the longer
word, what stands before lo and from hi on is the same in both. Such groups, at first one for each
half, are halved further while they have more than ``TILE`` words; at a single position a group has
at most one word for each letter and one without it (91 words). So hot beginnings are split over many groups
without a limit on their words, and each pair is found once, in the group of its first difference.

Defined results: null texts have no runs; a null doc_id is written as nothing in the hashed name
of a run; texts and documents that repeat count again; without words the table is empty.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from entigrid.llm.common import stored

RUN = re.compile("[a-zÀ-ÿ]+")
LEAST_LENGTH, LEAST_COUNT, TIMES = 5, 3, 2
DELETE_EVERY = 97
TILE = 128
TILE_ROWS = 8_192  # of groups that are compared in one go
CELLS = 1 << 21  # compared at once
HELD_WORDS, HELD_LETTERS = 200_000, 1 << 24  # of a task's counts before they are passed on

_COUNTS = "word string, n long"
_NEAR = "word string, n_near long, best_n long, best string"


# Words -----------------------------------------------------------------------


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: Counter[str] = Counter()
    letters = 0

    def passed_on() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])

    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
            if not text:
                continue
            lower = text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")  # A-Z only
            start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
            for run, n in Counter(RUN.findall(lower)).items():
                if len(run) < LEAST_LENGTH:
                    continue
                h = zlib.crc32(run.encode(), start)
                if h % DELETE_EVERY == 0:  # as if mistyped
                    run = run[: h % len(run)] + run[h % len(run) + 1 :]
                    if len(run) < LEAST_LENGTH:
                        continue
                if run not in held:
                    letters += len(run)
                held[run] += n
            if len(held) >= HELD_WORDS or letters >= HELD_LETTERS:
                yield passed_on()
                held.clear()
                letters = 0
    if held:
        yield passed_on()


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) of the words of at least five code points that occur three times or more."""
    texts = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    counts = texts.mapInArrow(_counted, _COUNTS).groupBy("word").agg(F.sum("n").alias("n"))
    return counts.filter(F.col("n") >= LEAST_COUNT)


# Blocks ----------------------------------------------------------------------


def _keyed(rows: DataFrame) -> DataFrame:
    """The group of each row (word, n, m, lo, hi): m is the longer word's length, and what stands
    outside of its positions [lo, hi) is the group's name."""
    tail = F.col("m") - F.col("hi")
    outside = F.xxhash64(
        F.substring("word", F.lit(1), F.col("lo")), F.when(tail > 0, F.substring("word", F.length("word") - tail + 1, tail)).otherwise(F.lit(""))
    )
    return rows.withColumn("outside", outside)


def _halves(rows: DataFrame) -> DataFrame:
    middle = F.floor((F.col("lo") + F.col("hi")) / 2).cast("int")
    each = F.explode(F.array(F.struct(F.col("lo").alias("a"), middle.alias("b")), F.struct(middle.alias("a"), F.col("hi").alias("b"))))
    return rows.withColumn("half", each).select("word", "n", "m", F.col("half.a").alias("lo"), F.col("half.b").alias("hi"))


def matrix(words: list[str], width: int, from_end: bool = False) -> np.ndarray:
    """The words' code points, one word a row, padded with 0 behind (or in front). All are below 256."""
    letters = np.frombuffer("".join(words).encode("latin-1"), dtype=np.uint8)
    size = np.array([len(w) for w in words], dtype=np.int64)
    column = np.arange(len(letters)) - np.repeat(np.cumsum(size) - size, size)
    out = np.zeros((len(words), width), dtype=np.uint8)
    out[np.repeat(np.arange(len(words)), size), column + (np.repeat(width - size, size) if from_end else 0)] = letters
    return out


def _run_length(same: np.ndarray) -> np.ndarray:
    """The number of leading true cells of each row."""
    length = same.argmin(axis=-1)
    return np.where(same.all(axis=-1), same.shape[-1], length)


def near_in_blocks(a: np.ndarray, a_end: np.ndarray, b: np.ndarray, b_end: np.ndarray, size_a: np.ndarray, size_b: np.ndarray, m: int, lo, hi) -> np.ndarray:
    """Which words of block a are one edit from which of block b: (..., rows of a, rows of b).

    Blocks may be stacked; empty rows have size 0. Of each pair the longer has length m, and the
    first difference lies in [lo, hi)."""
    prefix = _run_length(a[..., :, None, :] == b[..., None, :, :])
    suffix = _run_length(a_end[..., :, None, ::-1] == b_end[..., None, :, ::-1])
    longer, shorter = np.maximum(size_a[..., :, None], size_b[..., None, :]), np.minimum(size_a[..., :, None], size_b[..., None, :])
    return (longer == m) & (shorter > 0) & (prefix < m) & (prefix + suffix >= m - 1) & (prefix >= lo) & (prefix < hi)


def _pairs_of(words: list[str], bounds: np.ndarray, m: int, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices of near words, both ways, in groups of words given by their bounds, all for one m."""
    size = np.array([len(w) for w in words], dtype=np.int64)
    front, back = matrix(words, m), matrix(words, m, from_end=True)
    found_a, found_b = [], []
    counts = np.diff(bounds)
    padded = 1 << np.ceil(np.log2(np.maximum(counts, 2))).astype(np.int64)
    for s in np.unique(padded).tolist():
        groups = np.flatnonzero(padded == s)
        # groups of about one size are stacked; of a group too large for that, block pairs are compared
        together, side = max(CELLS // (s * s * m), 1), min(s, max(int((CELLS // m) ** 0.5), 1))
        for g in range(0, len(groups), together):
            own = groups[g : g + together]
            at = bounds[own][:, None] + np.arange(s)[None, :]
            there = np.arange(s)[None, :] < counts[own][:, None]
            at = np.where(there, at, 0)
            lengths = np.where(there, size[at], 0)
            low, high = lo[own][:, None, None], hi[own][:, None, None]
            for i in range(0, s, side):
                for j in range(0, s, side):
                    x, y = at[:, i : i + side], at[:, j : j + side]
                    near = near_in_blocks(front[x], back[x], front[y], back[y], lengths[:, i : i + side], lengths[:, j : j + side], m, low, high)
                    which, p, q = np.nonzero(near)
                    found_a.append(x[which, p])
                    found_b.append(y[which, q])
    none = np.zeros(0, dtype=np.int64)
    return np.concatenate(found_a or [none]), np.concatenate(found_b or [none])


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each word of groups that follow each other: its near words in them, and the best one."""

    def compared(rows: pa.Table) -> pa.RecordBatch:
        words, n = rows.column("word").to_pylist(), rows.column("n").to_numpy()
        m, lo, hi, outside = (rows.column(c).to_numpy() for c in ("m", "lo", "hi", "outside"))
        new = np.ones(len(words), dtype=bool)
        new[1:] = (m[1:] != m[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1]) | (outside[1:] != outside[:-1])
        starts = np.flatnonzero(new)
        pairs = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        for length in np.unique(m).tolist():
            own = np.flatnonzero(m[starts] == length)  # rows are in order of m, so these groups are one stretch
            first, last = starts[own[0]], starts[own[-1] + 1] if own[-1] + 1 < len(starts) else len(words)
            bounds = np.append(starts[own], last) - first
            a, b = _pairs_of(words[first:last], bounds, int(length), lo[starts[own]], hi[starts[own]])
            pairs.append((a + first, b + first))
        a, b = (np.concatenate(x) for x in zip(*pairs))
        # one row for each word here: the most frequent first, then the smallest
        rank = np.argsort(np.argsort(np.array(words, dtype=object), kind="stable")) if len(a) else None
        order = np.lexsort((rank[b], -n[b], rank[a])) if len(a) else a
        a, b = a[order], b[order]
        head = np.flatnonzero(np.concatenate([[True], rank[a[1:]] != rank[a[:-1]]])) if len(a) else a
        sizes = np.diff(np.append(head, len(a)))
        return pa.RecordBatch.from_arrays(
            [
                pa.array([words[i] for i in a[head].tolist()], pa.string()), pa.array(sizes, pa.int64()),
                pa.array(n[b[head]], pa.int64()), pa.array([words[i] for i in b[head].tolist()], pa.string()),
            ],
            ["word", "n_near", "best_n", "best"],
        )

    held, rows, key = [], 0, ("m", "lo", "hi", "outside")
    for batch in batches:
        held.append(batch)
        rows += len(batch)
        if rows < TILE_ROWS:
            continue
        # the last group may go on in the next batch
        table = pa.Table.from_batches(held).combine_chunks()
        values = [table.column(c).to_numpy() for c in key]
        other = np.flatnonzero(np.any([v != v[-1] for v in values], axis=0))
        cut = int(other[-1]) + 1 if len(other) else 0
        if cut:
            yield compared(table.slice(0, cut))
        held, rows = table.slice(cut).to_batches(), rows - cut
    if rows:
        yield compared(pa.Table.from_batches(held))


def near_words(words: DataFrame, tile: int = TILE) -> DataFrame:
    """(word, n_near, best_n, best) of the words (word, n) that have near words."""
    # as the longer or equal word, or the shorter of a pair; an edit in one of the longer's halves
    longer = F.explode(F.array(F.length("word"), F.length("word") + 1))
    rows = _halves(words.select("word", "n", longer.alias("m")).withColumn("lo", F.lit(0)).withColumn("hi", F.col("m")))
    group, found, left = ["m", "lo", "hi", "outside"], [], True
    while left:
        rows = stored(_keyed(rows), "grouped-words")
        sizes = stored(rows.groupBy(*group).agg(F.count("*").alias("size")).filter("size > 1"), "group-sizes")
        several, large = rows.join(sizes, group), (F.col("size") > tile) & (F.col("hi") - F.col("lo") > 1)
        tiles = several.filter(~large).select(*group, "word", "n")
        dealt = tiles.repartition(*group).sortWithinPartitions(*group)
        found.append(stored(dealt.mapInArrow(_near, _NEAR), "near-words"))
        rows = _halves(several.filter(large))
        left = not sizes.filter(large).isEmpty()
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    best = F.min(F.struct((-F.col("best_n")).alias("rank"), "best")).alias("s")
    return out.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select("word", "n_near", (-F.col("s.rank")).alias("best_n"), F.col("s.best").alias("best"))


# Forms -----------------------------------------------------------------------


def followed(forms: DataFrame) -> DataFrame:
    """(word, root) for (word, form): the last word that the forms lead to. Every round doubles the
    steps; as counts at least double with a step, there are few rounds."""
    at = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        on = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = stored(at.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        at = moved.select("word", "root")
        if moved.filter("moved").isEmpty():
            return at


def variants(docs: DataFrame, tile: int = TILE) -> DataFrame:
    """(word, form, root, n, n_near, form_n), one row per word."""
    words = stored(word_counts(docs), "words")
    joined = words.join(near_words(words, tile), "word", "left")
    has = F.col("best_n") >= TIMES * F.col("n")
    named = stored(
        joined.select(
            "word", F.when(has, F.col("best")).alias("form"), "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(has, F.col("best_n")).alias("form_n"),
        ),
        "forms",
    )
    roots = followed(named.filter("form IS NOT NULL"))
    return named.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
