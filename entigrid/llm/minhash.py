"""MinHash fingerprints of word shingles, near duplicates by bands, and edited neighbours.

A fingerprint holds, for each of ``PERMUTATIONS`` universal hash functions a * x + b, the upper
bits of the least value over the text's shingles. The share of equal places in two fingerprints
estimates the Jaccard similarity. Near duplicates are documents that agree in a whole band of
places (joined in Spark) and whose exact Jaccard similarity is then found to be high enough.
Groups of a band that one original doesn't explain are searched by their rarest shingles instead
of pair by pair, which finds all of their links.

Defined results: null is the empty text; a text without words has the fingerprint of the empty
set, which is like itself only (likeness 1); a text of fewer words than a shingle has its whole
sequence as the only one. Rows that repeat a doc_id follow each other by text; a null doc_id comes
after all others in descending order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from entigrid.llm.common import packed, small, stored, text_of, unpacked
from entigrid.llm.id_order import id_stretches, order_key, stretch_of
from entigrid.llm.overlaps import class_components
from entigrid.llm.shingles import set_ids, shingle_sets

K, PERCENT = 5, 80
PERMUTATIONS, BAND = 128, 6
_COLUMNS = 2048

_random = np.random.default_rng(20)
_A = _random.integers(0, 1 << 63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _random.integers(0, 1 << 63, PERMUTATIONS, dtype=np.uint64)


def signature(shingles: np.ndarray) -> np.ndarray:
    """The upper 16 bits of the least a * x + b modulo 2^64, for each permutation."""
    least = np.full(PERMUTATIONS, np.iinfo(np.uint64).max, dtype=np.uint64)
    for s in range(0, len(shingles), _COLUMNS):
        values = _A[:, None] * shingles[None, s : s + _COLUMNS]
        values += _B[:, None]
        np.minimum(least, values.min(axis=1), out=least)
    return least


def places(least: np.ndarray, n: int) -> np.ndarray:
    # rows of few shingles have large least values, so not the upper bits but mixed ones are kept
    mixed = least * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(48)).astype(">u2") if n else np.zeros(PERMUTATIONS, dtype=">u2")


def fingerprints(texts: list[str | None], k: int = K) -> list[tuple[np.ndarray, int]]:
    """Each text's fingerprint as 128 numbers of 16 bits, and its number of shingles."""
    return [(places(signature(s), len(s)), len(s)) for s in shingle_sets(texts, k)]


def likeness(a: tuple[np.ndarray, int], b: tuple[np.ndarray, int]) -> float:
    if not a[1] or not b[1]:
        return float(a[1] == b[1])
    return float(np.mean(a[0] == b[0]))


# Edited neighbours -----------------------------------------------------------

_EDITED = (
    "doc_id long, cls long, n long, n_chars long, edited_sha256 string, fingerprint binary, "
    "edited_fingerprint binary, near_edited double, near_next double"
)


def edited(text: str, following: str) -> str:
    """The last third of the characters replaced by as many of the following text's first."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


def _compare(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    held = None  # a row whose following one hasn't come yet
    for batch in batches:
        rows = list(zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "stretch", "guard"))))
        sets = shingle_sets([r[1] for r in rows], k)
        ids = set_ids(sets)
        own = [(places(signature(s), len(s)), len(s)) for s in sets]
        pairs = []
        for row, mark, cls in zip(rows, own, ids.tolist()):
            if held is not None and not held[0][3]:
                pairs.append((held, (row, mark, cls)))
            held = (row, mark, cls)
        texts = [edited(a[0][1], b[0][1]) for a, b in pairs]
        out = []
        for (row, mark, cls), (_, following, _), text, other in zip((p[0] for p in pairs), (p[1] for p in pairs), texts, fingerprints(texts, k)):
            out.append((
                row[0], cls, mark[1], len(row[1]), hashlib.sha256(text.encode()).hexdigest(), mark[0].tobytes(),
                other[0].tobytes(), likeness(mark, other), likeness(mark, following),
            ))
        kinds = [pa.int64()] * 4 + [pa.string()] + [pa.binary()] * 2 + [pa.float64()] * 2
        columns = list(zip(*out)) or [[]] * 9
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], [c.split()[0] for c in _EDITED.split(", ")])


def compared_with_edits(docs: DataFrame, k: int = K) -> DataFrame:
    """Each document's set (its id and size n), fingerprint, that of its edited text, and how like
    they and the following document's are. Documents follow each other by descending doc_id, the
    first after the last.

    The documents are dealt out in stretches of doc_id; the first document of each also goes, as
    a guard, to the end of the stretch before it. So texts are shuffled once, and compressed; they
    are sorted as plain texts.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"), order_key().alias("key"))
    bounds = id_stretches(docs)
    stretch = stretch_of(bounds)
    # in descending order a stretch's first document guards the next larger stretch; the largest
    # document guards the smallest stretch. One row a stretch
    firsts = docs.groupBy(stretch("key").alias("stretch")).agg(F.max("key").alias("key"))
    by_stretch = Window.orderBy("stretch")
    least = F.min("stretch").over(by_stretch.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    guards = stored(firsts.select("key", F.coalesce(F.lead("stretch").over(by_stretch), least).alias("before")), "guards")
    both = F.array_compact(
        F.array(
            F.struct(stretch("key").alias("stretch"), F.lit(False).alias("guard")),
            F.when(F.col("before").isNotNull(), F.struct(F.col("before").alias("stretch"), F.lit(True).alias("guard"))),
        )
    )
    docs = packed(docs, "text").join(small(guards), "key", "left")
    dealt = docs.withColumn("to", F.explode(both)).select("doc_id", "text", "size", "key", "to.stretch", "to.guard")
    ordered = unpacked(dealt.repartition("stretch"), "text").sortWithinPartitions("stretch", "guard", F.desc("key"), "text")
    return ordered.select("doc_id", "text", "stretch", "guard").mapInArrow(lambda it: _compare(it, k), _EDITED)


# Near duplicates -------------------------------------------------------------

_MARKED = "doc_id long, cls long, n long, fingerprint binary"


def _marked(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = shingle_sets(batch.column("text").to_pylist(), k)
        marks = [places(signature(s), len(s)).tobytes() for s in sets]
        columns = [batch.column("doc_id"), pa.array(set_ids(sets)), pa.array([len(s) for s in sets], pa.int64()), pa.array(marks, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in _MARKED.split(", ")])


def fingerprinted(docs: DataFrame, k: int = K) -> DataFrame:
    """(doc_id, cls, n, fingerprint): each document's set by its id and size, and its fingerprint."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return docs.mapInArrow(lambda it: _marked(it, k), _MARKED)


def bands(fingerprint: str) -> Column:
    """A key for each band of the fingerprint's places."""
    width = 2 * BAND
    return F.array(*[F.xxhash64(F.substring(fingerprint, width * b + 1, width), F.lit(b)) for b in range(PERMUTATIONS // BAND)])


def near_duplicates(docs: DataFrame, k: int = K, percent: int = PERCENT, marked: DataFrame | None = None) -> DataFrame:
    """(cls, cluster_id, members): for each shingle set that several documents have, or that is
    linked with others, the least doc_id of its cluster, and how many documents the set has.
    ``marked`` are the documents' fingerprints, if they have been made and stored before."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    marked = stored(fingerprinted(docs, k), "marked") if marked is None else marked
    signed = marked.filter("n > 0").select("doc_id", "cls", "n", bands("fingerprint").alias("bands"))
    classes = stored(signed.groupBy("cls").agg(F.min("doc_id").alias("rep"), F.max("n").alias("n"), F.count("*").alias("members")), "classes")
    one = signed.groupBy("cls").agg(F.first("bands").alias("bands"), F.first("n").alias("n"))
    keyed = one.select("cls", "n", F.explode("bands").alias("key"))
    shared = keyed.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1").select("key")
    postings = keyed.join(shared, "key")
    # the class with the most shared bands is the likeliest original of its neighbours
    score = postings.groupBy("cls").agg(F.count("*").cast("double").alias("score"))
    found = class_components(docs, classes, postings.join(score, "cls").select("key", "cls", "n", F.lit(0).cast("long").alias("pos"), "score"), percent, k, fragments=1, ordered=False)
    own = classes.join(found.withColumnRenamed("node", "cls"), "cls", "left")
    own = own.filter("component IS NOT NULL OR members > 1").withColumn("component", F.coalesce("component", "cls"))
    least = own.groupBy("component").agg(F.min("rep").alias("cluster_id"))
    return stored(own.join(least, "component").select("cls", "cluster_id", "members"), "clusters")


def with_clusters(rows: DataFrame, clusters: DataFrame) -> DataFrame:
    """Rows (doc_id, cls, ...) with the cluster_id of their set; alone, a document is its own."""
    own = clusters.select(F.col("cls").alias("own"), "cluster_id")
    joined = rows.join(small(own), F.col("cls") == F.col("own"), "left").drop("own", "cls")
    return joined.withColumn("cluster_id", F.coalesce("cluster_id", "doc_id"))
