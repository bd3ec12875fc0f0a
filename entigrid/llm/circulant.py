"""Near duplicates by circulant MinHash.

Two permutations make the whole signature. The first one (sigma) spreads a text's shingles over a
circle of 2^32 places; the second one (pi) ranks the places. Coordinate k is the least rank after
the circle has been shifted by k, so 128 coordinates need two permutations and no further seeds.
Documents that agree in a whole band of coordinates are candidates (joined in Spark); their exact
Jaccard similarity over whole shingle sets decides. Two texts of similarity 0.8 share no band with
a probability of 4e-8.

Defined results: A-Z is lower-cased, words are runs other than space and \\x09-\\x0D; a text of
fewer words than a shingle has its whole sequence as the only one; a text without words, or null,
has the empty set, is linked with nothing and kept. Rows that repeat a doc_id are rows of their
own; a null doc_id takes part, but a component's id is its least doc_id that isn't null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from entigrid.llm.common import small, stored
from entigrid.llm.overlaps import class_components
from entigrid.llm.shingles import set_ids, shingle_sets

K, PERCENT = 2, 80
COORDINATES, BAND = 128, 4
_CELLS = 1 << 15  # ranks at work at once; they stay in the processor's cache

_SIGMA = (np.uint64(0x9E6C63D0876A9A47), np.uint64(0xC8B3C5A1D24E6F35))
_PI = (np.uint32(0x7FEB352D), np.uint32(0x846CA68B))
_SIGNED = "doc_id long, cls long, n long, bands array<long>"


def sigma(shingles: np.ndarray) -> np.ndarray:
    """The places of shingles on the circle: the upper half of a permutation of 64-bit numbers."""
    x = shingles ^ (shingles >> np.uint64(32))
    x = x * _SIGMA[0]
    x ^= x >> np.uint64(29)
    x *= _SIGMA[1]
    return (x >> np.uint64(32)).astype(np.uint32)


def pi(places: np.ndarray) -> np.ndarray:
    """The ranks of places: a permutation of 32-bit numbers, in place."""
    x = places
    x ^= x >> np.uint32(16)
    x *= _PI[0]
    x ^= x >> np.uint32(15)
    x *= _PI[1]
    x ^= x >> np.uint32(16)
    return x


def signature(shingles: np.ndarray, coordinates: int = COORDINATES) -> np.ndarray:
    """For each shift of the circle the least rank of the set's places."""
    places, least = sigma(shingles), np.full(coordinates, np.iinfo(np.uint32).max, dtype=np.uint32)
    shifts = np.arange(coordinates, dtype=np.uint32)[:, None]
    width = max(_CELLS // coordinates, 1)
    for s in range(0, len(places), width):
        np.minimum(least, pi(places[None, s : s + width] + shifts).min(axis=1), out=least)
    return least


def bands(least: np.ndarray) -> np.ndarray:
    """A key for each band of coordinates."""
    rows = least.reshape(-1, BAND).astype(np.uint64)
    key = np.arange(1, len(rows) + 1, dtype=np.uint64)
    for j in range(BAND):
        key = (key ^ rows[:, j]) * np.uint64(0xD6E8FEB86659FD93)
        key ^= key >> np.uint64(32)
    return key.view(np.int64)


def _signed(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    width = COORDINATES // BAND
    for batch in batches:
        sets = shingle_sets(batch.column("text").to_pylist(), k)
        ids = set_ids(sets)
        keys = np.zeros((len(sets), width), dtype=np.int64)
        _, firsts, which = np.unique(ids, return_index=True, return_inverse=True)  # equal sets of a batch once
        for i in firsts.tolist():
            if len(sets[i]):
                keys[i] = bands(signature(sets[i]))
        keys = keys[firsts[which]]
        lists = pa.ListArray.from_arrays(pa.array(np.arange(0, keys.size + 1, width), pa.int32()), pa.array(keys.ravel()))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(ids), pa.array([len(s) for s in sets], pa.int64()), lists], ["doc_id", "cls", "n", "bands"]
        )


def band_postings(one: DataFrame) -> DataFrame:
    """(key, cls, n, pos, score) of the bands that several of (cls, n, bands) have."""
    keyed = one.select("cls", "n", F.explode("bands").alias("key"))
    shared = keyed.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1").select("key")
    postings = keyed.join(shared, "key")
    # the class with the most shared bands is the likeliest original of its neighbours
    score = postings.groupBy("cls").agg(F.count("*").cast("double").alias("score"))
    return postings.join(score, "cls").select("key", "cls", "n", F.lit(0).cast("long").alias("pos"), "score")


def near_components(docs: DataFrame, k: int = K, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row per document."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = stored(docs.mapInArrow(lambda it: _signed(it, k), _SIGNED), "signed")
    full = signed.filter("n > 0")
    classes = stored(full.groupBy("cls").agg(F.min("doc_id").alias("rep"), F.max("n").alias("n")), "classes")
    one = full.groupBy("cls").agg(F.first("n").alias("n"), F.first("bands").alias("bands"))
    found = class_components(docs, classes, band_postings(one), percent, k, fragments=1, ordered=False)
    own = classes.join(found.withColumnRenamed("node", "cls"), "cls", "left").select("cls", "rep", F.coalesce("component", "cls").alias("component"))
    least = own.groupBy("component").agg(F.min("rep").alias("component_id"))
    # classes of one document that stand alone need no row: the document is its own component
    shared = stored(own.join(least, "component").filter("NOT component_id <=> rep").select(F.col("cls").alias("own"), "component_id"), "components")
    reps = classes.select(F.col("cls").alias("own"), "rep")
    several = full.groupBy("cls").count().filter("count > 1").select(F.col("cls").alias("own"))
    of_class = shared.union(reps.join(several, "own").join(shared.select("own"), "own", "left_anti").select("own", "rep"))
    rows = signed.select("doc_id", "cls", F.col("n").alias("n_shingles"))
    joined = rows.join(small(stored(of_class, "of-class")), (F.col("cls") == F.col("own")) & (F.col("n_shingles") > 0), "left")
    named = joined.select("doc_id", "n_shingles", F.when(F.col("own").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))
    return named.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
