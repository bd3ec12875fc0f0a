"""N-gram Jaccard join with vertical partitioning.

The global order of shingles (rare ones first, as counted over all documents) is cut into
fragments by hash range. Each fragment is a group of its own: it receives every class's shingles
of that range, counts in how many classes each occurs and sends the shared ones back. From these
a class's prefix in the global order follows (the shingles of which linked classes must have one
in common), which gives candidates; for these, overlaps are counted per fragment and summed.

Shingles that many documents of one batch hold (a passage in a third of the corpus) don't travel
with their documents: the batch sends their count, and their lists of classes are joined with
the total afterwards, so no task gathers such a list.

Defined results: a null text has no words; a text without words has an empty set and is linked
with nothing; rows that repeat a doc_id are rows of their own; a null doc_id takes part, and a
component's id is its least doc_id that isn't null. ``docs`` should be a table scan, as its
batches are read twice.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from entigrid.llm.common import free_name, shuffle_partitions, stored
from entigrid.llm.overlaps import class_components, prefix_postings
from entigrid.llm.shingles import set_ids, shingle_sets

K, PERCENT = 5, 80
# Shingles that one fragment is meant to hold, and documents of a batch above which a shingle is common.
FRAGMENT_SHINGLES = 2_000_000
COMMON_IN_BATCH = 64

_ROWS = "doc_id long, cls long, n long, u long"
_FRAGMENT = "frag int, classes binary, counts binary, low binary, high binary"
_SHARED = "cls long, key long, df long"
_LINKS = "key long, classes array<long>"


def _keys(s: np.ndarray) -> np.ndarray:
    """The 40 bits of a shingle hash by which shingles are counted."""
    return s >> np.uint64(24)


def _summary(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = shingle_sets(batch.column("text").to_pylist(), k)
        n = np.array([len(s) for s in sets], dtype=np.int64)
        u = np.array([len(np.unique(_keys(s))) for s in sets], dtype=np.int64)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(set_ids(sets)), pa.array(n), pa.array(u)], ["doc_id", "cls", "n", "u"]
        )


def summaries(docs: DataFrame, k: int = K) -> DataFrame:
    """One row per document: its class, its number of shingles, and how many keys they have."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(lambda it: _summary(it, k), _ROWS)


def _new_classes(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Class ids, and for each of their keys the place of its class; each class once a partition."""
    met: set[int] = set()
    for batch in batches:
        sets = shingle_sets(batch.column("text").to_pylist(), k)
        ids, keep = set_ids(sets), []
        for i, s in enumerate(sets):
            if len(s) and ids[i] not in met:
                met.add(ids[i])
                keep.append(i)
        if keep:
            own = [np.unique(_keys(sets[i])) for i in keep]
            place = np.repeat(np.arange(len(keep), dtype=np.int64), [len(x) for x in own])
            yield ids[keep], np.concatenate(own), place


def _common(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.sort(keys)
    first = np.flatnonzero(np.concatenate([[True], order[1:] != order[:-1]]))
    counts = np.diff(np.append(first, len(order)))
    often = counts >= COMMON_IN_BATCH
    return order[first][often], counts[often]


def _to_fragments(batches: Iterator[pa.RecordBatch], k: int, fragments: int) -> Iterator[pa.RecordBatch]:
    for ids, keys, place in _new_classes(batches, k):
        common, count = _common(keys)
        if len(common):
            at = np.searchsorted(common, keys).clip(max=len(common) - 1)
            rare = common[at] != keys
            keys, place = keys[rare], place[rare]
        frag = _fragment(keys, fragments)
        order = np.argsort(frag, kind="stable")
        frag, keys, place = frag[order], keys[order], place[order]
        bounds = np.searchsorted(frag, np.arange(fragments + 1))
        hot = _fragment(common, fragments)
        rows = []
        for f in range(fragments):
            a, b = bounds[f], bounds[f + 1]
            if b > a:
                there, number = np.unique(place[a:b], return_counts=True)
                rows.append((f, ids[there].tobytes(), number.astype(np.uint32).tobytes(), *_split(keys[a:b])))
            if len(own := np.flatnonzero(hot == f)):
                rows.append((f, None, count[own].astype(np.uint32).tobytes(), *_split(common[own])))
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows), [pa.int32()] + [pa.binary()] * 4)],
            ["frag", "classes", "counts", "low", "high"],
        )


def _fragment(keys: np.ndarray, fragments: int) -> np.ndarray:
    return ((keys >> np.uint64(8)) * np.uint64(fragments) >> np.uint64(32)).astype(np.int32)


def _split(keys: np.ndarray) -> tuple[bytes, bytes]:
    return keys.astype(np.uint32).tobytes(), (keys >> np.uint64(32)).astype(np.uint8).tobytes()


def _count_fragment(rows: pa.Table) -> pa.Table:
    """Of one fragment, (class, key, classes with it) of the keys that several classes have; for
    keys that some batch only counted, also a row without class."""
    cls, keys, common, counted = [], [], [], []
    for row in rows.to_pylist():
        key = np.frombuffer(row["low"], "<u4").astype(np.uint64) | np.frombuffer(row["high"], "u1").astype(np.uint64) << np.uint64(32)
        number = np.frombuffer(row["counts"], "<u4")
        if row["classes"] is None:
            common.append(key)
            counted.append(number.astype(np.int64))
        else:
            keys.append(key)
            cls.append(np.repeat(np.frombuffer(row["classes"], "<i8"), number))
    key = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
    own = np.concatenate(cls) if cls else np.zeros(0, np.int64)
    order = np.lexsort((own, key))
    key, own = key[order], own[order]
    if len(key):
        new = np.concatenate([[True], (key[1:] != key[:-1]) | (own[1:] != own[:-1])])
        key, own = key[new], own[new]
    values, at, df = np.unique(key, return_inverse=True, return_counts=True)
    df = df.astype(np.int64)
    hot, extra = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    if common:
        hot, back = np.unique(np.concatenate(common), return_inverse=True)
        extra = np.bincount(back, np.concatenate(counted), len(hot)).astype(np.int64)
        if len(values):
            place = np.searchsorted(values, hot).clip(max=len(values) - 1)
            same = values[place] == hot
            extra[same] += df[place[same]]
            df[place[same]] = extra[same]
    total = df[at] if len(values) else np.zeros(0, np.int64)
    many = total > 1
    return pa.table({
        "cls": pa.concat_arrays([pa.array(own[many], pa.int64()), pa.nulls(len(hot), pa.int64())]),
        "key": np.concatenate([key[many], hot]).astype(np.int64),
        "df": np.concatenate([total[many], extra]),
    })


def _common_links(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for ids, keys, place in _new_classes(batches, k):
        common, _ = _common(keys)
        its, cuts = np.zeros(0, np.int64), np.zeros(1, np.int64)
        if len(common):
            at = np.searchsorted(common, keys).clip(max=len(common) - 1)
            its = np.flatnonzero(common[at] == keys)
            its = its[np.argsort(at[its], kind="stable")]
            cuts = np.searchsorted(at[its], np.arange(len(common) + 1))
        lists = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(ids[place[its]], pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array(common.astype(np.int64)), lists], ["key", "classes"])


def shared_shingles(docs: DataFrame, fragments: int, k: int = K) -> DataFrame:
    """(cls, key, df): each class's shingle keys that several classes have, and how many have them."""
    texts = docs.select("text")
    counted = stored(
        texts.mapInArrow(lambda it: _to_fragments(it, k, fragments), _FRAGMENT).groupBy("frag").applyInArrow(_count_fragment, _SHARED),
        "shared",
    )
    common = counted.filter("cls IS NULL").select("key", "df")
    links = texts.mapInArrow(lambda it: _common_links(it, k), _LINKS).join(common, "key")
    # taken apart here and not in Python, so that a task never needs a second worker beside the first
    return counted.filter("cls IS NOT NULL").unionByName(links.select(F.explode("classes").alias("cls"), "key", "df").distinct())


def text_classes(rows: DataFrame) -> DataFrame:
    """(cls, rep, n, u): each distinct non-empty set, and the least doc_id that has it."""
    return stored(rows.filter("n > 0").groupBy("cls").agg(F.min("doc_id").alias("rep"), F.max("n").alias("n"), F.max("u").alias("u")), "classes")


def jaccard_components(docs: DataFrame, k: int = K, percent: int = PERCENT) -> DataFrame:
    """(doc_id, cls, n_shingles, component, component_id), one row per document.

    ``component`` is a class id and never null, ``component_id`` the least doc_id of its rows.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = stored(summaries(docs, k), "summaries")
    classes = text_classes(rows)
    total = classes.agg(F.sum("u")).first()[0] or 0
    fragments = max(shuffle_partitions(docs.sparkSession), ceil(total / FRAGMENT_SHINGLES))
    postings = prefix_postings(shared_shingles(docs, fragments, k), classes, percent)
    found = class_components(docs, classes, postings, percent, k)
    own = classes.join(found.withColumnRenamed("node", "cls"), "cls", "left").select("cls", "rep", F.coalesce("component", "cls").alias("component"))
    least = own.groupBy("component").agg(F.min("rep").alias("component_id"))
    of_class = stored(own.join(least, "component").select(F.col("cls").alias("own"), "component", "component_id"), "components")
    alone = F.col("n") == 0
    return rows.join(of_class, (F.col("cls") == F.col("own")) & ~alone, "left").select(
        "doc_id",
        "cls",
        F.col("n").alias("n_shingles"),
        F.coalesce("component", "cls").alias("component"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )


def one_of_each(docs: DataFrame, k: int = K, percent: int = PERCENT) -> DataFrame:
    """The documents without near copies: of each component one row with the least doc_id (one
    without any only if none has an id), with all columns as they were. Texts without words are
    linked with nothing and all stay."""
    cls, nonce = free_name(docs, "set_id"), free_name(docs, "nonce")
    found = stored(jaccard_components(docs, k, percent), "found")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("blank"), "doc_id", "cls")).alias("s")
    keep = found.filter("n_shingles > 0").groupBy("component").agg(first).select("s.doc_id", "s.cls")
    keep = keep.union(found.filter("n_shingles = 0").select("doc_id", "cls").distinct())
    keep_doc, keep_cls = free_name(docs, "keep_doc"), free_name(docs, "keep_cls")
    keep = keep.toDF(keep_doc, keep_cls)

    @F.pandas_udf("long")
    def set_id(texts: pd.Series) -> pd.Series:
        return pd.Series(set_ids(shingle_sets(texts.tolist(), k)))

    empty = int(set_ids([np.zeros(0, np.uint64)])[0])
    # else the join's test for null would compute the ids a second time, in a second worker
    kept = docs.withColumn(cls, set_id.asNondeterministic()(F.col("text")))
    own_id = docs["doc_id"].cast("long")
    kept = kept.join(keep, (F.col(cls) == F.col(keep_cls)) & own_id.eqNullSafe(F.col(keep_doc)), "left_semi")
    if not found.filter("n_shingles > 0").groupBy("doc_id", "cls").count().filter("count > 1").isEmpty():
        # rows repeat an id and a text: one of them stays, but every text without words does
        kept = kept.withColumn(nonce, F.when(F.col(cls) == empty, F.monotonically_increasing_id()).otherwise(F.lit(-1)))
        kept = kept.dropDuplicates(["doc_id", cls, nonce]).drop(nonce)
    return kept.drop(cls)
