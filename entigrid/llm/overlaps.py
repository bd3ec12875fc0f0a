"""Exact Jaccard links among text classes, from posting lists of candidates.

A class is a set of shingles; all rows with that set belong to it. ``postings`` name, for each
key, the classes that carry it, such that linked classes share at least one key. Overlaps are
counted fragment by fragment of the shingle order and summed per pair.

A key's classes aren't compared pair by pair at first. Each is compared with the one among them
whose shingles are most common (an unchanged original among its edited copies), and the
components of these links are found. What remains are pairs of a key's classes that lie in
different components; these are all compared. So components are exact, while a large group of
near copies costs about one comparison per member.

Keys without an order (bands) would leave too many such pairs, as copies that are too far from
their original resemble all other copies somewhat. There the remaining classes get new keys: the
rarest of their shingles, as counted among them, of which linked classes must have one in common.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from entigrid.llm.common import few, packed, stored, text_of, unpacked
from entigrid.llm.components import connected_components
from entigrid.llm.shingles import set_ids, shingle_sets

FRAGMENTS = 4  # a power of two
SEGMENT_TYPE = "cls long, frag int, items array<long>"


def linked(overlap: Column, a: Column, b: Column, percent: int) -> Column:
    return (overlap * 100 >= (a + b - overlap) * percent) & (overlap > 0)


def _segments(batches: Iterator[pa.RecordBatch], k: int, fragments: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = shingle_sets(batch.column("text").to_pylist(), k)
        ids = set_ids(sets)
        cls, frag, cuts, items = [], [], [0], []
        for i, wanted in enumerate(batch.column("cls").to_pylist()):
            if int(ids[i]) != wanted:
                continue
            # the upper bits; sets are sorted, so fragments are stretches
            part = ((sets[i] >> np.uint64(32)) * np.uint64(fragments) >> np.uint64(32)).astype(np.int32)
            for f in range(fragments):
                a, b = np.searchsorted(part, [f, f + 1])
                if b > a:
                    cls.append(wanted)
                    frag.append(f)
                    items.append(sets[i][a:b].view(np.int64))
                    cuts.append(cuts[-1] + b - a)
        flat = np.concatenate(items) if items else np.zeros(0, dtype=np.int64)
        lists = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(flat))
        yield pa.RecordBatch.from_arrays([pa.array(cls, pa.int64()), pa.array(frag, pa.int32()), lists], ["cls", "frag", "items"])


def segments(docs: DataFrame, classes: DataFrame, wanted: DataFrame, k: int, fragments: int) -> DataFrame:
    """(cls, frag, items) of the wanted classes; their sets are made again from one text of each.
    Texts that have to be shuffled for that, as the classes are many, are shuffled compressed."""
    chosen = classes.join(wanted, "cls", "left_semi").select("rep", "cls")
    same = F.col("doc_id").eqNullSafe(F.col("rep"))
    if few(chosen):
        texts = docs.select("doc_id", "text").join(F.broadcast(chosen), same).select("cls", "text")
    else:
        texts = packed(docs.select("doc_id", text_of().alias("text")), "text").join(chosen, same).select("cls", "text", "size")
        texts = unpacked(texts, "text")
    return stored(texts.mapInArrow(lambda it: _segments(it, k, fragments), SEGMENT_TYPE), "segments")


def overlaps(pairs: DataFrame, parts: DataFrame, fragments: int) -> DataFrame:
    """pairs(a, b, na, nb) with their overlap, counted per fragment and summed."""
    left = parts.select(F.col("cls").alias("b"), "frag", F.col("items").alias("its"))
    right = parts.select(F.col("cls").alias("a"), "frag", "items")
    # b first: a hub is the a of many pairs, so its own segments travel once
    partial = (
        pairs.join(left, "b")
        .join(right, ["a", "frag"])
        .select("a", "b", "na", "nb", "frag", F.size(F.array_intersect("items", "its")).alias("n"))
    )
    # a class can be cut twice where rows repeat a doc_id; a fragment counts once
    each = [F.max(F.when(F.col("frag") == f, F.col("n")).otherwise(0)) for f in range(fragments)]
    return partial.groupBy("a", "b", "na", "nb").agg(sum(each[1:], each[0]).alias("overlap"))


def _verified(pairs: DataFrame, parts: DataFrame, percent: int, fragments: int) -> DataFrame:
    found = overlaps(pairs, parts, fragments).filter(linked(F.col("overlap"), F.col("na"), F.col("nb"), percent))
    return stored(found.select("a", "b"), "links")


def _pair(a: str, b: str) -> list[Column]:
    """The hub or the larger id first does not matter for the overlap; one order for each pair does."""
    swap = F.col(f"{a}.cls") > F.col(f"{b}.cls")
    pick = lambda x, y, c: F.when(swap, F.col(f"{y}.{c}")).otherwise(F.col(f"{x}.{c}"))
    return [pick(a, b, "cls").alias("a"), pick(b, a, "cls").alias("b"), pick(a, b, "n").alias("na"), pick(b, a, "n").alias("nb")]


def prefix_postings(shared: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """(key, cls, n, pos, score): the shared part of each class's prefix in the order (df, key).

    A linked class misses at most n - ceil(percent * n / 100) of the class's shingles, so among
    that many and one more of the rarest there is one they share.
    """
    spare = F.col("n") - F.ceil(F.col("n") * percent / 100)
    grouped = shared.groupBy("cls").agg(F.count("*").alias("m"), F.sort_array(F.collect_list(F.struct("df", "key"))).alias("order"))
    return (
        grouped.join(classes.select("cls", "n", "u"), "cls")
        .withColumn("take", spare + 1 - (F.col("u") - F.col("m")))
        .filter("take > 0")
        .select(
            "cls",
            "n",
            (F.col("u") - F.col("m")).alias("alone"),
            (F.col("m") / F.col("u")).alias("score"),
            F.posexplode(F.slice("order", F.lit(1), F.col("take").cast("int"))).alias("i", "s"),
        )
        .select(F.col("s.key").alias("key"), "cls", "n", (F.col("alone") + F.col("i")).alias("pos"), "score")
    )


def _rarest(parts: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Postings by the rarest shingles of the classes that have segments."""
    # a class can be cut twice where rows repeat a doc_id
    items = parts.dropDuplicates(["cls", "frag"]).select("cls", F.explode("items").alias("key"))
    shared = items.groupBy("key").agg(F.count("*").alias("df")).filter("df > 1")
    return prefix_postings(items.join(shared, "key"), classes.withColumn("u", F.col("n")), percent)


def class_components(
    docs: DataFrame, classes: DataFrame, postings: DataFrame, percent: int, k: int, fragments: int = FRAGMENTS, ordered: bool = True
) -> DataFrame:
    """(cls, component) of the classes that are linked with another one.

    docs(doc_id, text); classes(cls, rep, n); postings(key, cls, n, pos, score). ``pos`` is how many
    shingles of the class come before the key in an order that all classes share; at the first key
    that a pair shares, none of these is common to both. Keys that aren't ``ordered`` have 0 there.
    """
    postings = stored(postings, "postings")

    def near(x: str, y: str) -> Column:
        """The shingles from the key on are enough for the overlap that a link needs."""
        need = (F.col(f"{x}.n") + F.col(f"{y}.n")) * percent
        return ((F.col(f"{x}.n") - F.col(f"{x}.pos")) * (100 + percent) >= need) & ((F.col(f"{y}.n") - F.col(f"{y}.pos")) * (100 + percent) >= need)

    hubs = (
        postings.groupBy("key")
        .agg(F.max(F.struct("score", "cls", "n", "pos")).alias("hub"), F.count("*").alias("members"))
        .filter("members > 1")
        .select("key", "hub.cls", "hub.n", "hub.pos")
    )
    first = stored(
        hubs.alias("x")
        .join(postings.alias("y"), "key")
        .filter((F.col("x.cls") != F.col("y.cls")) & near("x", "y"))
        .select(*_pair("x", "y"))
        .distinct(),
        "pairs",
    )
    ends = lambda p: p.select(F.col("a").alias("cls")).union(p.select(F.col("b").alias("cls"))).distinct()
    # without an order the remaining classes need theirs too, so all classes' are made, once
    parts = segments(docs, classes, ends(first) if ordered else postings.select("cls").distinct(), k, fragments)
    links = _verified(first, parts, percent, fragments)
    found = connected_components(links)

    def mixed(postings: DataFrame) -> DataFrame:
        """Rows of the keys whose classes lie in several components, with the largest as ``main``."""
        placed = stored(
            postings.join(found.withColumnRenamed("node", "cls"), "cls", "left")
            .select("key", "cls", "n", "pos", F.coalesce("component", "cls").alias("component")),
            "placed",
        )
        sizes = placed.groupBy("key", "component").agg(F.count("*").alias("size"))
        main = (
            sizes.groupBy("key")
            .agg(F.max(F.struct("size", "component")).alias("most"), F.count("*").alias("parts"))
            .filter("parts > 1")
            .select("key", F.col("most.component").alias("main"))
        )
        return placed.join(main, "key")

    inside = mixed(postings)
    if not ordered:
        inside = mixed(_rarest(parts.join(inside.select("cls").distinct(), "cls", "left_semi"), classes, percent))
    rest = (
        inside.filter("component != main").alias("x")
        .join(inside.alias("y"), "key")
        .filter(
            (F.col("x.component") != F.col("y.component"))
            & ((F.col("y.component") == F.col("y.main")) | (F.col("x.cls") < F.col("y.cls")))
            & near("x", "y")
        )
        .select(*_pair("x", "y"))
        .distinct()
    )
    rest = stored(rest.join(first, ["a", "b"], "left_anti"), "pairs")
    if rest.isEmpty():
        return found
    parts = segments(docs, classes, ends(rest), k, fragments) if ordered else parts
    more = _verified(rest, parts, percent, fragments)
    return connected_components(links.union(more))
