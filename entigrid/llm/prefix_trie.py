"""Prefix trie of conversations, from sorted neighbours.

A conversation is a sequence of turns (role, text); its trie node at depth d stands for its first
d turns. Equal sequences are one class. Classes are sorted over the whole cluster by their turn
digests, and neighbours in that order are edges whose depth is the length of their longest common
prefix (LCP). Within a block of neighbours a union-find takes the edges by descending depth: each
merge of two components makes a branching node, or adds a child to the one that stands at that depth.
A block is closed but for the prefixes that it shares with its neighbours. These few nodes leave it
as partial sums, which are merged by prefix over all blocks; where two partitions meet, the edge
between them takes back what both have counted. So no task sees more than a block at a time, a
hot first turn is cut wherever the order cuts it, and copies of a conversation are counted
before they are sorted.

Defined results: turns are ordered by number, null first, and by digest where numbers repeat; a
null role or text is empty; rows without conv_id belong to no conversation; without conversations
there are no nodes. Turns are told apart by 128 bits of SHA-256. A conversation's digests (16 bytes
a turn) are one row, its texts never are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from entigrid.llm.common import shuffle_partitions, small, stored

DIGEST = 16
SHARED_TURNS, FAMILY = 3, 20  # a host lends at most its first turns to the conversations up to the next host
IDS = 1024  # of a class's conversation ids that are one row
BLOCK_CLASSES, BLOCK_TURNS = 8_192, 1 << 17
NO_ENDS = hashlib.sha256(b"").hexdigest()

NODE, SPINE, BORDER = 0, 1, 2
_TYPES = {
    "kind": pa.int32(), "part": pa.int32(), "block": pa.int64(), "conv_id": pa.int64(), "depth": pa.int64(),
    "parent_conv_id": pa.int64(), "n_convs": pa.int64(), "n_children": pa.int64(), "n_leaves": pa.int64(),
    "total": pa.int64(), "before": pa.int64(), "fresh": pa.int64(), "ends": pa.string(), "key": pa.binary(),
    "parent_key": pa.binary(), "seq": pa.binary(), "words": pa.list_(pa.int64()), "last": pa.bool_(),
}
_ROWS = (
    "kind int, part int, block long, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
    "n_leaves long, total long, before long, fresh long, ends string, key binary, parent_key binary, seq binary, "
    "words array<long>, last boolean"
)
_SUMS = ("n_convs", "n_children", "n_leaves", "total", "fresh")


# Conversations as sequences --------------------------------------------------


def digested(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, digest, words) of each turn that belongs to a conversation."""
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    hexed = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)
    return turns.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.unhex(F.substring(hexed, 1, 2 * DIGEST)).alias("digest"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"),
    )


def rebuilt(turns: DataFrame) -> DataFrame:
    """(conv_id, turns): each conversation with its first h turns taken from its host, the
    conversation at the last multiple of 20, where h is the CRC-32 of its decimal id modulo 4."""
    host = (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("host")
    dealt = digested(turns).select(host, "conv_id", F.struct("turn", "digest", "words").alias("t")).repartition("host")
    own = dealt.groupBy("host", "conv_id").agg(F.sort_array(F.collect_list("t")).alias("own"))
    heads = own.filter("conv_id = host").select("host", F.slice("own", 1, SHARED_TURNS).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (SHARED_TURNS + 1)).cast("int")
    own_rest = F.slice("own", h + 1, F.greatest(F.size("own") - h, F.lit(0)))
    shared = F.when(F.col("head").isNull() | (h == 0), F.slice("own", 1, 0)).otherwise(F.slice("head", F.lit(1), h))
    return own.join(heads, "host", "left").select("conv_id", F.concat(shared, own_rest).alias("turns"))


def sequences(conversations: DataFrame) -> DataFrame:
    """(conv_id, seq, words) from (conv_id, turns): the digests in a row, and each turn's words."""
    hexed = F.array_join(F.transform("turns", lambda t: F.hex(t["digest"])), "")
    return conversations.select("conv_id", F.unhex(hexed).alias("seq"), F.col("turns.words").alias("words"))


# Blocks of sorted classes ----------------------------------------------------


@dataclass
class Sequence:
    seq: bytes
    words: np.ndarray
    count: int
    least: int
    ends: str

    def __len__(self) -> int:
        return len(self.seq) // DIGEST


def common_turns(a: bytes, b: bytes) -> int:
    n, at, step = min(len(a), len(b)), 0, 64 * DIGEST
    while at < n and a[at : at + step] == b[at : at + step]:
        at += step
    if at >= n:
        return n // DIGEST
    x, y = (np.frombuffer(s[at : min(at + step, n)], dtype=np.uint8) for s in (a, b))
    different = np.flatnonzero(x != y)
    return (at + int(different[0]) if len(different) else n) // DIGEST


def prefix_keys(seq: bytes, depths: int) -> list[bytes]:
    """A key for each prefix of 0 to ``depths`` turns."""
    state, keys = hashlib.blake2b(digest_size=16), []
    keys.append(state.digest())
    for d in range(depths):
        state.update(seq[d * DIGEST : (d + 1) * DIGEST])
        keys.append(state.copy().digest())
    return keys


def _classes(batches: Iterator[pa.RecordBatch]) -> Iterator[Sequence]:
    """Rows of equal sequences, which follow each other by their ids, as one."""
    held, ids = None, None
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("seq", "words", "n", "least", "ids")]
        for seq, words, n, least, text in zip(*columns):
            if held is not None and held.seq == seq:
                held.count += n
                held.least = min(held.least, least)
                ids.update(b"," + text.encode())
                continue
            if held is not None:
                held.ends = ids.hexdigest()
                yield held
            held, ids = Sequence(seq, np.array(words, dtype=np.int64), n, least, ""), hashlib.sha256(text.encode())
    if held is not None:
        held.ends = ids.hexdigest()
        yield held


def _blocks(classes: Iterator[Sequence], block_classes: int) -> Iterator[tuple[list[Sequence], Sequence | None]]:
    """Stretches of classes, each with the class that follows in the partition."""
    block, turns = [], 0
    for c in classes:
        if block and (len(block) == block_classes or turns + len(c) > BLOCK_TURNS):
            yield block, c
            block, turns = [], 0
        block.append(c)
        turns += len(c)
    if block:
        yield block, None


def merged_by_depth(lengths: list[int], lcp: list[int]) -> tuple[np.ndarray, ...]:
    """The branching tree of sorted sequences; ``lcp[i]`` is that of sequences i and i + 1.

    Returns depth, first and last sequence, parent (-1 for the top) and number of children of each
    node. The first ``len(lengths)`` nodes are where the sequences end.
    """
    n = len(lengths)
    component, depth = list(range(n)), list(lengths)
    first, last, parent, children = list(range(n)), list(range(n)), [-1] * n, [0] * n
    top = list(range(n))

    def find(x: int) -> int:
        while component[x] != x:
            component[x] = component[component[x]]
            x = component[x]
        return x

    for i in np.argsort(-np.array(lcp, dtype=np.int64), kind="stable").tolist():
        a, b = find(i), find(i + 1)
        left, right, d = top[a], top[b], lcp[i]
        if depth[left] != d:
            depth.append(d)
            first.append(first[left])
            last.append(last[left])
            parent.append(-1)
            children.append(1)
            parent[left] = left = len(depth) - 1
        # the right one is deeper: at the same depth it would be the left one's own prefix and
        # stand before it, and edges of one depth are taken from left to right
        parent[right] = left
        children[left] += 1
        last[left] = last[right]
        component[b] = a
        top[a] = left
    return tuple(np.array(x, dtype=np.int64) for x in (depth, first, last, parent, children))


def _table(rows: int, **columns) -> pa.RecordBatch:
    arrays = []
    for name, kind in _TYPES.items():
        value = columns.get(name)
        if value is None:
            arrays.append(pa.nulls(rows, kind))
        elif np.isscalar(value):
            arrays.append(pa.array(np.full(rows, value), kind))
        else:
            arrays.append(value if isinstance(value, pa.Array) else pa.array(value, kind))
    return pa.RecordBatch.from_arrays(arrays, list(_TYPES))


def _forest(block: list[Sequence], before: int, after: int, open_left: bool, open_right: bool, part: int, number: int) -> Iterator[pa.RecordBatch]:
    """The nodes of a block. ``before`` and ``after`` are the depths of the edges to its neighbours
    in the partition (-1: none). Nodes that a neighbour may share, all prefixes at an open side,
    leave as parts of their sums."""
    m = len(block)
    length = np.array([len(c) for c in block], dtype=np.int64)
    lcp = [common_turns(a.seq, b.seq) for a, b in zip(block, block[1:])]
    depth, first, last, parent, children = merged_by_depth(length.tolist(), lcp)

    # words of each sequence's first d turns, all in one array
    start = np.concatenate([[0], np.cumsum(length + 1)])
    upto = np.zeros(start[-1], dtype=np.int64)
    for c, at in zip(block, start.tolist()):
        np.cumsum(c.words, out=upto[at + 1 : at + 1 + len(c)])
    full = upto[start[1:] - 1]
    count = np.array([c.count for c in block], dtype=np.int64)
    convs = np.concatenate([[0], np.cumsum(count)])
    total = np.concatenate([[0], np.cumsum(count * full)])
    edges = np.array([max(before, 0), *lcp], dtype=np.int64)
    fresh = np.concatenate([[0], np.cumsum(full - upto[start[:-1] + edges])])  # words of turns the neighbour before hasn't
    ends_here = np.array([*lcp, after], dtype=np.int64) < length
    leaves = np.concatenate([[0], np.cumsum(ends_here)])
    least = np.concatenate([[c.least for c in block], np.full(len(depth) - m, np.iinfo(np.int64).max)])
    for v in np.argsort(-depth, kind="stable").tolist():
        if parent[v] >= 0:
            least[parent[v]] = min(least[parent[v]], least[v])

    # a node stands for the chain of prefixes between its parent's depth and its own
    above = np.where(parent >= 0, depth[parent], -1)
    sizes = depth - above
    node = np.repeat(np.arange(len(depth)), sizes)
    at = np.arange(len(node)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(above, sizes) + 1
    lo, hi = first[node], last[node]
    bottom = at == depth[node]
    known = np.where(lo == 0, before, -1)  # how deep the neighbour before has these prefixes already
    path = np.maximum(known, 0)
    known_words = upto[start[lo] + np.maximum(at - 1, 0)]
    columns = {
        "conv_id": least[node],
        "depth": at,
        "n_convs": convs[hi + 1] - convs[lo],
        "n_children": np.where(bottom, children[node], 1) - ((lo == 0) & (at < before)),
        "n_leaves": leaves[hi + 1] - leaves[lo],
        "total": total[hi + 1] - total[lo],
        "before": known_words,
        "fresh": fresh[hi + 1] - fresh[lo + 1] + full[lo] - upto[start[lo] + np.maximum(path, np.maximum(at - 1, 0))],
    }
    shared = (lo == 0) & (open_left | (at <= before)) | (hi == m - 1) & (open_right | (at <= after))
    # depth 0 is the parent of nothing; else the row above in the chain, or the parent's last row
    end_row = np.cumsum(sizes) - 1
    above_row = np.where(at > np.repeat(above, sizes) + 1, np.arange(len(node)) - 1, end_row[parent[node]])
    has_parent = at > 0
    parent_shared = has_parent & shared[above_row]
    ends = [block[f].ends if b and n == d else NO_ENDS for f, b, n, d in zip(lo.tolist(), bottom.tolist(), length[lo].tolist(), at.tolist())]

    key: list[bytes | None] = [None] * len(node)
    open_ = np.flatnonzero(shared)
    for f in np.unique(lo[open_]).tolist():
        own = open_[lo[open_] == f]
        made = prefix_keys(block[f].seq, int(at[own].max()))
        for i, d in zip(own.tolist(), at[own].tolist()):
            key[i] = made[d]

    def rows(which: np.ndarray, kind: int, **more) -> pa.RecordBatch:
        parent_key = [key[a] if s else None for a, s in zip(above_row[which].tolist(), parent_shared[which].tolist())]
        return _table(
            len(which), kind=kind, part=part, block=(part << 32) + number, ends=[ends[i] for i in which.tolist()], parent_key=parent_key,
            **{k: v[which] for k, v in columns.items()}, **more,
        )

    closed = np.flatnonzero(~shared)
    direct = has_parent[closed] & ~parent_shared[closed]
    yield rows(closed, NODE, parent_conv_id=pa.array(columns["conv_id"][above_row[closed]], pa.int64(), mask=~direct))
    yield rows(open_, SPINE, key=[key[i] for i in open_.tolist()])


def _forests(batches: Iterator[pa.RecordBatch], block_classes: int) -> Iterator[pa.RecordBatch]:
    part, held = TaskContext.get().partitionId(), None
    for number, (block, following) in enumerate(_blocks(_classes(batches), block_classes)):
        before = common_turns(held.seq, block[0].seq) if held else -1
        after = common_turns(block[-1].seq, following.seq) if following else -1
        yield from _forest(block, before, after, held is None, following is None, part, number)
        if held is None:
            yield _table(1, kind=BORDER, part=part, seq=[block[0].seq], words=[block[0].words], last=[False])
        held = block[-1]
    if held is not None:
        yield _table(1, kind=BORDER, part=part, seq=[held.seq], words=[held.words], last=[True])


def _corrections(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Where partitions meet: what both have counted of the prefixes that they share."""
    for batch in batches:
        for left, right, words in zip(*(batch.column(c).to_pylist() for c in ("left", "seq", "words"))):
            d = common_turns(left, right)
            upto = np.concatenate([[0], np.cumsum(np.array(words[:d], dtype=np.int64))])
            depths = np.arange(d + 1)
            above = upto[np.maximum(depths - 1, 0)]
            keys = prefix_keys(right, d)
            ended = int(len(left) // DIGEST == d)
            yield _table(
                d + 1, kind=SPINE, depth=depths, n_convs=0, n_children=-(depths < d).astype(np.int64), n_leaves=np.full(d + 1, -ended),
                total=0, before=above, fresh=above - upto[d], key=keys, parent_key=[None, *keys[:-1]],
            )


def _met(borders: DataFrame) -> DataFrame:
    """(left, seq, words): the last sequence of each partition and the first of the next one that
    has any. One small row for each partition is put in order."""
    parts = borders.filter("NOT last").select("part", F.lag("part").over(Window.orderBy("part")).alias("other"))
    lefts = borders.filter("last").select(F.col("part").alias("other"), F.col("seq").alias("left"))
    firsts = borders.filter("NOT last").select("part", "seq", "words")
    return firsts.join(parts.filter("other IS NOT NULL"), "part").join(lefts, "other").select("left", "seq", "words")


def saved(total: str = "total", n: str = "n_convs", before: str = "before", fresh: str = "fresh") -> Column:
    """Words of all turns of the subtree in all conversations, less those of its distinct prefixes."""
    return F.col(total) - F.col(n) * F.col(before) - F.col(fresh)


def trie(seqs: DataFrame, block_classes: int = BLOCK_CLASSES, parts: int | None = None) -> DataFrame:
    """One row for each distinct prefix of (conv_id, seq, words), from the empty one on:
    conv_id (the least member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens
    and ends_sha256. The sequences are sorted in ``parts`` partitions."""
    # a class's ids in stretches: no row holds all copies of a conversation
    keyed = seqs.withColumn("stretch", F.floor(F.col("conv_id") / IDS))
    classes = keyed.groupBy("seq", "stretch").agg(
        F.first("words").alias("words"), F.count("*").alias("n"), F.min("conv_id").alias("least"),
        F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"),
    )
    classes = stored(classes, "classes")
    ordered = classes.repartitionByRange(parts or shuffle_partitions(seqs.sparkSession), "seq").sortWithinPartitions("seq", "stretch").select("seq", "words", "n", "least", "ids")
    rows = stored(ordered.mapInArrow(lambda it: _forests(it, block_classes), _ROWS), "forests")

    columns = ["depth", "key", "parent_key", "conv_id", "before", "ends", *_SUMS]
    met = _met(rows.filter(F.col("kind") == BORDER)).mapInArrow(_corrections, _ROWS)
    spine = rows.filter(F.col("kind") == SPINE)
    merged = stored(
        spine.select(*columns).union(met.select(*columns)).groupBy("key").agg(
            F.first("depth").alias("depth"), F.max("parent_key").alias("parent_key"), F.min("conv_id").alias("conv_id"), F.first("before").alias("before"),
            # all but one row of a prefix say that nothing ends there
            F.coalesce(F.max(F.when(F.col("ends") != NO_ENDS, F.col("ends"))), F.lit(NO_ENDS)).alias("ends"),
            *[F.sum(c).alias(c) for c in _SUMS],
        ),
        "spine",
    )
    least = merged.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("of_parent"))
    # by block, so that the children of a prefix common to all are no single group
    in_block = spine.select("block", F.col("key").alias("parent_key")).join(least, "parent_key")
    nodes = rows.filter(F.col("kind") == NODE)
    inner = nodes.filter("parent_key IS NULL").withColumn("of_parent", F.col("parent_conv_id"))
    outer = nodes.filter("parent_key IS NOT NULL").join(small(in_block), ["block", "parent_key"])
    middle = merged.join(small(least), "parent_key", "left")
    out = ["conv_id", "depth", F.col("of_parent").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves"]
    out += [saved().alias("saved_tokens"), F.col("ends").alias("ends_sha256")]
    return inner.select(*out).union(outer.select(*out)).union(middle.select(*out))
