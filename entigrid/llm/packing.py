"""Best-fit packing by the configuration linear program over the histogram of lengths.

Texts become ids, longer ones pieces. A configuration is a multiset of lengths that fits one
sequence; the program asks for the fewest sequences whose configurations hold all pieces. It
is solved by multiplicative weights: each length's price falls as it gets covered, and the best
configurations at the prices are found by a knapsack dynamic program, until the full cover found
is within ``GAP`` (or half a sequence) of the prices' bound. The solution is rounded down and what
is left is packed best-fit, always around the longest length left. Best-fit alone is the start,
and the result where rounding loses more than the program gains.
Only the histogram (at most ``capacity`` numbers) comes to the driver; pieces get their places by
their rank among those of their length.

Defined results: null is the empty text (one piece: the end id); rows that repeat a doc_id are
documents of their own. Pieces of full length are sequences of their own.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from entigrid.llm.common import free_name, stored
from entigrid.llm.tokens import END_ID, VOCABULARY, encoded, worker_encoder

CAPACITY = 1024
GAP = 0.005
# As the last of the pipeline's stages it runs in executors whose heaps have grown to their limit:
# what a worker remembers and encodes at once is half of the encoder's own settings.
MEMORY_PIECES, ENCODED_BYTES = 100_000, 3 << 20
#: The power of the prices at first, and up to which it grows fast; steps between knapsacks; the
#: part of the pieces that new configurations start with.
SHARP, STEPS, NEW_SHARE = (8.0, 60.0), 100, 0.05
_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary"
_END = END_ID.to_bytes(4, "little")


def _cut(batches: Iterator[pa.RecordBatch], vocabulary: str, capacity: int, with_ids: bool) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in _PIECES.split(", ")]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    encoder = worker_encoder(vocabulary, MEMORY_PIECES)
    for batch, texts in encoded(batches, encoder, ENCODED_BYTES):
        rows = []
        for doc_id, ids in zip(batch.column("doc_id").to_pylist(), texts):
            ids += _END
            n = len(ids) // 4
            first = n % capacity or capacity
            bounds = [0, *range(first, n + 1, capacity)] if n > capacity else [0, n]
            for i, (a, b) in enumerate(zip(bounds, bounds[1:])):
                own = ids[4 * a : 4 * b]
                rows.append((doc_id, i, a, b - a, zlib.crc32(own), own if with_ids else None))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*rows)) or [[]] * 6, kinds)], names)


def pieces(docs: DataFrame, vocabulary: str = VOCABULARY, capacity: int = CAPACITY, with_ids: bool = True) -> DataFrame:
    """The documents' ids with the end id, in pieces of at most ``capacity``; of a longer
    document only the first piece may be shorter."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    cut = own.mapInArrow(lambda it: _cut(it, vocabulary, capacity, with_ids), _PIECES)
    return cut if with_ids else cut.drop("ids")


# The plan --------------------------------------------------------------------


class Solution(NamedTuple):
    """Rows of ``configs`` are numbers by length; ``amounts`` of them cover every piece. No
    configuration is worth more than 1 at ``prices``, so fewer than ``bound`` sequences can't do."""

    configs: np.ndarray
    amounts: np.ndarray
    prices: np.ndarray
    bound: float


def _knapsack(lengths: np.ndarray, prices: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest worth by room (lengths may repeat), and which length is taken there, or -1.
    Of equals the longest."""
    best, choice = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    down, worth = lengths[::-1], prices[::-1]
    start = len(lengths) - np.searchsorted(lengths, np.arange(capacity + 1), side="right")
    for c in range(1, capacity + 1):
        best[c] = best[c - 1]
        if start[c] < len(lengths):
            gain = best[c - down[start[c] :]] + worth[start[c] :]
            i = int(gain.argmax())
            if gain[i] > best[c] * (1 + 1e-12):
                best[c], choice[c] = gain[i], len(lengths) - 1 - start[c] - i
    return best, choice


def _columns(lengths: np.ndarray, choice: np.ndarray, capacity: int) -> np.ndarray:
    """For each length the configuration of the largest worth that has it."""
    rows = np.arange(len(lengths))
    out = np.zeros((len(lengths), len(lengths)), dtype=np.int16)
    out[rows, rows] = 1
    filled = np.maximum.accumulate(np.where(choice >= 0, np.arange(capacity + 1), 0))
    room = capacity - lengths
    while (room := filled[room]).any():
        own = np.flatnonzero(room)
        taken = choice[room[own]]
        out[own, taken] += 1
        room[own] -= lengths[taken]
    return np.unique(out, axis=0)


def fractional(counts: np.ndarray, capacity: int = CAPACITY, rounds: int | None = None, gap: float = GAP) -> Solution:
    """The configuration program's solution by multiplicative weights, to a measured gap.

    A length's price is its size, multiplied by a power of how often the amounts cover it. An
    amount is multiplied by a root of its configuration's worth at these prices; if none is worth
    other than 1, prices and amounts are optimal but for the power's softness, which sharpens.
    Between such steps a knapsack finds each length's best configuration at the prices, and with
    the largest worth of all the dual bound. Amounts start as the best-fit packing's. They are
    scaled to cover the least covered length; when their sum is within ``gap`` of the bound, or
    within half a sequence, the program is solved. ``rounds`` ends it earlier.
    """
    lengths = np.flatnonzero(counts)
    need, size = counts[lengths].astype(float), lengths / capacity
    start: dict[bytes, int] = {}
    for config, times in _fill(counts, capacity):
        key = config[lengths].astype(np.int16).tobytes()
        start[key] = start.get(key, 0) + times
    known, done = set(start), 0  # configurations in the pool, knapsacks solved
    configs = np.array([np.frombuffer(c, dtype=np.int16) for c in start]).reshape(len(start), len(lengths))
    amounts = np.array(list(start.values()), dtype=float)
    best, prices, bound = (configs, amounts), size, 0.0
    worth, price, sharp = np.ones(len(amounts)), size, SHARP[0]
    while len(lengths):
        most, choice = _knapsack(lengths, price, capacity)
        if (least := float(need @ price) / most[capacity]) > bound:
            prices, bound = price / most[capacity], least
        if best[1].sum() - bound <= max(0.5, gap * bound) or done == rounds:
            break
        keep = (amounts > 1e-6 * amounts.mean()) | (worth > 0.9)
        known.difference_update(c.tobytes() for c in configs[~keep])
        fresh = [c for c in _columns(lengths, choice, capacity) if c.tobytes() not in known]
        configs, amounts = configs[keep], amounts[keep]
        if fresh:
            known.update(c.tobytes() for c in fresh)
            added = np.array(fresh)
            share = need / np.maximum(added.sum(axis=0), 1)
            configs = np.concatenate([configs, added])
            amounts = np.concatenate([amounts, NEW_SHARE * np.where(added > 0, share, np.inf).min(axis=1)])
        own, item = np.nonzero(configs)
        times = configs[own, item].astype(float)
        for _ in range(STEPS):
            cover = np.bincount(item, times * amounts[own], len(lengths)) / need
            if amounts.sum() / cover.min() < best[1].sum():
                best = configs, amounts / cover.min()
            price = size * np.exp(np.clip(-(sharp + 1) * np.log(cover), -60, 60))
            worth = np.bincount(own, times * price[item], len(amounts))
            amounts = amounts * worth ** (1.8 / (sharp + 1))
        sharp *= 1.1 if sharp < SHARP[1] else 1.005
        done += 1
    wide = np.zeros((len(best[0]), capacity + 1), dtype=np.int16)
    wide[:, lengths] = best[0]
    by_length = np.zeros(capacity + 1)
    by_length[lengths] = prices
    return Solution(wide, best[1], by_length, bound)


def _fullest(left: np.ndarray, longest: int, capacity: int) -> np.ndarray:
    """A configuration with the longest length that leaves least room, longer pieces first."""
    config, room = np.zeros_like(left), capacity - longest
    config[longest] = 1
    # how near to the room the lengths left can come; each length as often as it is left
    reach = np.zeros(room + 1, dtype=bool)
    reach[0] = True
    by = np.zeros(room + 1, dtype=np.int64)
    have = left.copy()
    have[longest] -= 1
    for length in np.flatnonzero(have[: room + 1])[::-1]:
        times = min(int(have[length]), room // int(length))
        for _ in range(times):
            new = np.zeros_like(reach)
            new[length:] = reach[:-length]
            new &= ~reach
            if not new.any():
                break
            by[new] = length
            reach |= new
        if reach[room]:
            break
    c = int(np.flatnonzero(reach).max())
    while c:
        config[by[c]] += 1
        c -= int(by[c])
    return config


def _fill(counts: np.ndarray, capacity: int) -> list[tuple[np.ndarray, int]]:
    """All pieces packed best-fit, always around the longest length left."""
    left, out = counts.copy(), []
    while left.any():
        config = _fullest(left, int(np.flatnonzero(left).max()), capacity)
        own = np.flatnonzero(config)
        times = int((left[own] // config[own]).min())
        left -= config * times
        out.append((config, times))
    return out


def plan(counts: np.ndarray, capacity: int = CAPACITY, rounds: int | None = None, gap: float = GAP) -> list[tuple[np.ndarray, int]]:
    """Configurations (numbers by length) and how many sequences have each, for all pieces."""
    solution = fractional(counts, capacity, rounds, gap)
    left, out = counts.copy(), []
    for i in np.argsort(-solution.amounts, kind="stable").tolist():
        config = solution.configs[i].astype(np.int64)
        own = np.flatnonzero(config)
        if times := min(int(solution.amounts[i] + 1e-9), int((left[own] // config[own]).min())):
            left -= config * times
            out.append((config, times))
    out += _fill(left, capacity)
    return min(out, _fill(counts, capacity), key=lambda configs: sum(times for _, times in configs))


class Places:
    """Where the r-th piece of a length goes: sorted bounds of ranks for each length."""

    def __init__(self, configs: list[tuple[np.ndarray, int]]):
        rows: dict[int, list[tuple[int, int, int, int]]] = {}
        taken: dict[int, int] = {}
        base = 0
        for config, times in configs:
            at = 0
            for length in np.flatnonzero(config).tolist():
                each = int(config[length])
                first = taken.get(length, 0)
                rows.setdefault(length, []).append((first, each, base, at))
                taken[length] = first + each * times
                at += each * length
            base += times
        self.sequences = base
        self.rows = {length: np.array(r, dtype=np.int64) for length, r in rows.items()}

    def of(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sequence, offset = np.zeros_like(rank), np.zeros_like(rank)
        for own in np.unique(length).tolist():
            mine = length == own
            table, r = self.rows[own], rank[mine]
            row = table[np.searchsorted(table[:, 0], r, side="right") - 1]
            place = r - row[:, 0]
            sequence[mine] = row[:, 2] + place // row[:, 1]
            offset[mine] = row[:, 3] + place % row[:, 1] * own
        return sequence, offset


def _placed(batches: Iterator[pa.RecordBatch], places: Places, rank: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sequence, offset = places.of(batch.column("length").to_numpy(), batch.column(rank).to_numpy())
        names = [n for n in batch.schema.names if n != rank]
        yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], pa.array(sequence), pa.array(offset)], [*names, "sequence_id", "offset"])


def packed(parts: DataFrame, capacity: int = CAPACITY, rounds: int | None = None) -> DataFrame:
    """The pieces with sequence_id and offset, which replace columns of these names. ``parts`` has
    a length column, 1 to capacity.

    The rank among the pieces of a length comes from counts per length and input partition, so
    a length that a third of all pieces have isn't ranked in one task.
    """
    parts = parts.drop("sequence_id", "offset")
    slot, rank, part, own_rank, before_rank = (free_name(parts, name) for name in ("slot", "rank", "part", "own", "before"))
    parts = stored(parts.withColumn(slot, F.monotonically_increasing_id()), "pieces")
    numbered = F.shiftright(F.col(slot), 33).alias(part)
    sizes = stored(parts.groupBy(F.col("length"), numbered).agg(F.count("*").alias("pieces")), "sizes")
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for row in sizes.groupBy("length").agg(F.sum("pieces").alias("pieces")).collect():  # a row for each length
        counts[row.length] = row.pieces
    before = Window.partitionBy("length").orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("length", part, F.coalesce(F.sum("pieces").over(before), F.lit(0)).alias(before_rank))
    own = Window.partitionBy("length", part).orderBy(slot)
    ranked = (
        parts.withColumn(part, F.shiftright(F.col(slot), 33))
        .withColumn(own_rank, F.row_number().over(own) - 1)
        .join(offsets, ["length", part])
        .withColumn(rank, (F.col(before_rank) + F.col(own_rank)).cast("long"))
    )
    places = Places(plan(counts, capacity, rounds))
    names = [f"`{c}`" for c in parts.columns if c != slot]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in parts.schema if f.name != slot)
    return ranked.select(*names, rank).mapInArrow(lambda it: _placed(it, places, rank), f"{schema}, sequence_id long, offset long")
