"""Token ids in wavelet matrices: one compressed file per shard of documents.

A shard holds the ids of consecutive documents, in ascending doc_id order. Level by level, from
the highest bit, the ids' bits form a plane and the ids are dealt out stably, zeros first. With
the number of ones before every ``BLOCK``-th bit, a plane answers rank and select, and from these
follow access to any token, counting and finding of an id's occurrences, without decoding the rest.

File: magic, header numbers, doc_ids and lengths (null ids flagged), then for each plane its number
of zeros, block ranks and bits, every part zstd-compressed; a line feed ends it. Files are written
by Spark's text writer from binary values, one for each row, so they lie wherever Spark can write.

Defined results: null is the empty text; a null doc_id comes first; rows that repeat a doc_id follow
each other by text; a shard holds whole documents and ends after ``SHARD_TOKENS`` ids or more.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from entigrid.llm.common import stored, text_of
from entigrid.llm.id_order import id_stretches, order_key, stretch_of
from entigrid.llm.tokens import END_ID, VOCABULARY, encoded, worker_encoder

SHARD_TOKENS = 1 << 21
BLOCK = 2048
# Pieces that a worker remembers: with more of them, looking up takes longer than learning some again.
MEMORY_PIECES = 100_000
# Ids are dealt out so many at once: what that takes stays in the processor's cache and off the system.
_AT_ONCE = 16_384
_MAGIC = b"WVLT\x01"
# ids, levels, documents, stretch of the doc_id order, shard within it, ids before it there
_HEADER = struct.Struct("<QBQqqQ")
_END = END_ID.to_bytes(4, "little")


def _ones(plane: np.ndarray) -> np.ndarray:
    """The number of ones before each block of a packed plane."""
    counts = np.bitwise_count(plane)
    blocks = np.add.reduceat(counts, np.arange(0, len(counts), BLOCK // 8), dtype=np.uint32) if len(counts) else np.zeros(0, np.uint32)
    return np.concatenate([[0], np.cumsum(blocks)]).astype(np.uint32)


class WaveletMatrix:
    """Rank, select, access and occurrences over bit planes."""

    def __init__(self, n: int, planes: list[np.ndarray], zeros: list[int], ones: list[np.ndarray]):
        self.n, self.planes, self.zeros, self.ones = n, planes, zeros, ones

    @classmethod
    def of(cls, ids: np.ndarray, levels: int) -> WaveletMatrix:
        planes, zeros, ones = [], [], []
        now, then, high = ids, np.empty_like(ids), np.empty_like(ids)
        for level in range(levels - 1, -1, -1):
            mask, plane = ids.dtype.type(1 << level), np.empty(-(-len(ids) // 8), dtype=np.uint8)
            n_low = n_high = 0
            for at in range(0, len(ids), _AT_ONCE):
                part = now[at : at + _AT_ONCE]
                bits = (part & mask) != 0
                packed = np.packbits(bits, bitorder="little")
                plane[at // 8 : at // 8 + len(packed)] = packed
                own = np.flatnonzero(bits)
                high[n_high : n_high + len(own)] = part.take(own)
                n_high += len(own)
                own = np.flatnonzero(~bits)
                then[n_low : n_low + len(own)] = part.take(own)
                n_low += len(own)
            then[n_low:] = high[:n_high]
            planes.append(plane)
            ones.append(_ones(plane))
            zeros.append(n_low)
            now, then = then, (np.empty_like(ids) if now is ids else now)
        return cls(len(ids), planes, zeros, ones)

    def all(self) -> np.ndarray:
        """All ids, from the lowest plane up."""
        values = np.zeros(self.n, dtype=np.uint16 if len(self.planes) <= 16 else np.uint32)
        above = np.empty_like(values)
        for level, (plane, zeros) in enumerate(zip(reversed(self.planes), reversed(self.zeros))):
            mask, low, high = values.dtype.type(1 << level), 0, zeros
            for at in range(0, self.n, _AT_ONCE):
                part = above[at : at + _AT_ONCE]
                bits = np.unpackbits(plane[at // 8 : (at + _AT_ONCE) // 8], count=len(part), bitorder="little").view(bool)
                own = np.flatnonzero(bits)
                part[own] = values[high : high + len(own)] | mask
                high += len(own)
                own = np.flatnonzero(~bits)
                part[own] = values[low : low + len(own)]
                low += len(own)
            values, above = above, values
        return values.astype(np.uint32, copy=False)

    def _bit(self, level: int, i: int) -> int:
        return int(self.planes[level][i >> 3] >> (i & 7)) & 1

    def _rank1(self, level: int, i: int) -> int:
        """Ones among the first i bits of a plane."""
        block = i // BLOCK
        plane, at = self.planes[level], block * (BLOCK // 8)
        count = int(self.ones[level][block]) + int(np.bitwise_count(plane[at : i >> 3]).sum())
        return count + (int(plane[i >> 3] & ((1 << (i & 7)) - 1)).bit_count() if i & 7 else 0)

    def _select(self, level: int, bit: int, k: int) -> int:
        """Place of the k-th (from 0) such bit of a plane."""
        ones = self.ones[level]
        before = ones if bit else np.minimum(np.arange(len(ones)) * BLOCK, self.n) - ones
        block = int(np.searchsorted(before, k, side="right")) - 1
        at = block * (BLOCK // 8)
        bits = np.unpackbits(self.planes[level][at : at + BLOCK // 8], bitorder="little")[: self.n - block * BLOCK]
        return block * BLOCK + int(np.flatnonzero(bits == bit)[k - int(before[block])])

    def access(self, i: int) -> int:
        value = 0
        for level in range(len(self.planes)):
            bit, ones = self._bit(level, i), self._rank1(level, i)
            value = value << 1 | bit
            i = self.zeros[level] + ones if bit else i - ones
        return value

    def _range(self, value: int, a: int, b: int) -> tuple[int, int]:
        """Where an id's occurrences among places a to b stand after the last level."""
        if value >> len(self.planes):
            return 0, 0
        for level in range(len(self.planes)):
            ra, rb = self._rank1(level, a), self._rank1(level, b)
            if value >> (len(self.planes) - 1 - level) & 1:
                a, b = self.zeros[level] + ra, self.zeros[level] + rb
            else:
                a, b = a - ra, b - rb
        return a, b

    def count(self, value: int, a: int = 0, b: int | None = None) -> int:
        first, end = self._range(value, a, self.n if b is None else b)
        return end - first

    def occurrences(self, value: int) -> Iterator[int]:
        """The places of an id, ascending."""
        first, end = self._range(value, 0, self.n)
        for i in range(first, end):
            for level in range(len(self.planes) - 1, -1, -1):
                bit = value >> (len(self.planes) - 1 - level) & 1
                i = self._select(level, bit, i - self.zeros[level] if bit else i)
            yield i


# Files -----------------------------------------------------------------------


def _packed(data: bytes) -> bytes:
    out = zstandard.ZstdCompressor(level=1).compress(data)
    return struct.pack("<Q", len(out)) + out


def to_bytes(docs: list[tuple[int | None, bytes]], stretch: int, shard: int, before: int, levels: int) -> bytes:
    """A shard file of documents with their ids as little-endian unsigned 32-bit bytes."""
    flat = np.frombuffer(b"".join(ids for _, ids in docs), dtype="<u4")
    if levels <= 16:
        flat = flat.astype(np.uint16)
    matrix = WaveletMatrix.of(flat, levels)
    parts = [_MAGIC, _HEADER.pack(len(flat), levels, len(docs), stretch, shard, before)]
    parts.append(_packed(np.array([d or 0 for d, _ in docs], dtype="<i8").tobytes()))
    parts.append(_packed(bytes(d is None for d, _ in docs)))
    parts.append(_packed(np.array([len(ids) // 4 for _, ids in docs], dtype="<u8").tobytes()))
    for plane, zeros, ones in zip(matrix.planes, matrix.zeros, matrix.ones):
        parts += [struct.pack("<Q", zeros), _packed(ones.astype("<u4").tobytes()), _packed(plane.tobytes())]
    return b"".join(parts)


class Shard:
    """A shard file read into memory: its documents and their wavelet matrix."""

    def __init__(self, data: bytes):
        if data[: len(_MAGIC)] != _MAGIC:
            raise ValueError("not a shard file")
        self._data, self._at = data, len(_MAGIC) + _HEADER.size
        n, levels, docs, self.stretch, self.number, self.before = _HEADER.unpack_from(data, len(_MAGIC))
        ids, blank = np.frombuffer(self._part(), "<i8"), self._part()
        self.doc_ids = [None if b else i for i, b in zip(ids.tolist(), blank)]
        self.lengths = np.frombuffer(self._part(), "<u8").astype(np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)]).astype(np.int64)
        planes, zeros, ones = [], [], []
        for _ in range(levels):
            zeros.append(struct.unpack_from("<Q", data, self._at)[0])
            self._at += 8
            ones.append(np.frombuffer(self._part(), "<u4"))
            planes.append(np.frombuffer(self._part(), "u1"))
        if data[self._at :] not in (b"", b"\n") or len(self.doc_ids) != docs:
            raise ValueError("a shard file that goes on after its end")
        self.matrix = WaveletMatrix(n, planes, zeros, ones)

    def _part(self) -> bytes:
        (size,) = struct.unpack_from("<Q", self._data, self._at)
        self._at += 8 + size
        return zstandard.ZstdDecompressor().decompress(self._data[self._at - size : self._at])


def _shards(batches: Iterator[pa.RecordBatch], vocabulary: str, shard_tokens: int, levels: int) -> Iterator[pa.RecordBatch]:
    encoder = worker_encoder(vocabulary, MEMORY_PIECES)
    held: list[tuple[int | None, bytes]] = []
    stretch, shard, before, size = None, 0, 0, 0

    def file() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([to_bytes(held, stretch, shard, before, levels)], pa.binary())], ["value"])

    for batch, texts in encoded(batches, encoder):
        for doc_id, own, ids in zip(batch.column("doc_id").to_pylist(), batch.column("stretch").to_pylist(), texts):
            if held and (own != stretch or size >= shard_tokens):
                yield file()
                shard, before, held, size = shard + 1, before + size, [], 0
            if own != stretch:
                stretch, shard, before = own, 0, 0
            held.append((doc_id, ids + _END))
            size += len(ids) // 4 + 1
    if held:
        yield file()


def write_shards(docs: DataFrame, path: str, vocabulary: str = VOCABULARY, shard_tokens: int = SHARD_TOKENS, levels: int = 16) -> str:
    """Encode the documents, each with the end id, into shard files in doc_id order. ``levels`` is
    the number of bits of the vocabulary's largest id."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"), order_key().alias("key"))
    dealt = own.withColumn("stretch", stretch_of(id_stretches(own))("key")).repartition("stretch").sortWithinPartitions("stretch", "key", "text")
    files = dealt.select("doc_id", "text", "stretch").mapInArrow(lambda it: _shards(it, vocabulary, shard_tokens, levels), "value binary")
    files.select(F.col("value").cast("string")).write.option("maxRecordsPerFile", 1).text(path)
    return path


_READ = "doc_id long, stretch long, start long, n_tokens long, ids_crc32 long, shard long"


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in _READ.split(", ")]
    for batch in batches:
        for content in batch.column("content"):
            if not len(data := content.as_py()):
                continue
            shard = Shard(data)
            ids = shard.matrix.all().astype("<u4")
            n = len(shard.doc_ids)
            crc = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(shard.starts[:-1].tolist(), shard.starts[1:].tolist())]
            columns = [
                pa.array(shard.doc_ids, pa.int64()), pa.array([shard.stretch] * n, pa.int64()), pa.array(shard.starts[:-1] + shard.before),
                pa.array(shard.lengths), pa.array(crc, pa.int64()), pa.array([shard.number] * n, pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names)


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) per document, decoded from the shard files."""
    rows = stored(spark.read.format("binaryFile").load(path).select("content").mapInArrow(_read, _READ), "token-rows")
    # one row for each stretch of ids; their number is that of the files at most
    totals = rows.groupBy("stretch").agg(F.sum("n_tokens").alias("total"))
    before = F.coalesce(F.sum("total").over(Window.orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = totals.select(F.col("stretch").alias("s"), before.alias("before"))
    return rows.join(F.broadcast(offsets), F.col("stretch") == F.col("s")).select(
        "doc_id", (F.col("before") + F.col("start")).alias("start"), "n_tokens", "ids_crc32",
    )


def _found(batches: Iterator[pa.RecordBatch], wanted: list[int]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for content in batch.column("content"):
            shard = Shard(content.as_py())
            rows = []
            for value in wanted:
                for place in shard.matrix.occurrences(value):
                    doc = int(np.searchsorted(shard.starts, place, side="right")) - 1
                    rows.append((value, shard.doc_ids[doc], place - int(shard.starts[doc])))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in (list(zip(*rows)) or [[]] * 3)], ["token", "doc_id", "place"]
            )


def occurrences(spark: SparkSession, path: str, wanted: list[int]) -> DataFrame:
    """(token, doc_id, place): where the wanted ids stand, found by select in each shard file."""
    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(lambda it: _found(it, wanted), "token long, doc_id long, place long")
