"""What the operators share: session settings, stored steps, tables, free column names."""

from __future__ import annotations

import ctypes
import gc
import os
import uuid
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from entigrid.session import scratch_path, tune

# Texts go to Python in small batches, so that a worker holds a few megabytes of them.
BATCH_ROWS = 512
BATCH_BYTES = 8 << 20

# Workers are reused by later stages; what a stage has freed goes back to the system, but for some
# megabytes, as pages that go back and forth with every batch cost a tenth of the encoder's time.
WORKER_MEMORY = {
    "MALLOC_ARENA_MAX": "2",
    "MALLOC_MMAP_THRESHOLD_": "1048576",
    "MALLOC_TRIM_THRESHOLD_": "16777216",
    "ARROW_DEFAULT_MEMORY_POOL": "system",
}

# A side of a join is broadcast only when it was counted to have no more rows than this.
BROADCAST_ROWS = 200_000


def prepare(spark: SparkSession) -> SparkSession:
    tune(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    # Python workers import this package; on a cluster without it, submit it with --py-files
    root, known = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [known, root]))
    for name, value in WORKER_MEMORY.items():
        spark.sparkContext.environment.setdefault(name, value)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


# Shuffle files go when the job that made them ends, not when the driver happens to collect garbage.
_SHUFFLES_END_WITH_JOB = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared folder and read again: work done once, lineage cut. The
    write's shuffle files, which nothing reads again, go with its end."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(_SHUFFLES_END_WITH_JOB, None)
    spark.conf.set(_SHUFFLES_END_WITH_JOB, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_SHUFFLES_END_WITH_JOB)
        else:
            spark.conf.set(_SHUFFLES_END_WITH_JOB, before)
    return spark.read.schema(df.schema).parquet(path)


def few(df: DataFrame, rows: int | None = None) -> bool:
    """Whether the rows, as counted, are no more than a broadcast may have."""
    limit = BROADCAST_ROWS if rows is None else rows
    return df.limit(limit + 1).count() <= limit


def small(df: DataFrame, rows: int | None = None) -> DataFrame:
    """Marked for a broadcast if it was counted to be small; else Spark joins it by a shuffle."""
    return F.broadcast(df) if few(df, rows) else df


def free_name(df: DataFrame, name: str) -> str:
    """A column name that the table doesn't have, in any case of letters."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"{name}_{uuid.uuid4().hex[:6]}"
    return name


_KEPT: dict[str, tuple] = {}


def kept_by_worker(owner: str, key, make: Callable):
    """What a Python worker keeps from task to task, made once for a key. Workers go on to other
    operators' tasks, so a worker keeps the state of one owner only, and of one key of it."""
    if owner not in _KEPT or _KEPT[owner][0] != key:
        forget_others(None)
        _KEPT[owner] = (key, make())
    return _KEPT[owner][1]


def forget_others(owner: str | None) -> None:
    """Drop what the worker has kept for other operators."""
    if _KEPT.keys() - {owner}:
        for other in _KEPT.keys() - {owner}:
            del _KEPT[other]
        gc.collect()
        give_back()


def give_back() -> None:
    """Freed memory between what is in use goes back to the system (where the C library can)."""
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def text_of(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def _placed(batch: pa.RecordBatch, column: str, values: pa.Array) -> pa.RecordBatch:
    at = batch.schema.get_field_index(column)
    return batch.set_column(at, pa.field(column, values.type), values)


def _packed(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    codec = pa.Codec("zstd", 1)
    for batch in batches:
        raw = [v.as_buffer() for v in batch.column(column)]
        out = _placed(batch, column, pa.array([codec.compress(r, asbytes=True) if r.size else b"" for r in raw], pa.binary()))
        yield out.append_column("size", pa.array([r.size for r in raw], pa.int64()))


def _unpacked(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    codec = pa.Codec("zstd", 1)
    for batch in batches:
        sizes = batch.column("size").to_pylist()
        batch = batch.drop_columns(["size"])
        # plain values can be many times as large: each batch that goes on holds few of them
        at = 0
        while at < len(sizes):
            stop, held = at + 1, sizes[at]
            while stop < len(sizes) and held + sizes[stop] <= BATCH_BYTES:
                held += sizes[stop]
                stop += 1
            part = batch.slice(at, stop - at)
            plain = [codec.decompress(v.as_buffer(), size, asbytes=True) if size else b"" for v, size in zip(part.column(column), sizes[at:stop])]
            yield _placed(part, column, pa.array(plain, pa.binary()))
            at = stop


def packed(df: DataFrame, column: str) -> DataFrame:
    """The rows with a text column (without nulls) compressed, text by text, and its ``size``: what
    is shuffled so takes about two thirds of what Spark's own compression leaves."""
    df = df.withColumn(column, F.col(column).cast("binary"))
    return df.mapInArrow(lambda it: _packed(it, column), StructType([*df.schema.fields, StructField("size", LongType())]))


def unpacked(df: DataFrame, column: str) -> DataFrame:
    """The rows of ``packed`` with the plain texts again."""
    kinds = StructType([f for f in df.schema.fields if f.name != "size"])
    return df.mapInArrow(lambda it: _unpacked(it, column), kinds).withColumn(column, F.col(column).cast("string"))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
