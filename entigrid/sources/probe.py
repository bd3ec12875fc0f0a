"""The first record of each of many text files, from one distributed job."""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator
from contextlib import contextmanager
from urllib.parse import unquote

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Files up to this size are read whole, many in one task. Of a larger one, a task of its own reads
# the first lines and stops.
SMALL_FILE = 256 << 10
_WHOLE_FILES = {"spark.sql.files.maxPartitionBytes": str(128 << 20), "spark.sql.files.openCostInBytes": str(1 << 20)}
_FILE_A_TASK = {"spark.sql.files.maxPartitionBytes": str(1 << 45), "spark.sql.files.openCostInBytes": str(1 << 45)}
RECORD_LINES = 1_000  # of a record whose quotes don't close

# Executors need not have this package installed to run the function.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]):
    before = {key: spark.conf.get(key) for key in values}
    try:
        for key, value in values.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def _first_records(batches: Iterator[pa.RecordBatch], quoted: bool, alone: bool) -> Iterator[pa.RecordBatch]:
    """The first line of each file that isn't blank; ``quoted``, with the lines up to where its
    quotes close. The lines of a file follow each other."""
    at, lines, done = None, [], False

    def record() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([at]), pa.array(["\n".join(lines)])], ["path", "record"])

    for batch in batches:
        for path, value in zip(batch.column("path").to_pylist(), batch.column("value").to_pylist()):
            if path != at:
                if lines and not done:
                    yield record()
                at, lines, done = path, [], False
            if done or not lines and not value.removeprefix("﻿").strip():
                continue
            lines.append(value if lines else value.removeprefix("﻿"))
            if not quoted or sum(line.count('"') for line in lines) % 2 == 0 or len(lines) == RECORD_LINES:
                yield record()
                done = True
                if alone:
                    return
    if lines and not done:
        yield record()


def _plain(path: str) -> str:
    """A path without a host is written with one slash or three."""
    return re.sub(r"^([A-Za-z][\w+.-]*):///(?!/)", r"\1:/", path)


def first_records(spark: SparkSession, paths: list[str], quoted: bool) -> dict[str, str]:
    """The first record of every file that has one, by path.

    Two jobs at most, whatever the number of files: one for the small files, one for the others.
    """
    found: dict[str, str] = {}
    if not paths:
        return found
    given = {_plain(path): path for path in paths}
    size: Column = F.col("_metadata.file_size")
    for part, settings, alone in ((size <= SMALL_FILE, _WHOLE_FILES, False), (size > SMALL_FILE, _FILE_A_TASK, True)):
        with _settings(spark, settings):
            lines: DataFrame = spark.read.text(paths).filter(part).select(F.col("_metadata.file_path").alias("path"), "value")
            rows = lines.mapInArrow(lambda it, alone=alone: _first_records(it, quoted, alone), "path string, record string").collect()
        found.update((given[_plain(unquote(row.path))], row.record) for row in rows)
    return found
