"""Raw party files: CSV and JSON, united with provenance and ingest order."""

from __future__ import annotations

import csv
import io
import json
from collections import defaultdict
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from entigrid.fixed_values import RAW_FIELDS
from entigrid.functions.text import text
from entigrid.schema import SCAN_SCHEMA, RAW_SCHEMA
from entigrid.sources.probe import first_records
from entigrid.sources.provenance import file_name, order_columns

CSV_RANK, JSON_RANK = 0, 1

_CSV_OPTIONS = {"header": True, "quote": '"', "escape": '"'}


def list_files(spark: SparkSession, folder: str, pattern: str) -> list[str]:
    """Paths of the matching files, empty files included, from the listing alone.

    A missing folder is an error. So is a file whose name starts with an underscore: Spark's
    readers would pass over it without a word.
    """
    files = spark.read.option("pathGlobFilter", pattern).text(folder).inputFiles()
    path = spark._jvm.org.apache.hadoop.fs.Path(folder, f"_{pattern}")
    unread = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    if unread:
        names = ", ".join(status.getPath().getName() for status in unread[:5])
        raise ValueError(f"{folder}: rename files that start with an underscore to have them read: {names}")
    return sorted(unquote(path) for path in files)


def _with_provenance(scan: DataFrame, source_rank: int) -> DataFrame:
    """The raw fields, source file and place in the scan, selected directly on the scan."""
    known = set(scan.columns)
    return scan.select(
        *(text(f) if f in known else F.lit("").alias(f) for f in RAW_FIELDS),
        file_name().alias("source_file"),
        *order_columns(source_rank),
    )


def _headers(spark: SparkSession, paths: list[str]) -> dict[str, tuple[str, ...]]:
    """The trimmed names of each file's first record; an empty file has none."""
    records = first_records(spark, paths, quoted=True)
    return {path: tuple(name.strip() for name in next(csv.reader(io.StringIO(record)))) for path, record in records.items()}


def _csv_scan(spark: SparkSession, paths: list[str], header: tuple[str, ...], verify: bool):
    """The raw fields, bound by position: of a repeated name the last column counts."""
    names = header if verify else [f"c{i}" for i in range(len(header))]
    schema = T.StructType([T.StructField(name, T.StringType()) for name in names])
    broken = any("\n" in name for name in header)  # such files aren't split, else the header's rest is a row
    reader = spark.read.options(**_CSV_OPTIONS).option("enforceSchema", not verify).option("multiLine", broken)
    scan = reader.schema(schema).csv(paths)
    last = {field: names[i] for i, field in enumerate(header) if field in RAW_FIELDS}
    return scan.select(*(F.col(f"`{name}`").alias(field) for field, name in last.items()), "_metadata")


def _can_verify(header: tuple[str, ...]) -> bool:
    """Spark compares headers only without names that are repeated, in any case of letters, or empty."""
    return len({name.lower() for name in header}) == len(header) and all(header)


def read_party_csv(
    spark: SparkSession, paths: list[str], uniform_header: bool = False
) -> DataFrame:
    """Parties from CSV files, columns bound by header name.

    The headers of all files are read by one job, and files that share a header are read in one
    scan. For files known to be alike, ``uniform_header`` only has the first one's header taken,
    and Spark check the others against it while reading, failing on a mismatch.
    """
    groups: dict[tuple[str, ...], list[str]] = defaultdict(list)
    if uniform_header:
        header = next((h for i in range(len(paths)) for h in _headers(spark, paths[i : i + 1]).values()), None)
        if header and not _can_verify(header):
            raise ValueError(f"a header with repeated or empty names can't be verified: {header}")
        if header:
            groups[header] = list(paths)
    else:
        headers = _headers(spark, paths)
        for path in paths:
            if path in headers:
                groups[headers[path]].append(path)
    scans = [
        _with_provenance(_csv_scan(spark, files, header, uniform_header), CSV_RANK)
        for header, files in groups.items()
    ]
    return _union(spark, scans)


def _holds_lines(first: str) -> bool:
    """Whether a file whose first line this is holds a record per line: it is an object of its own."""
    try:
        return isinstance(json.loads(first), dict)
    except ValueError:
        return False


def read_party_json(
    spark: SparkSession, paths: list[str], lines: bool | None = None, mode: str = "FAILFAST"
) -> DataFrame:
    """Parties from JSON files, numbers as their source text: a record per line, or a document
    that is one object or array. Unless ``lines`` tells which, each file's first line does.

    A document is one task's work; files of lines split.
    """
    if lines is None:
        firsts = first_records(spark, paths, quoted=False)
        by_line = [path for path in paths if _holds_lines(firsts.get(path, ""))]
    else:
        by_line = paths if lines else []
    documents = sorted(set(paths) - set(by_line))
    scans = []
    for files, whole in ((by_line, False), (documents, True)):
        if files:
            scan = spark.read.schema(RAW_SCHEMA).option("mode", mode).option("multiLine", whole)
            scans.append(_with_provenance(scan.json(files).select("*", "_metadata"), JSON_RANK))
    return _union(spark, scans)


def _union(spark: SparkSession, parts: list[DataFrame]) -> DataFrame:
    if not parts:
        provenance = [T.StructField("source_file", T.StringType()), *SCAN_SCHEMA.fields]
        return spark.createDataFrame([], T.StructType(RAW_SCHEMA.fields + provenance))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def read_parties(
    spark: SparkSession, folder: str, json_lines: bool | None = None, uniform_header: bool = False
) -> tuple[DataFrame, int]:
    """All parties of a folder, CSV before JSON, and the number of files found."""
    csv_files = list_files(spark, folder, "*.csv")
    json_files = list_files(spark, folder, "*.json")
    parts = []
    if csv_files:
        parts.append(read_party_csv(spark, csv_files, uniform_header))
    if json_files:
        parts.append(read_party_json(spark, json_files, json_lines))
    return _union(spark, parts), len(csv_files) + len(json_files)

