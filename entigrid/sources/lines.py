"""Text lines with their file order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from entigrid.operators.wire import parse_classified_lines, parse_identity_lines
from entigrid.sources.provenance import order_columns


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of text files: ``value`` and the place in the scan, taken on the scan itself."""
    return spark.read.text(path).select(
        F.regexp_replace("value", "\r$", "").alias("value"),
        *order_columns(0),
    )


def read_identity_lines(spark: SparkSession, path: str) -> DataFrame:
    return parse_identity_lines(read_lines(spark, path))


def read_classified_lines(spark: SparkSession, path: str) -> DataFrame:
    return parse_classified_lines(read_lines(spark, path))
