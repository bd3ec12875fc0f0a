"""Cleansed tables and quality reports as sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from entigrid.fixed_values import CLEANSED_FIELDS, SEVERITIES
from entigrid.functions.text import text
from entigrid.operators.quality import typed
from entigrid.schema import order_fields
from entigrid.sources.provenance import order_columns

_CLEANSED_TEXT = T.StructType([T.StructField(f, T.StringType()) for f in CLEANSED_FIELDS])


def read_cleansed_csv(spark: SparkSession, path: str) -> DataFrame:
    """A cleansed CSV as text columns with their place in the scan; its header is verified."""
    options = {"header": True, "escape": '"', "enforceSchema": False, "multiLine": True}
    scan = spark.read.options(**options).schema(_CLEANSED_TEXT).csv(path)
    return scan.select(
        *(text(f) for f in CLEANSED_FIELDS),
        *order_columns(0),
    )


def read_typed_cleansed(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """The typed table for quality work, from CSV or parquet."""
    table = read_cleansed_csv(spark, path) if fmt == "csv" else spark.read.format(fmt).load(path)
    return typed(table).select(*CLEANSED_FIELDS, *order_fields(table))


_HEADLINE_SCHEMA = """
    quality_score double, total_records bigint,
    anomalies struct<total: bigint, by_severity: map<string, bigint>>
"""


def read_report_headline(spark: SparkSession, path: str) -> DataFrame:
    """Score, record and anomaly totals of a report; an absent severity counts as 0."""
    report = spark.read.schema(_HEADLINE_SCHEMA).option("multiLine", True).json(path)
    return report.select(
        "quality_score",
        "total_records",
        F.coalesce("anomalies.total", F.lit(0)).alias("anomalies"),
        *(
            F.coalesce(F.element_at("anomalies.by_severity", s), F.lit(0)).alias(s.lower())
            for s in SEVERITIES
        ),
    )
