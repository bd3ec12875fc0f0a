"""Column layouts shared by the stages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from entigrid.fixed_values import RAW_FIELDS, VIEW_FIELDS

# Where a scan found a record: source kind, file, split of the file, position in the split.
# Numbering turns the four, compared left to right, into one number, which is all that
# stages behind it carry and shuffle.
SCAN_FIELDS = ["source_rank", "source_key", "block_start", "row_pos"]
POSITION = "ingest_pos"

SCAN_SCHEMA = T.StructType([
    T.StructField("source_rank", T.IntegerType()),
    T.StructField("source_key", T.StringType()),
    T.StructField("block_start", T.LongType()),
    T.StructField("row_pos", T.LongType()),
])

RAW_SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in RAW_FIELDS])

_VIEW_TYPES = {"risk_score": T.IntegerType(), "trust": T.DoubleType()}

VIEW_SCHEMA = T.StructType(
    [T.StructField(name, _VIEW_TYPES.get(name, T.StringType())) for name in VIEW_FIELDS]
)

# The published record calls the legal name just "name".
STREAM_SCHEMA = T.StructType([
    T.StructField("name" if f.name == "legal_name" else f.name, f.dataType) for f in VIEW_SCHEMA
])


def order_fields(df: DataFrame) -> list[str]:
    """The columns of a table that tell its rows' order: a number, or where a scan found them."""
    return [c for c in (POSITION, *SCAN_FIELDS) if c in df.columns]


def ingest_order(df: DataFrame) -> Column:
    """The same as one comparable column."""
    return F.col(POSITION) if POSITION in df.columns else F.struct(*SCAN_FIELDS)
