"""Where a row was read: file name and place in the scan, and the ingest position made of it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from entigrid.schema import POSITION, SCAN_FIELDS
from entigrid.sources.stored import bounded, stored


def file_name() -> Column:
    """Base name of the file; the metadata column holds it URL-encoded."""
    encoded = F.col("_metadata.file_name")
    decoded = F.try_url_decode(F.replace(encoded, F.lit("+"), F.lit("%2B")))
    return F.when(encoded.contains("%"), F.coalesce(decoded, encoded)).otherwise(encoded)


def order_columns(source_rank: int) -> list[Column]:
    """The place in the scan; right only when selected directly on the scan.

    Files rank by name without regard to case, then by path. Ids rise within a split, and
    splits of one file rank by where they start, so the four columns give file order no
    matter how the scan was spread over tasks.
    """
    return [
        F.lit(source_rank).alias("source_rank"),
        F.concat_ws("|", F.lower(file_name()), F.col("_metadata.file_path")).alias("source_key"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("row_pos"),
    ]


def numbered(rows: DataFrame) -> DataFrame:
    """Stored rows of scans with their global number in place of the four columns.

    Nothing is sorted: rows are counted per split, the counts are summed up in the order of the
    splits, and a row's number is that sum and its place in the split. One row per split is put
    in order; the splits reach the rows by a 64-bit name. Rows that were left out before leave gaps.

    Only stored rows can be numbered: another scan of the same files may cut them differently.
    """
    split = SCAN_FIELDS[:-1]
    splits = rows.groupBy(*split).agg(F.min("row_pos").alias("least"), F.max("row_pos").alias("most"))
    earlier = Window.orderBy(*split).rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum(F.col("most") - F.col("least") + 1).over(earlier), F.lit(0))
    starts = stored(splits.select(F.xxhash64(*split).alias("split"), (before - F.col("least")).alias("start")), "splits")
    named = rows.withColumn("split", F.xxhash64(*split)).drop(*split)
    joined = named.join(bounded(starts), "split")
    return joined.withColumn(POSITION, F.col("row_pos") + F.col("start")).drop("split", "start", "row_pos")


def in_order(rows: DataFrame) -> DataFrame:
    """Rows with their ingest position; those of a scan are stored and numbered."""
    return rows if POSITION in rows.columns else numbered(stored(rows, "scanned"))
