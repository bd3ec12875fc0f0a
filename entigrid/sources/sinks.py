"""Writing the results."""

from __future__ import annotations

from pyspark.sql import DataFrame

from entigrid.fixed_values import CLEANSED_FIELDS, RAW_FIELDS
from entigrid.operators.quality import DISTRIBUTION_FIELDS, anomalies, ordered_counts, value_counts
from entigrid.operators.reports import quality_report, quality_summary
from entigrid.operators.wire import CLASSIFIED_HEADER_LINE, classified_lines, identity_lines
from entigrid.sources.stored import stored

CSV_FILE_RECORDS = 500_000

# Values are written as they are: not trimmed, and nothing for the empty string.
_CSV_OPTIONS = {
    "header": True,
    "escape": '"',
    "emptyValue": "",
    "nullValue": "",
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def write_raw_csv(raw: DataFrame, path: str, mode: str = "errorifexists") -> None:
    raw.select(*RAW_FIELDS).write.mode(mode).options(**_CSV_OPTIONS).csv(path)


def write_cleansed(cleansed: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """The cleansed table as parquet, with the notes list and the ingest order."""
    cleansed.write.mode(mode).parquet(path)


def write_cleansed_csv(cleansed: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """The 17 fields as CSV; a value is quoted where it needs to be, line breaks included.

    Such values keep a file from being split on reading, so files are bounded instead.
    """
    options = {**_CSV_OPTIONS, "maxRecordsPerFile": CSV_FILE_RECORDS}
    cleansed.select(*CLEANSED_FIELDS).write.mode(mode).options(**options).csv(path)


def write_identity_lines(identities: DataFrame, path: str, mode: str = "errorifexists") -> None:
    identity_lines(identities).select("value").write.mode(mode).text(path)


def write_classified_lines(
    classified: DataFrame, path: str, mode: str = "errorifexists"
) -> None:
    """Pipe-delimited lines after one header line, nothing quoted."""
    header = classified.sparkSession.createDataFrame([(CLASSIFIED_HEADER_LINE,)], "value string").coalesce(1)
    header.union(classified_lines(classified).select("value")).write.mode(mode).text(path)


def write_report_lines(lines: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Report lines in order; the part files, by name, make up the text."""
    order = [c for c in ("section", "issue_order", "line") if c in lines.columns]
    lines.orderBy(*order).select("value").write.mode(mode).text(path)


def write_quality_report(
    table: DataFrame, sections: DataFrame, path: str, mode: str = "errorifexists"
) -> None:
    """Report document, text summary, distributions and anomaly details below one path.

    The document is one small row. What grows with the data is written as JSON lines from
    all tasks and never gathered.
    """
    quality_report(sections).coalesce(1).write.mode(mode).json(f"{path}/report")
    write_report_lines(quality_summary(sections), f"{path}/summary", mode)
    counts = stored(value_counts(table), "value-counts")
    for field in DISTRIBUTION_FIELDS:
        name = "type" if field == "entity_type" else field
        ordered_counts(counts, field).withColumnRenamed(field, name).write.mode(mode).json(f"{path}/by_{field}")
    anomalies(table).select("party_id", "type", "severity", "description").write.mode(
        mode
    ).json(f"{path}/anomalies")


