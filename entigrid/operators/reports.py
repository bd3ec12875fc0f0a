"""Ingestion statistics and the report documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from entigrid.fixed_values import PROFILED_FIELDS, SEVERITIES
from entigrid.functions.keys import key_digest, key_text
from entigrid.functions.text import normalize_name, not_blank, text
from entigrid.functions.validate import flag
from entigrid.operators.cleanse import has_content
from entigrid.operators.quality import (
    DISTRIBUTION_FIELDS,
    field_band,
    field_profile,
    quality_score,
)
from entigrid.schema import ingest_order

TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"


# Ingestion --------------------------------------------------------------------


def ingestion_stats(raw: DataFrame, files_processed: int) -> DataFrame:
    """One row of counts over the raw records, and the share that is valid.

    Duplicates are the valid records beyond the first of each key, so counting distinct
    keys is enough: no record is matched with another. Counts are combined per key before
    the shuffle. The file count comes from the listing, as an empty file has no record.
    """
    checked = (
        raw.select(
            F.expr(has_content()).alias("kept"),
            text("legal_name"),
            F.expr("upper(coalesce(country, ''))").alias("country"),
            text("lei"),
        )
        .withColumn("clean_name", normalize_name("legal_name"))
        .withColumn("key_text", key_text("clean_name", "country", "lei"))
        .select(
            F.when(F.col("kept"), key_digest("key_text")).alias("full_key"),
            flag(
                f"kept AND clean_name <> legal_name AND {not_blank('legal_name')}"
            ).alias("renamed"),
        )
    )
    per_key = checked.groupBy("full_key").agg(
        F.count("*").alias("records"), F.sum("renamed").alias("renamed")
    )
    valid = F.col("full_key").isNotNull()
    counts = per_key.agg(
        F.coalesce(F.sum("records"), F.lit(0)).alias("total"),
        F.coalesce(F.sum(F.when(valid, F.col("records"))), F.lit(0)).alias("valid"),
        F.coalesce(F.sum("renamed"), F.lit(0)).alias("cleansed"),
        F.coalesce(F.sum(F.when(~valid, F.col("records"))), F.lit(0)).alias("rejected"),
        F.coalesce(F.sum(F.when(valid, F.col("records") - 1)), F.lit(0)).alias("duplicates"),
    )
    return _with_share(counts, files_processed)


def record_counts() -> list[Column]:
    """Counts to observe while normalized records are written. A task that is retried counts once,
    as long as they are observed in the job's last stage."""
    return [
        F.count("*").alias("total"),
        F.count_if(~F.col("rejected")).alias("valid"),
        F.count_if(F.col("name_changed") & ~F.col("rejected")).alias("cleansed"),
        F.count_if("rejected").alias("rejected"),
    ]


def duplicate_counts() -> list[Column]:
    return [F.count("duplicate_of").alias("duplicates")]


def observed_ingestion_stats(spark: SparkSession, counts: dict[str, int], files_processed: int) -> DataFrame:
    """The row of ``ingestion_stats`` from observed counts."""
    names = ["total", "valid", "cleansed", "rejected", "duplicates"]
    row = spark.range(1).select(*(F.lit(counts[name]).cast("long").alias(name) for name in names))
    return _with_share(row, files_processed)


def _with_share(counts: DataFrame, files_processed: int) -> DataFrame:
    share = F.col("valid") / F.greatest("total", F.lit(1)) * 100
    return counts.select(
        F.lit(files_processed).cast("long").alias("files"),
        "*",
        share.alias("valid_pct"),
        F.format_string("%.1f%%", share).alias("score"),
    )


def _lines(rows: DataFrame, section: int, *values: Column) -> DataFrame:
    """The values as report lines of one section."""
    return rows.select(
        F.lit(section).alias("section"), F.posexplode(F.array(*values)).alias("line", "value")
    )


def _labelled(label: str, value: Column | str) -> Column:
    return F.concat(F.rpad(F.lit(label), 21, " "), F.col(value) if isinstance(value, str) else value)


def ingestion_report(stats: DataFrame, rejected: DataFrame, generated_at: Column) -> DataFrame:
    """The ingestion report as lines to be written in (section, line) order.

    There may be any number of issues, so each is a row of its own.
    """
    rule = F.lit("=" * 47)
    head = _lines(
        stats,
        0,
        rule,
        F.lit("  Party Ingestion Report"),
        F.concat(F.lit("  Generated: "), generated_at),
        rule,
        F.lit(""),
        _labelled("Files Processed:", "files"),
        _labelled("Total Records:", "total"),
        _labelled("Valid Records:", "valid"),
        _labelled("Cleansed Records:", "cleansed"),
        _labelled("Rejected Records:", "rejected"),
        _labelled("Duplicates Found:", "duplicates"),
        F.lit(""),
        _labelled("Data Quality Score:", "score"),
        F.lit(""),
        F.lit("Issues:"),
    )
    issues = rejected.select(
        F.lit(1).alias("section"),
        ingest_order(rejected).alias("issue_order"),
        F.concat(F.lit("  - "), "issue").alias("value"),
    )
    tail = _lines(stats, 2, F.lit(""), F.lit("--- End of Report ---"))
    return head.unionByName(issues, allowMissingColumns=True).unionByName(
        tail, allowMissingColumns=True
    )


# Quality ----------------------------------------------------------------------


def now_text() -> Column:
    return F.date_format(F.current_timestamp(), TIME_FORMAT)


def quality_sections(table: DataFrame) -> DataFrame:
    """One row holding the score as a struct and the profiles as a map by field.

    Both parts are one row; they are stacked and folded together, so none is joined.
    """
    profile = F.struct(
        "field_name",
        F.struct(
            "present",
            "missing",
            F.bround("completeness_pct", 1).alias("completeness_pct"),
            "unique_values",
            F.bround("uniqueness_pct", 1).alias("uniqueness_pct"),
        ),
    )
    scored = quality_score(table)
    score = scored.select(F.struct(*scored.columns).alias("score"))
    completeness = field_profile(table).agg(
        F.map_from_entries(F.collect_list(profile)).alias("completeness")
    )
    stacked = score.unionByName(completeness, allowMissingColumns=True)
    return stacked.agg(
        *(F.first(c, ignorenulls=True).alias(c) for c in ("score", "completeness"))
    )


def _occurring(field: str) -> Column:
    """How many values of a distributed field occur."""
    return F.element_at("completeness", field)["unique_values"]


def quality_report(sections: DataFrame, generated_at: Column | None = None) -> DataFrame:
    """The report document as one row. Distributions and anomaly details, which grow with
    the data, are tables of their own beside it."""
    severities = F.create_map(
        *(c for s in SEVERITIES for c in (F.lit(s), F.col(f"score.{s.lower()}")))
    )
    return sections.select(
        (now_text() if generated_at is None else generated_at).alias("generated_at"),
        F.col("score.total_records").alias("total_records"),
        F.col("score.quality_score").alias("quality_score"),
        "completeness",
        F.struct(
            F.col("score.anomalies").alias("total"), severities.alias("by_severity")
        ).alias("anomalies"),
    )


def quality_summary(sections: DataFrame, generated_at: Column | None = None) -> DataFrame:
    """The text summary as lines to be written in (section, line) order."""

    def field_line(field: str) -> Column:
        p = F.element_at("completeness", field)
        total = p["present"] + p["missing"]
        return F.concat(
            F.rpad(field_band(p["completeness_pct"]), 6, " "),
            F.format_string(
                "%-25s %5.1f%%  (%d/%d)", F.lit(field), p["completeness_pct"], p["present"], total
            ),
        )

    when = now_text() if generated_at is None else generated_at
    return _lines(
        sections,
        0,
        F.lit("Party Data Quality Report"),
        F.concat(F.lit("Generated: "), when),
        F.concat(F.lit("Records Analyzed: "), F.col("score.total_records").cast("string")),
        F.format_string(
            "Overall quality score: %.1f / 100.0 %s", "score.quality_score", "score.band"
        ),
        F.lit("Completeness:"),
        *(field_line(f) for f in PROFILED_FIELDS),
        F.lit("Anomalies:"),
        *(
            F.format_string("%-10s%d", F.lit(f"{s}:"), F.col(f"score.{s.lower()}"))
            for s in SEVERITIES
        ),
        F.format_string("%-10s%d", F.lit("TOTAL:"), "score.anomalies"),
        F.format_string(
            "Countries: %d  |  Entity Types: %d  |  Statuses: %d",
            *(_occurring(f) for f in DISTRIBUTION_FIELDS),
        ),
    )

