"""Data quality of a cleansed table: profiles, distributions, anomalies, score."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from entigrid.fixed_values import (
    CLEANSED_FIELDS,
    EXTREME_REVENUE_EUR,
    FIELD_BANDS,
    MISSING_MARKERS,
    PROFILED_FIELDS,
    QUALITY_WEIGHTS,
    SCORE_BAND_ELSE,
    SCORE_BANDS,
    SEVERITIES,
    TRUST_BAND_ELSE,
    TRUST_BANDS,
)
from entigrid.functions.sql import number, one_of, present
from entigrid.functions.text import not_blank
from entigrid.schema import POSITION, order_fields
from entigrid.sources.provenance import in_order

TYPED_FIELDS = {
    "annual_revenue_eur": "DOUBLE",
    "lei_valid": "BIGINT",
    "email_valid": "BIGINT",
    "country_valid": "BIGINT",
}
SKETCH_BITS = 14  # 2^14 registers, 16 KiB a field and part
DISTRIBUTION_FIELDS = ["country", "entity_type", "status"]


def typed(cleansed: DataFrame) -> DataFrame:
    """The cleansed table with missing markers as null, revenue and flags as numbers."""

    def value(name: str) -> Column:
        as_text = f"CAST({name} AS STRING)"
        known = f"if({one_of(as_text, MISSING_MARKERS)}, NULL, {as_text})"
        if name in TYPED_FIELDS:
            kind = TYPED_FIELDS[name]
            known = number(known) if kind == "DOUBLE" else f"TRY_CAST({known} AS {kind})"
        return F.expr(f"{known} AS {name}")

    return cleansed.select(*(value(f) for f in CLEANSED_FIELDS), *order_fields(cleansed))


# Profiles and distributions ---------------------------------------------------


def field_profile(table: DataFrame, fields: list[str] = PROFILED_FIELDS) -> DataFrame:
    """Completeness and uniqueness per field, exact.

    The fields are stacked and counted per (field, value) before anything is shuffled, so a
    value held by a third of the rows arrives as one row per task. Distinct values then are
    the rows of that count, combined again per field.
    """
    as_text = [F.col(f).cast("string").alias(f) for f in fields]
    values = (
        table.select(*as_text)
        .unpivot([], fields, "field_name", "value")
        .groupBy("field_name", "value")
        .agg(F.count("*").alias("n"))
    )
    present = F.sum(F.when(F.col("value").isNotNull(), F.col("n")).otherwise(0))
    counts = values.groupBy("field_name").agg(
        F.sum("n").alias("total"),
        present.alias("present"),
        F.count("value").alias("unique_values"),
    )
    return _profile(counts)


def profile_sketches(table: DataFrame, fields: list[str] = PROFILED_FIELDS) -> DataFrame:
    """What a batch adds to the profile of many: (field_name, part, total, present, sketch).

    A few rows of fixed size, whatever the batch. Values are sketched in two parts by hash, so
    that a merged profile always comes from several sketches and is estimated in one way.
    """
    as_text = [F.col(f).cast("string").alias(f) for f in fields]
    values = table.select(*as_text).unpivot([], fields, "field_name", "value")
    part = F.pmod(F.xxhash64("value"), F.lit(2)).alias("part")
    return values.groupBy("field_name", part).agg(
        F.count("*").alias("total"), F.count("value").alias("present"), F.hll_sketch_agg("value", SKETCH_BITS).alias("sketch")
    )


def merged_profile(sketches: DataFrame) -> DataFrame:
    """The profile of all batches whose sketches these are. Counts are exact; numbers of distinct
    values are estimates with a standard error of 0.8 %."""
    counts = sketches.groupBy("field_name").agg(
        F.sum("total").alias("total"), F.sum("present").alias("present"), F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("estimate")
    )
    return _profile(counts.withColumn("unique_values", F.least("estimate", "present")))


def _profile(counts: DataFrame) -> DataFrame:
    return counts.select(
        "field_name",
        "total",
        "present",
        (F.col("total") - F.col("present")).alias("missing"),
        (F.col("present") / F.col("total") * 100).alias("completeness_pct"),
        "unique_values",
        F.coalesce(
            F.try_divide(F.col("unique_values"), F.col("present")) * 100, F.lit(0.0)
        ).alias("uniqueness_pct"),
    )


def value_counts(table: DataFrame, fields: list[str] = DISTRIBUTION_FIELDS) -> DataFrame:
    """(field_name, value, count, first) of all values of the fields, from one pass over the table.

    Every field is a grouping set of its own, and the position is a number, so rows are combined
    by a hash aggregation before anything is shuffled.
    """
    rows = in_order(table).select(*fields, POSITION)
    counts = rows.groupingSets([[F.col(f)] for f in fields], *fields).agg(
        F.grouping_id().alias("left_out"), F.count("*").alias("count"), F.min(POSITION).alias("first")
    )
    # of the bits of left_out, the first field's is the highest; only the set's own field is 0 there
    own = {f: (1 << len(fields)) - 1 - (1 << (len(fields) - 1 - i)) for i, f in enumerate(fields)}
    named = reduce(lambda c, f: c.when(F.col("left_out") == own[f], F.struct(F.lit(f).alias("name"), F.col(f).alias("value"))), fields, F)
    return counts.select(named.alias("f"), "count", "first").select(
        F.col("f.name").alias("field_name"), F.col("f.value").alias("value"), "count", "first"
    ).filter("value IS NOT NULL")


def ordered_counts(counts: DataFrame, field: str) -> DataFrame:
    """One field's part of the value counts, most frequent first, ties in order of first appearance."""
    own = counts.filter(F.col("field_name") == field).select(F.col("value").alias(field), "count", "first")
    return own.orderBy(F.desc("count"), "first").select(field, "count")


def distribution(table: DataFrame, field: str) -> DataFrame:
    """Rows per value, most frequent first, ties in order of first appearance."""
    return ordered_counts(value_counts(table, [field]), field)


def distribution_sizes(table: DataFrame) -> DataFrame:
    """One row: how many countries, entity types and statuses occur."""
    values = (
        table.select(*DISTRIBUTION_FIELDS)
        .unpivot([], DISTRIBUTION_FIELDS, "field_name", "value")
        .filter(F.col("value").isNotNull())
        .groupBy("field_name", "value")
        .agg(F.count("*").alias("n"))
    )
    return values.agg(
        *(
            F.count_if(F.col("field_name") == field).alias(name)
            for field, name in zip(DISTRIBUTION_FIELDS, ["countries", "entity_types", "statuses"])
        )
    )


# Anomalies --------------------------------------------------------------------


def anomaly_kinds() -> list[tuple[str, str, str, str]]:
    """(type, severity, condition, description) in reporting order, over a typed table."""
    invalid = "coalesce(lei_valid = 0, false)"
    no_lei = "(lei IS NULL OR lei = 'MISSING')"
    notes = "coalesce(cleansing_notes, '')"

    def blank(name: str) -> str:
        return f"({name} IS NULL OR NOT {not_blank(name)})"

    return [
        ("MISSING_NAME", "HIGH", blank("legal_name"), "'Party has no legal name'"),
        ("MISSING_COUNTRY", "HIGH", blank("country"), "'Party has no country code'"),
        ("INVALID_LEI", "HIGH", f"{invalid} AND NOT {no_lei}",
         "concat('LEI present but invalid: ', lei)"),
        ("MISSING_LEI", "MEDIUM", f"{invalid} AND {no_lei}", "'No LEI provided'"),
        ("ZERO_REVENUE", "MEDIUM", "annual_revenue_eur = 0", "'Entity reports zero revenue'"),
        ("EXTREME_REVENUE", "LOW", f"annual_revenue_eur > {EXTREME_REVENUE_EUR}",
         "'Revenue exceeds €100B — verify'"),
        ("DUPLICATE_RECORD", "HIGH", f"contains({notes}, 'DUPLICATE')",
         "concat('Potential duplicate: ', cleansing_notes)"),
        ("HIGH_RISK_FLAG", "CRITICAL", f"contains({notes}, 'HIGH_RISK')",
         "concat('High risk flag: ', cleansing_notes)"),
    ]


def anomalies(table: DataFrame) -> DataFrame:
    """One row per anomaly; ``position`` orders the anomalies of a party."""
    found = present(
        (
            f"named_struct('position', {position}, 'type', '{kind}', 'severity', '{severity}',"
            f" 'description', {description})",
            condition,
        )
        for position, (kind, severity, condition, description) in enumerate(anomaly_kinds())
    )
    return table.select(F.expr("coalesce(id, 'UNKNOWN') AS party_id"), *order_fields(table), F.inline(found))


def severity_totals() -> dict[str, Column]:
    """Aggregates that count the anomalies of each severity without listing them."""
    totals = {}
    for severity in SEVERITIES:
        hits = [f"if({c}, 1, 0)" for _, kind_severity, c, _ in anomaly_kinds() if kind_severity == severity]
        totals[severity] = F.expr(f"CAST(coalesce(sum({' + '.join(hits)}), 0) AS BIGINT)")
    return totals


def severity_counts(table: DataFrame) -> DataFrame:
    """One row: anomalies per severity, zeros kept, and their total."""
    counts = table.agg(*(c.alias(s.lower()) for s, c in severity_totals().items()))
    total = reduce(lambda a, b: a + b, (F.col(s.lower()) for s in SEVERITIES))
    return counts.withColumn("total", total)


# Score ------------------------------------------------------------------------


def quality_totals(table: DataFrame) -> DataFrame:
    """One row with everything the score needs, from a single pass without any join."""
    return table.agg(
        F.count("*").alias("n"),
        *(F.count(f).alias(f"present_{f}") for f in PROFILED_FIELDS),
        F.count_if(F.col("lei_valid") == 1).alias("leis_valid"),
        F.count_if(F.col("country_valid") == 1).alias("countries_valid"),
        *(c.alias(s.lower()) for s, c in severity_totals().items()),
    )


def score_columns() -> tuple[Column, Column]:
    """Unrounded score and anomaly total over a row of ``quality_totals``.

    The score of an empty table is null.
    """
    n = F.col("n")
    weights = QUALITY_WEIGHTS
    pct = [F.try_divide(F.col(f"present_{f}"), n) * 100 for f in PROFILED_FIELDS]
    completeness = reduce(lambda a, b: a + b, pct) / len(pct) * weights["completeness"]
    valid = F.col("leis_valid") + F.col("countries_valid")
    validity = F.try_divide(valid, n * 2) * 100 * weights["validity"]
    total = reduce(lambda a, b: a + b, (F.col(s.lower()) for s in SEVERITIES))
    rate = F.try_divide(total, F.greatest(n, F.lit(1)))
    clean = F.greatest(F.lit(0.0), 1 - rate) * weights["anomaly"]
    score = completeness + validity + clean
    return F.when(score.isNotNull(), F.least(score, F.lit(100.0))), total


def quality_score(table: DataFrame) -> DataFrame:
    """One row: records, score to one decimal, anomaly counts, band."""
    score, total = score_columns()
    scored = quality_totals(table).select(
        F.col("n").alias("total_records"),
        F.bround(score, 1).alias("quality_score"),
        total.alias("anomalies"),
        *(s.lower() for s in SEVERITIES),
    )
    return scored.withColumn("band", score_band(F.col("quality_score")))


# Bands ------------------------------------------------------------------------


def _band(value: Column, floors, otherwise: str) -> Column:
    branches = F
    for floor, label in floors:
        branches = branches.when(value >= floor, label)
    return branches.otherwise(otherwise)


def score_band(score: Column) -> Column:
    return _band(score, SCORE_BANDS, SCORE_BAND_ELSE)


def field_band(completeness_pct: Column) -> Column:
    return _band(completeness_pct, FIELD_BANDS, SCORE_BAND_ELSE)


def trust_band(trust: Column) -> Column:
    """high, medium or low; an absent trust counts as 0."""
    return _band(F.coalesce(trust, F.lit(0.0)), TRUST_BANDS, TRUST_BAND_ELSE)


def shown_risk_class(risk_class: Column) -> Column:
    return F.when(F.coalesce(risk_class, F.lit("")) == "", "UNKNOWN").otherwise(risk_class)
