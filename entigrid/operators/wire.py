"""Pipe-delimited hand-off lines: writing, reading by position, and the lossy re-parse.

``reparse`` reproduces a hand-off that loses data: empty fields close up, so later fields
move left; and only ``key=value`` parts whose key is alphanumeric are kept, so the two
validity flags are lost. It exists for results that must equal those of that hand-off;
``classify`` on named columns is the normal way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from entigrid.fixed_values import CLASSIFIED_HEADER
from entigrid.functions.sql import joined, number
from entigrid.operators.classify import CLASSIFIED_FIELDS, classify, shown_fingerprint
from entigrid.schema import order_fields

MINIMUM_PARTS = 9
IDENTITY_FIELD_COUNT = 10
CLASSIFIED_FIELD_COUNT = 8
CLASSIFIED_HEADER_LINE = "|".join(CLASSIFIED_HEADER)


def identity_line() -> Column:
    def flag(name: str, column: str) -> Column:
        return F.concat(F.lit(f"{name}="), F.col(column).cast("string"))

    return F.concat_ws(
        "|",
        F.lit("IDENTITY"),
        *("id", "legal_name", "country", "fingerprint", "lei", "entity_type"),
        flag("lei_valid", "lei_format_valid"),
        flag("country_valid", "country_format_valid"),
        F.concat(F.lit("trust="), F.format_string("%.0f", F.col("trust"))),
    )


def identity_lines(identities: DataFrame) -> DataFrame:
    return identities.select(identity_line().alias("value"), *order_fields(identities))


def classified_fields(classified: DataFrame) -> DataFrame:
    """The eleven fields of a classified line, lists joined, fingerprint shortened."""
    key = "party_id" if "party_id" in classified.columns else "id"
    return classified.select(
        F.col(key).alias("party_id"),
        "legal_name",
        "country",
        shown_fingerprint().alias("fingerprint"),
        "kyc_level",
        "kyc_reason",
        "risk_score",
        "risk_class",
        joined("risk_factors", "NONE").alias("risk_factors"),
        joined("obligations", "NONE").alias("obligations"),
        joined("sanctions_flags", "CLEAR").alias("sanctions_flags"),
        *order_fields(classified),
    )


def classified_lines(classified: DataFrame) -> DataFrame:
    """Lines without quoting: a ``|`` in a name shifts the fields after it."""
    fields = classified_fields(classified)
    return fields.select(
        F.concat_ws("|", *(F.col(c).cast("string") for c in CLASSIFIED_FIELDS)).alias("value"),
        *order_fields(classified),
    )


def data_lines(lines: DataFrame) -> DataFrame:
    """Drop comments, the classified header and skip marks."""
    return lines.filter(~F.col("value").rlike(r"^(#|PARTY_ID|SKIP)"))


def parse_identity_lines(lines: DataFrame) -> DataFrame:
    """Identity fields by position; lines that are too short or of another kind drop out."""
    split = lines.filter(~F.col("value").startswith("#")).select(
        F.split("value", r"\|").alias("f"), *order_fields(lines)
    )
    given = F.expr(number("substring(f[9], instr(f[9], '=') + 1)"))
    trust = F.when(F.expr("f[9]").contains("="), F.coalesce(given, F.lit(0.0))).otherwise(0.0)
    return split.filter((F.size("f") >= IDENTITY_FIELD_COUNT) & F.expr("f[0] = 'IDENTITY'")).select(
        F.expr("f[1]").alias("id"),
        F.expr("f[4]").alias("fingerprint"),
        trust.alias("trust"),
        *order_fields(lines),
    )


def parse_classified_lines(lines: DataFrame) -> DataFrame:
    """Classification fields by position; a score that is no whole number counts as 0."""
    split = lines.filter(~F.col("value").startswith("#")).select(
        F.split("value", r"\|").alias("f"), *order_fields(lines)
    )
    score = F.when(F.expr(r"f[6] RLIKE '^[+-]?[0-9]+$'"), F.expr("try_cast(f[6] AS int)"))
    header = F.expr("f[0]") == CLASSIFIED_HEADER[0]
    return split.filter((F.size("f") >= CLASSIFIED_FIELD_COUNT) & ~header).select(
        F.expr("f[0]").alias("id"),
        F.expr("f[4]").alias("kyc_level"),
        F.coalesce(score, F.lit(0)).alias("risk_score"),
        F.expr("f[7]").alias("risk_class"),
        *order_fields(lines),
    )


def reparse(lines: DataFrame) -> DataFrame:
    """Parties as the lossy hand-off sees them."""
    closed_up = F.regexp_replace(F.regexp_replace("value", r"^\|+|\|+$", ""), r"\|+", "|")
    parts = data_lines(lines).select(F.split(closed_up, r"\|").alias("p"), *order_fields(lines))
    kept = parts.filter((F.size("p") >= MINIMUM_PARTS) & F.expr("p[0] = 'IDENTITY'"))
    rest = F.array_join(F.slice("p", 8, F.size("p")), "|")
    tail = kept.withColumn("tail", F.concat(F.lit("|"), rest))

    def given(key: str) -> Column:
        """Value of the last key=value part for the key, else null."""
        found = F.regexp_extract("tail", rf".*\|{key}=([^|]+)", 1)
        return F.when(found != "", found)

    return tail.select(
        F.expr("p[1]").alias("party_id"),
        F.expr("p[2]").alias("legal_name"),
        F.coalesce(given("country"), F.expr("p[3]")).alias("country"),
        F.coalesce(given("fingerprint"), F.expr("p[4]")).alias("fingerprint"),
        F.coalesce(given("lei"), F.expr("p[5]")).alias("lei"),
        F.expr("p[6]").alias("entity_type"),
        F.coalesce(given("status"), F.lit("ACTIVE")).alias("status"),
        F.coalesce(given("trust"), F.lit("0")).alias("trust"),
        F.lit(False).alias("lei_format_valid"),
        F.lit(False).alias("country_format_valid"),
        *order_fields(lines),
    ).withColumn("trust", F.expr(number("trust")))


def classify_lines(lines: DataFrame) -> DataFrame:
    """Classification of re-parsed lines. A trust that is no number costs nothing here."""
    return classify(reparse(lines).withColumn("trust", F.expr("coalesce(trust, double('NaN'))")))
