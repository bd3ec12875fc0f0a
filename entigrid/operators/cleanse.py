"""Reject empty records, cleanse and validate the rest. Every step here is narrow."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from entigrid.fixed_values import CLEANSED_FIELDS, INGEST_OFFSHORE, RAW_FIELDS
from entigrid.functions import keys, validate
from entigrid.functions.sql import joined, one_of, present, quoted
from entigrid.functions.text import normalize_address, normalize_name, not_blank, text
from entigrid.schema import order_fields


def has_content() -> str:
    """Condition: name, country or LEI is not blank."""
    fields = (f"coalesce({f}, '')" for f in ("legal_name", "country", "lei"))
    return f"({' OR '.join(map(not_blank, fields))})"


def issues(rejected: DataFrame) -> DataFrame:
    """Rejected records with the issue to report."""
    return rejected.select(
        text("id"),
        "source_file",
        *order_fields(rejected),
        F.expr("concat(coalesce(id, ''), ': REJECTED — empty record')").alias("issue"),
    )


def rejects(raw: DataFrame) -> DataFrame:
    """The empty records among the raw ones, with the issue to report."""
    return issues(raw.filter(f"NOT {has_content()}"))


def risk_flag_conditions() -> list[tuple[str, str]]:
    """Ingest risk flags over the normalized columns, as (label, condition)."""
    offshore = one_of("country", INGEST_OFFSHORE)
    return [
        ("HIGH_RISK:shell_company", "entity_type = 'SHELL_COMPANY'"),
        ("HIGH_RISK:suspended_entity", "status = 'SUSPENDED'"),
        ("HIGH_RISK:offshore_no_lei", f"{offshore} AND lei_status <> 'OK'"),
    ]


def labels(pairs: list[tuple[str, str]]) -> list[tuple[str, str]]:
    return [(quoted(label), condition) for label, condition in pairs]


def normalize(raw: DataFrame) -> DataFrame:
    """Accepted records with normalized values, checks and the full duplicate key.

    ``*_changed`` columns tell which values normalization altered. Unused columns of the
    result are pruned by the optimizer, down to the scan.
    """
    return _normalized(raw.filter(has_content()))


def normalize_marking_rejects(raw: DataFrame) -> DataFrame:
    """The same for all records, with a column ``rejected``, so that storing the result
    needs a single pass over the sources."""
    return _normalized(raw.withColumn("rejected", F.expr(f"NOT {has_content()}")), "rejected")


def _normalized(raw: DataFrame, *carried: str) -> DataFrame:
    accepted = raw.select(
        *(text(f) for f in RAW_FIELDS), "source_file", *order_fields(raw), *carried
    )
    # Each step uses its input more than once, so it is a column of its own: the optimizer
    # then computes it once instead of inlining it.
    values = (
        accepted.withColumns({
            "clean_name": normalize_name("legal_name"),
            "clean_address": normalize_address("address"),
            "clean_country": F.upper("country"),
            "clean_type": validate.entity_type("entity_type"),
            "lei_digits": validate.lei_digits("lei"),
        })
        .withColumns({
            "lei_status": validate.lei_status("lei", "lei_digits"),
            "key_text": keys.key_text("clean_name", "clean_country", "lei"),
        })
        .withColumn("full_key", keys.key_digest("key_text"))
    )

    def changed(clean: str, original: str) -> str:
        return f"{clean} <> {original} AND {not_blank(original)}"

    return values.selectExpr(
        "id",
        "clean_name AS legal_name",
        "clean_country AS country",
        "lei",
        "clean_type AS entity_type",
        "incorporation_date",
        "status",
        "clean_address AS address",
        "contact_email",
        "annual_revenue_eur",
        "CAST(lei_status = 'OK' AS BIGINT) AS lei_valid",
        "lei_status",
        f"CAST({validate.email_valid('contact_email')} AS BIGINT) AS email_valid",
        f"CAST({validate.country_known('clean_country')} AS BIGINT) AS country_valid",
        "full_key",
        "source_file",
        *order_fields(raw),
        f"{changed('clean_name', 'legal_name')} AS name_changed",
        f"{changed('clean_address', 'address')} AS address_changed",
        f"{changed('clean_type', 'entity_type')} AS type_changed",
        *carried,
    )


def notes() -> Column:
    """Cleansing notes in their fixed order, over a normalized and duplicate-flagged table."""
    return present([
        ("'name_normalized'", "name_changed"),
        ("'address_normalized'", "address_changed"),
        ("'country_invalid_or_missing'", "country_valid = 0"),
        ("'entity_type_normalized'", "type_changed"),
        ("concat('lei_', lei_status)", "lei_valid = 0"),
        *labels(risk_flag_conditions()),
        ("concat('DUPLICATE:matches_', duplicate_of)", "duplicate_of IS NOT NULL"),
    ])


def with_notes(flagged: DataFrame) -> DataFrame:
    """The cleansed table: 17 fields, the notes as a list, and the ingest order."""
    return (
        flagged.withColumn("notes", notes())
        .withColumns({
            "dedup_key": keys.shown_key("full_key"),
            "cleansing_notes": joined("notes", "clean"),
        })
        .select(*CLEANSED_FIELDS, "notes", "duplicate_of", *order_fields(flagged))
    )
