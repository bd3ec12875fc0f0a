"""Classification by fixed rules: KYC level, obligations, risk, review flags.

Works on named columns: ``legal_name, country, entity_type, status, trust`` and two flag
columns saying whether LEI and country count as valid. Every rule is a column expression
that stays in generated code, so a table is classified in the pass that reads it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from entigrid.fixed_values import (
    CRS_EXEMPT,
    EU_MEMBERS,
    HIGH_RISK_CLASSES,
    KYC_CSD,
    KYC_DEFAULT,
    KYC_EU_BANK,
    KYC_OFFSHORE,
    KYC_OFFSHORE_PARTY,
    KYC_SHELL,
    RISK_CLASS_ELSE,
    RISK_CLASSES,
    RISK_COUNTRY,
    RISK_NO_LEI,
    RISK_SHELL,
    RISK_SUSPENDED,
    RISK_TRUST_FLOOR,
)
from entigrid.functions.sql import looked_up, one_of, present, quoted
from entigrid.operators.cleanse import labels

CLASSIFIED_FIELDS = [
    "party_id", "legal_name", "country", "fingerprint", "kyc_level", "kyc_reason",
    "risk_score", "risk_class", "risk_factors", "obligations", "sanctions_flags",
]
SHOWN_FINGERPRINT = 16


def is_true(flag: str) -> str:
    """Condition on a flag given as boolean, 0/1 or text; absent means false."""
    return f"coalesce(CAST({flag} AS STRING) IN ('1', 'true'), false)"


def kyc(country_flag: str) -> Column:
    """Level and reason as one struct, so both come from the same branch."""

    def outcome(pair: tuple[str, str]) -> str:
        return f"named_struct('level', {quoted(pair[0])}, 'reason', {quoted(pair[1])})"

    eu_bank = (
        f"entity_type = 'CREDIT_INSTITUTION' AND {is_true(country_flag)}"
        f" AND {one_of('country', EU_MEMBERS)}"
    )
    return F.expr(f"""
        CASE WHEN entity_type = 'CSD' THEN {outcome(KYC_CSD)}
             WHEN {eu_bank} THEN {outcome(KYC_EU_BANK)}
             WHEN {one_of('country', KYC_OFFSHORE)} THEN {outcome(KYC_OFFSHORE_PARTY)}
             WHEN entity_type = 'SHELL_COMPANY' THEN {outcome(KYC_SHELL)}
             ELSE {outcome(KYC_DEFAULT)} END
    """)


def obligations(lei_flag: str) -> Column:
    return present(labels([
        ("EMIR_TR_REPORTING", one_of("entity_type", ["CREDIT_INSTITUTION", "INVESTMENT_FIRM"])),
        ("SFTR_REPORTING", "entity_type = 'CSD'"),
        ("CSDR_SETTLEMENT_DISCIPLINE", "entity_type = 'CSD'"),
        ("LEI_REQUIRED_MISSING", f"NOT {is_true(lei_flag)}"),
        ("CRS_REPORTING", f"NOT {one_of('country', CRS_EXEMPT)}"),
    ]))


def risk_points(lei_flag: str) -> list[tuple[str, str]]:
    """Factor names with their points, null where a factor does not apply."""
    floor = RISK_TRUST_FLOOR
    return [
        ("NO_VALID_LEI", f"if({is_true(lei_flag)}, NULL, {RISK_NO_LEI})"),
        ("HIGH_RISK_COUNTRY", looked_up("country", RISK_COUNTRY, "NULL")),
        ("SHELL_COMPANY", f"if(entity_type = 'SHELL_COMPANY', {RISK_SHELL}, NULL)"),
        ("SUSPENDED_ENTITY", f"if(status = 'SUSPENDED', {RISK_SUSPENDED}, NULL)"),
        (
            "LOW_TRUST_SCORE",
            f"if(coalesce(trust, 0) < {floor}, CAST(floor(({floor} - coalesce(trust, 0)) / 2) AS INT), NULL)",
        ),
    ]


def risk_score(lei_flag: str) -> Column:
    """Sum of the points. A missing trust counts as 0; NaN, for text that is no number, costs nothing."""
    return F.expr(" + ".join(f"coalesce({points}, 0)" for _, points in risk_points(lei_flag)))


def risk_factors(lei_flag: str) -> Column:
    return present(
        (f"concat('{name}(+', {points}, ')')", f"({points}) IS NOT NULL")
        for name, points in risk_points(lei_flag)
    )


def risk_class(score: str) -> Column:
    cases = " ".join(f"WHEN {score} >= {floor} THEN '{label}'" for floor, label in RISK_CLASSES)
    return F.expr(f"CASE {cases} ELSE '{RISK_CLASS_ELSE}' END")


def sanctions_flags() -> Column:
    return present(labels([
        ("REVIEW:SUSPENDED_STATUS", "status = 'SUSPENDED'"),
        ("REVIEW:NAME_CONTAINS_OFFSHORE", "legal_name RLIKE '[Oo]ffshore'"),
        ("ALERT:SUSPENDED_EXCHANGE", "status = 'SUSPENDED' AND entity_type = 'EXCHANGE'"),
    ]))


def classify(
    parties: DataFrame,
    lei_flag: str = "lei_format_valid",
    country_flag: str = "country_format_valid",
) -> DataFrame:
    """Add the classification columns to a table of identities.

    ``lei_flag="lei_valid"`` applies the strict ingest check, checksum included, instead of
    the format check.
    """
    known = parties.withColumns({
        "status": F.expr("coalesce(status, 'ACTIVE')"),
        "kyc": kyc(country_flag),
        "risk_score": risk_score(lei_flag),
        "risk_factors": risk_factors(lei_flag),
        "obligations": obligations(lei_flag),
        "sanctions_flags": sanctions_flags(),
    })
    return known.withColumns({
        "kyc_level": F.col("kyc.level"),
        "kyc_reason": F.col("kyc.reason"),
        "risk_class": risk_class("risk_score"),
    }).drop("kyc")


def shown_fingerprint() -> Column:
    return F.expr(f"concat(substring(fingerprint, 1, {SHOWN_FINGERPRINT}), '...')")


def high_risk(classified: DataFrame) -> DataFrame:
    """The HIGH and CRITICAL parties. On a stored table the filter reaches the scan."""
    return classified.filter(F.col("risk_class").isin(HIGH_RISK_CLASSES))


def classification_counts(classified: DataFrame) -> DataFrame:
    """One row: parties classified and how many of them are HIGH or CRITICAL."""
    return classified.agg(
        F.count("*").alias("processed"),
        F.count_if(F.col("risk_class").isin(HIGH_RISK_CLASSES)).alias("high_risk"),
    )


def class_counts(classified: DataFrame) -> DataFrame:
    return classified.groupBy("risk_class", "kyc_level").agg(F.count("*").alias("parties"))


def obligation_counts(classified: DataFrame) -> DataFrame:
    return (
        classified.select(F.explode("obligations").alias("obligation"))
        .groupBy("obligation")
        .agg(F.count("*").alias("parties"))
    )
