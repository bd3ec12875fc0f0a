"""Identity records: fingerprint, format checks and trust score. All narrow."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from entigrid.fixed_values import (
    TRUST_COUNTRY_FORMAT,
    TRUST_ENTITY_TYPE,
    TRUST_LEI_FORMAT,
    TRUST_NAME_OVER_2_BYTES,
    TRUST_NAME_OVER_5_BYTES,
    TRUST_STATUS,
)
from entigrid.functions.blake3 import fingerprint_blake3
from entigrid.functions.keys import fingerprint_sha256, identity_text
from entigrid.functions.text import text
from entigrid.functions.validate import country_format_valid, lei_format_valid

IDENTITY_FIELDS = ["id", "legal_name", "country", "lei", "entity_type", "status"]


def trust_score() -> Column:
    """0 to 100 over name, country, lei, entity_type and status; lengths in bytes."""
    parts = [
        ("octet_length(legal_name) > 2", TRUST_NAME_OVER_2_BYTES),
        ("octet_length(legal_name) > 5", TRUST_NAME_OVER_5_BYTES),
        (country_format_valid("country"), TRUST_COUNTRY_FORMAT),
        (lei_format_valid("lei"), TRUST_LEI_FORMAT),
        ("entity_type <> ''", TRUST_ENTITY_TYPE),
        *((f"status = '{status}'", points) for status, points in TRUST_STATUS.items()),
    ]
    total = " + ".join(f"if({condition}, {points}, 0)" for condition, points in parts)
    return F.expr(f"CAST({total} AS DOUBLE)")


def has_identity() -> str:
    """Condition: false for a party with neither name nor country, whatever its LEI."""
    return "(legal_name <> '' OR country <> '')"


def identity_columns(parties: DataFrame, algorithm: str = "sha256") -> DataFrame:
    """Add fingerprint, format checks and trust score to every row."""
    parts = ("legal_name", "country", "lei", "entity_type")
    if algorithm == "sha256":
        fingerprint = fingerprint_sha256(*parts)
    elif algorithm == "blake3":
        fingerprint = fingerprint_blake3(identity_text(*parts))
    else:
        raise ValueError(f"unknown fingerprint algorithm: {algorithm}")
    return parties.withColumns({
        "fingerprint": fingerprint,
        "lei_format_valid": F.expr(lei_format_valid("lei")),
        "country_format_valid": F.expr(country_format_valid("country")),
        "trust": trust_score(),
    })


def identities(cleansed: DataFrame, algorithm: str = "sha256") -> DataFrame:
    """Identity records of a cleansed table; its other columns are carried along."""
    named = cleansed.withColumns({c: text(c) for c in IDENTITY_FIELDS})
    return identity_columns(named.filter(has_identity()), algorithm)
