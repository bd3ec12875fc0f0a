"""Strict checks made at ingest and the looser format checks made for identities."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from entigrid.fixed_values import (
    COUNTRY_FORMAT_PATTERN,
    EMAIL_PATTERN,
    ENTITY_TYPES,
    KNOWN_COUNTRIES,
    LEI_FORMAT_PATTERN,
    LEI_PATTERN,
)
from entigrid.functions.sql import looked_up, one_of, quoted
from entigrid.functions.text import not_blank


def flag(condition: str) -> Column:
    """A condition as 0/1."""
    return F.expr(f"CAST({condition} AS BIGINT)")


def lei_digits(lei: str) -> Column:
    """The LEI with A=10 .. Z=35, padded to 40 digits; meaningless for a malformed LEI."""
    digits = lei
    for number, letter in enumerate("ABCDEFGHIJKLMNOPQRSTUVWXYZ", start=10):
        digits = f"replace({digits}, '{letter}', '{number}')"
    return F.expr(f"lpad({digits}, 40, '0')")


def lei_status(lei: str, digits: str) -> Column:
    """MISSING, INVALID_FORMAT, CHECKSUM_FAIL or OK; no trimming, case matters.

    ``digits`` is the column made by ``lei_digits``. Its remainder by 97 must be 1; it is
    taken in three parts that fit into 64 bits each. The parts are only looked at when the
    format is right, so the casts cannot fail.
    """
    high, middle, low = (
        f"CAST(substring({digits}, {start}, {length}) AS BIGINT)"
        for start, length in ((1, 4), (5, 18), (23, 18))
    )
    total = f"{high} * {pow(10, 36, 97)} + {middle} % 97 * {pow(10, 18, 97)} + {low}"
    return F.expr(f"""
        CASE WHEN NOT {not_blank(lei)} THEN 'MISSING'
             WHEN NOT {lei} RLIKE {quoted(LEI_PATTERN)} THEN 'INVALID_FORMAT'
             WHEN ({total}) % 97 <> 1 THEN 'CHECKSUM_FAIL'
             ELSE 'OK' END
    """)


def lei_format_valid(lei: str) -> str:
    return f"{lei} RLIKE {quoted(LEI_FORMAT_PATTERN)}"


def country_known(country: str) -> str:
    return one_of(country, KNOWN_COUNTRIES)


def country_format_valid(country: str) -> str:
    return f"{country} RLIKE {quoted(COUNTRY_FORMAT_PATTERN)}"


def email_valid(email: str) -> str:
    return f"{email} RLIKE {quoted(EMAIL_PATTERN)}"


def entity_type(column: str) -> Column:
    """The known type for an upper-cased alias, any other value as written."""
    return F.expr(looked_up(f"upper({column})", ENTITY_TYPES, column))
