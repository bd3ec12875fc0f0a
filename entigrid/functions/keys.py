"""Duplicate key and SHA-256 fingerprint over named columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from entigrid.functions.text import settled_name

SHOWN_KEY_LENGTH = 16


def key_text(clean_name: str, country: str, lei: str) -> Column:
    """Squeezed lower-case name, country and LEI. The name counts as normalized twice."""
    squeezed = rf"regexp_replace(lower({settled_name(clean_name)}), '(?U)\\s+', '')"
    return F.expr(f"concat_ws('|', {squeezed}, upper({country}), upper({lei}))")


def key_digest(key: str) -> Column:
    """SHA-256 of a key text as 64 hex digits, never null.

    Text is hashed as Latin-1 where it fits, else as UTF-8. CASE is lazy, so the strict
    Latin-1 encoder never sees other text. Being known not to be null, the digest gets no
    null check when it is joined on; pushed down, that would compute it a second time.
    """
    return F.expr(rf"""
        coalesce(
          CASE WHEN octet_length({key}) = length({key}) THEN sha2({key}, 256)
               WHEN {key} RLIKE '\\A[\\x00-\\xFF]*\\z' THEN sha2(encode({key}, 'ISO-8859-1'), 256)
               ELSE sha2({key}, 256) END,
          '')
    """)


def shown_key(full_key: str) -> Column:
    return F.expr(f"substring({full_key}, 1, {SHOWN_KEY_LENGTH})")


def identity_text(name: str, country: str, lei: str, kind: str) -> Column:
    return F.concat_ws("|", name, country, lei, kind)


def fingerprint_sha256(name: str, country: str, lei: str, kind: str) -> Column:
    return F.sha2(identity_text(name, country, lei, kind), 256)
