"""Small pieces of SQL text for expressions over named columns.

Long rule expressions are written as SQL and parsed in one go; building them operator by
operator from Python would cost a call into the JVM for every node, on every query.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, functions as F


def quoted(text: str) -> str:
    """A string literal."""
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def one_of(column: str, values: Iterable[str]) -> str:
    return f"{column} IN ({', '.join(map(quoted, values))})"


def looked_up(key: str, table: Mapping[str, object], otherwise: str) -> str:
    """The value a key has in a small fixed table, else another expression."""
    cases = " ".join(
        f"WHEN {quoted(k)} THEN {quoted(v) if isinstance(v, str) else v}" for k, v in table.items()
    )
    return f"CASE {key} {cases} ELSE {otherwise} END"


def replaced(column: str, rules: Iterable[tuple[str, str]], flags: str = "") -> str:
    """Pattern replacements applied one after the other."""
    for pattern, replacement in rules:
        column = f"regexp_replace({column}, {quoted(flags + pattern)}, {quoted(replacement)})"
    return column


def number(column: str) -> str:
    """A text as DOUBLE; null unless it is a decimal number, so not for 5d, 1f, NaN or Infinity."""
    pattern = quoted(r"^\s*[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?\s*$")
    return f"if({column} RLIKE {pattern}, TRY_CAST({column} AS DOUBLE), NULL)"


def present(pairs: Iterable[tuple[str, str]]) -> Column:
    """Ordered list of the values whose condition holds; both are SQL expressions.

    One-element and empty arrays are concatenated; unlike a lambda filter over an array
    this keeps the surrounding projection in generated code.
    """
    parts = (f"CASE WHEN {condition} THEN array({value}) ELSE array() END" for value, condition in pairs)
    return F.expr(f"concat({', '.join(parts)})")


def joined(column: str, empty: str) -> Column:
    """The list as ``;``-separated text, or ``empty`` when nothing is in it."""
    return F.expr(f"CASE WHEN size({column}) > 0 THEN array_join({column}, ';') ELSE {quoted(empty)} END")
