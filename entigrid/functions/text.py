"""Name and address normalization over named columns.

Patterns carry ``(?iU)``: case-insensitive, with Unicode word boundaries and white space.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from entigrid.fixed_values import (
    ADDRESS_RULES,
    DOTTED_NAME_RULES,
    NAME_RULE_HINT,
    NAME_RULES,
)
from entigrid.functions.sql import quoted, replaced

IGNORING_CASE = "(?iU)"
_TRIM = (r"(?U)^\s+|\s+$", "")
_SINGLE_SPACES = (r"(?U)\s{2,}", " ")


def text(column: str) -> Column:
    """A text column with absent values as the empty string."""
    return F.expr(f"coalesce({column}, '')").alias(column)


def not_blank(column: str) -> str:
    return rf"{column} RLIKE '(?U)\\S'"


def normalize_name(column: str) -> Column:
    """Trim, collapse spaces, unify legal-form suffixes in their fixed order.

    The order is part of the result: ``S.A./N.V.`` becomes ``SA /NV`` because the plain
    ``S.A.`` rule comes first. A blank name trims to the empty string on its own. Names in
    which no rule can match skip the rules, and the dotted rules need a dot.
    """
    spaced = replaced(column, [_TRIM, _SINGLE_SPACES])
    dotted = replaced(spaced, DOTTED_NAME_RULES, IGNORING_CASE)
    ruled = replaced(
        f"CASE WHEN contains({spaced}, '.') THEN {dotted} ELSE {spaced} END",
        NAME_RULES,
        IGNORING_CASE,
    )
    hint = quoted(IGNORING_CASE + NAME_RULE_HINT)
    chosen = f"CASE WHEN {spaced} RLIKE {hint} THEN {ruled} ELSE {spaced} END"
    return F.expr(replaced(chosen, [(r"(?U)\s+$", "")]))


def settled_name(clean_name: str) -> str:
    """A normalized name normalized once more, as far as other characters than spaces go.

    A second pass finds only one thing the first left: ``Limited.`` before a word became
    ``Ltd.`` after the rule for ``Ltd.`` had run.
    """
    return replaced(clean_name, [(r"\bLtd\.\b", "Ltd")], IGNORING_CASE)


def normalize_address(column: str) -> Column:
    """Trim, drop one quote at each end, collapse spaces, spell out street words."""
    plain = replaced(column, [_TRIM, ("^[\"']|[\"']$", ""), _SINGLE_SPACES])
    return F.expr(replaced(plain, ADDRESS_RULES, IGNORING_CASE))
