"""Boolean trigram queries: what three-letter runs a text must have to match a pattern.

A query is True (nothing is certain), a trigram, or ("and" | "or", queries). It is over the
lower-cased text, which makes it valid for either case.
"""

from __future__ import annotations

import re._constants as rc
import re._parser as rp

Query = bool | str | tuple

_MOST_STRINGS = 24


def _all(kind: str, parts: list[Query]) -> Query:
    absorbing = kind == "or"
    if absorbing and (not parts or any(p is True for p in parts)):
        return True
    flat: list[Query] = []
    for p in parts:
        for q in p[1] if isinstance(p, tuple) and p[0] == kind else [p]:
            if q is not True and q not in flat:
                flat.append(q)
    return True if not flat else flat[0] if len(flat) == 1 else (kind, flat)


def _of_strings(strings: set[str]) -> Query:
    """Any of the strings: those that ask for all that another one asks for are left out."""
    runs = {frozenset(s[i : i + 3] for i in range(len(s) - 2)): s for s in sorted(strings, reverse=True)}
    least = sorted(s for r, s in runs.items() if not any(other < r for other in runs))
    return _all("or", [_all("and", [s[i : i + 3] for i in range(len(s) - 2)]) for s in least])


def _item(op, arg) -> tuple[set[str] | None, Query]:
    """The exact strings an element stands for (None: too many), and its own query."""
    if op is rc.LITERAL:
        return {chr(arg).lower()}, True
    if op is rc.IN and all(o is rc.LITERAL for o, _ in arg):
        return {chr(a).lower() for _, a in arg}, True
    if op is rc.SUBPATTERN:
        return _sequence(arg[3])
    if op is rc.BRANCH:
        parts = [_sequence(b) for b in arg[1]]
        exact = [s for s, _ in parts]
        if all(s is not None for s in exact) and sum(map(len, exact)) <= _MOST_STRINGS:
            return set().union(*exact), True
        return None, _all("or", [_of_strings(s) if s is not None else q for s, q in parts])
    if op in (rc.MAX_REPEAT, rc.MIN_REPEAT):
        least, most, inner = arg
        exact, query = _sequence(inner)
        if exact is not None and (least, most) == (0, 1):
            return exact | {""}, True
        if exact is not None and least == most and len(exact) == 1:
            return {next(iter(exact)) * least}, True
        if least == 0:
            return None, True
        return None, _of_strings(exact) if exact is not None else query
    return None, True


def _sequence(parsed) -> tuple[set[str] | None, Query]:
    run, parts, whole = {""}, [], True
    for op, arg in parsed:
        exact, query = _item(op, arg)
        if exact is not None and len(run) * len(exact) <= _MOST_STRINGS:
            run = {a + b for a in run for b in exact}
            continue
        parts.append(_of_strings(run))
        whole = False
        run = exact if exact is not None else {""}
        parts.append(query)
    if whole:
        return run, True
    return None, _all("and", [*parts, _of_strings(run)])


def trigram_query(pattern: str) -> Query:
    exact, query = _sequence(rp.parse(pattern))
    return _of_strings(exact) if exact is not None else query


def trigrams(query: Query) -> list[str]:
    if isinstance(query, bool):
        return []
    if isinstance(query, str):
        return [query]
    return sorted({t for part in query[1] for t in trigrams(part)})
