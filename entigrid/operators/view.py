"""The merged party view and the lookups on it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from entigrid.fixed_values import VIEW_FIELDS
from entigrid.operators.classify import classify
from entigrid.operators.identity import has_identity, identity_columns
from entigrid.schema import POSITION, VIEW_SCHEMA
from entigrid.sources.provenance import in_order

BASE_FIELDS = ["id", "legal_name", "country", "lei", "entity_type", "status"]


def latest_per_id(table: DataFrame, fields: list[str], key: str = "id") -> DataFrame:
    """Per id the row that comes last in ingest order. Ids are never null.

    The last position per id is a number, so it is found by a hash aggregation that combines
    rows before the shuffle. The row at it is then fetched by a join on the id alone, which uses
    the aggregation's partitioning, and whose hot ids adaptive execution may split. The table is
    read twice, so it should be a stored one.
    """
    rest = [f for f in fields if f != key]
    rows = in_order(table).select(key, *rest, POSITION)
    last = rows.groupBy(F.col(key).alias("last_key")).agg(F.max(POSITION).alias("last_pos"))
    at_last = (F.col(key) == F.col("last_key")) & (F.col(POSITION) >= F.col("last_pos"))
    # one row matches; a semi-join would be pushed below a union, and repeated for each of its parts
    return rows.join(last, at_last).select(key, *rest)


def _defaults(name: str) -> Column:
    kind = VIEW_SCHEMA[name].dataType.simpleString()
    empty = "''" if kind == "string" else "0"
    return F.expr(f"CAST(coalesce({name}, {empty}) AS {kind}) AS {name}")


def merged_view(cleansed: DataFrame, identity: DataFrame, classified: DataFrame) -> DataFrame:
    """Parties with their latest identity and classification; gaps become '' or 0.

    Each side is reduced to one row per id by the same hash partitioning that the joins
    need, so the joins add no shuffle of their own. Ids without a party are left out.
    """
    base = latest_per_id(cleansed, BASE_FIELDS)
    prints = latest_per_id(identity, ["id", "fingerprint", "trust"])
    classes = latest_per_id(classified, ["id", "kyc_level", "risk_score", "risk_class"])
    joined = base.join(prints, "id", "left").join(classes, "id", "left")
    return joined.select(*(_defaults(f) for f in VIEW_FIELDS))


def party_view(
    cleansed: DataFrame, algorithm: str = "sha256", lei_flag: str = "lei_format_valid"
) -> DataFrame:
    """The merged view straight from a cleansed table.

    Identity and classification derive from the same row, so instead of joining three
    tables each id keeps its last row and, where that one has no identity, its last row that
    has. All joins use the partitioning by id.
    """
    fields = [*BASE_FIELDS[1:], "lei_valid"]
    rows = in_order(cleansed).select("id", *fields, POSITION)
    known = F.when(F.expr(has_identity()), F.col(POSITION))
    lasts = rows.groupBy(F.col("id").alias("last_id")).agg(F.max(POSITION).alias("last_pos"), F.max(known).alias("known_pos"))
    own = F.col("id") == F.col("last_id")
    base = rows.join(lasts, own & (F.col(POSITION) >= F.col("last_pos")))
    # written as a difference, this is no second key that rows would have to be dealt out by
    earlier = rows.join(lasts.filter("known_pos < last_pos"), own & (F.col(POSITION) - F.col("known_pos") == 0))
    earlier = earlier.select(F.col("id").alias("other_id"), F.struct(*fields).alias("other"))
    identified = F.when(F.col("known_pos") == F.col("last_pos"), F.struct(*fields)).otherwise(F.col("other")).alias("identified")
    latest = base.join(earlier, F.col("id") == F.col("other_id"), "left").select("id", F.struct(*fields).alias("base"), identified)
    derived = classify(identity_columns(latest.select("id", "base", "identified", "identified.*"), algorithm), lei_flag)
    derived_fields = ["fingerprint", "kyc_level", "risk_score", "risk_class", "trust"]
    masked = derived.select(
        "id",
        *(f"base.{f}" for f in BASE_FIELDS[1:]),
        *(F.expr(f"if(identified IS NOT NULL, {f}, NULL) AS {f}") for f in derived_fields),
    )
    return masked.select(*(_defaults(f) for f in VIEW_FIELDS))


def party_listing(view: DataFrame) -> DataFrame:
    return view.select(*VIEW_FIELDS)


def party_lookup(view: DataFrame, party_id: str) -> DataFrame:
    """The party of that id, as no or one row."""
    if not party_id:
        raise ValueError("missing id")
    return party_listing(view).filter(F.col("id") == party_id)


def name_search(view: DataFrame, name: str) -> DataFrame:
    """Parties whose name contains the text, whatever its case."""
    if not name:
        raise ValueError("missing name query")
    return party_listing(view).filter(F.lower("legal_name").contains(F.lower(F.lit(name))))


def explore(view: DataFrame, name: str) -> DataFrame:
    """Name search for a typed-in text: trimmed, and everything when nothing was typed."""
    wanted = name.strip()
    return name_search(view, wanted) if wanted else party_listing(view)
