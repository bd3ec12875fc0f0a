"""Named queries over the party records derived from the customer and supplier tables.

Every query takes a session and the folder of the tables and works on all their rows.
Lists are joined to text and counts are 64-bit, so results compare across engines.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from entigrid.fixed_values import CLEANSED_FIELDS, RAW_FIELDS, SEVERITIES
from entigrid.functions import keys, validate
from entigrid.functions.sql import joined, number, present
from entigrid.functions.text import normalize_address, normalize_name
from entigrid.operators import classify as rules
from entigrid.operators import quality, reports, rule_tables, view, wire
from entigrid.operators.cleanse import (
    has_content,
    labels,
    normalize,
    rejects,
    risk_flag_conditions,
)
from entigrid.operators.duplicates import flag_duplicates
from entigrid.operators.identity import has_identity, identities
from entigrid.operators.name_index import indexed_search, write_name_index
from entigrid.plans.pipeline import classified_parties, cleanse
from entigrid.schema import POSITION
from entigrid.session import scratch_path, tune
from entigrid.sources import sinks
from entigrid.sources.bucketed import read_bucketed, write_bucketed
from entigrid.sources.feed import read_derived_parties
from entigrid.sources.lines import read_classified_lines, read_identity_lines, read_lines
from entigrid.sources.party_files import read_parties
from entigrid.sources.stored import stored
from entigrid.sources.tables import read_cleansed_csv, read_report_headline, read_typed_cleansed
from entigrid.streaming.alerts import route_alerts, start_alerts
from entigrid.streaming.publish import publish, read_stream, stream_records

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
BUCKETS = 16


def query(function: Query) -> Query:
    """Register a query under its name; it runs with the settings its plan counts on."""

    @wraps(function)
    def tuned(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(tune(spark), sf_dir)

    QUERIES[function.__name__] = tuned
    return tuned


# Tables the queries start from ------------------------------------------------

feed = read_derived_parties


def accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feed(spark, sf_dir).filter(has_content())


def normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize(feed(spark, sf_dir))


def cleansed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleanse(feed(spark, sf_dir))


def table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.typed(cleansed(spark, sf_dir))


def stored_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from a stored cleansed table, for queries that pass over it repeatedly."""
    path = scratch_path(spark, "cleansed")
    sinks.write_cleansed(cleansed(spark, sf_dir), path)
    return quality.typed(spark.read.parquet(path))


def unflagged_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The typed table without notes, for what only looks at the profiled fields."""
    absent = {"dedup_key": F.lit(""), "cleansing_notes": F.lit("")}
    return quality.typed(normalized(spark, sf_dir).withColumns(absent))


def identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Identities need no duplicate flags, so nothing is shuffled for them."""
    return identities(normalized(spark, sf_dir))


def classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.classify(identity(spark, sf_dir))


def stored_classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The classification as a batch run stores it. A filter on a rule's outcome then reaches
    the scan, instead of repeating the rules below themselves."""
    path = scratch_path(spark, "classified")
    fields = ["id", "kyc_level", "risk_score", "risk_class", "obligations"]
    classified(spark, sf_dir).select(*fields).write.parquet(path)
    return spark.read.parquet(path)


def versions(parties: DataFrame) -> DataFrame:
    """Records that repeat another party's key become later versions of that party."""
    own = F.substring("id", 2, 20).cast("long")
    number = F.lpad(F.when(own % 10 == 8, own - 7).otherwise(own).cast("string"), 9, "0")
    return parties.withColumn("id", F.concat(F.substring("id", 1, 1), number))


def stored_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the view needs of the cleansed table, as a batch run stores it."""
    fields = [*view.BASE_FIELDS, "lei_valid", POSITION]
    return stored(versions(normalized(spark, sf_dir)).select(*fields), "cleansed")


def bucketed_parties(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "parties")
    write_bucketed(parties(spark, sf_dir), path, "id", BUCKETS)
    return read_bucketed(spark, path)


def parties(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view.party_view(stored_versions(spark, sf_dir))


# Cleansing --------------------------------------------------------------------


@query
def reject_empty(spark, sf_dir):
    return rejects(feed(spark, sf_dir)).select("id", "source_file", "issue")


@query
def normalize_names(spark, sf_dir):
    return accepted(spark, sf_dir).select(
        "id", normalize_name("legal_name").alias("clean_name")
    )


@query
def normalize_addresses(spark, sf_dir):
    return accepted(spark, sf_dir).select(
        "id", normalize_address("address").alias("clean_address")
    )


@query
def country_valid(spark, sf_dir):
    return accepted(spark, sf_dir).select(
        "id",
        F.upper("country").alias("country"),
        validate.flag(validate.country_known("upper(country)")).alias("country_valid"),
    )


@query
def entity_type_norm(spark, sf_dir):
    return accepted(spark, sf_dir).select(
        "id", validate.entity_type("entity_type").alias("entity_type")
    )


@query
def lei_status(spark, sf_dir):
    return normalized(spark, sf_dir).select("id", "lei", "lei_valid", "lei_status")


@query
def email_valid(spark, sf_dir):
    return accepted(spark, sf_dir).select(
        "id",
        "contact_email",
        validate.flag(validate.email_valid("contact_email")).alias("email_valid"),
    )


@query
def dedup_key(spark, sf_dir):
    return normalized(spark, sf_dir).select(
        "id", "full_key", keys.shown_key("full_key").alias("dedup_key")
    )


@query
def first_seen_duplicates(spark, sf_dir):
    keyed = normalized(spark, sf_dir).select("id", "full_key", POSITION)
    return flag_duplicates(keyed).select("id", "duplicate_of")


@query
def ingest_flags(spark, sf_dir):
    flags = present(labels(risk_flag_conditions()))
    return normalized(spark, sf_dir).select("id", F.array_join(flags, ";").alias("flags"))


@query
def cleansing_notes(spark, sf_dir):
    return cleansed(spark, sf_dir).select("id", "cleansing_notes")


@query
def cleansed_parties(spark, sf_dir):
    return cleansed(spark, sf_dir).select(*CLEANSED_FIELDS)


@query
def ingestion_stats(spark, sf_dir):
    return reports.ingestion_stats(feed(spark, sf_dir), files_processed=2)


@query
def typed_cleansed(spark, sf_dir):
    return table(spark, sf_dir).select(*CLEANSED_FIELDS)


# Identity ---------------------------------------------------------------------


@query
def drop_identity_less(spark, sf_dir):
    return normalized(spark, sf_dir).filter(has_identity()).select("id", "legal_name", "country")


@query
def identity_format_flags(spark, sf_dir):
    return identity(spark, sf_dir).select("id", "lei_format_valid", "country_format_valid")


@query
def trust_score(spark, sf_dir):
    return identity(spark, sf_dir).select(
        "id", "trust", quality.trust_band(F.col("trust")).alias("trust_band")
    )


@query
def fingerprint_sha256(spark, sf_dir):
    return identity(spark, sf_dir).select("id", "fingerprint")


@query
def fingerprint_blake3(spark, sf_dir):
    return identities(normalized(spark, sf_dir), "blake3").select("id", "fingerprint")


# Rules ------------------------------------------------------------------------


@query
def kyc_level(spark, sf_dir):
    return classified(spark, sf_dir).select("id", "kyc_level", "kyc_reason")


@query
def obligations(spark, sf_dir):
    return classified(spark, sf_dir).select("id", joined("obligations", "NONE").alias("obligations"))


@query
def obligation_counts(spark, sf_dir):
    return rules.obligation_counts(stored_classified(spark, sf_dir))


@query
def risk_score(spark, sf_dir):
    return classified(spark, sf_dir).select(
        "id",
        F.col("risk_score").cast("long").alias("risk_score"),
        "risk_class",
        joined("risk_factors", "NONE").alias("risk_factors"),
    )


@query
def risk_score_strict(spark, sf_dir):
    strict = rules.classify(identity(spark, sf_dir), lei_flag="lei_valid")
    return strict.select("id", F.col("risk_score").cast("long").alias("risk_score"), "risk_class")


@query
def sanctions_flags(spark, sf_dir):
    return classified(spark, sf_dir).select(
        "id", joined("sanctions_flags", "CLEAR").alias("sanctions_flags")
    )


@query
def high_risk(spark, sf_dir):
    return rules.high_risk(stored_classified(spark, sf_dir)).select(
        "id", F.col("risk_score").cast("long").alias("risk_score"), "risk_class"
    )


@query
def classification_counts(spark, sf_dir):
    return rules.classification_counts(classified(spark, sf_dir))


@query
def class_counts(spark, sf_dir):
    return rules.class_counts(classified(spark, sf_dir))


@query
def classified_table(spark, sf_dir):
    fields = wire.classified_fields(classified(spark, sf_dir)).select(*rules.CLASSIFIED_FIELDS)
    return fields.withColumn("risk_score", F.col("risk_score").cast("long"))


@query
def rule_tiers(spark, sf_dir):
    chosen = rule_tables.default_rules(spark)
    return rule_tables.with_tier(normalized(spark, sf_dir), chosen).select("id", "country", "tier")


@query
def rule_frameworks(spark, sf_dir):
    chosen = rule_tables.default_rules(spark)
    return rule_tables.framework_rows(normalized(spark, sf_dir), chosen).select(
        "id", "entity_type", F.col("position").cast("long").alias("position"), "framework"
    )


@query
def revenue_bands(spark, sf_dir):
    chosen = rule_tables.default_rules(spark)
    revenue = F.expr(number("annual_revenue_eur"))
    return normalized(spark, sf_dir).select(
        "id", rule_tables.revenue_band(revenue, chosen.thresholds).alias("revenue_band")
    )


# Line formats -----------------------------------------------------------------


@query
def identity_lines(spark, sf_dir):
    return wire.identity_lines(identity(spark, sf_dir)).select("value")


@query
def identity_lines_read(spark, sf_dir):
    path = scratch_path(spark, "identity-lines")
    sinks.write_identity_lines(identity(spark, sf_dir), path)
    return read_identity_lines(spark, path).select("id", "fingerprint", "trust")


@query
def data_lines_read(spark, sf_dir):
    """All line kinds in one folder; header and skip marks drop out on reading."""
    path = scratch_path(spark, "mixed-lines")
    sinks.write_identity_lines(identity(spark, sf_dir), path)
    sinks.write_classified_lines(classified(spark, sf_dir), path, mode="append")
    skipped = rejects(feed(spark, sf_dir)).select(F.concat(F.lit("SKIP|"), "id"))
    skipped.write.mode("append").text(path)
    return wire.data_lines(read_lines(spark, path)).select("value")


@query
def classified_lines(spark, sf_dir):
    path = scratch_path(spark, "classified-lines")
    sinks.write_classified_lines(classified(spark, sf_dir), path)
    return read_lines(spark, path).filter(F.col("value") != wire.CLASSIFIED_HEADER_LINE).select("value")


@query
def classified_lines_read(spark, sf_dir):
    path = scratch_path(spark, "classified-lines")
    sinks.write_classified_lines(classified(spark, sf_dir), path)
    return read_classified_lines(spark, path).select(
        "id", "kyc_level", F.col("risk_score").cast("long").alias("risk_score"), "risk_class"
    )


@query
def wire_reparse(spark, sf_dir):
    path = scratch_path(spark, "wire-lines")
    sinks.write_identity_lines(identity(spark, sf_dir), path)
    fields = wire.classified_fields(wire.classify_lines(read_lines(spark, path)))
    return fields.select(*rules.CLASSIFIED_FIELDS).withColumn(
        "risk_score", F.col("risk_score").cast("long")
    )


# Files ------------------------------------------------------------------------


def _party_files(spark, sf_dir) -> str:
    """Customers as CSV and suppliers as JSON lines, in one folder."""
    path = scratch_path(spark, "party-files")
    raw = feed(spark, sf_dir)
    sinks.write_raw_csv(raw.filter("source_rank = 0").orderBy("row_pos"), path)
    suppliers = raw.filter("source_rank = 1").orderBy("row_pos").select(*RAW_FIELDS)
    suppliers.write.mode("append").json(path)
    return path


@query
def party_files_read(spark, sf_dir):
    raw, _ = read_parties(spark, _party_files(spark, sf_dir), json_lines=True)
    return raw.select(*RAW_FIELDS, F.col("source_rank").cast("long").alias("source_rank"))


@query
def party_files_first_seen(spark, sf_dir):
    raw, _ = read_parties(spark, _party_files(spark, sf_dir), json_lines=True)
    return flag_duplicates(normalize(raw)).select("id", "duplicate_of")


@query
def cleansed_csv_read(spark, sf_dir):
    path = scratch_path(spark, "cleansed-csv")
    sinks.write_cleansed_csv(cleansed(spark, sf_dir), path)
    return read_cleansed_csv(spark, path).select(*CLEANSED_FIELDS)


@query
def typed_csv_read(spark, sf_dir):
    path = scratch_path(spark, "typed-csv")
    sinks.write_cleansed_csv(cleansed(spark, sf_dir), path)
    return read_typed_cleansed(spark, path).select(*CLEANSED_FIELDS)


# Quality ----------------------------------------------------------------------


def _rounded(name: str) -> Column:
    return F.round(name, 6).alias(name)


@query
def field_profile(spark, sf_dir):
    return quality.field_profile(unflagged_table(spark, sf_dir)).select(
        "field_name", "total", "present", "missing", "unique_values",
        _rounded("completeness_pct"), _rounded("uniqueness_pct"),
    )


@query
def dist_country(spark, sf_dir):
    return quality.distribution(unflagged_table(spark, sf_dir), "country")


@query
def dist_entity_type(spark, sf_dir):
    return quality.distribution(unflagged_table(spark, sf_dir), "entity_type")


@query
def dist_status(spark, sf_dir):
    return quality.distribution(unflagged_table(spark, sf_dir), "status")


@query
def dist_sizes(spark, sf_dir):
    return quality.distribution_sizes(unflagged_table(spark, sf_dir))


@query
def anomalies(spark, sf_dir):
    return quality.anomalies(table(spark, sf_dir)).select(
        "party_id", F.col("position").cast("long").alias("position"),
        "type", "severity", "description",
    )


@query
def severity_counts(spark, sf_dir):
    return quality.severity_counts(table(spark, sf_dir))


@query
def quality_score(spark, sf_dir):
    return quality.quality_score(table(spark, sf_dir)).drop("band")


@query
def quality_bands(spark, sf_dir):
    table = stored_table(spark, sf_dir)
    fields = quality.field_profile(table).select(
        F.col("field_name").alias("name"),
        F.round("completeness_pct", 6).alias("value"),
        quality.field_band(F.col("completeness_pct")).alias("band"),
    )
    score = quality.quality_score(table).select(
        F.lit("score").alias("name"), F.col("quality_score").alias("value"), "band"
    )
    return fields.unionByName(score)


@query
def quality_report(spark, sf_dir):
    """The report document with its profile map unfolded to columns."""
    report = reports.quality_report(reports.quality_sections(stored_table(spark, sf_dir)))
    profile = F.element_at("completeness", "country")
    return report.select(
        "total_records",
        "quality_score",
        F.map_keys("completeness").alias("f"),
        profile["present"].alias("country_present"),
        profile["unique_values"].alias("country_unique"),
        F.col("anomalies.total").alias("anomalies"),
        *(F.element_at("anomalies.by_severity", s).alias(s.lower()) for s in SEVERITIES),
    ).withColumn("f", F.array_join(F.array_sort("f"), ";")).withColumnRenamed("f", "fields")


@query
def quality_summary(spark, sf_dir):
    """The lines of the text summary, its time stamp left out."""
    lines = reports.quality_summary(reports.quality_sections(stored_table(spark, sf_dir)))
    return lines.filter("line <> 1").select(F.col("line").cast("long").alias("line"), "value")


@query
def ingestion_report(spark, sf_dir):
    raw = feed(spark, sf_dir)
    stats = reports.ingestion_stats(raw, files_processed=2)
    lines = reports.ingestion_report(stats, rejects(raw), F.lit("-"))
    return lines.select(F.col("section").cast("long").alias("section"), "value")


@query
def report_headline(spark, sf_dir):
    path = scratch_path(spark, "report")
    report = reports.quality_report(reports.quality_sections(stored_table(spark, sf_dir)))
    report.write.json(path)
    return read_report_headline(spark, path)


# View -------------------------------------------------------------------------


@query
def latest_per_id(spark, sf_dir):
    return view.latest_per_id(stored_versions(spark, sf_dir), view.BASE_FIELDS)


def _comparable(parties_view: DataFrame) -> DataFrame:
    return parties_view.withColumn("risk_score", F.col("risk_score").cast("long"))


@query
def merged_view(spark, sf_dir):
    """The view from three tables joined by id."""
    base = stored_versions(spark, sf_dir)
    prints = identities(base)
    return _comparable(view.merged_view(base, prints, rules.classify(prints)))


@query
def party_listing(spark, sf_dir):
    """The view from the cleansed table alone."""
    return _comparable(view.party_listing(parties(spark, sf_dir)))


@query
def name_search(spark, sf_dir):
    return _comparable(view.name_search(parties(spark, sf_dir), "OFFshore"))


@query
def name_search_indexed(spark, sf_dir):
    """The same search through the stored view's trigram index."""
    stored_view = bucketed_parties(spark, sf_dir)
    index = scratch_path(spark, "name-index")
    write_name_index(stored_view, index, BUCKETS)
    return _comparable(indexed_search(stored_view, index, "OFFshore"))


@query
def party_lookup(spark, sf_dir):
    """One bucket of the stored view is read."""
    return _comparable(view.party_lookup(bucketed_parties(spark, sf_dir), "C000000011"))


@query
def merged_view_stored(spark, sf_dir):
    """The view from three tables stored in buckets of the id: nothing is shuffled to merge them."""
    base = stored_versions(spark, sf_dir)
    prints = identities(base)
    sides = {"base": base, "identity": prints.select("id", "fingerprint", "trust", POSITION)}
    sides["classified"] = rules.classify(prints).select("id", "kyc_level", "risk_score", "risk_class", POSITION)
    tables = []
    for name, side in sides.items():
        path = scratch_path(spark, f"bucketed-{name}")
        write_bucketed(side, path, "id", BUCKETS)
        tables.append(read_bucketed(spark, path))
    return _comparable(view.merged_view(*tables))


@query
def explorer_listing(spark, sf_dir):
    return view.explore(parties(spark, sf_dir), "  ltd ").select(
        "id",
        "legal_name",
        "country",
        quality.shown_risk_class(F.col("risk_class")).alias("risk_class"),
        "trust",
        quality.trust_band(F.col("trust")).alias("trust_band"),
        "kyc_level",
    )


# Streaming --------------------------------------------------------------------


@query
def published_parties(spark, sf_dir):
    path = scratch_path(spark, "stream")
    publish(parties(spark, sf_dir), path)
    return spark.read.parquet(path).withColumn("risk_score", F.col("risk_score").cast("long"))


@query
def stream_alerts(spark, sf_dir):
    """Publish, consume as a stream to the end, and return what the sink received."""
    source, sink, position = (scratch_path(spark, n) for n in ("stream", "alerts", "position"))
    publish(parties(spark, sf_dir), source)
    start_alerts(read_stream(spark, source), sink, position).awaitTermination()
    return spark.read.parquet(sink).select(
        "id", F.col("risk_score").cast("long").alias("risk_score"), "level", "message"
    )


@query
def batch_alerts(spark, sf_dir):
    return route_alerts(stream_records(parties(spark, sf_dir))).select(
        "id", F.col("risk_score").cast("long").alias("risk_score"), "level", "message"
    )


# Flagship ---------------------------------------------------------------------


@query
def party_classification(spark, sf_dir):
    """Cleansed, duplicate-flagged and classified parties in one table."""
    full = classified_parties(cleansed(spark, sf_dir))
    return full.select(
        "id", "legal_name", "country", "lei_status", "entity_type", "status",
        "duplicate_of", "trust", "fingerprint", "kyc_level",
        F.col("risk_score").cast("long").alias("risk_score"), "risk_class",
        joined("obligations", "NONE").alias("obligations"),
    )


@query
def duplicates_by_country(spark, sf_dir):
    """Parties, duplicates and LEI outcomes per country."""
    keyed = normalized(spark, sf_dir).select("id", "full_key", "country", "lei_status", POSITION)
    return flag_duplicates(keyed).groupBy("country").agg(
        F.count("*").alias("parties"),
        F.count("duplicate_of").alias("duplicates"),
        *(
            F.count_if(F.col("lei_status") == s).alias(f"lei_{s.lower()}")
            for s in ("OK", "MISSING", "INVALID_FORMAT", "CHECKSUM_FAIL")
        ),
    )
