"""The whole batch run: files in, cleansed table, classification, reports, view, stream.

What two stages share is written once and read back: the cleansed table feeds identity,
classification, quality and the view. The normalized table is written before its duplicates are
matched, so nothing is normalized twice and a lost executor costs no re-reading of the sources.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession

from entigrid.operators.classify import classify
from entigrid.operators.cleanse import (
    issues,
    normalize,
    normalize_marking_rejects,
    with_notes,
)
from entigrid.operators.duplicates import flag_duplicates
from entigrid.operators.identity import identities
from entigrid.operators.quality import profile_sketches, typed
from entigrid.operators.reports import (
    duplicate_counts,
    ingestion_report,
    now_text,
    observed_ingestion_stats,
    quality_sections,
    record_counts,
)
from entigrid.operators.name_index import write_name_index
from entigrid.operators.rule_tables import default_rules, read_rules, with_rules
from entigrid.operators.view import party_view
from entigrid.sources import sinks
from entigrid.sources.bucketed import read_bucketed, write_bucketed
from entigrid.sources.party_files import read_parties
from entigrid.sources.provenance import numbered
from entigrid.sources.stored import stored
from entigrid.streaming.publish import publish


def cleanse(raw: DataFrame) -> DataFrame:
    """Raw parties to the cleansed table; the normalized records are stored on the way."""
    return with_notes(flag_duplicates(normalize(raw)))


def classified_parties(
    cleansed: DataFrame, algorithm: str = "sha256", lei_flag: str = "lei_format_valid"
) -> DataFrame:
    return classify(identities(cleansed, algorithm), lei_flag)


@dataclass(frozen=True)
class Outputs:
    """Where a run leaves its results, all below one folder."""

    folder: str

    def path(self, name: str) -> str:
        return f"{self.folder.rstrip('/')}/{name}"


def ingest(spark: SparkSession, raw: DataFrame, files: int, out: Outputs) -> DataFrame:
    """Store cleansed table, rejects, statistics and ingestion report.

    The sources are read once, into a stored table of all normalized records. The records are
    counted while that table and the cleansed one are written; no table is read for counts.
    """
    records, flags = Observation("records"), Observation("flags")
    marked = normalize_marking_rejects(raw).observe(records, *record_counts())
    everything = numbered(stored(marked, "normalized"))
    accepted = everything.filter("NOT rejected").drop("rejected")
    if not records.get["valid"]:
        raise ValueError("no data: no party was accepted")

    cleansed = with_notes(flag_duplicates(accepted, settled=True)).observe(flags, *duplicate_counts())
    sinks.write_cleansed(cleansed, out.path("cleansed"))
    issues(everything.filter("rejected")).write.parquet(out.path("rejects"))
    stats = observed_ingestion_stats(spark, {**records.get, **flags.get}, files)
    stats.write.parquet(out.path("ingestion_stats"))
    report = ingestion_report(
        spark.read.parquet(out.path("ingestion_stats")),
        spark.read.parquet(out.path("rejects")),
        now_text(),
    )
    sinks.write_report_lines(report, out.path("ingestion_report"))
    return spark.read.parquet(out.path("cleansed"))


def run(
    spark: SparkSession,
    data_dir: str,
    output_dir: str,
    algorithm: str = "blake3",
    lei_flag: str = "lei_format_valid",
    json_lines: bool | None = None,
    text_outputs: bool = True,
    buckets: int | None = None,
    rules: str | None = None,
    sketches: bool = False,
) -> Outputs:
    """Run every stage over a folder of party files into a new output folder.

    The view is stored in buckets of the id, by default as many as there are shuffle partitions.
    ``rules`` is a document or folder of rule versions; the one in effect today is applied. With
    ``sketches``, the run also leaves what it adds to a profile over several runs.
    """
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    out = Outputs(output_dir)
    raw, files = read_parties(spark, data_dir, json_lines)
    cleansed = ingest(spark, raw, files, out)

    classify(identities(cleansed, algorithm), lei_flag).write.parquet(out.path("classified"))
    classified = spark.read.parquet(out.path("classified"))
    chosen = read_rules(spark, rules) if rules else default_rules(spark)
    ruled = with_rules(cleansed.select("id", "country", "entity_type", "annual_revenue_eur"), chosen)
    ruled.drop("annual_revenue_eur").write.parquet(out.path("rules"))
    if text_outputs:
        sinks.write_cleansed_csv(cleansed, out.path("cleansed_csv"))
        sinks.write_identity_lines(classified, out.path("identity_lines"))
        sinks.write_classified_lines(classified, out.path("classified_lines"))

    table = typed(cleansed)
    quality_sections(table).write.parquet(out.path("quality_sections"))
    sections = spark.read.parquet(out.path("quality_sections"))
    if sketches:
        profile_sketches(table).write.parquet(out.path("profile_sketches"))
    sinks.write_quality_report(table, sections, out.path("quality"))

    write_bucketed(party_view(cleansed, algorithm, lei_flag), out.path("parties"), "id", buckets)
    parties = read_bucketed(spark, out.path("parties"))
    write_name_index(parties, out.path("name_index"), buckets)
    publish(parties, out.path("stream"))
    return out
