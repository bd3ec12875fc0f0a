"""The sample parties through identity, rules, quality and the view."""

import pytest

from entigrid.operators import quality
from entigrid.operators.classify import classify, classification_counts
from entigrid.operators.identity import identities
from entigrid.operators.reports import (
    ingestion_stats,
    quality_sections,
    quality_summary,
)
from entigrid.operators.view import merged_view, party_view
from entigrid.operators.wire import (
    classified_lines,
    classify_lines,
    identity_lines,
    parse_classified_lines,
    parse_identity_lines,
)
from entigrid.plans.pipeline import cleanse
from entigrid.sources.party_files import read_parties
from fixtures import (
    ANOMALIES,
    CLASSIFIED_LINES,
    COMPLETENESS,
    DISTRIBUTIONS,
    IDENTITY_LINES,
    QUALITY_SCORE,
    SEVERITY_COUNTS,
)


@pytest.fixture(scope="module")
def cleansed(spark, sample_dir):
    raw, _ = read_parties(spark, sample_dir)
    return cleanse(raw).cache()


@pytest.fixture(scope="module")
def table(cleansed):
    return quality.typed(cleansed)


@pytest.fixture(scope="module")
def identity(cleansed):
    return identities(cleansed, "blake3").cache()


def values(df):
    return sorted(r.value for r in df.collect())


def test_ingestion_stats(spark, sample_dir):
    raw, files = read_parties(spark, sample_dir)
    row = ingestion_stats(raw, files).first()
    assert (row.files, row.total, row.valid, row.cleansed, row.rejected, row.duplicates) == (
        2, 12, 11, 1, 1, 1,
    )
    assert row.score == "91.7%"


def test_identity_lines(identity):
    assert values(identity_lines(identity)) == IDENTITY_LINES


def test_lossy_hand_off(identity):
    assert values(classified_lines(classify_lines(identity_lines(identity)))) == CLASSIFIED_LINES


def test_named_columns_mode(identity):
    rows = {r.id: r for r in classify(identity).collect()}
    scores = {i: (r.risk_score, r.risk_class) for i, r in rows.items()}
    clean = ["P001", "P002", "P004", "P006", "P008", "P009", "P011", "P012"]
    assert all(scores[i] == (0, "LOW") for i in clean)
    assert scores["P003"] == (30, "MEDIUM")
    assert scores["P005"] == (120, "CRITICAL")
    assert scores["P010"] == (110, "CRITICAL")
    assert rows["P001"].kyc_reason == "EU credit institution — standard CDD"
    assert rows["P003"].obligations == [
        "EMIR_TR_REPORTING", "LEI_REQUIRED_MISSING", "CRS_REPORTING",
    ]
    assert rows["P010"].sanctions_flags == [
        "REVIEW:SUSPENDED_STATUS", "ALERT:SUSPENDED_EXCHANGE",
    ]
    strict = {r.id: r.risk_score for r in classify(identity, "lei_valid").collect()}
    assert strict == {i: 30 if i in ("P009", "P011") else s for i, (s, _) in scores.items()}
    assert tuple(classification_counts(classify(identity)).first()) == (11, 2)


def test_field_profile(table):
    got = {
        r.field_name: (
            r.present, r.missing, round(r.completeness_pct, 1), r.unique_values,
            round(r.uniqueness_pct, 1),
        )
        for r in quality.field_profile(table).collect()
    }
    assert got == COMPLETENESS


@pytest.mark.parametrize("field", DISTRIBUTIONS)
def test_distribution(table, field):
    got = [tuple(r) for r in quality.distribution(table, field).collect()]
    assert got == DISTRIBUTIONS[field]


def test_distribution_sizes(table):
    assert tuple(quality.distribution_sizes(table).first()) == (8, 5, 2)


def test_anomalies(table):
    rows = quality.anomalies(table).orderBy("party_id", "position").collect()
    assert [(r.party_id, r.type, r.severity, r.description) for r in rows] == ANOMALIES
    counts = quality.severity_counts(table).first()
    assert {s: counts[s.lower()] for s in SEVERITY_COUNTS} == SEVERITY_COUNTS
    assert counts.total == 10


def test_quality_score(table):
    row = quality.quality_score(table).first()
    assert (row.total_records, row.quality_score, row.band) == (11, QUALITY_SCORE, "FAIR")


def test_quality_summary(table):
    lines = [r.value for r in quality_summary(quality_sections(table)).orderBy("line").collect()]
    assert "Overall quality score: 62.1 / 100.0 FAIR" in lines
    assert "FAIR  contact_email              81.8%  (9/11)" in lines
    assert "GOOD  id                        100.0%  (11/11)" in lines
    assert "Countries: 8  |  Entity Types: 5  |  Statuses: 2" in lines
    assert lines[-6:-1] == [
        "CRITICAL: 2", "HIGH:     6", "MEDIUM:   2", "LOW:      0", "TOTAL:    10",
    ]


def test_merged_view(cleansed, identity):
    prints = parse_identity_lines(identity_lines(identity))
    lines = classified_lines(classify_lines(identity_lines(identity)))
    rows = {r.id: r for r in merged_view(cleansed, prints, parse_classified_lines(lines)).collect()}
    assert len(rows) == 11
    p5 = rows["P005"]
    assert (p5.legal_name, p5.kyc_level, p5.risk_score, p5.risk_class, p5.trust) == (
        "Shady Offshore Holdings", "ENHANCED", 70, "HIGH", 75.0,
    )
    assert p5.fingerprint == IDENTITY_LINES[4].split("|")[4]
    assert rows["P003"].lei == "INVALIDLEI12345" and rows["P003"].country == ""


def test_one_shuffle_view_equals_joined_view(cleansed, identity):
    joined = merged_view(cleansed, identity, classify(identity))
    direct = party_view(cleansed, "blake3")
    assert sorted(map(tuple, joined.collect())) == sorted(map(tuple, direct.collect()))
