"""The batch run over the sample files, its outputs read back, and the stream after it."""

import json
import os
import subprocess
import sys
from datetime import date
from pathlib import Path

import pytest

from entigrid.__main__ import main
from entigrid.fixed_values import CLEANSED_FIELDS, VIEW_FIELDS
from entigrid.operators import quality
from entigrid.operators.reports import ingestion_stats
from entigrid.operators.rule_tables import read_rules
from entigrid.operators.view import merged_view
from entigrid.plans.pipeline import run
from entigrid.schema import STREAM_SCHEMA
from entigrid.sources.lines import read_classified_lines, read_identity_lines
from entigrid.sources.party_files import read_parties
from entigrid.sources.tables import read_cleansed_csv, read_report_headline, read_typed_cleansed
from entigrid.streaming.alerts import route_alerts, start_alerts
from entigrid.streaming.publish import publish, read_stream
from fixtures import ANOMALIES, COMPLETENESS, DISTRIBUTIONS, IDENTITY_LINES, SEVERITY_COUNTS


@pytest.fixture(scope="module")
def out(spark, sample_dir, tmp_path_factory):
    return run(spark, sample_dir, str(tmp_path_factory.mktemp("out") / "run"))


def text_of(folder):
    parts = sorted(Path(folder).glob("part-*"))
    return "".join(p.read_text(encoding="utf-8") for p in parts)


def json_rows(folder):
    return [json.loads(line) for line in text_of(folder).splitlines()]


def test_ingestion_report(out):
    lines = text_of(out.path("ingestion_report")).splitlines()
    assert lines[5:] == [
        "Files Processed:     2", "Total Records:       12", "Valid Records:       11",
        "Cleansed Records:    1", "Rejected Records:    1", "Duplicates Found:    1", "",
        "Data Quality Score:  91.7%", "", "Issues:", "  - P007: REJECTED — empty record", "",
        "--- End of Report ---",
    ]


def test_observed_statistics_equal_counted_ones(spark, out, sample_dir):
    raw, files = read_parties(spark, sample_dir)
    assert spark.read.parquet(out.path("ingestion_stats")).first() == ingestion_stats(raw, files).first()


RETRIED = """
import sys
from pyspark import TaskContext
from pyspark.sql import functions as F
from entigrid.plans.pipeline import Outputs, ingest
from entigrid.session import build_session
from entigrid.sources.party_files import read_parties

spark = build_session(master="local[2,4]", **{"spark.checkpoint.dir": sys.argv[2] + "/shared", "spark.sql.shuffle.partitions": "3"})
spark.sparkContext.setLogLevel("OFF")
raw, files = read_parties(spark, sys.argv[1])

@F.udf("string")
def flaky(value):
    if TaskContext.get().attemptNumber() == 0:
        raise RuntimeError("first attempt")
    return value

counted = ingest(spark, raw.withColumn("id", flaky("id")), files, Outputs(sys.argv[2] + "/out"))
row = spark.read.parquet(sys.argv[2] + "/out/ingestion_stats").first()
print("ROW", row.files, row.total, row.valid, row.cleansed, row.rejected, row.duplicates, counted.count())
"""


def test_retried_tasks_count_once(sample_dir, tmp_path):
    root = str(Path(__file__).resolve().parent.parent)
    done = subprocess.run(
        [sys.executable, "-c", RETRIED, sample_dir, str(tmp_path)], capture_output=True, text=True, timeout=240, cwd=root, env={**os.environ, "PYTHONPATH": root}
    )
    assert "ROW 2 12 11 1 1 1 11" in done.stdout, done.stdout + done.stderr[-2000:]


def test_no_output_without_data(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("id,legal_name,country,lei\n1, ,,\n")
    with pytest.raises(ValueError, match="no data"):
        run(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    assert not (tmp_path / "out").exists()


def test_identity_lines(out):
    assert sorted(text_of(out.path("identity_lines")).splitlines()) == IDENTITY_LINES


def test_cleansed_csv_reads_back(spark, out):
    stored = spark.read.parquet(out.path("cleansed")).select(CLEANSED_FIELDS)
    read = read_cleansed_csv(spark, out.path("cleansed_csv")).select(CLEANSED_FIELDS)
    as_text = lambda df: sorted(tuple(str(v) for v in r) for r in df.collect())
    assert as_text(read) == as_text(stored)
    typed = read_typed_cleansed(spark, out.path("cleansed_csv"))
    assert quality.quality_score(typed).first().quality_score == 62.1
    assert quality.quality_score(
        read_typed_cleansed(spark, out.path("cleansed"), "parquet")
    ).first().quality_score == 62.1


def test_quality_report(spark, out):
    report = json_rows(out.path("quality/report"))[0]
    assert report["total_records"] == 11 and report["quality_score"] == 62.1
    assert report["anomalies"] == {"total": 10, "by_severity": SEVERITY_COUNTS}
    got = {
        f: (p["present"], p["missing"], p["completeness_pct"], p["unique_values"], p["uniqueness_pct"])
        for f, p in report["completeness"].items()
    }
    assert got == COMPLETENESS
    for field, expected in DISTRIBUTIONS.items():
        name = "type" if field == "entity_type" else field
        assert [(r[name], r["count"]) for r in json_rows(out.path(f"quality/by_{field}"))] == expected
    details = json_rows(out.path("quality/anomalies"))
    assert sorted((d["party_id"], d["type"], d["severity"], d["description"]) for d in details) == sorted(ANOMALIES)
    head = read_report_headline(spark, out.path("quality/report")).first()
    assert tuple(head) == (62.1, 11, 10, 2, 6, 2, 0)


def test_headline_of_a_sparse_report(spark, tmp_path):
    (tmp_path / "r.json").write_text('{"quality_score": 5.0,\n "total_records": 1, "anomalies": {"total": 3, "by_severity": {"HIGH": 3}}}')
    assert tuple(read_report_headline(spark, str(tmp_path / "r.json")).first()) == (5.0, 1, 3, 0, 3, 0, 0)


def test_view_from_files(spark, out):
    """Merging the text outputs gives the stored view."""
    view = merged_view(
        read_cleansed_csv(spark, out.path("cleansed_csv")),
        read_identity_lines(spark, out.path("identity_lines")),
        read_classified_lines(spark, out.path("classified_lines")),
    )
    stored = spark.read.parquet(out.path("parties"))
    assert sorted(map(tuple, view.collect())) == sorted(map(tuple, stored.select(VIEW_FIELDS).collect()))


def test_stream_has_a_durable_position(spark, out, tmp_path):
    stream, sink, position = str(tmp_path / "stream"), str(tmp_path / "sink"), str(tmp_path / "pos")
    view = spark.read.parquet(out.path("parties"))
    publish(view, stream)

    def consume():
        start_alerts(read_stream(spark, stream, files_per_trigger=1), sink, position).awaitTermination()
        return spark.read.parquet(sink)

    first = consume()
    assert first.count() == 11
    alerts = {r.id: r.message for r in first.filter("level = 'ALERT'").collect()}
    assert alerts == {
        "P005": "ALERT: High-risk party P005 (Shady Offshore Holdings) risk score 120",
        "P010": "ALERT: High-risk party P010 (FTX Trading Ltd) risk score 110",
    }
    assert consume().count() == 11  # nothing new
    publish(view, stream)
    assert consume().count() == 22  # each publication is consumed again


def test_a_batch_that_is_handled_again_adds_nothing(spark, out, tmp_path):
    """The position is set back to before the last batch's end, as after a failure between writing and that."""
    stream, sink, alerts, position = (str(tmp_path / n) for n in ("stream", "sink", "alerts", "pos"))
    view = spark.read.parquet(out.path("parties"))
    publish(view, stream)

    def consume():
        start_alerts(read_stream(spark, stream, files_per_trigger=1), sink, position, alerts=alerts).awaitTermination()
        records, raised = spark.read.parquet(sink), spark.read.parquet(alerts)
        return records.count(), sorted(r.id for r in raised.collect())

    assert consume() == (11, ["P005", "P010"])
    commits = sorted((tmp_path / "pos" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    last = commits[-1]
    last.unlink()
    (last.parent / f".{last.name}.crc").unlink(missing_ok=True)
    (tmp_path / "alerts" / "stray").mkdir()
    assert consume() == (11, ["P005", "P010"])
    publish(view, stream)
    assert consume() == (22, ["P005", "P005", "P010", "P010"])


def rule_version(version, day, tiers):
    return json.dumps({"version": version, "effective_date": day, "jurisdiction_tiers": tiers, "regulatory_frameworks": {}})


def test_rule_versions_take_effect_by_date(spark, tmp_path):
    folder = tmp_path / "rules"
    folder.mkdir()
    (folder / "a.json").write_text(rule_version("1.9.0", "2020-01-01", {"OLD": ["DE"]}))
    (folder / "b.json").write_text(rule_version("1.10.0", "2020-01-01", {"NEW": ["DE"]}))
    (folder / "c.json").write_text(rule_version("9.0.0", "2021-06-01", {"LAST": ["DE"]}))
    on = lambda *day: read_rules(spark, str(folder), date(*day)).version
    assert (on(2020, 1, 1), on(2021, 5, 31), on(2021, 6, 1)) == ("1.10.0", "1.10.0", "9.0.0")
    with pytest.raises(ValueError, match="no rules in effect"):
        on(2019, 12, 31)
    (folder / "d.json").write_text(rule_version("0.1", None, {"ALWAYS": ["DE"]}))
    assert on(2019, 12, 31) == "0.1" and on(2020, 1, 1) == "1.10.0"


def test_a_stream_takes_up_new_rules(spark, out, tmp_path):
    stream, sink, alerts, position = (str(tmp_path / n) for n in ("stream", "sink", "alerts", "pos"))
    (tmp_path / "rules").mkdir()
    publish(spark.read.parquet(out.path("parties")).filter("id = 'P005'"), stream)
    records = read_stream(spark, stream)

    def consume():
        start_alerts(records, sink, position, alerts=alerts, rules=str(tmp_path / "rules")).awaitTermination()
        return sorted((r.tier, r.rules_version) for r in spark.read.parquet(alerts).collect())

    country = spark.read.parquet(stream).first().country
    (tmp_path / "rules" / "1.json").write_text(rule_version("1", "2020-01-01", {"TIER_A": [country]}))
    assert consume() == [("TIER_A", "1")]
    (tmp_path / "rules" / "2.json").write_text(rule_version("2", "2021-01-01", {"TIER_B": [country]}))
    (tmp_path / "rules" / "3.json").write_text(rule_version("3", "9999-01-01", {"TIER_C": [country]}))
    publish(spark.read.parquet(out.path("parties")).filter("id = 'P005'"), stream)
    assert consume() == [("TIER_A", "1"), ("TIER_B", "2")]


def printed_profile(capsys, *results):
    main(["profile", "--results", *results])
    return capsys.readouterr().out.splitlines()


def test_commands(spark, sample_dir, tmp_path, capsys):
    """The batch run, the consumer and the lookups, as commands."""
    results = str(tmp_path / "results")
    (tmp_path / "rules.json").write_text(rule_version("7", "2020-01-01", {"T": ["DE"]}))
    main(["--data-dir", sample_dir, "--output", results, "--fingerprint", "sha256", "--rules", str(tmp_path / "rules.json"), "--sketches"])
    ruled = spark.read.parquet(f"{results}/rules").collect()
    assert len(ruled) == 11 and {r.rules_version for r in ruled} == {"7"}
    assert {r.tier for r in ruled if r.country == "DE"} == {"T"} and {r.tier for r in ruled if r.country != "DE"} == {None}
    capsys.readouterr()

    def printed(*arguments):
        main([*arguments, "--results", results])
        return [json.loads(line) for line in capsys.readouterr().out.splitlines()]

    assert len(printed("list")) == 11
    both = [json.loads(line) for line in printed_profile(capsys, results, results)]
    assert {r["field_name"]: (r["total"], r["unique_values"]) for r in both}["id"] == (22, 11)
    assert [r["id"] for r in printed("party", "--id", "P005")] == ["P005"] and printed("party", "--id", "none") == []
    assert "P005" in [r["id"] for r in printed("search", "--name", "OFFSHORE")]
    sink, alerts = str(tmp_path / "sink"), str(tmp_path / "alerts")
    for _ in range(2):
        main(["alerts", "--stream", f"{results}/stream", "--output", sink, "--alerts", alerts, "--position", str(tmp_path / "pos")])
        assert spark.read.parquet(sink).count() == 11
        assert sorted(r.id for r in spark.read.parquet(alerts).collect()) == ["P005", "P010"]


def test_alert_threshold(spark):
    rows = [("a", "n", s) for s in ("69", "70", None, "x", "-1")]
    df = spark.createDataFrame(rows, "id string, name string, risk_score string")
    got = [(r.risk_score, r.level, r.message) for r in route_alerts(df).collect()]
    assert got == [
        (69, "OK", "Party a risk score 69 (ok)"),
        (70, "ALERT", "ALERT: High-risk party a (n) risk score 70"),
        (0, "OK", "Party a risk score 0 (ok)"), (0, "OK", "Party a risk score 0 (ok)"),
        (-1, "OK", "Party a risk score -1 (ok)"),
    ]


def test_published_layout(spark, out):
    assert spark.read.parquet(out.path("stream")).schema == STREAM_SCHEMA
