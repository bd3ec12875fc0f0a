"""Party files with all their irregularities, and every sink read back."""

import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from entigrid.fixed_values import CLEANSED_FIELDS
from entigrid.functions.sql import number
from entigrid.operators.cleanse import normalize
from entigrid.operators.duplicates import flag_duplicates
from entigrid.operators.wire import CLASSIFIED_HEADER_LINE, parse_identity_lines
from entigrid.plans.pipeline import classified_parties, cleanse, run
from entigrid.schema import POSITION, SCAN_FIELDS
from entigrid.sources import sinks
from entigrid.sources.party_files import list_files, read_parties, read_party_csv
from entigrid.sources import party_files, stored as stored_steps
from entigrid.sources.provenance import numbered
from entigrid.sources.stored import stored
from entigrid.sources.tables import read_cleansed_csv

FIELDS = ["id", "legal_name", "country", "lei"]


def rows(df, *fields):
    return sorted(tuple(r) for r in df.select(*(fields or FIELDS)).collect())


def test_csv_irregularities(spark, tmp_path):
    (tmp_path / "a.csv").write_text(
        'id, legal_name ,country,lei,unknown\r\n'
        '1,"Say ""Hi"", Inc.",DE,L1,x\r\n'
        '\n'
        '   \n'
        '2,No Quotes,FR\n'
        '3,Many,GB,L3,x,y,z\n'
        '4,  spaced  , LU,,\n'
    )
    raw, files = read_parties(spark, str(tmp_path))
    assert files == 1
    assert rows(raw) == [
        ("1", 'Say "Hi", Inc.', "DE", "L1"),
        ("2", "No Quotes", "FR", ""),
        ("3", "Many", "GB", "L3"),
        ("4", "  spaced  ", " LU", ""),
    ]
    assert rows(raw, "status", "address") == [("", "")] * 4


def test_headers_may_differ(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,legal_name\n1,One\n")
    (tmp_path / "b.csv").write_text("country,id\nDE,2\n")
    (tmp_path / "c.csv").write_text("")
    (tmp_path / "d é %.csv").write_text("id,legal_name\n4,Four\n")
    raw, files = read_parties(spark, str(tmp_path))
    assert files == 4
    assert rows(raw, "id", "legal_name", "country", "source_file") == [
        ("1", "One", "", "a.csv"), ("2", "", "DE", "b.csv"), ("4", "Four", "", "d é %.csv"),
    ]


def test_uniform_header_is_verified(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,legal_name\n1,One\n")
    (tmp_path / "b.csv").write_text("id,legal_name\n2,Two\n")
    paths = list_files(spark, str(tmp_path), "*.csv")
    assert rows(read_party_csv(spark, paths, uniform_header=True), "id") == [("1",), ("2",)]
    (tmp_path / "c.csv").write_text("legal_name,id\nThree,3\n")
    paths = list_files(spark, str(tmp_path), "*.csv")
    try:
        read_party_csv(spark, paths, uniform_header=True).collect()
    except Exception as error:
        assert "header" in str(error).lower()
    else:
        raise AssertionError("a different header went unnoticed")


def test_headers_of_many_files(spark, tmp_path):
    """Mixed headers, blank first lines, a byte order mark, quoted names with line breaks, empty and
    large files; no more than two jobs look at them."""
    wanted = []
    for i in range(400):
        kind = i % 5
        head, row = {
            0: ("id,legal_name", f"{i},Name {i}"), 1: ("legal_name,id", f"Name {i},{i}"), 2: ("\n  \n\ufeffid,legal_name", f"{i},Name {i}"),
            3: ('\ufeff"x\ny",id," legal_name "', f"z,{i},Name {i}"), 4: ("", ""),
        }[kind]
        # a mark that isn't at the start is one of a name
        text = head.replace("\ufeff", "") if kind == 2 else head
        (tmp_path / f"f{i:04}.csv").write_text(f"{text}\n{row}\n" if kind < 4 else "\n" * (i % 3), encoding="utf-8")
        wanted += [(str(i), f"Name {i}")] if kind < 4 else []
    big = "".join(f"b{i},Big {i}\n" for i in range(40_000))
    (tmp_path / "large.csv").write_text("\n\nid,legal_name\n" + big)
    paths = list_files(spark, str(tmp_path), "*.csv")
    spark.sparkContext.setJobGroup("headers", "headers")
    try:
        headers = party_files._headers(spark, paths)
        # listing more than 32 paths is a job of its own
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("headers")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) <= 4
    assert len(headers) == 321 and headers[paths[-1]] == ("id", "legal_name") and headers[paths[3]] == ("x\ny", "id", "legal_name")
    got = rows(read_party_csv(spark, paths), "id", "legal_name")
    assert len(got) == len(wanted) + 40_000 and set(wanted) <= set(got)


def test_json_lines_and_documents_in_one_folder(spark, tmp_path):
    one = {"id": "1", "legal_name": "One"}
    (tmp_path / "a.json").write_text("\n" + "".join(json.dumps({"id": f"l{i}"}) + "\n" for i in range(3)))
    (tmp_path / "b.json").write_text(json.dumps(one))
    (tmp_path / "c.json").write_text(json.dumps([one, {"id": "2"}]))
    (tmp_path / "d.json").write_text(json.dumps({"id": "3", "legal_name": "Three"}, indent=2))
    (tmp_path / "e.json").write_text("")
    (tmp_path / "f.json").write_text("\ufeff" + json.dumps([{"id": "4"}], indent=1))
    raw, files = read_parties(spark, str(tmp_path))
    assert files == 6
    assert rows(raw, "id") == sorted([("l0",), ("l1",), ("l2",), ("1",), ("1",), ("2",), ("3",), ("4",)])
    numbers = numbered(stored(raw, "raw"))
    assert [r.id for r in numbers.orderBy(POSITION).collect()] == ["l0", "l1", "l2", "1", "1", "2", "3", "4"]


def test_json_documents(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"id": "1", "annual_revenue_eur": 2100000000}))
    (tmp_path / "b.json").write_text('[{"id": 2, "annual_revenue_eur": 1.50}, {"id": "3", "lei": null}]')
    raw, files = read_parties(spark, str(tmp_path))
    assert files == 2
    assert rows(raw, "id", "lei", "annual_revenue_eur") == [
        ("1", "", "2100000000"), ("2", "", "1.50"), ("3", "", ""),
    ]


def test_no_files(spark, tmp_path):
    raw, files = read_parties(spark, str(tmp_path))
    assert files == 0 and raw.count() == 0


def test_first_seen_follows_files_not_tasks(spark, tmp_path):
    """CSV before JSON, files by name whatever their case, then position; splits in order."""
    same = "Same Name AG,DE,LEI"
    (tmp_path / "B.csv").write_text("id,legal_name,country,lei\n" + f"b1,{same}\n")
    many = "".join(f"a{i},{same}\n" for i in range(2000))
    (tmp_path / "a.csv").write_text("id,legal_name,country,lei\n" + many)
    (tmp_path / "0.json").write_text(
        '{"id": "j", "legal_name": "Same Name AG", "country": "DE", "lei": "LEI"}'
    )
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        raw, _ = read_parties(spark, str(tmp_path))
        assert raw.rdd.getNumPartitions() > 5
        flagged = flag_duplicates(normalize(raw)).select("id", "duplicate_of", POSITION)
        got = flagged.collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [r.id for r in got if r.duplicate_of is None] == ["a0"]
    assert {r.duplicate_of for r in got if r.id != "a0"} == {"a0"}
    in_order = sorted(got, key=lambda r: r[POSITION])
    assert [r.id for r in in_order] == [f"a{i}" for i in range(2000)] + ["b1", "j"]


def test_numbers_follow_files_over_many_partitions(spark, tmp_path):
    """Three files in 16 partitions or more: numbers from 0 on, in file order."""
    wanted = []
    for name, n in (("a.csv", 700), ("B.csv", 1), ("c.csv", 900)):
        ids = [f"{name}-{i}" for i in range(n)]
        (tmp_path / name).write_text("id,legal_name\n" + "".join(f"{i},Name of {i}\n" for i in ids))
        wanted += ids
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2048")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        raw, _ = read_parties(spark, str(tmp_path))
        assert raw.rdd.getNumPartitions() >= 16
        rows = numbered(stored(normalize(raw).select("id", *SCAN_FIELDS), "raw"))
        got = rows.collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert rows.columns == ["id", POSITION]
    assert [r.id for r in sorted(got, key=lambda r: r[POSITION])] == wanted
    assert sorted(r[POSITION] for r in got) == list(range(len(wanted)))


def test_numbering_without_a_broadcast(spark, tmp_path, monkeypatch):
    (tmp_path / "a.csv").write_text("id\n" + "".join(f"a{i}\n" for i in range(50)))
    (tmp_path / "b.csv").write_text("id\nb0\n")
    monkeypatch.setattr(stored_steps, "BROADCAST_ROWS", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = numbered(stored(read_parties(spark, str(tmp_path))[0], "raw"))
        shuffles = [line for line in rows._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange" in line]
        # the rows are dealt out by the name of their split, a number
        assert len(shuffles) == 2 and all("hashpartitioning(split#" in line for line in shuffles)
        got = {r.id: r[POSITION] for r in rows.collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == {**{f"a{i}": i for i in range(50)}, "b0": 50}


def test_numbering_of_nothing(spark, tmp_path):
    (tmp_path / "a.csv").write_text("")
    rows = numbered(stored(read_parties(spark, str(tmp_path))[0], "raw"))
    assert POSITION in rows.columns and rows.count() == 0


def test_hidden_files_and_missing_folders_are_errors(spark, tmp_path):
    for name in ("_x.csv", "_x.json"):
        folder = tmp_path / name.split(".")[1]
        folder.mkdir()
        (folder / name).write_text("id\n1\n")
        (folder / "b.csv").write_text("id\n2\n")
        with pytest.raises(ValueError, match=name):
            read_parties(spark, str(folder))
    with pytest.raises(AnalysisException):
        read_parties(spark, str(tmp_path / "missing"))


def test_repeated_and_similar_header_names(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,legal_name,country,lei,id\n1,One,DE,L,last\n")
    (tmp_path / "b.csv").write_text("ID,legal_name,id\nother,Two,2\n")
    raw, _ = read_parties(spark, str(tmp_path))
    assert rows(raw) == [("2", "Two", "", ""), ("last", "One", "DE", "L")]


def test_line_breaks_and_bars_in_names(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"id": "1", "legal_name": "A\nB", "address": "x\ny"}, {"id": "2", "legal_name": "X|Y"}]))
    raw, _ = read_parties(spark, str(tmp_path))
    cleansed = cleanse(raw)
    sinks.write_cleansed_csv(cleansed, str(tmp_path / "csv"))
    back = read_cleansed_csv(spark, str(tmp_path / "csv"))
    fields = [f for f in CLEANSED_FIELDS if f != "cleansing_notes"]  # a list before it is written
    text = [F.col(f).cast("string").alias(f) for f in fields]
    assert rows(back, *fields) == rows(cleansed.select(*text), *fields)
    sinks.write_classified_lines(classified_parties(cleansed.filter("id = '2'")), str(tmp_path / "lines"))
    lines = [line for part in sorted((tmp_path / "lines").glob("part-*")) for line in part.read_text().splitlines()]
    assert lines[0] == CLASSIFIED_HEADER_LINE and lines[1].startswith("2|X|Y|") and len(lines) == 2 and "\0" not in lines[1]


def test_no_data_is_an_error(spark, tmp_path):
    (tmp_path / "in").mkdir()
    with pytest.raises(ValueError, match="no data"):
        run(spark, str(tmp_path / "in"), str(tmp_path / "out"))


def test_only_plain_numbers_are_numbers(spark):
    given = ["5", "1.5", "-2e3", ".5", "5.", "5d", "1f", "NaN", "Infinity", "0x1", "", " 7 "]
    df = spark.createDataFrame([(g,) for g in given], "v string")
    assert [r[0] for r in df.select(F.expr(number("v"))).collect()] == [5.0, 1.5, -2000.0, 0.5, 5.0, None, None, None, None, None, None, 7.0]
    start = "IDENTITY|1|n|DE|f|l|t|lei_valid=true|country_valid=true|trust="
    lines = spark.createDataFrame([(start + t,) for t in ("50", "1=50", "85d")], "value string")
    assert [r.trust for r in parse_identity_lines(lines).collect()] == [50.0, 0.0, 0.0]
