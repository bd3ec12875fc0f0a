"""Tables stored in buckets, and the search index beside them."""

import re

import pytest
from pyspark.sql import functions as F

from entigrid.operators.name_index import indexed_search, write_name_index
from entigrid.operators.view import merged_view, name_search, party_lookup
from entigrid.schema import POSITION, VIEW_SCHEMA
from entigrid.sources.bucketed import read_bucketed, write_bucketed

NAMES = ["Alpha Offshore Ltd", "BETA ltd", "offsho re", "ab", "", "Zürich AG", "ZÜRICH ag 100%", "a_b%c", "aaaa", "İstanbul Ltd", "日本銀行", "Offshore"]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def files_read(df):
    """Names of the files that a scan's tasks get to read."""
    parts = df._jdf.queryExecution().toRdd().partitions()
    return sorted(f.filePath().toString().rsplit("/", 1)[1] for part in parts for f in part.files())


def parties(spark, names):
    known = {"id", "legal_name", "risk_score", "trust"}
    fields = [f.name for f in VIEW_SCHEMA]
    values = {"risk_score": lambda i: i % 90, "trust": lambda i: 50.0, "id": lambda i: f"P{i:04}", "legal_name": lambda i: names[i]}
    rows = [tuple(values[f](i) if f in known else f"{f}{i}" for f in fields) for i in range(len(names))]
    return spark.createDataFrame(rows, VIEW_SCHEMA)


@pytest.fixture(scope="module")
def stored_view(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("view's")  # a quote in the path
    # many parties share the letters of "ltd"
    view = parties(spark, NAMES + [f"Company {i} Ltd" for i in range(600)])
    write_bucketed(view, str(folder / "parties"), "id", 8)
    write_name_index(read_bucketed(spark, str(folder / "parties")), str(folder / "index"), 8, parties_a_task=100)
    return folder


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_buckets_keep_all_rows(spark, stored_view):
    table = read_bucketed(spark, str(stored_view / "parties"))
    assert rows(table) == rows(spark.read.parquet(str(stored_view / "parties"))) == rows(parties(spark, NAMES + [f"Company {i} Ltd" for i in range(600)]))
    files = [p.name for p in (stored_view / "parties").glob("part-*")]
    assert len(files) == len({re.search(r"_(\d{5})\.", n)[1] for n in files}) <= 8


def test_lookup_reads_one_bucket(spark, stored_view):
    view = read_bucketed(spark, str(stored_view / "parties"))
    for party in ("P0003", "P0400"):
        found = party_lookup(view, party)
        assert len(files_read(found)) == 1 and len(files_read(view)) > 4
        assert [r.id for r in found.collect()] == [party]
    assert party_lookup(view, "no such").collect() == []


def test_merge_of_stored_sides_has_no_exchange(spark, tmp_path):
    n = 500
    base = spark.range(n).select(
        F.concat(F.lit("i"), F.col("id") % 200).alias("id"), *(F.lit(f).alias(f) for f in ("legal_name", "country", "lei", "entity_type", "status")),
        F.col("id").alias(POSITION),
    ).withColumn("country", F.col(POSITION).cast("string"))
    prints = base.select("id", F.lit("f").alias("fingerprint"), F.lit(5.0).alias("trust"), POSITION)
    classes = base.select("id", F.lit("k").alias("kyc_level"), F.lit(3).alias("risk_score"), F.lit("LOW").alias("risk_class"), POSITION)
    sides = []
    for name, side in (("a", base), ("b", prints), ("c", classes.filter("id <> 'i7'"))):
        write_bucketed(side, str(tmp_path / name), "id", 4)
        sides.append(read_bucketed(spark, str(tmp_path / name)))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged = merged_view(*sides)
        assert "Exchange" not in plan(merged)
        got = {r.id: r for r in merged.collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(got) == 200 and got["i5"].country == "405" and got["i150"].country == "350"
    assert got["i7"].kyc_level == "" and got["i8"].kyc_level == "k"


@pytest.mark.parametrize("text", ["offshore", "OFFSHORE L", "ltd", "zürich", "ZÜRICH", "100%", "_b%", "ab", "a", "aaa", "aaaaa", "istanbul", "日本銀", "company 59", "no such", "xyz ltd", " "])
def test_indexed_search_equals_scan(spark, stored_view, text):
    view = read_bucketed(spark, str(stored_view / "parties"))
    assert rows(indexed_search(view, str(stored_view / "index"), text)) == rows(name_search(view, text))


def test_search_reads_few_buckets_and_short_texts_scan(spark, stored_view):
    view, index = read_bucketed(spark, str(stored_view / "parties")), str(stored_view / "index")
    postings = read_bucketed(spark, f"{index}/postings")
    two = files_read(postings.filter(F.col("gram").isin(["off", "zür"])))
    assert 1 <= len({re.search(r"_(\d{5})\.", n)[1] for n in two}) <= 2 < len(files_read(postings)) / 3
    short = plan(indexed_search(view, index, "ab"))
    assert "Join" not in short and "postings" not in short
    with pytest.raises(ValueError, match="missing name"):
        indexed_search(view, index, "")


def test_common_letters_are_written_by_several_tasks(spark, stored_view):
    postings = spark.read.parquet(str(stored_view / "index" / "postings"))
    ltd = postings.filter("gram = 'ltd'").groupBy(F.col("_metadata.file_name")).count().collect()
    assert len(ltd) > 1 and sum(r["count"] for r in ltd) == 603


def test_index_of_nothing(spark, tmp_path):
    write_bucketed(parties(spark, ["x"]).limit(0), str(tmp_path / "parties"), "id", 4)
    view = read_bucketed(spark, str(tmp_path / "parties"))
    write_name_index(view, str(tmp_path / "index"), 4)
    assert indexed_search(view, str(tmp_path / "index"), "anything").collect() == []
