"""Hot keys, plan shapes and results that must not depend on either."""

import re

import pytest
from pyspark.sql import functions as F

from entigrid.operators import duplicates
from entigrid.operators.duplicates import flag_duplicates
from entigrid.operators.quality import distribution, field_profile, merged_profile, ordered_counts, profile_sketches, value_counts
from entigrid.operators.view import latest_per_id, merged_view
from entigrid.plans.catalog import QUERIES, classified, identity, normalized
from entigrid.schema import POSITION

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(df):
    return len(re.findall(r"Exchange (?:hash|range)partitioning|Exchange SinglePartition", plan(df)))


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of 30,000 rows under one key, 5,000 keys that occur twice, the rest unique."""
    n = F.col("id")
    key = (
        F.when(n % 3 == 0, F.lit("hot"))
        .when(n % 3 == 1, F.concat(F.lit("pair"), F.floor(n / 6).cast("string")))
        .otherwise(F.concat(F.lit("single"), n.cast("string")))
    )
    return spark.range(0, 30000, 1, 7).select(
        F.concat(F.lit("id"), n.cast("string")).alias("id"),
        key.alias("full_key"),
        ((n % 2) * 100_000 + 30000 - n).alias(POSITION),
    )


def brute_force(rows):
    """First id per key in ingest order, by a plain loop."""
    first, result = {}, {}
    for r in sorted(rows, key=lambda r: r[POSITION]):
        if r.full_key in first:
            result[r.id] = first[r.full_key]
        else:
            first[r.full_key], result[r.id] = r.id, None
    return result


@pytest.mark.parametrize("hot, tracked, broadcast", [(1, 4, "-1"), (3, 64, "10485760"), (1024, 4096, "-1")])
def test_duplicates_under_skew(spark, skewed, monkeypatch, hot, tracked, broadcast):
    monkeypatch.setattr(duplicates, "HOT_KEYS", hot)
    monkeypatch.setattr(duplicates, "TRACKED_KEYS", tracked)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        got = {r.id: r.duplicate_of for r in flag_duplicates(skewed).collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == brute_force(skewed.collect())


def test_hot_keys_are_found(skewed):
    assert "hot" in {r.hot_key for r in duplicates.hot_keys(skewed, "full_key").collect()}


def test_duplicates_of_nothing(skewed):
    assert flag_duplicates(skewed.limit(0)).collect() == []


def test_one_exchange_of_rows_and_none_of_hot_ones(spark, skewed):
    """The rows of hot keys aren't shuffled, the others once; no partition holds the hot third."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        flagged = flag_duplicates(skewed)
        found = plan(flagged)
        dealt = flagged.filter("duplicate_of IS NULL OR duplicate_of NOT LIKE '%x%'")
        sizes = [r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert shuffles(flagged) == 1 and "SortAggregate" not in found and "SortMergeJoin" not in found
    assert sum(sizes) == 30000 and max(sizes) < 9500


def test_records_are_normalized_once(spark):
    """What is flagged is a stored table: the plan holds no name rule."""
    for name in ("first_seen_duplicates", "cleansed_parties", "duplicates_by_country"):
        found = plan(QUERIES[name](spark, SF))
        assert "regexp_replace" not in found and "c_custkey" not in found


def test_latest_rows_need_no_sort_aggregate(spark):
    for name in ("latest_per_id", "party_listing", "merged_view"):
        found = plan(QUERIES[name](spark, SF))
        assert "SortAggregate" not in found and "HashAggregate" in found


def test_latest_row_of_a_hot_id(spark):
    rows = spark.range(0, 9000, 1, 7).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("i"), F.floor(F.col("id") / 6))).alias("id"),
        F.concat(F.lit("n"), "id").alias("lei"),
        ((F.col("id") * 7919) % 9000).alias(POSITION),
    )
    wanted = {}
    for r in sorted(rows.collect(), key=lambda r: r[POSITION]):
        wanted[r.id] = r.lei
    got = latest_per_id(rows, ["id", "lei"]).collect()
    assert len(got) == len(wanted) and {r.id: r.lei for r in got} == wanted


def test_all_distributions_take_one_pass(spark):
    table = normalized(spark, SF)
    counts = value_counts(table)
    assert plan(counts).count("Expand") == 1 and plan(counts).count("Scan parquet") == 2  # customers and suppliers, once each
    for field in ("country", "entity_type", "status"):
        seen = {}
        for r in sorted(table.select(field, POSITION).collect(), key=lambda r: r[POSITION]):
            seen[r[0]] = seen.get(r[0], 0) + 1
        wanted = sorted(seen.items(), key=lambda v: -v[1])  # stable, so ties stay in order of appearance
        assert [tuple(r) for r in ordered_counts(counts, field).collect()] == wanted


def test_sketches_of_batches_merge(spark):
    """Counts are exact, distinct values within four standard errors, however rows are cut into batches."""
    n = 60_000
    table = spark.range(n).select(
        "id", F.concat(F.lit("a"), "id").alias("own"), (F.col("id") % 37).alias("few"),
        F.when(F.col("id") % 3 > 0, F.col("id") % 9000).alias("some"), F.lit(None).cast("string").alias("none"),
    )
    fields = ["own", "few", "some", "none"]
    exact = {r.field_name: r for r in field_profile(table, fields).collect()}
    whole = profile_sketches(table, fields)
    cuts = [table.filter("id % 7 < 3"), table.filter("id % 7 >= 3 AND id < 50000"), table.filter("id % 7 >= 3 AND id >= 50000")]
    batches = [profile_sketches(cut, fields) for cut in cuts]
    profiles = [{r.field_name: r for r in merged_profile(s).collect()} for s in (whole, batches[0].union(batches[1]).union(batches[2]))]
    for profile in profiles:
        for field in fields:
            got, wanted = profile[field], exact[field]
            assert (got.total, got.present, got.missing, got.completeness_pct) == (wanted.total, wanted.present, wanted.missing, wanted.completeness_pct)
            assert abs(got.unique_values - wanted.unique_values) <= 4 * 0.0082 * wanted.unique_values
    # the registers are the same, whatever the batches
    assert [profiles[0][f].unique_values for f in fields] == [profiles[1][f].unique_values for f in fields]
    assert profiles[0]["few"].unique_values == 37 and profiles[0]["none"].unique_values == 0
    assert whole.count() <= 2 * len(fields)


@pytest.mark.parametrize("table", [normalized, identity, classified])
def test_record_rules_do_not_shuffle(spark, table):
    assert shuffles(table(spark, SF)) == 0


def test_scans_read_only_the_key(spark):
    for name in ("lei_status", "classified_table", "field_profile"):
        schemas = set(re.findall(r"ReadSchema: (struct<[^>]*>)", plan(QUERIES[name](spark, SF))))
        assert schemas == {"struct<c_custkey:bigint>", "struct<s_suppkey:bigint>"}


def test_shuffle_counts(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        base = normalized(spark, SF)
        prints = base.withColumns({"fingerprint": F.lit("x"), "trust": F.lit(1.0)})
        classes = base.withColumns({
            "kyc_level": F.lit("x"), "risk_score": F.lit(1), "risk_class": F.lit("x"),
        })
        # each side deals out its rows and, combined, their last positions
        assert shuffles(merged_view(base, prints, classes)) == 6
        assert shuffles(latest_per_id(base, ["id", "lei"])) == 2
        assert shuffles(field_profile(base)) == 2
        # per value, and the order of the report
        assert shuffles(distribution(base, "country")) == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_stored_classification_filters_in_the_scan(spark):
    assert "PushedFilters: [In(risk_class, [CRITICAL,HIGH])]" in plan(QUERIES["high_risk"](spark, SF))
