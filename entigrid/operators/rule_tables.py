"""Rule tables kept as data: jurisdiction tiers, regulatory frameworks, revenue bands.

A run may read its own tables from JSON, so rules change without a new release. Rule tables
are joined without a broadcast hint: the optimizer knows their size and broadcasts them as
long as they are small, and would shuffle if somebody supplied a huge one.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from entigrid.fixed_values import (
    JURISDICTION_TIERS,
    REGULATORY_FRAMEWORKS,
    REVENUE_THRESHOLDS,
    RULES_EFFECTIVE_DATE,
    RULES_VERSION,
)
from entigrid.functions.sql import number

RULES_SCHEMA = """
    version string, effective_date string,
    jurisdiction_tiers map<string, array<string>>,
    thresholds map<string, double>,
    regulatory_frameworks map<string, array<string>>
"""


@dataclass(frozen=True)
class Rules:
    version: str
    effective_date: str
    tiers: DataFrame  # country, tier
    frameworks: DataFrame  # entity_type, frameworks
    thresholds: dict[str, float]


def _rules(document: DataFrame) -> Rules:
    """Tables from a one-row rule document; a country in two tiers gets the higher one."""
    head = document.select("version", "effective_date", "thresholds").first()
    tiers = document.select(F.explode("jurisdiction_tiers").alias("tier", "countries")).select(
        F.explode("countries").alias("country"), "tier"
    )
    frameworks = document.select(
        F.explode("regulatory_frameworks").alias("entity_type", "frameworks")
    )
    return Rules(
        head.version,
        head.effective_date,
        tiers.groupBy("country").agg(F.max("tier").alias("tier")),
        frameworks,
        {**REVENUE_THRESHOLDS, **(head.thresholds or {})},
    )


def _literal_map(table: dict[str, list[str]]) -> Column:
    cells = []
    for key, values in table.items():
        cells += [F.lit(key), F.array(*(F.lit(v) for v in values))]
    return F.create_map(*cells)


def default_rule_document(spark: SparkSession) -> DataFrame:
    thresholds = F.create_map(
        *(F.lit(v) for k, x in REVENUE_THRESHOLDS.items() for v in (k, float(x)))
    )
    return spark.range(1).select(
        F.lit(RULES_VERSION).alias("version"),
        F.lit(RULES_EFFECTIVE_DATE).alias("effective_date"),
        _literal_map(JURISDICTION_TIERS).alias("jurisdiction_tiers"),
        thresholds.alias("thresholds"),
        _literal_map(REGULATORY_FRAMEWORKS).alias("regulatory_frameworks"),
    )


def default_rules(spark: SparkSession) -> Rules:
    return _rules(default_rule_document(spark))


def read_rules(spark: SparkSession, path: str, on: date | None = None) -> Rules:
    """The rules in effect on a day (today), from a JSON document or a folder of their versions.

    Of the versions whose effective date has come, the last one counts; of one day's, the highest
    number. A version without a date has always been in effect. Files are read anew on every
    call, so a version that is put into the folder takes effect with the next run or batch.
    """
    reader = spark.read.schema(RULES_SCHEMA).option("multiLine", True).option("mode", "FAILFAST")
    day = (on or date.today()).isoformat()
    due = reader.json(path).filter(F.col("effective_date").isNull() | (F.to_date("effective_date") <= F.lit(day).cast("date")))
    parts = F.transform(F.split(F.coalesce("version", F.lit("")), r"\."), lambda part: part.try_cast("int"))
    chosen = due.orderBy(F.to_date("effective_date").desc_nulls_last(), parts.desc(), F.desc("version")).limit(1)
    if chosen.isEmpty():
        raise ValueError(f"{path}: no rules in effect on {day}")
    return _rules(chosen)


def with_rules(parties: DataFrame, rules: Rules) -> DataFrame:
    """Add what the rules say of a party, and their version: tier, frameworks, and the revenue band
    where the table has a revenue."""
    ruled = with_frameworks(with_tier(parties, rules), rules).withColumn("rules_version", F.lit(rules.version))
    if "annual_revenue_eur" not in parties.columns:
        return ruled
    revenue = F.expr(number("annual_revenue_eur"))
    return ruled.withColumn("revenue_band", revenue_band(revenue, rules.thresholds))


def with_tier(parties: DataFrame, rules: Rules) -> DataFrame:
    """Add the jurisdiction tier of the country, null where none is declared."""
    return parties.join(rules.tiers, "country", "left")


def with_frameworks(parties: DataFrame, rules: Rules) -> DataFrame:
    """Add the list of frameworks that apply to the entity type."""
    return parties.join(rules.frameworks, "entity_type", "left").withColumn(
        "frameworks", F.coalesce("frameworks", F.array().cast("array<string>"))
    )


def framework_rows(parties: DataFrame, rules: Rules) -> DataFrame:
    """One row per party and framework."""
    return with_frameworks(parties, rules).select(
        "id", "entity_type", F.posexplode("frameworks").alias("position", "framework")
    )


def revenue_band(revenue: Column, thresholds: dict[str, float]) -> Column:
    """HIGH_VALUE from the upper threshold, SUSPICIOUS within the low range, else NORMAL."""
    return (
        F.when(revenue.isNull(), "UNKNOWN")
        .when(revenue >= thresholds["high_value_entity_eur"], "HIGH_VALUE")
        .when(
            revenue.between(
                thresholds["suspicious_revenue_min"], thresholds["suspicious_revenue_max"]
            ),
            "SUSPICIOUS",
        )
        .otherwise("NORMAL")
    )
