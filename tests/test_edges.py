"""Rules at their edges, each against a plain restatement or a stated result."""

import hashlib
import itertools
import random

import pytest
import regex
from pyspark.sql import functions as F

from entigrid.fixed_values import DOTTED_NAME_RULES, NAME_RULE_HINT, NAME_RULES
from entigrid.functions import keys, text, validate
from entigrid.operators import quality
from entigrid.operators.classify import classify, risk_class
from entigrid.operators.identity import trust_score
from entigrid.operators.rule_tables import (
    default_rule_document,
    default_rules,
    framework_rows,
    read_rules,
    revenue_band,
    with_tier,
)
from entigrid.operators.view import explore, name_search, party_lookup
from entigrid.operators.wire import parse_classified_lines, parse_identity_lines, reparse


def apply(spark, function, values):
    """The function over values, in their order."""
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "i int, v string").select("i", function("v").alias("r"))
    return [r.r for r in df.orderBy("i").collect()]


NAMES = {
    "  Foo   S.A.  ": "Foo SA",
    "Euro S.A./N.V.": "Euro SA /NV",
    "Bar N.V. Holding": "Bar NV Holding",
    "baz a.g.": "baz AG",
    "Qux GMBH": "Qux GmbH",
    "Acme Ltd.": "Acme Ltd.",
    "Acme ltd. x": "Acme Ltd. x",
    "Acme Ltd.x": "Acme Ltdx",
    "Acme LIMITED": "Acme Ltd",
    "Unlimited": "Unlimited",
    "Big p.l.c.": "Big PLC.",
    "Big P.L.C": "Big PLC",
    "One INC.": "One Inc.",
    "Two corp": "Two Corp",
    "Nordea ABP": "Nordea Abp",
    "Incorporated": "Incorporated",
    " \t  ": "",
    "": "",
    " Ünï  S.a.": "Ünï SA",
}


def test_names(spark):
    assert apply(spark, text.normalize_name, NAMES) == list(NAMES.values())


ADDRESSES = {
    "12 Baker Str. 5": "12 Baker Street 5",
    "Avenue X": "Avenue nue X",
    "Avery Road": "Avenue ry Road",
    "5 Ave. Foch": "5 Avenue Foch",
    '"5th  Blvd"': "5th Boulevard ",
    "'x\"": "x",
    '""x""': '"x"',
    "  ": "",
}


def test_addresses(spark):
    assert apply(spark, text.normalize_address, ADDRESSES) == list(ADDRESSES.values())


def plain_name(name, flags=regex.I):
    """Every rule in turn, without any shortcut."""
    name = regex.sub(r"\s{2,}", " ", name.strip())
    for pattern, replacement in DOTTED_NAME_RULES + NAME_RULES:
        name = regex.sub(pattern, replacement, name, flags=flags)
    return name.rstrip()


TOKENS = [
    "S.A.", "N.V.", "A.G.", "gmbh", "Ltd", "Ltd.", "Limited", "Limited.", "P.L.C.", "PLC",
    "Inc.", "Corp.", "Abp.", " ", ".", "/", "x", "S", "A.", "N.",
]


def token_names():
    for length in (1, 2, 3):
        for parts in itertools.product(TOKENS, repeat=length):
            yield "".join(parts)
    rng = random.Random(7)
    for _ in range(20000):
        yield "".join(rng.choice(TOKENS) for _ in range(rng.randint(4, 9)))


def test_name_shortcuts_are_exact():
    """The hint never hides a rule, and a second pass only does what settled_name does."""
    hint = regex.compile(NAME_RULE_HINT, regex.I)
    rules = [regex.compile(p, regex.I) for p, _ in DOTTED_NAME_RULES + NAME_RULES]
    for name in token_names():
        spaced = regex.sub(r"\s{2,}", " ", name.strip())
        if any(r.search(spaced) for r in rules):
            assert hint.search(spaced), name
        once = plain_name(name)
        twice = plain_name(once)
        settled = regex.sub(r"\bLtd\.\b", "Ltd", once, flags=regex.I)
        squeeze = lambda s: regex.sub(r"\s+", "", s.lower())
        assert squeeze(settled) == squeeze(twice), name


def test_names_match_plain_rules(spark):
    names = sorted(set(itertools.islice(token_names(), 0, None, 9)))
    assert apply(spark, text.normalize_name, names) == [plain_name(n) for n in names]


def plain_lei(lei):
    if not lei.strip():
        return "MISSING"
    if not regex.fullmatch("[A-Z0-9]{20}", lei):
        return "INVALID_FORMAT"
    return "OK" if int("".join(str(int(c, 36)) for c in lei)) % 97 == 1 else "CHECKSUM_FAIL"


def test_lei(spark):
    rng = random.Random(3)
    alphabet = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    leis = ["", "  ", "7LTWFZYICNSX8D621K86", "7ltwfzyicnsx8d621k86", "INVALIDLEI12345", "Z" * 20,
            "0" * 20, " 7LTWFZYICNSX8D621K86", "7LTWFZYICNSX8D621K86\n", "5299-0ODI3047E2LIV03"]
    for _ in range(300):
        body = "".join(rng.choice(alphabet) for _ in range(18))
        number = int("".join(str(int(c, 36)) for c in body)) * 100
        leis += [f"{body}{98 - number % 97:02d}", "".join(rng.choice(alphabet) for _ in range(20))]
    rows = [(i, v) for i, v in enumerate(leis)]
    df = spark.createDataFrame(rows, "i int, lei string").withColumn(
        "digits", validate.lei_digits("lei")
    )
    got = df.select("i", validate.lei_status("lei", "digits").alias("r")).orderBy("i")
    assert [r.r for r in got.collect()] == [plain_lei(lei) for lei in leis]


def test_emails(spark):
    emails = {"a@b.co": True, "a.b+c%d-e_f@x-y.example.org": True, "bad@": False, "": False,
              "a@b.c": False, "a b@c.de": False, "a@b.co ": False, "é@b.co": False}
    assert apply(spark, lambda c: F.expr(validate.email_valid(c)), emails) == list(emails.values())


def test_entity_types(spark):
    kinds = {"bank": "CREDIT_INSTITUTION", "Fund": "INVESTMENT_FUND", "ICSD": "CSD", "csd": "CSD",
             "insurance": "INSURANCE_UNDERTAKING", "Corporate": "NON_FINANCIAL_CORPORATE",
             "Partnership": "Partnership", "": ""}
    assert apply(spark, validate.entity_type, kinds) == list(kinds.values())


def test_countries(spark):
    assert apply(spark, lambda c: F.expr(validate.country_known(c)), ["DE", "PA", "XX", "", "de"]) == [
        True, False, False, False, False,
    ]
    assert apply(spark, lambda c: F.expr(validate.country_format_valid(c)), ["DE", "XX", "d1", "DEU", "ÄÖ"]) == [
        True, True, False, False, False,
    ]


def test_dedup_key_encodings(spark):
    texts = {"müller&associés|LU|": "latin-1", "plain|DE|X": "ascii", "żółć|PL|": "utf-8"}
    expected = [hashlib.sha256(t.encode(e)).hexdigest() for t, e in texts.items()]
    assert apply(spark, keys.key_digest, texts) == expected


def test_trust_counts_bytes(spark):
    rows = [("é", "", "", "", ""), ("éa", "", "", "", ""), ("ééé", "DE", "x" * 20, "BANK", "SUSPENDED")]
    df = spark.createDataFrame(rows, "legal_name string, country string, lei string, entity_type string, status string")
    # 2 bytes, 3 bytes, 6 bytes
    assert [r[0] for r in df.select(trust_score()).collect()] == [0.0, 20.0, 25 + 15 + 25 + 15 + 5]


def test_risk_class_edges(spark):
    df = spark.createDataFrame([(s,) for s in (0, 24, 25, 49, 50, 79, 80)], "s int")
    assert [r[0] for r in df.select(risk_class("s")).collect()] == [
        "LOW", "LOW", "MEDIUM", "MEDIUM", "HIGH", "HIGH", "CRITICAL",
    ]


def party(spark, rows):
    return spark.createDataFrame(
        rows,
        "legal_name string, country string, entity_type string, status string, trust double,"
        " lei_format_valid boolean, country_format_valid boolean",
    )


def test_low_trust_penalty(spark):
    rows = [("n", "DE", "FUND", "ACTIVE", t, True, True) for t in (50.0, 49.0, 48.0, 0.0, None)]
    got = classify(party(spark, rows)).orderBy(F.desc_nulls_last("trust")).collect()
    assert [(r.risk_score, r.risk_factors) for r in got] == [
        (0, []),
        (0, ["LOW_TRUST_SCORE(+0)"]),
        (1, ["LOW_TRUST_SCORE(+1)"]),
        (25, ["LOW_TRUST_SCORE(+25)"]),
        (25, ["LOW_TRUST_SCORE(+25)"]),
    ]


def test_kyc_branches(spark):
    rows = [
        ("a", "KY", "CSD", "ACTIVE", 100.0, True, True),
        ("b", "DE", "CREDIT_INSTITUTION", "ACTIVE", 100.0, True, True),
        ("c", "DE", "CREDIT_INSTITUTION", "ACTIVE", 100.0, True, False),
        ("d", "PA", "CREDIT_INSTITUTION", "ACTIVE", 100.0, True, True),
        ("e", "DE", "SHELL_COMPANY", "ACTIVE", 100.0, True, True),
        ("OFFSHORE", "GB", "FUND", "ACTIVE", 100.0, True, True),
        ("offshore", "GB", "EXCHANGE", "SUSPENDED", 100.0, False, True),
    ]
    got = classify(party(spark, rows)).collect()
    assert [r.kyc_level for r in got] == [
        "SIMPLIFIED", "STANDARD", "STANDARD", "ENHANCED", "ENHANCED", "STANDARD", "STANDARD",
    ]
    assert got[1].kyc_reason.startswith("EU credit") and got[2].kyc_reason.startswith("Default")
    assert got[5].sanctions_flags == []
    assert got[6].sanctions_flags == [
        "REVIEW:SUSPENDED_STATUS", "REVIEW:NAME_CONTAINS_OFFSHORE", "ALERT:SUSPENDED_EXCHANGE",
    ]
    assert got[0].risk_factors == ["HIGH_RISK_COUNTRY(+40)"]


def lines(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_reparse_shifts_drops_and_overrides(spark):
    got = reparse(lines(spark, [
        "# comment", "PARTY_ID|x", "SKIP|x", "OTHER|1|2|3|4|5|6|7|8",
        "IDENTITY|P1|n||fp||T|lei_valid=true|country_valid=true|trust=60",  # two empty: 8 parts
        "IDENTITY|P2|n||fp|LEI|T|lei_valid=true|country_valid=true|trust=60",
        "IDENTITY|P3|n|DE|fp|LEI|T|status=SUSPENDED|country=KY|trust=1|trust=2|trust=",
        "IDENTITY|P4|n|DE|fp|LEI|T|a=b|trust=many",
        "IDENTITY|P5|n|DE|fp|LEI|T|a=b|c=d",
    ])).collect()
    assert [(r.party_id, r.country, r.fingerprint, r.entity_type, r.status, r.trust) for r in got] == [
        ("P2", "fp", "LEI", "lei_valid=true", "ACTIVE", 60.0),
        ("P3", "KY", "fp", "T", "SUSPENDED", 2.0),
        ("P4", "DE", "fp", "T", "ACTIVE", None),
        ("P5", "DE", "fp", "T", "ACTIVE", 0.0),
    ]


def test_lines_by_position(spark):
    got = parse_identity_lines(lines(spark, [
        "IDENTITY|P1|n||fp||T|lei_valid=true|country_valid=true|trust=60",
        "IDENTITY|P2|n||fp||T|x|y|trust=oops", "IDENTITY|P3|n||fp||T|x|y|60", "IDENTITY|P4|short",
        "#IDENTITY|P5|n||fp||T|x|y|trust=1", "OTHER|P6|n||fp||T|x|y|trust=1",
    ])).collect()
    assert [tuple(r) for r in got] == [("P1", "fp", 60.0), ("P2", "fp", 0.0), ("P3", "fp", 0.0)]
    got = parse_classified_lines(lines(spark, [
        "PARTY_ID|LEGAL_NAME|C|F|KYC_LEVEL|R|RISK_SCORE|RISK_CLASS", "P1|n|c|f|K|r|70|HIGH|x",
        "P2|n|c|f|K|r|seven|LOW", "P3|n|c|f|K|r|7", "P4|n|c|f|K|r|+5|LOW",
    ])).collect()
    assert [tuple(r) for r in got] == [
        ("P1", "K", 70, "HIGH"), ("P2", "K", 0, "LOW"), ("P4", "K", 5, "LOW"),
    ]


CLEANSED_COLUMNS = (
    "id string, legal_name string, country string, lei string, entity_type string,"
    " incorporation_date string, status string, address string, contact_email string,"
    " annual_revenue_eur string, lei_valid long, lei_status string, email_valid long,"
    " country_valid long, dedup_key string, source_file string, cleansing_notes string"
)


def cleansed_rows(spark, *rows):
    base = dict(zip(
        [c.strip().split(" ")[0] for c in CLEANSED_COLUMNS.split(",")],
        ["P", "n", "DE", "L", "T", "", "ACTIVE", "a", "e", "5", 1, "OK", 1, 1, "k", "f", "clean"],
    ))
    return spark.createDataFrame([tuple({**base, **r}.values()) for r in rows], CLEANSED_COLUMNS)


def test_missing_markers_and_anomalies(spark):
    table = quality.typed(cleansed_rows(
        spark,
        {"id": "", "legal_name": "N/A", "country": "NA"},
        {"id": "B", "legal_name": " \t", "country": "null", "annual_revenue_eur": "abc"},
        {"id": "C", "lei": "MISSING", "lei_valid": 0, "annual_revenue_eur": "0.0"},
        {"id": "D", "annual_revenue_eur": "100000000000"},
        {"id": "E", "annual_revenue_eur": "100000000000.5", "cleansing_notes": "DUPLICATE:matches_HIGH_RISK"},
    ))
    got = quality.anomalies(table).orderBy("party_id", "position").collect()
    assert [(r.party_id, r.type) for r in got] == [
        ("B", "MISSING_NAME"), ("B", "MISSING_COUNTRY"), ("C", "MISSING_LEI"), ("C", "ZERO_REVENUE"),
        ("E", "EXTREME_REVENUE"), ("E", "DUPLICATE_RECORD"), ("E", "HIGH_RISK_FLAG"),
        ("UNKNOWN", "MISSING_NAME"), ("UNKNOWN", "MISSING_COUNTRY"),
    ]
    counts = quality.severity_counts(table).first()
    assert tuple(counts) == (1, 5, 2, 1, 9)
    assert quality.field_profile(table).filter("field_name = 'annual_revenue_eur'").first().present == 4


def test_revenue_counts_as_number_in_profile(spark):
    table = quality.typed(cleansed_rows(spark, {"annual_revenue_eur": "5"}, {"annual_revenue_eur": "5.0"}))
    row = quality.field_profile(table).filter("field_name = 'annual_revenue_eur'").first()
    assert (row.unique_values, row.uniqueness_pct) == (1, 50.0)


def test_empty_table(spark):
    table = quality.typed(cleansed_rows(spark, {}).filter("false"))
    row = quality.quality_score(table).first()
    assert (row.total_records, row.quality_score, row.anomalies) == (0, None, 0)
    assert quality.severity_counts(table).first().total == 0
    assert quality.field_profile(table).count() == 0


@pytest.mark.parametrize("score, band", [(80.0, "GOOD"), (79.9, "FAIR"), (60.0, "FAIR"), (59.9, "POOR")])
def test_score_bands(spark, score, band):
    assert spark.range(1).select(quality.score_band(F.lit(score))).first()[0] == band


def test_bands(spark):
    pct = spark.createDataFrame([(v,) for v in (90.0, 89.9, 70.0, 69.9)], "v double")
    assert [r[0] for r in pct.select(quality.field_band(F.col("v"))).collect()] == ["GOOD", "FAIR", "FAIR", "POOR"]
    trust = spark.createDataFrame([(v,) for v in (80.0, 79.0, 50.0, 49.0, None)], "v double")
    assert [r[0] for r in trust.select(quality.trust_band(F.col("v"))).collect()] == ["high", "medium", "medium", "low", "low"]
    assert apply(spark, lambda c: quality.shown_risk_class(F.col(c)), ["HIGH", "", None]) == ["HIGH", "UNKNOWN", "UNKNOWN"]


def test_rules_are_read_anew(spark, tmp_path):
    path = str(tmp_path / "rules")
    default_rule_document(spark).coalesce(1).write.json(path)
    same = read_rules(spark, path)
    assert sorted(same.tiers.collect()) == sorted(default_rules(spark).tiers.collect())
    assert same.thresholds == default_rules(spark).thresholds
    (tmp_path / "own.json").write_text(
        '{"version": "2", "effective_date": "2026-01-01",\n "jurisdiction_tiers": {"TIER_1": ["DE"], "TIER_9": ["DE", "XX"]},'
        '\n "thresholds": {"suspicious_revenue_max": 5}, "regulatory_frameworks": {"FUND": ["UCITS"]}}'
    )
    own = read_rules(spark, str(tmp_path / "own.json"))
    parties = spark.createDataFrame([("1", "DE", "FUND"), ("2", "FR", "CSD")], "id string, country string, entity_type string")
    assert {r.id: r.tier for r in with_tier(parties, own).collect()} == {"1": "TIER_9", "2": None}
    assert [tuple(r) for r in framework_rows(parties, own).collect()] == [("1", "FUND", 0, "UCITS")]
    bands = spark.createDataFrame([(v,) for v in (None, 1e9, 5.0, 6.0, 0.0, -1.0)], "v double")
    got = [r[0] for r in bands.select(revenue_band(F.col("v"), own.thresholds)).collect()]
    assert got == ["UNKNOWN", "HIGH_VALUE", "SUSPICIOUS", "NORMAL", "SUSPICIOUS", "NORMAL"]


def test_search_needs_a_text(spark):
    view = spark.createDataFrame(
        [("1", "Müller AG", "DE", "", "", "", "", "", 0, "", 0.0)],
        "id string, legal_name string, country string, lei string, entity_type string, status string,"
        " fingerprint string, kyc_level string, risk_score int, risk_class string, trust double",
    )
    assert name_search(view, "MÜLL").count() == 1 and name_search(view, "x").count() == 0
    assert explore(view, "  ").count() == 1 and explore(view, " müller ").count() == 1
    assert party_lookup(view, "1").count() == 1 and party_lookup(view, "2").count() == 0
    for call in (lambda: name_search(view, ""), lambda: party_lookup(view, "")):
        with pytest.raises(ValueError):
            call()
