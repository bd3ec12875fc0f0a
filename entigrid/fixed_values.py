"""Fixed values.

Word lists, code lists, patterns, labels and thresholds that decide the results.
They are data, not tuning: changing one changes what the engine reports.
"""

# Record layout -------------------------------------------------

RAW_FIELDS = [
    "id", "legal_name", "country", "lei", "entity_type", "incorporation_date",
    "status", "address", "contact_email", "annual_revenue_eur",
]

CLEANSED_FIELDS = RAW_FIELDS + [
    "lei_valid", "lei_status", "email_valid", "country_valid",
    "dedup_key", "source_file", "cleansing_notes",
]

VIEW_FIELDS = [
    "id", "legal_name", "country", "lei", "entity_type", "status",
    "fingerprint", "kyc_level", "risk_score", "risk_class", "trust",
]

PROFILED_FIELDS = [
    "id", "legal_name", "country", "lei", "entity_type",
    "status", "address", "contact_email", "annual_revenue_eur",
]

CLASSIFIED_HEADER = [
    "PARTY_ID", "LEGAL_NAME", "COUNTRY", "FINGERPRINT", "KYC_LEVEL", "KYC_REASON",
    "RISK_SCORE", "RISK_CLASS", "RISK_FACTORS", "OBLIGATIONS", "SANCTIONS_FLAGS",
]

MISSING_MARKERS = ["", "NA", "N/A", "null"]

# Cleansing -----------------------------------------------------

# Ordered (pattern, replacement) pairs, case-insensitive; the dotted ones come first.
DOTTED_NAME_RULES = [
    (r"\bS\.A\.\s*", "SA "),
    (r"\bS\.A\./N\.V\.", "SA/NV"),
    (r"\bN\.V\.\s*", "NV "),
    (r"\bA\.G\.\s*", "AG "),
]
NAME_RULES = [
    (r"\bGmbH\b", "GmbH"),
    (r"\bLtd\.?\b", "Ltd"),
    (r"\bLimited\b", "Ltd"),
    (r"\bP\.?L\.?C\.?\b", "PLC"),
    (r"\bInc\.?\b", "Inc"),
    (r"\bCorp\.?\b", "Corp"),
    (r"\bAbp\.?\b", "Abp"),
]
# Found in every name that one of the rules above can match.
NAME_RULE_HINT = r"\b(?:S\.A|N\.V|A\.G|GmbH|Ltd|Limited|P\.?L\.?C|Inc|Corp|Abp)"

ADDRESS_RULES = [
    (r"\bStr\.\s*", "Street "),
    (r"\bBlvd\.?\s*", "Boulevard "),
    (r"\bAve\.?\s*", "Avenue "),
]

LEI_PATTERN = r"^[A-Z0-9]{20}\z"
LEI_FORMAT_PATTERN = r"^[A-Za-z0-9]{20}\z"
COUNTRY_FORMAT_PATTERN = r"^[A-Z]{2}\z"
EMAIL_PATTERN = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}\z"

KNOWN_COUNTRIES = [
    "AT", "BE", "BG", "CY", "CZ", "DE", "DK", "EE", "ES", "FI", "FR", "GR", "HR", "HU", "IE",
    "IT", "LT", "LU", "LV", "MT", "NL", "PL", "PT", "RO", "SE", "SI", "SK",
    "GB", "CH", "NO", "IS", "LI", "US", "CA", "JP", "AU", "SG", "HK",
    "KY", "BS", "BM", "VG", "JE", "GG", "IM",
]

INGEST_OFFSHORE = ["KY", "BS", "BM", "VG", "JE", "GG", "IM"]

# Looked up by the upper-cased type; a type not listed is kept as written.
ENTITY_TYPES = {
    "CREDIT_INSTITUTION": "CREDIT_INSTITUTION",
    "BANK": "CREDIT_INSTITUTION",
    "INVESTMENT_FIRM": "INVESTMENT_FIRM",
    "FUND": "INVESTMENT_FUND",
    "INVESTMENT_FUND": "INVESTMENT_FUND",
    "CSD": "CSD",
    "ICSD": "CSD",
    "EXCHANGE": "EXCHANGE",
    "SHELL_COMPANY": "SHELL_COMPANY",
    "INSURANCE": "INSURANCE_UNDERTAKING",
    "CORPORATE": "NON_FINANCIAL_CORPORATE",
}

# Trust score ---------------------------------------------------

TRUST_NAME_OVER_2_BYTES = 20
TRUST_NAME_OVER_5_BYTES = 5
TRUST_COUNTRY_FORMAT = 15
TRUST_LEI_FORMAT = 25
TRUST_ENTITY_TYPE = 15
TRUST_STATUS = {"ACTIVE": 20, "SUSPENDED": 5}

# Classification ------------------------------------------------

EU_MEMBERS = [
    "DE", "FR", "BE", "NL", "LU", "IT", "ES", "PT", "AT", "FI", "IE", "GR", "SE", "DK",
    "PL", "CZ", "HU", "RO", "BG", "HR", "SI", "SK", "LT", "LV", "EE", "CY", "MT",
]
CRS_EXEMPT = ["DE", "FR", "BE", "NL", "LU", "IT", "ES", "PT", "AT", "FI", "IE", "GR"]
KYC_OFFSHORE = ["KY", "BS", "BM", "VG", "JE", "GG", "IM", "PA"]

KYC_CSD = ("SIMPLIFIED", "Regulated FMI — simplified due diligence per MiFID II Art. 13")
KYC_EU_BANK = ("STANDARD", "EU credit institution — standard CDD")
KYC_OFFSHORE_PARTY = ("ENHANCED", "Offshore jurisdiction — enhanced due diligence required")
KYC_SHELL = ("ENHANCED", "Shell company classification — enhanced due diligence mandatory")
KYC_DEFAULT = ("STANDARD", "Default classification")

RISK_NO_LEI = 30
RISK_COUNTRY = {"KY": 40, "BS": 40, "BM": 35, "VG": 45, "PA": 50}
RISK_SHELL = 50
RISK_SUSPENDED = 40
RISK_TRUST_FLOOR = 50
RISK_CLASSES = [(80, "CRITICAL"), (50, "HIGH"), (25, "MEDIUM")]
RISK_CLASS_ELSE = "LOW"
HIGH_RISK_CLASSES = ["HIGH", "CRITICAL"]

# Rule tables (defaults; a run may bring its own) ----------------

JURISDICTION_TIERS = {
    "TIER_1": ["DE", "FR", "BE", "NL", "LU", "FI", "AT", "IE"],
    "TIER_2": ["GB", "CH", "US", "CA", "JP", "AU", "SG", "HK"],
    "TIER_3": ["KY", "BS", "BM", "VG", "JE", "GG", "IM", "PA"],
}
REGULATORY_FRAMEWORKS = {
    "CREDIT_INSTITUTION": ["CRD_V", "MiFID_II", "EMIR", "AMLD_VI"],
    "INVESTMENT_FIRM": ["MiFID_II", "EMIR", "AMLD_VI"],
    "CSD": ["CSDR", "EMIR", "SFTR"],
    "EXCHANGE": ["MiFID_II", "MAR", "EMIR"],
    "SHELL_COMPANY": ["AMLD_VI", "DAC_6"],
}
REVENUE_THRESHOLDS = {
    "high_value_entity_eur": 1_000_000_000,
    "suspicious_revenue_min": 0,
    "suspicious_revenue_max": 1_000,
}
RULES_VERSION = "1.0.0"
RULES_EFFECTIVE_DATE = "2025-03-24"

# Quality -------------------------------------------------------

SEVERITIES = ["CRITICAL", "HIGH", "MEDIUM", "LOW"]
EXTREME_REVENUE_EUR = 100_000_000_000
QUALITY_WEIGHTS = {"completeness": 0.4, "validity": 0.3, "anomaly": 30}
SCORE_BANDS = [(80, "GOOD"), (60, "FAIR")]
SCORE_BAND_ELSE = "POOR"
FIELD_BANDS = [(90, "GOOD"), (70, "FAIR")]
TRUST_BANDS = [(80, "high"), (50, "medium")]
TRUST_BAND_ELSE = "low"

# Stream alerts -------------------------------------------------

ALERT_THRESHOLD = 70
