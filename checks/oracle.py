"""The catalog's queries once more, as SQL for DuckDB over the same tables.

Written from the definitions, not from the Spark code: windows instead of grouped joins,
UNION ALL instead of generators, lists instead of unrolled arithmetic.
"""

from __future__ import annotations

FEED = """
base AS (
  SELECT 'C' AS pfx, c_custkey AS k, 'customer' AS source_file, 0 AS source_rank FROM customer
  UNION ALL
  SELECT 'S' AS pfx, s_suppkey AS k, 'supplier' AS source_file, 1 AS source_rank FROM supplier
), keyed AS (
  SELECT *, CASE WHEN k % 10 = 8 THEN k - 7 ELSE k END AS ck FROM base
), named AS (
  SELECT *, CASE WHEN pfx = 'C' THEN 'Customer#' ELSE 'Supplier#' END || lpad(CAST(ck AS VARCHAR(20)), 9, '0') AS nm,
         'AB' || lpad(CAST(ck AS VARCHAR(20)), 16, '0') AS lei_body,
         98 - ((60 + ck * 100) % 97) AS lei_chk
  FROM keyed
), feed AS (
SELECT source_rank, source_file, k AS row_pos,
  pfx || lpad(CAST(k AS VARCHAR(20)), 9, '0') AS id,
  CASE WHEN k % 50 = 49 THEN '  '
       WHEN ck % 10 = 0 THEN '  ' || nm || '   Trading S.A. '
       WHEN ck % 10 = 1 THEN nm || ' Limited'
       WHEN ck % 10 = 2 THEN nm || ' P.L.C.'
       WHEN ck % 10 = 3 THEN nm || ' Holding N.V.'
       WHEN ck % 10 = 4 THEN nm || ' GMBH'
       WHEN ck % 10 = 5 THEN nm || ' Offshore Holdings'
       WHEN ck % 20 = 16 THEN ''
       WHEN ck % 10 = 7 THEN nm || ' A.G. Zürich'
       ELSE nm || ' Inc.' END AS legal_name,
  CASE WHEN k % 50 = 49 THEN ''
       WHEN ck % 12 = 0 THEN 'DE' WHEN ck % 12 = 1 THEN 'fr' WHEN ck % 12 = 2 THEN 'KY' WHEN ck % 12 = 3 THEN 'LU'
       WHEN ck % 12 = 4 THEN ''   WHEN ck % 12 = 5 THEN 'BS' WHEN ck % 12 = 6 THEN 'GB' WHEN ck % 12 = 7 THEN 'XX'
       WHEN ck % 12 = 8 THEN 'JE' WHEN ck % 12 = 9 THEN 'BM' WHEN ck % 12 = 10 THEN 'VG' ELSE 'PA' END AS country,
  CASE WHEN k % 50 = 49 THEN ''
       WHEN ck % 9 = 3 THEN lei_body || lpad(CAST((lei_chk % 97) + 1 AS VARCHAR(20)), 2, '0')
       WHEN ck % 9 = 5 THEN lower(lei_body) || '00'
       WHEN ck % 9 = 7 THEN ''
       ELSE lei_body || lpad(CAST(lei_chk AS VARCHAR(20)), 2, '0') END AS lei,
  CASE ck % 10 WHEN 0 THEN 'bank' WHEN 1 THEN 'CREDIT_INSTITUTION' WHEN 2 THEN 'INVESTMENT_FIRM' WHEN 3 THEN 'FUND'
       WHEN 4 THEN 'ICSD' WHEN 5 THEN 'EXCHANGE' WHEN 6 THEN 'SHELL_COMPANY' WHEN 7 THEN 'Insurance'
       ELSE 'PARTNERSHIP' END AS entity_type,
  '2001-02-03' AS incorporation_date,
  CASE WHEN k % 13 = 0 THEN 'SUSPENDED' WHEN k % 13 = 5 THEN '' ELSE 'ACTIVE' END AS status,
  CASE k % 5 WHEN 0 THEN '12 Baker Str. ' || CAST(k AS VARCHAR(20)) WHEN 1 THEN CAST(k AS VARCHAR(20)) || ' Ave. Foch'
       WHEN 2 THEN '"5th  Blvd"' WHEN 3 THEN '' ELSE '1 Main Street' END AS address,
  CASE k % 4 WHEN 0 THEN 'u' || CAST(k AS VARCHAR(20)) || '@ex.com' WHEN 1 THEN 'bad@' WHEN 2 THEN ''
       ELSE 'a.b+' || CAST(k AS VARCHAR(20)) || '@sub.example.org' END AS contact_email,
  CASE k % 6 WHEN 0 THEN '0' WHEN 1 THEN '250000000000' WHEN 2 THEN '' ELSE CAST(k * 1000 AS VARCHAR(20)) END AS annual_revenue_eur
FROM named
)
"""


def _chain(expression: str, steps: list[tuple[str, str]]) -> str:
    for pattern, replacement in steps:
        expression = f"regexp_replace({expression}, '{pattern}', '{replacement}', 'gi')"
    return expression


def _name(expression: str) -> str:
    return _chain(expression, [
        (r"^\s+|\s+$", ""), (r"\s{2,}", " "),
        (r"\bS\.A\.\s*", "SA "), (r"\bS\.A\./N\.V\.", "SA/NV"), (r"\bN\.V\.\s*", "NV "),
        (r"\bA\.G\.\s*", "AG "), (r"\bGmbH\b", "GmbH"), (r"\bLtd\.?\b", "Ltd"),
        (r"\bLimited\b", "Ltd"), (r"\bP\.?L\.?C\.?\b", "PLC"), (r"\bInc\.?\b", "Inc"),
        (r"\bCorp\.?\b", "Corp"), (r"\bAbp\.?\b", "Abp"), (r"\s+$", ""),
    ])


def _address(expression: str) -> str:
    return _chain(expression, [
        (r"^\s+|\s+$", ""), (r"""^["'']|["'']$""", ""), (r"\s{2,}", " "),
        (r"\bStr\.\s*", "Street "), (r"\bBlvd\.?\s*", "Boulevard "), (r"\bAve\.?\s*", "Avenue "),
    ])


# ü is one byte in Latin-1; no other letter of the derived names is outside ASCII.
CLEANSED = FEED + rf""",
accepted AS (
  SELECT * FROM feed
  WHERE regexp_matches(legal_name, '\S') OR regexp_matches(country, '\S') OR regexp_matches(lei, '\S')
), cleaned AS (
  SELECT *, {_name("legal_name")} AS clean_name, {_address("address")} AS clean_address,
    upper(country) AS clean_country,
    CASE upper(entity_type)
      WHEN 'BANK' THEN 'CREDIT_INSTITUTION' WHEN 'CREDIT_INSTITUTION' THEN 'CREDIT_INSTITUTION'
      WHEN 'INVESTMENT_FIRM' THEN 'INVESTMENT_FIRM' WHEN 'FUND' THEN 'INVESTMENT_FUND'
      WHEN 'INVESTMENT_FUND' THEN 'INVESTMENT_FUND' WHEN 'CSD' THEN 'CSD' WHEN 'ICSD' THEN 'CSD'
      WHEN 'EXCHANGE' THEN 'EXCHANGE' WHEN 'SHELL_COMPANY' THEN 'SHELL_COMPANY'
      WHEN 'INSURANCE' THEN 'INSURANCE_UNDERTAKING' WHEN 'CORPORATE' THEN 'NON_FINANCIAL_CORPORATE'
      ELSE entity_type END AS clean_type,
    CASE WHEN NOT regexp_matches(lei, '\S') THEN 'MISSING'
         WHEN NOT regexp_full_match(lei, '[A-Z0-9]{{20}}') THEN 'INVALID_FORMAT'
         WHEN list_reduce(
           list_prepend(0, list_transform(string_split(lei, ''),
             lambda c: CASE WHEN c BETWEEN '0' AND '9' THEN ascii(c) - 48 ELSE ascii(c) - 55 END)),
           lambda a, v: CASE WHEN v >= 10 THEN (a * 100 + v) % 97 ELSE (a * 10 + v) % 97 END) <> 1
         THEN 'CHECKSUM_FAIL'
         ELSE 'OK' END AS lei_status,
    CASE WHEN regexp_full_match(contact_email, '[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{{2,}}')
         THEN 1 ELSE 0 END::BIGINT AS email_valid
  FROM accepted
), keytext AS (
  SELECT *, regexp_replace(lower({_name("clean_name")}), '\s+', '', 'g')
    || '|' || upper(clean_country) || '|' || upper(lei) AS kt
  FROM cleaned
), hashed AS (
  SELECT *,
    CASE WHEN contains(kt, 'ü')
         THEN sha256(encode(split_part(kt, 'ü', 1)) || '\xFC'::BLOB || encode(split_part(kt, 'ü', 2)))
         ELSE sha256(kt) END AS full_key
  FROM keytext
), n AS (
  SELECT source_rank, row_pos, source_file, id, clean_name AS legal_name, clean_country AS country, lei,
    clean_type AS entity_type, incorporation_date, status, clean_address AS address, contact_email,
    annual_revenue_eur, lei_status, email_valid, full_key,
    CASE WHEN lei_status = 'OK' THEN 1 ELSE 0 END::BIGINT AS lei_valid,
    CASE WHEN clean_country IN (
      'AT','BE','BG','CY','CZ','DE','DK','EE','ES','FI','FR','GR','HR','HU','IE','IT','LT','LU','LV',
      'MT','NL','PL','PT','RO','SE','SI','SK','GB','CH','NO','IS','LI','US','CA','JP','AU','SG','HK',
      'KY','BS','BM','VG','JE','GG','IM') THEN 1 ELSE 0 END::BIGINT AS country_valid,
    clean_name <> legal_name AND regexp_matches(legal_name, '\S') AS name_changed,
    clean_address <> address AND regexp_matches(address, '\S') AS address_changed,
    clean_type <> entity_type AND regexp_matches(entity_type, '\S') AS type_changed
  FROM hashed
), flagged AS (
  SELECT *,
    CASE WHEN row_number() OVER w > 1 THEN first_value(id) OVER w END AS duplicate_of,
    concat_ws(';',
      CASE WHEN entity_type = 'SHELL_COMPANY' THEN 'HIGH_RISK:shell_company' END,
      CASE WHEN status = 'SUSPENDED' THEN 'HIGH_RISK:suspended_entity' END,
      CASE WHEN country IN ('KY','BS','BM','VG','JE','GG','IM') AND lei_valid = 0
           THEN 'HIGH_RISK:offshore_no_lei' END) AS flags
  FROM n WINDOW w AS (PARTITION BY full_key ORDER BY source_rank, row_pos)
), c AS (
  SELECT * EXCLUDE (full_key), substr(full_key, 1, 16) AS dedup_key,
    coalesce(nullif(concat_ws(';',
      CASE WHEN name_changed THEN 'name_normalized' END,
      CASE WHEN address_changed THEN 'address_normalized' END,
      CASE WHEN country_valid = 0 THEN 'country_invalid_or_missing' END,
      CASE WHEN type_changed THEN 'entity_type_normalized' END,
      CASE WHEN lei_valid = 0 THEN 'lei_' || lei_status END,
      nullif(flags, ''),
      'DUPLICATE:matches_' || duplicate_of), ''), 'clean') AS cleansing_notes
  FROM flagged
)
"""

_COLUMNS_17 = """id, legal_name, country, lei, entity_type, incorporation_date, status, address,
  contact_email, annual_revenue_eur, lei_valid, lei_status, email_valid, country_valid,
  dedup_key, source_file, cleansing_notes"""


def _identity(source: str, prefix: str = "") -> str:
    """CTEs ``ident`` and ``cl`` (classified) over a table of normalized parties."""
    return f""",
{prefix}ident AS (
  SELECT *, sha256(legal_name || '|' || country || '|' || lei || '|' || entity_type) AS fingerprint,
    regexp_full_match(lei, '[A-Za-z0-9]{{20}}') AS lei_format_valid,
    regexp_full_match(country, '[A-Z]{{2}}') AS country_format_valid,
    (CASE WHEN strlen(legal_name) > 2 THEN 20 ELSE 0 END
     + CASE WHEN strlen(legal_name) > 5 THEN 5 ELSE 0 END
     + CASE WHEN regexp_full_match(country, '[A-Z]{{2}}') THEN 15 ELSE 0 END
     + CASE WHEN regexp_full_match(lei, '[A-Za-z0-9]{{20}}') THEN 25 ELSE 0 END
     + CASE WHEN entity_type <> '' THEN 15 ELSE 0 END
     + CASE status WHEN 'ACTIVE' THEN 20 WHEN 'SUSPENDED' THEN 5 ELSE 0 END)::DOUBLE AS trust
  FROM {source} WHERE legal_name <> '' OR country <> ''
)"""


# Fixed values of the BLAKE3 specification.
_BLAKE3_IV = [0x6A09E667, 0xBB67AE85, 0x3C6EF372, 0xA54FF53A, 0x510E527F, 0x9B05688C, 0x1F83D9AB, 0x5BE0CD19]
_BLAKE3_ORDER = [2, 6, 3, 10, 7, 0, 4, 13, 1, 11, 12, 5, 9, 14, 15, 8]
_BLAKE3_QUARTERS = [
    (0, 4, 8, 12), (1, 5, 9, 13), (2, 6, 10, 14), (3, 7, 11, 15),
    (0, 5, 10, 15), (1, 6, 11, 12), (2, 7, 8, 13), (3, 4, 9, 14),
]


def _blake3(source: str, key: str, text: str) -> str:
    """CTEs up to ``blake3(key, digest)`` for texts of at most 1,024 bytes, which are one chunk.

    A recursion takes each text through its blocks and the 56 quarter rounds of each, one a step.
    Numbers are 64 bits wide and cut to 32.
    """

    def turned(value: str, bits: int) -> str:
        return f"((({value}) >> {bits}) | ((({value}) << {32 - bits}) & 4294967295))"

    steps, schedule = [], list(range(16))
    for _ in range(7):
        for i, quarter in enumerate(_BLAKE3_QUARTERS):
            steps.append((len(steps), *(q + 1 for q in quarter), schedule[2 * i] + 1, schedule[2 * i + 1] + 1))
        schedule = [schedule[p] for p in _BLAKE3_ORDER]
    iv = ", ".join(map(str, _BLAKE3_IV))
    byte = "substr(h, 128 * block + 8 * j + {}, 2)"
    word = f"('0x' || {' || '.join(byte.format(at) for at in (7, 5, 3, 1))})::BIGINT"
    flags = "(CASE WHEN {block} = 0 THEN 1 ELSE 0 END + CASE WHEN {block} + 1 = blocks THEN 10 ELSE 0 END)"
    first = "list_concat({chain}, [" + ", ".join(map(str, _BLAKE3_IV[:4])) + ", 0, 0, least(64, size - 64 * ({block})), " + flags + "])"
    changed = "CASE i WHEN a THEN va2 WHEN b THEN vb2 WHEN c THEN vc2 WHEN d THEN vd2 ELSE v[i] END"
    bytes_out = " || ".join(f"printf('%02x', (w >> {shift}) & 255)" for shift in (0, 8, 16, 24))
    return f""",
b3_steps(step, a, b, c, d, x, y) AS (VALUES {", ".join(map(str, steps))}),
b3_texts AS (
  SELECT {key} AS key, octet_length(encode({text})) AS size, greatest(1, (octet_length(encode({text})) + 63) // 64) AS blocks,
    rpad(hex(encode({text})), (128 * greatest(1, (octet_length(encode({text})) + 63) // 64))::INT, '0') AS h FROM {source}
), b3_blocks AS (
  SELECT key, block, list_transform(range(0, 16), lambda j: {word}) AS m FROM (SELECT *, unnest(range(0, blocks)) AS block FROM b3_texts)
), b3_run AS (
  SELECT key, size, blocks, 0::BIGINT AS block, 0 AS step, [{iv}]::BIGINT[] AS chain, {first.format(chain=f"[{iv}]::BIGINT[]", block="0")}::BIGINT[] AS v
  FROM b3_texts
  UNION ALL (
  SELECT key, size, blocks, block, step + 1, chain, list_transform(range(1, 17), lambda i: {changed}) FROM (
    SELECT *, {turned("xor(vb1, vc2)", 7)} AS vb2 FROM (
      SELECT *, (vc1 + vd2) & 4294967295 AS vc2 FROM (
        SELECT *, {turned("xor(vd1, va2)", 8)} AS vd2 FROM (
          SELECT *, (va1 + vb1 + m[y]) & 4294967295 AS va2 FROM (
            SELECT *, {turned("xor(v[b], vc1)", 12)} AS vb1 FROM (
              SELECT *, (v[c] + vd1) & 4294967295 AS vc1 FROM (
                SELECT *, {turned("xor(v[d], va1)", 16)} AS vd1 FROM (
                  SELECT r.*, s.a, s.b, s.c, s.d, s.y, k.m, (v[s.a] + v[s.b] + k.m[s.x]) & 4294967295 AS va1
                  FROM b3_run r JOIN b3_steps s ON s.step = r.step JOIN b3_blocks k ON k.key = r.key AND k.block = r.block
  ))))))))
  UNION ALL
  SELECT key, size, blocks, block + 1, 0, chained, {first.format(chain="chained", block="block + 1").replace("{block}", "block + 1")} FROM (
    SELECT *, list_transform(range(1, 9), lambda i: xor(v[i], v[i + 8])) AS chained FROM b3_run WHERE step = 56 AND block + 1 < blocks
  ))
), blake3 AS (
  SELECT key, list_reduce(list_transform(list_transform(range(1, 9), lambda i: xor(v[i], v[i + 8])), lambda w: {bytes_out}), lambda p, q: p || q) AS digest
  FROM b3_run WHERE step = 56 AND block + 1 = blocks
)"""


def _rules(source: str, target: str, lei_ok: str, country_ok: str, status: str) -> str:
    """CTE with the classification of a table of identities."""
    eu = """'DE','FR','BE','NL','LU','IT','ES','PT','AT','FI','IE','GR','SE','DK','PL','CZ','HU',
      'RO','BG','HR','SI','SK','LT','LV','EE','CY','MT'"""
    return f""",
{target}_points AS (
  SELECT *,
    CASE WHEN {lei_ok} THEN 0 ELSE 30 END AS p_lei,
    CASE country WHEN 'KY' THEN 40 WHEN 'BS' THEN 40 WHEN 'BM' THEN 35 WHEN 'VG' THEN 45
      WHEN 'PA' THEN 50 ELSE 0 END AS p_country,
    CASE WHEN entity_type = 'SHELL_COMPANY' THEN 50 ELSE 0 END AS p_shell,
    CASE WHEN {status} = 'SUSPENDED' THEN 40 ELSE 0 END AS p_susp,
    CASE WHEN trust < 50 THEN floor((50 - trust) / 2)::INTEGER END AS p_trust
  FROM {source}
), {target} AS (
  SELECT *, (p_lei + p_country + p_shell + p_susp + coalesce(p_trust, 0))::BIGINT AS risk_score,
    CASE WHEN p_lei + p_country + p_shell + p_susp + coalesce(p_trust, 0) >= 80 THEN 'CRITICAL'
         WHEN p_lei + p_country + p_shell + p_susp + coalesce(p_trust, 0) >= 50 THEN 'HIGH'
         WHEN p_lei + p_country + p_shell + p_susp + coalesce(p_trust, 0) >= 25 THEN 'MEDIUM'
         ELSE 'LOW' END AS risk_class,
    coalesce(nullif(concat_ws(';',
      CASE WHEN p_lei > 0 THEN 'NO_VALID_LEI(+30)' END,
      CASE WHEN p_country > 0 THEN 'HIGH_RISK_COUNTRY(+' || p_country || ')' END,
      CASE WHEN p_shell > 0 THEN 'SHELL_COMPANY(+50)' END,
      CASE WHEN p_susp > 0 THEN 'SUSPENDED_ENTITY(+40)' END,
      CASE WHEN p_trust IS NOT NULL THEN 'LOW_TRUST_SCORE(+' || p_trust || ')' END), ''), 'NONE') AS risk_factors,
    coalesce(nullif(concat_ws(';',
      CASE WHEN entity_type IN ('CREDIT_INSTITUTION', 'INVESTMENT_FIRM') THEN 'EMIR_TR_REPORTING' END,
      CASE WHEN entity_type = 'CSD' THEN 'SFTR_REPORTING;CSDR_SETTLEMENT_DISCIPLINE' END,
      CASE WHEN p_lei > 0 THEN 'LEI_REQUIRED_MISSING' END,
      CASE WHEN country NOT IN ('DE','FR','BE','NL','LU','IT','ES','PT','AT','FI','IE','GR')
           THEN 'CRS_REPORTING' END), ''), 'NONE') AS obligations,
    coalesce(nullif(concat_ws(';',
      CASE WHEN {status} = 'SUSPENDED' THEN 'REVIEW:SUSPENDED_STATUS' END,
      CASE WHEN contains(legal_name, 'Offshore') OR contains(legal_name, 'offshore')
           THEN 'REVIEW:NAME_CONTAINS_OFFSHORE' END,
      CASE WHEN {status} = 'SUSPENDED' AND entity_type = 'EXCHANGE'
           THEN 'ALERT:SUSPENDED_EXCHANGE' END), ''), 'CLEAR') AS sanctions_flags,
    CASE WHEN entity_type = 'CSD' THEN 'SIMPLIFIED'
         WHEN entity_type = 'CREDIT_INSTITUTION' AND {country_ok} AND country IN ({eu}) THEN 'STANDARD'
         WHEN country IN ('KY','BS','BM','VG','JE','GG','IM','PA') THEN 'ENHANCED'
         WHEN entity_type = 'SHELL_COMPANY' THEN 'ENHANCED'
         ELSE 'STANDARD' END AS kyc_level,
    CASE WHEN entity_type = 'CSD' THEN 'Regulated FMI — simplified due diligence per MiFID II Art. 13'
         WHEN entity_type = 'CREDIT_INSTITUTION' AND {country_ok} AND country IN ({eu})
           THEN 'EU credit institution — standard CDD'
         WHEN country IN ('KY','BS','BM','VG','JE','GG','IM','PA')
           THEN 'Offshore jurisdiction — enhanced due diligence required'
         WHEN entity_type = 'SHELL_COMPANY'
           THEN 'Shell company classification — enhanced due diligence mandatory'
         ELSE 'Default classification' END AS kyc_reason
  FROM {target}_points
)"""


def _with(ctes: str, select: str) -> str:
    return f"WITH {ctes}\n{select}"


def _classified(source: str = "n", lei_ok: str = "lei_format_valid") -> str:
    return _identity(source) + _rules("ident", "cl", lei_ok, "country_format_valid", "status")


IDENT = CLEANSED + _identity("n")
CLASSIFIED = CLEANSED + _classified()

_LINE = """'IDENTITY|' || id || '|' || legal_name || '|' || country || '|' || fingerprint || '|' || lei
  || '|' || entity_type || '|lei_valid=' || lei_format_valid || '|country_valid=' || country_format_valid
  || '|trust=' || trust::INTEGER"""
_CLASSIFIED_11 = """legal_name, country, substr(fingerprint, 1, 16) || '...' AS fingerprint, kyc_level,
  kyc_reason, risk_score, risk_class, risk_factors, obligations, sanctions_flags"""
_CLASSIFIED_LINE = """id || '|' || legal_name || '|' || country || '|' || substr(fingerprint, 1, 16)
  || '...|' || kyc_level || '|' || kyc_reason || '|' || risk_score || '|' || risk_class || '|'
  || risk_factors || '|' || obligations || '|' || sanctions_flags"""

# Empty fields close up, so positions shift; no derived value has the form key=value.
WIRE = (
    IDENT
    + f""",
parts AS (
  SELECT list_filter(string_split({_LINE}, '|'), lambda x: x <> '') AS p FROM ident
), wired AS (
  SELECT p[2] AS party_id, p[3] AS legal_name, p[4] AS country, p[5] AS fingerprint, p[6] AS lei,
    p[7] AS entity_type, 'ACTIVE' AS status,
    CAST(split_part(list_extract(list_filter(p, lambda x: starts_with(x, 'trust=')), 1), '=', 2) AS DOUBLE) AS trust
  FROM parts WHERE len(p) >= 9
)"""
    + _rules("wired", "cl", "false", "false", "status")
)


def _typed(source: str) -> str:
    markers = "('', 'NA', 'N/A', 'null')"
    texts = [
        "id", "legal_name", "country", "lei", "entity_type", "incorporation_date", "status",
        "address", "contact_email", "lei_status", "dedup_key", "source_file", "cleansing_notes",
    ]
    columns = ",\n    ".join(f"CASE WHEN {c} NOT IN {markers} THEN {c} END AS {c}" for c in texts)
    return f""",
t AS (
  SELECT source_rank, row_pos, {columns},
    TRY_CAST(CASE WHEN annual_revenue_eur NOT IN {markers} THEN annual_revenue_eur END AS DOUBLE)
      AS annual_revenue_eur,
    lei_valid, email_valid, country_valid
  FROM {source}
)"""


TYPED = CLEANSED + _typed("c")

_FIELDS = [
    "id", "legal_name", "country", "lei", "entity_type", "status", "address", "contact_email",
    "annual_revenue_eur",
]


def _profile() -> str:
    parts = [
        f"""SELECT '{f}' AS field_name, count(*) AS total, count({f}) AS present,
  count(*) - count({f}) AS missing, count(DISTINCT {f}) AS unique_values,
  round(100.0 * count({f}) / count(*), 6) AS completeness_pct,
  round(CASE WHEN count({f}) = 0 THEN 0 ELSE 100.0 * count(DISTINCT {f}) / count({f}) END, 6) AS uniqueness_pct
FROM t"""
        for f in _FIELDS
    ]
    return "\nUNION ALL\n".join(parts)


def _distribution(field: str) -> str:
    return _with(TYPED, f'SELECT {field}, count(*) AS "count" FROM t WHERE {field} IS NOT NULL GROUP BY {field}')


ANOMALIES = TYPED + r""",
an AS (
  SELECT id, 0 AS position, 'MISSING_NAME' AS type, 'HIGH' AS severity, 'Party has no legal name' AS description
    FROM t WHERE legal_name IS NULL OR NOT regexp_matches(legal_name, '\S')
  UNION ALL SELECT id, 1, 'MISSING_COUNTRY', 'HIGH', 'Party has no country code'
    FROM t WHERE country IS NULL OR NOT regexp_matches(country, '\S')
  UNION ALL SELECT id, 2, 'INVALID_LEI', 'HIGH', 'LEI present but invalid: ' || lei
    FROM t WHERE lei_valid = 0 AND lei IS NOT NULL AND lei <> 'MISSING'
  UNION ALL SELECT id, 3, 'MISSING_LEI', 'MEDIUM', 'No LEI provided'
    FROM t WHERE lei_valid = 0 AND (lei IS NULL OR lei = 'MISSING')
  UNION ALL SELECT id, 4, 'ZERO_REVENUE', 'MEDIUM', 'Entity reports zero revenue'
    FROM t WHERE annual_revenue_eur = 0
  UNION ALL SELECT id, 5, 'EXTREME_REVENUE', 'LOW', 'Revenue exceeds €100B — verify'
    FROM t WHERE annual_revenue_eur > 100000000000
  UNION ALL SELECT id, 6, 'DUPLICATE_RECORD', 'HIGH', 'Potential duplicate: ' || cleansing_notes
    FROM t WHERE contains(cleansing_notes, 'DUPLICATE')
  UNION ALL SELECT id, 7, 'HIGH_RISK_FLAG', 'CRITICAL', 'High risk flag: ' || cleansing_notes
    FROM t WHERE contains(cleansing_notes, 'HIGH_RISK')
)"""

SCORED = ANOMALIES + f""",
sev AS (
  SELECT count(*) FILTER (severity = 'CRITICAL') AS critical, count(*) FILTER (severity = 'HIGH') AS high,
    count(*) FILTER (severity = 'MEDIUM') AS medium, count(*) FILTER (severity = 'LOW') AS low,
    count(*) AS total
  FROM an
), profile AS ({_profile()}
), score AS (
  SELECT (SELECT count(*) FROM t) AS total_records,
    round_even(least(100.0,
      0.4 * (SELECT avg(completeness_pct) FROM profile)
      + 0.3 * (SELECT 100.0 * (sum(lei_valid) + sum(country_valid)) / (2 * count(*)) FROM t)
      + 30 * greatest(0, 1 - (SELECT total FROM sev) / (SELECT count(*)::DOUBLE FROM t))), 1)::DOUBLE
      AS quality_score,
    sev.total AS anomalies, critical, high, medium, low
  FROM sev
)"""

# Records that share another party's key are later versions of that party.
_VERSION_ID = """substr(id, 1, 1)
  || lpad(CAST(CASE WHEN row_pos % 10 = 8 THEN row_pos - 7 ELSE row_pos END AS VARCHAR(20)), 9, '0')"""
VERSIONS = CLEANSED + f""",
v AS (SELECT * REPLACE ({_VERSION_ID} AS id) FROM n)"""
VIEW = (
    VERSIONS
    + _classified("v")
    + """,
latest AS (
  SELECT * FROM v QUALIFY row_number() OVER (PARTITION BY id ORDER BY source_rank DESC, row_pos DESC) = 1
), latest_cl AS (
  SELECT * FROM cl QUALIFY row_number() OVER (PARTITION BY id ORDER BY source_rank DESC, row_pos DESC) = 1
), mv AS (
  SELECT l.id, l.legal_name, l.country, l.lei, l.entity_type, l.status,
    coalesce(x.fingerprint, '') AS fingerprint, coalesce(x.kyc_level, '') AS kyc_level,
    coalesce(x.risk_score, 0) AS risk_score, coalesce(x.risk_class, '') AS risk_class,
    coalesce(x.trust, 0.0)::DOUBLE AS trust
  FROM latest l LEFT JOIN latest_cl x ON l.id = x.id
)"""
)
ALERTS = """SELECT id, risk_score, CASE WHEN risk_score >= 70 THEN 'ALERT' ELSE 'OK' END AS level,
  CASE WHEN risk_score >= 70 THEN 'ALERT: High-risk party ' || id || ' (' || legal_name || ') risk score ' || risk_score
       ELSE 'Party ' || id || ' risk score ' || risk_score || ' (ok)' END AS message
FROM mv"""

_TRUST_BAND = "CASE WHEN trust >= 80 THEN 'high' WHEN trust >= 50 THEN 'medium' ELSE 'low' END AS trust_band"

STATS = CLEANSED + """,
stats AS (
  SELECT 2::BIGINT AS files, (SELECT count(*) FROM feed) AS total, count(*) AS valid,
    count(*) FILTER (name_changed) AS cleansed,
    (SELECT count(*) FROM feed) - count(*) AS rejected, count(duplicate_of) AS duplicates,
    100.0 * count(*) / (SELECT count(*)::DOUBLE FROM feed) AS valid_pct
  FROM flagged
)"""


def _summary_lines() -> str:
    """The text summary: fixed labels, profile lines in field order, counts."""
    fixed = [
        (0, "'Party Data Quality Report'"),
        (2, "'Records Analyzed: ' || total_records"),
        (3, """printf('Overall quality score: %.1f / 100.0 %s', quality_score,
            CASE WHEN quality_score >= 80 THEN 'GOOD' WHEN quality_score >= 60 THEN 'FAIR' ELSE 'POOR' END)"""),
        (4, "'Completeness:'"),
        (14, "'Anomalies:'"),
        (15, "'CRITICAL: ' || critical"),
        (16, "'HIGH:     ' || high"),
        (17, "'MEDIUM:   ' || medium"),
        (18, "'LOW:      ' || low"),
        (19, "'TOTAL:    ' || anomalies"),
        (20, """'Countries: ' || (SELECT unique_values FROM profile WHERE field_name = 'country')
            || '  |  Entity Types: ' || (SELECT unique_values FROM profile WHERE field_name = 'entity_type')
            || '  |  Statuses: ' || (SELECT unique_values FROM profile WHERE field_name = 'status')"""),
    ]
    rows = [f"SELECT {line}::BIGINT AS line, {value} AS value FROM score" for line, value in fixed]
    names = ", ".join(f"'{f}'" for f in _FIELDS)
    rows.append(f"""SELECT (4 + list_position([{names}], field_name))::BIGINT AS line,
  rpad(CASE WHEN pct >= 90 THEN 'GOOD' WHEN pct >= 70 THEN 'FAIR' ELSE 'POOR' END, 6, ' ')
  || rpad(field_name, 25, ' ') || ' ' || printf('%5.1f', pct) || '%  (' || present || '/' || total || ')' AS value
FROM (SELECT *, round_even(completeness_pct, 1)::DOUBLE AS pct FROM profile)""")
    return "\nUNION ALL\n".join(rows)


ORACLE: dict[str, str] = {
    "reject_empty": _with(CLEANSED, r"""SELECT id, source_file, id || ': REJECTED — empty record' AS issue FROM feed
WHERE NOT (regexp_matches(legal_name, '\S') OR regexp_matches(country, '\S') OR regexp_matches(lei, '\S'))"""),
    "normalize_names": _with(CLEANSED, "SELECT id, clean_name FROM cleaned"),
    "normalize_addresses": _with(CLEANSED, "SELECT id, clean_address FROM cleaned"),
    "country_valid": _with(CLEANSED, "SELECT id, country, country_valid FROM n"),
    "entity_type_norm": _with(CLEANSED, "SELECT id, entity_type FROM n"),
    "lei_status": _with(CLEANSED, "SELECT id, lei, lei_valid, lei_status FROM n"),
    "email_valid": _with(CLEANSED, "SELECT id, contact_email, email_valid FROM n"),
    "dedup_key": _with(CLEANSED, "SELECT id, full_key, substr(full_key, 1, 16) AS dedup_key FROM n"),
    "first_seen_duplicates": _with(CLEANSED, "SELECT id, duplicate_of FROM flagged"),
    "ingest_flags": _with(CLEANSED, "SELECT id, flags FROM flagged"),
    "cleansing_notes": _with(CLEANSED, "SELECT id, cleansing_notes FROM c"),
    "cleansed_parties": _with(CLEANSED, f"SELECT {_COLUMNS_17} FROM c"),
    "ingestion_stats": _with(STATS, "SELECT *, printf('%.1f%%', valid_pct) AS score FROM stats"),
    "typed_cleansed": _with(TYPED, f"SELECT {_COLUMNS_17} FROM t"),
    "drop_identity_less": _with(IDENT, "SELECT id, legal_name, country FROM ident"),
    "identity_format_flags": _with(IDENT, "SELECT id, lei_format_valid, country_format_valid FROM ident"),
    "trust_score": _with(IDENT, f"SELECT id, trust, {_TRUST_BAND} FROM ident"),
    "fingerprint_sha256": _with(IDENT, "SELECT id, fingerprint FROM ident"),
    "fingerprint_blake3": _with(
        IDENT + _blake3("ident", "id", "legal_name || '|' || country || '|' || lei || '|' || entity_type"),
        "SELECT key AS id, digest AS fingerprint FROM blake3",
    ).replace("WITH", "WITH RECURSIVE", 1),
    "kyc_level": _with(CLASSIFIED, "SELECT id, kyc_level, kyc_reason FROM cl"),
    "obligations": _with(CLASSIFIED, "SELECT id, obligations FROM cl"),
    "obligation_counts": _with(CLASSIFIED, """SELECT obligation, count(*) AS parties
FROM (SELECT unnest(string_split(obligations, ';')) AS obligation FROM cl WHERE obligations <> 'NONE')
GROUP BY obligation"""),
    "risk_score": _with(CLASSIFIED, "SELECT id, risk_score, risk_class, risk_factors FROM cl"),
    "risk_score_strict": _with(
        CLEANSED + _classified("n", "lei_valid = 1"), "SELECT id, risk_score, risk_class FROM cl"
    ),
    "sanctions_flags": _with(CLASSIFIED, "SELECT id, sanctions_flags FROM cl"),
    "high_risk": _with(CLASSIFIED, "SELECT id, risk_score, risk_class FROM cl WHERE risk_class IN ('HIGH', 'CRITICAL')"),
    "classification_counts": _with(CLASSIFIED, """SELECT count(*) AS processed,
  count(*) FILTER (risk_class IN ('HIGH', 'CRITICAL')) AS high_risk FROM cl"""),
    "class_counts": _with(CLASSIFIED, "SELECT risk_class, kyc_level, count(*) AS parties FROM cl GROUP BY ALL"),
    "classified_table": _with(CLASSIFIED, f"SELECT id AS party_id, {_CLASSIFIED_11} FROM cl"),
    "rule_tiers": _with(CLEANSED, """SELECT id, country,
  CASE WHEN country IN ('DE','FR','BE','NL','LU','FI','AT','IE') THEN 'TIER_1'
       WHEN country IN ('GB','CH','US','CA','JP','AU','SG','HK') THEN 'TIER_2'
       WHEN country IN ('KY','BS','BM','VG','JE','GG','IM','PA') THEN 'TIER_3' END AS tier
FROM n"""),
    "rule_frameworks": _with(CLEANSED + """,
fw AS (SELECT * FROM (VALUES
  ('CREDIT_INSTITUTION', 0, 'CRD_V'), ('CREDIT_INSTITUTION', 1, 'MiFID_II'),
  ('CREDIT_INSTITUTION', 2, 'EMIR'), ('CREDIT_INSTITUTION', 3, 'AMLD_VI'),
  ('INVESTMENT_FIRM', 0, 'MiFID_II'), ('INVESTMENT_FIRM', 1, 'EMIR'), ('INVESTMENT_FIRM', 2, 'AMLD_VI'),
  ('CSD', 0, 'CSDR'), ('CSD', 1, 'EMIR'), ('CSD', 2, 'SFTR'),
  ('EXCHANGE', 0, 'MiFID_II'), ('EXCHANGE', 1, 'MAR'), ('EXCHANGE', 2, 'EMIR'),
  ('SHELL_COMPANY', 0, 'AMLD_VI'), ('SHELL_COMPANY', 1, 'DAC_6')) x(entity_type, position, framework))""",
        "SELECT n.id, n.entity_type, fw.position::BIGINT AS position, fw.framework FROM n JOIN fw USING (entity_type)"),
    "revenue_bands": _with(TYPED, """SELECT id, CASE WHEN annual_revenue_eur IS NULL THEN 'UNKNOWN'
  WHEN annual_revenue_eur >= 1000000000 THEN 'HIGH_VALUE'
  WHEN annual_revenue_eur >= 0 AND annual_revenue_eur <= 1000 THEN 'SUSPICIOUS'
  ELSE 'NORMAL' END AS revenue_band FROM t"""),
    "identity_lines": _with(IDENT, f"SELECT {_LINE} AS value FROM ident"),
    "identity_lines_read": _with(IDENT, "SELECT id, fingerprint, trust FROM ident"),
    "data_lines_read": _with(CLASSIFIED, f"""SELECT {_LINE} AS value FROM ident
UNION ALL SELECT {_CLASSIFIED_LINE} AS value FROM cl"""),
    "classified_lines": _with(CLASSIFIED, f"SELECT {_CLASSIFIED_LINE} AS value FROM cl"),
    "classified_lines_read": _with(CLASSIFIED, "SELECT id, kyc_level, risk_score, risk_class FROM cl"),
    "wire_reparse": _with(WIRE, f"SELECT party_id, {_CLASSIFIED_11} FROM cl"),
    "party_files_read": _with(FEED, """SELECT id, legal_name, country, lei, entity_type, incorporation_date,
  status, address, contact_email, annual_revenue_eur, source_rank::BIGINT AS source_rank FROM feed"""),
    "party_files_first_seen": _with(CLEANSED, "SELECT id, duplicate_of FROM flagged"),
    "cleansed_csv_read": _with(CLEANSED, f"""SELECT {_COLUMNS_17.replace("lei_valid", "lei_valid::VARCHAR AS lei_valid")
        .replace("email_valid,", "email_valid::VARCHAR AS email_valid,")
        .replace("country_valid", "country_valid::VARCHAR AS country_valid")} FROM c"""),
    "typed_csv_read": _with(TYPED, f"SELECT {_COLUMNS_17} FROM t"),
    "field_profile": _with(TYPED, _profile()),
    "dist_country": _distribution("country"),
    "dist_entity_type": _distribution("entity_type"),
    "dist_status": _distribution("status"),
    "dist_sizes": _with(TYPED, """SELECT count(DISTINCT country) AS countries,
  count(DISTINCT entity_type) AS entity_types, count(DISTINCT status) AS statuses FROM t"""),
    "anomalies": _with(ANOMALIES, """SELECT coalesce(id, 'UNKNOWN') AS party_id, position::BIGINT AS position,
  type, severity, description FROM an"""),
    "severity_counts": _with(SCORED, "SELECT * FROM sev"),
    "quality_score": _with(SCORED, "SELECT * FROM score"),
    "quality_bands": _with(SCORED, """SELECT field_name AS name, completeness_pct AS value,
  CASE WHEN completeness_pct >= 90 THEN 'GOOD' WHEN completeness_pct >= 70 THEN 'FAIR' ELSE 'POOR' END AS band
FROM profile
UNION ALL
SELECT 'score', quality_score,
  CASE WHEN quality_score >= 80 THEN 'GOOD' WHEN quality_score >= 60 THEN 'FAIR' ELSE 'POOR' END
FROM score"""),
    "quality_report": _with(SCORED, f"""SELECT total_records, quality_score,
  '{";".join(sorted(_FIELDS))}' AS fields,
  p.present AS country_present, p.unique_values AS country_unique, anomalies, critical, high, medium, low
FROM score JOIN profile p ON p.field_name = 'country'"""),
    "quality_summary": _with(SCORED, _summary_lines()),
    "ingestion_report": _with(STATS, r"""SELECT 0::BIGINT AS section, unnest([
  repeat('=', 47), '  Party Ingestion Report', '  Generated: -', repeat('=', 47), '',
  'Files Processed:     ' || files, 'Total Records:       ' || total, 'Valid Records:       ' || valid,
  'Cleansed Records:    ' || cleansed, 'Rejected Records:    ' || rejected,
  'Duplicates Found:    ' || duplicates, '', 'Data Quality Score:  ' || printf('%.1f%%', valid_pct), '',
  'Issues:']) AS value FROM stats
UNION ALL SELECT 1, '  - ' || id || ': REJECTED — empty record' FROM feed
  WHERE NOT (regexp_matches(legal_name, '\S') OR regexp_matches(country, '\S') OR regexp_matches(lei, '\S'))
UNION ALL SELECT 2, unnest(['', '--- End of Report ---'])"""),
    "report_headline": _with(SCORED, "SELECT quality_score, total_records, anomalies, critical, high, medium, low FROM score"),
    "latest_per_id": _with(VIEW, "SELECT id, legal_name, country, lei, entity_type, status FROM latest"),
    "merged_view": _with(VIEW, "SELECT * FROM mv"),
    "party_listing": _with(VIEW, "SELECT * FROM mv"),
    "name_search": _with(VIEW, "SELECT * FROM mv WHERE contains(lower(legal_name), 'offshore')"),
    "name_search_indexed": _with(VIEW, "SELECT * FROM mv WHERE contains(lower(legal_name), 'offshore')"),
    "merged_view_stored": _with(VIEW, "SELECT * FROM mv"),
    "party_lookup": _with(VIEW, "SELECT * FROM mv WHERE id = 'C000000011'"),
    "explorer_listing": _with(VIEW, f"""SELECT id, legal_name, country,
  CASE WHEN risk_class = '' THEN 'UNKNOWN' ELSE risk_class END AS risk_class, trust, {_TRUST_BAND}, kyc_level
FROM mv WHERE contains(lower(legal_name), 'ltd')"""),
    "published_parties": _with(VIEW, "SELECT * RENAME (legal_name AS name) FROM mv"),
    "stream_alerts": _with(VIEW, ALERTS),
    "batch_alerts": _with(VIEW, ALERTS),
    "party_classification": _with(CLEANSED + _classified("c"), """SELECT id, legal_name, country, lei_status,
  entity_type, status, duplicate_of, trust, fingerprint, kyc_level, risk_score, risk_class, obligations FROM cl"""),
    "duplicates_by_country": _with(CLEANSED, """SELECT country, count(*) AS parties, count(duplicate_of) AS duplicates,
  count(*) FILTER (lei_status = 'OK') AS lei_ok, count(*) FILTER (lei_status = 'MISSING') AS lei_missing,
  count(*) FILTER (lei_status = 'INVALID_FORMAT') AS lei_invalid_format,
  count(*) FILTER (lei_status = 'CHECKSUM_FAIL') AS lei_checksum_fail
FROM flagged GROUP BY country"""),
}
