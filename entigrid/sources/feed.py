"""Party records derived from the customer and supplier tables.

Both tables only lend their keys; names, countries, LEIs and so on follow from the key by
fixed arithmetic. The scan therefore reads one column per table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from entigrid.schema import POSITION

SOURCE_ROWS = 1 << 50  # above any key, so that customers come before suppliers

FEED_SQL = """
WITH base AS (
  SELECT 'C' AS pfx, c_custkey AS k, 'customer' AS source_file, 0 AS source_rank FROM {customer}
  UNION ALL
  SELECT 'S' AS pfx, s_suppkey AS k, 'supplier' AS source_file, 1 AS source_rank FROM {supplier}
), keyed AS (
  SELECT *, CASE WHEN k % 10 = 8 THEN k - 7 ELSE k END AS ck FROM base
), named AS (
  SELECT *,
    CASE WHEN pfx = 'C' THEN 'Customer#' ELSE 'Supplier#' END
      || lpad(CAST(ck AS VARCHAR(20)), 9, '0') AS nm,
    'AB' || lpad(CAST(ck AS VARCHAR(20)), 16, '0') AS lei_body,
    98 - ((60 + ck * 100) % 97) AS lei_chk
  FROM keyed
)
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
       WHEN ck % 12 = 0 THEN 'DE' WHEN ck % 12 = 1 THEN 'fr' WHEN ck % 12 = 2 THEN 'KY'
       WHEN ck % 12 = 3 THEN 'LU' WHEN ck % 12 = 4 THEN ''   WHEN ck % 12 = 5 THEN 'BS'
       WHEN ck % 12 = 6 THEN 'GB' WHEN ck % 12 = 7 THEN 'XX' WHEN ck % 12 = 8 THEN 'JE'
       WHEN ck % 12 = 9 THEN 'BM' WHEN ck % 12 = 10 THEN 'VG' ELSE 'PA' END AS country,
  CASE WHEN k % 50 = 49 THEN ''
       WHEN ck % 9 = 3 THEN lei_body || lpad(CAST((lei_chk % 97) + 1 AS VARCHAR(20)), 2, '0')
       WHEN ck % 9 = 5 THEN lower(lei_body) || '00'
       WHEN ck % 9 = 7 THEN ''
       ELSE lei_body || lpad(CAST(lei_chk AS VARCHAR(20)), 2, '0') END AS lei,
  CASE ck % 10 WHEN 0 THEN 'bank' WHEN 1 THEN 'CREDIT_INSTITUTION' WHEN 2 THEN 'INVESTMENT_FIRM'
       WHEN 3 THEN 'FUND' WHEN 4 THEN 'ICSD' WHEN 5 THEN 'EXCHANGE' WHEN 6 THEN 'SHELL_COMPANY'
       WHEN 7 THEN 'Insurance' ELSE 'PARTNERSHIP' END AS entity_type,
  '2001-02-03' AS incorporation_date,
  CASE WHEN k % 13 = 0 THEN 'SUSPENDED' WHEN k % 13 = 5 THEN '' ELSE 'ACTIVE' END AS status,
  CASE k % 5 WHEN 0 THEN '12 Baker Str. ' || CAST(k AS VARCHAR(20))
       WHEN 1 THEN CAST(k AS VARCHAR(20)) || ' Ave. Foch'
       WHEN 2 THEN '"5th  Blvd"' WHEN 3 THEN '' ELSE '1 Main Street' END AS address,
  CASE k % 4 WHEN 0 THEN 'u' || CAST(k AS VARCHAR(20)) || '@ex.com' WHEN 1 THEN 'bad@'
       WHEN 2 THEN '' ELSE 'a.b+' || CAST(k AS VARCHAR(20)) || '@sub.example.org'
       END AS contact_email,
  CASE k % 6 WHEN 0 THEN '0' WHEN 1 THEN '250000000000' WHEN 2 THEN ''
       ELSE CAST(k * 1000 AS VARCHAR(20)) END AS annual_revenue_eur
FROM named
"""

FEED_SOURCES = ["customer", "supplier"]


def derived_parties(customer: DataFrame, supplier: DataFrame) -> DataFrame:
    """Raw parties with provenance and ingest order, from the two tables."""
    spark: SparkSession = customer.sparkSession
    feed = spark.sql(FEED_SQL, customer=customer, supplier=supplier)
    return feed.selectExpr(
        "*", f"source_rank * {SOURCE_ROWS} + row_pos AS {POSITION}"
    )


def read_derived_parties(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived_parties(
        *(spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in FEED_SOURCES)
    )
