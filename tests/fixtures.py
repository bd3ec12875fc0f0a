"""Twelve sample parties and the results expected for them."""

from __future__ import annotations

SAMPLE_CSV = '''id,legal_name,country,lei,entity_type,incorporation_date,status,address,contact_email,annual_revenue_eur
P001,Deutsche Bank AG,DE,7LTWFZYICNSX8D621K86,CREDIT_INSTITUTION,1870-03-10,ACTIVE,"Taunusanlage 12, 60325 Frankfurt",contact@db.com,28900000000
P002,BNP Paribas SA,FR,R0MUWSFPU8MPRO8K5P83,CREDIT_INSTITUTION,1966-05-01,ACTIVE,"16 Boulevard des Italiens, 75009 Paris",info@bnpparibas.com,46200000000
P003,Acme Capital Ltd,,INVALIDLEI12345,INVESTMENT_FIRM,2019-06-15,ACTIVE,"",hello@acmecap.fake,5000000
P004,Deutsche Bank AG,DE,7LTWFZYICNSX8D621K86,CREDIT_INSTITUTION,1870-03-10,ACTIVE,"Taunusanlage 12, Frankfurt 60325",kontakt@db.com,28900000000
P005,Shady Offshore Holdings,KY,,SHELL_COMPANY,2023-11-01,ACTIVE,"PO Box 1234, George Town",,,
P006,Nordea Bank Abp,FI,529900ODI3047E2LIV03,CREDIT_INSTITUTION,2018-10-01,ACTIVE,"Hamnbanegatan 5, 00020 Nordea Helsinki",info@nordea.fi,9200000000
P007,,,,,,,,,
P008,Jean-Pierre Müller & Associés,LU,5493001KJTIIGC8Y1R12,INVESTMENT_FIRM,2005-03-22,ACTIVE,"42 Rue de la Gare, L-1611 Luxembourg",jp@muller-associes.lu,12000000
P009,Clearstream Banking S.A.,LU,549300OL514RA0SBER12,CSD,1970-01-01,ACTIVE,"42 Avenue JF Kennedy, L-1855 Luxembourg",info@clearstream.com,1800000000
P010,FTX Trading Ltd,BS,NOTVALID999,EXCHANGE,2019-05-01,SUSPENDED,"Bahamas","",0
'''

SAMPLE_JSON = '''[
  {"id": "P011", "legal_name": "Euroclear Bank SA/NV", "country": "BE",
   "lei": "549300HWWJR97TH4DP82", "entity_type": "CSD", "incorporation_date": "1968-12-01",
   "status": "ACTIVE", "address": "1 Boulevard du Roi Albert II, 1210 Brussels",
   "contact_email": "info@euroclear.com", "annual_revenue_eur": 2100000000},
  {"id": "P012", "legal_name": "Goldman Sachs International", "country": "GB",
   "lei": "W22LROWP2IHZNBB6K528", "entity_type": "CREDIT_INSTITUTION",
   "incorporation_date": "1988-02-12", "status": "ACTIVE",
   "address": "Plumtree Court, 25 Shoe Lane, London EC4A 4AU",
   "contact_email": "gs-info@gs.com", "annual_revenue_eur": 47900000000}
]
'''

CLEANSED = '''id,legal_name,country,lei,entity_type,incorporation_date,status,address,contact_email,annual_revenue_eur,lei_valid,lei_status,email_valid,country_valid,dedup_key,source_file,cleansing_notes
P001,Deutsche Bank AG,DE,7LTWFZYICNSX8D621K86,CREDIT_INSTITUTION,1870-03-10,ACTIVE,"Taunusanlage 12, 60325 Frankfurt",contact@db.com,28900000000,1,OK,1,1,4ce564e76e86e49c,sample_parties.csv,clean
P002,BNP Paribas SA,FR,R0MUWSFPU8MPRO8K5P83,CREDIT_INSTITUTION,1966-05-01,ACTIVE,"16 Boulevard des Italiens, 75009 Paris",info@bnpparibas.com,46200000000,1,OK,1,1,95d0ce7b19bdaeba,sample_parties.csv,clean
P003,Acme Capital Ltd,,INVALIDLEI12345,INVESTMENT_FIRM,2019-06-15,ACTIVE,,hello@acmecap.fake,5000000,0,INVALID_FORMAT,1,0,27dcb9b013ffdc22,sample_parties.csv,country_invalid_or_missing;lei_INVALID_FORMAT
P004,Deutsche Bank AG,DE,7LTWFZYICNSX8D621K86,CREDIT_INSTITUTION,1870-03-10,ACTIVE,"Taunusanlage 12, Frankfurt 60325",kontakt@db.com,28900000000,1,OK,1,1,4ce564e76e86e49c,sample_parties.csv,DUPLICATE:matches_P001
P005,Shady Offshore Holdings,KY,,SHELL_COMPANY,2023-11-01,ACTIVE,"PO Box 1234, George Town",,,0,MISSING,0,1,16feaa7711ee5525,sample_parties.csv,lei_MISSING;HIGH_RISK:shell_company;HIGH_RISK:offshore_no_lei
P006,Nordea Bank Abp,FI,529900ODI3047E2LIV03,CREDIT_INSTITUTION,2018-10-01,ACTIVE,"Hamnbanegatan 5, 00020 Nordea Helsinki",info@nordea.fi,9200000000,1,OK,1,1,344acf190bec9e0b,sample_parties.csv,clean
P008,Jean-Pierre Müller & Associés,LU,5493001KJTIIGC8Y1R12,INVESTMENT_FIRM,2005-03-22,ACTIVE,"42 Rue de la Gare, L-1611 Luxembourg",jp@muller-associes.lu,12000000,1,OK,1,1,ccb7b1998368b4b1,sample_parties.csv,clean
P009,Clearstream Banking SA,LU,549300OL514RA0SBER12,CSD,1970-01-01,ACTIVE,"42 Avenue nue JF Kennedy, L-1855 Luxembourg",info@clearstream.com,1800000000,0,CHECKSUM_FAIL,1,1,91a79d980637568b,sample_parties.csv,name_normalized;address_normalized;lei_CHECKSUM_FAIL
P010,FTX Trading Ltd,BS,NOTVALID999,EXCHANGE,2019-05-01,SUSPENDED,Bahamas,,0,0,INVALID_FORMAT,0,1,d035e80ddbe75b61,sample_parties.csv,lei_INVALID_FORMAT;HIGH_RISK:suspended_entity;HIGH_RISK:offshore_no_lei
P011,Euroclear Bank SA/NV,BE,549300HWWJR97TH4DP82,CSD,1968-12-01,ACTIVE,"1 Boulevard du Roi Albert II, 1210 Brussels",info@euroclear.com,2100000000,0,CHECKSUM_FAIL,1,1,f8aa2dc21cafb1e6,sample_parties.json,lei_CHECKSUM_FAIL
P012,Goldman Sachs International,GB,W22LROWP2IHZNBB6K528,CREDIT_INSTITUTION,1988-02-12,ACTIVE,"Plumtree Court, 25 Shoe Lane, London EC4A 4AU",gs-info@gs.com,47900000000,1,OK,1,1,215ef165a42f52a0,sample_parties.json,clean
'''

IDENTITY_LINES = '''IDENTITY|P001|Deutsche Bank AG|DE|a40d77f3ee2bbbf6acb2ddb2b9d5432c99478a8ee4fb912e36bff14cbcb58603|7LTWFZYICNSX8D621K86|CREDIT_INSTITUTION|lei_valid=true|country_valid=true|trust=100
IDENTITY|P002|BNP Paribas SA|FR|7516760dd95542187a6b812056ec7b65c4b6616601f98eda66d4d46c8636785b|R0MUWSFPU8MPRO8K5P83|CREDIT_INSTITUTION|lei_valid=true|country_valid=true|trust=100
IDENTITY|P003|Acme Capital Ltd||b47c5fe8890758e00b66bccdc0e5eff74dca194e3c3d29c231569f4f632989c8|INVALIDLEI12345|INVESTMENT_FIRM|lei_valid=false|country_valid=false|trust=60
IDENTITY|P004|Deutsche Bank AG|DE|a40d77f3ee2bbbf6acb2ddb2b9d5432c99478a8ee4fb912e36bff14cbcb58603|7LTWFZYICNSX8D621K86|CREDIT_INSTITUTION|lei_valid=true|country_valid=true|trust=100
IDENTITY|P005|Shady Offshore Holdings|KY|47659b8bce4c26351789f8cbb796db3ee4dd2bd128ede3b8bb5901f9a62213bf||SHELL_COMPANY|lei_valid=false|country_valid=true|trust=75
IDENTITY|P006|Nordea Bank Abp|FI|2e4f2c323684ac958fc1a866a46df066a397673b71391afc53b1219d4a11d49a|529900ODI3047E2LIV03|CREDIT_INSTITUTION|lei_valid=true|country_valid=true|trust=100
IDENTITY|P008|Jean-Pierre Müller & Associés|LU|d0615316edd3bcb6f6dbf0e7276cef5647acb66a2c586aca6e02133eb7f4a951|5493001KJTIIGC8Y1R12|INVESTMENT_FIRM|lei_valid=true|country_valid=true|trust=100
IDENTITY|P009|Clearstream Banking SA|LU|7cbf02629e905d70ff428d23a0aa5d118f766e6106fe55571ee0fbb9f2a3086c|549300OL514RA0SBER12|CSD|lei_valid=true|country_valid=true|trust=100
IDENTITY|P010|FTX Trading Ltd|BS|6bec23e20e63c1e9e18b3253c6de6ec44750ad650528705d052feb641a5616cd|NOTVALID999|EXCHANGE|lei_valid=false|country_valid=true|trust=60
IDENTITY|P011|Euroclear Bank SA/NV|BE|b248112c0800b5f97940a39bb0cc3edb3af359bc92d85acbb52db47bc1a381d0|549300HWWJR97TH4DP82|CSD|lei_valid=true|country_valid=true|trust=100
IDENTITY|P012|Goldman Sachs International|GB|647268468684a1f03c9ed2bbab91b6caa3e4a004b92f23c0f4958b744ecdb379|W22LROWP2IHZNBB6K528|CREDIT_INSTITUTION|lei_valid=true|country_valid=true|trust=100
'''.splitlines()

# Results of the lossy line hand-off, see operators/wire.py.
CLASSIFIED_LINES = '''P001|Deutsche Bank AG|DE|a40d77f3ee2bbbf6...|STANDARD|Default classification|30|MEDIUM|NO_VALID_LEI(+30)|EMIR_TR_REPORTING;LEI_REQUIRED_MISSING|CLEAR
P002|BNP Paribas SA|FR|7516760dd9554218...|STANDARD|Default classification|30|MEDIUM|NO_VALID_LEI(+30)|EMIR_TR_REPORTING;LEI_REQUIRED_MISSING|CLEAR
P003|Acme Capital Ltd|b47c5fe8890758e00b66bccdc0e5eff74dca194e3c3d29c231569f4f632989c8|INVALIDLEI12345...|STANDARD|Default classification|30|MEDIUM|NO_VALID_LEI(+30)|LEI_REQUIRED_MISSING;CRS_REPORTING|CLEAR
P004|Deutsche Bank AG|DE|a40d77f3ee2bbbf6...|STANDARD|Default classification|30|MEDIUM|NO_VALID_LEI(+30)|EMIR_TR_REPORTING;LEI_REQUIRED_MISSING|CLEAR
P005|Shady Offshore Holdings|KY|47659b8bce4c2635...|ENHANCED|Offshore jurisdiction — enhanced due diligence required|70|HIGH|NO_VALID_LEI(+30);HIGH_RISK_COUNTRY(+40)|LEI_REQUIRED_MISSING;CRS_REPORTING|REVIEW:NAME_CONTAINS_OFFSHORE
P006|Nordea Bank Abp|FI|2e4f2c323684ac95...|STANDARD|Default classification|30|MEDIUM|NO_VALID_LEI(+30)|EMIR_TR_REPORTING;LEI_REQUIRED_MISSING|CLEAR
P008|Jean-Pierre Müller & Associés|LU|d0615316edd3bcb6...|STANDARD|Default classification|30|MEDIUM|NO_VALID_LEI(+30)|EMIR_TR_REPORTING;LEI_REQUIRED_MISSING|CLEAR
P009|Clearstream Banking SA|LU|7cbf02629e905d70...|SIMPLIFIED|Regulated FMI — simplified due diligence per MiFID II Art. 13|30|MEDIUM|NO_VALID_LEI(+30)|SFTR_REPORTING;CSDR_SETTLEMENT_DISCIPLINE;LEI_REQUIRED_MISSING|CLEAR
P010|FTX Trading Ltd|BS|6bec23e20e63c1e9...|ENHANCED|Offshore jurisdiction — enhanced due diligence required|70|HIGH|NO_VALID_LEI(+30);HIGH_RISK_COUNTRY(+40)|LEI_REQUIRED_MISSING;CRS_REPORTING|CLEAR
P011|Euroclear Bank SA/NV|BE|b248112c0800b5f9...|SIMPLIFIED|Regulated FMI — simplified due diligence per MiFID II Art. 13|30|MEDIUM|NO_VALID_LEI(+30)|SFTR_REPORTING;CSDR_SETTLEMENT_DISCIPLINE;LEI_REQUIRED_MISSING|CLEAR
P012|Goldman Sachs International|GB|647268468684a1f0...|STANDARD|Default classification|30|MEDIUM|NO_VALID_LEI(+30)|EMIR_TR_REPORTING;LEI_REQUIRED_MISSING;CRS_REPORTING|CLEAR
'''.splitlines()

# field: present, missing, completeness %, distinct values, uniqueness %
COMPLETENESS = {
    "id": (11, 0, 100.0, 11, 100.0),
    "legal_name": (11, 0, 100.0, 10, 90.9),
    "country": (10, 1, 90.9, 8, 80.0),
    "lei": (10, 1, 90.9, 9, 90.0),
    "entity_type": (11, 0, 100.0, 5, 45.5),
    "status": (11, 0, 100.0, 2, 18.2),
    "address": (10, 1, 90.9, 10, 100.0),
    "contact_email": (9, 2, 81.8, 9, 100.0),
    "annual_revenue_eur": (10, 1, 90.9, 9, 90.0),
}

DISTRIBUTIONS = {
    "country": [("DE", 2), ("LU", 2), ("FR", 1), ("KY", 1), ("FI", 1), ("BS", 1), ("BE", 1), ("GB", 1)],
    "entity_type": [
        ("CREDIT_INSTITUTION", 5), ("INVESTMENT_FIRM", 2), ("CSD", 2), ("SHELL_COMPANY", 1), ("EXCHANGE", 1),
    ],
    "status": [("ACTIVE", 10), ("SUSPENDED", 1)],
}

ANOMALIES = [
    ("P003", "MISSING_COUNTRY", "HIGH", "Party has no country code"),
    ("P003", "INVALID_LEI", "HIGH", "LEI present but invalid: INVALIDLEI12345"),
    ("P004", "DUPLICATE_RECORD", "HIGH", "Potential duplicate: DUPLICATE:matches_P001"),
    ("P005", "MISSING_LEI", "MEDIUM", "No LEI provided"),
    ("P005", "HIGH_RISK_FLAG", "CRITICAL",
     "High risk flag: lei_MISSING;HIGH_RISK:shell_company;HIGH_RISK:offshore_no_lei"),
    ("P009", "INVALID_LEI", "HIGH", "LEI present but invalid: 549300OL514RA0SBER12"),
    ("P010", "INVALID_LEI", "HIGH", "LEI present but invalid: NOTVALID999"),
    ("P010", "ZERO_REVENUE", "MEDIUM", "Entity reports zero revenue"),
    ("P010", "HIGH_RISK_FLAG", "CRITICAL",
     "High risk flag: lei_INVALID_FORMAT;HIGH_RISK:suspended_entity;HIGH_RISK:offshore_no_lei"),
    ("P011", "INVALID_LEI", "HIGH", "LEI present but invalid: 549300HWWJR97TH4DP82"),
]

SEVERITY_COUNTS = {"CRITICAL": 2, "HIGH": 6, "MEDIUM": 2, "LOW": 0}
QUALITY_SCORE = 62.1
