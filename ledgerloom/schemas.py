"""Declared schemas. Ids are strings everywhere, so leading zeros survive every read."""

from __future__ import annotations

COMPANY_MAP_CSV = "cik STRING, cusip6 STRING, cusip STRING, names STRING"
FILING_URLS_CSV = COMPANY_MAP_CSV + ", form10KUrls STRING"

HOLDINGS = (
    "source STRING, managerCik STRING, managerAddress STRING, managerName STRING, "
    "reportCalendarOrQuarter DATE, cusip6 STRING, cusip STRING, companyName STRING, "
    "value DECIMAL(28,6), shares BIGINT"
)

FILING_HISTORY = (
    "filings STRUCT<recent: STRUCT<accessionNumber: ARRAY<STRING>, "
    "form: ARRAY<STRING>, filingDate: ARRAY<STRING>>>"
)

SECTIONS_JSON = (
    "item1 STRING, item1a STRING, item7 STRING, item7a STRING, cik STRING, cusip6 STRING, "
    "cusip ARRAY<STRING>, names ARRAY<STRING>, source STRING"
)

# Cover page and information table of an institutional holdings submission.
# The address is a map so that its parts keep document order whatever they are called.
COVER_XML = (
    "headerData STRUCT<filerInfo: STRUCT<filer: STRUCT<credentials: STRUCT<cik: STRING>>>>, "
    "formData STRUCT<coverPage: STRUCT<reportCalendarOrQuarter: STRING, "
    "filingManager: STRUCT<name: STRING, address: MAP<STRING, STRING>>>>, "
    "_corrupt_record STRING"
)
TABLE_XML = (
    "infoTable ARRAY<STRUCT<nameOfIssuer: STRING, titleOfClass: STRING, cusip: STRING, value: STRING, "
    "shrsOrPrnAmt: STRUCT<sshPrnamt: STRING, sshPrnamtType: STRING>>>, "
    "_corrupt_record STRING"
)

_EXTRACTED_NODE = (
    "STRUCT<entityId: STRING, type: STRING, properties: ARRAY<STRUCT<key: STRING, value: STRING>>>"
)
EXTRACTED_GRAPH = (
    f"nodes ARRAY<{_EXTRACTED_NODE}>, "
    f"rels ARRAY<STRUCT<source: {_EXTRACTED_NODE}, target: {_EXTRACTED_NODE}, type: STRING, "
    "properties: ARRAY<STRUCT<key: STRING, value: STRING>>>>"
)
