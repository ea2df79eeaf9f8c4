"""Identifier, path and URL expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ARCHIVE_ROOT = "https://sec.gov"


def padded_cik(cik: Column) -> Column:
    """``CIK`` and ten digits. Longer ids are kept whole, which padding functions would cut."""
    return F.format_string("CIK%010d", cik.try_cast("bigint"))


def filing_url(base: str, cik: Column, accession: Column) -> Column:
    return F.concat(
        F.lit(f"{base}/Archives/edgar/data/"),
        cik.try_cast("bigint").cast("string"),
        F.lit("/"),
        F.replace(accession, F.lit("-"), F.lit("")),
        F.lit("/"),
        accession,
        F.lit(".txt"),
    )


def file_id(url: Column) -> Column:
    """What stands between the last ``/`` and the last ``.``; empty if no ``.`` follows the last ``/``."""
    return F.regexp_extract(url, r"([^/]*)\.[^./]*$", 1)


def form_id(file_name: Column) -> Column:
    """File name without its last extension."""
    return F.regexp_extract(file_name, r"^(.*)\.[^.]*$", 1)


def index_page_url(url: Column) -> Column:
    return F.regexp_replace(url, r"\.[^.]*$", "-index.htm")


def flat_file_name(path: Column) -> Column:
    return F.translate(path, "/", "_")


def source_from_file_name(file_name: Column) -> Column:
    """Inverse of :func:`flat_file_name`, with or without the leading ``_``.

    Paths that held ``_`` do not come back; keep a mapping column then.
    """
    return F.concat(F.lit(f"{ARCHIVE_ROOT}/"), F.ltrim(F.replace(file_name, F.lit("_"), F.lit("/")), F.lit("/")))


def cusip6(cusip: Column) -> Column:
    """Six-character security prefix. Three leading zeros are taken as one zero of padding too many."""
    upper = F.upper(cusip)
    return F.when(cusip.startswith("000"), F.substring(upper, 2, 6)).otherwise(F.substring(upper, 1, 6))


def chunk_id(form: Column, item: Column, seq: Column) -> Column:
    return F.format_string("%s-%s-chunk%04d", form, item, seq)
