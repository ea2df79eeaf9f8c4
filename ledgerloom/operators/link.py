"""The overlap of annual reports and holdings, joined on the security prefix."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.operators.holdings import ROLLUP_KEYS

HOLDING_COLUMNS = (
    "source",
    "managerCik",
    "managerAddress",
    "managerName",
    "reportCalendarOrQuarter",
    "cusip6",
    "cusip",
    "companyName",
    "value",
    "shares",
)


def _same(left: Column, right: Column, compat: bool) -> Column:
    # compat: a missing prefix matches a missing prefix.
    return left.eqNullSafe(right) if compat else left == right


def keep_first(frame: DataFrame, keys: list[str], order_by: list[str | Column]) -> DataFrame:
    """First row per key. Each task keeps one row per key before the shuffle, so hot keys stay small."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order_by))
    return frame.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def companies_with_holdings(
    companies: DataFrame,
    holdings: DataFrame,
    order_by: tuple[str, ...] = ("form10KUrls",),
    dedupe_keys: tuple[str, ...] = ("cusip6",),
    compat: bool = False,
) -> DataFrame:
    """Companies whose prefix some manager holds, first row per prefix.

    No holdings column survives, so this is a semi-join against the distinct prefixes, not a fan-out.
    """
    held = holdings.filter(F.col("managerCik").isNotNull()).select(F.col("cusip6").alias("_held")).distinct()
    by_prefix = "cusip6" in dedupe_keys
    # A prefix is held or not as a whole, so rows per prefix can be reduced before the join.
    rows = keep_first(companies, list(dedupe_keys), list(order_by)) if by_prefix else companies
    kept = rows.join(held, _same(rows["cusip6"], held["_held"], compat), "left_semi")
    first = kept if by_prefix else keep_first(kept, list(dedupe_keys), list(order_by))
    return first.select("cusip6", "cik", "names", "cusip", "form10KUrls")


def holdings_with_companies(
    companies: DataFrame,
    holdings: DataFrame,
    dedupe_keys: tuple[str, ...] = ("managerCik", "cik"),
    compat: bool = False,
) -> DataFrame:
    """Holdings whose prefix belongs to a company, first row per manager and company.

    Only the first row per (dedupe keys on the holdings side, prefix) can be the first of any company, so
    holdings shrink to that before the join: a popular prefix then has one row per manager.
    """
    order = [*ROLLUP_KEYS]
    own_keys = [k for k in dedupe_keys if k != "cik"]
    first = keep_first(holdings, [*own_keys, "cusip6"], order)
    listed = companies.filter(F.col("cik").isNotNull()).select(F.col("cusip6").alias("_listed"), "cik").distinct()
    joined = first.join(listed, _same(first["cusip6"], listed["_listed"], compat))
    return keep_first(joined, list(dedupe_keys), order).select(*HOLDING_COLUMNS)


def join_funnel(companies: DataFrame, holdings: DataFrame, compat: bool = False) -> DataFrame:
    """Row counts of every step of both joins, as (step, rows).

    The joins are counted from row counts per prefix, so the fan-out never exists.
    """
    left = companies.groupBy(F.col("cusip6").alias("l")).agg(
        F.count("*").alias("companies"), F.count("cik").alias("companies_with_cik")
    )
    # Rows per (manager, prefix): the counts per prefix and the distinct pairs both come from this one frame.
    per_pair = holdings.groupBy("managerCik", "cusip6").agg(F.count("*").alias("rows"))
    right = per_pair.groupBy(F.col("cusip6").alias("r")).agg(
        F.sum("rows").alias("holdings"),
        F.sum(F.when(F.col("managerCik").isNotNull(), F.col("rows"))).alias("holdings_with_manager"),
    )
    both = left.join(right, _same(left["l"], right["r"], compat), "full")
    n, m = F.coalesce("companies", F.lit(0)), F.coalesce("holdings", F.lit(0))
    held = F.coalesce("holdings_with_manager", F.lit(0))
    listed = F.coalesce("companies_with_cik", F.lit(0))
    totals = both.agg(
        F.sum(n).alias("companies"),
        F.sum(m).alias("holdings"),
        F.sum(n * F.greatest(m, F.lit(1))).alias("left_joined"),
        F.sum(n * held).alias("left_filtered"),
        F.count_if((n > 0) & (held > 0)).alias("left_deduped"),
        F.sum(m * F.greatest(n, F.lit(1))).alias("right_joined"),
        F.sum(m * listed).alias("right_filtered"),
    )
    holders = per_pair.select("managerCik", "cusip6")
    ciks = companies.filter(F.col("cik").isNotNull()).select(F.col("cusip6").alias("_listed"), "cik").distinct()
    pairs = holders.join(ciks, _same(holders["cusip6"], ciks["_listed"], compat)).select("managerCik", "cik")
    pair_count = pairs.distinct().agg(F.count("*").alias("right_deduped"))
    # Two single-row totals become one row.
    both_rows = totals.unionByName(pair_count, allowMissingColumns=True)
    wide = both_rows.agg(*[F.max(c).alias(c) for c in both_rows.columns]).withColumns(
        {
            "left_removed": F.col("left_filtered") - F.col("left_deduped"),
            "right_removed": F.col("right_filtered") - F.col("right_deduped"),
        }
    )
    return wide.unpivot([], list(wide.columns), "step", "rows")
