"""Institutional holdings: parse, filter, roll up, keep recent periods."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom import schemas
from ledgerloom.functions import ids, values
from ledgerloom.functions.bind import computed_once, let
from ledgerloom.functions.plain_xml import never_closed, read_plain

# A holding is kept if its share type is this and its title holds one of these words.
SHARE_TYPE = "SH"
STOCK_WORDS = ("COM", "CL", "ORD", "SHS", "STOCK")
NO_SECURITY = "000000000"

# Fixed value: the keys of the roll-up.
ROLLUP_KEYS = (
    "source",
    "managerCik",
    "managerAddress",
    "managerName",
    "reportCalendarOrQuarter",
    "cusip6",
    "cusip",
)
MAX_BROADCAST_PERIODS = 10_000
XML_OPTIONS = {"ignoreNamespace": "true", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}


def parse_submissions(raw: DataFrame) -> DataFrame:
    """Raw submissions (file_name, raw) -> one row per file with its cover page, table and parse status.

    ``reason`` is null for a file that parsed; see :func:`parse_failures`.
    """

    def block(n: int) -> Column:
        return F.get(F.split(F.get(F.split("_text", "<XML>"), F.lit(n)), "</XML>", 2), F.lit(0))

    def parsed_by_spark(document: str, schema: str) -> Column:
        trimmed = F.btrim(document, F.lit(" \t\r\n"))
        # What the parser gives for a broken text, without setting it up for one that is known to be cut off.
        broken = F.from_json(F.lit("{}"), schema).withField("_corrupt_record", trimmed)
        return F.when(never_closed(F.col(document)), broken).otherwise(F.from_xml(trimmed, schema, XML_OPTIONS))

    # Each step is a generator, so the next one reads its values and does not compute them again.
    text = computed_once(raw.select("file_name", "raw"), _text=F.col("raw")).drop("raw")
    ends = computed_once(text, _ends=F.split("_text", "</XML>", 3))
    halves = computed_once(ends, _first=F.get("_ends", F.lit(0)), _second=F.get("_ends", F.lit(1))).drop("_ends")
    plain = read_plain(halves, "_first", "_second", "_plain_cover", "_plain_table", marked=True)
    # What the second half begins is the second block if the first half begins just one, as it does with a plain cover page.
    one = F.col("_plain_cover").isNotNull() | (F.size(F.split("_first", "<XML>")) == 2)
    kept = computed_once(plain, _kept=F.when(one, F.col("_plain_table"))).drop("_plain_table")
    left = computed_once(
        kept,
        _cover=F.when(F.col("_plain_cover").isNull(), block(1)),
        _table=F.when(F.col("_kept").isNull(), block(2)),
    )
    parsed = computed_once(
        left,
        cover=F.coalesce("_plain_cover", parsed_by_spark("_cover", schemas.COVER_XML)),
        holdings=F.coalesce("_kept", parsed_by_spark("_table", schemas.TABLE_XML)),
    ).select("file_name", "cover", "holdings")
    reason = (
        F.when(F.col("cover").isNull(), "no cover page")
        .when(F.col("cover._corrupt_record").isNotNull(), "broken cover page")
        .when(F.col("holdings").isNull(), "no information table")
        .when(F.col("holdings._corrupt_record").isNotNull(), "broken information table")
        .when(F.col("holdings.infoTable").isNull(), "no holdings")
    )
    return parsed.withColumn("reason", reason)


def holding_lines(submissions: DataFrame, keep_failed: bool = False) -> DataFrame:
    """One row per reported line of the files that parsed, all values still text.

    With ``keep_failed``, a file that did not parse gives one row with its reason in ``fileReason``.
    """
    page = "cover.formData.coverPage"
    parsed = submissions if keep_failed else submissions.filter(F.col("reason").isNull())
    explode = F.posexplode_outer if keep_failed else F.posexplode
    table = F.col("holdings.infoTable")
    return (
        parsed.select(
            "file_name",
            F.col("reason").alias("fileReason"),
            F.col("cover.headerData.filerInfo.filer.credentials.cik").alias("managerCik"),
            F.array_join(F.map_values(f"{page}.filingManager.address"), ", ").alias("managerAddress"),
            F.col(f"{page}.filingManager.name").alias("managerName"),
            F.col(f"{page}.reportCalendarOrQuarter").alias("period"),
            explode(F.when(F.col("reason").isNull(), table) if keep_failed else table).alias("line", "h"),
        )
        .select(
            "file_name",
            *(["fileReason"] if keep_failed else []),
            "line",
            "managerCik",
            "managerAddress",
            "managerName",
            "period",
            F.col("h.nameOfIssuer").alias("companyName"),
            F.col("h.titleOfClass").alias("title"),
            F.col("h.cusip").alias("cusip"),
            F.col("h.value").alias("value"),
            F.col("h.shrsOrPrnAmt.sshPrnamt").alias("shares"),
            F.col("h.shrsOrPrnAmt.sshPrnamtType").alias("shareType"),
        )
    )


def is_common_stock(
    share_type: str = SHARE_TYPE,
    words: tuple[str, ...] = STOCK_WORDS,
    kind: Column | str = "shareType",
    title: Column | str = "title",
) -> Column:
    """Exact share type, and a title that holds any word (case matters)."""
    kind, title = (F.col(c) if isinstance(c, str) else c for c in (kind, title))
    any_word = F.lit(False)
    for word in words:
        any_word = any_word | F.contains(title, F.lit(word))
    return (kind == share_type) & any_word


def security_filter(
    lines: DataFrame,
    share_type: str = SHARE_TYPE,
    words: tuple[str, ...] = STOCK_WORDS,
    drop_zero_cusip: bool = False,
) -> DataFrame:
    """Common stock only; a line whose type or title is missing is not known to be any."""
    # One filter: of two in a row the optimizer loses a column of parsed filings.
    kept = is_common_stock(share_type, words)
    return lines.filter(kept & (F.col("cusip") != NO_SECURITY) if drop_zero_cusip else kept)


def missing_part(lines: DataFrame) -> Column:
    """Why a line cannot be judged or keyed; null if nothing is missing."""
    reason = F.when(F.col("managerCik").isNull(), "no manager")
    if "title" in lines.columns:
        reason = reason.when(F.col("title").isNull(), "no title").when(F.col("shareType").isNull(), "no share type")
    return reason.when(F.col("cusip").isNull(), "no cusip")


def typed_lines(lines: DataFrame, compat: bool = False) -> DataFrame:
    """Text lines -> typed holdings, with ``reason`` set where a part is missing or does not parse."""
    typed = lines.select(
        *[c for c in ("file_name", "fileReason", "line") if c in lines.columns],
        ids.source_from_file_name(F.col("file_name")).alias("source"),
        "managerCik",
        "managerAddress",
        "managerName",
        values.parse_period(F.col("period")).alias("reportCalendarOrQuarter"),
        ids.cusip6(F.col("cusip")).alias("cusip6"),
        F.upper("cusip").alias("cusip"),
        "companyName",
        values.scaled_value(F.col("value"), compat).alias("value"),
        F.col("shares").try_cast("bigint").alias("shares"),
        missing_part(lines).alias("missing"),
    )
    reason = (
        F.when(F.col("missing").isNotNull(), F.col("missing"))
        .when(F.col("reportCalendarOrQuarter").isNull(), "bad period")
        .when(F.col("value").isNull(), "bad value")
        .when(F.col("shares").isNull(), "bad shares")
    )
    return typed.withColumn("reason", reason).drop("missing")


def holdings_from_xml(
    raw: DataFrame,
    share_type: str = SHARE_TYPE,
    words: tuple[str, ...] = STOCK_WORDS,
    compat: bool = False,
    drop_zero_cusip: bool = False,
) -> DataFrame:
    """Raw submissions -> typed, filtered holdings; bad files and lines are in :func:`parse_failures`.

    With the same settings, every line of a file that parsed is a holding, a failure, or filtered out.
    """
    lines = security_filter(holding_lines(parse_submissions(raw)), share_type, words, drop_zero_cusip)
    return typed_lines(lines, compat).filter(F.col("reason").isNull()).drop("reason")


def parse_failures(
    raw: DataFrame,
    share_type: str = SHARE_TYPE,
    words: tuple[str, ...] = STOCK_WORDS,
    compat: bool = False,
    drop_zero_cusip: bool = False,
) -> DataFrame:
    """Quarantine: every file or line that gave no holding because it could not be read: file, stage, reason.

    Files and lines are told apart after one parse. A line that may be common stock, because its title or type is
    missing, counts as one that could not be read.
    """
    lines = holding_lines(parse_submissions(raw), keep_failed=True)
    failed = F.col("fileReason").isNotNull()
    wanted = F.coalesce(is_common_stock(share_type, words), F.lit(True))
    if drop_zero_cusip:
        wanted = wanted & F.coalesce(F.col("cusip") != NO_SECURITY, F.lit(True))
    typed = typed_lines(lines.filter(failed | wanted), compat)
    return typed.filter(failed | F.col("reason").isNotNull()).select(
        F.col("file_name").alias("file"),
        F.when(failed, "parse").otherwise("types").alias("stage"),
        F.coalesce("fileReason", "reason").alias("reason"),
    )


def rollup(holdings: DataFrame, order_by: tuple[str, ...] = ("companyName",)) -> DataFrame:
    """Sum value and shares per filing, manager, period and security.

    The name is the first that is not null in ``order_by`` order. Rows with a null key drop out.
    Sums and the first name combine before the shuffle, so a popular security costs no more than others.
    """
    if tuple(order_by) == ("companyName",):
        first_name = F.min("companyName")
    else:
        # min_by passes over rows whose order is null, so unnamed rows never win.
        first_name = F.min_by("companyName", F.when(F.col("companyName").isNotNull(), F.struct(*order_by)))
    return (
        holdings.dropna(subset=list(ROLLUP_KEYS))
        .groupBy(*ROLLUP_KEYS)
        .agg(first_name.alias("companyName"), F.sum("value").alias("value"), F.sum("shares").alias("shares"))
    )


def rollup_filings(
    raw: DataFrame,
    share_type: str = SHARE_TYPE,
    words: tuple[str, ...] = STOCK_WORDS,
    compat: bool = False,
    drop_zero_cusip: bool = False,
) -> DataFrame:
    """``rollup(holdings_from_xml(raw), ("line",))`` without a shuffle, for raw files that each have their own source.

    A filing is one row, so its lines are sorted by security, cut where the security changes and folded in the row,
    in time that grows as a sort of them does.
    """
    page = "cover.formData.coverPage"

    def typed(line: Column, at: Column) -> Column:
        return F.struct(
            F.upper(line["cusip"]).alias("cusip"),
            at.alias("line"),
            line["nameOfIssuer"].alias("companyName"),
            values.scaled_value(line["value"], compat).alias("value"),
            line["shrsOrPrnAmt"]["sshPrnamt"].try_cast("bigint").alias("shares"),
        )

    def wanted(line: Column) -> Column:
        kept = is_common_stock(share_type, words, line["shrsOrPrnAmt"]["sshPrnamtType"], line["titleOfClass"])
        return kept & (line["cusip"] != NO_SECURITY) if drop_zero_cusip else kept

    def usable(line: Column) -> Column:
        return line["cusip"].isNotNull() & line["value"].isNotNull() & line["shares"].isNotNull()

    value_kind = "double" if compat else "decimal(38,6)"
    nothing = F.struct(
        F.lit(None).cast("string").alias("companyName"), F.lit(0).cast(value_kind).alias("value"), F.lit(0).cast("bigint").alias("shares")
    )

    def added(total: Column, line: Column) -> Column:
        return F.struct(
            F.coalesce(total["companyName"], line["companyName"]).alias("companyName"),
            (total["value"] + line["value"]).cast(value_kind).alias("value"),
            (total["shares"] + line["shares"]).alias("shares"),
        )

    def cusip(at: Column) -> Column:
        return F.get("_lines", at)["cusip"]

    def cut(starts: Column) -> Column:
        def folded(at: Column, n: Column) -> Column:
            end = F.coalesce(F.get(starts, n + 1), F.size("_lines"))
            return F.struct(cusip(at).alias("cusip"), F.aggregate(F.slice("_lines", at + 1, end - at), nothing, added).alias("total"))

        return F.transform(starts, folded)

    lines = F.filter(F.transform(F.filter("holdings.infoTable", wanted), typed), usable)
    parsed = parse_submissions(raw).filter(F.col("reason").isNull())
    # Made by a generator: of plain columns, the filters that Spark puts before ``inline`` compute all of them again.
    filings = computed_once(
        parsed,
        source=ids.source_from_file_name(F.col("file_name")),
        managerCik=F.col("cover.headerData.filerInfo.filer.credentials.cik"),
        managerAddress=F.array_join(F.map_values(f"{page}.filingManager.address"), ", "),
        managerName=F.col(f"{page}.filingManager.name"),
        reportCalendarOrQuarter=values.parse_period(F.col(f"{page}.reportCalendarOrQuarter")),
    )
    of_filing = [c for c in ROLLUP_KEYS if c in filings.columns]
    # By themselves, since Spark generates no code for what has a lambda.
    sorted_ = computed_once(filings.dropna(subset=of_filing).select(*of_filing, "holdings"), _lines=F.array_sort(lines)).drop("holdings")
    some = sorted_.filter(F.size("_lines") > 0)
    starts = F.filter(F.sequence(F.lit(0), F.size("_lines") - 1), lambda at: (at == 0) | (cusip(at) != cusip(at - 1)))
    rolled = computed_once(some, securities=let(starts, cut)).select(*of_filing, F.inline("securities"))
    return rolled.withColumn("cusip6", ids.cusip6(F.col("cusip"))).select(*ROLLUP_KEYS, "total.*")


def period_counts(holdings: DataFrame) -> DataFrame:
    return (
        holdings.groupBy("reportCalendarOrQuarter")
        .agg(F.count("value").alias("rows"))
        .orderBy("reportCalendarOrQuarter")
    )


def top_periods(holdings: DataFrame, n: int) -> DataFrame:
    """Rows of the ``n`` most recent periods that a roll-up would keep. The broadcast side has at most ``n`` rows.

    Rows with a null key drop out first, as in :func:`rollup`, so they name no period.
    """
    if n < 1:
        raise ValueError("n must be at least 1")
    key = "reportCalendarOrQuarter"
    holdings = holdings.dropna(subset=[c for c in ROLLUP_KEYS if c in holdings.columns])
    recent = holdings.select(key).filter(F.col(key).isNotNull()).distinct().orderBy(F.desc(key)).limit(n)
    return holdings.join(F.broadcast(recent) if n <= MAX_BROADCAST_PERIODS else recent, key, "left_semi")
