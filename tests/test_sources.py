import json

from pyspark.sql import functions as F

from ledgerloom import schemas
from ledgerloom.sources import files, filings


def test_company_map_keeps_leading_zeros(spark, tmp_path):
    path = tmp_path / "map.csv"
    path.write_text(
        "cik,cusip6,cusip,names\n"
        "0000320193,037833,\"{'037833100', '037833200'}\",{'APPLE INC'}\n"
        "7,,{'1'},{'X'}\n"
    )
    got = files.read_company_map(spark, str(path)).collect()
    assert (got[0].cik, got[0].cusip6, got[0].cusip) == ("0000320193", "037833", ["037833100", "037833200"])
    assert got[1].cusip6 is None and got[1].names == ["X"]


def test_csv_round_trip(spark, tmp_path, rows):
    frame = spark.createDataFrame([("01", 'say "hi", ok', ["a", "b"]), ("02", "", ["c"])], "cik string, t string, names array<string>")
    path = str(tmp_path / "out")
    files.write_csv(frame, path)
    back = files.read_csv(spark, path, "cik STRING, t STRING, names STRING")
    assert rows(back) == [("01", 'say "hi", ok', "{'a', 'b'}"), ("02", None, "{'c'}")]


def test_section_files_take_their_id_from_the_name(spark, tmp_path):
    doc = {"item1": "a", "item1a": "b", "item7": "c", "item7a": "", "cik": "1", "cusip6": "2", "cusip": ["3"], "names": ["n"], "source": "s"}
    (tmp_path / "0000950170-23-001409.json").write_text(json.dumps(doc, indent=4))
    row = files.read_section_files(spark, str(tmp_path)).first()
    assert row.formId == "0000950170-23-001409" and row.item7a == "" and row.cusip == ["3"]


def test_filing_history(spark, tmp_path, rows):
    recent = {
        "accessionNumber": ["a-1", "a-2", "a-3", "a-4"],
        "form": ["10-K", "10-K/A", "10-K", "10-K"],
        "filingDate": ["2022-01-01", "2022-02-01", "2022-12-31", "2023-01-01"],
    }
    (tmp_path / "CIK0000000042.json").write_text(json.dumps({"filings": {"recent": recent}}, indent=2))
    empty = {"accessionNumber": [], "form": [], "filingDate": []}
    (tmp_path / "CIK0000000043.json").write_text(json.dumps({"filings": {"recent": empty}}))
    (tmp_path / "CIK0000000044.json").write_text("{}")
    listed = filings.filing_history_rows(files.read_filing_history(spark, str(tmp_path)))
    assert listed.count() == 4
    # Both ends of the range count.
    kept = filings.annual_reports(listed, "2022-01-01", "2022-12-31")
    assert rows(kept, "cik", "accessionNumber") == [("42", "a-1"), ("42", "a-3")]


def test_index_lines(spark, tmp_path, rows):
    lines = [
        "Description: Master Index",
        "CIK|Company Name|Form Type|Date Filed|File Name",
        "-----",
        "1|A \"B\" Co|13F-HR|20230102|edgar/data/1/a.txt",
        '2|"C | D ""E"""|13F-HR|20230102|edgar/data/2/b.txt',
        "3|F|13F-HR/A|20230102|edgar/data/3/c.txt",
        "4|G|13F-HR|edgar/data/4/d.txt",
    ]
    (tmp_path / "master.idx").write_text("\n".join(lines))
    paths = filings.index_paths(files.read_index_lines(spark, str(tmp_path)))
    assert rows(paths) == [("/Archives/edgar/data/1/a.txt",), ("/Archives/edgar/data/2/b.txt",)]


def test_calendar_runs_backwards_and_counts_both_ends(spark):
    bounds = spark.sql("SELECT DATE'2022-12-30' AS start_date, DATE'2023-01-02' AS end_date")
    got = filings.daily_index_paths(bounds).collect()
    assert [str(r.day) for r in got] == ["2023-01-02", "2023-01-01", "2022-12-31", "2022-12-30"]
    assert got[0].path == "/Archives/edgar/daily-index/2023/QTR1/master.20230102.idx"
    reversed_bounds = spark.sql("SELECT DATE'2023-01-02' AS start_date, DATE'2022-12-30' AS end_date")
    assert filings.calendar(reversed_bounds).count() == 0


def test_explode_urls_and_preview(spark, rows):
    frame = spark.createDataFrame([("1", ["u", "v"]), ("2", [])], "cik string, form10KUrls array<string>")
    assert rows(filings.explode_urls(frame)) == [("1", "u"), ("1", "v")]
    assert [r.cik for r in filings.preview(frame, 1, "cik").collect()] == ["1"]


def test_raw_files_keep_name_and_normalise_newlines(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes(b"x\r\ny")
    (tmp_path / "b.csv").write_bytes(b"z")
    assert [tuple(r) for r in files.read_raw_files(spark, str(tmp_path)).collect()] == [("a.txt", "x\ny")]


def test_history_schema_is_declared(spark):
    assert spark.createDataFrame([], schemas.FILING_HISTORY).select(F.col("filings.recent.form")).count() == 0


def test_files_named_after_paths(spark, tmp_path, rows):
    (tmp_path / "_Archives_a.txt").write_bytes(b"x\r\ny")
    (tmp_path / "_Archives_b.txt").write_bytes("é".encode())
    (tmp_path / "_c.csv").write_bytes(b"z")
    assert files.read_raw_files(spark, str(tmp_path)).count() == 0
    assert rows(files.read_underscored_files(spark, str(tmp_path))) == [("_Archives_a.txt", "x\ny"), ("_Archives_b.txt", "é")]


def test_landed_files_come_with_a_reason_if_unreadable(spark, tmp_path, rows):
    frame = spark.createDataFrame([("_a.txt", b"x\r\ny"), ("b.txt", b""), ("_c.txt", b"\xff"), ("d.csv", b"z")], "file_name string, content binary")
    assert files.write_raw_files(frame, str(tmp_path)) == 4 == files.write_raw_files(frame, f"file:{tmp_path}")
    landed = files.landed_files(spark, str(tmp_path))
    assert rows(landed) == [("_a.txt", 4, "x\ny", None), ("_c.txt", 1, None, "not UTF-8"), ("b.txt", 0, None, "empty file")]
    assert rows(files.unreadable_files(landed)) == [("_c.txt", "parse", "not UTF-8"), ("b.txt", "parse", "empty file")]
    assert rows(files.read_underscored_files(spark, str(tmp_path))) == [("_a.txt", "x\ny")]


def test_an_empty_folder_has_no_files(spark, tmp_path):
    assert files.landed_files(spark, str(tmp_path)).count() == 0
    assert files.write_raw_files(spark.createDataFrame([], "file_name string, content binary"), str(tmp_path / "new")) == 0


def test_url_table_meets_on_the_number_of_the_cik(spark, rows):
    companies = spark.createDataFrame([("0000000007", "c1"), ("8", "c2"), ("x", "c3")], "cik string, cusip6 string")
    listed = [
        ("7", "a-2", "10-K", "2023-05-01"), ("0007", "a-1", "10-K", "2022-05-01"), ("7", "a-3", "10-K/A", "2023-05-02"),
        ("7", "a-4", "10-K", "2020-01-01"), ("9", "a-5", "10-K", "2023-01-01"),
    ]
    history = spark.createDataFrame(listed, "cik string, accessionNumber string, form string, filingDate string")
    found = filings.company_urls(companies, history.withColumn("filingDate", F.to_date("filingDate")), "2022-01-01", "2023-12-31")
    got = found.first()
    assert found.count() == 1 and (got.cik, got.cusip6) == ("0000000007", "c1")
    assert got.form10KUrls == ["/Archives/edgar/data/7/a1/a-1.txt", "/Archives/edgar/data/7/a2/a-2.txt"]


def test_range_and_form_reach_the_scan_of_a_stored_history(spark, tmp_path):
    path = str(tmp_path / "history")
    history = spark.createDataFrame([("7", "a", "10-K", "2023-05-01")], "cik string, accessionNumber string, form string, filingDate string")
    history.withColumn("filingDate", F.to_date("filingDate")).write.parquet(path)
    kept = filings.annual_reports(spark.read.parquet(path), "2023-01-01", "2023-12-31")
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    plan = kept._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = plan[plan.index("PushedFilters") :]
    assert "GreaterThanOrEqual(filingDate" in pushed and "EqualTo(form,10-K)" in pushed and kept.count() == 1


def test_holdings_survive_csv(spark, tmp_path):
    record = ("s", "m", "1, Main", "n", "2023-03-31", "c", "cx", None, "1234567890123.500000", 7)
    names = "source managerCik managerAddress managerName reportCalendarOrQuarter cusip6 cusip companyName value shares".split()
    frame = spark.createDataFrame([record], ", ".join(f"{n} {'bigint' if n == 'shares' else 'string'}" for n in names))
    typed = frame.withColumns({"reportCalendarOrQuarter": F.to_date("reportCalendarOrQuarter"), "value": F.col("value").cast("decimal(28,6)")})
    files.write_csv(typed, str(tmp_path / "h"))
    assert files.read_holdings(spark, str(tmp_path / "h")).collect() == typed.collect()


def test_stream_reads_a_table_of_many_files(spark, tmp_path):
    """As the tables of a large store are: a folder per table; several batches."""
    from ledgerloom.plans import holdings, incremental
    from ledgerloom.plans.catalog import Tables

    folder = "/root/testdata/sf0.001"
    for name in ("lineitem", "part"):
        spark.read.parquet(f"{folder}/{name}.parquet").repartition(20).write.parquet(str(tmp_path / f"{name}.parquet"))
    got = incremental.incremental_holdings(Tables(spark, str(tmp_path)))
    want = holdings.holdings_rollup(Tables(spark, folder))
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect())) != []


def test_a_mounted_folder_is_listed_entry_by_entry(tmp_path, monkeypatch):
    for n in range(3):
        (tmp_path / f"_{n}.txt").write_text("x" * n)
    (tmp_path / "sub.txt").mkdir()
    store, folder = files._store(str(tmp_path))

    class Whole:
        def __init__(self, *_):
            raise AssertionError("the whole folder is listed at once")

    monkeypatch.setattr(files.pafs, "FileSelector", Whole)
    assert sorted((name, size) for _, name, size in files._entries(store, folder, ".txt")) == [("_0.txt", 0), ("_1.txt", 1), ("_2.txt", 2)]
