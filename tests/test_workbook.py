"""Workbook drop scan (A2): .xlsx files -> text cells -> conformed log rows."""

import datetime as dt
import os

from yieldspark import schemas
from yieldspark.operators import ingest
from yieldspark.sources import workbook
from tests.xlsx_writer import write_xlsx


def test_scan_and_conform_workbooks(spark, scratch):
    hdr = ["SN", "Model", "Workstation Name", "History Station Start Time", "History Station End Time",
           "History Station Passing Status", "Service Flow", "Day"]
    t = dt.datetime(2025, 7, 7, 23, 48, 1)
    book1 = [hdr, ["S1", "Tesla SXM4", "VI2", None, t, "Pass", "NORMAL", "7/7/2025"],
             ["S1", "Tesla SXM4", "VI2", None, t, "Pass", "NORMAL", "7/8/2025"],  # in-file copy, other Day
             ["S2", "Tesla SXM5", "FQC", t - dt.timedelta(minutes=5), t, "Fail", "", "7/7/2025"]]
    book2 = [hdr, ["S3", "Tesla SXM5", "PACKING", None, "2025-07-08 01:02:03", "Pass", "nan", "7/8/2025"]]
    os.makedirs(os.path.join(scratch, "drop", "sub"))
    write_xlsx(os.path.join(scratch, "drop", "a.xlsx"), book1)
    write_xlsx(os.path.join(scratch, "drop", "sub", "b.xlsx"), book2)
    raw = workbook.scan_workbooks(spark, os.path.join(scratch, "drop"))
    cols = workbook.cells_to_columns(raw, [f.name for f in schemas.WORKSTATION_LOG.fields] + ["day"])
    conf = ingest.conform(cols, schemas.WORKSTATION_LOG, "workstation", start_falls_back_to_end=True)
    first = ingest.infile_dedup(conf, list(schemas.WORKSTATION_KEY))
    got = {r.sn: r for r in first.collect()}
    assert set(got) == {"S1", "S2", "S3"}
    assert got["S1"].history_station_end_time == t and got["S1"].history_station_start_time == t
    assert got["S2"].history_station_start_time == t - dt.timedelta(minutes=5)
    assert got["S2"].service_flow is None and got["S3"].service_flow is None
    assert got["S3"].history_station_end_time == dt.datetime(2025, 7, 8, 1, 2, 3)


def test_broken_workbook_is_one_error_row(spark, scratch):
    write_xlsx(os.path.join(scratch, "a.xlsx"), [["SN", "sn", "Model"], ["S1", "dup", "M"]])
    with open(os.path.join(scratch, "b.xlsx"), "wb") as f:
        f.write(b"PK broken")
    got = workbook.scan_workbooks(spark, scratch).collect()
    good = [r for r in got if r.error is None]
    assert [r.cells["sn"] for r in good] == ["S1"] and [r.source_file[-6:] for r in got if r.error] == ["b.xlsx"]


def _rows(n):
    return [["SN", "Model", "When"], *([f"S{i}", "M", dt.datetime(2025, 7, 7, 1, 2, i % 60)] for i in range(n))]


def test_long_sheets_are_read_row_by_row(scratch):
    import tracemalloc
    peaks = []
    for n in (2_000, 40_000):
        path = os.path.join(scratch, f"{n}.xlsx")
        write_xlsx(path, _rows(n))
        with open(path, "rb") as f:
            data = f.read()
        tracemalloc.start()
        assert sum(1 for _ in workbook.first_sheet_rows(data)) == n + 1
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    assert peaks[1] < peaks[0] + 2_000_000  # twenty times the rows


def test_a_sheet_that_breaks_off_gives_no_rows(spark, scratch):
    import zipfile
    good, bad = (os.path.join(scratch, x) for x in ("good.xlsx", "bad.xlsx"))
    write_xlsx(good, _rows(10_000))
    with zipfile.ZipFile(good) as a, zipfile.ZipFile(bad, "w") as b:
        for name in a.namelist():
            part = a.read(name)
            b.writestr(name, part[:len(part) * 9 // 10] if "sheet1" in name else part)
    got = workbook.scan_workbooks(spark, scratch)
    assert {(r.source_file[-9:], r.error is None): r["count"] for r in got.groupBy("source_file", "error").count().collect()} == {
        ("good.xlsx", True): 10_000, ("/bad.xlsx", False): 1}
    rows = got.where("error is null").orderBy("row_ordinal").collect()
    assert [r.row_ordinal for r in rows] == list(range(1, 10_001)) and rows[-1].cells["sn"] == "S9999"
