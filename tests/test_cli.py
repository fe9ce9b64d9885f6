"""The command line runs end to end in-process: ingest -> daily -> weekly -> dedup -> report."""

import os

import pytest

from tests import helpers
from yieldspark import cli
from yieldspark.sources import fixtures as fx

SF = "/root/testdata/sf0.001"


def test_cli_chain(spark, scratch):
    drop = os.path.join(scratch, "drop")
    fx.workstation_report(spark, SF).drop("source_file", "row_ordinal").coalesce(3) \
        .write.option("header", True).csv(drop)
    log, out = os.path.join(scratch, "log"), os.path.join(scratch, "out")
    res = cli.main(["ingest", "--drop", drop, "--log", log, "--checkpoint", os.path.join(scratch, "ck")], spark)
    assert res["rows_in_log"] == fx.workstation_log(spark, SF).count()
    assert "daily_tpy_metrics" in cli.main(["daily", "--log", log, "--out", out], spark)
    assert "weekly_tpy_metrics" in cli.main(["weekly", "--log", log, "--out", out, "--mode", "recent",
                                             "--as-of", "2024-01-19"], spark)
    d = cli.main(["dedup", "--log", log, "--to", os.path.join(scratch, "log2")], spark)
    assert d["before"] == d["after"]  # the ingest already dropped the re-exported copies
    rep = cli.main(["report", "--log", log, "--out", out, "--as-of", "2024-01-19"], spark)
    assert rep["daily_tpy_metrics"]["rows_on_as_of"] > 0
    with pytest.raises(SystemExit):
        cli.main(["daily", "--log", log, "--out", out, "--mode", "recent"], spark)


@pytest.mark.parametrize("kind", ["testboard", "snfn"])
def test_cli_ingests_every_kind(spark, scratch, kind):
    drop, log = os.path.join(scratch, "drop"), os.path.join(scratch, "log")
    report = {"testboard": helpers.testboard_report, "snfn": helpers.snfn_report}[kind](spark, SF)
    report.coalesce(1).write.option("header", True).csv(drop)
    res = cli.main(["ingest", "--drop", drop, "--log", log, "--checkpoint", os.path.join(scratch, "ck"), "--kind", kind], spark)
    want = report.distinct().count()
    assert res["rows_in_log"] == want and res["quarantined"] == 0
    assert {r.data_source for r in spark.read.parquet(log).select("data_source").distinct().collect()} == {kind}


def test_cli_ingest_without_a_good_row(spark, scratch):
    drop, log = os.path.join(scratch, "drop"), os.path.join(scratch, "log")
    os.makedirs(drop)
    with open(os.path.join(drop, "a.csv"), "w") as f:
        f.write("Color,Size\nred,1\n")
    res = cli.main(["ingest", "--drop", drop, "--log", log, "--checkpoint", os.path.join(scratch, "ck")], spark)
    assert res == {"rows_read": 1, "added": 0, "quarantined": 1, "rows_in_log": 0}
