"""Run audit rows, the Year level, wide section projections, time-dim check."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from reports import dims, month_report, write_reports
from tallyspark.operators import sections
from tallyspark.plans.audit import JobInfo, run_with_audit
from tallyspark.plans.load import load_files
from tallyspark.sinks.tables import append
from tallyspark.sources.dims import read_time_dim
from tallyspark.sources.reports import read_reports


def test_audit_phases(spark, tmpdir_path):
    import os
    os.makedirs(f"{tmpdir_path}/in")
    write_reports(f"{tmpdir_path}/in", {"a.csv": month_report(this_rows=["[T|r|w|s|V|T],12%," + "1," * 10 + "1"])})
    mm, su, td = dims(spark)
    job = JobInfo("metrics", "monthly", "web", "portal")

    def load():
        res = load_files(spark, f"{tmpdir_path}/in", mm, su, td, "Month", "R", observe=True)
        return res, lambda rows: append(rows, f"{tmpdir_path}/out")
    run_with_audit(spark, f"{tmpdir_path}/audit", job, load)

    def failing():
        raise RuntimeError("boom")
    with pytest.raises(RuntimeError, match="boom"):
        run_with_audit(spark, f"{tmpdir_path}/audit", job, failing)
    rows = {r.phase: r for r in spark.read.parquet(f"{tmpdir_path}/audit").collect() if r.phase != "start"}
    # one this-year metric row (12 periods) + two last-year rows (24)
    assert rows["end"].prereccount == 12 + 24 and rows["end"].rejreccount == 1
    assert rows["end"].postreccount == 12 + 24 - 1
    assert spark.read.parquet(f"{tmpdir_path}/out").count() == 35
    assert rows["fail"].error == "boom"


def test_year_level_emits_summary(spark, tmpdir_path):
    write_reports(tmpdir_path, {"a.csv": month_report()})
    mm, su, td = dims(spark)
    years = spark.createDataFrame([("Y", "Year", "2022", "2022"), ("Y", "Year", "2021", "2021")],
                                  "timelvl string, timelvlnm string, timeid string, timeidnm string")
    res = load_files(spark, tmpdir_path, mm, su, td.unionByName(years), "Year", "R")
    got = sorted((r.timeid, r.metric_value) for r in res.rows.collect())
    assert got == [("2021", "90.0"), ("2022", "100.0")]


def test_wide_section_projection(spark, tmpdir_path):
    write_reports(tmpdir_path, {"a.csv": month_report()})
    parsed = read_reports(spark, tmpdir_path)
    heads = sections.report_heads(parsed, "Month")
    starts = sections.section_starts(heads)
    body = sections.carve(parsed, sections.section_bounds(parsed, starts))
    wide = sections.project_section(body, "month_this")
    assert wide.columns[2:4] == ["metrix", "all_visits_this_year_january"]
    assert sorted(r.all_visits_this_year_december for r in wide.collect()) == ["11", "21"]
    summary = sections.project_section(body, "summary").collect()
    assert [(r.metrix, r.all_visits_this_year, r.all_visits_last_year) for r in summary] == \
        [("[T|retail|web|shop|Visits|Traffic]", "100", "90")]


def test_time_dim_from_path_or_missing(spark, tmpdir_path):
    _, _, td = dims(spark)
    td.write.parquet(f"{tmpdir_path}/td")
    assert read_time_dim(spark, f"{tmpdir_path}/td").where(F.col("timelvlnm") == "Month").count() == 48
    with pytest.raises(LookupError):
        read_time_dim(spark, "no_such_db.no_such_table")
