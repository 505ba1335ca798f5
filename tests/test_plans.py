"""Plan shape: no Python UDFs, pushed filters, carve equal to a row model."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from reports import dims, month_report, write_reports
from tallyspark.operators import lookups, sections
from tallyspark.plans.load import load_files
from tallyspark.sources.reports import number_lines, parse_lines


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_load_has_no_python_nodes(spark, tmpdir_path):
    write_reports(tmpdir_path, {"a.csv": month_report()})
    mm, su, td = dims(spark)
    res = load_files(spark, tmpdir_path, mm, su, td, "Month", "R")
    plan = _plan(res.rows)
    for node in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "FlatMapGroupsInPandas", "MapInPandas"):
        assert node not in plan


def test_time_level_filter_reaches_scan(spark, tmpdir_path):
    rows = [("M", "Month", "202201", "Jan"), ("Q", "Quarter", "20221", "Q1")]
    spark.createDataFrame(rows, "timelvl string, timelvlnm string, timeid string, timeidnm string") \
        .write.parquet(f"{tmpdir_path}/td")
    cal = lookups.time_level(spark.read.parquet(f"{tmpdir_path}/td"), "Month")
    assert "PushedFilters: [IsNotNull(timelvlnm), EqualTo(timelvlnm,Month)]" in _plan(cal)


def _row_model(lines, level_kind_offset=2):
    """Row-by-row carve of one report: last summary header, body from +2 to
    the first '####' at or after the start."""
    heads = [i for i, l in enumerate(lines) if "#" in l and "Metrics" in l and "by" not in l]
    if not heads:
        return []
    start = heads[-1] + level_kind_offset
    out = []
    for i in range(start, len(lines)):
        if "####" in lines[i]:
            break
        if "|" in lines[i]:
            out.append(i)
    return out


def test_carve_equals_row_model(spark):
    random.seed(11)
    kinds = ["# Site Metrics", "####", "[T|a|b|c|d|e],1", "other", "x|y,2"]
    reports = {f"r{n}": [random.choice(kinds) for _ in range(random.randint(0, 40))] for n in range(60)}
    data = [(rid, i, l) for rid, ls in reports.items() for i, l in enumerate(ls)]
    lines = spark.createDataFrame(data, "report_id string, raw_pos long, line string")
    parsed = parse_lines(number_lines(lines, chunk=7))     # small chunks: offsets across chunks
    heads = sections.report_heads(parsed, "Month")
    starts = sections.section_starts(heads).where(F.col("kind") == "summary")
    body = sections.carve(parsed, sections.section_bounds(sections.markers(parsed, "Month"), starts))
    got = sorted((r.report_id, r.pos) for r in body.collect())
    want = sorted((rid, p) for rid, ls in reports.items() for p in _row_model(ls))
    assert got == want


def test_lines_are_not_shuffled(spark, tmpdir_path):
    """Pass 2 streams the stored scan through broadcast joins only."""
    write_reports(tmpdir_path, {f"r{i}.csv": month_report() for i in range(5)})
    mm, su, td = dims(spark)
    res = load_files(spark, tmpdir_path, mm, su, td, "Month", "R")
    res.rows.write.format("noop").mode("overwrite").save()
    plan = _plan(res.rows)
    assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan
    assert plan.count("BroadcastHashJoin") >= 4      # split offsets, bounds, metric ids, calendar
    assert "FileScan text" not in plan               # the text is read once, and stored


def _set_model(col1, level):
    """Per kind, the metric rows from its last header's body start on with no
    separator between that start and the row."""
    rules = {"summary": (2, lambda c: "by" not in c), "month_this": (5, lambda c: level == "Month" and "month - this" in c),
             "month_last": (5, lambda c: level == "Month" and "month - last" in c),
             "quarter": (5, lambda c: level == "Quarter" and "quarter" in c)}
    heads = {i: next((k for k, (_, is_kind) in rules.items() if is_kind(c)), None)
             for i, c in enumerate(col1) if "#" in c and "Metrics" in c}
    last = {k: max(i for i, found in heads.items() if found == k) + rules[k][0] for k in set(heads.values()) - {None}}
    stops = [i for i, c in enumerate(col1) if "####" in c]
    return {k: [r for r, c in enumerate(col1) if r >= s and "|" in c and not any(s <= x <= r for x in stops)]
            for k, s in last.items()}


def test_all_kinds_equal_set_model(spark):
    random.seed(5)
    vocab = ["# Site Metrics", "# Site Metrics by month - this year", "# Site Metrics by month - last year",
             "# Site Metrics by quarter", "# site Metrics by month - this year", "# Metrics by week",
             "####", "[T|a|b|c|d|e],1", "[T|a|b|c|d|e],2", "h", "x|y,3", "Metrics # | by"]
    weights = [2, 2, 2, 2, 1, 1, 4, 8, 8, 4, 2, 1]
    reports = {f"r{n}": random.choices(vocab, weights, k=random.randint(0, 60)) for n in range(120)}
    data = [(rid, i, l) for rid, ls in reports.items() for i, l in enumerate(ls)]
    lines = spark.createDataFrame(data, "report_id string, raw_pos long, line string")
    parsed = parse_lines(number_lines(lines))
    for level in ("Month", "Quarter"):
        marks = sections.markers(parsed, level)
        starts = sections.section_starts(sections.report_heads(marks, level))
        body = sections.carve(parsed, sections.section_bounds(marks, starts))
        got = sorted((r.report_id, r.kind, r.pos) for r in body.collect())
        want = sorted((rid, kind, p) for rid, ls in reports.items()
                      for kind, ps in _set_model([l.split(",")[0] for l in ls], level).items() for p in ps)
        assert got == want, level


def test_number_lines_matches_python_model(spark):
    random.seed(9)
    kinds = ["a,b", "", "   ", "\t", "x" + ",1" * 13, "y" + ",1" * 12 + ",", "z" + ",1" * 12, '"q,1",2']
    reports = {f"r{n}": [random.choice(kinds) for _ in range(random.randint(0, 50))] for n in range(40)}
    data = [(rid, i * 3, l) for rid, ls in reports.items() for i, l in enumerate(ls)]   # gaps in raw_pos
    lines = spark.createDataFrame(data, "report_id string, raw_pos long, line string")

    def keep(l):
        return l.strip(" \t") != "" and l.replace('"q,1"', "q").count(",") <= 12
    want = sorted((rid, p, l) for rid, ls in reports.items() for p, l in enumerate([x for x in ls if keep(x)]))
    for chunk in (5, 1 << 20):
        got = sorted((r.report_id, r.pos, r.line) for r in number_lines(lines, chunk=chunk).collect())
        assert got == want, chunk
