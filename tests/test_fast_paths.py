"""The short ways for usual lines and cells give what the general rules give,
and the load stays small enough for the JVM to compile."""

import contextlib
import io
import itertools
import re

from pyspark.sql import functions as F

from tallyspark.functions import quotes
from tallyspark.functions.values import parse_value, value_ok
from tallyspark.operators import sections
from tallyspark.operators.reshape import unpivot_periods
from tallyspark.plans.load import load_files
from tallyspark.sources import reports
from tallyspark.sources.reports import parse_lines


def _lines():
    pieces = ["", "a", '"', '""', ",", '"x, y"', "\n"]
    return sorted({"".join(p) for n in range(1, 5) for p in itertools.product(pieces, repeat=n)})


def _walk(line, inside=False):
    """Fields of a line and whether its last one is open, a character at a time."""
    state, done, cur = ("inside" if inside else "start"), [], ""
    for ch in line:
        if state in ("inside", "seen") and ch == '"':
            cur += '"' if state == "seen" else ""
            state = "seen" if state == "inside" else "inside"
        elif state == "inside":
            cur += ch
        elif ch == ",":
            done, cur, state = done + [cur], "", "start"
        elif ch == '"' and state == "start":
            state = "inside"
        else:
            cur, state = cur + ch, "field"
    return done + [cur], state == "inside"


def test_quotes_follow_the_walk(spark):
    long = '"' + 'a""b,' * 20_000 + '"c,' + 'x"y,' * 5_000 + '"open ""'
    df = spark.createDataFrame([(x,) for x in _lines() + [long]], "line string")
    line = F.col("line")
    rows = df.select("line", quotes.cells(line).alias("c"), quotes.ends_inside(line).alias("e"),
                     quotes.ends_inside(line, True).alias("e_in")).collect()
    assert [r.line for r in rows if (r.c, r.e) != _walk(r.line)] == []
    assert [r.line for r in rows if r.e_in != _walk(r.line, True)[1]] == []


def test_blank_lines_and_cells_as_before(spark):
    lines = _lines() + ["﻿a,b", "﻿", " ", "\t ", " \n", " ", "\x7f", "\x00,b", "a\rb,c", " a, b ", "," * 12, "," * 13, "é,ü"]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "pos long, line string")
    line = F.col("line")
    old = F.regexp_replace(line, "^﻿", "")
    bad = df.where((reports.strip_bom(line) != old) | (reports.is_blank(line) != line.rlike(r"^[ \t]*$")))
    assert bad.collect() == []
    plain = df.where(~line.contains('"') & (line != "")).select(F.lit("r").alias("report_id"), "pos", "line")
    csv = F.from_csv(line, reports.REPORT_SCHEMA_DDL, reports.CSV_OPTIONS)
    got = {r.pos: tuple(r)[4:] for r in reports.parse_lines(plain).collect()}
    want = {r.pos: tuple(r)[1:] for r in plain.select("pos", csv.alias("c")).select("pos", "c.*").collect()}
    assert got == want


def test_value_is_null_exactly_where_it_is_not_ok(spark):
    cells = ["1", "-0", "007", " 7 ", "1_0", "1__0", "1e5", "1e400", "inf", "-Infinity", "+nan", " -inf ", "x", "", "N/A", None, "1.", ".5", "1,0", "5\n"]
    df = spark.createDataFrame([(x,) for x in cells], "raw string")
    rows = df.select("raw", parse_value(F.col("raw")).alias("v"), value_ok(F.col("raw")).alias("ok")).collect()
    assert [r.raw for r in rows if (r.v is not None) != r.ok] == []
    assert {r.raw: r.v for r in rows}["-Infinity"] == float("-inf") and {r.raw: r.v for r in rows}["1_0"] == 10.0


def test_periods_of_every_kind_and_a_missing_year(spark):
    cols = ", ".join(f"col{i} string" for i in range(2, 14))
    data = [(k, y, *[str(i) for i in range(1, 13)]) for k in ("month_last", "month_this", "quarter", "summary") for y in (2024, None)]
    out = unpivot_periods(spark.createDataFrame(data, f"kind string, year int, {cols}"), []).collect()
    got = {(r.kind, r.year, r.slot): r.timeid for r in out}
    assert all(r.raw == str(r.slot) for r in out) and len(out) == 2 * (12 + 12 + 8 + 2)
    assert got[("month_last", 2024, 2)] == "202302" and got[("month_this", 2024, 12)] == "202412"
    assert [got[("quarter", 2024, s)] for s in range(1, 9)] == ["20231", "20232", "20233", "20234", "20241", "20242", "20243", "20244"]
    assert got[("summary", 2024, 1)] == "2024" and got[("summary", 2024, 2)] == "2023"
    assert got[("month_this", None, 1)] == "null01" and got[("quarter", None, 8)] == "null4" and got[("summary", None, 1)] is None


def test_load_is_compiled(spark):
    """The JVM leaves methods above 8000 bytes to its interpreter; the load's
    longest one had 12854."""
    from tallyspark.constants import LEVEL_MONTH
    from tallyspark.plans.load import load_reports
    text = ["####", "# Company", "# Report suite: S", "# Date: 2024", "####"]
    for kind in ("this", "last"):
        text += [f"# Site Metrics by month - {kind} year", "####", "h", "h", "h", "[T|a|web|b|c|d]" + ",1" * 12, "####"]
    lines = spark.createDataFrame([("r", i, x) for i, x in enumerate(text)], "report_id string, raw_pos long, line string")
    result = load_reports(reports.parse_lines(reports.number_lines(lines)), spark.createDataFrame([("1", "x", 1)], "id string, name string, ord long"),
                          spark.createDataFrame([("S", "rs", 1)], "name string, rsid string, ord long"),
                          spark.createDataFrame([("M", "Month", "202401", "Jan")], "timelvl string, timelvlnm string, timeid string, timeidnm string"),
                          LEVEL_MONTH, "2024-01-01 00:00:00")
    # an adaptive plan shows its code only once it has run
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        with contextlib.redirect_stdout(io.StringIO()) as shown:
            result.rows.select("*").explain("codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", shown.getvalue())]
    assert max(sizes) < 8000
    assert result.rows.count() == 1


def test_first_cell_is_the_first_of_all_cells(spark):
    lines = _lines() + ['"a ', '"a"b"c,d', '"é|""|,1', 'st"ray,"x"']
    df = spark.createDataFrame([(t,) for t in lines], "line string")
    got = df.select("line", quotes.first_cell(F.col("line")).alias("first"), F.get(quotes.cells(F.col("line")), F.lit(0)).alias("cell"))
    assert [(r.line, r.first) for r in got.collect()] == [(r.line, r.cell) for r in got.collect()]


def test_files_are_listed_once(spark, tmpdir_path, monkeypatch):
    with open(f"{tmpdir_path}/empty.txt", "w"):
        pass
    with open(f"{tmpdir_path}/r.txt", "w") as f:
        f.write("# Company\n")
    reader, listed = type(spark.read), []
    text = reader.text
    monkeypatch.setattr(reader, "text", lambda self, *a, **k: listed.append(a) or text(self, *a, **k))
    dims = [spark.createDataFrame([], s) for s in ("id string, name string, ord long", "name string, rsid string, ord long",
                                                   "timelvl string, timelvlnm string, timeid string, timeidnm string")]
    res = load_files(spark, tmpdir_path, *dims, "Month", "now")
    assert len(listed) == 1
    assert sorted((r.report_id.rsplit("/", 1)[1], r.reason) for r in res.report_rejects.collect()) == [
        ("empty.txt", "empty_report"), ("r.txt", "no_year")]


def test_only_lines_of_sections_are_parsed(spark):
    lines = spark.createDataFrame([("r", 0, "|a,1"), ("r", 1, "|b,2"), ("r", 2, "|c,3")], "report_id string, pos long, line string")
    bounds = spark.createDataFrame([("r", "summary", 1, 2)], "report_id string, kind string, start long, end long")
    body = sections.carve(parse_lines(lines), bounds)
    assert [(r.kind, r.pos, r.col1, r.col2, r.col3) for r in body.collect()] == [("summary", 1, "|b", "2", None)]
    plan = body._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("split(line") < plan.index("Join")


def test_markers_read_a_cell_once_and_heads_do_not_sort_them(spark):
    lines = spark.createDataFrame([("r", 2, '"# Report suite: A, B"'), ("r", 5, "# Site Metrics"), ("r", 6, "####"), ("r", 7, "x,#")],
                                  "report_id string, pos long, line string")
    marks = sections.markers(parse_lines(lines), "Month")
    assert sorted(r.pos for r in marks.collect()) == [2, 5, 6]
    # twice for each use of the cell: one in the projection, two in the filter
    assert marks._jdf.queryExecution().optimizedPlan().toString().count("substring_index(") <= 6
    heads = sections.report_heads(marks, "Month")
    assert [(r.suite_line, r.date_line, r.any_quote_bad, r.h_summary) for r in heads.collect()] == [("# Report suite: A, B", None, False, 5)]
    plan = heads._jdf.queryExecution().executedPlan().toString()
    assert "max(quote_bad" in plan and not any("quote_bad" in part for part in plan.split("\n") if "SortAggregate" in part)
