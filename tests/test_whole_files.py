"""Report files that are read whole: the same records as by the line, without a
shuffle, and no listing of them all on the driver."""

from __future__ import annotations

import datetime
import glob
import os
import random

import pytest
from pyspark.sql import functions as F

from reports import dims, month_report, write_reports
from tallyspark.functions import quotes
from tallyspark.plans import queries
from tallyspark.plans.load import load_files
from tallyspark.sources import reports


def _texts():
    rnd = random.Random(3)
    pieces = ["a", '"x"', '"li\nne"', '"two\r\n\r\nlines"', 'st"ray', '"do""ub"', '"tail"end', "", '"""', '"\n#,"', "﻿b", "é,ü", "|", "1" + "," * 12, "\u0085"]
    texts = ["", "\n", "\r\n \r\n", "﻿# a\r\nb\rc", "﻿﻿a\n﻿b", 'a,"open\nb\n', "no end", "x\n" * 5]
    for _ in range(60):
        lines = [",".join(rnd.choice(pieces) for _ in range(rnd.choice([1, 2, 3]))) for _ in range(rnd.randrange(1, 9))]
        texts.append(rnd.choice(["\n", "\r\n", "\r"]).join(lines) + rnd.choice(["", "\n"]))
    return texts


def _read(spark, folder):
    lines, marks, files = reports.scan_report_files(spark, folder)
    name = F.regexp_extract("report_id", r"r(\d+)\.csv", 1)
    key = lambda df: sorted(map(tuple, df.withColumn("report_id", name).collect()))
    return key(lines), key(marks), key(files)


def test_whole_files_as_by_the_line(spark, tmpdir_path, monkeypatch):
    texts = _texts()
    for i, text in enumerate(texts):
        with open(f"{tmpdir_path}/r{i:03}.csv", "w", newline="") as f:
            f.write(text)
    whole = _read(spark, tmpdir_path)
    monkeypatch.setattr(reports, "WHOLE_BYTES", 0)
    by_line = _read(spark, tmpdir_path)
    assert whole[0] == by_line[0] and whole[1] == by_line[1]
    assert whole[2] == by_line[2] == [(f"{i:03}",) for i in range(len(texts))]


def test_lines_of_whole_files_are_not_shuffled(spark, tmpdir_path):
    write_reports(tmpdir_path, {"a.csv": month_report(), "b.csv": 'a,"two\nlines"\n'})
    plan = reports.read_report_lines(spark, tmpdir_path)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan and "Join" not in plan


def test_bytes_that_are_no_utf8_stay(spark, tmpdir_path):
    for name, text in {"a.csv": b"caf\xe9,1\n\n# x\n", "b.csv": b"# y\n"}.items():
        with open(f"{tmpdir_path}/{name}", "wb") as f:
            f.write(text)
    lines, marks, files = reports.scan_report_files(spark, tmpdir_path)
    assert sorted((r.pos, r.h) for r in lines.select("pos", F.hex(F.col("line").cast("binary")).alias("h")).collect()) == [
        (0, "232079"), (0, "636166E92C31"), (1, "232078")]
    assert marks.count() == 2 and files.count() == 2


def test_settings_for_many_files_end_with_the_scan(spark, tmpdir_path):
    names = ["spark.sql.sources.parallelPartitionDiscovery.parallelism", "spark.sql.files.openCostInBytes"]
    before = [spark.conf.get(n) for n in names]
    with pytest.raises(Exception):
        reports.scan_report_files(spark, f"{tmpdir_path}/nowhere")
    assert [spark.conf.get(n) for n in names] == before


def test_files_in_several_lists(spark, tmpdir_path):
    texts = {"a.csv": month_report(), "b.csv": "", "c.csv": "other\n", "d.csv": month_report(suite="Nowhere")}
    for name, text in texts.items():
        os.mkdir(f"{tmpdir_path}/in-{name[0]}")
        write_reports(f"{tmpdir_path}/in-{name[0]}", {name: text})
    load = lambda paths: load_files(spark, paths, *dims(spark), "Month", "R")
    one, parts = load([f"{tmpdir_path}/in-{n[0]}" for n in texts]), load([[f"{tmpdir_path}/in-{n[0]}"] for n in texts])
    for frame in (lambda r: r.rows, lambda r: r.report_rejects):
        assert sorted(map(tuple, frame(one).collect())) == sorted(map(tuple, frame(parts).collect()))
    assert parts.report_rejects.count() == 3


def test_other_cells_than_the_first_are_split_as_all_cells(spark):
    lines = ['"a,""b",1,,2', '"a"t,x', 'a,"b"', 'st"ray,1,2', '"open,1', '""', '"a\nb",1', ',"x"']
    df = spark.createDataFrame([("r", i, t) for i, t in enumerate(lines)], "report_id string, pos long, line string")
    rows = reports.parse_lines(df).join(df.select("pos", quotes.cells(F.col("line")).alias("all")), "pos").collect()
    for r in rows:
        assert [r[c] for c in reports.REPORT_COLS] == [x or None for x in r["all"]] + [None] * (13 - len(r["all"])), r.line


def _tables(spark, folder):
    """A few customers of the nations that the queries spoil, with orders of three years."""
    people = [(k * 7_000, f"c{k}", k % 7, -1.0 if k % 3 == 0 else 1.0, ["BUILDING", "MACHINERY"][k % 2]) for k in range(14)]
    orders = [(k * 14 + i, k * 7_000, "FOP"[(k + i) % 3], 10.0, datetime.date(1995 + i % 3, 1 + (k * i) % 12, 3),
               ["1-URGENT", "5-LOW"][(k + i) % 2]) for k in range(14) for i in range(9)]
    for name, rows, schema in [
            ("customer", people, "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"),
            ("orders", orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate date, o_orderpriority string"),
            ("nation", [(n, f"N{n}", n % 2) for n in range(7)], "n_nationkey int, n_name string, n_regionkey int"),
            ("region", [(0, "ASIA"), (1, "MIDDLE EAST")], "r_regionkey int, r_name string")]:
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")


def test_files_are_written_and_read_some_at_a_time(spark, tmpdir_path, monkeypatch):
    _tables(spark, tmpdir_path)
    once = [sorted(map(tuple, q(spark, tmpdir_path).collect())) for q in (queries.load_reject_reasons, queries.load_quotes)]
    assert {r[2] for r in once[0]} >= {"no_year", "empty_report", "unbalanced_quote", "label_parts"} and len(once[1]) > 1000
    read, text = [], type(spark.read).text
    monkeypatch.setattr(type(spark.read), "text", lambda self, paths, **k: read.append(paths) or text(self, paths, **k))
    monkeypatch.setattr(queries, "FILES_AT_ONCE", 12)
    parts = [sorted(map(tuple, q(spark, tmpdir_path).collect())) for q in (queries.load_reject_reasons, queries.load_quotes)]
    assert parts == once
    files = [len(glob.glob(f"{p[0].removeprefix('file:')}/rid=*")) for p in read]
    assert len(files) == 10 and sum(files) > 40 and max(files) < sum(files) / 4


def test_no_order_no_report(spark, tmpdir_path):
    _tables(spark, tmpdir_path)
    spark.read.parquet(f"{tmpdir_path}/orders.parquet").limit(0).write.parquet(f"{tmpdir_path}/none")
    os.rename(f"{tmpdir_path}/orders.parquet", f"{tmpdir_path}/some")
    os.rename(f"{tmpdir_path}/none", f"{tmpdir_path}/orders.parquet")
    assert queries.load_reject_reasons(spark, tmpdir_path).collect() == []
