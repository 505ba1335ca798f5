"""Column functions against their Python definitions."""

from __future__ import annotations

import random
import re

from pyspark.sql import functions as F

from tallyspark.functions.labels import split_label, split_label_pipe
from tallyspark.functions.text import pystrip
from tallyspark.functions.values import format_value, parse_int, parse_value, value_ok

NA = {"", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>",
      "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"}


def py_value(t):
    if t is None or t in NA:
        return "nan"
    try:
        return repr(float(t))
    except ValueError:
        return None


def test_format_matches_python_repr(spark):
    random.seed(7)
    vals = [12345678.0, 123456789.25, 1e16, 1.5e-5, 0.001, 1e-4, 100.0, 0.1 + 0.2, -3.5e-7, 0.0, -0.0]
    vals += [random.uniform(-1, 1) * 10 ** random.randint(-8, 15) for _ in range(2000)]
    vals += [round(random.uniform(0, 1e6), 2) for _ in range(2000)]
    got = spark.createDataFrame([(v,) for v in vals], "v double").select("v", format_value(F.col("v")).alias("s"))
    bad = [(r.v, r.s) for r in got.collect() if r.s != repr(r.v)]
    assert bad == []


def test_parse_matches_python_float(spark):
    toks = ["1", "  2.5 ", "1_000", "1__0", "1.0d", "0x1p3", "12%", "1,234", "", "NA", "N/A", "null", "nan",
            "-inf", "Infinity", "+1e5", ".5", "5.", "_1", None, "abc", " ", "\t7 ", "1e", "1.2.3", "-0", "1E-7"]
    df = spark.createDataFrame([(t,) for t in toks], "t string")
    df = df.withColumn("v", parse_value(F.col("t"))).select("t", format_value(F.col("v")).alias("s"),
                                                            value_ok(F.col("t")).alias("ok"))
    for r in df.collect():
        assert r.s == py_value(r.t), r.t
        assert r.ok == (py_value(r.t) is not None), r.t


def test_parse_int(spark):
    toks = [" 2022", "2_022", "+12", "x022", "20.2", None]
    got = [r.i for r in spark.createDataFrame([(t,) for t in toks], "t string")
           .select(parse_int(F.col("t")).alias("i")).collect()]

    def py(t):
        try:
            return int(t)
        except (TypeError, ValueError):
            return None
    assert got == [py(t) for t in toks]


def test_strip_is_python_strip(spark):
    toks = [" a ", "\ta\t", " a　", "\x1ca\x1f", "a b", ""]
    got = [r.s for r in spark.createDataFrame([(t,) for t in toks], "t string")
           .select(pystrip(F.col("t")).alias("s")).collect()]
    assert got == [t.strip() for t in toks]


def py_split(label, lob_filter):
    parts = re.split(r"[\[\|\]]", label)
    if len(parts) < 6:
        return None
    cat = "Stand Alone" if len(parts) < 7 or parts[6] == "" else parts[6].strip()
    lob = "ALL LoB" if lob_filter.lower() == "no filter" else parts[2].strip().upper()
    return (parts[3].strip(), lob, parts[4].strip(), "Site Activity", cat, parts[5].strip())


def test_bracket_split_matches_python(spark):
    labels = ["[T|retail|web|shop|Visits|Traffic]", "[T|l|c|p|m", "[T|l|c|p|m| ]", "[a|b|c]",
              "[T| Lob\t| ch |pr|me|ca|extra]", "x|y|z|w|v|u", "[T|l|c|p|m|]"]
    for lf in ("no filter", "Filtered"):
        df = spark.createDataFrame([(l,) for l in labels], "l string").select("l", split_label(F.col("l"), lf).alias("s"))
        for r in df.collect():
            want = py_split(r.l, lf)
            if want is None:
                assert r.s.n_parts < 6
            else:
                assert (r.s.channel, r.s.lob, r.s.product, r.s.category_type, r.s.category, r.s.metric_name) == want


def test_pipe_split(spark):
    rows = spark.createDataFrame([("T|lob|ch|pr|me|",), ("T| |ch|pr|me|ca",), ("T|lob|ch|pr|me",)], "l string")
    got = rows.select(split_label_pipe(F.col("l"), "Filtered").alias("s")).collect()
    assert (got[0].s.lob, got[0].s.category) == ("LOB", "Stand Alone")
    assert (got[1].s.lob, got[1].s.category) == ("ALL LoB", "ca")
    assert got[2].s.n_parts == 5
    over = rows.select(split_label_pipe(F.col("l"), "Filtered", lob_override="seg x").alias("s")).collect()
    assert {r.s.lob for r in over} == {"SEG X"}


def test_random_labels_match_python(spark):
    random.seed(21)
    alphabet = ["[", "]", "|", "|", "a", "B", " ", "\t", " ", "x"]
    labels = ["".join(random.choice(alphabet) for _ in range(random.randint(0, 24))) for _ in range(600)]
    for lf in ("no filter", "Seg"):
        df = spark.createDataFrame([(l,) for l in labels], "l string").select(
            "l", split_label(F.col("l"), lf).alias("s"))
        for r in df.collect():
            assert r.s.n_parts == len(re.split(r"[\[\|\]]", r.l)), r.l
            want = py_split(r.l, lf)
            if want is not None:
                got = (r.s.channel, r.s.lob, r.s.product, r.s.category_type, r.s.category, r.s.metric_name)
                assert got == want, r.l


def test_run_ts_and_preview(spark):
    from datetime import datetime, timezone

    from tallyspark.functions.periods import run_ts
    from tallyspark.operators.layout import preview
    # 2024-07-01 17:30 UTC is 12:30 in Chicago (daylight time)
    assert run_ts(datetime(2024, 7, 1, 17, 30, 5, tzinfo=timezone.utc)) == "2024-07-01 12:30:05"
    assert re.fullmatch(r"\d{4}-\d\d-\d\d \d\d:\d\d:\d\d", run_ts())
    assert preview(spark.range(100), 10).count() == 10
