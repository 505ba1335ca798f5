"""Queries over the driver's tables, one per operator of the report load.

Each function takes ``(spark, data_dir)`` and returns a DataFrame built from
the whole tables (or from data Spark derives from them). The wide tables the
report load works on are derived from ``orders`` the way a metric report is
shaped: one row per metric label with month / quarter / year columns.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyspark.constants import FINAL_COLS, LEVEL_MONTH, LEVEL_QUARTER, REPORT_COLS
from tallyspark.functions.labels import label_ok, split_label, split_label_pipe
from tallyspark.functions.periods import month_key, quarter_key
from tallyspark.functions.values import format_value, parse_value, value_ok
from tallyspark.operators import layout, lookups, sections
from tallyspark.operators.joins import sized_broadcast
from tallyspark.operators.reshape import unpivot_periods
from tallyspark.plans.load import load_files, load_reports
from tallyspark.session import shared_dir, stage
from tallyspark.sinks import tables as sink
from tallyspark.sources.reports import number_lines, parse_lines
from tallyspark.sources.tables import read_table

RUN_TS = "2024-01-01 00:00:00"
OLD_TS = "2023-12-31 00:00:00"


# ---------------------------------------------------------------- helpers
def _orders(spark: SparkSession, d: str) -> DataFrame:
    o = read_table(spark, d, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    return o.withColumns({"y": F.year("o_orderdate"), "mo": F.month("o_orderdate"),
                          "q": F.quarter("o_orderdate")})


def _orders_customers(spark: SparkSession, d: str) -> DataFrame:
    c = read_table(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal",
                                                "c_mktsegment")
    return _orders(spark, d).join(c, F.col("o_custkey") == F.col("c_custkey"))


def _value_cols(cells: list[Column]) -> list[Column]:
    """Cells as ``col2..col13`` (missing ones NULL)."""
    cells = cells + [F.lit(None).cast("string")] * (12 - len(cells))
    return [c.cast("string").alias(REPORT_COLS[i + 1]) for i, c in enumerate(cells)]


def _text_value(df: DataFrame, raw: str = "raw") -> DataFrame:
    """raw text -> parsed double -> Python-style text, in two projections."""
    return (df.withColumn("__v", parse_value(F.col(raw)))
            .withColumn("metric_value", format_value(F.col("__v"))).drop("__v"))


def _period_wide(df: DataFrame, keys: list[str], period: str, n: int, value: Column) -> DataFrame:
    """``keys + y`` with one text column per period ``1..n`` (NULL when empty)."""
    return df.groupBy(*keys, "y").pivot(period, list(range(1, n + 1))).agg(value.cast("string"))


def _this_last(wide: DataFrame, keys: list[str]) -> DataFrame:
    """Pairs each ``(keys, y)`` row with the row of the year before (``p_*``)."""
    periods = [c for c in wide.columns if c not in keys + ["y"]]
    prev = wide.select(*keys, (F.col("y") + 1).alias("y"), *[F.col(c).alias(f"p_{c}") for c in periods])
    return wide.join(prev, keys + ["y"], "left")


def _month_sections(df: DataFrame, keys: list[str], value: Column) -> DataFrame:
    """Month sections (this year and last year) per ``keys`` and report year."""
    wide = _this_last(_period_wide(df, keys, "mo", 12, value), keys)
    this = wide.select(*keys, "y", F.lit("month_this").alias("kind"),
                       *_value_cols([F.col(str(m)) for m in range(1, 13)]))
    last = wide.select(*keys, "y", F.lit("month_last").alias("kind"),
                       *_value_cols([F.col(f"p_{m}") for m in range(1, 13)]))
    return last.unionByName(this)


def _quarter_section(df: DataFrame, keys: list[str], value: Column) -> DataFrame:
    wide = _this_last(_period_wide(df, keys, "q", 4, value), keys)
    return wide.select(*keys, "y", F.lit("quarter").alias("kind"),
                       *_value_cols([F.col(f"p_{q}") for q in range(1, 5)] + [F.col(str(q)) for q in range(1, 5)]))


def _summary_section(df: DataFrame, keys: list[str], value: Column) -> DataFrame:
    per_year = df.groupBy(*keys, "y").agg(value.cast("string").alias("v"))
    prev = per_year.select(*keys, (F.col("y") + 1).alias("y"), F.col("v").alias("p_v"))
    wide = per_year.join(prev, keys + ["y"], "left")
    return wide.select(*keys, "y", F.lit("summary").alias("kind"), *_value_cols([F.col("v"), F.col("p_v")]))


def _count() -> Column:
    """Rows per cell; NULL (an empty cell) when there are none."""
    return F.sum(F.lit(1))


def _total() -> Column:
    """Order value per cell: cents summed exactly, shown as a double."""
    return F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")) / F.lit(100.0)


def _unpivoted(body: DataFrame, keys: list[str]) -> DataFrame:
    long = unpivot_periods(body, keys, year_col="y")
    return _text_value(long).select(*keys, F.col("y").alias("report_year"), "kind", "timeid", "metric_value")


def _calendar(spark: SparkSession, d: str, gap: bool = False) -> DataFrame:
    """Months and quarters seen in ``orders``. ``gap`` leaves December out of
    the month level, where a calendar gap is what the query is about."""
    o = _orders(spark, d)
    seen = o.where(F.col("mo") != 12) if gap else o
    months = (seen.select("y", "mo").distinct()
              .select(F.lit("M").alias("timelvl"), F.lit(LEVEL_MONTH).alias("timelvlnm"),
                      month_key(F.col("y"), F.col("mo")).alias("timeid"),
                      F.date_format(F.make_date(F.col("y"), F.col("mo"), F.lit(1)), "MMM yyyy").alias("timeidnm")))
    quarters = (o.select("y", "q").distinct()
                .select(F.lit("Q").alias("timelvl"), F.lit(LEVEL_QUARTER).alias("timelvlnm"),
                        quarter_key(F.col("y"), F.col("q")).alias("timeid"),
                        F.format_string("Q%d %d", F.col("q"), F.col("y")).alias("timeidnm")))
    return months.unionByName(quarters)


# ---------------------------------------------------------------- unpivot
def unpivot_month(spark, d):
    body = _month_sections(_orders(spark, d), ["o_orderpriority"], _count())
    return _unpivoted(body, ["o_orderpriority"])


def unpivot_quarter(spark, d):
    body = _quarter_section(_orders(spark, d), ["o_orderpriority"], _count())
    return _unpivoted(body, ["o_orderpriority"])


def unpivot_summary(spark, d):
    body = _summary_section(_orders(spark, d), ["o_orderpriority"], _total())
    return _unpivoted(body, ["o_orderpriority"])


# ---------------------------------------------------------------- labels
def _label_input(spark, d):
    oc = _orders_customers(spark, d)
    return oc.withColumn("lob_filter", F.when(F.col("c_acctbal") < 0, F.lit("Filtered"))
                         .otherwise(F.lit("no filter")))


def label_split(spark, d):
    seg, prio, st = F.lower(F.col("c_mktsegment")), F.col("o_orderpriority"), F.col("o_orderstatus")
    label = (F.when(prio == "5-LOW", F.concat(F.lit("[T|"), seg, F.lit("|web]")))
             .when(st == "O", F.concat(F.lit("[T|"), seg, F.lit("| web\t|"), prio, F.lit("|Orders")))
             .when(st == "F", F.concat(F.lit("[T|"), seg, F.lit("| web\t|"), prio, F.lit("|Orders| Done ]")))
             .otherwise(F.concat(F.lit("[T|"), seg, F.lit("| web\t|"), prio, F.lit("|Orders| ]"))))
    df = _label_input(spark, d).select("o_orderkey", label.alias("label"), "lob_filter")
    s = split_label(F.col("label"), F.col("lob_filter"))
    return df.select("o_orderkey", "label", s["channel"].alias("channel"), s["lob"].alias("lob"),
                     s["product"].alias("product"), s["category_type"].alias("category_type"),
                     s["category"].alias("category"), s["metric_name"].alias("metric_name"),
                     s["n_parts"].alias("n_parts"), label_ok(s).alias("label_ok"))


def label_split_pipe(spark, d):
    seg, prio, st = F.lower(F.col("c_mktsegment")), F.col("o_orderpriority"), F.col("o_orderstatus")
    label = (F.when(prio == "5-LOW", F.concat(F.lit("T|"), seg, F.lit("|web|"), prio, F.lit("|Orders")))
             .when(st == "P", F.concat(F.lit("T| |web|"), prio, F.lit("|Orders|Pending")))
             .when(st == "O", F.concat(F.lit("T|"), seg, F.lit("|web|"), prio, F.lit("|Orders|")))
             .otherwise(F.concat(F.lit("T|"), seg, F.lit("| web |"), prio, F.lit("|Orders| Filled "))))
    df = _label_input(spark, d).select("o_orderkey", label.alias("label"), "lob_filter")
    s = split_label_pipe(F.col("label"), F.col("lob_filter"))
    return df.select("o_orderkey", "label", s["channel"].alias("channel"), s["lob"].alias("lob"),
                     s["product"].alias("product"), s["category"].alias("category"),
                     s["metric_name"].alias("metric_name"), label_ok(s).alias("label_ok"))


# ---------------------------------------------------------------- lookups
def metric_lookup(spark, d):
    part = read_table(spark, d, "part")
    mapping = part.select(F.col("p_partkey").cast("string").alias("id"), F.col("p_name").alias("name"),
                          F.col("p_partkey").alias("ord"))
    labels = part.select("p_partkey", F.when(F.col("p_size") > 25, F.upper(F.col("p_name")))
                         .otherwise(F.col("p_type")).alias("label"))
    out = lookups.with_metric_id(labels, F.col("label"), lookups.metric_ids(mapping))
    return out.select("p_partkey", "label", "metric_id")


def suite_lookup(spark, d):
    region = read_table(spark, d, "region")
    suites = (region.select(F.col("r_name").alias("name"), F.concat(F.lit("rs"), F.col("r_regionkey")).alias("rsid"),
                            F.col("r_regionkey").cast("long").alias("ord"))
              .unionByName(region.select(F.col("r_name").alias("name"),
                                         F.concat(F.lit("dup"), F.col("r_regionkey")).alias("rsid"),
                                         (F.col("r_regionkey") + 1000).cast("long").alias("ord"))))
    c = read_table(spark, d, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    n = read_table(spark, d, "nation").select("n_nationkey", "n_regionkey")
    names = (c.join(n, F.col("c_nationkey") == F.col("n_nationkey"))
             .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
             .select("c_custkey", F.when(F.col("c_acctbal") < 0, F.lower(F.col("r_name")))
                     .otherwise(F.col("r_name")).alias("rs_name")))
    out = lookups.with_suite(names, lookups.suite_ids(suites))
    return out.select("c_custkey", "rs_name", "rsid", F.col("rsid").isNotNull().alias("suite_ok"))


def description_lookup(spark, d):
    part = read_table(spark, d, "part")
    mapping = part.select(F.col("p_name").alias("name"), F.col("p_partkey").alias("ord"),
                          F.concat(F.lit("[T|"), F.col("p_brand"), F.lit("|web|"), F.col("p_type"), F.lit("|"),
                                   F.col("p_name"), F.lit("|"), F.col("p_size").cast("string"),
                                   F.lit("]")).alias("description"))
    rows = part.select("p_partkey", "p_name", "p_brand")
    out = lookups.with_description(rows, F.col("p_name"), lookups.descriptions(mapping))
    s = split_label(F.col("description"), F.col("p_brand"))
    return out.select("p_partkey", "description", s["channel"].alias("channel"), s["lob"].alias("lob"),
                      s["product"].alias("product"), s["category"].alias("category"),
                      s["metric_name"].alias("metric_name"))


def time_join(spark, d):
    cal = lookups.time_level(_calendar(spark, d, gap=True), LEVEL_MONTH)
    return lookups.with_time(unpivot_month(spark, d), cal).select(
        "o_orderpriority", "report_year", "kind", "timeid", "metric_value", "timelvl", "timeidnm", "timelvlnm")


# ---------------------------------------------------------------- layout
def _segment_long(spark, d) -> DataFrame:
    """Long rows per segment and priority label, all 11 long columns."""
    keys = ["c_mktsegment", "o_orderpriority"]
    body = _month_sections(_orders_customers(spark, d), keys, _count())
    long = _text_value(unpivot_periods(body, keys, year_col="y"))
    label = F.concat(F.lit("[T|"), F.lower(F.col("c_mktsegment")), F.lit("|web|"),
                     F.col("o_orderpriority"), F.lit("|Orders|]"))
    s = split_label(label, F.lit("Filtered"))
    return long.select("timeid", F.lit("rs-all").alias("rpt_suite_id"), F.lit("All Suites").alias("rpt_suite_nm"),
                       s["channel"].alias("channel"), s["lob"].alias("lob"), s["product"].alias("product"),
                       s["category_type"].alias("category_type"), s["category"].alias("category"),
                       s["metric_name"].alias("metric_name"), "metric_value",
                       F.lit("0").alias("metric_id"))


def final_layout(spark, d):
    long = layout.stamp(layout.to_long_layout(_segment_long(spark, d)), RUN_TS)
    cal = lookups.time_level(_calendar(spark, d), LEVEL_MONTH)
    return layout.final_extract(lookups.with_time(long, cal))


# ---------------------------------------------------------------- sections
def _event_lines(spark, d) -> DataFrame:
    """Events as report lines: per user, in (ts, event_id) order; purchase is a
    summary header, signup a separator, view / click metric rows."""
    e = read_table(spark, d, "events").select("event_id", "ts", "user_id", "event_type", "value")
    line = (F.when(F.col("event_type") == "purchase", F.lit("# Site Metrics"))
            .when(F.col("event_type") == "signup", F.lit("####################"))
            .when(F.col("event_type").isin("view", "click"),
                  F.concat(F.lit("[T|x|web|p|"), F.col("event_type"), F.lit("|c],"), F.col("event_id").cast("string")))
            .otherwise(F.col("event_type")))
    return e.select(F.col("user_id").cast("string").alias("report_id"), "ts", "event_id", line.alias("line"))


def section_carve(spark, d):
    ev = _event_lines(spark, d)
    lines = number_lines(ev, order_cols=["ts", "event_id"],
                         chunk_col=F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / F.lit(3_600_000_000)))
    # read three times below (headers, separators, metric rows): store once
    parsed = stage(parse_lines(lines), "event-lines")
    heads = sections.report_heads(parsed, LEVEL_MONTH)
    starts = sections.section_starts(heads).where(F.col("kind") == "summary")
    body = sections.carve(parsed, sections.section_bounds(parsed, starts))
    return body.select(F.col("report_id").cast("bigint").alias("user_id"), "pos",
                       F.col("col2").cast("bigint").alias("event_id"))


def header_classify(spark, d):
    e = read_table(spark, d, "events").select("event_id", "event_type", "value")
    tail = (F.when(F.col("value") < 10, F.lit(" by month - this year"))
            .when(F.col("value") < 20, F.lit(" by month - last year"))
            .when(F.col("value") < 30, F.lit(" by quarter"))
            .when(F.col("value") < 40, F.lit(" by week"))
            .otherwise(F.lit("")))
    word = F.when(F.col("event_type") == "error", F.lit("metrics")).otherwise(F.lit("Metrics"))
    header = F.concat(F.lit("# "), F.upper(F.col("event_type")), F.lit(" "), word, tail)
    df = e.select("event_id", header.alias("header"))
    return df.select("event_id", "header", sections.classify(F.col("header"), LEVEL_MONTH).alias("kind_month"),
                     sections.classify(F.col("header"), LEVEL_QUARTER).alias("kind_quarter"))


def preamble(spark, d):
    c = read_table(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    years = _orders(spark, d).groupBy("o_custkey").agg(F.min("y").alias("y0"), F.max("y").alias("y1"))
    cy = c.join(years, F.col("c_custkey") == F.col("o_custkey"), "left")
    # a cell holding a comma is quoted, as a CSV export writes it
    suite = F.when(F.col("c_acctbal") < 0,
                   F.concat(F.lit('"# Report suite: '), F.col("c_name"), F.lit(", "), F.col("c_mktsegment"), F.lit('"'))
                   ).otherwise(F.concat(F.lit("# Report suite: "), F.col("c_name")))
    date = (F.when((F.col("c_mktsegment") == "HOUSEHOLD") | F.col("y1").isNull(), F.lit("# no date"))
            .otherwise(F.concat(F.lit('"# Date: Jan 1, '), F.col("y0").cast("string"), F.lit(" - Dec 31, "),
                                F.col("y1").cast("string"), F.lit('"'))))
    lines = cy.select(F.col("c_custkey").cast("string").alias("report_id"), F.inline(F.array(
        F.struct(F.lit(0).alias("raw_pos"), F.lit("####################").alias("line")),
        F.struct(F.lit(1).alias("raw_pos"), F.lit("# Company").alias("line")),
        F.struct(F.lit(2).alias("raw_pos"), suite.alias("line")),
        F.struct(F.lit(3).alias("raw_pos"), date.alias("line")))))
    parsed = parse_lines(number_lines(lines))
    meta = sections.with_preamble(sections.report_heads(parsed, LEVEL_MONTH))
    return meta.select(F.col("report_id").cast("bigint").alias("c_custkey"), "rs_name", "lob_filter", "year")


def value_parse(spark, d):
    e = read_table(spark, d, "events").select("event_id", "event_type", "value")
    raw = (F.when(F.col("event_type") == "error", F.lit("N/A"))
           .when(F.col("event_type") == "signup", F.lit(""))
           .when(F.col("event_type") == "click", F.concat(F.col("value").cast("string"), F.lit("%")))
           .when(F.col("event_type") == "purchase", F.concat(F.lit(" "), F.col("value").cast("string"), F.lit(" ")))
           .otherwise(F.col("value").cast("string")))
    df = e.select("event_id", raw.alias("raw"))
    df = df.withColumn("value_ok", value_ok(F.col("raw")))
    return _text_value(df).select("event_id", "raw", "value_ok", "metric_value")


# ---------------------------------------------------------------- upsert
def _merge_side(spark, d, drop_status: str, name: str, ts: str, null_low: bool = False) -> DataFrame:
    oc = _orders_customers(spark, d).where(F.col("o_orderstatus") != drop_status)
    metric_id = F.col("o_orderpriority")
    if null_low:
        metric_id = F.when(metric_id != "5-LOW", metric_id)
    g = oc.groupBy(month_key(F.col("y"), F.col("mo")).alias("timeid"), metric_id.alias("metric_id"),
                   F.upper(F.col("c_mktsegment")).alias("lob")).agg(F.count(F.lit(1)).cast("double").alias("v"))
    return g.select("timeid", "metric_id", "lob", F.lit(name).alias("metric_name"),
                    format_value(F.col("v")).alias("metric_value"), F.lit(ts).alias("create_ts"),
                    F.lit(ts).alias("update_ts"))


def upsert(spark, d):
    target = _merge_side(spark, d, "P", "orders", OLD_TS)
    source = _merge_side(spark, d, "F", "orders_v2", RUN_TS)
    return sink.merge_rows(target, source, RUN_TS)


def upsert_null_key(spark, d):
    target = _merge_side(spark, d, "P", "orders", OLD_TS, null_low=True)
    source = _merge_side(spark, d, "F", "orders_v2", RUN_TS, null_low=True)
    return sink.merge_rows(target, source, RUN_TS)


def merge_key_dups(spark, d):
    oc = _orders_customers(spark, d)
    src = oc.groupBy(month_key(F.col("y"), F.col("mo")).alias("timeid"), "o_orderpriority",
                     F.upper(F.col("c_mktsegment")).alias("lob")).agg(F.count(F.lit(1)).alias("n"))
    src = src.withColumn("metric_id", F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"),
                                             F.col("o_orderpriority")).otherwise(F.lit("0")))
    return sink.merge_key_dups(src)


# ---------------------------------------------------------------- comments
def _part_comments(spark, d) -> DataFrame:
    part = read_table(spark, d, "part")
    return part.select(F.col("p_type").alias("column"), F.col("p_name").alias("metadata"),
                       F.col("p_partkey").alias("ord"))


def column_comments(spark, d):
    return sink.first_comments(_part_comments(spark, d))


# ---------------------------------------------------------------- report load
SEP = "####################"


# Customers of one report file: its text is bounded, the number of files grows
# with the customers.
FILE_CUSTOMERS = 10_000
# Report files written and listed at once, about: the driver keeps some KB for each.
FILES_AT_ONCE = 16_000
# Reports by nation that the "defects" variant spoils.
NO_DATE, NO_HEADER, OPEN_QUOTE, BLANK = 1, 2, 3, 5


def _category() -> Column:
    return (F.when(F.col("o_orderstatus") == "F", F.lit("Filled"))
            .when(F.col("o_orderstatus") == "O", F.lit("Open")).otherwise(F.lit("")))


def _label(seg: Column, metric: str = "Orders", mark: str = "") -> Column:
    return F.concat(F.lit(f"{mark}[T|"), seg, F.lit("|web|"), F.col("o_orderpriority"), F.lit(f"|{metric}|"), _category(),
                    F.lit(f"]{mark}"))


def _open_name(seg: Column) -> Column:
    return F.concat(F.lit("Open orders "), F.col("o_orderpriority"), F.lit(" "), seg)


def _metric_cell(variant: str) -> Column:
    """The first cell of a metric row as it stands in the file."""
    seg = F.lower(F.col("c_mktsegment"))
    filled, opened = F.col("o_orderstatus") == "F", F.col("o_orderstatus") == "O"
    if variant == "quotes":  # over two lines with doubled quotes; a stray quote; a quoted comma
        return (F.when(filled, _label(seg, 'Or\nders ""all""', '"')).when(opened, _label(seg, 'Ord"ers'))
                .otherwise(_label(seg, "Orders, net", '"')))
    if variant == "names":  # known by a name of the mapping; no such name
        return (F.when(filled, _label(seg)).when(opened, _open_name(seg))
                .otherwise(F.concat(F.lit("Pending "), F.col("o_orderpriority"))))
    if variant == "defects":  # too few parts
        return F.when(filled | opened, _label(seg)).otherwise(F.concat(F.lit("[T|"), seg, F.lit("|web]")))
    return _label(seg)


def report_lines(spark, d, per_suite: bool = False, variant: str = "") -> DataFrame:
    """Renders monthly/quarterly reports per report year from the orders: preamble,
    a summary section, both month sections and a quarter section. A report is one
    customer's, or with ``per_suite`` that of up to ``FILE_CUSTOMERS`` customers of
    one suite; it has one metric row per customer, priority and status seen in the
    report year or the year before. Every order is in two reports: its own year's
    and, as last year, the next one's. A blank line and, for some customers, an
    over-wide line are mixed in. ``variant`` changes how the cells are written
    (``_metric_cell``). ``(report_id, raw_pos, line)``.

    One aggregate gives the metric rows; one window over each report's (bounded)
    metric rows numbers them; every metric row emits its four section lines and
    the first one also the report's fixed lines.
    """
    return _report_text(_metric_rows(spark, d, per_suite, variant), variant)


def _report_key() -> list[Column]:
    """What names a report with ``per_suite``, but for its year."""
    return [F.col("c_nationkey"), F.when(_of_segment(), F.lower("c_mktsegment")).otherwise(F.lit("all")),
            F.floor(F.col("c_custkey") / FILE_CUSTOMERS)]


def _of_segment() -> Column:
    return F.col("c_acctbal") < 0


def _metric_rows(spark, d, per_suite: bool, variant: str) -> DataFrame:
    """The metric rows of ``report_lines``: a row with its four section lines."""
    oc = _orders_customers(spark, d).withColumn("ry", F.explode(F.array(F.col("y"), F.col("y") + 1)))
    nation = read_table(spark, d, "nation").select("n_nationkey", "n_name")
    name = [*(_report_key() if per_suite else [F.col("c_custkey")]), F.col("ry")]
    label = _metric_cell(variant)
    is_this = F.col("y") == F.col("ry")
    agg = [F.sum(F.when(is_this, 1)).alias("s_this"), F.sum(F.when(~is_this, 1)).alias("s_last")]
    agg += [F.sum(F.when(is_this & (F.col("mo") == m), 1)).alias(f"t{m}") for m in range(1, 13)]
    agg += [F.sum(F.when(~is_this & (F.col("mo") == m), 1)).alias(f"l{m}") for m in range(1, 13)]
    agg += [F.sum(F.when(~is_this & (F.col("q") == q), 1)).alias(f"lq{q}") for q in range(1, 5)]
    agg += [F.sum(F.when(is_this & (F.col("q") == q), 1)).alias(f"tq{q}") for q in range(1, 5)]
    keys = ["c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment", "ry", "o_orderpriority", "o_orderstatus"]
    rows = oc.groupBy(*keys, label.alias("label")).agg(*agg)
    rows = rows.join(sized_broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey"))

    def csv(*cells):
        return F.concat_ws(",", F.col("label"), *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cells])

    row_text = [csv("s_this", "s_last"), csv(*[f"t{m}" for m in range(1, 13)]),
                csv(*[f"l{m}" for m in range(1, 13)]),
                csv(*[f"lq{q}" for q in range(1, 5)], *[f"tq{q}" for q in range(1, 5)])]
    if variant == "defects":
        low = (F.col("o_orderpriority") == "5-LOW") & F.col("t1").isNotNull()
        row_text[1] = F.when(low, F.regexp_replace(row_text[1], r"\],([0-9]+)", "],$1%")).otherwise(row_text[1])
    # four texts a row instead of its counts go to the report's window
    return rows.select(*keys[:-2], "n_name", "o_orderpriority", "o_orderstatus", F.concat_ws("-", *name).alias("report_id"),
                       *[text.alias(f"text{k}") for k, text in enumerate(row_text)])


def _report_text(rows: DataFrame, variant: str) -> DataFrame:
    """The lines of the reports with these metric rows."""
    per_report = Window.partitionBy("report_id")
    rows = rows.withColumns({
        "i": F.row_number().over(per_report.orderBy("c_custkey", "c_mktsegment", "o_orderpriority", "o_orderstatus")) - 1,
        "n": F.count(F.lit(1)).over(per_report)})
    suite = F.when(_of_segment(),
                   F.concat(F.lit('"# Report suite: '), F.col("n_name"), F.lit(", "), F.col("c_mktsegment"), F.lit('"'))
                   ).otherwise(F.concat(F.lit("# Report suite: "), F.col("n_name")))
    date = F.concat(F.lit('"# Date: Jan 1, '), (F.col("ry") - 1).cast("string"), F.lit(" - Dec 31, "),
                    F.col("ry").cast("string"), F.lit('"'))
    wide_junk = F.when(F.col("c_mktsegment") == "MACHINERY", F.lit("x" + ",1" * 13)).otherwise(F.lit(""))
    spec = [SEP, "# Company", suite, date, SEP, "", "# Site Metrics", SEP, ",This year,Last year", 0, SEP,
            "# Site Metrics by month - this year", SEP, "h1", wide_junk, "h2", "h3", 1, SEP,
            "# Site Metrics by month - last year", SEP, "h1", "h2", "h3", 2, SEP,
            "# Site Metrics by quarter", SEP, "h1", "h2", "h3", 3, SEP]
    if variant == "defects":
        of = F.col("c_nationkey")
        spec[3] = F.when(of == NO_DATE, F.lit("# no date")).otherwise(date)
        at = next(i for i, item in enumerate(spec) if isinstance(item, str) and item.endswith("by month - this year"))
        spec[at] = F.when(of == NO_HEADER, F.lit("# Site metrics by month - this year")).otherwise(F.lit(spec[at]))
        spec[-1] = F.when(of == OPEN_QUOTE, F.lit('"# never closed')).otherwise(F.lit(SEP))
    # raw position of an item: fixed items before it + n per metric block before it
    fixed, row_pos, fixed_before, blocks_before = [], {}, 0, 0
    for item in spec:
        if isinstance(item, int):
            row_pos[item] = (fixed_before, blocks_before)
            blocks_before += 1
            continue
        text = F.lit(item) if isinstance(item, str) else item
        fixed.append(F.struct((F.lit(fixed_before) + F.lit(blocks_before) * F.col("n")).cast("long").alias("p"),
                              text.alias("line")))
        fixed_before += 1
    own = [F.struct((F.lit(row_pos[k][0]) + F.lit(row_pos[k][1]) * F.col("n") + F.col("i")).cast("long").alias("p"),
                    F.col(f"text{k}").alias("line")) for k in range(4)]
    # no lambda here: it would keep the whole array out of the generated code
    lines = F.when(F.col("i") == 0, F.array(*own, *fixed)).otherwise(F.array(*own))
    out = rows.select("report_id", "c_nationkey", F.inline(lines)).withColumnRenamed("p", "raw_pos")
    if variant == "defects":
        out = out.withColumn("line", F.when(F.col("c_nationkey") == BLANK, F.lit("")).otherwise(F.col("line")))
    return out.select("report_id", "raw_pos", "line")


def report_dims(spark, d, gaps: bool = False):
    """Metric map, suite catalogue and calendar derived from the tables.
    ``gaps`` leaves a region's suites and a month out, for rejects."""
    oc = _orders_customers(spark, d)
    combos = oc.select(F.lower(F.col("c_mktsegment")).alias("seg"), "o_orderpriority", "o_orderstatus").distinct()
    label = _label(F.col("seg"))
    mid = F.concat(F.lit("m"), F.substring("o_orderpriority", 1, 1), F.col("o_orderstatus"), F.lit("-"),
                   F.substring("seg", 1, 3))
    mapped = combos.where(F.col("o_orderstatus") != "P")
    metric_map = (mapped.select(mid.alias("id"), label.alias("name"), F.lit(1).cast("long").alias("ord"))
                  .unionByName(mapped.where(F.col("o_orderstatus") == "F")
                               .select(F.concat(F.lit("u"), mid).alias("id"), F.upper(label).alias("name"),
                                       F.lit(0).cast("long").alias("ord")))
                  .withColumn("description", F.col("name"))
                  .unionByName(mapped.where(F.col("o_orderstatus") == "O")
                               .select(F.concat(F.lit("d"), mid).alias("id"), _open_name(F.col("seg")).alias("name"),
                                       F.lit(2).cast("long").alias("ord"), label.alias("description"))))
    n = read_table(spark, d, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = read_table(spark, d, "region").select("r_regionkey", "r_name")
    nr = n.join(r, F.col("n_regionkey") == F.col("r_regionkey"))
    if gaps:
        nr = nr.where(F.col("r_name") != "MIDDLE EAST")
    c = read_table(spark, d, "customer").select("c_nationkey", "c_mktsegment")
    suites = (nr.select(F.col("n_name").alias("name"), F.concat(F.lit("rs"), F.col("n_nationkey")).alias("rsid"),
                        F.col("n_nationkey").cast("long").alias("ord"))
              .unionByName(c.join(nr, F.col("c_nationkey") == F.col("n_nationkey"))
                           .select(F.concat(F.col("n_name"), F.lit(", "), F.col("c_mktsegment")).alias("name"),
                                   F.concat(F.lit("rs"), F.col("n_nationkey"), F.lit("-"),
                                            F.lower(F.substring("c_mktsegment", 1, 3))).alias("rsid"),
                                   (F.col("n_nationkey") + 100).cast("long").alias("ord")).distinct()))
    # derived once and stored: small parquet, so the broadcast size check
    # reads the file size instead of re-running the derivation
    return stage(metric_map, "metric-map"), stage(suites, "suites"), stage(_calendar(spark, d, gaps), "calendar")


def report_parsed(spark, d) -> DataFrame:
    """The rendered reports, numbered and parsed. ``number_lines`` stores them
    in the shared folder (they stand for the report files a load reads); the
    cells are parsed where they are read, after the tests on the line."""
    return parse_lines(number_lines(report_lines(spark, d)))


def section_wide_month(spark, d):
    """The this-year month table of every rendered report, as its wide
    columns (``metrix`` + twelve months), straight from the carve."""
    parsed = report_parsed(spark, d)
    # read for the heads and the bounds: stored, as in the load
    marks = stage(sections.markers(parsed, LEVEL_MONTH), "markers")
    starts = sections.section_starts(sections.report_heads(marks, LEVEL_MONTH))
    body = sections.carve(parsed, sections.section_bounds(marks, starts))
    wide = sections.project_section(body, "month_this")
    return wide.drop("pos")


def _report_load(spark, d, level, gaps=False):
    parsed = report_parsed(spark, d)
    metric_map, suites, cal = report_dims(spark, d, gaps)
    return load_reports(parsed, metric_map, suites, cal, level, RUN_TS)


def _most_files(spark, d) -> int:
    """At least as many as there are reports with ``per_suite``."""
    names = read_table(spark, d, "customer").select(*_report_key()).distinct().count()
    years = _orders(spark, d).select(F.explode(F.array(F.col("y"), F.col("y") + 1))).distinct().count()
    return max(names * years, 1)


def _load_files(spark, d, variant: str = "", gaps: bool = False, **kw):
    """Reports per suite, written as text files (lines in file order, junk lines
    included) to the shared folder, in parts of about ``FILES_AT_ONCE`` files, then
    read back part by part through the file reader and loaded."""
    path = f"{shared_dir(spark)}/reports-{uuid.uuid4().hex}"
    rows, parts = _metric_rows(spark, d, True, variant), -(-_most_files(spark, d) // FILES_AT_ONCE)
    folders = [path]
    if parts > 1:
        # whole reports, some at a time: what the driver keeps of a write or a listing is bounded
        rows = stage(rows.withColumn("part", F.pmod(F.xxhash64("report_id"), F.lit(parts)).cast("int")), "metric-rows", by="part")
        folders = [f"{path}/{k}" for k in range(parts)]
    for k, folder in enumerate(folders):
        some = rows.where(F.col("part") == k).drop("part") if parts > 1 else rows
        # the lines come partitioned by report, so a report's are written by one task
        (_report_text(some, variant).withColumnRenamed("report_id", "rid").sortWithinPartitions("rid", "raw_pos")
         .select("rid", "line").write.partitionBy("rid").text(folder))
    metric_map, suites, cal = report_dims(spark, d, gaps)
    return load_files(spark, [[folder] for folder in folders], metric_map, suites, cal, LEVEL_MONTH, RUN_TS, **kw)


def report_load_files(spark, d):
    """All orders as report files, one metric row per customer, priority and
    status: the text grows with the orders."""
    return _load_files(spark, d).rows


def load_quotes(spark, d):
    """The same with labels over two lines, doubled and stray quotes."""
    return _load_files(spark, d, "quotes").rows


def report_load_description(spark, d):
    """The same with open orders' rows named as in the metric map, whose
    descriptions give their dimensions; rows of other names are no metric rows."""
    return _load_files(spark, d, "names", label_style="description").rows


def load_reject_reasons(spark, d):
    """Every reject reason in one load, counted per report and period."""
    res = _load_files(spark, d, "defects", gaps=True)
    rows = res.rejects().groupBy("report_id", "timeid", "reason").agg(F.count(F.lit(1)).alias("n"))
    both = rows.unionByName(res.report_rejects.select(
        "report_id", F.lit("").alias("timeid"), "reason", F.lit(1).cast("long").alias("n")))
    return both.withColumn("report_id", F.regexp_extract("report_id", "/rid=([^/]+)/", 1))


def report_load(spark, d):
    return _report_load(spark, d, LEVEL_MONTH).rows


def report_load_quarter(spark, d):
    return _report_load(spark, d, LEVEL_QUARTER).rows


def load_audit(spark, d):
    return _report_load(spark, d, LEVEL_MONTH, gaps=True).audit()


def load_rejects(spark, d):
    """Row rejects per report, period and reason, and report rejects."""
    res = _report_load(spark, d, LEVEL_MONTH, gaps=True)
    rows = res.rejects().groupBy("report_id", "timeid", "reason").agg(F.count(F.lit(1)).alias("n"))
    return rows.unionByName(res.report_rejects.select(
        "report_id", F.lit("").alias("timeid"), "reason", F.lit(1).cast("long").alias("n")))


# ---------------------------------------------------------------- writes
def _scratch(spark) -> str:
    return f"{shared_dir(spark)}/tables/{uuid.uuid4().hex}"


def _read_final(spark, path):
    from pyspark.sql.types import StringType, StructField, StructType
    schema = StructType([StructField(c, StringType(), True) for c in FINAL_COLS])
    return spark.read.schema(schema).parquet(path).select(*FINAL_COLS)


def write_append(spark, d):
    path = _scratch(spark)
    rows = final_layout(spark, d)
    sink.append(rows, path)
    sink.append(rows, path)
    return _read_final(spark, path)


def write_overwrite(spark, d):
    path = _scratch(spark)
    rows = final_layout(spark, d)
    sink.append(rows, path)
    sink.overwrite(rows, path)
    return _read_final(spark, path)


def upsert_path(spark, d):
    """Two runs through ``write(..., "upsert")`` into a table on storage, rows
    of every segment as a suite of its own: the first run holds the months up
    to June, the second all months; then the table is read back."""
    path = _scratch(spark)
    rows = stage(final_layout(spark, d).groupBy(*[c for c in FINAL_COLS if c not in ("metric_value", "rpt_suite_id", "metric_id")])
                 .agg(F.max("metric_value").alias("metric_value"))
                 .withColumns({"rpt_suite_id": F.col("lob"), "metric_id": F.col("product")}).select(*FINAL_COLS), "run")
    first = rows.where(F.right("timeid", F.lit(2)) <= "06").withColumn("metric_value", F.lit("0.0"))
    sink.write(spark, first, path, "upsert", RUN_TS)
    sink.write(spark, rows.withColumn("create_ts", F.lit("second")), path, "upsert", "second")
    return _read_final(spark, path)


def report_load_twice(spark, d):
    """The month load of all reports, the latest report's rows, written by
    upsert twice: the second run, under another run time, changes nothing."""
    path = _scratch(spark)
    rows = stage(_report_load(spark, d, LEVEL_MONTH).latest(), "latest-rows")
    sink.write(spark, rows, path, "upsert", RUN_TS)
    sink.write(spark, rows.withColumns({"create_ts": F.lit("second"), "update_ts": F.lit("second")}), path, "upsert", "second")
    return _read_final(spark, path)


def upsert_added_columns(spark, d):
    """A table gets a column that later rows lack, and the other way round: the
    first half year is written with a note, all months are upserted without it
    and with a rank of their own, then the table is read with all its columns."""
    path = _scratch(spark)
    rows = stage(final_layout(spark, d).groupBy("timeid", "lob", "product", "metric_name")
                 .agg(F.count(F.lit(1)).alias("n"))
                 .select("timeid", "lob", F.col("product").alias("metric_id"), "metric_name",
                         F.col("n").cast("string").alias("metric_value"), F.lit(RUN_TS).alias("create_ts"),
                         F.lit(RUN_TS).alias("update_ts"), "n"), "run")
    early = rows.where(F.right("timeid", F.lit(2)) <= "06")
    first = early.select("timeid", "lob", "metric_id", "metric_name", F.lit("0").alias("metric_value"), "create_ts", "update_ts",
                         F.concat(F.lit("note "), "metric_id").alias("region_note"))
    second = rows.withColumn("orders_rank", F.col("n") % 7).drop("n").withColumn("create_ts", F.lit("second"))
    sink.append(first, path)
    sink.write(spark, second, path, "upsert", "second")
    return sink.read_target(spark, path).select(
        "timeid", "lob", "metric_id", "metric_name", "metric_value", "create_ts", "update_ts", "region_note", "orders_rank")


def _registered(spark, d, rows: DataFrame | None = None, comments: DataFrame | None = None) -> str:
    path = _scratch(spark)
    rows = final_layout(spark, d) if rows is None else rows
    sink.append(rows, path)
    return sink.register_table(spark, "tallyspark_q", f"t_{uuid.uuid4().hex[:12]}", path, schema=rows.schema, comments=comments)


def register_table(spark, d):
    return spark.table(_registered(spark, d)).select(*FINAL_COLS)


def _table_comments(spark, name) -> DataFrame:
    return spark.sql(f"DESCRIBE TABLE {name}").where(~F.col("col_name").startswith("#")).select(
        "col_name", "data_type", F.coalesce(F.col("comment"), F.lit("")).alias("comment")).distinct()


def publish_comments(spark, d):
    # comments from the data itself: the number of distinct values per column
    rows = stage(final_layout(spark, d), "commented")
    stats = rows.agg(*[F.count_distinct(F.col(c)).alias(c) for c in FINAL_COLS])
    comments = stats.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.concat(F.lit("it's "), F.col(c).cast("string"),
                                                    F.lit(" distinct values")).alias("metadata"),
                 F.lit(i).cast("long").alias("ord")) for i, c in enumerate(FINAL_COLS)])))
    # the partition column takes its comment where the table is declared
    name = _registered(spark, d, rows, comments)
    sink.publish_comments(spark, name, comments)
    return _table_comments(spark, name)


def add_columns(spark, d):
    name = _registered(spark, d)
    r = read_table(spark, d, "region")
    comments = r.select(F.concat(F.lit("region_"), F.lower(F.regexp_replace("r_name", " ", "_"))).alias("column"),
                        F.concat(F.lit("orders in "), F.col("r_name")).alias("metadata"),
                        F.col("r_regionkey").cast("long").alias("ord"))
    sink.add_columns(spark, name, comments)
    return _table_comments(spark, name)


QUERIES = {
    "unpivot_month": unpivot_month,
    "unpivot_quarter": unpivot_quarter,
    "unpivot_summary": unpivot_summary,
    "label_split": label_split,
    "label_split_pipe": label_split_pipe,
    "metric_lookup": metric_lookup,
    "suite_lookup": suite_lookup,
    "description_lookup": description_lookup,
    "time_join": time_join,
    "final_layout": final_layout,
    "section_carve": section_carve,
    "header_classify": header_classify,
    "preamble": preamble,
    "value_parse": value_parse,
    "upsert": upsert,
    "upsert_null_key": upsert_null_key,
    "merge_key_dups": merge_key_dups,
    "column_comments": column_comments,
    "report_load": report_load,
    "report_load_quarter": report_load_quarter,
    "report_load_files": report_load_files,
    "load_quotes": load_quotes,
    "report_load_description": report_load_description,
    "load_reject_reasons": load_reject_reasons,
    "section_wide_month": section_wide_month,
    "load_audit": load_audit,
    "load_rejects": load_rejects,
    "upsert_path": upsert_path,
    "report_load_twice": report_load_twice,
    "upsert_added_columns": upsert_added_columns,
    "write_append": write_append,
    "write_overwrite": write_overwrite,
    "register_table": register_table,
    "publish_comments": publish_comments,
    "add_columns": add_columns,
}
