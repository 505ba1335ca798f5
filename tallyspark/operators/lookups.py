"""Dimension lookups: metric id, report suite, description, time level."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.constants import DEFAULT_METRIC_ID, METRIC_MARK, TIME_COLS
from tallyspark.operators.joins import first_by


def metric_ids(metric_map: DataFrame) -> DataFrame:
    """``(name_key, metric_id)``: first id per lower-cased name; NULL names
    never match."""
    m = metric_map.where(F.col("name").isNotNull())
    return first_by(m, [F.lower(F.col("name")).alias("name_key")], "id", alias="metric_id")


def with_metric_id(df: DataFrame, label: Column, ids: DataFrame) -> DataFrame:
    """Adds ``metric_id``: the mapping id whose name equals the whole label
    case-insensitively, ``'0'`` when none does."""
    keyed = df.withColumn("__name_key", F.lower(label))
    return (keyed.join(ids, keyed["__name_key"] == ids["name_key"], "left")
            .withColumn("metric_id", F.coalesce(F.col("metric_id"), F.lit(DEFAULT_METRIC_ID)))
            .drop("__name_key", "name_key"))


def suite_ids(suites: DataFrame) -> DataFrame:
    """``(suite_name, rsid)``: first rsid per exact (case-sensitive) name."""
    s = suites.where(F.col("name").isNotNull())
    return first_by(s, [F.col("name").alias("suite_name")], "rsid")


def with_suite(meta: DataFrame, ids: DataFrame, name_col: str = "rs_name") -> DataFrame:
    """Adds ``rsid``; NULL when the name is missing, empty or unknown."""
    return (meta.join(ids, meta[name_col] == ids["suite_name"], "left")
            .withColumn("rsid", F.when(F.coalesce(F.col(name_col), F.lit("")) != "", F.col("rsid")))
            .drop("suite_name"))


def descriptions(metric_map: DataFrame) -> DataFrame:
    """``(desc_name, description)``: first description per exact name."""
    m = metric_map.where(F.col("name").isNotNull())
    return first_by(m, [F.col("name").alias("desc_name")], "description")


def with_description(df: DataFrame, name: Column, descs: DataFrame) -> DataFrame:
    """Adds ``description`` of the mapping row whose name equals ``name``."""
    keyed = df.withColumn("__desc_key", name)
    return (keyed.join(descs, keyed["__desc_key"] == descs["desc_name"], "left")
            .drop("__desc_key", "desc_name"))


def first_cell(line: Column) -> Column:
    """The first cell of an unquoted line, straight from its text; NULL for a
    line that must be parsed to tell."""
    return F.when(~F.startswith(line, F.lit('"')), F.substring_index(line, ",", 1))


def maybe_metric_lines(lines: DataFrame, descs: DataFrame) -> DataFrame:
    """Lines ``(.., line)`` that may be metric rows where these are known by a
    name of the mapping too: tested before any cell is parsed."""
    line = F.col("line")
    named = with_description(lines, first_cell(line), descs.withColumn("__named", F.lit(True)))
    may = line.contains(METRIC_MARK) | F.startswith(line, F.lit('"')) | F.coalesce("__named", F.lit(False))
    return named.where(may).select(*lines.columns)


def with_label_text(body: DataFrame, descs: DataFrame) -> DataFrame:
    """Rows whose ``col1`` is a delimited label or a name of the mapping, with
    ``label_text``: the label, or the description that stands for the name
    (empty where it has none)."""
    piped = F.col("col1").contains(METRIC_MARK)
    named = with_description(body, F.when(~piped, F.col("col1")), descs.withColumn("__named", F.lit(True)))
    text = F.when(piped, F.col("col1")).otherwise(F.coalesce("description", F.lit("")))
    return named.where(piped | F.col("__named")).withColumn("label_text", text).drop("__named", "description")


def time_level(time_dim: DataFrame, level: str) -> DataFrame:
    """Calendar rows of one level (filter reaches the scan)."""
    return (time_dim.where(F.col("timelvlnm") == level)
            .select(F.col("timeid").cast("string").alias("timeid"), *TIME_COLS))


def with_time(df: DataFrame, calendar: DataFrame) -> DataFrame:
    """Inner join on ``timeid``: rows without a calendar entry are dropped,
    duplicate calendar rows fan out. Adds ``timelvl, timeidnm, timelvlnm``."""
    return df.join(calendar, "timeid", "inner")
