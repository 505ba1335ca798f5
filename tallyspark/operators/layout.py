"""Output layout: long schema, audit timestamps, placeholders, final order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tallyspark.constants import AUDIT_TS_COLS, FINAL_COLS, LONG_COLS, PLACEHOLDER_COLS

LONG_SCHEMA = StructType([StructField(c, StringType(), True) for c in LONG_COLS])


def to_long_layout(df: DataFrame) -> DataFrame:
    """The 11 long columns, all text, in order."""
    out = df.select(*[F.col(c).cast("string").alias(c) for c in LONG_COLS])
    if StructType([StructField(f.name, f.dataType, True) for f in out.schema.fields]) != LONG_SCHEMA:
        raise TypeError("long rows do not fit the long schema")
    return out


def stamp(df: DataFrame, run_ts: str) -> DataFrame:
    """``create_ts = update_ts = run_ts`` (one literal per run)."""
    return df.withColumns({c: F.lit(run_ts) for c in AUDIT_TS_COLS})


def with_placeholders(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.lit("") for c in PLACEHOLDER_COLS})


def final_extract(df: DataFrame) -> DataFrame:
    """Placeholders added, then the 23 output columns in their fixed order."""
    return with_placeholders(df).select(*FINAL_COLS)


def preview(df: DataFrame, n: int = 10) -> DataFrame:
    """First ``n`` rows on demand; never called inside a transform."""
    return df.limit(n)
