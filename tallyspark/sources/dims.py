"""Dimension tables: metric mapping, report-suite catalogue, time dimension,
column comments. Each gets an ``ord`` column so 'first match' rules have an
order to follow."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_dim(spark: SparkSession, path: str, fmt: str = "csv", ord_col: str = "ord",
             columns: list[str] | None = None) -> DataFrame:
    """Read a small table with a header. All columns are read as text.

    ``ord`` is the row's place in the file (file name, then line order), the
    order a 'first match' lookup follows.
    """
    if fmt == "csv":
        df = (spark.read.option("header", True).option("inferSchema", False)
              .option("escape", '"').csv(path))
    else:
        df = spark.read.format(fmt).load(path)
        df = df.select([F.col(c).cast("string").alias(c) for c in df.columns])
    df = df.select("*", F.col("_metadata.file_path").alias("_f"),
                   F.col("_metadata.file_block_start").alias("_b"),
                   F.monotonically_increasing_id().alias("_m"))
    # Rows keep file order within one split, so (file, split start, id) is a
    # total order that follows the files; structs compare field by field.
    df = df.withColumn(ord_col, F.struct("_f", "_b", "_m")).drop("_f", "_b", "_m")
    if columns:
        df = df.select(*columns, ord_col)
    return df


def read_time_dim(spark: SparkSession, table_or_path: str) -> DataFrame:
    """Time dimension from the catalog (``db.table``) or a parquet path.

    Fails with a clear message when neither exists.
    """
    if "/" in table_or_path or ":" in table_or_path:
        df = spark.read.parquet(table_or_path)
    elif spark.catalog.tableExists(table_or_path):
        df = spark.table(table_or_path)
    else:
        raise LookupError(f"time dimension {table_or_path!r} is not available")
    return df.select(*(F.col(c).cast("string").alias(c)
                       for c in ("timelvl", "timelvlnm", "timeid", "timeidnm")))
