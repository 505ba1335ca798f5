"""Dimension files keep file order for 'first match' lookups."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from tallyspark.operators import lookups
from tallyspark.sinks.tables import first_comments
from tallyspark.sources.dims import read_dim


def test_metric_map_first_in_file_order(spark, tmpdir_path):
    rows = ["id,name,description"] + [f"{i},filler {i},d" for i in range(3000)]
    rows.insert(1500, '900001,"[T|A|b|c|d|e]",first')
    rows.append('900002,"[t|a|B|C|D|E]",second')
    with open(os.path.join(tmpdir_path, "map.csv"), "w") as f:
        f.write("\n".join(rows) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")   # several splits
    try:
        m = read_dim(spark, tmpdir_path, "csv")
        ids = lookups.metric_ids(m).where(F.col("name_key") == "[t|a|b|c|d|e]").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [r.metric_id for r in ids] == ["900001"]


def test_comment_table_first_per_column(spark, tmpdir_path):
    with open(os.path.join(tmpdir_path, "c.csv"), "w") as f:
        f.write("column,metadata\nlob,\"line of business, it's\"\nlob,later\ntimeid,period\n")
    got = {r.column: r.comment for r in first_comments(read_dim(spark, tmpdir_path, "csv")).collect()}
    assert got == {"lob": "line of business, it's", "timeid": "period"}


def test_parquet_dimension_is_text_with_order(spark, tmpdir_path):
    spark.createDataFrame([(7, "Suite A"), (8, "Suite A"), (9, "Suite B")], "rsid long, name string") \
        .coalesce(1).write.parquet(f"{tmpdir_path}/s")
    s = read_dim(spark, f"{tmpdir_path}/s", "parquet")
    assert dict(s.dtypes)["rsid"] == "string"
    got = {r.suite_name: r.rsid for r in lookups.suite_ids(s).collect()}
    assert got == {"Suite A": "7", "Suite B": "9"}
