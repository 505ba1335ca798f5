"""Report files arriving in a folder are loaded and upserted per batch."""

from __future__ import annotations

import os

from reports import dims, month_report, write_reports
from tallyspark.streaming.reports import start_report_stream


def test_stream_loads_and_upserts(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "in")
    os.makedirs(src)
    write_reports(src, {"a.csv": month_report()})
    mm, su, td = dims(spark)
    target = os.path.join(tmpdir_path, "target")
    ckpt = os.path.join(tmpdir_path, "ckpt")
    q = start_report_stream(spark, src, ckpt, target, mm, su, td, "Month")
    q.awaitTermination(300)
    assert spark.read.parquet(target).count() == 48
    # a later file with changed values for the same metrics and periods
    write_reports(src, {"b.csv": month_report(this_rows=["[T|retail|web|shop|Visits|Traffic]," +
                                                         ",".join("7" * 12)], last_rows=[])})
    q = start_report_stream(spark, src, ckpt, target, mm, su, td, "Month")
    q.awaitTermination(300)
    t = spark.read.parquet(target)
    assert t.count() == 48
    assert {r.metric_value for r in t.where("metric_id = '101' and timeid like '2022%'").collect()} == {"7.0"}
