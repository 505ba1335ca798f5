"""Incremental load of report files as they arrive.

A file-source stream picks up new report files; every micro-batch (whole
files only) is loaded and upserted into the target. The upsert is idempotent
on non-NULL keys, so a batch replayed after a failure changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tallyspark.functions.periods import run_ts
from tallyspark.plans.load import load_reports
from tallyspark.sinks.tables import upsert
from tallyspark.sources.reports import read_reports_with_markers, scan_columns


def start_report_stream(spark: SparkSession, source_dir: str, checkpoint_location: str, target_path: str,
                        metric_map: DataFrame, suites: DataFrame, time_dim: DataFrame, level: str,
                        available_now: bool = True, max_files_per_trigger: int | None = None,
                        processing_time: str = "1 minute") -> StreamingQuery:
    """Start the stream. ``checkpoint_location`` must be on shared storage."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    stream = scan_columns(reader.load(source_dir))

    def load_batch(batch: DataFrame, batch_id: int) -> None:
        ts = run_ts()
        parsed, candidates, _ = read_reports_with_markers(spark, batch)
        result = load_reports(parsed, metric_map, suites, time_dim, level, ts, candidates=candidates)
        upsert(spark, result.rows, target_path, ts)

    writer = stream.writeStream.foreachBatch(load_batch).option("checkpointLocation", checkpoint_location)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time)
    return writer.start()
