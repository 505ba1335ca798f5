"""Load audit: one row per run phase (start, end, fail), appended to a table.

The counts are real: long rows read, rows written and rows rejected,
observed while the rows are written. The original error is re-raised, never
replaced.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import asdict, dataclass

from typing import TYPE_CHECKING

from pyspark.sql import DataFrame, SparkSession

from tallyspark.functions.periods import run_ts as now_ts

if TYPE_CHECKING:
    from tallyspark.plans.load import LoadResult

AUDIT_SCHEMA = ("phase string, ts string, jobname string, subjobname string, application string, "
                "product string, loadtype string, prereccount long, postreccount long, rejreccount long, "
                "restart_step string, error string, rejreportcount long")


@dataclass(frozen=True)
class JobInfo:
    jobname: str
    subjobname: str = ""
    application: str = ""
    product: str = ""
    loadtype: str = "Incr"
    restart_step: str = ""


def audit_row(spark: SparkSession, phase: str, job: JobInfo, pre: int | None = None, post: int | None = None,
              rejected: int | None = None, error: str | None = None,
              rejected_reports: int | None = None) -> DataFrame:
    j = asdict(job)
    row = (phase, now_ts(), j["jobname"], j["subjobname"], j["application"], j["product"], j["loadtype"],
           pre, post, rejected, j["restart_step"], error, rejected_reports)
    return spark.createDataFrame([row], AUDIT_SCHEMA)


def run_with_audit(spark: SparkSession, audit_path: str, job: JobInfo,
                   load: Callable[[], tuple["LoadResult", Callable[[DataFrame], None]]]) -> None:
    """``load()`` returns ``(result, write)``: a load result built with
    ``observe=True`` and the function that writes its rows. Appends a start
    row, runs the write, then appends an end row with the counts observed
    during the write (no extra pass), or a fail row with the error text before
    re-raising."""
    audit_row(spark, "start", job).write.mode("append").parquet(audit_path)
    try:
        result, write = load()
        if not result.observed:
            raise ValueError("the load must be built with observe=True, or its counts are unknown")
        write(result.rows)
        c = result.counts()
        audit_row(spark, "end", job, c["pre"], c["written"], c["rejected"],
                  rejected_reports=result.report_rejects.count()).write.mode("append").parquet(audit_path)
    except Exception as e:
        audit_row(spark, "fail", job, error=str(e)).write.mode("append").parquet(audit_path)
        raise
