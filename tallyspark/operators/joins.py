"""Join helpers: size-checked broadcast and 'first match' deduplication."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.session import stage

# Rows a broadcast side may have. At ~100 bytes a row this is ~100 MB per
# executor, the upper end of what a broadcast should carry.
BROADCAST_MAX_ROWS = 1_000_000
# Estimated size below which no count is needed (Spark's own default
# broadcast threshold).
ESTIMATE_MAX_BYTES = 10 * 1024 * 1024


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate of ``df`` (file sizes for scans; an
    upper bound after filters and aggregates). Costs no job."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def sized_broadcast(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS,
                    max_bytes: int = ESTIMATE_MAX_BYTES) -> DataFrame:
    """Broadcast ``df`` only when its size is known to be bounded.

    First the optimizer's estimate (no job): at most ``max_bytes`` -> broadcast.
    Otherwise a row count that stops after ``max_rows + 1`` rows decides.
    Beyond the bound the frame is returned as is and the planner shuffles both
    sides (AQE splits skewed partitions of that join).
    """
    if estimated_bytes(df) <= max_bytes:
        return F.broadcast(df)
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df


def materialize_small(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Compute a small derived side once, store it in the shared checkpoint
    folder (cuts lineage, survives executor loss) and broadcast it when the
    size check passes."""
    return sized_broadcast(stage(df, "small"), max_rows)


def first_by(df: DataFrame, keys: list, value: str, ord_col: str = "ord",
             alias: str | None = None) -> DataFrame:
    """First ``value`` per key in ``ord`` order (a 'first match' lookup).

    ``min_by`` is an ordinary aggregate: partial results are combined map-side,
    so a key holding a third of all rows never reaches one task whole.
    """
    key_cols = [F.col(k) if isinstance(k, str) else k for k in keys]
    return df.groupBy(*key_cols).agg(F.min_by(F.col(value), F.col(ord_col)).alias(alias or value))
