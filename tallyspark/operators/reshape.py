"""Wide section rows -> one row per metric and period (unpivot)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.constants import LEVEL_MONTH, LEVEL_QUARTER, LEVEL_YEAR, REPORT_COLS

VALUE_COLS = REPORT_COLS[1:]           # col2..col13
LEVEL_KINDS = {
    LEVEL_MONTH: ["month_last", "month_this"],
    LEVEL_QUARTER: ["quarter"],
    LEVEL_YEAR: ["summary"],
}
KIND_WIDTH = {"month_last": 12, "month_this": 12, "quarter": 8, "summary": 2}


def kinds_for_level(level: str) -> list[str]:
    """Sections a level emits; any other level emits nothing."""
    return LEVEL_KINDS.get(level, [])


def unpivot_periods(body: DataFrame, id_cols: list[str], year_col: str = "year") -> DataFrame:
    """Rows ``id_cols + kind + year, col2..col13`` -> ``id_cols + kind + slot,
    timeid, raw``.

    Periods per kind: month_last -> ``(year-1)MM``, month_this -> ``yearMM``;
    quarter: slots 1-4 -> ``(year-1)Q``, 5-8 -> ``year(Q)``; summary: slot 1 ->
    ``year``, slot 2 -> ``year-1``. Missing cells stay (as NULL ``raw``).
    ``DataFrame.unpivot`` keeps NULL values (SQL ``UNPIVOT`` would drop them).
    """
    ids = list(dict.fromkeys(id_cols + ["kind", year_col]))
    slots = [f"{i:02d}" for i in range(1, len(VALUE_COLS) + 1)]
    # once per wide row, not per cell: the two years and the width
    year, text = F.col(year_col), lambda y: F.coalesce(y.cast("string"), F.lit("null"))
    width = F.coalesce(*[F.when(F.col("kind") == k, F.lit(f"{w:02d}")) for k, w in KIND_WIDTH.items()])
    monthly = F.col("kind").isin("month_last", "month_this")
    wide = body.select(*ids, *[F.col(c).alias(s) for c, s in zip(VALUE_COLS, slots)],
                       F.when(F.col("kind") == "summary", year.cast("string")).otherwise(text(year)).alias("__this"),
                       F.when(F.col("kind") == "summary", (year - 1).cast("string")).otherwise(text(year - 1)).alias("__last"),
                       width.alias("__width"), monthly.alias("__monthly"))
    long = wide.unpivot([*ids, "__this", "__last", "__width", "__monthly"], slots, "__slot", "raw")
    slot, this, last = F.col("__slot"), F.col("__this"), F.col("__last")
    digit = F.right(slot, F.lit(1))
    timeid = (F.when(F.col("__monthly"), F.concat(F.when(F.col("kind") == "month_last", last).otherwise(this), slot))
              .when(F.col("kind") == "summary", F.when(slot == "01", this).otherwise(last))
              .otherwise(F.when(slot <= "04", F.concat(last, digit))
                         .otherwise(F.concat(this, F.translate(digit, "5678", "1234")))))
    return (long.where(slot <= F.col("__width"))
            .select(*ids, slot.cast("int").alias("slot"), timeid.alias("timeid"), "raw"))
