"""Metric label splitting (bracket style and pipe style) as column expressions.

Bracket style ``[X|lob|channel|product|metric|category]`` is split on any of
``[ | ]`` with empty pieces kept, so the parts sit at 0-based positions
2 lob, 3 channel, 4 product, 5 metric, 6 category. Pipe style
``X|lob|channel|product|metric|category`` is split on ``|`` only: 1 lob,
2 channel, 3 product, 4 metric, 5 category.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyspark.constants import (
    ALL_LOB, CATEGORY_TYPE, DEFAULT_CATEGORY, LABEL_SPLIT_PATTERN, NO_FILTER,
    PIPE_SPLIT_PATTERN,
)
from tallyspark.functions.text import part, pystrip

SEGMENT_FIELDS = ["channel", "lob", "product", "category_type", "category", "metric_name"]


def split_label(label: Column, lob_filter: Column | str = NO_FILTER) -> Column:
    """Bracket-style label -> struct(channel, lob, product, category_type,
    category, metric_name, n_parts). ``n_parts < 6`` marks a label to reject."""
    lob_filter = F.lit(lob_filter) if isinstance(lob_filter, str) else lob_filter
    a = F.split(label, LABEL_SPLIT_PATTERN, -1)
    cat_raw = part(a, 6)
    category = (F.when(F.coalesce(cat_raw, F.lit("")) == "", F.lit(DEFAULT_CATEGORY))
                .otherwise(pystrip(cat_raw)))
    lob = (F.when(F.lower(lob_filter) == NO_FILTER, F.lit(ALL_LOB))
           .otherwise(F.upper(pystrip(part(a, 2)))))
    return F.struct(
        pystrip(part(a, 3)).alias("channel"),
        lob.alias("lob"),
        pystrip(part(a, 4)).alias("product"),
        F.lit(CATEGORY_TYPE).alias("category_type"),
        category.alias("category"),
        pystrip(part(a, 5)).alias("metric_name"),
        F.size(a).alias("n_parts"),
    )


def split_label_pipe(label: Column, lob_filter: Column | str = NO_FILTER,
                     lob_override: Column | str | None = None,
                     category_type: str = CATEGORY_TYPE) -> Column:
    """Pipe-style label. ``lob_override`` (a segment filter value) wins when
    given; else 'no filter' or an empty lob part give 'ALL LoB'. The category
    part must exist: ``n_parts < 6`` marks a label to reject."""
    lob_filter = F.lit(lob_filter) if isinstance(lob_filter, str) else lob_filter
    a = F.split(label, PIPE_SPLIT_PATTERN, -1)
    cat_raw = part(a, 5)
    category = F.when(cat_raw == "", F.lit(DEFAULT_CATEGORY)).otherwise(pystrip(cat_raw))
    lob_part = pystrip(part(a, 1))
    lob = (F.when((F.lower(lob_filter) == NO_FILTER) | (lob_part == ""), F.lit(ALL_LOB))
           .otherwise(F.upper(lob_part)))
    if lob_override is not None:
        ov = F.lit(lob_override) if isinstance(lob_override, str) else lob_override
        lob = F.when(ov.isNotNull(), F.upper(ov)).otherwise(lob)
    return F.struct(
        pystrip(part(a, 2)).alias("channel"),
        lob.alias("lob"),
        pystrip(part(a, 3)).alias("product"),
        F.lit(category_type).alias("category_type"),
        category.alias("category"),
        pystrip(part(a, 4)).alias("metric_name"),
        F.size(a).alias("n_parts"),
    )


def label_ok(segments: Column) -> Column:
    """Reject rule: the label has at least 6 parts."""
    return segments["n_parts"] >= 6
