"""Fixed values of the report format and the output layout.

Everything in this module is a fixed value that must equal the behaviour being
reproduced (column names, markers, defaults, tokens). Logic lives elsewhere.
"""

from __future__ import annotations

# --- fixed values: raw report -------------------------------------------------
# A report is read into 13 positional string columns, no header row.
REPORT_WIDTH = 13
REPORT_COLS = [f"col{i}" for i in range(1, REPORT_WIDTH + 1)]

# Markers tested with a plain, case-sensitive substring match on ``col1``.
HEADER_MARK = "#"
HEADER_WORD = "Metrics"
HEADER_BY = "by"
MONTH_THIS_MARK = "month - this"
MONTH_LAST_MARK = "month - last"
QUARTER_MARK = "quarter"
SEPARATOR_MARK = "####"
METRIC_MARK = "|"
DATE_MARK = "# Date"
SUITE_SPLIT = ": "

# Preamble rows (0-based, counted after blank and over-wide lines are dropped).
SUITE_POS = 2
DATE_POS = 3

# Body start offset after a section header, per section kind.
SECTION_OFFSETS = {"summary": 2, "month_this": 5, "month_last": 5, "quarter": 5}

# --- fixed values: section layouts ---------------------------------------------
MONTH_NAMES = [
    "january", "february", "march", "april", "may", "june",
    "july", "august", "september", "october", "november", "december",
]
SUMMARY_COLS = ["metrix", "all_visits_this_year", "all_visits_last_year"]
MONTH_THIS_COLS = ["metrix"] + [f"all_visits_this_year_{m}" for m in MONTH_NAMES]
MONTH_LAST_COLS = ["metrix"] + [f"all_visits_last_year_{m}" for m in MONTH_NAMES]
QUARTER_COLS = (["metrix"] + [f"all_visits_last_year_{q}" for q in range(1, 5)]
                + [f"all_visits_this_year_{q}" for q in range(1, 5)])

# --- fixed values: metric label ------------------------------------------------
LABEL_SPLIT_PATTERN = r"[\[\|\]]"
PIPE_SPLIT_PATTERN = r"\|"
CATEGORY_TYPE = "Site Activity"
DEFAULT_CATEGORY = "Stand Alone"
ALL_LOB = "ALL LoB"
NO_FILTER = "no filter"
DEFAULT_METRIC_ID = "0"

# --- fixed values: value tokens read as missing -------------------------------
# The default missing-value strings of the pandas CSV reader.
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]

# --- fixed values: time ---------------------------------------------------------
RUN_TIMEZONE = "America/Chicago"
TS_FORMAT = "yyyy-MM-dd HH:mm:ss"
LEVEL_MONTH = "Month"
LEVEL_QUARTER = "Quarter"
LEVEL_YEAR = "Year"

# --- fixed values: output layout ----------------------------------------------
LONG_COLS = [
    "timeid", "rpt_suite_id", "rpt_suite_nm", "channel", "lob", "product",
    "category_type", "category", "metric_name", "metric_value", "metric_id",
]
AUDIT_TS_COLS = ["create_ts", "update_ts"]
PLACEHOLDER_COLS = ["sgm_cd", "sgm_desc", "seg_cd", "seg_desc", "metric_format", "page_url", "data_src"]
TIME_COLS = ["timelvl", "timeidnm", "timelvlnm"]
FINAL_COLS = [
    "timelvl", "timelvlnm", "timeid", "timeidnm", "rpt_suite_id", "rpt_suite_nm",
    "channel", "lob", "product", "category_type", "category", "sgm_cd", "sgm_desc",
    "seg_cd", "seg_desc", "metric_name", "metric_value", "metric_format", "page_url",
    "data_src", "create_ts", "update_ts", "metric_id",
]

# Upsert keys and the columns a changed value replaces.
MERGE_KEYS = ["timeid", "metric_id", "lob"]
MERGE_CHANGE_COL = "metric_value"
MERGE_SET_COLS = ["metric_value", "update_ts", "metric_name"]

# --- reject reasons ------------------------------------------------------------
R_LABEL_SHORT = "label_parts"        # label has fewer than 6 parts
R_NO_YEAR = "no_year"                # date row missing or year not an integer
R_NO_SUITE = "suite_unknown"         # suite name missing or not in the catalogue
R_BAD_VALUE = "value_not_numeric"    # a value is neither numeric nor missing
R_NO_SECTION = "section_missing"     # a section needed by the level is absent
R_NO_TIME = "timeid_not_in_calendar" # period absent from the time dimension
R_EMPTY = "empty_report"           # the file has no header, separator or preamble line
R_QUOTE = "unbalanced_quote"         # a quoted field spans lines
