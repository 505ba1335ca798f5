"""Golden report texts and small dimension frames for the tests."""

from __future__ import annotations

import os

SEP = "####################"


def month_report(suite="Suite A", year=2022, this_rows=None, last_rows=None, extra_top="", date=True):
    this_rows = this_rows if this_rows is not None else [
        "[T|retail|web|shop|Visits|Traffic]," + ",".join(str(10 + i) for i in range(12)),
        "[T|grocery|app|shop|Orders]," + ",".join(str(i) for i in range(12)),
    ]
    last_rows = last_rows if last_rows is not None else [
        "[T|retail|web|shop|Visits|Traffic]," + ",".join(str(100 + i) for i in range(12)),
        "[T|grocery|app|shop|Orders]," + ",".join(str(50 + i) for i in range(12)),
    ]
    date_line = f'"# Date: Jan 1, {year} - Dec 31, {year}"' if date else "# Nothing here"
    lines = [SEP, "# Company", f"# Report suite: {suite}", date_line, SEP, "", extra_top,
             "# Site Metrics", SEP, ",This year,Last year",
             "[T|retail|web|shop|Visits|Traffic],100,90", SEP,
             "# Site Metrics by month - this year", SEP, "h1", "h2", "h3", *this_rows, SEP,
             "# Site Metrics by month - last year", SEP, "h1", "h2", "h3", *last_rows, SEP]
    return "\n".join(lines) + "\n"


def quarter_report(suite="Suite A", year=2022, rows=None):
    rows = rows if rows is not None else [
        "[T|retail|web|shop|Visits|Traffic],1,2,3,4,5,6,7,8",
    ]
    lines = [SEP, "# Company", f"# Report suite: {suite}", f'"# Date: Jan 1, {year} - Dec 31, {year}"', SEP,
             "# Site Metrics by quarter", SEP, "h1", "h2", "h3", *rows, SEP]
    return "\n".join(lines) + "\n"


def write_reports(folder, texts: dict) -> str:
    for name, text in texts.items():
        with open(os.path.join(folder, name), "w") as f:
            f.write(text)
    return folder


def dims(spark, level_years=(2020, 2021, 2022, 2023)):
    metric_map = spark.createDataFrame(
        [("101", "[T|retail|web|shop|Visits|Traffic]", "desc a", 0),
         ("102", "[t|RETAIL|web|shop|visits|traffic]", "desc b", 1),
         ("201", "[T|grocery|app|shop|Orders]", "desc c", 2)],
        "id string, name string, description string, ord long")
    suites = spark.createDataFrame([("Suite A", "rsA", 0), ("Suite B", "rsB", 1), ("Suite A", "rsA2", 2),
                                    ("Suite A, Retail", "rsAR", 3)],
                                   "name string, rsid string, ord long")
    rows = []
    for y in level_years:
        for m in range(1, 13):
            rows.append(("M", "Month", f"{y}{m:02d}", f"{y}-{m:02d}"))
        for q in range(1, 5):
            rows.append(("Q", "Quarter", f"{y}{q}", f"Q{q} {y}"))
    time_dim = spark.createDataFrame(rows, "timelvl string, timelvlnm string, timeid string, timeidnm string")
    return metric_map, suites, time_dim
