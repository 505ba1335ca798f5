"""Expected-result SQL (DuckDB dialect) for the queries in ``plans.queries``.

Each statement computes the expected result straight from the tables, by a
route independent of the Spark plan (a period grid and outer joins instead of
report text, ``NOT EXISTS``-style bounds instead of the carve, a full outer
join instead of the split upsert). Column names match the Spark results.
"""

from __future__ import annotations

RUN_TS = "2024-01-01 00:00:00"
OLD_TS = "2023-12-31 00:00:00"
WS = "' ' || chr(9)"          # the whitespace present in the test labels
SPLIT_RE = r"[\[|\]]"

# Cell texts read as missing, and the texts of numbers; fixed values, written
# out here so that the SQL does not depend on the code under test.
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
    "NULL", "NaN", "None", "n/a", "nan", "null"]
FLOAT_RE = r"[+-]?([0-9]+(_[0-9]+)*\.?([0-9]+(_[0-9]+)*)?|\.[0-9]+(_[0-9]+)*)([eE][+-]?[0-9]+(_[0-9]+)*)?"
SPECIAL_RE = r"(?i)[+-]?(inf|infinity|nan)"
_NA_LIST = ", ".join("'" + t.replace("'", "''") + "'" for t in NA_TOKENS)


def _value_text(raw: str) -> str:
    """Python float() text of a cell, NULL when not numeric."""
    return (f"CASE WHEN {raw} IS NULL OR {raw} IN ({_NA_LIST}) THEN 'nan' "
            f"WHEN regexp_full_match(trim({raw}), '{FLOAT_RE}') "
            f"THEN CAST(CAST(replace(trim({raw}), '_', '') AS DOUBLE) AS VARCHAR) END")


ORDERS_YMQ = ("SELECT *, year(o_orderdate) AS y, month(o_orderdate) AS mo, quarter(o_orderdate) AS q FROM orders")

UNPIVOT_MONTH = f"""
WITH o AS ({ORDERS_YMQ}),
cnt AS (SELECT o_orderpriority, y, mo, count(*) AS n FROM o GROUP BY ALL),
yrs AS (SELECT DISTINCT o_orderpriority, y FROM o),
grid AS (SELECT k.*, unnest(range(1, 13)) AS slot
         FROM (SELECT yrs.*, unnest(['month_last', 'month_this']) AS kind FROM yrs) k)
SELECT g.o_orderpriority, CAST(g.y AS INTEGER) AS report_year, g.kind,
       printf('%d%02d', CASE WHEN g.kind = 'month_last' THEN g.y - 1 ELSE g.y END, g.slot) AS timeid,
       coalesce(CAST(CAST(c.n AS DOUBLE) AS VARCHAR), 'nan') AS metric_value
FROM grid g LEFT JOIN cnt c ON c.o_orderpriority = g.o_orderpriority
  AND c.y = CASE WHEN g.kind = 'month_last' THEN g.y - 1 ELSE g.y END AND c.mo = g.slot
"""

UNPIVOT_QUARTER = f"""
WITH o AS ({ORDERS_YMQ}),
cnt AS (SELECT o_orderpriority, y, q, count(*) AS n FROM o GROUP BY ALL),
yrs AS (SELECT DISTINCT o_orderpriority, y FROM o),
grid AS (SELECT yrs.*, unnest(range(1, 9)) AS slot FROM yrs)
SELECT g.o_orderpriority, CAST(g.y AS INTEGER) AS report_year, 'quarter' AS kind,
       CASE WHEN g.slot <= 4 THEN printf('%d%d', g.y - 1, g.slot) ELSE printf('%d%d', g.y, g.slot - 4) END AS timeid,
       coalesce(CAST(CAST(c.n AS DOUBLE) AS VARCHAR), 'nan') AS metric_value
FROM grid g LEFT JOIN cnt c ON c.o_orderpriority = g.o_orderpriority
  AND c.y = CASE WHEN g.slot <= 4 THEN g.y - 1 ELSE g.y END
  AND c.q = CASE WHEN g.slot <= 4 THEN g.slot ELSE g.slot - 4 END
"""

UNPIVOT_SUMMARY = f"""
WITH o AS ({ORDERS_YMQ}),
tot AS (SELECT o_orderpriority, y, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS DOUBLE) / 100.0 AS v
        FROM o GROUP BY ALL),
grid AS (SELECT tot.o_orderpriority, tot.y, unnest(range(1, 3)) AS slot FROM tot)
SELECT g.o_orderpriority, CAST(g.y AS INTEGER) AS report_year, 'summary' AS kind,
       CAST(CASE WHEN g.slot = 1 THEN g.y ELSE g.y - 1 END AS VARCHAR) AS timeid,
       coalesce(CAST(t.v AS VARCHAR), 'nan') AS metric_value
FROM grid g LEFT JOIN tot t ON t.o_orderpriority = g.o_orderpriority
  AND t.y = CASE WHEN g.slot = 1 THEN g.y ELSE g.y - 1 END
"""

LABEL_INPUT = """
SELECT o_orderkey, lower(c_mktsegment) AS seg, o_orderpriority AS prio, o_orderstatus AS st,
       CASE WHEN c_acctbal < 0 THEN 'Filtered' ELSE 'no filter' END AS lf
FROM orders JOIN customer ON o_custkey = c_custkey
"""

LABEL_SPLIT = f"""
WITH b AS ({LABEL_INPUT}),
l AS (SELECT o_orderkey, lf, CASE
        WHEN prio = '5-LOW' THEN '[T|' || seg || '|web]'
        WHEN st = 'O' THEN '[T|' || seg || '| web' || chr(9) || '|' || prio || '|Orders'
        WHEN st = 'F' THEN '[T|' || seg || '| web' || chr(9) || '|' || prio || '|Orders| Done ]'
        ELSE '[T|' || seg || '| web' || chr(9) || '|' || prio || '|Orders| ]' END AS label FROM b),
p AS (SELECT *, regexp_split_to_array(label, '{SPLIT_RE}') AS a FROM l)
SELECT o_orderkey, label, trim(a[4], {WS}) AS channel,
       CASE WHEN lower(lf) = 'no filter' THEN 'ALL LoB' ELSE upper(trim(a[3], {WS})) END AS lob,
       trim(a[5], {WS}) AS product, 'Site Activity' AS category_type,
       CASE WHEN coalesce(a[7], '') = '' THEN 'Stand Alone' ELSE trim(a[7], {WS}) END AS category,
       trim(a[6], {WS}) AS metric_name, CAST(len(a) AS INTEGER) AS n_parts, len(a) >= 6 AS label_ok
FROM p
"""

LABEL_SPLIT_PIPE = f"""
WITH b AS ({LABEL_INPUT}),
l AS (SELECT o_orderkey, lf, CASE
        WHEN prio = '5-LOW' THEN 'T|' || seg || '|web|' || prio || '|Orders'
        WHEN st = 'P' THEN 'T| |web|' || prio || '|Orders|Pending'
        WHEN st = 'O' THEN 'T|' || seg || '|web|' || prio || '|Orders|'
        ELSE 'T|' || seg || '| web |' || prio || '|Orders| Filled ' END AS label FROM b),
p AS (SELECT *, string_split(label, '|') AS a FROM l)
SELECT o_orderkey, label, trim(a[3], {WS}) AS channel,
       CASE WHEN lower(lf) = 'no filter' OR trim(a[2], {WS}) = '' THEN 'ALL LoB' ELSE upper(trim(a[2], {WS})) END AS lob,
       trim(a[4], {WS}) AS product,
       CASE WHEN a[6] = '' THEN 'Stand Alone' ELSE trim(a[6], {WS}) END AS category,
       trim(a[5], {WS}) AS metric_name, len(a) >= 6 AS label_ok
FROM p
"""

METRIC_LOOKUP = """
WITH m AS (SELECT lower(p_name) AS k, arg_min(CAST(p_partkey AS VARCHAR), p_partkey) AS id
           FROM part WHERE p_name IS NOT NULL GROUP BY 1),
l AS (SELECT p_partkey, CASE WHEN p_size > 25 THEN upper(p_name) ELSE p_type END AS label FROM part)
SELECT l.p_partkey, l.label, coalesce(m.id, '0') AS metric_id FROM l LEFT JOIN m ON lower(l.label) = m.k
"""

SUITE_LOOKUP = """
WITH s AS (SELECT r_name AS name, 'rs' || r_regionkey AS rsid, r_regionkey AS ord FROM region
           UNION ALL SELECT r_name, 'dup' || r_regionkey, r_regionkey + 1000 FROM region),
f AS (SELECT name, arg_min(rsid, ord) AS rsid FROM s WHERE name IS NOT NULL GROUP BY 1),
c AS (SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN lower(r_name) ELSE r_name END AS rs_name
      FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
j AS (SELECT c.c_custkey, c.rs_name, CASE WHEN coalesce(c.rs_name, '') <> '' THEN f.rsid END AS rsid
      FROM c LEFT JOIN f ON c.rs_name = f.name)
SELECT c_custkey, rs_name, rsid, rsid IS NOT NULL AS suite_ok FROM j
"""

DESCRIPTION_LOOKUP = f"""
WITH m AS (SELECT p_name AS name,
                  arg_min('[T|' || p_brand || '|web|' || p_type || '|' || p_name || '|' || CAST(p_size AS VARCHAR) || ']',
                          p_partkey) AS description
           FROM part WHERE p_name IS NOT NULL GROUP BY 1),
j AS (SELECT r.p_partkey, r.p_brand, m.description, regexp_split_to_array(m.description, '{SPLIT_RE}') AS a
      FROM part r LEFT JOIN m ON r.p_name = m.name)
SELECT p_partkey, description, trim(a[4], {WS}) AS channel,
       CASE WHEN lower(p_brand) = 'no filter' THEN 'ALL LoB' ELSE upper(trim(a[3], {WS})) END AS lob,
       trim(a[5], {WS}) AS product,
       CASE WHEN coalesce(a[7], '') = '' THEN 'Stand Alone' ELSE trim(a[7], {WS}) END AS category,
       trim(a[6], {WS}) AS metric_name
FROM j
"""

CALENDAR = """
SELECT DISTINCT 'M' AS timelvl, 'Month' AS timelvlnm, printf('%d%02d', year(o_orderdate), month(o_orderdate)) AS timeid,
       strftime(o_orderdate, '%b %Y') AS timeidnm FROM orders
UNION ALL
SELECT DISTINCT 'Q', 'Quarter', printf('%d%d', year(o_orderdate), quarter(o_orderdate)),
       printf('Q%d %d', quarter(o_orderdate), year(o_orderdate)) FROM orders
"""

TIME_JOIN = f"""
WITH um AS ({UNPIVOT_MONTH}),
cal AS (SELECT * FROM ({CALENDAR}) WHERE timelvlnm = 'Month' AND right(timeid, 2) <> '12')
SELECT um.o_orderpriority, um.report_year, um.kind, um.timeid, um.metric_value, cal.timelvl, cal.timeidnm, cal.timelvlnm
FROM um JOIN cal ON um.timeid = cal.timeid
"""

FINAL_LAYOUT = f"""
WITH b AS (SELECT c_mktsegment, o_orderpriority, year(o_orderdate) AS y, month(o_orderdate) AS mo
           FROM orders JOIN customer ON o_custkey = c_custkey),
cnt AS (SELECT c_mktsegment, o_orderpriority, y, mo, count(*) AS n FROM b GROUP BY ALL),
yrs AS (SELECT DISTINCT c_mktsegment, o_orderpriority, y FROM b),
grid AS (SELECT k.*, unnest(range(1, 13)) AS slot
         FROM (SELECT yrs.*, unnest(['month_last', 'month_this']) AS kind FROM yrs) k),
lng AS (SELECT g.c_mktsegment, g.o_orderpriority,
               printf('%d%02d', CASE WHEN g.kind = 'month_last' THEN g.y - 1 ELSE g.y END, g.slot) AS timeid,
               coalesce(CAST(CAST(c.n AS DOUBLE) AS VARCHAR), 'nan') AS metric_value
        FROM grid g LEFT JOIN cnt c ON c.c_mktsegment = g.c_mktsegment AND c.o_orderpriority = g.o_orderpriority
          AND c.y = CASE WHEN g.kind = 'month_last' THEN g.y - 1 ELSE g.y END AND c.mo = g.slot),
cal AS (SELECT * FROM ({CALENDAR}) WHERE timelvlnm = 'Month')
SELECT cal.timelvl, cal.timelvlnm, l.timeid, cal.timeidnm, 'rs-all' AS rpt_suite_id, 'All Suites' AS rpt_suite_nm,
       'web' AS channel, upper(lower(l.c_mktsegment)) AS lob, l.o_orderpriority AS product,
       'Site Activity' AS category_type, 'Stand Alone' AS category, '' AS sgm_cd, '' AS sgm_desc, '' AS seg_cd,
       '' AS seg_desc, 'Orders' AS metric_name, l.metric_value, '' AS metric_format, '' AS page_url,
       '' AS data_src, '{RUN_TS}' AS create_ts, '{RUN_TS}' AS update_ts, '0' AS metric_id
FROM lng l JOIN cal ON l.timeid = cal.timeid
"""

SECTION_CARVE = """
WITH e AS (SELECT user_id, event_id, event_type,
                  CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS BIGINT) AS pos
           FROM events),
h AS (SELECT user_id, max(pos) + 2 AS start FROM e WHERE event_type = 'purchase' GROUP BY 1),
f AS (SELECT h.user_id, h.start, min(e.pos) AS fin FROM h
      LEFT JOIN e ON e.user_id = h.user_id AND e.event_type = 'signup' AND e.pos >= h.start GROUP BY 1, 2)
SELECT e.user_id, e.pos, e.event_id FROM e JOIN f ON e.user_id = f.user_id
WHERE e.event_type IN ('view', 'click') AND e.pos >= f.start AND (f.fin IS NULL OR e.pos < f.fin)
"""

HEADER_CLASSIFY = """
WITH e AS (SELECT event_id, '# ' || upper(event_type) || ' '
                  || CASE WHEN event_type = 'error' THEN 'metrics' ELSE 'Metrics' END
                  || CASE WHEN value < 10 THEN ' by month - this year' WHEN value < 20 THEN ' by month - last year'
                          WHEN value < 30 THEN ' by quarter' WHEN value < 40 THEN ' by week' ELSE '' END AS header
           FROM events),
c AS (SELECT *, contains(header, '#') AND contains(header, 'Metrics') AS cand FROM e)
SELECT event_id, header,
       CASE WHEN cand AND NOT contains(header, 'by') THEN 'summary'
            WHEN cand AND contains(header, 'month - this') THEN 'month_this'
            WHEN cand AND contains(header, 'month - last') THEN 'month_last' END AS kind_month,
       CASE WHEN cand AND NOT contains(header, 'by') THEN 'summary'
            WHEN cand AND contains(header, 'quarter') THEN 'quarter' END AS kind_quarter
FROM c
"""

PREAMBLE = """
WITH y AS (SELECT o_custkey, max(year(o_orderdate)) AS y1 FROM orders GROUP BY 1),
c AS (SELECT c_custkey, c_name || CASE WHEN c_acctbal < 0 THEN ', ' || c_mktsegment ELSE '' END AS rs_name,
             CASE WHEN c_mktsegment = 'HOUSEHOLD' OR y.y1 IS NULL THEN NULL ELSE y.y1 END AS year
      FROM customer LEFT JOIN y ON c_custkey = y.o_custkey)
SELECT c_custkey, rs_name, CASE WHEN contains(rs_name, ',') THEN split_part(rs_name, ',', 1) ELSE 'no filter' END AS lob_filter,
       CAST(year AS INTEGER) AS year
FROM c
"""

VALUE_PARSE = f"""
WITH e AS (SELECT event_id, CASE WHEN event_type = 'error' THEN 'N/A' WHEN event_type = 'signup' THEN ''
                   WHEN event_type = 'click' THEN CAST(value AS VARCHAR) || '%'
                   WHEN event_type = 'purchase' THEN ' ' || CAST(value AS VARCHAR) || ' '
                   ELSE CAST(value AS VARCHAR) END AS raw FROM events)
SELECT event_id, raw,
       (raw IS NULL OR raw IN ({_NA_LIST}) OR regexp_full_match(trim(raw), '{FLOAT_RE}')
        OR regexp_full_match(trim(raw), '{SPECIAL_RE}')) AS value_ok,
       {_value_text('raw')} AS metric_value
FROM e
"""


def _merge_side(drop_status: str, name: str, ts: str, marker: str, null_low: bool) -> str:
    mid = "CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END" if null_low else "o_orderpriority"
    return f"""SELECT printf('%d%02d', year(o_orderdate), month(o_orderdate)) AS timeid, {mid} AS metric_id,
                  upper(c_mktsegment) AS lob, '{name}' AS metric_name,
                  CAST(CAST(count(*) AS DOUBLE) AS VARCHAR) AS metric_value,
                  '{ts}' AS create_ts, '{ts}' AS update_ts, true AS {marker}
           FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus <> '{drop_status}'
           GROUP BY 1, 2, 3"""


def _upsert(null_low: bool) -> str:
    t = _merge_side("P", "orders", OLD_TS, "tm", null_low)
    s = _merge_side("F", "orders_v2", RUN_TS, "sm", null_low)
    chg = "(s.sm AND t.metric_value <> s.metric_value)"
    return f"""
WITH t AS ({t}), s AS ({s})
SELECT CASE WHEN t.tm IS NULL THEN s.timeid ELSE t.timeid END AS timeid,
       CASE WHEN t.tm IS NULL THEN s.metric_id ELSE t.metric_id END AS metric_id,
       CASE WHEN t.tm IS NULL THEN s.lob ELSE t.lob END AS lob,
       CASE WHEN t.tm IS NULL THEN s.metric_name WHEN {chg} THEN s.metric_name ELSE t.metric_name END AS metric_name,
       CASE WHEN t.tm IS NULL THEN s.metric_value WHEN {chg} THEN s.metric_value ELSE t.metric_value END AS metric_value,
       CASE WHEN t.tm IS NULL THEN s.create_ts ELSE t.create_ts END AS create_ts,
       CASE WHEN t.tm IS NULL THEN s.update_ts WHEN {chg} THEN '{RUN_TS}' ELSE t.update_ts END AS update_ts
FROM t FULL OUTER JOIN s ON t.timeid = s.timeid AND t.metric_id = s.metric_id AND t.lob = s.lob
"""


MERGE_KEY_DUPS = """
WITH src AS (SELECT printf('%d%02d', year(o_orderdate), month(o_orderdate)) AS timeid, o_orderpriority,
                    upper(c_mktsegment) AS lob, count(*) AS n
             FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL),
k AS (SELECT timeid, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN o_orderpriority ELSE '0' END AS metric_id,
             lob FROM src)
SELECT timeid, metric_id, lob, count(*) AS n_rows FROM k
WHERE timeid IS NOT NULL AND metric_id IS NOT NULL AND lob IS NOT NULL
GROUP BY ALL HAVING count(*) > 1
"""

COLUMN_COMMENTS = """
SELECT p_type AS "column", arg_min(p_name, p_partkey) AS comment FROM part WHERE p_type IS NOT NULL GROUP BY 1
"""

# Expected rows of the report load, computed from the tables without any
# report text: per customer and report year (each order year and the next), one
# metric per (priority, status), counts per period, suites / ids / calendar joined.
_REPORT_BASE = """
b AS (SELECT c_custkey, c_acctbal, c_mktsegment, c_nationkey, o_orderpriority AS prio, o_orderstatus AS st,
             year(o_orderdate) AS y, month(o_orderdate) AS mo, quarter(o_orderdate) AS q
      FROM orders JOIN customer ON o_custkey = c_custkey),
bb AS (SELECT b.*, y + k AS ry FROM b, (VALUES (0), (1)) t(k)),
combos AS (SELECT DISTINCT c_custkey, ry, prio, st, lower(c_mktsegment) AS seg, c_acctbal, c_mktsegment, c_nationkey
           FROM bb),
nr AS (SELECT n_nationkey, n_name FROM nation JOIN region ON n_regionkey = r_regionkey{nr}),
rep AS (SELECT DISTINCT c.c_custkey, c.ry, c.c_acctbal, c.c_mktsegment, n.n_name, n.n_nationkey,
               n.n_name || CASE WHEN c.c_acctbal < 0 THEN ', ' || c.c_mktsegment ELSE '' END AS rs_name
        FROM combos c JOIN nation n ON c.c_nationkey = n.n_nationkey),
ok AS (SELECT rep.*, CASE WHEN rep.c_acctbal < 0
                     THEN 'rs' || rep.n_nationkey || '-' || lower(substr(rep.c_mktsegment, 1, 3))
                     ELSE 'rs' || rep.n_nationkey END AS rsid
       FROM rep WHERE rep.n_nationkey IN (SELECT n_nationkey FROM nr)),
mm AS (SELECT DISTINCT lower(c_mktsegment) AS seg, o_orderpriority AS prio, o_orderstatus AS st
       FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus <> 'P'),
ids AS (SELECT seg, prio, st, CASE WHEN st = 'F' THEN 'u' ELSE '' END || 'm' || substr(prio, 1, 1) || st || '-'
               || substr(seg, 1, 3) AS metric_id FROM mm),
lines AS (SELECT c.c_custkey, c.ry, c.prio, c.st, c.seg, c.c_mktsegment, ok.rs_name, ok.rsid,
                 CASE WHEN c.c_acctbal < 0 THEN upper(c.seg) ELSE 'ALL LoB' END AS lob,
                 CASE c.st WHEN 'F' THEN 'Filled' WHEN 'O' THEN 'Open' ELSE 'Stand Alone' END AS category,
                 coalesce(ids.metric_id, '0') AS metric_id
          FROM combos c JOIN ok USING (c_custkey, ry, c_mktsegment)
          LEFT JOIN ids ON ids.seg = c.seg AND ids.prio = c.prio AND ids.st = c.st)
"""


def _report_rows(level: str, gaps: bool = False) -> str:
    if level == "Month":
        grid = """grid0 AS (SELECT k.*, unnest(range(1, 13)) AS slot
                           FROM (SELECT l.*, unnest(['month_last', 'month_this']) AS kind FROM lines l) k),
        grid AS (SELECT g.*, CASE WHEN g.kind = 'month_last' THEN g.ry - 1 ELSE g.ry END AS yy FROM grid0 g),
        cnt AS (SELECT c_custkey, c_mktsegment, prio, st, y, mo AS per, count(*) AS n FROM b GROUP BY ALL),
        per AS (SELECT g.*, printf('%d%02d', g.yy, g.slot) AS timeid, g.slot AS pp FROM grid g)"""
    else:
        grid = """grid0 AS (SELECT l.*, unnest(range(1, 9)) AS slot FROM lines l),
        grid AS (SELECT g.*, CASE WHEN g.slot <= 4 THEN g.ry - 1 ELSE g.ry END AS yy FROM grid0 g),
        cnt AS (SELECT c_custkey, c_mktsegment, prio, st, y, q AS per, count(*) AS n FROM b GROUP BY ALL),
        per AS (SELECT g.*, printf('%d%d', g.yy, CASE WHEN g.slot <= 4 THEN g.slot ELSE g.slot - 4 END) AS timeid,
                       CASE WHEN g.slot <= 4 THEN g.slot ELSE g.slot - 4 END AS pp FROM grid g)"""
    return f"""
WITH {_REPORT_BASE.replace("{nr}", " WHERE r_name <> 'MIDDLE EAST'" if gaps else "")},
{grid},
vals AS (SELECT p.*, coalesce(CAST(CAST(c.n AS DOUBLE) AS VARCHAR), 'nan') AS metric_value FROM per p
         LEFT JOIN cnt c ON c.c_custkey = p.c_custkey AND c.c_mktsegment = p.c_mktsegment AND c.prio = p.prio AND c.st = p.st AND c.y = p.yy
         AND c.per = p.pp),
cal AS (SELECT * FROM ({CALENDAR}) WHERE timelvlnm = '{level}'{" AND right(timeid, 2) <> '12'" if gaps else ""})"""


def _report_load(level: str) -> str:
    return _report_rows(level) + f"""
SELECT cal.timelvl, cal.timelvlnm, v.timeid, cal.timeidnm, v.rsid AS rpt_suite_id, v.rs_name AS rpt_suite_nm,
       'web' AS channel, v.lob, v.prio AS product, 'Site Activity' AS category_type, v.category,
       '' AS sgm_cd, '' AS sgm_desc, '' AS seg_cd, '' AS seg_desc, 'Orders' AS metric_name, v.metric_value,
       '' AS metric_format, '' AS page_url, '' AS data_src, '{RUN_TS}' AS create_ts, '{RUN_TS}' AS update_ts,
       v.metric_id
FROM vals v JOIN cal ON v.timeid = cal.timeid
"""


# Same rows, the metric named as its cell spells it; no such label is mapped.
LOAD_QUOTES = _report_load("Month").replace(
    "'Orders' AS metric_name", "CASE v.st WHEN 'F' THEN 'Or' || chr(10) || 'ders \"all\"' WHEN 'O' THEN 'Ord\"ers' "
    "ELSE 'Orders, net' END AS metric_name").replace("v.metric_id\nFROM", "'0' AS metric_id\nFROM")

# Open orders have ids of their own, pending ones no name in the mapping.
LOAD_DESCRIPTION = _report_load("Month").replace(
    "v.metric_id\nFROM", "CASE WHEN v.st = 'O' THEN 'd' || v.metric_id ELSE v.metric_id END AS metric_id\nFROM"
) + "WHERE v.st <> 'P'\n"

# A report is one suite's, per 10,000 customers and year; nations 1, 2, 3 and 5
# have no date, a misspelt header, an open quote, blank lines only.
LOAD_REJECT_REASONS = _report_rows("Month", gaps=True) + """,
named AS (SELECT c_custkey, ry, n_nationkey AS nat, n_nationkey || '-' || CASE WHEN c_acctbal < 0 THEN lower(c_mktsegment) ELSE 'all' END
                 || '-' || c_custkey // 10000 || '-' || ry AS report_id FROM rep),
refused AS (SELECT DISTINCT report_id, nat, CASE nat WHEN 3 THEN 'unbalanced_quote' WHEN 5 THEN 'empty_report' WHEN 1 THEN 'no_year'
              ELSE CASE WHEN nat NOT IN (SELECT n_nationkey FROM nr) THEN 'suite_unknown' WHEN nat = 2 THEN 'section_missing' END END AS reason
            FROM named),
tagged AS (SELECT n.report_id, v.timeid, CASE WHEN v.st = 'P' THEN 'label_parts'
             WHEN v.prio = '5-LOW' AND v.kind = 'month_this' AND v.slot = 1 AND v.metric_value <> 'nan' THEN 'value_not_numeric'
             WHEN NOT EXISTS (SELECT 1 FROM cal WHERE cal.timeid = v.timeid) THEN 'timeid_not_in_calendar' END AS reason
           FROM vals v JOIN named n USING (c_custkey, ry) JOIN refused r ON r.report_id = n.report_id AND r.reason IS NULL)
SELECT report_id, timeid, reason, count(*) AS n FROM tagged WHERE reason IS NOT NULL GROUP BY ALL
UNION ALL
SELECT report_id, '', reason, 1 FROM refused WHERE reason IS NOT NULL
"""

LOAD_AUDIT = _report_rows("Month", gaps=True) + """,
tagged AS (SELECT v.timeid, EXISTS (SELECT 1 FROM cal WHERE cal.timeid = v.timeid) AS in_cal FROM vals v)
SELECT CASE WHEN in_cal THEN 'accepted' ELSE 'timeid_not_in_calendar' END AS outcome, count(*) AS n
FROM tagged GROUP BY 1
UNION ALL
SELECT 'report:suite_unknown' AS outcome, count(*) AS n FROM rep
WHERE rep.n_nationkey NOT IN (SELECT n_nationkey FROM nr) HAVING count(*) > 0
"""

LOAD_REJECTS = _report_rows("Month", gaps=True) + """
SELECT c_custkey || '-' || ry AS report_id, timeid, 'timeid_not_in_calendar' AS reason, count(*) AS n
FROM vals v WHERE NOT EXISTS (SELECT 1 FROM cal WHERE cal.timeid = v.timeid) GROUP BY ALL
UNION ALL
SELECT c_custkey || '-' || ry, '', 'suite_unknown', 1 FROM rep WHERE n_nationkey NOT IN (SELECT n_nationkey FROM nr)
"""

UPSERT_PATH = f"""
WITH r AS (SELECT * EXCLUDE (metric_value, rpt_suite_id, metric_id), max(metric_value) AS metric_value,
                  lob AS rpt_suite_id, product AS metric_id FROM ({FINAL_LAYOUT}) GROUP BY ALL)
SELECT * REPLACE (CASE WHEN right(timeid, 2) <= '06' THEN create_ts ELSE 'second' END AS create_ts,
                  CASE WHEN right(timeid, 2) <= '06' AND metric_value <> '0.0' THEN 'second' ELSE update_ts END AS update_ts)
FROM r
"""

# One row per period, suite, line of business and metric (its id, or its label
# where it has none): the latest report year's, then this year's section, then
# the report that is last by name and its lower line.
REPORT_LOAD_TWICE = _report_rows("Month") + f""",
seen AS (SELECT v.*, row_number() OVER (PARTITION BY v.c_custkey, v.ry, v.kind, v.slot ORDER BY v.c_mktsegment, v.prio, v.st) AS line
         FROM vals v),
best AS (SELECT * FROM seen QUALIFY row_number() OVER (
           PARTITION BY timeid, rsid, lob, CASE WHEN metric_id <> '0' THEN 'id|' || metric_id
                                               ELSE 'label|web|' || lower(prio) || '|' || lower(category) || '|orders' END
           ORDER BY ry DESC, kind = 'month_this' DESC, c_custkey || '-' || ry DESC, line DESC) = 1)
SELECT cal.timelvl, cal.timelvlnm, v.timeid, cal.timeidnm, v.rsid AS rpt_suite_id, v.rs_name AS rpt_suite_nm,
       'web' AS channel, v.lob, v.prio AS product, 'Site Activity' AS category_type, v.category,
       '' AS sgm_cd, '' AS sgm_desc, '' AS seg_cd, '' AS seg_desc, 'Orders' AS metric_name, v.metric_value,
       '' AS metric_format, '' AS page_url, '' AS data_src, '{RUN_TS}' AS create_ts, '{RUN_TS}' AS update_ts,
       v.metric_id
FROM best v JOIN cal ON v.timeid = cal.timeid
"""

UPSERT_ADDED_COLUMNS = f"""
WITH r AS (SELECT timeid, lob, product AS metric_id, metric_name, count(*) AS n FROM ({FINAL_LAYOUT}) GROUP BY ALL)
SELECT timeid, lob, metric_id, metric_name, n::VARCHAR AS metric_value,
       CASE WHEN right(timeid, 2) <= '06' THEN '{RUN_TS}' ELSE 'second' END AS create_ts,
       CASE WHEN right(timeid, 2) <= '06' THEN 'second' ELSE '{RUN_TS}' END AS update_ts,
       CASE WHEN right(timeid, 2) <= '06' THEN 'note ' || metric_id END AS region_note,
       CASE WHEN right(timeid, 2) <= '06' THEN NULL ELSE n % 7 END AS orders_rank
FROM r
"""

# The this-year month table of each report, computed from the orders: one
# row per (report, priority, status) of its two years; months
# without orders are empty cells (NULL).
SECTION_WIDE_MONTH = """
WITH b AS (SELECT c_custkey, c_mktsegment, o_orderpriority AS prio, o_orderstatus AS st,
                  year(o_orderdate) AS y, month(o_orderdate) AS mo
           FROM orders JOIN customer ON o_custkey = c_custkey),
bb AS (SELECT b.*, y + k AS ry FROM b, (VALUES (0), (1)) t(k))
SELECT bb.c_custkey || '-' || bb.ry AS report_id,
       '[T|' || lower(bb.c_mktsegment) || '|web|' || bb.prio || '|Orders|'
         || CASE bb.st WHEN 'F' THEN 'Filled' WHEN 'O' THEN 'Open' ELSE '' END || ']' AS metrix,
       CAST(NULLIF(count(*) FILTER (WHERE bb.y = bb.ry AND bb.mo = 1), 0) AS VARCHAR) AS all_visits_this_year_january,
       CAST(NULLIF(count(*) FILTER (WHERE bb.y = bb.ry AND bb.mo = 2), 0) AS VARCHAR) AS all_visits_this_year_february,
       CAST(NULLIF(count(*) FILTER (WHERE bb.y = bb.ry AND bb.mo = 3), 0) AS VARCHAR) AS all_visits_this_year_march,
       CAST(NULLIF(count(*) FILTER (WHERE bb.y = bb.ry AND bb.mo = 4), 0) AS VARCHAR) AS all_visits_this_year_april,
       CAST(NULLIF(count(*) FILTER (WHERE bb.y = bb.ry AND bb.mo = 5), 0) AS VARCHAR) AS all_visits_this_year_may,
       CAST(NULLIF(count(*) FILTER (WHERE bb.y = bb.ry AND bb.mo = 6), 0) AS VARCHAR) AS all_visits_this_year_june,
       CAST(NULLIF(count(*) FILTER (WHERE bb.y = bb.ry AND bb.mo = 7), 0) AS VARCHAR) AS all_visits_this_year_july,
       CAST(NULLIF(count(*) FILTER (WHERE bb.y = bb.ry AND bb.mo = 8), 0) AS VARCHAR) AS all_visits_this_year_august,
       CAST(NULLIF(count(*) FILTER (WHERE bb.y = bb.ry AND bb.mo = 9), 0) AS VARCHAR) AS all_visits_this_year_september,
       CAST(NULLIF(count(*) FILTER (WHERE bb.y = bb.ry AND bb.mo = 10), 0) AS VARCHAR) AS all_visits_this_year_october,
       CAST(NULLIF(count(*) FILTER (WHERE bb.y = bb.ry AND bb.mo = 11), 0) AS VARCHAR) AS all_visits_this_year_november,
       CAST(NULLIF(count(*) FILTER (WHERE bb.y = bb.ry AND bb.mo = 12), 0) AS VARCHAR) AS all_visits_this_year_december
FROM bb GROUP BY bb.c_custkey, bb.ry, bb.c_mktsegment, bb.prio, bb.st
"""

FINAL_NAMES = """timelvl timelvlnm timeid timeidnm rpt_suite_id rpt_suite_nm channel lob product category_type category
sgm_cd sgm_desc seg_cd seg_desc metric_name metric_value metric_format page_url data_src create_ts update_ts metric_id""".split()

PUBLISH_COMMENTS = f"WITH t AS MATERIALIZED ({FINAL_LAYOUT})\n" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS col_name, 'string' AS data_type, 'it''s ' || count(DISTINCT {c}) || ' distinct values' AS comment FROM t"
    for c in FINAL_NAMES)

ADD_COLUMNS = f"""
SELECT unnest({FINAL_NAMES!r}) AS col_name, 'string' AS data_type, '' AS comment
UNION ALL
SELECT 'region_' || lower(replace(r_name, ' ', '_')), 'string', 'orders in ' || r_name FROM region
"""


ORACLES = {
    "unpivot_month": UNPIVOT_MONTH,
    "unpivot_quarter": UNPIVOT_QUARTER,
    "unpivot_summary": UNPIVOT_SUMMARY,
    "label_split": LABEL_SPLIT,
    "label_split_pipe": LABEL_SPLIT_PIPE,
    "metric_lookup": METRIC_LOOKUP,
    "suite_lookup": SUITE_LOOKUP,
    "description_lookup": DESCRIPTION_LOOKUP,
    "time_join": TIME_JOIN,
    "final_layout": FINAL_LAYOUT,
    "section_carve": SECTION_CARVE,
    "header_classify": HEADER_CLASSIFY,
    "preamble": PREAMBLE,
    "value_parse": VALUE_PARSE,
    "upsert": _upsert(False),
    "upsert_null_key": _upsert(True),
    "merge_key_dups": MERGE_KEY_DUPS,
    "column_comments": COLUMN_COMMENTS,
    "report_load": _report_load("Month"),
    "report_load_quarter": _report_load("Quarter"),
    "report_load_files": _report_load("Month"),
    "load_quotes": LOAD_QUOTES,
    "report_load_description": LOAD_DESCRIPTION,
    "load_reject_reasons": LOAD_REJECT_REASONS,
    "section_wide_month": SECTION_WIDE_MONTH,
    "load_audit": LOAD_AUDIT,
    "load_rejects": LOAD_REJECTS,
    "upsert_path": UPSERT_PATH,
    "report_load_twice": REPORT_LOAD_TWICE,
    "upsert_added_columns": UPSERT_ADDED_COLUMNS,
    "write_append": f"SELECT * FROM ({FINAL_LAYOUT}) UNION ALL SELECT * FROM ({FINAL_LAYOUT})",
    "write_overwrite": FINAL_LAYOUT,
    "register_table": FINAL_LAYOUT,
    "publish_comments": PUBLISH_COMMENTS,
    "add_columns": ADD_COLUMNS,
}
