"""DuckDB SQL for the registered queries, written from the report definitions.

The SQL uses one window per visitor and plain grouping, not the slot-wise plan of the
library, so that the two sides are independent.
"""

from __future__ import annotations

from checks.logs import DT, LOGS, OTHER_DT, SITE, STATE_CUT_MS, duckdb_logs, line_expression
from touchpath import config as c
from touchpath.config import FIELD_SEPARATOR
from touchpath.plans.misc import GROUP_SEPARATOR

ORACLE_SQL: dict[str, str] = {}

SITES = f"(?:{SITE}|e{SITE})"
INTERNAL = rf"(?:http|https)://.*\.{SITES}"
# DuckDB's regular expressions have no lookahead: spelled out "not m, mzt, zt, data"
LANDING = (
    r"https?://(|[^mzd\n].*|z([^t\n].*)?|d([^a\n].*|a([^t\n].*|t([^a\n].*)?)?)?)\." + SITES
)


QUESTION = "'?'"  # label of unknown codes


def quoted(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def case(column: str, table: dict[str, str], default: str) -> str:
    rows = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in table.items())
    return f"CASE {column} {rows} ELSE {default} END"


PROMO = r"\d{10}90{5}"
SEARCH = r"[1-6]80{5}"


def host_sql(url: str) -> str:
    return (
        f"CASE WHEN contains({url}, ' ') THEN NULL "
        f"ELSE nullif(regexp_extract({url}, '^https?://([^/?#]*)', 1), '') END"
    )


def refchan_sql(host: str) -> str:
    rows = " ".join(
        f"WHEN contains({host}, '{domain}') THEN '{code}'" for domain, code in c.REFERRER_DOMAINS
    )
    return f"CASE {rows} END"


def group_sql(code: str) -> str:
    return (
        f"CASE WHEN {code} = '{c.DIRECT}' THEN '{c.ALL_DIRECT}' "
        f"WHEN {code} = '{c.OTHER}' OR {code} IN ({quoted(c.PORTAL_CODES)}) THEN '{c.ALL_OTHER}' "
        f"WHEN {code} IN ({quoted(c.SEARCH_CODES)}) THEN '{c.ALL_SEARCH}' "
        f"WHEN regexp_full_match({code}, '{PROMO}') THEN '{c.ALL_PROMO}' END"
    )


def levels_sql(code: str) -> str:
    return (
        f"CASE WHEN regexp_full_match({code}, '{PROMO}') "
        f"THEN [{code}[1:3], {code}[1:6], {code}[1:10]] ELSE [{code}] END"
    )


def otrack_sql(otrack: str) -> str:
    body = f"split_part({otrack}, '-', 1)"
    return (
        f"CASE WHEN lower({otrack}) IN ('', 'null') THEN NULL "
        rf"WHEN NOT regexp_full_match({otrack}, '\d+-\d+-\d+-\d+\.[0-3]') THEN '{c.OTHER}' "
        f"WHEN {body} = '0' THEN '{c.DIRECT}' "
        f"WHEN regexp_full_match({body}, '{PROMO}') OR regexp_full_match({body}, '{SEARCH}') "
        f"OR {body} IN ('{c.DIRECT}', '{c.OTHER}') THEN {body} ELSE '{c.OTHER}' END"
    )


SUMMARY = quoted((*c.GROUPS, c.ALL))


def type_sql(code: str) -> str:
    return (
        f"CASE WHEN {code} IN ({SUMMARY}) THEN 5 WHEN {code} = '{c.DIRECT}' THEN 1 "
        f"WHEN {code} = '{c.OTHER}' THEN 2 "
        f"WHEN regexp_full_match({code}, '\\d{{3}}|\\d{{6}}|\\d{{10}}') THEN 4 "
        f"WHEN {code} IN ({quoted(c.SEARCH_CODES)}) THEN 3 "
        f"WHEN {code} IN ({quoted(c.PORTAL_CODES)}) THEN 2 ELSE -1 END"
    )


def parent_sql(code: str, top: str) -> str:
    return (
        f"CASE WHEN {type_sql(code)} = -1 THEN '-1' WHEN {type_sql(code)} <> 4 THEN {top} "
        f"WHEN length({code}) = 6 THEN {code}[1:3] WHEN length({code}) = 10 THEN {code}[1:6] "
        f"ELSE {top} END"
    )


def level_sql(code: str) -> str:
    return (
        f"CASE WHEN {type_sql(code)} = -1 THEN '-1' WHEN {type_sql(code)} <> 4 THEN '1' "
        f"WHEN length({code}) = 3 THEN '1' WHEN length({code}) = 6 THEN '2' ELSE '3' END"
    )


def dims_sql(code: str, top: str = "CAST(NULL AS VARCHAR)", text_type: bool = False) -> str:
    kind = f"CAST({type_sql(code)} AS {'VARCHAR' if text_type else 'INTEGER'})"
    return (
        f"{kind} AS channel_type, {parent_sql(code, top)} AS channel_parent, "
        f"{level_sql(code)} AS channel_level"
    )


DATE = f"DATE '{DT}' AS dt"
FIXED_CODES = f"(SELECT unnest([{SUMMARY}]) AS channel)"


def long(expression: str, name: str) -> str:
    return f"CAST({expression} AS BIGINT) AS {name}"


def add(name: str, sql: str, *logs: str) -> None:
    ORACLE_SQL[name] = f"WITH {duckdb_logs(*logs)}{sql}" if logs else sql


# --- scans -------------------------------------------------------------------

# only the white space that occurs in the derived lines
TRIM = "regexp_replace({0}, '^[\\s　]+|[\\s　]+$', '', 'g')"


def lines_sql(name: str) -> str:
    return (
        f",\nlines AS (SELECT event_id, {line_expression(name)} AS value FROM {name}),\n"
        f"split AS (SELECT event_id, string_split(value, '{FIELD_SEPARATOR}') AS f FROM lines)\n"
    )


def scan_sql(name: str) -> str:
    layout = LOGS[name][1]
    fields = ", ".join(
        f"{TRIM.format(f'f[{i + 1}]')} AS {column}" for column, i in layout.positions.items()
    )
    return f"{lines_sql(name)}SELECT event_id, {fields} FROM split WHERE len(f) = {layout.arity}"


for _log in LOGS:
    add(f"scan_{_log}", scan_sql(_log), _log)
add(
    "scan_delimited",
    lines_sql("pv_log")
    + f"SELECT {long('len(f)', 'n_fields')}, "
    + f"array_to_string(list_transform(f, lambda x: {TRIM.format('x')}), '|') AS joined FROM split",
    "pv_log",
)

# --- page views: filters and expressions -------------------------------------

COMPLETE = "event_id % 89 <> 0"
VISITOR_BAD = "(guid IN ('', 'null') OR ts IN ('', 'null') OR NOT starts_with(guid, '0x'))"
BAD_HTAG = r"(htag NOT IN ('', 'null') AND NOT regexp_full_match(htag, '[0-3]\.\d{6,}'))"
IS_LANDING = f"regexp_matches(desturl, '{LANDING}')"


def pv_valid_sql(keep: str, product: str, complete: str = "TRUE") -> str:
    return (
        f"SELECT {keep} FROM pv_log WHERE {complete} AND NOT {VISITOR_BAD} AND {product} "
        f"AND {IS_LANDING} AND TRY_CAST(ts AS BIGINT) IS NOT NULL"
    )


PC_PRODUCT, H5_PRODUCT = "proid <> '5001'", "proid = '5002'"
PV_COLUMNS = "event_id, guid, CAST(ts AS BIGINT) AS ts, srcurl, htag, desturl, pageid, proid"


def rejects_sql(log: str, tests: list[tuple[str, str]], extra: str = "") -> str:
    rows = " ".join(f"WHEN {test} THEN '{reason}'" for test, reason in tests)
    return (
        f",\nr AS (SELECT *, CASE WHEN NOT ({COMPLETE}) THEN 'NO_COMPLETE' {rows} "
        f"ELSE 'ACCEPTED' END AS reason FROM {log})\n"
        f"SELECT reason, count(*) AS n{extra} FROM r GROUP BY reason"
    )


KEPT_BAD = f", count(*) FILTER (WHERE reason = 'ACCEPTED' AND {BAD_HTAG}) AS bad_htag"

add("pv_valid", "\n" + pv_valid_sql(PV_COLUMNS, PC_PRODUCT, COMPLETE), "pv_log")
add("h5_pv_valid", "\n" + pv_valid_sql(PV_COLUMNS, H5_PRODUCT, COMPLETE), "pv_log")
add("pv_rejects", rejects_sql("pv_log", [
    (VISITOR_BAD, "INVALID_DATA"), (f"NOT ({PC_PRODUCT})", "EXCLUDED_PRODUCT"),
    (f"NOT {IS_LANDING}", "INVALID_URL"),
], KEPT_BAD), "pv_log")
add("h5_rejects", rejects_sql("pv_log", [
    (VISITOR_BAD, "INVALID_DATA"), (f"NOT ({H5_PRODUCT})", "OTHER_PRODUCT"),
    (f"NOT {IS_LANDING}", "INVALID_URL"),
], KEPT_BAD), "pv_log")
add("landing_filter", f"\nSELECT event_id, desturl, {IS_LANDING} AS is_landing FROM pv_log", "pv_log")
add(
    "isempty_variants",
    "\nSELECT event_id, guid, guid IN ('', 'null') AS blank_exact, "
    "lower(guid) IN ('', 'null') AS blank_any_case FROM trade_log",
    "trade_log",
)
add(
    "referrer_channel",
    f"\nSELECT event_id, {refchan_sql('h')} AS channel FROM "
    f"(SELECT event_id, {host_sql('srcurl')} AS h FROM pv_log)",
    "pv_log",
)
add(
    "referrer_class",
    f"\nSELECT event_id, regexp_matches(srcurl, '{INTERNAL}') AS internal, "
    "NOT contains(srcurl, ' ') AS uri_ok, "
    f"CASE WHEN code IN ({quoted(c.SEARCH_CODES)}) THEN 'search' "
    f"WHEN code IN ({quoted(c.PORTAL_CODES)}) THEN 'portal' ELSE 'none' END AS class FROM "
    f"(SELECT *, {refchan_sql('h')} AS code FROM (SELECT *, {host_sql('srcurl')} AS h FROM pv_log))",
    "pv_log",
)
HTAG_VALID = r"regexp_full_match(htag, '[0-3]\.\d{6,}')"
add(
    "htag_parts",
    f"\nSELECT event_id, htag, {HTAG_VALID} AS valid, "
    f"CASE WHEN {HTAG_VALID} THEN split_part(htag, '.', 1) END AS level, "
    f"CASE WHEN {HTAG_VALID} THEN split_part(htag, '.', 2) END AS body FROM pv_log",
    "pv_log",
)
add(
    "promo_levels",
    f"\nSELECT event_id, unnest({levels_sql('tag')}) AS code FROM "
    f"(SELECT event_id, split_part(htag, '.', 2) AS tag FROM pv_log WHERE {HTAG_VALID}) "
    f"WHERE regexp_full_match(tag, '{PROMO}')",
    "pv_log",
)
NEWS_PARTS = (
    "CAST(left({0}, length({0}) - 13) AS DECIMAL(38,0)) AS zid, "
    "right({0}, 13)[1:3] AS newstype, right({0}, 13)[4:7] AS subtype, "
    "right({0}, 13)[8:12] AS author_id"
)
IS_NEWS_PAGE = r"regexp_full_match(pageid, '\d{13,}3')"
add(
    "news_pageid_parts",
    f"\nSELECT event_id, pageid, {NEWS_PARTS.format('pageid')} FROM pv_log WHERE {IS_NEWS_PAGE}",
    "pv_log",
)

# --- PC report ---------------------------------------------------------------

PC_ROWS = f""",
v AS ({pv_valid_sql(PV_COLUMNS, PC_PRODUCT)}),
t AS (SELECT *, htag NOT IN ('', 'null') AS has_htag,
  htag NOT IN ('', 'null') AND {HTAG_VALID} AS ok,
  htag NOT IN ('', 'null') AND {HTAG_VALID} AND split_part(htag, '.', 1) = '0' AS level0,
  split_part(htag, '.', 2) AS body, srcurl IN ('', 'null') AS no_ref,
  regexp_matches(srcurl, '{INTERNAL}') AS internal, NOT contains(srcurl, ' ') AS uri_ok,
  {host_sql('srcurl')} AS h,
  pageid NOT IN ('', 'null') AND ends_with(pageid, '2') AS simu FROM v),
k AS (SELECT *, level0 AND regexp_full_match(body, '{PROMO}') AS promo,
  CASE WHEN ok AND NOT no_ref AND internal THEN 'C'
    WHEN level0 AND regexp_full_match(body, '{PROMO}') THEN 'A'
    WHEN level0 THEN 'S'
    WHEN has_htag AND no_ref THEN 'D'
    WHEN no_ref OR internal THEN 'C'
    ELSE 'A' END AS kind FROM t),
a AS (SELECT *, CASE WHEN promo THEN body ELSE coalesce({refchan_sql('h')}, '{c.OTHER}') END AS ch
  FROM k),
s AS (SELECT *, row_number() OVER (PARTITION BY guid ORDER BY ts, event_id) AS rn,
  first_value(kind) OVER (PARTITION BY guid ORDER BY ts, event_id) AS first_kind
  FROM a WHERE kind <> 'S'),
d AS (SELECT *, min(CASE WHEN kind = 'D' THEN rn END) OVER (PARTITION BY guid) AS first_d FROM s),
st AS (SELECT *, CASE WHEN kind = 'A' THEN ch
    WHEN kind = 'C' AND rn = 1 THEN '{c.DIRECT}'
    WHEN kind = 'D' AND first_kind <> 'C' AND rn = first_d THEN '{c.DIRECT}' END AS state FROM d),
cur AS (SELECT *, CASE WHEN kind = 'D' THEN '{c.DIRECT}' ELSE last_value(state IGNORE NULLS)
    OVER (PARTITION BY guid ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
    END AS channel FROM st),
ek AS (SELECT kind, rn, unnest(list_concat(
    CASE WHEN kind = 'D' THEN ['{c.DIRECT}', '{c.ALL_DIRECT}']
      WHEN kind = 'A' AND promo THEN list_concat({levels_sql('ch')}, ['{c.ALL_PROMO}'])
      WHEN kind = 'A' AND uri_ok THEN [ch, {group_sql('ch')}]
      WHEN kind = 'A' AND has_htag AND NOT ok THEN ['{c.OTHER}']
      WHEN kind = 'A' THEN ['{c.ALL_OTHER}'] ELSE [] END,
    CASE WHEN kind = 'C' AND rn = 1 THEN ['{c.DIRECT}', '{c.ALL_DIRECT}'] ELSE [] END
  )) AS code FROM cur),
e1 AS (SELECT code, count(*) AS enter FROM ek GROUP BY code),
enters AS (SELECT code, enter FROM e1 UNION ALL
  SELECT '{c.ALL}', CAST(coalesce(sum(enter), 0) AS BIGINT) FROM e1
  WHERE code IN ({quoted(c.GROUPS)})),
pv1 AS (SELECT guid, simu, channel FROM cur WHERE channel NOT IN ({quoted(c.PORTAL_CODES)})),
pvx AS (SELECT guid, simu, unnest({levels_sql('channel')}) AS code FROM pv1
  UNION ALL SELECT guid, simu, {group_sql('channel')} FROM pv1
  UNION ALL SELECT guid, simu, '{c.ALL}' FROM pv1),
pg AS (SELECT guid, code, count(*) AS pv, count(*) FILTER (WHERE simu) AS sm
  FROM pvx GROUP BY guid, code),
pc AS (SELECT code, sum(pv) AS pv, count(*) AS uv, count(*) FILTER (WHERE pv > 1) AS validuv,
  count(*) FILTER (WHERE sm > 0) AS simuuv FROM pg GROUP BY code),
codes AS (SELECT code AS channel FROM pc UNION SELECT code FROM enters
  UNION SELECT channel FROM {FIXED_CODES}),
m AS (SELECT channel, {long('coalesce(pv, 0)', 'pv')}, {long('coalesce(uv, 0)', 'uv')},
  {long('coalesce(validuv, 0)', 'validuv')}, {long('coalesce(enter, 0)', 'enter')},
  {long('0', 'gmuv')}, {long('coalesce(simuuv, 0)', 'simuuv')}
  FROM codes LEFT JOIN pc ON codes.channel = pc.code LEFT JOIN enters ON codes.channel = enters.code)
"""
IS_DETAIL = f"channel NOT IN ({SUMMARY})"

add("pc_attribution", PC_ROWS + "SELECT guid, ts, event_id, kind, channel FROM cur", "pv_log")
add("pc_enter", PC_ROWS + "SELECT channel, enter FROM m WHERE enter > 0", "pv_log")
add(
    "pc_simu_uv",
    PC_ROWS + f"SELECT channel, simuuv FROM m WHERE simuuv > 0 AND {IS_DETAIL}", "pv_log",
)
add("pc_channel_view", PC_ROWS + f"SELECT * FROM m WHERE pv > 0 AND {IS_DETAIL}", "pv_log")
add("pc_group_view", PC_ROWS + f"SELECT * FROM m WHERE channel IN ({quoted(c.GROUPS)})", "pv_log")
add("pc_total_view", PC_ROWS + f"SELECT * FROM m WHERE channel = '{c.ALL}'", "pv_log")
add(
    "pc_channel_report",
    PC_ROWS + f"SELECT {DATE}, *, {dims_sql('channel')} FROM m WHERE pv > 0 OR NOT ({IS_DETAIL})",
    "pv_log",
)
add(
    "channel_dim",
    PC_ROWS + f"SELECT channel, {dims_sql('channel')}, "
    f"""{parent_sql('channel', "'-1'")} AS h5_parent FROM m""",
    "pv_log",
)
add(
    "pc_anomalies",
    PC_ROWS + "SELECT count(*) FILTER (WHERE has_htag AND NOT ok) AS bad_htag, "
    "count(*) FILTER (WHERE kind = 'A' AND NOT promo AND NOT uri_ok) AS bad_referrer, "
    "count(*) FILTER (WHERE ok AND NOT level0 AND no_ref) AS htag_without_ref, "
    "count(*) FILTER (WHERE kind = 'S') AS level0_not_promo FROM a",
    "pv_log",
)

# --- H5 ----------------------------------------------------------------------

STEP = " ".join(
    f"WHEN ends_with(pageid, '{end}') THEN '{step}'" for step, end in c.FUNNEL_SUFFIXES.items()
)
STEPS = tuple(c.FUNNEL_SUFFIXES)
H5_ROWS = f""",
v AS ({pv_valid_sql(PV_COLUMNS, H5_PRODUCT)}),
t AS (SELECT *, lower(htag) NOT IN ('', 'null') AND {HTAG_VALID} AS ok,
  split_part(htag, '.', 1) = '0' AS zero, split_part(htag, '.', 2) AS body,
  {host_sql('srcurl')} AS h,
  CASE WHEN lower(pageid) NOT IN ('', 'null') THEN CASE {STEP} END END AS step FROM v),
a AS (SELECT *, CASE WHEN ok AND zero THEN
      CASE WHEN regexp_full_match(body, '{PROMO}') THEN body END
    WHEN lower(srcurl) IN ('', 'null') THEN '{c.DIRECT}'
    WHEN ok OR NOT regexp_matches(srcurl, '{INTERNAL}')
      THEN coalesce({refchan_sql('h')}, '{c.OTHER}') END AS assigned,
  row_number() OVER (PARTITION BY guid ORDER BY ts, event_id) AS rn FROM t),
cur AS (SELECT *, coalesce(last_value(assigned IGNORE NULLS) OVER (PARTITION BY guid ORDER BY rn
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), '{c.DIRECT}') AS channel,
  CASE WHEN assigned IS NOT NULL OR rn = 1 THEN 1 ELSE 0 END AS entered FROM a),
x AS (SELECT guid, step, entered, unnest({levels_sql('channel')}) AS code FROM cur
  UNION ALL SELECT guid, step, entered, {group_sql('channel')} FROM cur
  UNION ALL SELECT guid, step, entered, '{c.ALL}' FROM cur),
g AS (SELECT code, count(*) AS pv, count(DISTINCT guid) AS uv, sum(entered) AS enter,
  {', '.join(f"count(DISTINCT CASE WHEN step = '{s}' THEN guid END) AS {s}" for s in STEPS)}
  FROM x GROUP BY code),
m AS (SELECT channel, {', '.join(long(f'coalesce({n}, 0)', n) for n in ('pv', 'uv', 'enter', *STEPS))}
  FROM (SELECT code AS channel FROM g UNION SELECT channel FROM {FIXED_CODES}) codes
  LEFT JOIN g ON codes.channel = g.code)
"""
OPENINGS = f""",
o AS (SELECT coalesce({otrack_sql('otrack')}, '{c.DIRECT}') AS channel FROM h5_event_log
  WHERE productid = '5002' AND type = '4' AND @complete),
ox AS (SELECT unnest({levels_sql('channel')}) AS code FROM o
  UNION ALL SELECT {group_sql('channel')} FROM o UNION ALL SELECT '{c.ALL}' FROM o),
og AS (SELECT code, count(*) AS n FROM ox GROUP BY code),
om AS (SELECT channel, {long('coalesce(n, 0)', 'openacct_num')}
  FROM (SELECT code AS channel FROM og UNION SELECT channel FROM {FIXED_CODES}) codes
  LEFT JOIN og ON codes.channel = og.code)
"""
H5_DIMS = dims_sql("channel", "'-1'", True)
add("h5_attribution", H5_ROWS + "SELECT guid, ts, event_id, channel FROM cur", "pv_log")
add("h5_funnel", f"\nSELECT event_id, pageid, CASE {STEP} END AS step FROM pv_log", "pv_log")
add("h5_enter", H5_ROWS + "SELECT channel, enter FROM m WHERE enter > 0", "pv_log")
add("h5_channel_view", H5_ROWS + f"SELECT * FROM m WHERE {IS_DETAIL}", "pv_log")
add("h5_group_view", H5_ROWS + f"SELECT * FROM m WHERE NOT ({IS_DETAIL})", "pv_log")
add("h5_view_report", H5_ROWS + f"SELECT {DATE}, *, {H5_DIMS} FROM m", "pv_log")
add(
    "h5_openacct",
    OPENINGS.replace('@complete', COMPLETE) + f"SELECT {DATE}, *, {H5_DIMS} FROM om", "h5_event_log",
)
BOTH = H5_ROWS.rstrip() + OPENINGS.replace("@complete", "TRUE").rstrip()
add(
    "h5_channel_merged",
    BOTH + f"""
SELECT {DATE}, channel, {', '.join(f'coalesce({n}, 0) AS {n}'
                                   for n in ('pv', 'uv', 'enter', *STEPS, 'openacct_num'))},
  {H5_DIMS} FROM m FULL OUTER JOIN om USING (channel)""",
    "pv_log", "h5_event_log",
)
add(
    "h5_merge_coverage",
    BOTH + """
SELECT CASE WHEN m.channel IS NOT NULL AND om.channel IS NOT NULL THEN 'pairs'
  WHEN m.channel IS NOT NULL THEN 'pv copy' ELSE 'event copy' END AS side, count(*) AS n
FROM m FULL OUTER JOIN om ON m.channel = om.channel GROUP BY 1""",
    "pv_log", "h5_event_log",
)

# --- news, private fund, ads -------------------------------------------------

NEWS_ROWS = (
    f"pv_log WHERE NOT {VISITOR_BAD} AND starts_with('10012', proid) AND {IS_NEWS_PAGE}"
)
NEWS_SELECT = (
    f"{DATE}, 10012 AS proid, pageid AS page_id, {NEWS_PARTS.format('pageid')}, "
    "count(*) AS pv, count(DISTINCT guid) AS uv"
)
add("news_pv_daily", f"\nSELECT {NEWS_SELECT} FROM {NEWS_ROWS} GROUP BY pageid", "pv_log")
LOG_HOUR = f"concat('{DT}.', CAST((CAST(ts AS BIGINT) // 3600000) % 24 AS VARCHAR))"
add(
    "news_pv_hourly",
    f"\nSELECT {LOG_HOUR} AS log, {NEWS_SELECT} FROM {NEWS_ROWS} AND {COMPLETE} GROUP BY 1, pageid",
    "pv_log",
)
add(
    "news_pv_stream",
    f""",
n AS (SELECT CAST(ts AS BIGINT) // 3600000 * 3600000 AS hour_ms, pageid, guid
  FROM {NEWS_ROWS} AND {COMPLETE})
SELECT hour_ms, pageid AS page_id, count(*) AS pv, count(DISTINCT guid) AS uv FROM n GROUP BY 1, 2""",
    "pv_log",
)
add(
    "news_pv_total",
    f"\nSELECT {DATE}, 10012 AS proid, '-1' AS page_id, CAST(-1 AS DECIMAL(38,0)) AS zid, "
    "'-1' AS newstype, '-1' AS subtype, '-1' AS author_id, count(*) AS pv, "
    f"count(DISTINCT guid) AS uv FROM {NEWS_ROWS}",
    "pv_log",
)
add(
    "news_uv_sketch",
    f"""\nSELECT *, true AS uv_near FROM ({ORACLE_SQL['news_pv_daily']})
UNION ALL SELECT *, true FROM ({ORACLE_SQL['news_pv_total']})""",
)
IS_FUND_PAGE = r"regexp_full_match(pageid, '\d+(1|2|3)2')"
IS_FUND_URL = rf"regexp_full_match(desturl, '(?:http|https)://.*simu\.{SITE}\.com.*')"
add(
    "simu_page_pv",
    f"\nSELECT {DATE}, 10011 AS proid, CAST(pageid AS DECIMAL(38,0)) AS page_id, "
    "CAST(right(pageid, 2) AS INTEGER) AS page_type, count(*) AS pv, "
    f"count(DISTINCT guid) AS uv FROM pv_log WHERE NOT {VISITOR_BAD} "
    f"AND starts_with('10011', proid) AND {IS_FUND_PAGE} AND {IS_FUND_URL} GROUP BY pageid",
    "pv_log",
)
add("news_rejects", rejects_sql("pv_log", [
    (f"({VISITOR_BAD} OR NOT starts_with('10012', proid))", "INVALID_DATA"),
    (f"NOT {IS_NEWS_PAGE}", "INVALID_PAGEID"),
]), "pv_log")
add("simu_rejects", rejects_sql("pv_log", [
    (f"({VISITOR_BAD} OR NOT starts_with('10011', proid))", "INVALID_DATA"),
    (f"NOT {IS_FUND_PAGE}", "INVALID_PAGEID"), (f"NOT {IS_FUND_URL}", "INVALID_URL"),
]), "pv_log")
AD_TESTS = [
    (VISITOR_BAD, "INVALID_DATA"), ("tag IN ('', 'null')", "NO_TAG"),
    (r"(tag = '10000' OR NOT regexp_full_match(tag, '1\d{4}'))", "INVALID_TAG"),
]
AD_REPORT = (
    f"SELECT {DATE}, tag, CASE WHEN proid IN ('', 'null') THEN '10013' ELSE proid END AS proid, "
    "CASE WHEN pageid IN ('', 'null') THEN '' ELSE pageid END AS page_id, count(*) AS click_num "
    f"FROM ad_log WHERE {' AND '.join(f'NOT {test}' for test, _ in AD_TESTS)} GROUP BY 2, 3, 4"
)
add("ad_rejects", rejects_sql("ad_log", AD_TESTS), "ad_log")
add("ad_click_daily", "\n" + AD_REPORT, "ad_log")
add(
    "sink_delimited",
    f"\nSELECT concat_ws('{FIELD_SEPARATOR}', CAST(dt AS VARCHAR), tag, proid, page_id, "
    f"CAST(click_num AS VARCHAR)) AS value FROM ({AD_REPORT})",
    "ad_log",
)
add(
    "module_dim",
    f"\nSELECT proid, {case('proid', c.MODULES, QUESTION)} AS label, "
    f"count(*) AS n FROM ({AD_REPORT}) GROUP BY proid",
    "ad_log",
)

# --- trades ------------------------------------------------------------------

AMOUNT_OK = r"regexp_full_match(amt, '[+-]?\d{1,18}(\.\d{0,6})?')"
AMOUNT = f"CASE WHEN {AMOUNT_OK} THEN TRY_CAST(amt AS DECIMAL(38,6)) END"
TRADE_TESTS = [
    (f"type NOT IN ({quoted(c.REPORTED_ACTIONS)})", "OTHER_ACTION"),
    ("tx_rslt = '0'", "FAILED"),
    (f"NOT regexp_matches(url, '{LANDING}')", "INVALID_URL"),
    ("(lower(guid) IN ('', 'null') OR lower(ts) IN ('', 'null'))", "INVALID_DATA"),
    (f"(type IN ({quoted(c.TRADE_ACTIONS)}) AND NOT {AMOUNT_OK})", "INVALID_AMOUNT"),
]
TRADE_VALID = " AND ".join(f"NOT ({test})" for test, _ in TRADE_TESTS)
TRADE_SELECT = (
    f"event_id, CAST(ts AS BIGINT) AS ts, type, url, {AMOUNT} AS amt, "
    "tx_rslt, guid, otrack"
)
IS_TRADE = f"type IN ({quoted(c.TRADE_ACTIONS)})"
TRADE_ROWS = f""",
v AS (SELECT {TRADE_SELECT} FROM trade_log WHERE {TRADE_VALID}),
a AS (SELECT *, {otrack_sql('otrack')} AS assigned FROM v),
cur AS (SELECT *, coalesce(last_value(assigned IGNORE NULLS) OVER (PARTITION BY guid
    ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), '{c.DIRECT}')
    AS channel FROM a),
x AS (SELECT *, unnest({levels_sql('channel')}) AS code, 0 AS is_group FROM cur
  UNION ALL SELECT *, {group_sql('channel')} AS code, 1 AS is_group FROM cur),
g AS (SELECT guid, code, is_group, count(*) FILTER (WHERE {IS_TRADE}) AS bills,
  coalesce(sum(amt) FILTER (WHERE {IS_TRADE}), 0) AS amt,
  count(*) FILTER (WHERE type = '5') AS bind_card, count(*) FILTER (WHERE type = '4') AS open_acct
  FROM x GROUP BY ALL),
p AS (SELECT guid, sum(bills) AS bills, sum(greatest(amt, 0)) AS amt, sum(bind_card) AS bind_card,
  sum(open_acct) AS open_acct FROM g WHERE is_group = 1 GROUP BY guid),
u AS (SELECT code AS channel, count(*) FILTER (WHERE CASE WHEN is_group = 1 THEN amt > 0
    ELSE bills > 0 END) AS persons, sum(bills) AS bills, sum(amt) AS amt,
    sum(bind_card) AS bind_card, sum(open_acct) AS open_acct FROM g GROUP BY code
  UNION ALL SELECT '{c.ALL}', count(*) FILTER (WHERE amt > 0), sum(bills), sum(amt),
    sum(bind_card), sum(open_acct) FROM p),
m AS (SELECT channel, {long('coalesce(persons, 0)', 'persons')},
  {long('coalesce(bills, 0)', 'bills')}, CAST(coalesce(amt, 0) AS DECIMAL(38,6)) AS amt,
  {long('coalesce(bind_card, 0)', 'bind_card')}, {long('coalesce(open_acct, 0)', 'open_acct')}
  FROM (SELECT channel FROM u UNION SELECT channel FROM {FIXED_CODES}) codes
  LEFT JOIN u USING (channel))
"""
add(
    "trade_valid",
    f"\nSELECT {TRADE_SELECT} FROM trade_log WHERE {COMPLETE} AND {TRADE_VALID}", "trade_log",
)
add("trade_rejects", rejects_sql("trade_log", TRADE_TESTS), "trade_log")
add(
    "trade_failures",
    f"\nSELECT {case('type', c.FAILURE_COUNTERS, 'NULL')} AS failure, count(*) AS n "
    f"FROM trade_log WHERE {COMPLETE} AND {IS_TRADE} AND tx_rslt = '0' GROUP BY 1",
    "trade_log",
)
add(
    "otrack_channel",
    f"\nSELECT event_id, otrack, {otrack_sql('otrack')} AS channel FROM trade_log", "trade_log",
)
add("trade_attribution", TRADE_ROWS + "SELECT guid, ts, event_id, channel FROM cur", "trade_log")
add("trade_by_channel", TRADE_ROWS + f"SELECT * FROM m WHERE {IS_DETAIL}", "trade_log")
add("trade_group", TRADE_ROWS + f"SELECT * FROM m WHERE channel IN ({quoted(c.GROUPS)})", "trade_log")
add("trade_total", TRADE_ROWS + f"SELECT * FROM m WHERE channel = '{c.ALL}'", "trade_log")
TRADE_REPORT = f"SELECT {DATE}, *, {dims_sql('channel')} FROM m"
add("trade_report", TRADE_ROWS + TRADE_REPORT, "trade_log")
add("sink_report_table", TRADE_ROWS + TRADE_REPORT, "trade_log")
add(
    "report_day_twice",
    f"{TRADE_ROWS}\nSELECT * FROM ({TRADE_REPORT}) UNION ALL SELECT * FROM ({TRADE_REPORT.replace(DT, OTHER_DT)})",
    "trade_log",
)


def total_sql(action: str, name: str) -> str:
    return (
        f"CAST(coalesce(sum(a) FILTER (WHERE type = '{action}'), 0) AS DECIMAL(38,6)) AS {name}, "
        f"coalesce(max(d) FILTER (WHERE type = '{action}'), 0) AS {name}_scale"
    )


def shown_sql(name: str) -> str:
    text = f"CAST({name} AS VARCHAR)"
    short = f"CASE WHEN {name}_scale = 0 THEN 7 ELSE 6 - {name}_scale END"
    return f"left({text}, CAST(length({text}) - {short} AS BIGINT))"


add(
    "event_total_amount",
    f"""
SELECT pigamt, buyamt, CAST(0 AS DECIMAL(38,6)) AS other, n_rejected,
  concat('pigamt:', {shown_sql('pigamt')}, ',buyamt:', {shown_sql('buyamt')}, ',other:0') AS line
FROM (SELECT {total_sql('8', 'pigamt')}, {total_sql('6', 'buyamt')},
    count(*) FILTER (WHERE a IS NULL) AS n_rejected
  FROM (SELECT type, {AMOUNT} AS a,
      CASE WHEN {AMOUNT_OK} THEN length(regexp_extract(amt, '\\.(\\d+)$', 1)) END AS d
    FROM trade_log WHERE {COMPLETE} AND type IN ('6', '8')))""",
    "trade_log",
)
add(
    "trade_anomalies",
    "\nSELECT count(*) FILTER (WHERE lower(otrack) NOT IN ('', 'null') AND NOT "
    rf"regexp_full_match(otrack, '\d+-\d+-\d+-\d+\.[0-3]')) AS bad_otrack FROM trade_log WHERE {TRADE_VALID}",
    "trade_log",
)
add(
    "action_dim",
    f"\nSELECT type, {case('type', c.ACTIONS, QUESTION)} AS label, "
    "count(*) AS n FROM trade_log GROUP BY type",
    "trade_log",
)

# --- app logins --------------------------------------------------------------

APP_ROWS = r""",
d AS (SELECT *, CASE WHEN proid IN ('2002', '3002') THEN imei
    WHEN proid IN ('2001', '3001') THEN ios_guid ELSE '' END AS deviceid,
  CASE WHEN proid IN ('2002', '3002') THEN 1 WHEN proid IN ('2001', '3001') THEN 2
    ELSE -1 END AS flag FROM app_log)"""
APP_TESTS = [
    ("TRY_CAST(ts AS BIGINT) IS NULL", "INVALID_TIME"),
    ("TRY_CAST(type AS INTEGER) IS NULL", "INVALID_TYPE"),
    (r"(regexp_full_match(deviceid, '0+|-+|\s*') AND custno = '0')", "INVALID_DEVICE"),
    ("flag = -1", "UNKNOWN_PRODUCT"),
]
LOGINS = (
    "SELECT deviceid, custno, proid, CAST(ts AS BIGINT) AS ts, CAST(type AS INTEGER) AS type, "
    f"flag FROM d WHERE {' AND '.join(f'NOT {test}' for test, _ in APP_TESTS)}"
).replace("NOT TRY_CAST(ts AS BIGINT) IS NULL", "TRY_CAST(ts AS BIGINT) IS NOT NULL").replace(
    "NOT TRY_CAST(type AS INTEGER) IS NULL", "TRY_CAST(type AS INTEGER) IS NOT NULL"
)


def first_logins_sql(rows: str) -> str:
    def millis(*products: str) -> str:
        return f"make_timestamp(min(ts) FILTER (WHERE proid IN ({quoted(products)})) * 1000)"

    return (
        f"SELECT deviceid, custno, {millis('2001', '2002')} AS chuxuguan_firsttime, "
        f"{millis('3001', '3002')} AS zhangji_firsttime, "
        f"arg_min(flag, (ts, flag)) AS flag FROM ({rows}) GROUP BY deviceid, custno"
    )


add("app_logins_valid", APP_ROWS + "\n" + LOGINS, "app_log")
add("app_rejects", APP_ROWS + rejects_sql("d", APP_TESTS), "app_log")
add("app_first_login", APP_ROWS + "\n" + first_logins_sql(LOGINS), "app_log")
add("app_first_login_stream", APP_ROWS + "\n" + first_logins_sql(f"{LOGINS} AND {COMPLETE}"), "app_log")
STATE = f""",
l AS ({LOGINS}),
o AS ({first_logins_sql(f'SELECT * FROM l WHERE ts < {STATE_CUT_MS}')}),
n AS ({first_logins_sql(f'SELECT * FROM l WHERE ts >= {STATE_CUT_MS}')})
"""
add(
    "app_first_login_upsert",
    APP_ROWS + STATE + """
SELECT deviceid, custno,
  coalesce(o.chuxuguan_firsttime, n.chuxuguan_firsttime) AS chuxuguan_firsttime,
  coalesce(o.zhangji_firsttime, n.zhangji_firsttime) AS zhangji_firsttime,
  CASE WHEN o.flag IS NULL THEN n.flag
    WHEN n.flag IS NOT NULL AND (o.chuxuguan_firsttime IS NULL OR o.zhangji_firsttime IS NULL)
    THEN n.flag ELSE o.flag END AS flag,
  CASE WHEN o.flag IS NULL THEN 'insert'
    WHEN n.flag IS NOT NULL AND (o.chuxuguan_firsttime IS NULL OR o.zhangji_firsttime IS NULL)
    THEN 'update' ELSE 'keep' END AS change
FROM n FULL OUTER JOIN o USING (deviceid, custno)""",
    "app_log",
)
ORACLE_SQL["observed_rejects"] = " UNION ALL ".join(
    f"SELECT '{log}' AS log, reason, n FROM ({ORACLE_SQL[name]})" for log, name in (
        ("page views", "pv_rejects"), ("H5 page views", "h5_rejects"), ("trades", "trade_rejects"),
        ("news page views", "news_rejects"), ("private-fund page views", "simu_rejects"),
        ("ad clicks", "ad_rejects"), ("app logins", "app_rejects")))
ORACLE_SQL["several_inputs"] = ORACLE_SQL["pv_rejects"]
add(
    "news_hourly_files",
    f"""
SELECT 'today' AS name, {NEWS_SELECT} FROM {NEWS_ROWS} AND {COMPLETE}
  AND {LOG_HOUR} IN ('{DT}.1', '{DT}.14') GROUP BY {LOG_HOUR}, pageid
UNION ALL SELECT 'his', {NEWS_SELECT} FROM {NEWS_ROWS} AND {COMPLETE} GROUP BY pageid""",
    "pv_log",
)
ORACLE_SQL["app_login_state"] = (
    f"SELECT * EXCLUDE (change), CAST(2 AS INTEGER) AS version FROM ({ORACLE_SQL['app_first_login_upsert']})")
ORACLE_SQL["app_first_login_keyed"] = ORACLE_SQL["app_first_login_stream"]
ORACLE_SQL["news_windows_late"] = ORACLE_SQL["news_pv_stream"]
add(
    "table_count",
    APP_ROWS + STATE + "SELECT count(*) AS n FROM n FULL OUTER JOIN o USING (deviceid, custno) "
    "WHERE coalesce(o.zhangji_firsttime, n.zhangji_firsttime) IS NOT NULL",
    "app_log",
)

# --- small text jobs ---------------------------------------------------------

add(
    "word_count",
    r"SELECT word, count(*) AS n FROM (SELECT unnest(string_split_regex(text, '[ \t\n\r\f]+')) "
    "AS word FROM documents) WHERE word <> '' GROUP BY word",
)
add("word_count_text", ORACLE_SQL["word_count"])
add(
    "secondary_sort_rejects",
    "SELECT CASE WHEN o_orderkey % 101 IN (0, 1) THEN 'NOT_A_NUMBER' WHEN o_orderkey % 101 = 2 THEN 'BLANK' "
    "ELSE 'ACCEPTED' END AS reason, count(*) AS n FROM orders GROUP BY 1",
)
add(
    "secondary_sort",
    f"""WITH p AS (SELECT CAST(o_custkey AS INTEGER) AS f, CAST(o_orderkey AS INTEGER) AS s FROM orders
  WHERE o_orderkey % 101 > 2),
x AS (SELECT f, s, concat(CAST(f AS VARCHAR), '\t', CAST(s AS VARCHAR)) AS line FROM p
  UNION ALL SELECT DISTINCT f, CAST(NULL AS INTEGER), '{GROUP_SEPARATOR}' FROM p)
SELECT CASE WHEN f <= 10 THEN 0 WHEN f <= 20 THEN 1 ELSE 2 END AS bucket,
  f AS first, s AS second, line FROM x""",
)
add(
    "signature",
    "SELECT doc_id, to_base64(encode(md5(text))) AS signature, TRUE AS verified, FALSE AS verified_changed, "
    "TRUE AS base64_round_trip FROM documents",
)
