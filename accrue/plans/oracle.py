"""The same queries in DuckDB SQL, written independently of the Spark plans."""

from __future__ import annotations

_FACTS = """
typed AS (
  SELECT event_id AS id, CAST(user_id AS VARCHAR) AS cuit,
         CASE event_type WHEN 'purchase' THEN 'RET_IVA' WHEN 'click' THEN 'RET_GANANCIAS'
              WHEN 'view' THEN 'RET_IIBB_CABA' WHEN 'signup' THEN 'PER_IVA' WHEN 'error' THEN 'PER_IIBB_CABA' END AS tax_id,
         CAST(2 + (event_id % 3) * 1.5 AS DECIMAL(5,2)) AS tax_rate,
         CAST(value AS DECIMAL(18,2)) AS base_tax,
         CAST(ts AS TIMESTAMP) AS created_at,
         CAST(epoch(date_trunc('second', ts)) AS BIGINT) AS e
  FROM events),
facts AS (
  SELECT *, CAST(CAST(base_tax * tax_rate * 0.01 AS DECIMAL(18,2)) + CASE WHEN id % 97 = 13 THEN 0.01 ELSE 0 END AS DECIMAL(18,2)) AS tax_amount,
         e + (id * 7919) % 1200 AS arr FROM typed)"""

_LOG = """
merchants AS (SELECT * FROM customer WHERE c_custkey % 11 <> 5),
timed AS (SELECT *, TIMESTAMP '2024-01-10 12:00:00' + to_minutes(CAST(c_custkey % 600 AS INTEGER)) AS upd FROM merchants),
log AS (
  SELECT CAST(c_custkey AS VARCHAR) AS cuit, c_name AS name, CAST(10000 + c_custkey AS VARCHAR) AS establishment,
         'r' AS op, TIMESTAMP '2024-01-02 00:00:00' AS op_ts, c_custkey * 10 AS seq FROM timed
  UNION ALL SELECT CAST(c_custkey AS VARCHAR), c_name || ' II', CAST(20000 + c_custkey AS VARCHAR), 'u', upd, c_custkey * 10 + 1
         FROM timed WHERE c_custkey % 3 = 0
  UNION ALL SELECT CAST(c_custkey AS VARCHAR), c_name || ' III', CAST(30000 + c_custkey AS VARCHAR), 'u', upd, c_custkey * 10 + 2
         FROM timed WHERE c_custkey % 6 = 0
  UNION ALL SELECT CAST(c_custkey AS VARCHAR), NULL, NULL, 'd', TIMESTAMP '2024-01-20 00:00:00', c_custkey * 10 + 3
         FROM timed WHERE c_custkey % 7 = 0),
versions AS (
  SELECT * FROM log QUALIFY row_number() OVER (PARTITION BY cuit, op_ts ORDER BY seq DESC) = 1)"""

_LOG_OF_ALL = _LOG.replace("SELECT * FROM customer WHERE c_custkey % 11 <> 5", "SELECT * FROM customer")


def _marked(name: str, delay: int, facts: str = "facts") -> str:
    return f"""
seen_{name} AS (
  SELECT *, max(created_at) OVER (ORDER BY arr, id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS seen FROM {facts}),
marked_{name} AS (SELECT *, created_at < seen - to_seconds({delay}) AS late FROM seen_{name})"""


# Buenos Aires is at UTC-3 in all of the sample data
_START = {
    "60s": "make_timestamp(((e - 10800) - (e - 10800) % 60 + 10800) * 1000000)",
    "7s": "make_timestamp(((e - 10800) - (e - 10800) % 7 + 10800) * 1000000)",
    "7s_midnight": "make_timestamp((e - ((e - 10800) % 86400) % 7) * 1000000)",
    "120s": "make_timestamp(((e - 10800) - (e - 10800) % 120 + 10800) * 1000000)",
    "daily": "CAST(date_trunc('day', created_at - INTERVAL 3 HOUR) AS TIMESTAMP) + INTERVAL 3 HOUR",
    "monthly": "CAST(date_trunc('month', created_at - INTERVAL 3 HOUR) AS TIMESTAMP) + INTERVAL 3 HOUR",
}
_END = {
    "60s": "window_start + INTERVAL 60 SECOND",
    "7s": "window_start + INTERVAL 7 SECOND",
    "7s_midnight": "least(window_start + INTERVAL 7 SECOND,"
    " CAST(date_trunc('day', window_start - INTERVAL 3 HOUR) AS TIMESTAMP) + INTERVAL 27 HOUR)",
    "120s": "window_start + INTERVAL 120 SECOND",
    "daily": "window_start + INTERVAL 1 DAY",
    "monthly": "(window_start - INTERVAL 3 HOUR) + INTERVAL 1 MONTH + INTERVAL 3 HOUR",
}


def _lines_cte(name: str, period: str, delay: int = 600, facts: str = "facts", where: str = "TRUE") -> str:
    """CTEs up to ``lines_<name>``."""
    return f"""{_marked(name, delay, facts)},
enriched_{name} AS (
  SELECT f.*, v.name, v.establishment
  FROM (SELECT * FROM marked_{name} WHERE NOT late AND starts_with(tax_id, 'RET_') AND {where}) f
  ASOF LEFT JOIN versions v ON f.cuit = v.cuit AND f.created_at >= v.op_ts),
grouped_{name} AS (
  SELECT cuit, tax_id, {_START[period]} AS window_start, tax_rate,
         arg_max(establishment, created_at) FILTER (WHERE establishment IS NOT NULL) AS establishment,
         arg_max(name, created_at) FILTER (WHERE name IS NOT NULL) AS merchant_name,
         CAST(sum(base_tax) AS DECIMAL(18,2)) AS total_base_tax,
         CAST(sum(tax_amount) AS DECIMAL(18,2)) AS total_tax_amount
  FROM enriched_{name} GROUP BY ALL),
lines_{name} AS (SELECT *, {_END[period]} AS window_end FROM grouped_{name})"""


def _with(*ctes: str, select: str) -> str:
    return "WITH " + ",".join(ctes) + "\n" + select


def _lines(period: str, select: str = "SELECT * FROM lines_a", **options) -> str:
    return _with(_FACTS, _LOG, _lines_cte("a", period, **options), select=select)


def _period(spec: str) -> str:
    return _with(
        _FACTS,
        f"p AS (SELECT id, {_START[spec]} AS window_start FROM facts)",
        select=f"SELECT id, window_start, {_END[spec]} AS window_end FROM p",
    )


_ASOF = "a AS (SELECT f.id, f.cuit, f.created_at, v.name, v.establishment, v.op, v.op_ts" \
    " FROM facts f ASOF LEFT JOIN versions v ON f.cuit = v.cuit AND f.created_at >= v.op_ts)"
_ASOF_ROWS = "SELECT id, cuit, created_at, name, establishment," \
    " CASE WHEN op <> 'd' THEN op_ts END AS version_from FROM a"
_CHANGED = """(a.establishment IS DISTINCT FROM b.establishment OR a.merchant_name IS DISTINCT FROM b.merchant_name
  OR a.window_end IS DISTINCT FROM b.window_end OR a.total_base_tax IS DISTINCT FROM b.total_base_tax
  OR a.total_tax_amount IS DISTINCT FROM b.total_tax_amount)"""
_KEYS = "cuit, tax_id, window_start, tax_rate"
_WM = "(SELECT max(created_at) - to_seconds(600) FROM facts)"
_ITEMS = """SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC, l_discount DESC,
  l_tax DESC, l_returnflag DESC, l_linestatus DESC) = 1"""

_OF_GAPS = _LOG.replace(
    "versions AS (",
    "versions AS (SELECT * REPLACE (CASE WHEN (seq // 10 + seq % 10) % 4 <> 1 THEN name END AS name,"
    " CASE WHEN (seq // 10 + seq % 10) % 4 <> 2 THEN establishment END AS establishment) FROM (",
) + ")"
_SNAPSHOT = _LOG.replace("SELECT * FROM log QUALIFY", "SELECT * FROM log WHERE op = 'r' QUALIFY")
# micro-batches 0 to 5: the snapshot, facts, updates, facts, deletes, facts; 6 is the end of the input
_LATE_CHANGES = f"""
waves AS (SELECT m.*, 2 * ((arr - first) // span) + 1 AS batch
          FROM marked_a m, (SELECT min(arr) AS first, (max(arr) - min(arr)) // 3 + 1 AS span FROM facts)),
landed AS (SELECT *, CASE op WHEN 'r' THEN 0 WHEN 'u' THEN 2 ELSE 4 END AS batch FROM log),
newest AS (SELECT b.batch, CASE WHEN b.batch % 2 = 1 THEN (SELECT max(created_at) FROM waves w WHERE w.batch <= b.batch)
                                WHEN b.batch > 0 THEN (SELECT max(op_ts) FROM landed l WHERE l.batch <= b.batch) END AS t
           FROM (SELECT unnest(range(0, 6)) AS batch) b),
marks AS (SELECT batch, max(t - to_seconds(600)) OVER (ORDER BY batch) AS wm FROM newest),
out AS (SELECT w.id, any_value(w) AS f, coalesce(min(m.batch), 6) AS released FROM waves w LEFT JOIN marks m ON m.batch >= w.batch AND w.created_at <= m.wm
        WHERE NOT w.late AND starts_with(w.tax_id, 'RET_') GROUP BY w.id),
enriched AS (
  SELECT f.*, l.name, l.establishment FROM out LEFT JOIN landed l ON l.cuit = f.cuit AND l.op_ts <= f.created_at AND l.batch <= released
  QUALIFY row_number() OVER (PARTITION BY out.id ORDER BY l.op_ts DESC NULLS LAST, l.seq DESC) = 1),
grouped AS (
  SELECT cuit, tax_id, {_START["daily"]} AS window_start, tax_rate,
         arg_max(establishment, created_at) FILTER (WHERE establishment IS NOT NULL) AS establishment,
         arg_max(name, created_at) FILTER (WHERE name IS NOT NULL) AS merchant_name,
         CAST(sum(base_tax) AS DECIMAL(18,2)) AS total_base_tax, CAST(sum(tax_amount) AS DECIMAL(18,2)) AS total_tax_amount
  FROM enriched GROUP BY ALL)"""

_DIFF = _with(_FACTS, _LOG, _lines_cte("a", "daily"), _lines_cte("b", "daily", delay=300), select=f"""
SELECT CASE WHEN b.k IS NULL THEN 'only_left' WHEN a.k IS NULL THEN 'only_right'
            WHEN {_CHANGED} THEN 'changed' ELSE 'equal' END AS status, count(*) AS n
FROM (SELECT *, 1 AS k FROM lines_a) a FULL JOIN (SELECT *, 1 AS k FROM lines_b) b USING ({_KEYS}) GROUP BY ALL""")
_NOW = """
SELECT cuit, name, establishment FROM (
  SELECT * FROM log QUALIFY row_number() OVER (PARTITION BY cuit ORDER BY op_ts DESC, seq DESC) = 1) WHERE op <> 'd'"""
# the state at the end of each chunk's reading, where nothing changed during it, and every change behind its beginning
_CHUNKS = """
spans AS (SELECT chunk, epoch(TIMESTAMP '2024-01-10 12:00:00') + 60 * low AS low, epoch(TIMESTAMP '2024-01-10 12:00:00') + 60 * high AS high
          FROM (VALUES (0, 0, 110), (1, 120, 300), (2, 310, 500), (3, 13620, 13800), (4, 13630, 13790)) AS t(chunk, low, high)),
width AS (SELECT max(c_custkey) // 5 + 1 AS w FROM customer),
placed AS (SELECT l.*, CAST(low AS BIGINT) AS low, CAST(high AS BIGINT) AS high, CAST(epoch(op_ts) AS BIGINT) AS e
           FROM log l, width JOIN spans s ON CAST(l.cuit AS BIGINT) // w = s.chunk),
still AS (SELECT cuit, any_value(high) AS high, min(op_ts) FILTER (WHERE e > high) AS following,
                 arg_max(struct_pack(op, name, establishment), (e, seq)) FILTER (WHERE e <= high) AS v
          FROM placed GROUP BY cuit HAVING NOT bool_or(e > low AND e <= high))"""

ORACLE: dict[str, str] = {
    "family_filter": _with(_FACTS, select="SELECT id, cuit, tax_id, base_tax FROM facts WHERE tax_id LIKE 'RET|_%' ESCAPE '|'"),
    "prefix_count": _with(_FACTS, select="SELECT tax_id, count(*) AS n FROM facts WHERE tax_id LIKE 'PER%' GROUP BY tax_id"),
    **{f"period_{spec}": _period(spec) for spec in _START},
    "period_daily_dst": """
WITH l AS (SELECT o_orderkey, date_trunc('day', (o_orderdate AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York') AS d FROM orders)
SELECT o_orderkey, (CAST(d AS TIMESTAMP) AT TIME ZONE 'America/New_York') AT TIME ZONE 'UTC' AS window_start,
       (CAST(d + INTERVAL 1 DAY AS TIMESTAMP) AT TIME ZONE 'America/New_York') AT TIME ZONE 'UTC' AS window_end FROM l""",
    "late_drop": _with(_FACTS, _marked("a", 600), select="SELECT id, tax_id, created_at, arr FROM marked_a WHERE NOT late"),
    "late_rows": _with(_FACTS, _marked("a", 600), select="SELECT id, tax_id, created_at, arr FROM marked_a WHERE late"),
    "released_at_watermark": _with(
        _FACTS, _marked("a", 600),
        select=f"SELECT id, cuit, created_at FROM marked_a WHERE NOT late AND starts_with(tax_id, 'RET_') AND created_at <= {_WM}"),
    "pending_at_watermark": _with(
        _FACTS, _marked("a", 600),
        select=f"SELECT id, cuit, created_at FROM marked_a WHERE NOT late AND starts_with(tax_id, 'RET_') AND created_at > {_WM}"),
    "changelog_intervals": _with(_LOG_OF_ALL, select="""
SELECT cuit, name, establishment, valid_from, valid_to FROM (
  SELECT *, op_ts AS valid_from, lead(op_ts) OVER (PARTITION BY cuit ORDER BY op_ts, seq) AS valid_to FROM log)
WHERE op <> 'd' AND (valid_to IS NULL OR valid_from < valid_to)"""),
    "change_records": _with(_LOG_OF_ALL, select="SELECT * FROM log"),
    "fact_records": _with(_FACTS, select="SELECT id, cuit, tax_id, tax_rate, base_tax, tax_amount, created_at FROM facts"),
    "snapshot_log_merge": _with(_FACTS, select="""
SELECT id, cuit, tax_id, base_tax, created_at FROM (
  SELECT *, 0 AS src FROM facts WHERE created_at < TIMESTAMP '2024-01-16'
  UNION ALL SELECT *, 1 FROM facts WHERE created_at >= TIMESTAMP '2024-01-14')
QUALIFY row_number() OVER (PARTITION BY id ORDER BY src DESC) = 1"""),
    "incremental_snapshot": _with(_LOG_OF_ALL, _CHUNKS, select="""
SELECT cuit, name, establishment, op, op_ts, e * 10000000 + seq AS seq FROM placed WHERE e > low
UNION ALL SELECT cuit, v.name, v.establishment, 'r', least(make_timestamp(high * 1000000), coalesce(following, TIMESTAMP '9999-01-01')),
       high * 10000000 + 9999999 FROM still WHERE v.op <> 'd'"""),
    "incremental_snapshot_state": _with(_LOG_OF_ALL, select=_NOW),
    "asof_interval": _with(_FACTS, _LOG, _ASOF, select=_ASOF_ROWS),
    "asof_union": _with(_FACTS, _LOG, _ASOF, select=_ASOF_ROWS),
    "asof_null_keys": _with(
        _FACTS, _LOG,
        "keyed AS (SELECT * REPLACE (CASE WHEN id % 7 = 3 THEN NULL ELSE cuit END AS cuit) FROM facts)",
        "a AS (SELECT f.id, f.cuit, v.name, v.op, v.op_ts FROM keyed f ASOF LEFT JOIN versions v ON f.cuit = v.cuit AND f.created_at >= v.op_ts)",
        select="""
SELECT strategy, id, cuit, name, CASE WHEN op <> 'd' THEN op_ts END AS version_from
FROM a CROSS JOIN (VALUES ('interval'), ('union')) AS s(strategy)"""),
    "asof_delete": _with(_FACTS, _LOG, _ASOF, select="""
SELECT a.id, a.cuit, a.created_at, a.name, a.establishment FROM a JOIN log l ON l.cuit = a.cuit AND l.op = 'd'
WHERE a.created_at >= l.op_ts"""),
    "asof_before_first": _with(_FACTS, _LOG, _ASOF, select="""
SELECT id, cuit, created_at, name, establishment FROM a
JOIN (SELECT cuit, min(op_ts) AS first_at FROM log GROUP BY cuit) USING (cuit) WHERE created_at < first_at"""),
    "asof_snapshot": _with(_FACTS, select="""
SELECT f.id, f.cuit, c.c_name AS name FROM facts f
LEFT JOIN customer c ON CAST(c.c_custkey AS VARCHAR) = f.cuit AND f.created_at >= TIMESTAMP '2024-01-15'"""),
    "rate_lines_60s": _lines("60s"),
    "rate_lines_daily": _lines("daily"),
    "rate_lines_monthly": _lines("monthly"),
    "rate_lines_7s_midnight": _lines("7s_midnight"),
    "report_by_tax": _lines("daily", f"""
SELECT {_KEYS}, total_base_tax, row_number() OVER (PARTITION BY cuit ORDER BY tax_id, tax_rate, window_start) AS position FROM lines_a"""),
    "dump_order": _lines("daily", f"""
SELECT {_KEYS}, total_base_tax, row_number() OVER (PARTITION BY cuit ORDER BY tax_id, window_start, tax_rate) AS position FROM lines_a"""),
    "rate_lines_open_end": _lines("daily", where=f"created_at <= {_WM}"),
    "rate_lines_report": _lines("monthly", "SELECT * FROM lines_a ORDER BY window_start, tax_id"),
    "certificates": _lines("monthly", """
SELECT cuit, tax_id, window_start, window_end, count(*) AS rate_line_count,
       CAST(sum(total_base_tax) AS DECIMAL(18,2)) AS total_base_tax,
       CAST(sum(total_tax_amount) AS DECIMAL(18,2)) AS total_tax_amount,
       string_agg(tax_rate || '|' || total_base_tax || '|' || total_tax_amount || '|' || coalesce(establishment, '') || '|'
                  || coalesce(merchant_name, ''), ',' ORDER BY tax_rate) AS rates
FROM lines_a GROUP BY cuit, tax_id, window_start, window_end"""),
    "closed_certificates": _lines("daily", "SELECT * FROM lines_a WHERE window_end < TIMESTAMP '2024-01-16'"),
    "open_certificates": _lines("daily", "SELECT * FROM lines_a WHERE window_end >= TIMESTAMP '2024-01-16'"),
    "final_certificates": _lines("daily", f"SELECT * FROM lines_a WHERE window_end <= {_WM}"),
    "key_lookup": _lines("monthly", """
SELECT * FROM lines_a WHERE cuit = '11' AND tax_id = 'RET_IVA' AND tax_rate = 3.50 AND window_start = TIMESTAMP '2024-01-01 03:00:00'"""),
    "key_lookup_written": _lines("monthly", """
SELECT * FROM lines_a WHERE cuit = '11' AND tax_id = 'RET_IVA' AND tax_rate = 3.50 AND window_start = TIMESTAMP '2024-01-01 03:00:00'"""),
    "enriched_keys": _lines("daily", "SELECT DISTINCT cuit FROM lines_a WHERE establishment IS NOT NULL OR merchant_name IS NOT NULL"),
    "upsert_latest": _ITEMS,
    "keyed_table_upsert": _ITEMS,
    "apply_changes": _with(_LOG_OF_ALL, select=_NOW),
    "crossjoin_fanout": """
SELECT p_partkey, tax_id, CAST(tax_rate AS DECIMAL(5,2)) AS tax_rate
FROM part CROSS JOIN (VALUES ('RET_IVA', 3.50), ('RET_IVA', 5.00), ('RET_GANANCIAS', 3.00)) AS t(tax_id, tax_rate)""",
    "qa_duplicates": "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1",
    "qa_orphans": _lines("daily", """
SELECT count(*) AS orphan_lines, count(merchant_name) AS enriched_orphans
FROM lines_a WHERE cuit NOT IN (SELECT cuit FROM log)"""),
    "qa_family_leak": _lines("daily", """
SELECT (SELECT count(*) FROM lines_a WHERE tax_id LIKE 'PER%') AS leaked_lines,
       (SELECT count(*) FROM facts WHERE tax_id LIKE 'PER%') AS family_facts"""),
    "qa_diff": _DIFF,
    "qa_reconcile": _DIFF,
    "qa_reconcile_planted": """
SELECT o_orderkey, CASE WHEN o_orderkey % 1009 = 5 THEN 'only_left' ELSE 'changed' END AS status
FROM orders WHERE o_orderkey % 1009 = 5 OR (o_orderkey % 997 = 3 AND o_custkey IS NOT NULL)""",
    "qa_amounts": _with(_FACTS, select="""
SELECT count(*) AS facts,
       count(*) FILTER (WHERE tax_amount <> CAST(base_tax * tax_rate * 0.01 AS DECIMAL(18,2))) AS wrong FROM facts"""),
    "qa_closed_stable": _with(
        _FACTS, _LOG,
        "early AS (SELECT * FROM facts WHERE arr < epoch(TIMESTAMP '2024-01-16'))",
        _lines_cte("a", "daily", facts="early"), _lines_cte("b", "daily"),
        f"""
compared AS (
  SELECT a.window_end <= (SELECT max(created_at) - to_seconds(600) FROM early) AS final,
         b.k IS NULL OR {_CHANGED} AS changed
  FROM lines_a a LEFT JOIN (SELECT *, 1 AS k FROM lines_b) b USING ({_KEYS}))""",
        select="""
SELECT count(*) FILTER (WHERE final) AS final_lines, count(*) FILTER (WHERE final AND changed) AS changed_final_lines,
       count(*) FILTER (WHERE changed) AS changed_lines FROM compared"""),
    "qa_span": _lines("daily", """
SELECT count(*) FILTER (WHERE hour(window_start) <> 3 OR window_end <> window_start + INTERVAL 1 DAY) AS not_daily,
       count(*) FILTER (WHERE day(window_start) <> 1 OR hour(window_start) <> 3
                        OR window_end <> window_start + INTERVAL 1 MONTH) AS not_monthly,
       count(*) AS lines FROM lines_a"""),
    "qa_resum": _lines("daily", f"""
, plain AS (
  SELECT cuit, tax_id, {_START['daily']} AS window_start, tax_rate, 1 AS k,
         CAST(sum(base_tax) AS DECIMAL(18,2)) AS b, CAST(sum(tax_amount) AS DECIMAL(18,2)) AS t
  FROM facts WHERE starts_with(tax_id, 'RET_') GROUP BY ALL)
SELECT * FROM (
  SELECT CASE WHEN p.k IS NULL THEN 'only_left' WHEN l.j IS NULL THEN 'only_right'
              WHEN l.total_base_tax <> p.b OR l.total_tax_amount <> p.t THEN 'changed' ELSE 'equal' END AS status,
         count(*) AS n
  FROM (SELECT *, 1 AS j FROM lines_a) l FULL JOIN plain p USING ({_KEYS}) GROUP BY ALL) WHERE status <> 'equal'"""),
    "stream_equals_batch": _lines("daily"),
    "stream_live_target": _lines("daily", where=f"created_at <= {_WM}"),
    "restart_from_scratch": _lines("daily", where=f"created_at <= {_WM}"),
    "replay_idempotent": _lines("daily"),
    "stream_new_checkpoint": _lines("daily"),
    "stream_midnight": _lines("7s_midnight"),
    "stream_late_changes": _with(_FACTS, _LOG, _marked("a", 600), _LATE_CHANGES, select=f"SELECT *, {_END['daily']} AS window_end FROM grouped"),
    "stream_idle_inputs": _with(_FACTS, _SNAPSHOT, _lines_cte("a", "daily", where=f"created_at <= {_WM}"), select="SELECT * FROM lines_a"),
    "last_value_nulls": _with(_FACTS, _OF_GAPS, _lines_cte("a", "monthly"), select="SELECT * FROM lines_a"),
    "stream_last_value_nulls": _with(_FACTS, _OF_GAPS, _lines_cte("a", "monthly"), select="SELECT * FROM lines_a"),
    "stream_landed_source": _lines("daily"),
    "stream_state": _lines("daily", where=f"created_at <= {_WM}", select=f"""
SELECT cuit, 'line' AS kind, tax_id, tax_rate, window_start, total_base_tax AS base_tax FROM lines_a WHERE window_end > {_WM} - to_seconds(600)
UNION ALL SELECT cuit, 'waiting', tax_id, tax_rate, {_START['daily']}, base_tax FROM marked_a
WHERE NOT late AND starts_with(tax_id, 'RET_') AND created_at > {_WM}"""),
    "stream_state_restored": _lines("daily", where=f"created_at <= {_WM}", select=f"""
SELECT 'planted' AS against, cuit, CASE WHEN CAST(cuit AS BIGINT) % 7 = 0 THEN 'only_left' ELSE 'changed' END AS status FROM (
SELECT cuit FROM lines_a WHERE window_end > {_WM} - to_seconds(600)
UNION SELECT cuit FROM marked_a WHERE NOT late AND starts_with(tax_id, 'RET_') AND created_at > {_WM})
WHERE CAST(cuit AS BIGINT) % 7 < 2"""),
}
