"""DuckDB SQL for every registered query key.

Runs on the driver's pre-registered parquet views (``events``, ``pages``,
``nation``, ``documents`` ...).  The SQL is written independently of the Spark
plans where it matters: the funnel here is a range join of events against a
(day x slot window) table with ``arg_min`` picks, the form of the original
per-slot statements, while the Spark side assigns slots by a CASE expression
and aggregates struct minima.
"""

from __future__ import annotations

from .sources import fixtures as fx

# --------------------------------------------------------------------------
# Fixture views, as CTEs
# --------------------------------------------------------------------------

_TN_CASE = "CASE e.event_type " + " ".join(
    f"WHEN '{k}' THEN {v}" for k, v in fx.EVENT_TYPE_TN.items()) + " ELSE 0 END"

H_CTES = f"""
pg AS (
  SELECT page_id, min(url) AS url FROM pages GROUP BY page_id
),
h AS (
  SELECT e.event_id,
    CAST(e.user_id AS BIGINT) AS uid,
    date_trunc('second', e.ts) AS sec,
    CAST(CASE WHEN e.event_id % {fx.INVALID_EXPID_MODULUS} = 0 THEN 0 ELSE e.event_id // 4 + 1 END AS BIGINT) AS expid,
    CAST({_TN_CASE} AS TINYINT) AS tn,
    CAST(CASE WHEN e.event_type = 'error' THEN 1 ELSE 0 END AS TINYINT) AS sn,
    CAST(0 AS TINYINT) AS stn,
    coalesce(p1.url, '') AS ref,
    CAST((e.event_id // 4 + 1) % {fx.SITE_MODULUS} AS BIGINT) AS sid,
    CAST((e.event_id // 4 + 1) % {fx.ZONE_MODULUS} AS BIGINT) AS sz,
    coalesce(p2.url, '') AS bref,
    CAST(json_extract_string(e.props, '$.k') AS INTEGER) AS geo,
    CAST({fx.IP_BASE} + e.user_id AS BIGINT) AS ipint,
    CAST(0 AS INTEGER) AS pz,
    CAST(e.event_id % {fx.BANNER_MODULUS} AS INTEGER) AS bt,
    CAST(0 AS BIGINT) AS ad,
    CAST(0 AS BIGINT) AS net,
    CAST(0 AS DOUBLE) AS exppr,
    CAST(0 AS DOUBLE) AS winexppr,
    CAST(0 AS DOUBLE) AS secondpr,
    CAST(0 AS DOUBLE) AS floor,
    CAST(0 AS BIGINT) AS ddid,
    '' AS custom
  FROM events e
  LEFT JOIN pg p1 ON p1.page_id = e.event_id % (SELECT greatest(count(*), 1) FROM pages)
  LEFT JOIN pg p2 ON p2.page_id = (e.event_id + 1) % (SELECT greatest(count(*), 1) FROM pages)
),
ssp AS (
  SELECT CAST(n_nationkey AS BIGINT) AS sid, n_name AS name FROM nation
  WHERE n_regionkey IN ({", ".join(str(r) for r in fx.SSP_REGIONS)})
)"""


def with_h(body: str, extra_ctes: str = "") -> str:
    ctes = H_CTES + (",\n" + extra_ctes if extra_ctes else "")
    return f"WITH {ctes}\n{body}"


# --------------------------------------------------------------------------
# Funnel
# --------------------------------------------------------------------------

# Fixed values, kept apart from the library's own slot tables: hours at which a slot begins, its
# anchors end and its clicks end (SSP impressions end two minutes after their bids).
_NONSSP_HOURS = [(0, 6, 8), (6, 10, 12), (10, 14, 16), (14, 17, 19), (17, 20, 22), (20, 22, 24), (22, 24, 26)]
_SSP_HOURS = [(0, 6, 8), (6, 12, 14), (12, 15, 17), (15, 18, 20), (18, 21, 23), (21, 24, 26)]


def _window_rows() -> str:
    """(is_ssp, tn, slot, lo, hi) in seconds from the start of the processed day."""
    rows = []
    hm = lambda h, m=0: h * 3600 + m * 60
    for slot, (b, e_imp, e_cl) in enumerate(_NONSSP_HOURS):
        b, e_imp, e_cl = hm(b), hm(e_imp) - 1, hm(e_cl) - 1
        rows.append(f"(false, 0, {slot}, {b}, {e_imp})")
        rows.append(f"(false, 1, {slot}, {b}, {e_cl})")
    for slot, (b, e_bid, e_cl) in enumerate(_SSP_HOURS):
        b, e_bid, e_imp, e_cl = hm(b), hm(e_bid) - 1, hm(e_bid, 2) - 1, hm(e_cl) - 1
        rows.append(f"(true, 3, {slot}, {b}, {e_bid})")
        rows.append(f"(true, 0, {slot}, {b}, {e_imp})")
        rows.append(f"(true, 1, {slot}, {b}, {e_cl})")
    return "VALUES " + ", ".join(rows)


FUNNEL_CTES = f"""
v AS (
  SELECT h.*, (h.sid IN (SELECT sid FROM ssp)) AS is_ssp FROM h
  WHERE h.sn = 0 AND h.expid <> 0 AND h.tn IN (0, 1, 3)
),
days AS (
  SELECT DISTINCT CAST(sec AS DATE) AS d FROM v
  UNION SELECT DISTINCT CAST(sec AS DATE) - 1 FROM v
),
sw(is_ssp, tn, slot, lo, hi) AS ({_window_rows()}),
win AS (
  SELECT days.d, sw.is_ssp, sw.tn, sw.slot,
    CAST(days.d AS TIMESTAMP) + to_seconds(sw.lo) AS lo_ts,
    CAST(days.d AS TIMESTAMP) + to_seconds(sw.hi) AS hi_ts
  FROM days CROSS JOIN sw
),
m AS (
  SELECT w.d, w.slot, v.*,
    CASE WHEN v.tn = CASE WHEN v.is_ssp THEN 3 ELSE 0 END THEN 'A'
         WHEN v.tn = 0 THEN 'E' ELSE 'C' END AS rl
  FROM v JOIN win w
    ON v.is_ssp = w.is_ssp AND v.tn = w.tn AND v.sec BETWEEN w.lo_ts AND w.hi_ts
),
g AS (
  SELECT is_ssp, d, slot, expid,
    count(*) FILTER (WHERE rl = 'A') AS n_a,
    arg_min(sec, (sec, event_id)) FILTER (WHERE rl = 'A') AS a_sec,
    arg_min(uid, (sec, event_id)) FILTER (WHERE rl = 'A') AS a_uid,
    arg_min(sid, (sec, event_id)) FILTER (WHERE rl = 'A') AS a_sid,
    arg_min(sz, (sec, event_id)) FILTER (WHERE rl = 'A') AS a_sz,
    arg_min(geo, (sec, event_id)) FILTER (WHERE rl = 'A') AS a_geo,
    arg_min(bt, (sec, event_id)) FILTER (WHERE rl = 'A') AS a_bt,
    arg_min(ref, (sec, event_id)) FILTER (WHERE rl = 'A') AS a_ref,
    arg_min(bref, (sec, event_id)) FILTER (WHERE rl = 'A') AS a_bref,
    arg_min(ipint, (sec, event_id)) FILTER (WHERE rl = 'A') AS a_ip,
    arg_min(sec, (sec, event_id)) FILTER (WHERE rl = 'E') AS e_sec,
    arg_min(ipint, (sec, event_id)) FILTER (WHERE rl = 'E') AS e_ip,
    arg_min(sec, (sec, event_id)) FILTER (WHERE rl = 'C') AS c_sec,
    arg_min(ipint, (sec, event_id)) FILTER (WHERE rl = 'C') AS c_ip
  FROM m GROUP BY is_ssp, d, slot, expid
),
f AS (
  SELECT
    a_uid AS uid, expid,
    CAST(CASE WHEN is_ssp THEN 3 ELSE 0 END AS TINYINT) AS tn,
    a_sec AS sec,
    CAST(CASE WHEN is_ssp AND e_sec IS NOT NULL THEN date_diff('second', a_sec, e_sec) ELSE 0 END AS INTEGER) AS delta30,
    CAST(CASE WHEN NOT is_ssp AND c_sec IS NOT NULL THEN date_diff('second', a_sec, c_sec)
              WHEN is_ssp AND e_sec IS NOT NULL AND c_sec IS NOT NULL THEN date_diff('second', e_sec, c_sec)
              ELSE 0 END AS INTEGER) AS delta01,
    a_ref AS ref, a_sid AS sid, a_sz AS sz, a_bref AS bref, a_geo AS geo,
    CAST(CASE WHEN is_ssp THEN a_ip ELSE 0 END AS BIGINT) AS ipint_bid,
    CAST(CASE WHEN is_ssp THEN coalesce(e_ip, 0) ELSE a_ip END AS BIGINT) AS ipint_exp,
    CAST(coalesce(c_ip, 0) AS BIGINT) AS ipint_cl,
    a_bt AS bt, d
  FROM g WHERE n_a > 0
)"""

FUNNEL_COLS = ("uid, expid, tn, sec, delta30, delta01, ref, sid, sz, bref, geo, "
               "ipint_bid, ipint_exp, ipint_cl, bt, d")


def _funnel_sql(where: str = "") -> str:
    return with_h(f"SELECT {FUNNEL_COLS} FROM f {where}", FUNNEL_CTES)


SQL: dict[str, str] = {}

SQL["funnel_all"] = _funnel_sql()
SQL["funnel_repair"] = _funnel_sql()  # a repair gives the rows of a full build
SQL["funnel_nonssp"] = _funnel_sql("WHERE tn = 0")
SQL["funnel_ssp"] = _funnel_sql("WHERE tn = 3")


# --------------------------------------------------------------------------
# Scalar pieces in DuckDB form
# --------------------------------------------------------------------------

def _dom(x: str) -> str:
    return (f"regexp_replace(lower(regexp_extract({x}, '{_HOST}', 1)), '^www\\.', '')")


_HOST = r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/:?#]+)"


def _ip(x: str) -> str:
    return f"concat_ws('.', ({x} >> 24) & 255, ({x} >> 16) & 255, ({x} >> 8) & 255, {x} & 255)"


def _ip_or_empty(x: str) -> str:
    return f"CASE WHEN {x} = 0 THEN '' ELSE {_ip(x)} END"


def _strip(x: str) -> str:
    out = x
    for code in (10, 9, 39, 34, 92):  # newline, tab, ', ", backslash
        out = f"replace({out}, chr({code}), '')"
    return out


def _fingerprint(x: str) -> str:
    return f"md5(regexp_replace({x}, '[/?#]$', ''))"


def _repair(ref: str, sid: str) -> str:
    return (f"CASE WHEN {sid} = 197671 AND NOT contains({ref}, '://') THEN 'http://' || {ref} "
            f"WHEN {sid} = 187537 AND ends_with({ref}, '.google') THEN 'http://' || {ref} "
            f"ELSE {ref} END")


EVENT_COLS = ("uid, sec, expid, tn, sn, stn, ref, sid, sz, bref, geo, ipint, pz, bt, ad, net, "
              "exppr, winexppr, secondpr, floor, ddid, custom")

# --------------------------------------------------------------------------
# Funnel pieces
# --------------------------------------------------------------------------

SQL["funnel_flags"] = with_h(f"""
SELECT expid, d, sec, tn, {_dom('ref')} AS dom,
  {_ip_or_empty('ipint_bid')} AS ip_bid, {_ip_or_empty('ipint_exp')} AS ip_exp,
  {_ip_or_empty('ipint_cl')} AS ip_cl,
  CAST(CASE WHEN ipint_bid <> 0 THEN 1 ELSE 0 END AS TINYINT) AS has_bid,
  CAST(CASE WHEN ipint_exp <> 0 THEN 1 ELSE 0 END AS TINYINT) AS has_exp,
  CAST(CASE WHEN ipint_cl <> 0 THEN 1 ELSE 0 END AS TINYINT) AS has_cl
FROM f""", FUNNEL_CTES)

SQL["slot_assignment"] = with_h("""
SELECT event_id, CASE WHEN is_ssp THEN 'ssp' ELSE 'nonssp' END AS branch, d, CAST(slot AS INTEGER) AS slot
FROM m""", FUNNEL_CTES)

SQL["slot_assignment_table"] = SQL["slot_assignment"]

SQL["slot_assignment_many"] = with_h("""
SELECT b.d, CASE WHEN v.is_ssp THEN 'ssp' ELSE 'nonssp' END AS branch, CAST(k AS INTEGER) AS slot,
  count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids
FROM (
  SELECT *, CASE WHEN tn = 1 THEN 2 WHEN tn = 0 AND is_ssp THEN 1 ELSE 0 END AS rl FROM v WHERE tn IN (0, 1) OR is_ssp
) v JOIN (SELECT d, k FROM days, range(500) r(k)) b
  ON v.sec BETWEEN CAST(b.d AS TIMESTAMP) + to_seconds(k * 173)
           AND CAST(b.d AS TIMESTAMP) + to_seconds(k * 173 + 600 + (k * 37) % 7200 + rl * 60)
GROUP BY 1, 2, 3""", FUNNEL_CTES)

SQL["union_branches"] = with_h("""
SELECT event_id, CASE WHEN is_ssp THEN 'ssp' ELSE 'nonssp' END AS branch, tn,
  CASE WHEN tn = 1 THEN '' ELSE ref END AS ref,
  CASE WHEN tn = 1 THEN '' ELSE bref END AS bref
FROM v WHERE tn IN (0, 1) OR (is_ssp AND tn = 3)""", FUNNEL_CTES)

SQL["valid_events"] = with_h("""
SELECT event_id, expid, tn, sec, sid FROM h
WHERE sn = 0 AND expid <> 0 AND tn IN (0, 1, 3)""")

SQL["first_by_type"] = with_h("""
SELECT expid,
  coalesce(arg_min(sec, (sec, event_id)) FILTER (WHERE tn = 3), TIMESTAMP '1970-01-01 00:00:00') AS first_sec_bid,
  coalesce(arg_min(uid, (sec, event_id)) FILTER (WHERE tn = 3), 0) AS first_uid_bid,
  coalesce(arg_min(sec, (sec, event_id)) FILTER (WHERE tn = 0), TIMESTAMP '1970-01-01 00:00:00') AS first_sec_exp,
  coalesce(arg_min(uid, (sec, event_id)) FILTER (WHERE tn = 0), 0) AS first_uid_exp,
  coalesce(arg_min(sec, (sec, event_id)) FILTER (WHERE tn = 1), TIMESTAMP '1970-01-01 00:00:00') AS first_sec_cl,
  coalesce(arg_min(uid, (sec, event_id)) FILTER (WHERE tn = 1), 0) AS first_uid_cl
FROM h WHERE sn = 0 AND expid <> 0 AND tn IN (0, 1, 3)
GROUP BY expid""")

# --------------------------------------------------------------------------
# Cleaning and derived columns
# --------------------------------------------------------------------------

SQL["null_defaults"] = with_h("""
SELECT event_id, uid, sec,
  CAST(coalesce(CASE WHEN sn = 1 AND geo < 20 THEN NULL ELSE expid END, 0) AS BIGINT) AS expid,
  tn, sn,
  CAST(coalesce(CASE WHEN sn = 1 THEN NULL ELSE stn END, 0) AS TINYINT) AS stn,
  coalesce(CASE WHEN sn = 1 THEN NULL ELSE ref END, '') AS ref,
  CAST(coalesce(CASE WHEN sn = 1 THEN NULL ELSE sid END, 0) AS BIGINT) AS sid,
  CAST(coalesce(CASE WHEN sn = 1 THEN NULL ELSE sz END, 0) AS BIGINT) AS sz,
  bref,
  CAST(coalesce(CASE WHEN geo < 20 THEN NULL ELSE geo END, 0) AS INTEGER) AS geo,
  CAST(coalesce(CASE WHEN geo < 20 THEN NULL ELSE ipint END, 0) AS BIGINT) AS ipint,
  pz,
  CAST(coalesce(CASE WHEN geo < 20 THEN NULL ELSE bt END, 0) AS INTEGER) AS bt,
  ad, net,
  CAST(coalesce(CASE WHEN geo < 20 THEN NULL ELSE exppr END, 0) AS DOUBLE) AS exppr,
  winexppr, secondpr, floor, ddid,
  coalesce(CASE WHEN geo < 20 THEN NULL ELSE custom END, '') AS custom
FROM h""")

SQL["strip_breaking_chars"] = f"""
SELECT doc_id,
  CAST(length({_strip('text')}) AS BIGINT) AS clean_len,
  md5({_strip('text')}) AS clean_md5,
  CAST(length(text) - length({_strip('text')}) AS BIGINT) AS n_removed
FROM documents"""

SQL["scheme_repair"] = f"""
WITH r AS (
  SELECT page_id,
    CAST(CASE WHEN page_id % 3 = 0 THEN 197671 WHEN page_id % 3 = 1 THEN 187537 ELSE page_id END AS BIGINT) AS sid,
    CASE page_id % 4 WHEN 0 THEN url WHEN 1 THEN regexp_replace(url, '^[a-zA-Z]+://', '')
      WHEN 2 THEN url || '.google' ELSE '' END AS ref_in
  FROM pages
)
SELECT page_id, sid, ref_in, {_repair('ref_in', 'sid')} AS ref_out FROM r"""

SQL["url_domain"] = f"SELECT page_id, url, {_dom('url')} AS dom FROM pages"

SQL["url_fingerprint"] = f"SELECT page_id, {_fingerprint('url')} AS refhash FROM pages"

SQL["ipv4_text"] = with_h(f"SELECT event_id, ipint, {_ip('ipint')} AS ip FROM h")

_DERIVED = (f"{_dom('ref')} AS dom, {_fingerprint('ref')} AS refhash, CAST(sec AS DATE) AS d, "
            f"CAST(hour(sec) AS INTEGER) AS h")

SQL["event_enriched"] = with_h(f"""
SELECT event_id, {EVENT_COLS}, {_DERIVED}, {_ip('ipint')} AS ip FROM h""")

SQL["user_group_filter"] = with_h("""
SELECT event_id, uid, CAST(((uid % 256) + 256) % 256 + 1 AS BIGINT) AS ug FROM h
WHERE ((uid % 256) + 256) % 256 + 1 BETWEEN 1 AND 128""")

SQL["ingest_hour_slice"] = with_h(f"""
SELECT event_id, {EVENT_COLS.replace('ref, ', 'ref, ', 1)}, {_DERIVED} FROM (
  SELECT event_id, uid, sec, expid, tn, sn, stn,
    {_repair(_strip('ref'), 'sid')} AS ref, sid, sz, {_strip('bref')} AS bref, geo, ipint, pz, bt,
    ad, net, exppr, winexppr, secondpr, floor, ddid, {_strip('custom')} AS custom
  FROM h
  WHERE sec >= TIMESTAMP '2024-01-05 13:00:00' AND sec < TIMESTAMP '2024-01-05 14:00:00'
    AND ((uid % 256) + 256) % 256 + 1 BETWEEN 1 AND 128
) c""")

SQL["window_end"] = with_h("""
SELECT DISTINCT strftime(date_trunc('hour', sec), '%Y-%m-%dT%H:%M:%S') AS window_start,
  strftime(date_trunc('hour', sec) + INTERVAL 4 HOUR + INTERVAL 5 MINUTE - INTERVAL 1 SECOND,
           '%Y-%m-%dT%H:%M:%S') AS window_end
FROM h""")

SQL["sample_by_user"] = with_h("SELECT event_id, uid FROM h WHERE ((uid % 10) + 10) % 10 = 3")

_HOUR_KEY = r"(\d\d\d\d)\D+(\d\d)\D+(\d\d)\D+(\d\d)"

SQL["hour_key_from_path"] = with_h(f"""
SELECT path, make_timestamp(
    CAST(regexp_extract(path, '{_HOUR_KEY}', 1) AS BIGINT), CAST(regexp_extract(path, '{_HOUR_KEY}', 2) AS BIGINT),
    CAST(regexp_extract(path, '{_HOUR_KEY}', 3) AS BIGINT), CAST(regexp_extract(path, '{_HOUR_KEY}', 4) AS BIGINT),
    0, 0) AS src_hour
FROM (SELECT DISTINCT '../../reg_history_ref/' || strftime(sec, '%Y-%m-%d') || '/' || strftime(sec, '%H')
        || '_s1.txt' AS path FROM h) p""")

# --------------------------------------------------------------------------
# Profiles and membership
# --------------------------------------------------------------------------

SQL["volume_by_site_nonssp"] = with_h("""
SELECT CAST(sec AS DATE) AS d, sid, count(*) AS n FROM h
WHERE sn = 0 AND expid <> 0 AND sid NOT IN (SELECT sid FROM ssp)
GROUP BY 1, 2 ORDER BY 1, 2""")

SQL["volume_by_site_zone_ssp"] = with_h("""
SELECT CAST(sec AS DATE) AS d, sid, sz, count(*) AS n FROM h
WHERE sn = 0 AND expid <> 0 AND sid IN (SELECT sid FROM ssp)
GROUP BY 1, 2, 3 ORDER BY 1, 2, 3""")

SQL["exposure_trace"] = with_h("""
SELECT expid, sec, event_id, tn, sn, uid, sid, ref FROM h WHERE expid IN (7, 50, 123, 200)""")

SQL["uniq_users"] = with_h("""
SELECT sid, count(*) AS n, count(DISTINCT uid) AS users, true AS uniq_within_5_percent FROM h GROUP BY sid""")

# the dated SSP list: the newest version on or before a day names its sites
_VERSIONS = " UNION ALL ".join(
    f"SELECT CAST(n_nationkey AS BIGINT) AS sid, n_name AS name, DATE '{d}' AS d FROM nation "
    f"WHERE n_regionkey IN ({', '.join(map(str, regions))})" for d, regions in fx.SSP_VERSIONS)
_ON_LIST = ("EXISTS (SELECT 1 FROM versions x WHERE x.sid = {sid} AND x.d = (SELECT max(y.d) FROM versions y WHERE y.d <= {d}))")

SQL["volume_by_site_asof"] = with_h(f"""
SELECT d, sid, {_ON_LIST.format(sid='g.sid', d='g.d')} AS is_ssp, n FROM (
  SELECT CAST(sec AS DATE) AS d, sid, count(*) AS n FROM h WHERE sn = 0 AND expid <> 0 GROUP BY 1, 2
) g""", f"versions AS ({_VERSIONS})")

_ASOF_CTES = FUNNEL_CTES.replace("(h.sid IN (SELECT sid FROM ssp)) AS is_ssp", "0 AS unmarked").replace(
    "SELECT w.d, w.slot, v.*,", "SELECT w.d, w.slot, w.is_ssp, v.*,").replace(
    "CASE WHEN v.is_ssp THEN 3", "CASE WHEN w.is_ssp THEN 3").replace(
    "ON v.is_ssp = w.is_ssp AND v.tn = w.tn AND v.sec BETWEEN w.lo_ts AND w.hi_ts",
    "ON v.tn = w.tn AND v.sec BETWEEN w.lo_ts AND w.hi_ts\n"
    "  JOIN listed l ON l.d = w.d AND l.sid = v.sid AND l.on_list = w.is_ssp").replace(
    "sw(is_ssp,", f"versions AS ({_VERSIONS}),\nlisted AS (SELECT days.d, s.sid, {_ON_LIST.format(sid='s.sid', d='days.d')} AS on_list "
    "FROM days, (SELECT DISTINCT sid FROM v) s),\nsw(is_ssp,")
SQL["funnel_asof"] = with_h(f"SELECT {FUNNEL_COLS} FROM f", _ASOF_CTES)

SQL["ssp_validity"] = f"""
WITH versions AS ({_VERSIONS}),
loads AS (SELECT d, lead(d) OVER (ORDER BY d) AS nxt FROM (SELECT DISTINCT d FROM versions)),
p AS (SELECT v.*, loads.nxt, lag(loads.nxt) OVER (PARTITION BY sid ORDER BY v.d) AS prev FROM versions v JOIN loads USING (d)),
i AS (SELECT *, sum(CASE WHEN prev = d THEN 0 ELSE 1 END) OVER (PARTITION BY sid ORDER BY d) AS island FROM p)
SELECT sid, name, min(d) AS valid_from, arg_max(coalesce(nxt, DATE '9999-01-01'), d) AS valid_to, true AS forget
FROM i GROUP BY sid, name, island
UNION ALL SELECT sid, name, min(d), DATE '9999-01-01', false FROM versions GROUP BY sid, name
"""
SQL["ssp_validity"] = f"SELECT * REPLACE (nullif(valid_to, DATE '9999-01-01') AS valid_to) FROM ({SQL['ssp_validity']})"

SQL["site_subset"] = with_h("SELECT sid, count(*) AS n FROM h WHERE sid IN (3, 7, 12) GROUP BY sid")

SQL["site_zone_subset"] = with_h("""
SELECT sid, sz, count(*) AS n FROM h
WHERE (sid = 3 AND sz IN (1, 2)) OR sid = 7 OR (sid = 12 AND sz IN (0, 5))
GROUP BY sid, sz""")

SQL["day_completeness"] = with_h("""
SELECT CAST(sec AS DATE) AS d, count(DISTINCT hour(sec)) AS n_hours,
  count(DISTINCT hour(sec)) = 24 AS complete
FROM h GROUP BY 1""")

SQL["distinct_days"] = with_h("SELECT DISTINCT CAST(sec AS DATE) AS d FROM h")

# --------------------------------------------------------------------------
# Lifecycle
# --------------------------------------------------------------------------

_BIDS = """
bids AS (
  SELECT * FROM h WHERE sn = 0 AND expid <> 0 AND tn = 3 AND sid IN (SELECT sid FROM ssp)
),
hours AS (
  SELECT dd.d, CAST(g.h AS INTEGER) AS h
  FROM (SELECT DISTINCT CAST(sec AS DATE) AS d FROM h) dd, range(0, 24) g(h)
)"""

SQL["hour_present"] = with_h("""
SELECT hours.d, hours.h,
  EXISTS (SELECT 1 FROM bids b WHERE CAST(b.sec AS DATE) = hours.d AND hour(b.sec) = hours.h) AS present
FROM hours""", _BIDS)

SQL["missing_hours"] = with_h("""
SELECT hours.d, hours.h FROM hours
WHERE NOT EXISTS (SELECT 1 FROM bids b WHERE CAST(b.sec AS DATE) = hours.d AND hour(b.sec) = hours.h)""", _BIDS)

SQL["missing_days"] = with_h("""
SELECT CAST(g.d AS DATE) AS d
FROM generate_series(DATE '2024-01-07', DATE '2024-01-19', INTERVAL 1 DAY) g(d)
WHERE CAST(g.d AS DATE) NOT IN (
  SELECT DISTINCT CAST(sec AS DATE) FROM h
  WHERE CAST(sec AS DATE) NOT BETWEEN DATE '2024-01-10' AND DATE '2024-01-12')""")

SQL["need_fill"] = with_h("""
SELECT count(DISTINCT CAST(sec AS DATE)) AS n_days,
  count(DISTINCT CAST(sec AS DATE)) < 21 AS need_fill
FROM h""")

_RANKED = """
ranked AS (
  SELECT d, row_number() OVER (ORDER BY d DESC) AS age
  FROM (SELECT DISTINCT CAST(sec AS DATE) AS d FROM h) x
)"""

SQL["retention_expired_days"] = with_h("SELECT d FROM ranked WHERE age > 14", _RANKED)

SQL["retention_keep"] = with_h("""
SELECT CAST(sec AS DATE) AS d, count(*) AS n FROM h
WHERE CAST(sec AS DATE) IN (SELECT d FROM ranked WHERE age <= 14)
GROUP BY 1""", _RANKED)

SQL["excise_days"] = with_h("""
SELECT CAST(sec AS DATE) AS d, count(*) AS n FROM h
WHERE CAST(sec AS DATE) NOT BETWEEN DATE '2024-01-10' AND DATE '2024-01-12'
GROUP BY 1""")

SQL["shard_union"] = with_h("""
SELECT ug, CAST(CASE WHEN ug BETWEEN 1 AND 128 THEN 1 ELSE 2 END AS INTEGER) AS shard,
  count(*) AS n, CAST(sum(event_id) AS BIGINT) AS sum_event_id
FROM (SELECT CAST(((uid % 256) + 256) % 256 + 1 AS BIGINT) AS ug, event_id FROM h) x
GROUP BY ug""")

SQL["ssp_sites_load"] = """
WITH lines AS (
  SELECT CASE WHEN n_regionkey IN (0, 1) THEN '' ELSE 'x' END || CAST(n_nationkey AS VARCHAR)
    || repeat(chr(9), 1 + n_nationkey % 3) || n_name AS line
  FROM nation
),
parts AS (
  SELECT string_split(regexp_replace(line, '\\t+', chr(9), 'g'), chr(9)) AS p FROM lines
)
SELECT TRY_CAST(trim(p[1]) AS BIGINT) AS sid, p[2] AS name, DATE '2024-01-31' AS d
FROM parts WHERE len(p) = 2 AND TRY_CAST(trim(p[1]) AS BIGINT) IS NOT NULL"""

SQL["publish_reconcile"] = with_h("""
SELECT d, h, before, staged, r AS "replace",
  CASE WHEN before = 0 THEN 'write' WHEN r THEN 'replace' WHEN before = staged THEN 'replay' ELSE 'refuse' END AS action,
  CASE WHEN before = 0 OR r THEN staged ELSE before END AS "after",
  before = 0 OR r OR before = staged AS ok
FROM (
  SELECT CAST(sec AS DATE) AS d, CAST(hour(sec) AS INTEGER) AS h, count(*) AS staged,
    count(*) FILTER (WHERE hour(sec) % 3 = 2 OR (hour(sec) % 3 = 1 AND event_id % 2 = 0)) AS before
  FROM h WHERE CAST(sec AS DATE) = DATE '2024-01-10' GROUP BY 1, 2
) x CROSS JOIN (VALUES (false), (true)) t(r)""")


def _line(uid: str = "CAST(uid AS VARCHAR)", sid: str = "CAST(sid AS VARCHAR)", ref: str = "ref",
          bref: str = "bref", custom: str = "custom", first: int = 1, last: int = 22) -> str:
    """Tab-joined fields ``first`` to ``last`` of an event, null as nothing."""
    shown = {"uid": uid, "sid": sid, "ref": ref, "bref": bref, "custom": custom,
             "sec": "strftime(sec, '%Y-%m-%d %H:%M:%S')"}
    cols = [shown.get(c, f"CAST({c} AS VARCHAR)") for c in EVENT_COLS.replace(" ", "").split(",")]
    return " || chr(9) || ".join(f"coalesce({c}, '')" for c in cols[first - 1:last])


_UNSIGNED = "CAST(CAST({0} AS HUGEINT) + CASE WHEN {1} THEN 9223372036854775808 ELSE 0 END AS VARCHAR)"
_FEED_UID = _UNSIGNED.format("uid", "event_id % 11 = 0")

SQL["load_accounting"] = with_h("""
SELECT src_hour, count(*) AS lines,
  count(*) FILTER (WHERE class = 'loaded') AS loaded, count(*) FILTER (WHERE class = 'rejected') AS rejected,
  count(*) FILTER (WHERE class = 'no_key') AS no_key, count(*) FILTER (WHERE class = 'stray') AS stray,
  count(*) FILTER (WHERE class = 'other_groups') AS other_groups
FROM (
  SELECT date_trunc('hour', sec) + CASE WHEN event_id % 23 = 0 THEN INTERVAL 1 HOUR ELSE INTERVAL 0 HOUR END AS src_hour,
    CASE WHEN event_id % 13 = 0 THEN 'rejected' WHEN event_id % 17 = 0 THEN 'no_key'
         WHEN event_id % 19 = 0 THEN 'rejected' WHEN event_id % 23 = 0 THEN 'stray'
         WHEN uid % 256 < 128 THEN 'loaded' ELSE 'other_groups' END AS class
  FROM h
) x GROUP BY src_hour""")

SQL["reconcile_diff"] = with_h("""
, a AS (SELECT event_id, geo, CAST(sec AS DATE) AS d FROM h),
s AS (SELECT event_id, CASE WHEN day(d) <= 20 AND event_id % 17 = 0 THEN geo + 1 ELSE geo END AS geo, d FROM a,
        range(CASE WHEN day(d) > 20 THEN 1 WHEN event_id % 11 = 0 THEN 0 WHEN event_id % 13 = 0 THEN 3 ELSE 1 END) r)
SELECT *, 'missing' AS side, count(*) AS n FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM s) GROUP BY ALL
UNION ALL SELECT *, 'added' AS side, count(*) AS n FROM (SELECT * FROM s EXCEPT ALL SELECT * FROM a) GROUP BY ALL""")

SQL["publish_day"] = with_h("""
SELECT run, h, CASE WHEN run = 1 THEN 0 ELSE n END AS before, n AS staged, n AS after,
  CASE WHEN run = 1 THEN 'write' ELSE 'replay' END AS action, n AS held, ids
FROM (SELECT CAST(hour(sec) AS INTEGER) AS h, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids
      FROM h WHERE CAST(sec AS DATE) = DATE '2024-01-05' GROUP BY 1), (SELECT unnest([1, 2]) AS run)""")

# a day is built when it is complete, and repaired once the first hours of the next have come
SQL["backfill_days"] = with_h("""
SELECT run, b.d, CASE WHEN run = 2 THEN '' WHEN b.d < DATE '2024-01-06' THEN 'built,repaired' ELSE 'built' END AS done, rows,
  (SELECT count(*) FROM h WHERE CAST(sec AS DATE) = b.d) AS events
FROM (SELECT unnest([1, 2]) AS run),
  (SELECT d, count(*) AS rows FROM f WHERE d BETWEEN DATE '2024-01-05' AND DATE '2024-01-06' GROUP BY d) b""",
  FUNNEL_CTES)

SQL["load_in_parts"] = with_h("""
SELECT '/in/' || strftime(src_hour, '%Y-%m-%d/%H') || '_p' || part || name AS path, src_hour, lines,
  CASE WHEN name = '_again.txt' THEN 'duplicate' WHEN day(src_hour) % 3 <> 0 THEN 'new'
       WHEN part <> 1 OR even = lines THEN 'known' WHEN even = 0 THEN 'new' ELSE 'changed' END AS state
FROM (
  SELECT date_trunc('hour', sec) AS src_hour, event_id % 3 AS part, count(*) AS lines,
    count(*) FILTER (WHERE event_id % 2 = 0) AS even,
    unnest(CASE WHEN event_id % 3 = 0 THEN ['.txt', '_again.txt'] ELSE ['.txt'] END) AS name
  FROM h GROUP BY 1, 2, 5
) x""")

SQL["tsv_rejects"] = with_h(f"""
SELECT event_id, event_id % 13 = 0 OR (event_id % 17 <> 0 AND event_id % 19 = 0) AS rejected,
  CASE WHEN event_id % 13 = 0 THEN {_line(uid=_FEED_UID, last=5)}
  WHEN event_id % 17 <> 0 AND event_id % 19 = 0 THEN {_line(uid=_FEED_UID, last=3)} || chr(9) || '300' || chr(9) || {_line(first=5)} END AS value
FROM h""")

_ODD_UID, _ODD_SID = (_UNSIGNED.format(c, "event_id % 2 = 0") for c in ("uid", "sid"))
_ODD = {"ref": "' ' || ref || ' '", "bref": "bref || chr(13)", "custom": "'a' || chr(13) || 'b '"}
_WRAPPED = "CASE WHEN event_id % 2 = 0 THEN CAST(CAST({0} AS HUGEINT) - 9223372036854775808 AS BIGINT) ELSE {0} END"


def _odd_columns() -> str:
    out = []
    for c in EVENT_COLS.replace(" ", "").split(","):
        value = _ODD.get(c) or (_WRAPPED.format(c) if c in ("uid", "sid") else
                                "coalesce(geo, CAST(0 AS INTEGER))" if c == "geo" else c)
        out.append(f"{value} AS {c}")
    return ", ".join(out)


SQL["tsv_round_trip"] = with_h(f"""
SELECT event_id, md5({_line(uid=_ODD_UID, sid=_ODD_SID, **_ODD)}) AS line_md5, {_ODD_UID} AS uid_text, false AS rejected, {_odd_columns()}
FROM h""")

SQL["funnel_day"] = _funnel_sql("WHERE d = DATE '2024-01-05'")

SQL["day_membership"] = with_h("""
SELECT event_id, sec FROM h
WHERE sec >= TIMESTAMP '2024-01-05 00:00:00' AND sec < TIMESTAMP '2024-01-06 02:00:00'""")
