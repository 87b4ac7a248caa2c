"""Oracle SQL for DuckDB: the same queries as :mod:`learnmetrics.plans.catalog`, written
independently in plain SQL over the benchmark tables (registered as views by name).

Money is compared as double (decimal sums cast at the end), counts as bigint.
"""

from __future__ import annotations

from learnmetrics.plans.views import EVENT_KEYS, IP_SLOT, LOAD_DATE, LOAD_DAY, SEGMENTS

_SEGS = "[" + ", ".join(f"'{s}'" for s in SEGMENTS) + "]"
TAB = "chr(9)"

# --- views ---------------------------------------------------------------------------

MEMBER = f"""
member AS (
  SELECT c_custkey AS uid, CASE WHEN c_acctbal < 0 THEN -1 - c_custkey ELSE c_custkey * 4 // 3 END AS ad_id,
         CAST(NULL AS VARCHAR) AS birthday,
         'u' || CAST(c_custkey AS VARCHAR) || '@mail.example' AS email,
         substr(c_name, 1, 1) || 'xx' AS fullname,
         'http://icon.example/' || CAST(c_custkey AS VARCHAR) AS iconurl,
         CAST(NULL AS VARCHAR) AS lastlogin, CAST(NULL AS VARCHAR) AS mailaddr,
         CAST(c_custkey % 8 + 1 AS VARCHAR) AS memberlevel, '******' AS password,
         '138*****' || substr(lpad(CAST(c_custkey AS VARCHAR), 8, '0'), 5, 4) AS phone,
         CAST(NULL AS VARCHAR) AS qq,
         CAST(DATE '2019-01-01' + CAST(c_custkey % 365 AS INTEGER) AS VARCHAR) AS register,
         CAST(NULL AS VARCHAR) AS regupdatetime, CAST(NULL AS VARCHAR) AS unitname,
         CAST(NULL AS VARCHAR) AS userip, CAST(NULL AS VARCHAR) AS zipcode,
         '{LOAD_DATE}' AS time, c_mktsegment AS website
  FROM customer)"""

REGTYPE = f"""
regtype AS (
  SELECT CASE WHEN c_acctbal <= 9000 THEN c_custkey END AS uid, CAST(NULL AS VARCHAR) AS appkey,
         'http://reg_' || CAST(c_custkey % 10 AS VARCHAR) AS appregurl,
         CAST(NULL AS VARCHAR) AS bdp_uuid, '{LOAD_DAY}' AS createtime, CAST(NULL AS VARCHAR) AS domain,
         CAST(NULL AS VARCHAR) AS isranreg, CAST(c_custkey % 6 AS VARCHAR) AS regsource,
         CASE c_custkey % 6 WHEN 1 THEN 'PC' WHEN 2 THEN 'Mobile' WHEN 3 THEN 'App'
              WHEN 4 THEN 'WeChat' ELSE 'other' END AS regsourcename,
         c_nationkey + CASE WHEN c_acctbal > 8000 THEN 100 ELSE 0 END AS websiteid, c_mktsegment AS website
  FROM customer)"""

AD = f"""
ad AS (SELECT p_partkey AS adid, p_name AS adname, unnest({_SEGS}) AS website FROM part)"""

SITE = f"""
site AS (
  SELECT n_nationkey AS siteid, n_name AS sitename, 'www.' || lower(n_name) || '.com' AS siteurl,
         0 AS delete, '{LOAD_DAY}' AS createtime, 'admin' AS creator, unnest({_SEGS}) AS website
  FROM nation)"""

VIP = f"""
vip AS (
  SELECT r_regionkey + 1 AS vip_id, r_name AS vip_level,
         '2019-0' || CAST(r_regionkey + 1 AS VARCHAR) || '-01' AS start_time,
         '2020-0' || CAST(r_regionkey + 1 AS VARCHAR) || '-01' AS end_time,
         '2019-1' || CAST(r_regionkey + 1 AS VARCHAR) || '-01' AS last_modify_time,
         CAST((r_regionkey + 1) * 10 AS VARCHAR) AS max_free, CAST(r_regionkey + 1 AS VARCHAR) AS min_free,
         'L' || CAST(r_regionkey + 2 AS VARCHAR) AS next_level, 'op' || CAST(r_regionkey + 1 AS VARCHAR) AS operator,
         unnest({_SEGS}) AS website
  FROM region)"""

PAYMENT = """
payment AS (
  SELECT o_custkey AS uid,
         CASE WHEN CAST(o_totalprice AS DECIMAL(12,2)) < 5000 THEN 'n/a'
              WHEN CAST(o_totalprice AS DECIMAL(12,2)) > 400000 THEN CAST(CAST(o_totalprice AS DECIMAL(12,2)) * 10 AS VARCHAR)
              ELSE CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) END AS paymoney,
         c_nationkey AS siteid,
         TRY_CAST(substr(o_orderpriority, 1, 1) AS INTEGER) + CASE WHEN o_orderstatus = 'P' THEN 10 ELSE 0 END AS vip_id,
         strftime(o_orderdate, '%Y%m%d') AS time, c_mktsegment AS website
  FROM orders JOIN customer ON o_custkey = c_custkey)"""

WIDE_SELECT = """
  SELECT m.uid, min(m.ad_id) AS ad_id, min(m.fullname) AS fullname, min(m.iconurl) AS iconurl,
         min(m.lastlogin) AS lastlogin, min(m.mailaddr) AS mailaddr, min(m.memberlevel) AS memberlevel,
         min(m.password) AS password, {money} AS paymoney, min(m.phone) AS phone, min(m.qq) AS qq,
         min(m.register) AS register, min(m.regupdatetime) AS regupdatetime, min(m.unitname) AS unitname,
         min(m.userip) AS userip, min(m.zipcode) AS zipcode, min(m.time) AS time,
         min(b.appkey) AS appkey, min(b.appregurl) AS appregurl, min(b.bdp_uuid) AS bdp_uuid,
         min(b.createtime) AS reg_createtime, min(b.domain) AS domain, min(b.isranreg) AS isranreg,
         min(b.regsource) AS regsource, min(b.regsourcename) AS regsourcename, min(c.adname) AS adname,
         min(d.siteid) AS siteid, min(d.sitename) AS sitename, min(d.siteurl) AS siteurl,
         min(d.delete) AS site_delete, min(d.createtime) AS site_createtime, min(d.creator) AS site_creator,
         min(f.vip_id) AS vip_id, max(f.vip_level) AS vip_level, min(f.start_time) AS vip_start_time,
         max(f.end_time) AS vip_end_time, max(f.last_modify_time) AS vip_last_modify_time,
         arg_min(f.max_free, f.vip_id) AS vip_max_free, arg_min(f.min_free, f.vip_id) AS vip_min_free,
         max(f.next_level) AS vip_next_level, arg_min(f.operator, f.vip_id) AS vip_operator, m.website
  FROM member m
  LEFT JOIN regtype b ON m.uid = b.uid AND m.website = b.website
  LEFT JOIN ad c ON m.ad_id = c.adid AND m.website = c.website
  LEFT JOIN site d ON b.websiteid = d.siteid AND b.website = d.website
  LEFT JOIN payment e ON m.uid = e.uid AND m.website = e.website
  LEFT JOIN vip f ON e.vip_id = f.vip_id AND e.website = f.website
  GROUP BY m.uid, m.website"""

_MONEY_SUM = "sum(TRY_CAST(e.paymoney AS DECIMAL(20,4)))"

WIDE = "wide AS (" + WIDE_SELECT.format(money=_MONEY_SUM) + ")"
# The API form: ids of the left side of each join, the next level of the row that gives the level id.
WIDE_API = "wide AS (" + WIDE_SELECT.format(money=f"coalesce({_MONEY_SUM}, 0)").replace(
    "min(d.siteid) AS siteid", "min(b.websiteid) AS siteid"
).replace("min(f.vip_id) AS vip_id", f"(min(CASE WHEN e.uid IS NOT NULL THEN {{'u': f.vip_id IS NULL, 'v': e.vip_id}} END)).v AS vip_id").replace(
    "max(f.next_level) AS vip_next_level", "arg_min(f.next_level, f.vip_id) AS vip_next_level"
) + ")"

MEMBER_VIEWS = [MEMBER, REGTYPE, AD, SITE, VIP, PAYMENT]

# Behaviour events: epoch seconds (naive timestamps read as UTC), the rendered fields.
EV = f"""
ev AS (
  SELECT event_id, user_id, event_type, value,
         epoch_us(ts) // 1000000 AS epoch,
         TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
         (user_id * 2654435761) % 4294967296 AS ip,
         CASE event_type {' '.join(f"WHEN '{t}' THEN '{v}'" for t, v in EVENT_KEYS.items())} END AS event_key
  FROM events)"""

IP_RANGES = f"""
ip_ranges AS (
  SELECT CAST(n_nationkey AS BIGINT) * {IP_SLOT} + CAST(n_nationkey AS BIGINT) * 7919 AS lo,
         CAST(n_nationkey AS BIGINT) * {IP_SLOT} + CAST(n_nationkey AS BIGINT) * 7919 + 100000000
           + CAST(n_nationkey AS BIGINT) * 1000003 AS hi,
         n_name AS region
  FROM nation)"""


def _local_day(epoch: str, tz_hours: int = 8) -> str:
    return f"(DATE '1970-01-01' + CAST(floor(({epoch} + {tz_hours * 3600}) / 86400) AS INTEGER))"


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


# --- queries --------------------------------------------------------------------------

def _headcount(dim: str) -> str:
    return _with(*MEMBER_VIEWS, WIDE) + f"SELECT {dim}, count(uid) AS num, website FROM wide GROUP BY {dim}, website"


HEADCOUNT_DIMS = ["appregurl", "sitename", "regsourcename", "adname", "memberlevel", "vip_level"]


def _headcount_all() -> str:
    parts = [
        f"SELECT '{d}' AS dimension, CAST({d} AS VARCHAR) AS value, count(uid) AS num, website "
        f"FROM wide GROUP BY {d}, website"
        for d in HEADCOUNT_DIMS
    ]
    return _with(*MEMBER_VIEWS, WIDE) + "\nUNION ALL\n".join(parts)


def _top(asc: bool, money: str = "DECIMAL(20,4)") -> str:
    order = "ASC NULLS FIRST" if asc else "DESC NULLS LAST"
    return _with(*MEMBER_VIEWS, WIDE) + f"""
SELECT uid, memberlevel, register, appregurl, regsourcename, adname, sitename, vip_level,
       CAST(TRY_CAST(paymoney AS {money}) AS DOUBLE) AS paymoney, CAST(rownum AS INTEGER) AS rownum, website
FROM (SELECT *, row_number() OVER (PARTITION BY website, memberlevel ORDER BY
        TRY_CAST(paymoney AS {money}) {order}, uid ASC) AS rownum FROM wide) t
WHERE rownum <= 3"""


DAY_INCREMENT = """
inc AS (
  SELECT e.uid, sum(TRY_CAST(e.paymoney AS DECIMAL(20,4))) AS paymoney, max(f.vip_level) AS vip_level,
         substr(e.time, 1, 4) || '-' || substr(e.time, 5, 2) || '-' || substr(e.time, 7, 2) AS start_time,
         '9999-12-31' AS end_time, e.website
  FROM payment e JOIN vip f ON e.vip_id = f.vip_id AND e.website = f.website
  GROUP BY e.uid, e.website, e.time)"""

# The merge of days from the middle one on into a history that already holds the middle
# day, closing only each key's second-newest row: every other row keeps its stored end.
_ZIPPER_LAST = """,
mid AS (
  SELECT CAST(min(CAST(start_time AS DATE)) + CAST((max(CAST(start_time AS DATE)) - min(CAST(start_time AS DATE))) // 2 AS INTEGER)
         AS VARCHAR) AS day FROM inc),
history AS (
  SELECT uid, paymoney, vip_level, start_time, website,
         coalesce(lead(start_time) OVER (PARTITION BY uid, website ORDER BY start_time), '9999-12-31') AS end_time
  FROM inc, mid WHERE start_time <= mid.day),
merged AS (
  SELECT uid, paymoney, vip_level, start_time, website, end_time FROM history
  WHERE start_time NOT IN (SELECT start_time FROM inc, mid WHERE start_time >= mid.day)
  UNION ALL
  SELECT uid, paymoney, vip_level, start_time, website, end_time FROM inc, mid WHERE start_time >= mid.day)
SELECT uid, CAST(paymoney AS DOUBLE) AS paymoney, vip_level, start_time,
       CASE WHEN row_number() OVER (PARTITION BY uid, website ORDER BY start_time DESC) = 2
            THEN lead(start_time) OVER (PARTITION BY uid, website ORDER BY start_time) ELSE end_time END AS end_time,
       website
FROM merged"""

_ZIPPER_OUT = """
SELECT uid, CAST(paymoney AS DOUBLE) AS paymoney, vip_level, start_time,
       coalesce(lead(start_time) OVER (PARTITION BY uid, website ORDER BY start_time), '9999-12-31') AS end_time,
       website
FROM inc"""

_WIDE_OUT_COLS = """uid, ad_id, fullname, iconurl, lastlogin, mailaddr, memberlevel, password,
  CAST(paymoney AS DOUBLE) AS paymoney, phone, qq, register, regupdatetime, unitname, userip, zipcode, time,
  appkey, appregurl, bdp_uuid, reg_createtime, domain, isranreg, regsource, regsourcename, adname, siteid,
  sitename, siteurl, site_delete, site_createtime, site_creator, vip_id, vip_level, vip_start_time,
  vip_end_time, vip_last_modify_time, vip_max_free, vip_min_free, vip_next_level, vip_operator, website"""

_RAW_PHONE = "('138' || lpad(CAST(user_id AS VARCHAR), 8, '0'))"

CLEAN_EVENTS = _with(EV) + f"""
SELECT concat_ws({TAB},
  CAST(user_id AS VARCHAR), 'user' || CAST(user_id AS VARCHAR),
  CASE WHEN user_id % 2 = 0 THEN 'F' ELSE 'M' END, CAST(user_id % 2 + 1 AS VARCHAR), '0',
  CASE WHEN user_id % 3 = 0 THEN 'ios' ELSE 'android' END, 'toutiao', 'wifi',
  CAST((ip >> 24) & 255 AS VARCHAR) || '.' || CAST((ip >> 16) & 255 AS VARCHAR) || '.'
    || CAST((ip >> 8) & 255 AS VARCHAR) || '.' || CAST(ip & 255 AS VARCHAR),
  CASE WHEN value < 1 THEN '' WHEN value < 2 THEN '*****'
       ELSE substr({_RAW_PHONE}, 1, 3) || 'xxxx' || substr({_RAW_PHONE}, 8, 4) END,
  CAST(k % 2 AS VARCHAR), CAST(k AS VARCHAR), CAST(epoch AS VARCHAR),
  CAST(epoch + CAST(floor(value) AS BIGINT) AS VARCHAR), '1.0', event_key, CAST(epoch AS VARCHAR)) AS value
FROM ev WHERE event_type <> 'error'"""

DAILY_VIDEO_USERS = _with(EV) + f"""
SELECT count(DISTINCT CASE WHEN event_type = 'view' THEN user_id END) AS watch_video_count,
       count(DISTINCT CASE WHEN event_type = 'click' AND floor(value) >= k THEN user_id END) AS complete_video_count,
       strftime({_local_day('epoch')}, '%Y%m%d') AS dt
FROM ev WHERE event_type IN ('view', 'click')
GROUP BY 3"""

IP_REGION_JOIN = _with(EV, IP_RANGES) + """
SELECT ev.event_id, ev.user_id, ev.ip AS ip_num, coalesce(r.region, '未知') AS region
FROM ev LEFT JOIN ip_ranges r ON ev.ip BETWEEN r.lo AND r.hi"""

_VIP_TOTALS = """
totals AS (
  SELECT CAST({day} AS VARCHAR) AS dt, coalesce(r.region, '未知') AS province, count(*) AS cnt
  FROM ev LEFT JOIN ip_ranges r ON ev.ip BETWEEN r.lo AND r.hi
  WHERE ev.event_type = 'purchase'
  GROUP BY 1, 2)""".format(day=_local_day("ev.epoch"))

VIP_INCREMENT = _with(EV, IP_RANGES, _VIP_TOTALS) + "SELECT dt, province, cnt FROM totals"

VIP_INCREMENT_RECENT = _with(EV, IP_RANGES, _VIP_TOTALS) + """
SELECT dt, province, cnt FROM totals
WHERE epoch_ms(CAST(dt AS DATE)::TIMESTAMP) // 1000 - 28800 + 86400
      > (SELECT max(epoch) FROM ev WHERE event_type = 'purchase') - 2 * 86400"""

UNPAID_VISITORS = _with(EV) + """
, visits AS (
  SELECT user_id AS uid, epoch FROM ev
  WHERE event_type = 'signup'
    AND user_id NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'AUTOMOBILE'))
, win AS (
  SELECT uid, (CAST(floor(epoch / 43200) AS BIGINT) - i) * 43200 AS window_start
  FROM visits, range(0, 2) t(i))
SELECT uid, window_start, window_start + 86400 AS window_end, count(*) AS cnt
FROM win GROUP BY uid, window_start HAVING count(*) >= 3"""

INGEST_MEMBER = """
SELECT CAST(c_custkey AS INTEGER) AS uid,
       CASE WHEN c_nationkey = 22 THEN 0 ELSE CAST(c_custkey * 4 // 3 AS INTEGER) END AS ad_id,
       CAST(NULL AS VARCHAR) AS birthday, 'u' || CAST(c_custkey AS VARCHAR) || '@mail.example' AS email,
       CASE WHEN c_nationkey = 20 THEN NULL ELSE substr(c_name, 1, 1) || 'xx' END AS fullname,
       CAST(NULL AS VARCHAR) AS iconurl, CAST(NULL AS VARCHAR) AS lastlogin, CAST(NULL AS VARCHAR) AS mailaddr,
       CAST(c_custkey % 8 + 1 AS VARCHAR) AS memberlevel, '******' AS password, CAST(NULL AS VARCHAR) AS paymoney,
       CASE WHEN c_nationkey = 21 THEN '*****'
            ELSE '138*****' || substr(lpad(CAST(c_custkey AS VARCHAR), 8, '0'), 5, 4) END AS phone,
       CAST(NULL AS VARCHAR) AS qq, CAST(NULL AS VARCHAR) AS register, CAST(NULL AS VARCHAR) AS regupdatetime,
       CAST(NULL AS VARCHAR) AS unitname, CAST(NULL AS VARCHAR) AS userip, CAST(NULL AS VARCHAR) AS zipcode,
       '{d}' AS time, c_mktsegment AS website
FROM customer WHERE c_acctbal >= 0 AND c_nationkey <> 24""".format(d=LOAD_DATE)

INGEST_MEMBER_REJECTS = """
SELECT CASE WHEN c_acctbal < 0 THEN 'not_a_json_object' ELSE 'bad_int:ad_id' END AS reason,
       count(*) AS n, '{d}' AS time
FROM customer WHERE c_acctbal < 0 OR c_nationkey = 24
GROUP BY 1""".format(d=LOAD_DATE)

INGEST_REGTYPE = f"""
SELECT CAST(c_custkey AS INTEGER) AS uid, CAST(NULL AS VARCHAR) AS appkey,
       'http://reg_' || CAST(c_custkey % 10 AS VARCHAR) AS appregurl, CAST(NULL AS VARCHAR) AS bdp_uuid,
       '{LOAD_DAY}' AS createtime, 'www.site' || CAST(c_nationkey AS VARCHAR) || '.com' AS domain,
       CAST(NULL AS VARCHAR) AS isranreg,
       CASE WHEN c_nationkey = 0 THEN NULL ELSE CAST(c_custkey % 6 AS VARCHAR) END AS regsource,
       CASE WHEN c_nationkey = 0 THEN 'other' ELSE
         CASE c_custkey % 6 WHEN 1 THEN 'PC' WHEN 2 THEN 'Mobile' WHEN 3 THEN 'App'
              WHEN 4 THEN 'WeChat' ELSE 'other' END END AS regsourcename,
       c_nationkey AS websiteid, '{LOAD_DATE}' AS time, c_mktsegment AS website
FROM customer"""

INGEST_PAYMENT = f"""
SELECT CAST(o_custkey AS INTEGER) AS uid, CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) AS paymoney,
       CAST(o_orderkey % 25 AS INTEGER) AS siteid, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS vip_id,
       '{LOAD_DATE}' AS time, o_orderstatus AS website
FROM orders"""

INGEST_VIP_LEVEL = f"""
SELECT CAST(r_regionkey + 1 AS INTEGER) AS vip_id, r_name AS vip_level,
       '2019-0' || CAST(r_regionkey + 1 AS VARCHAR) || '-01' AS start_time,
       '2020-0' || CAST(r_regionkey + 1 AS VARCHAR) || '-01' AS end_time,
       CAST(NULL AS VARCHAR) AS last_modify_time, CAST(NULL AS VARCHAR) AS max_free, CAST(NULL AS VARCHAR) AS min_free,
       'L' || CAST(r_regionkey + 2 AS VARCHAR) AS next_level, CAST(NULL AS VARCHAR) AS operator,
       unnest({_SEGS}) AS website
FROM region"""

INGEST_BASE_AD = """
SELECT CAST(p_partkey AS INTEGER) AS adid, p_name AS adname, p_brand AS website
FROM part WHERE p_size <= 45"""

INGEST_BASE_AD_REJECTS = """
SELECT '{"adid":"ad' || CAST(p_partkey AS VARCHAR) || '","adname":"' || p_name || '","dn":"' || p_brand || '"}' AS value,
       'bad_int:adid' AS reason
FROM part WHERE p_size > 45"""

INGEST_BASE_WEBSITE = f"""
SELECT n_nationkey AS siteid, n_name AS sitename, 'www.' || lower(n_name) || '.com' AS siteurl,
       CASE WHEN n_nationkey = 0 THEN 0 ELSE n_regionkey % 2 END AS delete, '{LOAD_DAY}' AS createtime,
       'admin' AS creator, CAST(n_regionkey AS VARCHAR) AS website
FROM nation"""

INGEST_WXBOUND = f"""
SELECT CAST(c_custkey AS INTEGER) AS uid, 'un' || CAST(c_custkey AS VARCHAR) AS unionid,
       'op' || CAST(c_custkey AS VARCHAR) AS openid, c_name AS nickname, CAST(c_custkey % 2 AS VARCHAR) AS isdefault,
       CAST(NULL AS VARCHAR) AS headimgurl, CAST(NULL AS VARCHAR) AS boundtime,
       CAST(c_custkey % 3 AS INTEGER) AS bindsource, '{LOAD_DATE}' AS time, c_mktsegment AS website
FROM customer"""

MASK_MEMBERS = """
SELECT c_custkey AS uid, substr(c_name, 1, 1) || 'xx' AS fullname,
       '138*****' || substr(lpad(CAST(c_custkey AS VARCHAR), 8, '0'), 5, 4) AS phone,
       '138xxxx' || substr(lpad(CAST(c_custkey AS VARCHAR), 8, '0'), 5, 4) AS phone_behaviour,
       '******' AS password,
       CASE c_custkey % 6 WHEN 1 THEN 'PC' WHEN 2 THEN 'Mobile' WHEN 3 THEN 'App'
            WHEN 4 THEN 'WeChat' ELSE 'other' END AS regsourcename,
       c_mktsegment AS website
FROM customer"""

CLEAN_EVENTS_REJECTS = """
SELECT 16 AS n_fields, count(*) AS n FROM events WHERE event_type = 'error'"""

INGEST_WXTYPE = f"""
SELECT CAST(s_suppkey % 3 AS INTEGER) AS bind_source, 'wx' || CAST(s_suppkey AS VARCHAR) AS app_id,
       't' || CAST(s_suppkey AS VARCHAR) AS token_secret, s_name AS wx_name,
       CAST(s_nationkey AS VARCHAR) AS wx_no, 'admin' AS creator, '{LOAD_DAY}' AS createtime,
       CAST(s_nationkey % 5 AS VARCHAR) AS website
FROM supplier"""


ORDER_LEVELS = """
, facts AS (
  SELECT o_orderkey, o_custkey AS uid, c_mktsegment AS website,
         CAST(CAST(o_orderdate AS DATE) + CAST(o_orderkey % 60 - 30 AS INTEGER) AS VARCHAR) AS day
  FROM orders JOIN customer ON o_custkey = c_custkey)
SELECT f.*, i.vip_level AS valid_vip_level, i.start_time AS valid_start_time
FROM facts f ASOF LEFT JOIN inc i ON f.uid = i.uid AND f.website = i.website AND f.day >= i.start_time"""

# The first and the last day that hold any valid line.
_STORED_DAYS = _with(EV) + f"""
SELECT unnest([strftime(min({_local_day('epoch')}), '%Y%m%d'), strftime(max({_local_day('epoch')}), '%Y%m%d')])
FROM ev WHERE event_type <> 'error'"""

# A stream in append mode has put out the windows that end at or before its watermark.
UNPAID_CLOSED = UNPAID_VISITORS + """
AND window_start + 86400 <= (SELECT max(epoch) FROM ev WHERE event_type = 'signup')"""

VIDEO_USERS_BY_SPAN = _with(EV) + f"""
, video AS (SELECT *, {_local_day('epoch')} AS day FROM ev WHERE event_type IN ('view', 'click'))
SELECT span, CAST(CAST(date_trunc(span, CAST(day AS TIMESTAMP)) AS DATE) AS VARCHAR) AS span_start,
       count(DISTINCT CASE WHEN event_type = 'view' THEN user_id END) AS watch_video_count,
       count(DISTINCT CASE WHEN event_type = 'click' AND floor(value) >= k THEN user_id END) AS complete_video_count
FROM video, (VALUES ('week'), ('month')) s(span)
GROUP BY 1, 2
HAVING watch_video_count + complete_video_count > 0"""

IP_REGION_NESTED = _with(EV, IP_RANGES) + """
, nested AS (
  SELECT lo, hi, region FROM ip_ranges
  UNION ALL
  SELECT lo, least(lo + 40000 + (k % 13) * (k % 13) * (k % 13) * 30000, 4294967295), s_name
  FROM (SELECT s_suppkey::BIGINT AS k, s_suppkey::BIGINT * 1640531527 % 4294967296 AS lo, s_name FROM supplier))
SELECT ev.event_id, ev.user_id, ev.ip AS ip_num, coalesce(r.region, '未知') AS region
FROM ev LEFT JOIN nested r ON ev.ip BETWEEN r.lo AND r.hi
QUALIFY row_number() OVER (PARTITION BY ev.event_id ORDER BY r.hi - r.lo, r.lo, r.region) = 1"""

UNPAID_USERS = "WITH w AS (" + UNPAID_VISITORS.strip() + """)
SELECT uid, min(window_start) AS first_window_start, max(cnt) AS max_visits FROM w GROUP BY uid"""


def oracle_sql() -> dict[str, str]:
    q = {
        "ingest_member": INGEST_MEMBER,
        "ingest_member_rejects": INGEST_MEMBER_REJECTS,
        "ingest_regtype": INGEST_REGTYPE,
        "ingest_payment": INGEST_PAYMENT,
        "ingest_wxtype": INGEST_WXTYPE,
        "ingest_vip_level": INGEST_VIP_LEVEL,
        "ingest_base_ad": INGEST_BASE_AD,
        "ingest_base_ad_rejects": INGEST_BASE_AD_REJECTS,
        "ingest_base_website": INGEST_BASE_WEBSITE,
        "ingest_wxbound": INGEST_WXBOUND,
        "mask_members": MASK_MEMBERS,
        "clean_events_rejects": CLEAN_EVENTS_REJECTS,
        "top3_payers_legacy_money": _top(asc=False, money="DECIMAL(10,4)"),
        "zipper_close_last": _with(*MEMBER_VIEWS, DAY_INCREMENT) + _ZIPPER_LAST,
        "payment_money_rejects": _with(PAYMENT) + """
SELECT uid, paymoney, vip_id, time, website FROM payment
WHERE paymoney IS NOT NULL AND TRY_CAST(paymoney AS DECIMAL(20,4)) IS NULL""",
        "zipper_advance_open": _with(*MEMBER_VIEWS, DAY_INCREMENT) + _ZIPPER_OUT,
        "wide_member": _with(*MEMBER_VIEWS, WIDE) + f"SELECT {_WIDE_OUT_COLS} FROM wide",
        "wide_member_reference": _with(*MEMBER_VIEWS, WIDE) + f"SELECT {_WIDE_OUT_COLS} FROM wide",
        "wide_member_api": _with(*MEMBER_VIEWS, WIDE_API) + f"SELECT {_WIDE_OUT_COLS} FROM wide",
        "headcount_all": _headcount_all(),
        "top3_payers": _top(asc=False),
        "bottom3_payers": _top(asc=True),
        "zipper_day_increment": _with(*MEMBER_VIEWS, DAY_INCREMENT)
        + "SELECT uid, CAST(paymoney AS DOUBLE) AS paymoney, vip_level, start_time, end_time, website FROM inc",
        "zipper_close_out": _with(*MEMBER_VIEWS, DAY_INCREMENT) + _ZIPPER_OUT,
        "zipper_incremental": _with(*MEMBER_VIEWS, DAY_INCREMENT) + _ZIPPER_OUT,
        "clean_events": CLEAN_EVENTS,
        "daily_video_users": DAILY_VIDEO_USERS,
        "ip_region_join": IP_REGION_JOIN,
        "vip_increment_stream": VIP_INCREMENT,
        "vip_increment_recent": VIP_INCREMENT_RECENT,
        "unpaid_visitors_stream": UNPAID_VISITORS,
        "unpaid_visitors_batch": UNPAID_VISITORS,
        "unpaid_users_batch": UNPAID_USERS,
        "vip_totals_stream": VIP_INCREMENT_RECENT,
        "vip_totals_seeded_stream": VIP_INCREMENT,
        "unpaid_visitors_panes_stream": UNPAID_CLOSED,
        "unpaid_visitors_panes_batch": UNPAID_VISITORS,
        "stream_offset_ledger": "SELECT count(*) AS input_rows, 0::BIGINT AS late_rows, 0::BIGINT AS gaps FROM events",
        "video_users_by_span": VIDEO_USERS_BY_SPAN,
        "video_users_sketched": "SELECT *, TRUE AS watch_within, TRUE AS complete_within FROM (" + VIDEO_USERS_BY_SPAN + ")",
        "ip_region_nested": IP_REGION_NESTED,
        "ingest_member_variant": INGEST_MEMBER,
        "ingest_base_ad_variant_rejects": INGEST_BASE_AD_REJECTS,
        "ingest_member_counts": f"SELECT reason, n FROM ({INGEST_MEMBER_REJECTS}) UNION ALL SELECT 'rows', count(*) FROM ({INGEST_MEMBER})",
        "mask_members_sql": MASK_MEMBERS,
        "wide_member_bucketed": _with(*MEMBER_VIEWS, WIDE) + f"SELECT {_WIDE_OUT_COLS} FROM wide",
        "zipper_close_out_bucketed": _with(*MEMBER_VIEWS, DAY_INCREMENT) + _ZIPPER_OUT,
        "order_vip_level_as_of": _with(*MEMBER_VIEWS, DAY_INCREMENT) + ORDER_LEVELS,
        "payments_sized_files": _with(PAYMENT) + "SELECT coalesce(vip_id, -1)::INTEGER AS level, count(*) AS n, TRUE AS sized FROM payment GROUP BY 1",
        "job_ingest_rerun": INGEST_PAYMENT,
        "job_zipper_layers": _with(*MEMBER_VIEWS, DAY_INCREMENT.replace("e.time", "concat(substr(e.time, 1, 6), '01')")) + _ZIPPER_OUT,
        "job_behaviour_days": f"WITH d AS ({DAILY_VIDEO_USERS}) SELECT * FROM d WHERE dt IN ({_STORED_DAYS})",
    }
    for d in HEADCOUNT_DIMS:
        q[f"headcount_{d.replace('_', '')}"] = _headcount(d)
    return q
