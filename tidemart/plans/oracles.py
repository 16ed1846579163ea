"""The same questions as `queries`, in plain SQL for DuckDB over the same input tables.

Written from the definitions, with ranking windows and self-joins where the Spark
side uses aggregates, so that agreement means something.
"""

from __future__ import annotations


def _sid(*cols: str) -> str:
    """The number `stable_id` derives from text values."""
    joined = ", ".join(f"CAST({c} AS VARCHAR)" for c in cols)
    return f"CAST(('0x' || substr(md5(concat_ws('|', {joined})), 1, 15)) AS BIGINT)"


_SECOND = "'%Y-%m-%d %H:%M:%S'"
_LINE_ID = _sid(
    "l_orderkey",
    "l_linenumber",
    "l_partkey",
    "l_suppkey",
    "CAST(l_quantity AS BIGINT)",
    "CAST(round(l_extendedprice * 100) AS BIGINT)",
)
_LOGS = """logs AS (
  SELECT event_id AS log_id, CAST(user_id AS VARCHAR) AS mid, CAST(user_id AS VARCHAR) AS uid,
         CAST(user_id % 34 AS VARCHAR) AS ar, CAST(event_id % 5 AS VARCHAR) AS ch,
         CAST(event_id % 3 AS VARCHAR) AS vc,
         strftime(ts, '%Y-%m-%d') AS dt, strftime(ts, '%H') AS hr, strftime(ts, '%M') AS mi,
         epoch_us(ts) // 1000 AS ts, CASE WHEN event_type = 'signup' THEN event_type END AS start
  FROM events)"""
_FIRST = """first_logs AS (
  SELECT * FROM logs
  QUALIFY row_number() OVER (PARTITION BY mid, dt ORDER BY ts, log_id) = 1)"""
_DAU = f"{_LOGS}, {_FIRST}"
_DAU_COLS = "mid, uid, ar, ch, vc, dt, hr, mi, ts"
_LINES = """'{"common":{"mid":"' || mid || '","uid":"' || uid || '","ar":"' || ar || '","ch":"' || ch
  || '","vc":"' || vc || '"},' || CASE WHEN start IS NULL THEN '' ELSE '"start":"' || start || '",' END
  || '"ts":' || CAST(ts AS VARCHAR) || '}'"""
_TOPIC = "CASE WHEN start IS NULL THEN 'EVENT_LOG' ELSE 'START_LOG' END"

_PURCHASES = f"""purchases AS (
  SELECT event_id AS id, user_id, CAST(value AS DECIMAL(18,2)) AS amount,
         strftime(ts, {_SECOND}) AS create_time, strftime(ts, '%Y-%m-%d') AS dt,
         strftime(ts, '%H') AS hr
  FROM events WHERE event_type = 'purchase')"""
_FLAGGED = f"""{_PURCHASES}, flagged AS (
  SELECT *, CASE WHEN row_number() OVER (PARTITION BY user_id ORDER BY create_time, id) = 1
                 THEN '1' ELSE '0' END AS if_first_order
  FROM purchases)"""
_HOURLY = """hourly AS (
  SELECT dt, hr, CAST(sum(amount) AS DECIMAL(28,2)) AS v FROM purchases GROUP BY dt, hr)"""
_DAU_HOURLY = "hourly AS (SELECT dt, hr, count(*) AS v FROM first_logs GROUP BY dt, hr)"
_AXIS = """days AS (
  SELECT dt FROM hourly UNION
  SELECT strftime(CAST(dt AS DATE) + INTERVAL 1 DAY, '%Y-%m-%d') FROM hourly),
hours AS (SELECT lpad(CAST(h AS VARCHAR), 2, '0') AS hr FROM (SELECT unnest(range(0, 24)) AS h) AS u),
axis AS (SELECT dt, hr FROM days, hours)"""
_COMPARE = f"""{_AXIS}
SELECT a.dt, a.hr, coalesce(y.v, 0) AS yesterday, coalesce(t.v, 0) AS today
FROM axis a
LEFT JOIN hourly t ON t.dt = a.dt AND t.hr = a.hr
LEFT JOIN hourly y
  ON y.dt = strftime(CAST(a.dt AS DATE) - INTERVAL 1 DAY, '%Y-%m-%d') AND y.hr = a.hr"""

_ORDERS = f"""order_info AS (
  SELECT o_orderkey AS id, o_custkey AS user_id, o_orderstatus AS order_status,
         CAST(o_totalprice AS DECIMAL(18,2)) AS amount, o_orderdate AS placed,
         strftime(o_orderdate, {_SECOND}) AS create_time, strftime(o_orderdate, '%Y-%m-%d') AS dt
  FROM orders)"""
_DETAILS = f"""order_detail AS (
  SELECT {_LINE_ID} AS id, l_orderkey AS order_id, l_partkey AS sku_id,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS price, CAST(l_quantity AS BIGINT) AS num,
         l_linenumber AS line_no
  FROM lineitem)"""
_SPLIT = f"""{_ORDERS}, {_DETAILS}, lines AS (
  SELECT o.id AS order_id, d.id AS order_detail_id, o.dt, d.price, o.amount,
         CAST(o.amount * 100 AS BIGINT) AS total, CAST(d.price * 100 AS BIGINT) AS w,
         row_number() OVER (PARTITION BY o.id ORDER BY d.line_no DESC, d.id DESC) AS back,
         CAST(sum(CAST(d.price * 100 AS BIGINT)) OVER (PARTITION BY o.id) AS BIGINT) AS all_w
  FROM order_info o JOIN order_detail d ON d.order_id = o.id),
floors AS (
  SELECT *, CASE WHEN back = 1 OR all_w = 0 THEN 0 ELSE total * w // all_w END AS f FROM lines),
shares AS (
  SELECT *, CAST(CASE WHEN back = 1 THEN total - sum(f) OVER (PARTITION BY order_id) ELSE f END
                 AS DECIMAL(18,0)) / 100 AS share
  FROM floors),
split AS (
  SELECT order_id, order_detail_id, dt, price, amount,
         CAST(share AS DECIMAL(18,2)) AS final_detail_amount
  FROM shares)"""

_AGE = """CASE WHEN {years} < 20 THEN '20岁以下' WHEN {years} <= 30 THEN '20-30岁'
     WHEN {years} > 30 THEN '30岁以上' END"""


def _age(day: str, born: str) -> str:
    years = (
        f"(CAST(strftime({day}, '%Y') AS INTEGER) - CAST(strftime({born}, '%Y') AS INTEGER)"
        f" - CASE WHEN strftime({day}, '%m%d') < strftime({born}, '%m%d') THEN 1 ELSE 0 END)"
    )
    return _AGE.format(years=years)


_USERS = """users AS (
  SELECT c_custkey AS key, CAST(c_custkey AS VARCHAR) AS id, c_name AS name,
         make_date(1950 + c_custkey % 60, 1 + c_custkey % 12, 1 + c_custkey % 28) AS born,
         CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender
  FROM customer)"""
_PROVINCES = """provinces AS (
  SELECT n_nationkey AS key, CAST(n_nationkey AS VARCHAR) AS id, n_name AS name,
         r_name AS area_code, lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS iso_code,
         'N-' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS iso_3166_2
  FROM nation LEFT JOIN region ON r_regionkey = n_regionkey)"""
_SPUS = f"""spus AS (
  SELECT {_sid('p_name')} AS id, p_name AS spu_name, {_sid('p_brand')} AS tm_id,
         {_sid('p_type')} AS category3_id
  FROM part QUALIFY row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) = 1)"""
_ORDER_ROW = f"""'{{"id":' || o_orderkey || ',"user_id":' || o_custkey || ',"order_status":"' || STATUS
  || '","final_total_amount":' || CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR)
  || ',"create_time":"' || strftime(o_orderdate, {_SECOND}) || '"}}'"""
_ORDER_JSON = _ORDER_ROW.replace("STATUS", "o_orderstatus")
_SHIPPED_JSON = _ORDER_ROW.replace("STATUS", "'S'")
_OBJECT_ROUTES = f"""
SELECT 'ODS_ORDER_INFO' AS topic, {_ORDER_JSON} AS value FROM orders WHERE o_orderstatus = 'F'
UNION ALL
SELECT 'ODS_BASE_PROVINCE', '{{"id":"' || n_nationkey || '","name":"' || n_name || '"}}' FROM nation
UNION ALL
SELECT 'ODS_USER_INFO', '{{"id":"' || c_custkey || '","name":"' || c_name || '"}}'
FROM customer WHERE c_custkey % 10 <> 0 AND c_custkey % 7 <> 0"""


def _upsert(base: str, change: str, keys: str, versions: str, keep: str = "TRUE") -> str:
    return f"""WITH rows AS (
  SELECT *, 0 AS fresh FROM ({base}) AS b UNION ALL SELECT *, 1 AS fresh FROM ({change}) AS c),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY fresh DESC, {versions}) AS rn FROM rows)
SELECT * FROM ranked WHERE rn = 1 AND {keep}"""


def _pick(columns: str, sql: str) -> str:
    return f"SELECT {columns} FROM ({sql}) AS latest"


_KIND = "CASE {k} % 3 WHEN 0 THEN 'insert' WHEN 1 THEN 'update' ELSE 'delete' END"


def _joined(seconds: int) -> str:
    return f"""WITH {_ORDERS}, {_DETAILS}
SELECT o.id AS order_id, d.id AS order_detail_id, o.user_id, d.sku_id, d.price AS sku_price,
       d.num AS sku_num, o.amount AS final_total_amount, o.create_time, o.dt
FROM order_info o JOIN order_detail d ON d.order_id = o.id
WHERE o.placed + d.line_no * INTERVAL 5 SECONDS
      BETWEEN o.placed - INTERVAL {seconds} SECONDS AND o.placed + INTERVAL {seconds} SECONDS"""


_FLAG_SQL = f"WITH {_FLAGGED} SELECT id, user_id, create_time, if_first_order FROM flagged"
_DAU_SQL = f"WITH {_DAU} SELECT {_DAU_COLS} FROM first_logs"
_DAU_TOTAL = "SELECT dt, count(DISTINCT mid) AS n FROM logs GROUP BY dt"
_NEW_MIDS = "SELECT dt, count(*) AS n FROM (SELECT mid, min(dt) AS dt FROM logs GROUP BY mid) AS f GROUP BY dt"
_SHARE = """SELECT {c}, n, CAST(n AS DOUBLE) / sum(n) OVER () AS share
FROM (SELECT {c}, count(*) AS n FROM buyers GROUP BY {c}) AS g"""
_BUYERS = f"""{_ORDERS}, {_USERS}, last_orders AS (
  SELECT user_id, max(placed) AS placed FROM order_info GROUP BY user_id),
buyers AS (
  SELECT u.gender AS user_gender, {_age('l.placed', 'u.born')} AS user_age_group
  FROM last_orders l LEFT JOIN users u ON u.key = l.user_id)"""
_PROVINCE_SALES = f"""{_PROVINCES}, province_sales AS (
  SELECT p.name AS province_name,
         CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS sales, count(*) AS n
  FROM orders LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN provinces p ON p.key = c_nationkey
  GROUP BY p.name)"""

ORACLES: dict[str, str] = {
    "dau_info": f"WITH {_LOGS} SELECT {_DAU_COLS} FROM logs",
    "dau_first_log": _DAU_SQL,
    "dau_total": f"WITH {_LOGS} {_DAU_TOTAL}",
    "dau_hour_count": f"WITH {_DAU} SELECT dt, hr, count(*) AS n FROM first_logs GROUP BY dt, hr",
    "new_mid_total": f"WITH {_LOGS} {_NEW_MIDS}",
    "dau_hour_compare": f"WITH {_DAU}, {_DAU_HOURLY}, {_COMPARE}",
    "hour_axis_zero_fill": f"""WITH {_PURCHASES}, {_HOURLY}, {_AXIS}
SELECT a.dt, a.hr, coalesce(t.v, 0) AS order_amount
FROM axis a LEFT JOIN hourly t ON t.dt = a.dt AND t.hr = a.hr""",
    "hour_map": f"""WITH {_DAU}, {_DAU_HOURLY}
SELECT dt, string_agg(hr || '=' || CAST(v AS VARCHAR), ',' ORDER BY hr) AS hours FROM hourly GROUP BY dt""",
    "sliding_window_counts": f"""WITH w AS (
  SELECT time_bucket(INTERVAL 5 SECONDS, ts) - i * INTERVAL 5 SECONDS AS start
  FROM events, range(0, 3) AS r(i))
SELECT strftime(start, {_SECOND}) AS window_start,
       strftime(start + INTERVAL 15 SECONDS, {_SECOND}) AS window_end, count(*) AS n
FROM w GROUP BY start""",
    "order_time_parts": f"""WITH {_PURCHASES}
SELECT id, create_time, dt AS create_date, hr AS create_hour FROM purchases""",
    "first_order_flag": _FLAG_SQL,
    "first_order_stream": _FLAG_SQL,
    "first_order_job": _FLAG_SQL,
    "user_state": "SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS user_id, '1' AS if_consumed FROM orders",
    "orders_with_state": """SELECT o_orderkey AS id, o_custkey AS user_id,
       CASE WHEN o_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')
            THEN '1' ELSE '0' END AS if_consumed
FROM orders""",
    "order_wide": f"""WITH {_SPLIT}, {_USERS}, {_PROVINCES}, {_SPUS}, firsts AS (
  SELECT id, CASE WHEN row_number() OVER (PARTITION BY user_id ORDER BY create_time, id) = 1
                  THEN '1' ELSE '0' END AS flag
  FROM order_info)
SELECT d.id AS order_detail_id, o.id AS order_id, o.order_status, o.create_time, o.user_id,
       d.sku_id, d.price AS sku_price, d.num AS sku_num, p.p_name AS sku_name,
       CAST(0 AS DECIMAL(18,2)) AS benefit_reduce_amount, o.amount AS original_total_amount,
       CAST(0 AS DECIMAL(18,2)) AS feight_fee, o.amount AS final_total_amount,
       s.final_detail_amount, f.flag AS if_first_order, v.name AS province_name,
       v.area_code AS province_area_code, {_age('o.placed', 'u.born')} AS user_age_group,
       u.gender AS user_gender, o.dt, {_sid('p.p_name')} AS spu_id, {_sid('p.p_brand')} AS tm_id,
       {_sid('p.p_type')} AS category3_id, p.p_name AS spu_name, p.p_brand AS tm_name,
       p.p_type AS category3_name
FROM split s
JOIN order_info o ON o.id = s.order_id
JOIN order_detail d ON d.order_id = s.order_id AND d.id = s.order_detail_id
JOIN firsts f ON f.id = o.id
LEFT JOIN customer c ON c.c_custkey = o.user_id
LEFT JOIN users u ON u.key = o.user_id
LEFT JOIN provinces v ON v.key = c.c_nationkey
LEFT JOIN part p ON p.p_partkey = d.sku_id""",
    "order_wide_defaults": f"""WITH {_ORDERS}, {_DETAILS}
SELECT coalesce(d.id, 0) AS order_detail_id, coalesce(o.id, 0) AS order_id, o.order_status,
       o.create_time, coalesce(o.user_id, 0) AS user_id, coalesce(d.sku_id, 0) AS sku_id,
       coalesce(d.price, 0) AS sku_price, coalesce(d.num, 0) AS sku_num,
       CAST(NULL AS VARCHAR) AS sku_name, CAST(0 AS DECIMAL(18,2)) AS benefit_reduce_amount,
       coalesce(o.amount, 0) AS original_total_amount, CAST(0 AS DECIMAL(18,2)) AS feight_fee,
       coalesce(o.amount, 0) AS final_total_amount, CAST(0 AS DECIMAL(18,2)) AS final_detail_amount,
       CAST(NULL AS VARCHAR) AS if_first_order, CAST(NULL AS VARCHAR) AS province_name,
       CAST(NULL AS VARCHAR) AS province_area_code, CAST(NULL AS VARCHAR) AS user_age_group,
       CAST(NULL AS VARCHAR) AS user_gender, o.dt, CAST(0 AS BIGINT) AS spu_id,
       CAST(0 AS BIGINT) AS tm_id, CAST(0 AS BIGINT) AS category3_id,
       CAST(NULL AS VARCHAR) AS spu_name, CAST(NULL AS VARCHAR) AS tm_name,
       CAST(NULL AS VARCHAR) AS category3_name
FROM order_info o FULL JOIN order_detail d ON d.order_id = o.id""",
    "detail_amount_split": f"""WITH {_SPLIT}
SELECT order_id, order_detail_id, price AS sku_price, amount AS final_total_amount, final_detail_amount
FROM split""",
    "orders_without_detail": """SELECT o_orderkey AS id, o_custkey AS user_id,
       CAST(o_totalprice AS DECIMAL(18,2)) AS final_total_amount
FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)""",
    "details_per_order": """SELECT l_orderkey AS order_id, count(*) AS n_details,
       CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS sku_num
FROM lineitem GROUP BY l_orderkey""",
    "enrich_order_province": f"""WITH {_PROVINCES}
SELECT o_orderkey AS id, CAST(c_nationkey AS BIGINT) AS province_id, p.name AS province_name,
       p.area_code AS province_area_code, p.iso_3166_2 AS province_iso_3166_2
FROM orders LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN provinces p ON p.key = c_nationkey""",
    "enrich_order_user": f"""WITH {_ORDERS}, {_USERS}
SELECT o.id, o.user_id, o.dt AS create_date, u.gender AS user_gender,
       {_age('o.placed', 'u.born')} AS user_age_group
FROM order_info o LEFT JOIN users u ON u.key = o.user_id""",
    "enrich_detail_sku": f"""WITH {_DETAILS}
SELECT d.id, d.order_id, d.sku_id, p_name AS sku_name, {_sid('p_name')} AS spu_id,
       {_sid('p_brand')} AS tm_id, {_sid('p_type')} AS category3_id, p_name AS spu_name,
       p_brand AS tm_name, p_type AS category3_name
FROM order_detail d LEFT JOIN part ON p_partkey = d.sku_id""",
    "order_total_amount": f"""WITH {_SPLIT}
SELECT dt, CAST(sum(final_detail_amount) AS DECIMAL(28,2)) AS order_total_amount FROM split GROUP BY dt""",
    "order_hour_amount": f"WITH {_PURCHASES}, {_HOURLY} SELECT dt, hr, v AS order_amount FROM hourly",
    "order_hour_compare": f"WITH {_PURCHASES}, {_HOURLY}, {_COMPARE}",
    "realtime_total": f"""WITH {_LOGS}, {_PURCHASES}
SELECT dt, 'dau' AS id, '新增日活' AS name, CAST(n AS DECIMAL(28,2)) AS value FROM ({_DAU_TOTAL}) AS a
UNION ALL
SELECT dt, 'new_mid', '新增设备', CAST(n AS DECIMAL(28,2)) FROM ({_NEW_MIDS}) AS b
UNION ALL
SELECT dt, 'order_amount', '新增交易额', CAST(sum(amount) AS DECIMAL(28,2)) FROM purchases GROUP BY dt""",
    "gender_ratio": f"WITH {_BUYERS} {_SHARE.format(c='user_gender')}",
    "age_ratio": f"WITH {_BUYERS} {_SHARE.format(c='user_age_group')}",
    "province_sales": f"WITH {_PROVINCE_SALES} SELECT province_name, sales, n FROM province_sales",
    "province_sales_bins": f"""WITH {_PROVINCE_SALES}
SELECT CAST(least(5, n // 100) AS INTEGER) AS bin, count(*) AS n FROM province_sales GROUP BY 1""",
    "sales_by_name": """SELECT p_name AS sku_name, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS sales,
       count(*) AS n
FROM lineitem LEFT JOIN part ON p_partkey = l_partkey GROUP BY p_name""",
    "search_page": """WITH hits AS (
  SELECT p_partkey AS id, CAST(p_retailprice AS DECIMAL(18,2)) AS price, p_name AS sku_name
  FROM part WHERE CAST(p_retailprice AS DECIMAL(18,2)) >= 905)
SELECT id, price, sku_name, replace(sku_name, 'ring', '<em>ring</em>') AS highlighted,
       contains(sku_name, 'ring') AS matched, (SELECT count(*) FROM hits) AS total
FROM hits ORDER BY price, id LIMIT 20""",
    "sale_detail_page": f"""WITH {_ORDERS}, {_DETAILS}, hits AS (
  SELECT o.dt, o.id AS order_id, d.id AS order_detail_id, p_name AS sku_name
  FROM order_info o JOIN order_detail d ON d.order_id = o.id JOIN part ON p_partkey = d.sku_id
  WHERE contains(p_name, 'ring'))
SELECT *, replace(sku_name, 'ring', '<em>ring</em>') AS highlighted,
       (SELECT count(*) FROM hits) AS total
FROM hits ORDER BY dt, order_id, order_detail_id LIMIT 20 OFFSET 20""",
    "masked_users": f"""WITH {_USERS}
SELECT id, regexp_replace(regexp_replace(regexp_replace(name, '[A-Z]', 'X', 'g'), '[a-z]', 'x', 'g'),
                          '[0-9]', 'n', 'g') AS name,
       regexp_replace(strftime(born, '%Y-%m-%d'), '[0-9]', 'n', 'g') AS birthday, gender
FROM users""",
    "user_age_group": f"""WITH {_USERS}
SELECT id, strftime(born, '%Y-%m-%d') AS birthday,
       {_age("DATE '2001-08-01'", 'born')} AS age_group
FROM users""",
    "parse_orders": f"""WITH {_ORDERS}
SELECT id, CAST(NULL AS BIGINT) AS province_id, user_id, order_status,
       amount AS final_total_amount, create_time
FROM order_info""",
    "parse_app_log": f"WITH {_LOGS} SELECT mid, uid, ar, ch, vc, start, ts FROM logs",
    "orders_to_json": f"""WITH {_PURCHASES}
SELECT '{{"id":' || id || ',"user_id":' || user_id || ',"final_total_amount":' || CAST(amount AS VARCHAR)
       || ',"create_time":"' || create_time || '"}}' AS value
FROM purchases""",
    "route_app_log": f"WITH {_LOGS} SELECT {_TOPIC} AS topic, {_LINES} AS value FROM logs",
    "route_cdc_object": _OBJECT_ROUTES,
    "route_cdc_array": f"""
SELECT 'ODS_ORDER_INFO' AS topic, {_ORDER_JSON} AS value FROM orders WHERE o_orderstatus = 'F'
UNION ALL
SELECT 'ODS_ORDER_INFO', {_SHIPPED_JSON} FROM orders WHERE o_orderstatus = 'F'""",
    "topic_sink": _OBJECT_ROUTES,
    "topic_sink_keyed": f"""WITH {_FLAGGED}
SELECT 'DWD_ORDER_INFO' AS topic, CAST(id AS VARCHAR) AS key,
       '{{"id":' || id || ',"user_id":' || user_id || ',"create_time":"' || create_time
       || '","if_first_order":"' || if_first_order || '"}}' AS value
FROM flagged""",
    "topic_source": f"WITH {_LOGS} SELECT mid, start, ts FROM logs WHERE start IS NOT NULL",
    "sql_to_json_rows": """SELECT '{"c_custkey":' || c_custkey || ',"c_name":"' || c_name || '"'
       || CASE WHEN c_mktsegment = 'MACHINERY' THEN '' ELSE ',"segment":"' || c_mktsegment || '"' END
       || '}' AS json
FROM customer""",
    "dim_upsert_base_province": f"WITH {_PROVINCES} "
    + _pick(
        "id, version, name, area_code, iso_code, iso_3166_2",
        _upsert(
            "SELECT id, name, area_code, iso_code, iso_3166_2, CAST(NULL AS BIGINT) AS version FROM provinces",
            "SELECT CAST(c_nationkey AS VARCHAR), c_name, 'area', 'iso', 'iso2', c_custkey FROM customer",
            "id",
            "version DESC",
        ),
    ),
    "dim_upsert_user_info": f"WITH {_USERS} "
    + _pick(
        "id, changed, version, name, birthday, gender",
        _upsert(
            "SELECT id, name, strftime(born, '%Y-%m-%d') AS birthday, gender,"
            " CAST(NULL AS VARCHAR) AS changed, CAST(NULL AS BIGINT) AS version FROM users",
            "SELECT CAST(o_custkey AS VARCHAR), 'user of order ' || o_orderkey, CAST(NULL AS VARCHAR),"
            f" o_orderstatus, strftime(o_orderdate, {_SECOND}), o_orderkey FROM orders",
            "id",
            "changed DESC, version DESC",
        ),
    ),
    "dim_upsert_sku_info": _pick(
        "id, shipped, version, sku_name, price, weight",
        _upsert(
            "SELECT p_partkey AS id, p_name AS sku_name, CAST(p_retailprice AS DECIMAL(18,2)) AS price,"
            " CAST(p_size AS DOUBLE) AS weight, CAST(NULL AS INTEGER) AS shipped,"
            " CAST(NULL AS BIGINT) AS version FROM part",
            "SELECT l_partkey, CAST(NULL AS VARCHAR), CAST(l_extendedprice AS DECIMAL(18,2)), l_quantity,"
            f" CAST(CAST(l_shipdate AS DATE) - DATE '1970-01-01' AS INTEGER), {_LINE_ID} FROM lineitem",
            "id",
            "shipped DESC, version DESC",
        ),
    ),
    "dim_upsert_spu_info": _pick(
        "CAST(id AS VARCHAR) AS id, version, spu_name, tm_id, category3_id",
        _upsert(
            f"SELECT {_sid('p_name')} AS id, p_name AS spu_name, CAST(0 AS BIGINT) AS tm_id,"
            " CAST(0 AS BIGINT) AS category3_id, CAST(NULL AS BIGINT) AS version FROM part",
            f"SELECT {_sid('p_name')}, upper(p_name), {_sid('p_brand')}, {_sid('p_type')}, p_partkey FROM part",
            "id",
            "version DESC",
        ),
    ),
    "dim_upsert_base_trademark": _pick(
        "CAST(tm_id AS VARCHAR) AS tm_id, version, tm_name",
        _upsert(
            f"SELECT DISTINCT {_sid('p_brand')} AS tm_id, p_brand AS tm_name,"
            " CAST(NULL AS BIGINT) AS version FROM part",
            f"SELECT {_sid('p_brand')}, p_brand || '/' || p_name, p_partkey FROM part",
            "tm_id",
            "version DESC",
        ),
    ),
    "dim_upsert_base_category3": _pick(
        "CAST(id AS VARCHAR) AS id, version, name",
        _upsert(
            f"SELECT DISTINCT {_sid('p_type')} AS id, p_type AS name, CAST(NULL AS BIGINT) AS version,"
            " CAST('insert' AS VARCHAR) AS kind FROM part",
            f"SELECT {_sid('p_type')}, p_type || '/' || p_name, p_partkey,"
            f" {_KIND.format(k='p_partkey')} FROM part",
            "id",
            "version DESC",
            "kind <> 'delete'",
        ),
    ),
    "daily_index_dau": _DAU_SQL,
    "daily_index_orders": f"""WITH {_FLAGGED}
SELECT id, user_id, amount AS final_total_amount, if_first_order, dt FROM flagged""",
    "replay_idempotent": f"""WITH {_LOGS}
SELECT dt, count(*) AS n, CAST(sum(ts) AS BIGINT) AS ts_sum FROM logs GROUP BY dt""",
    "raw_log_archive": f"WITH {_LOGS} SELECT dt, {_LINES} AS value FROM logs",
    "order_wide_store": f"""WITH {_SPLIT}
SELECT dt, count(*) AS n, CAST(sum(final_detail_amount) AS DECIMAL(28,2)) AS final_detail_amount
FROM split GROUP BY dt""",
    "dau_stream": _DAU_SQL,
    "dau_stream_dedupe": f"WITH {_LOGS} SELECT DISTINCT dt, mid FROM logs",
    "order_wide_stream": _joined(15),
    "order_wide_buffered": _joined(600),
    "pair_dedupe_stream": f"SELECT DISTINCT l_orderkey AS order_id, {_LINE_ID} AS order_detail_id FROM lineitem",
    "resume_from_checkpoint": f"WITH {_LOGS} SELECT CAST(log_id AS VARCHAR) AS key, {_LINES} AS value FROM logs",
}

_SIDES = f"""{_ORDERS}, {_DETAILS}, timed AS (
  SELECT d.*, p.at AS order_at, p.at + line_no * INTERVAL 5 SECOND AS detail_at
  FROM order_detail d JOIN (SELECT o_orderkey, CAST(o_orderdate AS TIMESTAMP) AS at FROM orders) p ON d.order_id = p.o_orderkey)"""
ORACLES["order_wide_outer_stream"] = f"""
WITH {_SIDES}, placed AS (
  SELECT i.*, CAST(o_orderdate AS TIMESTAMP) AS at FROM order_info i JOIN orders ON id = o_orderkey)
SELECT CASE WHEN t.id IS NULL THEN 'order' WHEN o.id IS NULL THEN 'detail' ELSE 'both' END AS side,
       coalesce(o.id, t.order_id) AS order_id, coalesce(t.id, 0) AS order_detail_id,
       coalesce(t.price, CAST(0 AS DECIMAL(18, 2))) AS sku_price,
       coalesce(o.amount, CAST(0 AS DECIMAL(18, 2))) AS final_total_amount
FROM timed t FULL JOIN placed o
  ON t.order_id = o.id AND t.detail_at BETWEEN o.at - INTERVAL 15 SECOND AND o.at + INTERVAL 15 SECOND
"""
ORACLES["detail_amount_stream"] = ORACLES["detail_amount_split"]
# A set starts anew where its order was silent for over 600 seconds; a member passes once
# per life of the set.
ORACLES["pair_dedupe_renewed"] = f"""
WITH {_SIDES}, sent AS (
  SELECT order_id, id, detail_at + after * INTERVAL 1 SECOND AS seen
  FROM timed, (SELECT unnest([0, 500, 1000, 1200]) AS after)
  WHERE after NOT IN (1000, 1200) OR (after = 1200) = (order_id % 2 = 0)),
gaps AS (
  SELECT *, CASE WHEN seen > lag(seen) OVER (PARTITION BY order_id ORDER BY seen, id) + INTERVAL 600 SECOND
                 THEN 1 ELSE 0 END AS fresh FROM sent),
lives AS (
  SELECT *, sum(fresh) OVER (PARTITION BY order_id ORDER BY seen, id ROWS UNBOUNDED PRECEDING) AS life FROM gaps)
SELECT order_id, id AS order_detail_id, strftime(min(seen), {_SECOND}) AS seen_at
FROM lives GROUP BY order_id, id, life
"""

ORACLES["stored_offsets"] = """
SELECT 'LOG' AS topic, 'warehouse' AS group_id, CAST(later AS BIGINT) AS batch_id, 0 AS part,
       CAST(later AS BIGINT) AS "offset", count(*) AS n_rows
FROM (SELECT CASE WHEN ts < TIMESTAMP '2024-01-16' THEN 0 ELSE 1 END AS later FROM events) GROUP BY later
"""
ORACLES["topic_rejects"] = f"""
SELECT 'ODS_ORDER_INFO' AS topic, CASE WHEN o_orderkey % 7 <> 0 THEN o_orderkey END AS id,
       CASE WHEN o_orderkey % 7 = 0 THEN substr({_ORDER_JSON}, 1, 25) END AS value FROM orders
"""
ORACLES["late_rows"] = """
WITH sent AS (
  SELECT event_id AS log_id, CAST(user_id AS VARCHAR) AS mid, CAST(ts AS TIMESTAMP) AS seen,
         least((extract(day FROM ts) - 1) // 10, 2) + CASE WHEN event_id % 50 = 0 THEN 1 ELSE 0 END AS turn
  FROM events),
clock AS (SELECT turn, max(seen) AS greatest FROM sent GROUP BY turn),
passed AS (
  SELECT s.*, (SELECT max(greatest) - INTERVAL 1 DAY FROM clock c WHERE c.turn < s.turn) AS wm FROM sent s)
SELECT log_id, mid, CASE WHEN seen <= wm THEN CAST(epoch_us(wm) - epoch_us(seen) AS DOUBLE) / 1000000 END AS late_by
FROM passed
"""
ORACLES["dimension_job"] = f"""
SELECT CAST(o_custkey AS VARCHAR) AS id, 'user of order ' || o_orderkey AS name, o_orderstatus AS gender,
       strftime(o_orderdate, {_SECOND}) AS changed, o_orderkey AS version
FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1
"""
ORACLES["dau_total_day"] = f"""
SELECT * FROM (WITH {_LOGS} {_DAU_TOTAL}) AS t WHERE dt IN ('2024-01-09', '2024-01-10')
"""
ORACLES["order_total_day"] = f"""
WITH {_SPLIT}
SELECT '1998-06-15' AS dt, CAST(coalesce(sum(final_detail_amount), 0) AS DECIMAL(28,2)) AS order_total_amount
FROM split WHERE dt = '1998-06-15'
"""
ORACLES["order_hour_day"] = f"""
SELECT * FROM (WITH {_PURCHASES}, {_HOURLY}, {_COMPARE}) AS t WHERE dt = '2024-01-10'
"""
ORACLES["sale_detail_day"] = f"""
WITH {_ORDERS}, {_DETAILS}, hits AS (
  SELECT o.dt, o.id AS order_id, d.id AS order_detail_id, p_name AS sku_name
  FROM order_info o JOIN order_detail d ON d.order_id = o.id JOIN part ON p_partkey = d.sku_id
  WHERE contains(p_name, 'ring') AND o.dt = '1998-06-15')
SELECT *, replace(sku_name, 'ring', '<em>ring</em>') AS highlighted,
       (SELECT count(*) FROM hits) AS total
FROM hits ORDER BY dt, order_id, order_detail_id LIMIT 20
"""

ORACLES["dau_rollup"] = ORACLES["dau_hour_count"]
ORACLES["order_rollup"] = ORACLES["order_hour_amount"]
ORACLES["search_deep_page"] = f"""
WITH {_DETAILS}
SELECT id, order_id, price AS order_price FROM order_detail ORDER BY price DESC, id LIMIT 20 OFFSET 5000
"""
