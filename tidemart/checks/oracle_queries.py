"""One SQL text per registered query."""

from tidemart.checks.oracle_views import LOG_DAY, ORDER_DAY

_LINE_COLUMNS = """id, order_id, user_id, sku_id, province_id, activity_id, activity_rule_id,
    coupon_id, date_id, create_time, sku_num, split_original_amount, split_activity_amount,
    split_coupon_amount, split_total_amount, ds"""
_PAY_COLUMNS = """id, order_id, user_id, sku_id, province_id, activity_id, activity_rule_id,
    coupon_id, payment_type_code, payment_type_name, date_id, callback_time, sku_num,
    split_original_amount, split_activity_amount, split_coupon_amount, split_payment_amount, ds"""

_STATS = """
    SELECT '{day}' AS ds, CAST(1 AS BIGINT) AS recent_days, {keys},
           CAST(sum(order_count_1d) AS BIGINT) AS order_count,
           count(DISTINCT user_id) AS order_user_count
    FROM a_user_product WHERE ds = '{day}' GROUP BY {keys}
    UNION ALL
    SELECT '{day}', 7, {keys}, CAST(sum(order_count_7d) AS BIGINT),
           count(DISTINCT user_id) FILTER (order_count_7d > 0)
    FROM h_user_product GROUP BY {keys}
    UNION ALL
    SELECT '{day}', 30, {keys}, CAST(sum(order_count_30d) AS BIGINT),
           count(DISTINCT user_id) FILTER (order_count_30d > 0)
    FROM h_user_product GROUP BY {keys}"""

_CATEGORIES = ("category1_id, category1_name, category2_id, category2_name, category3_id,"
               " category3_name")

_AGES = """
        SELECT user_id, label AS age_label, total AS score
        FROM (SELECT user_id, CASE WHEN k < 20 THEN '18-24' WHEN k < 40 THEN '25-29'
                                   WHEN k < 60 THEN '30-34' WHEN k < 80 THEN '35-39'
                                   ELSE '40+' END AS label,
                     CAST(sum(CAST(value AS DECIMAL(16,2)) * CASE event_type
                          WHEN 'click' THEN 0.30 WHEN 'purchase' THEN 0.40
                          WHEN 'view' THEN 0.20 ELSE 0.10 END) AS DECIMAL(30,4)) AS total
              FROM x_event WHERE event_type <> 'error' GROUP BY 1, 2)
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY total DESC, label DESC) = 1"""
_GENDERS = """
        SELECT user_id, female, male, family,
               CASE WHEN (female - male) * 10 > female + male + family THEN 'female'
                    WHEN (male - female) * 10 > female + male + family THEN 'male'
                    WHEN family * 10 >= (female + male + family) * 3 THEN 'family' END
                   AS gender_label
        FROM (SELECT user_id,
                     CAST(coalesce(sum(v) FILTER (k < 34), 0) AS DECIMAL(26,2)) AS female,
                     CAST(coalesce(sum(v) FILTER (k >= 34 AND k < 67), 0) AS DECIMAL(26,2)) AS male,
                     CAST(coalesce(sum(v) FILTER (k >= 67), 0) AS DECIMAL(26,2)) AS family
              FROM (SELECT *, CAST(value AS DECIMAL(16,2)) AS v FROM x_event) GROUP BY user_id)"""
_SIGNS = """
        SELECT c_custkey AS user_id,
               CASE WHEN md < 120 THEN 'Capricorn' WHEN md < 219 THEN 'Aquarius'
                    WHEN md < 321 THEN 'Pisces' WHEN md < 420 THEN 'Aries'
                    WHEN md < 521 THEN 'Taurus' WHEN md < 622 THEN 'Gemini'
                    WHEN md < 723 THEN 'Cancer' WHEN md < 823 THEN 'Leo'
                    WHEN md < 923 THEN 'Virgo' WHEN md < 1024 THEN 'Libra'
                    WHEN md < 1123 THEN 'Scorpio' WHEN md < 1222 THEN 'Sagittarius'
                    ELSE 'Capricorn' END AS constellation
        FROM (SELECT c_custkey, month(b) * 100 + day(b) AS md
              FROM (SELECT c_custkey, DATE '1980-01-01' + CAST(floor(c_acctbal) AS INTEGER) AS b
                    FROM customer))"""


def _watermark(time: str, delay: int) -> str:
    """Two deliveries: days before the 20th, then the others and the first three days again. A message counts
    unless its day was over at the watermark after the first delivery; days over at the last one
    are given out."""
    return f"""
        SELECT strftime(d, '%Y-%m-%d') AS day, 'ok' AS route, count(*) AS message_count
        FROM (SELECT date_trunc('day', t) AS d, part,
                     max(t) FILTER (part = 1) OVER () - INTERVAL {delay} SECOND AS mark_1,
                     max(t) OVER () - INTERVAL {delay} SECOND AS mark_2
              FROM (SELECT {time} AS t, CASE WHEN ts < DATE '2024-01-20' THEN 1 ELSE 2 END AS part
                    FROM events UNION ALL
                    SELECT {time}, 2 FROM events WHERE ts < DATE '2024-01-04')
              WHERE t IS NOT NULL)
        WHERE (part = 1 OR d + INTERVAL 1 DAY > mark_1) AND d + INTERVAL 1 DAY <= mark_2
        GROUP BY d
        UNION ALL
        SELECT NULL, 'reject', count(*)
        FROM (SELECT {time} AS t FROM events UNION ALL
              SELECT {time} FROM events WHERE ts < DATE '2024-01-04')
        WHERE t IS NULL HAVING count(*) > 0"""


TEXTS = {
    # dimensions
    "dim_product": """
        SELECT p_partkey AS id, CAST(p_retailprice AS DECIMAL(16,2)) AS price, sku_name,
               p_type || ' ' || p_name AS sku_desc, CAST(p_size AS DECIMAL(16,2)) AS weight,
               true AS is_sale, CAST(p_size AS BIGINT) AS spu_id, 'SPU ' || p_size AS spu_name,
               category3_id, category3_name, category2_id, category2_name, category1_id,
               category1_name, tm_id, tm_name,
               '[{"attr_id":"1","value_id":"' || length(CAST(p_size AS VARCHAR))
               || '","attr_name":"size","value_name":"' || p_size
               || '"},{"attr_id":"2","value_id":"' || length(p_type)
               || '","attr_name":"type","value_name":"' || p_type
               || '"},{"attr_id":"3","value_id":"' || length(p_brand)
               || '","attr_name":"brand","value_name":"' || p_brand || '"}]' AS sku_attr_values,
               CASE WHEN p_size > 5 THEN '[{"sale_attr_id":"1","sale_attr_value_id":"'
               || length(category2_id) || '","sale_attr_name":"colour","sale_attr_value_name":"'
               || category2_id || '"}]' END AS sku_sale_attr_values,
               '1994-12-31 00:00:00' AS create_time
        FROM part JOIN d_product ON p_partkey = sku_id""",
    "attr_lists": """
        SELECT p_partkey AS sku_id, '[{"attr_id":"1","value_id":"'
               || length(CAST(p_size AS VARCHAR)) || '","attr_name":"size","value_name":"'
               || p_size || '"},{"attr_id":"2","value_id":"' || length(p_type)
               || '","attr_name":"type","value_name":"' || p_type
               || '"},{"attr_id":"3","value_id":"' || length(p_brand)
               || '","attr_name":"brand","value_name":"' || p_brand || '"}]' AS attrs
        FROM part""",
    "dim_coupon": "SELECT * FROM d_coupon",
    "dim_activity": """
        SELECT CAST(n_nationkey AS BIGINT) AS activity_rule_id,
               CAST(r_regionkey AS BIGINT) AS activity_id, r_name || ' week' AS activity_name,
               '310' || kind AS activity_type_code,
               ['money off', 'pieces off', 'discount'][kind] AS activity_type_name,
               lower(r_name) AS activity_desc, '1995-01-01 00:00:00' AS start_time,
               '2001-12-31 00:00:00' AS end_time, '1994-12-31 00:00:00' AS create_time,
               CAST(n_nationkey * 10 AS DECIMAL(16,2)) AS condition_amount,
               CAST(n_nationkey AS BIGINT) AS condition_num,
               CAST(n_nationkey AS DECIMAL(16,2)) AS benefit_amount,
               CAST(n_regionkey AS DECIMAL(16,2)) AS benefit_discount,
               CASE kind WHEN 1 THEN '满' || n_nationkey * 10 || '.00元减' || n_nationkey || '.00元'
                    WHEN 2 THEN '满' || n_nationkey || '件打' || n_regionkey || '.00 折'
                    ELSE '打' || n_regionkey || '.00折' END AS benefit_rule,
               CAST(n_regionkey AS VARCHAR) AS benefit_level
        FROM (SELECT *, CASE WHEN n_regionkey < 2 THEN 1 WHEN n_regionkey < 4 THEN 2 ELSE 3 END
                     AS kind FROM nation) LEFT JOIN region ON n_regionkey = r_regionkey""",
    "dim_province": "SELECT * FROM d_province",
    "dim_promotion": """
        SELECT 'position' AS kind, s_suppkey AS id, s_name AS name,
               CASE WHEN s_acctbal < 0 THEN 'banner' ELSE 'list' END AS pos_type,
               CASE WHEN s_nationkey < 12 THEN 'algorithm' ELSE 'manual' END AS promotion_type,
               '1994-12-31 00:00:00' AS create_time, CAST(NULL AS VARCHAR) AS operate_time
        FROM supplier
        UNION ALL
        SELECT 'channel', n_nationkey, lower(n_name), NULL, NULL, '1994-12-31 00:00:00', NULL
        FROM nation""",
    "dim_calendar": """
        SELECT CAST(d AS VARCHAR) AS date_id, CAST(weekofyear(d) AS VARCHAR) AS week_id,
               CAST(isodow(d) AS VARCHAR) AS week_day, CAST(day(d) AS VARCHAR) AS day,
               CAST(month(d) AS VARCHAR) AS month, CAST(quarter(d) AS VARCHAR) AS quarter,
               CAST(year(d) AS VARCHAR) AS year,
               CASE WHEN isodow(d) > 5 THEN '0' ELSE '1' END AS is_workday,
               CAST(NULL AS VARCHAR) AS holiday_id
        FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders)""",
    "dim_user_masked": f"""
        SELECT *, '{LOG_DAY}' AS start_date, '9999-12-31' AS end_date, '9999-12-31' AS ds
        FROM d_user""",
    "dim_user_scd2": f"""
        SELECT d_user.* REPLACE (CASE v WHEN 'new' THEN 'VIP' ELSE user_level END AS user_level),
               CASE v WHEN 'new' THEN '{LOG_DAY}' ELSE '2024-01-01' END AS start_date,
               CASE v WHEN 'old' THEN '2024-01-29' ELSE '9999-12-31' END AS end_date,
               CASE v WHEN 'old' THEN '2024-01-29' ELSE '9999-12-31' END AS ds
        FROM d_user, (VALUES ('old'), ('kept'), ('new')) AS versions(v)
        WHERE (v = 'new' AND user_level = 'M')
           OR (v = 'old' AND user_level = 'M' AND operate_time IS NULL)
           OR (v = 'kept' AND user_level <> 'M' AND operate_time IS NULL)""",
    "dict_decode": """
        SELECT id, coupon_type_code AS coupon_type, range_type_code AS range_type,
               coupon_type_name AS type_name, range_type_name AS range_name FROM d_coupon""",
    # facts
    "fact_cart_add": """
        SELECT id, user_id, sku_id, date_id, create_time, sku_num, ds FROM f_cart""",
    "fact_cart_snapshot": f"""
        SELECT id, user_id, sku_id, 'product ' || sku_id AS sku_name, sku_num, '{LOG_DAY}' AS ds
        FROM f_cart WHERE value <= 60 AND f_cart.ds <= '{LOG_DAY}'""",
    "line_amounts": """
        SELECT id, order_id, sku_id, sku_num, original AS split_original_amount,
               off AS split_activity_amount, coupon AS split_coupon_amount,
               CAST(original - off - coupon AS DECIMAL(16,2)) AS split_total_amount FROM x_line""",
    "fact_order_line": f"SELECT {_LINE_COLUMNS} FROM f_line",
    "fact_order_line_daily": f"""
        SELECT {_LINE_COLUMNS} FROM f_line WHERE CAST(l_shipdate AS DATE) = DATE '{ORDER_DAY}'""",
    "order_totals_bucketed": """
        SELECT order_id, max(user_id) AS user_id, count(*) AS line_count, CAST(sum(sku_num) AS BIGINT) AS sku_num,
               CAST(sum(original) AS DECIMAL(26,2)) AS original_amount
        FROM x_line LEFT JOIN x_head ON order_id = o_orderkey GROUP BY order_id""",
    "scan_lookback": f"""
        SELECT id, order_id, sku_id, sku_num, ds FROM x_line
        WHERE l_shipdate >= DATE '{ORDER_DAY}' - 1 AND l_shipdate < DATE '{ORDER_DAY}' + 1""",
    "fact_payment_line": f"SELECT {_PAY_COLUMNS} FROM f_pay",
    "fact_payment_line_daily": f"""
        SELECT {_PAY_COLUMNS} FROM f_pay
        WHERE ds = '1998-07-03' AND order_day IN ('1998-07-02', '1998-07-03')""",
    "payment_unmatched_daily": """
        SELECT o_orderkey AS order_id, o_custkey AS user_id,
               CASE orders.o_orderpriority WHEN '1-URGENT' THEN '1101' WHEN '2-HIGH' THEN '1102'
                    WHEN '3-MEDIUM' THEN '1103' ELSE '1199' END AS payment_type_code,
               strftime(paid_at, '%Y-%m-%d %H:%M:%S') AS callback_time, '1998-07-03' AS ds
        FROM orders JOIN x_paid ON o_orderkey = paid_order
        WHERE CAST(paid_at AS DATE) = DATE '1998-07-03'
          AND NOT (CAST(o_orderdate AS DATE) BETWEEN DATE '1998-07-02' AND DATE '1998-07-03'
                   AND o_orderkey IN (SELECT l_orderkey FROM lineitem))""",
    "log_rejects": """
        SELECT event_id AS id, CASE WHEN value > 300 THEN 'unreadable' ELSE 'time out of range'
               END AS reason FROM events WHERE value > 290""",
    "fact_order_flow": """
        SELECT order_id, user_id, province_id, strftime(o_orderdate, '%Y-%m-%d') AS order_date_id,
               strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS order_time,
               strftime(paid_at, '%Y-%m-%d') AS payment_date_id,
               strftime(paid_at, '%Y-%m-%d %H:%M:%S') AS payment_time,
               strftime(done_at, '%Y-%m-%d') AS finish_date_id,
               strftime(done_at, '%Y-%m-%d %H:%M:%S') AS finish_time,
               original AS order_original_amount, off AS order_activity_amount,
               coupon AS order_coupon_amount, total AS order_total_amount,
               paid_amount AS payment_amount,
               coalesce(strftime(done_at, '%Y-%m-%d'), '9999-12-31') AS ds
        FROM x_flow""",
    "fact_order_flow_daily": f"""
        SELECT order_id, user_id, province_id, strftime(o_orderdate, '%Y-%m-%d') AS order_date_id,
               strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS order_time,
               strftime(paid, '%Y-%m-%d') AS payment_date_id,
               strftime(paid, '%Y-%m-%d %H:%M:%S') AS payment_time,
               strftime(done, '%Y-%m-%d') AS finish_date_id,
               strftime(done, '%Y-%m-%d %H:%M:%S') AS finish_time,
               original AS order_original_amount, off AS order_activity_amount,
               coupon AS order_coupon_amount, total AS order_total_amount,
               CASE WHEN paid IS NOT NULL THEN paid_amount END AS payment_amount,
               coalesce(strftime(done, '%Y-%m-%d'), '9999-12-31') AS ds
        FROM (SELECT *, CASE WHEN paid_at < DATE '{ORDER_DAY}' + 1 THEN paid_at END AS paid,
                     CASE WHEN done_at < DATE '{ORDER_DAY}' + 1 THEN done_at END AS done
              FROM x_flow WHERE o_orderdate < DATE '{ORDER_DAY}' + 1)
        WHERE done IS NULL OR done >= DATE '{ORDER_DAY}'""",
    "fact_coupon_used": "SELECT * FROM f_coupon",
    "fact_favorite_add": "SELECT * FROM f_favor",
    "fact_page_view": """
        SELECT province_id, brand, channel, is_new, model, mid_id, operate_system,
               CAST(uid AS VARCHAR) AS user_id, version_code, CAST(k AS VARCHAR) AS page_item,
               'sku_id' AS page_item_type, last_page_id, page_id,
               CASE WHEN k < 10 THEN CAST(k AS VARCHAR) END AS from_pos_id,
               CASE WHEN k < 10 THEN '1' END AS from_pos_seq,
               CASE WHEN k < 25 THEN CAST(k AS VARCHAR) END AS refer_id, ds AS date_id,
               shop_time AS view_time, session_id, during_time, ds
        FROM x_log""",
    "fact_login": "SELECT * FROM f_login",
    "first_event_per_session": """
        SELECT session_id, ms AS ts, event_id AS id, page_id FROM x_log
        QUALIFY row_number() OVER (PARTITION BY session_id ORDER BY ms, event_id) = 1""",
    # one-day aggregates
    "user_product_order_1d": "SELECT * FROM a_user_product",
    "user_order_1d": "SELECT * FROM a_user",
    "user_cart_add_1d": """
        SELECT user_id, count(*) AS cart_add_count_1d, CAST(sum(sku_num) AS BIGINT)
               AS cart_add_num_1d, ds FROM f_cart GROUP BY user_id, ds""",
    "user_payment_1d": """
        SELECT user_id, count(DISTINCT order_id) AS payment_count_1d,
               CAST(sum(sku_num) AS BIGINT) AS payment_num_1d,
               CAST(sum(split_payment_amount) AS DECIMAL(26,2)) AS payment_amount_1d, ds
        FROM f_pay GROUP BY user_id, ds""",
    "province_order_1d": "SELECT * FROM a_province",
    "user_coupon_used_1d": "SELECT * FROM a_coupon",
    "product_favorite_1d": "SELECT * FROM a_favor",
    "session_page_view_1d": "SELECT * FROM a_session",
    "visitor_page_view_1d": "SELECT * FROM a_visitor",
    # horizons and totals; the incremental builds must equal the full build
    "user_product_order_nd": "SELECT * FROM h_user_product",
    "user_history_rebuilt": """
        SELECT user_id, event_type, start_date, coalesce(strftime(lead(CAST(start_date AS DATE)) OVER (
                   PARTITION BY user_id ORDER BY start_date) - 1, '%Y-%m-%d'), '9999-12-31') AS end_date
        FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY start_date) AS before
              FROM (SELECT user_id, strftime(ts, '%Y-%m-%d') AS start_date, arg_max(event_type, event_id) AS event_type
                    FROM events GROUP BY ALL))
        WHERE event_type IS DISTINCT FROM before""",
    "purchase_as_of_signup": """
        SELECT p.event_id, p.user_id, arg_max(s.value, (s.ts, s.event_id)) AS signup_value
        FROM events p LEFT JOIN events s
          ON s.user_id = p.user_id AND s.event_type = 'signup' AND s.ts <= p.ts
        WHERE p.event_type = 'purchase' GROUP BY p.event_id, p.user_id""",
    "snapshot_diff": """
        SELECT c_custkey, CASE c_custkey % 50 WHEN 1 THEN 'I' WHEN 2 THEN 'D' ELSE 'U' END AS change
        FROM customer WHERE c_custkey % 50 IN (1, 2, 3)""",
    "user_product_order_sliding": "SELECT * FROM h_user_product",
    "visitor_count_nd": f"""
        SELECT page_id, h AS recent_days, visitor_count, visitor_count AS visitor_estimate, '{LOG_DAY}' AS ds
        FROM (SELECT page_id, h, count(DISTINCT mid_id) FILTER (CAST(ds AS DATE) > DATE '{LOG_DAY}' - CAST(h AS INTEGER))
                  AS visitor_count
              FROM x_log, (VALUES (CAST(1 AS BIGINT)), (7), (30)) AS horizons(h)
              WHERE CAST(ds AS DATE) > DATE '{LOG_DAY}' - 30 AND ds <= '{LOG_DAY}' GROUP BY page_id, h)""",
    "province_order_nd": "SELECT * FROM h_province",
    "user_order_td": "SELECT * FROM t_user",
    "user_order_td_merge_join": "SELECT * FROM t_user",
    "user_order_td_merge_union": "SELECT * FROM t_user",
    "user_login_td": "SELECT * FROM t_login",
    "horizon_fanout": f"""
        SELECT h AS recent_days, count(*) AS event_count, count(DISTINCT utc_day) AS day_count
        FROM x_event, (VALUES (CAST(1 AS BIGINT)), (7), (30)) AS horizons(h)
        WHERE CAST(utc_day AS DATE) >= DATE '{LOG_DAY}' - CAST(h - 1 AS INTEGER)
          AND utc_day <= '{LOG_DAY}' GROUP BY h""",
    "lead_gap": """
        SELECT user_id, ds, second_next,
               CAST(CAST(second_next AS DATE) - CAST(ds AS DATE) AS INTEGER) AS gap
        FROM (SELECT user_id, ds, lead(ds, 2, '9999-12-31') OVER (PARTITION BY user_id ORDER BY ds)
                     AS second_next
              FROM (SELECT DISTINCT user_id, utc_day AS ds FROM x_event))""",
    # reports
    "channel_traffic": f"""
        SELECT '{LOG_DAY}' AS ds, h AS recent_days, channel, count(DISTINCT mid_id) AS uv_count,
               CAST(trunc(sum(during_time_1d) / count(*) / 1000) AS BIGINT) AS avg_duration_sec,
               CAST(trunc(sum(page_count_1d) / count(*)) AS BIGINT) AS avg_page_count,
               count(*) AS sv_count,
               CAST(((200 * count(*) FILTER (page_count_1d = 1) + count(*)) // (2 * count(*)))
                    * 0.01 AS DECIMAL(16,2)) AS bounce_rate
        FROM a_session, (VALUES (CAST(1 AS BIGINT)), (7), (30)) AS horizons(h)
        WHERE CAST(a_session.ds AS DATE) BETWEEN DATE '{LOG_DAY}' - CAST(h - 1 AS INTEGER)
              AND DATE '{LOG_DAY}'
        GROUP BY h, channel""",
    "user_churn_return": f"""
        SELECT '{LOG_DAY}' AS ds,
               (SELECT count(*) FROM t_login WHERE login_date_last = '2024-01-23')
                   AS user_churn_count,
               (SELECT count(*) FROM t_login n JOIN t_login_before b USING (user_id)
                WHERE n.login_date_last = '{LOG_DAY}'
                  AND DATE '{LOG_DAY}' - CAST(b.login_date_last AS DATE) >= 8)
                   AS user_back_count""",
    "user_retention": f"""
        SELECT '{LOG_DAY}' AS ds, login_date_first AS create_date,
               CAST(DATE '{LOG_DAY}' - CAST(login_date_first AS DATE) AS INTEGER) AS retention_day,
               count(*) FILTER (login_date_last = '{LOG_DAY}') AS retention_count,
               count(*) AS new_user_count,
               CAST(((20000 * count(*) FILTER (login_date_last = '{LOG_DAY}') + count(*))
                     // (2 * count(*))) * 0.01 AS DECIMAL(16,2)) AS retention_rate
        FROM t_login WHERE login_date_first BETWEEN '2024-01-23' AND '2024-01-29'
        GROUP BY login_date_first""",
    "user_new_active": f"""
        SELECT '{LOG_DAY}' AS ds, h AS recent_days,
               count(*) FILTER (CAST(login_date_first AS DATE)
                                >= DATE '{LOG_DAY}' - CAST(h - 1 AS INTEGER)) AS new_user_count,
               count(*) AS active_user_count
        FROM t_login, (VALUES (CAST(1 AS BIGINT)), (7), (30)) AS horizons(h)
        WHERE CAST(login_date_last AS DATE) >= DATE '{LOG_DAY}' - CAST(h - 1 AS INTEGER)
        GROUP BY h""",
    "user_funnel": f"""
        SELECT '{LOG_DAY}' AS ds,
               (SELECT count(*) FROM a_visitor WHERE ds = '{LOG_DAY}' AND page_id = 'home')
                   AS home_count,
               (SELECT count(*) FROM a_visitor WHERE ds = '{LOG_DAY}' AND page_id = 'good_detail')
                   AS good_detail_count,
               (SELECT count(DISTINCT user_id) FROM f_cart WHERE ds = '{LOG_DAY}') AS cart_count,
               (SELECT count(DISTINCT user_id) FROM x_event
                WHERE utc_day = '{LOG_DAY}' AND event_type = 'purchase') AS order_count,
               (SELECT count(DISTINCT user_id) FROM x_event WHERE utc_day = '{LOG_DAY}'
                AND event_type = 'purchase' AND value >= 20) AS payment_count""",
    "new_order_users": """
        SELECT '1995-01-31' AS ds, h AS recent_days, count(*) AS new_order_user_count
        FROM (SELECT user_id, min(ds) AS first FROM a_user GROUP BY user_id),
             (VALUES (CAST(1 AS BIGINT)), (7), (30)) AS horizons(h)
        WHERE CAST(first AS DATE) BETWEEN DATE '1995-01-31' - CAST(h - 1 AS INTEGER)
              AND DATE '1995-01-31'
        GROUP BY h""",
    "consecutive_order_users": f"""
        SELECT '{LOG_DAY}' AS ds, CAST(7 AS BIGINT) AS recent_days,
               count(DISTINCT a.user_id) AS order_continuously_user_count
        FROM (SELECT DISTINCT user_id, CAST(ts AS DATE) AS d FROM events) a
             JOIN (SELECT DISTINCT user_id, CAST(ts AS DATE) AS d FROM events) b
                  ON a.user_id = b.user_id AND b.d = a.d + 1
             JOIN (SELECT DISTINCT user_id, CAST(ts AS DATE) AS d FROM events) c
                  ON a.user_id = c.user_id AND c.d = a.d + 2
        WHERE a.d >= DATE '{LOG_DAY}' - 6 AND c.d <= DATE '{LOG_DAY}'""",
    "brand_repeat_rate": f"""
        SELECT '{ORDER_DAY}' AS ds, CAST(30 AS BIGINT) AS recent_days, tm_id, tm_name,
               CAST(((200 * count(*) FILTER (n >= 2) + count(*)) // (2 * count(*))) * 0.01
                    AS DECIMAL(16,2)) AS order_repeat_rate
        FROM (SELECT tm_id, tm_name, user_id, sum(order_count_30d) AS n FROM h_user_product
              GROUP BY ALL) GROUP BY tm_id, tm_name""",
    "brand_order_stats": _STATS.format(day=ORDER_DAY, keys="tm_id, tm_name"),
    "category_order_stats": _STATS.format(day=ORDER_DAY, keys=_CATEGORIES),
    "cart_top3_by_category": f"""
        SELECT '{LOG_DAY}' AS ds, {_CATEGORIES}, sku_id, sku_name, cart_num, rk
        FROM (SELECT *, rank() OVER (PARTITION BY category1_id, category2_id, category3_id
                                     ORDER BY cart_num DESC) AS rk
              FROM (SELECT sku_id, CAST(sum(sku_num) AS BIGINT) AS cart_num FROM f_cart
                    WHERE value <= 60 AND f_cart.ds <= '{LOG_DAY}' GROUP BY sku_id)
                   LEFT JOIN d_product USING (sku_id))
        WHERE rk <= 3""",
    "favorite_top3_by_brand": f"""
        SELECT ds, tm_id, tm_name, sku_id, sku_name, favor_add_count_1d AS favor_count,
               rank() OVER (PARTITION BY tm_id ORDER BY favor_add_count_1d DESC) AS rk
        FROM a_favor WHERE ds = '{LOG_DAY}' QUALIFY rk <= 3""",
    "order_to_pay_seconds": f"""
        SELECT '{ORDER_DAY}' AS ds,
               CAST(trunc(sum(date_diff('second', o_orderdate, paid_at)) / count(*)) AS BIGINT)
                   AS order_to_pay_interval_avg
        FROM x_flow WHERE CAST(paid_at AS DATE) = DATE '{ORDER_DAY}'
          AND (done_at IS NULL OR CAST(done_at AS DATE) = DATE '{ORDER_DAY}')""",
    "province_order_stats": f"""
        SELECT '{ORDER_DAY}' AS ds, CAST(1 AS BIGINT) AS recent_days, province_id, province_name,
               area_code, iso_code, iso_3166_2 AS iso_code_3166_2,
               order_count_1d AS order_count, order_total_amount_1d AS order_total_amount
        FROM a_province WHERE ds = '{ORDER_DAY}'
        UNION
        SELECT ds, 7, province_id, province_name, area_code, iso_code, iso_3166_2,
               order_count_7d, order_total_amount_7d FROM h_province
        UNION
        SELECT ds, 30, province_id, province_name, area_code, iso_code, iso_3166_2,
               order_count_30d, order_total_amount_30d FROM h_province""",
    "coupon_stats": f"""
        SELECT ds, coupon_id, coupon_name, CAST(sum(used_count_1d) AS BIGINT) AS used_count,
               count(*) AS used_user_count
        FROM a_coupon WHERE ds = '{ORDER_DAY}' GROUP BY ds, coupon_id, coupon_name""",
    # behaviour and profile
    "page_visits": "SELECT ds, page_id, count(*) AS visit_count FROM x_log GROUP BY ds, page_id",
    "search_top10": """
        SELECT utc_day AS ds, 'w' || k AS term, count(*) AS search_count,
               row_number() OVER (PARTITION BY utc_day ORDER BY count(*) DESC, 'w' || k) AS place
        FROM x_event WHERE event_type = 'view' GROUP BY utc_day, k QUALIFY place <= 10""",
    "login_region_heat": """
        SELECT ds, CAST(province_id AS BIGINT) AS province_id, province_name, region_name,
               count(*) AS login_count, count(DISTINCT user_id) AS user_count
        FROM f_login LEFT JOIN d_province ON CAST(province_id AS BIGINT) = d_province.id
        GROUP BY ALL""",
    "page_path_edges": """
        SELECT page_id, next_page_id, count(*) AS step_count
        FROM (SELECT page_id, lead(page_id) OVER (PARTITION BY session_id ORDER BY ms, event_id)
                     AS next_page_id FROM x_log) GROUP BY ALL""",
    "page_paths": """
        SELECT concat_ws('>', page_id, second, third) AS path, count(*) AS path_count
        FROM (SELECT page_id, lead(page_id) OVER w AS second, lead(page_id, 2) OVER w AS third,
                     row_number() OVER w AS step
              FROM x_log WINDOW w AS (PARTITION BY session_id ORDER BY ms, event_id))
        WHERE third IS NOT NULL OR step = 1 GROUP BY 1""",
    "frequent_page_paths": """
        SELECT array_to_string(path, '>') AS path, len(path) AS page_count, count(*) AS session_count
        FROM (WITH RECURSIVE views AS (
                SELECT session_id, page_id, row_number() OVER (PARTITION BY session_id ORDER BY ms, event_id) AS place
                FROM x_log WHERE page_id IS NOT NULL),
              held AS (
                SELECT session_id, [page_id] AS path, min(place) AS at FROM views GROUP BY ALL
                UNION ALL
                SELECT h.session_id, list_append(h.path, v.page_id) AS path, min(v.place) AS at
                FROM held h JOIN views v ON v.session_id = h.session_id AND v.place > h.at GROUP BY ALL)
              SELECT * FROM held)
        GROUP BY path
        HAVING count(*) * 100 >= (SELECT count(DISTINCT session_id) FROM x_log WHERE page_id IS NOT NULL)""",
    "device_rollup": """
        SELECT operate_system, brand, version_code,
               grouping_id(operate_system, brand, version_code) AS level, count(*) AS view_count,
               count(DISTINCT mid_id) AS visitor_count
        FROM x_log GROUP BY ROLLUP (operate_system, brand, version_code)""",
    "category_rollup": """
        SELECT category1_id, category2_id, category3_id,
               grouping_id(category1_id, category2_id, category3_id) AS level,
               CAST(sum(order_count_1d) AS BIGINT) AS order_count,
               CAST(sum(order_total_amount_1d) AS DECIMAL(26,2)) AS order_total_amount
        FROM a_user_product GROUP BY ROLLUP (category1_id, category2_id, category3_id)""",
    "user_profile_json": """
        SELECT user_id, login_days, login_dates, bought, searched, day_parts,
               '{"user_id":' || user_id || ',"login_days":' || login_days || ',"login_dates":"'
               || login_dates || '","bought":' || bought || ',"searched":' || searched
               || ',"day_parts":"' || day_parts || '"}' AS profile
        FROM (SELECT uid AS user_id, count(DISTINCT ds) AS login_days,
                     string_agg(DISTINCT ds, ',' ORDER BY ds) AS login_dates,
                     bool_or(page_id = 'payment') AS bought,
                     bool_or(event_type = 'view') AS searched,
                     concat_ws(',', CASE WHEN bool_or(shop_hour < 6) THEN 'night' END,
                               CASE WHEN bool_or(shop_hour BETWEEN 6 AND 11) THEN 'morning' END,
                               CASE WHEN bool_or(shop_hour BETWEEN 12 AND 17) THEN 'afternoon' END,
                               CASE WHEN bool_or(shop_hour >= 18) THEN 'evening' END) AS day_parts
              FROM x_log WHERE uid IS NOT NULL GROUP BY uid)""",
    "profile_age_label": _AGES,
    "profile_gender_label": _GENDERS,
    "profile_zodiac": _SIGNS,
    "profile_labels": f"""
        SELECT d_user.id AS user_id, age_label, gender_label,
               CASE WHEN d_user.id % 3 <> 0 THEN CAST(d_user.id % 50 + 150 AS INTEGER) END AS height_cm,
               CASE WHEN d_user.id % 3 <> 0
                    THEN CAST((d_user.id % 400 + 450) * 0.1 AS DECIMAL(5,1)) END AS weight_kg,
               constellation, coalesce(operate_time, create_time) AS update_time
        FROM d_user LEFT JOIN ({_AGES}) a ON a.user_id = d_user.id
             LEFT JOIN ({_GENDERS}) g ON g.user_id = d_user.id
             LEFT JOIN ({_SIGNS}) s ON s.user_id = d_user.id""",
    "product_name_split": """
        SELECT p_partkey AS sku_id,
               p_brand || CASE WHEN p_size > 10 THEN '丨' ELSE ' ' END || p_name || ' 套装 ' || p_type
                   AS full_name,
               CASE WHEN p_size > 10 THEN p_brand || '丨' || p_name END AS brand_path,
               CASE WHEN p_size > 10 THEN p_name END AS brand_series,
               CASE WHEN p_size > 10 THEN '套装 ' || p_type
                    ELSE p_brand || ' ' || p_name || ' 套装 ' || p_type END AS product_name
        FROM part""",
    # moderation
    "comment_grade": "SELECT comment_id, user_id, grade FROM x_grade",
    "comment_grade_lookup": """
        SELECT comment_id, min(grade) AS grade FROM x_word JOIN x_list ON word = listed
        GROUP BY comment_id""",
    "comment_words_inside": """
        SELECT word, count(*) AS comment_count FROM x_stem_found GROUP BY word""",
    "comment_grade_inside": """
        SELECT doc_id AS comment_id, min(grade) AS grade FROM x_stem_found GROUP BY doc_id""",
    "ban_periods": """
        SELECT user_id, strftime(since, '%Y-%m-%d %H:%M:%S.%f') AS banned_from, strftime(until, '%Y-%m-%d %H:%M:%S.%f') AS expires,
               worst_grade, offences FROM x_ban""",
    "event_sessions": """
        SELECT user_id, strftime(since, '%Y-%m-%d %H:%M:%S.%f') AS session_start,
               strftime(until, '%Y-%m-%d %H:%M:%S.%f') AS session_end, event_count, last_event FROM x_session""",
    "stream_sessions": """
        SELECT user_id, 'ok' AS route, strftime(since, '%Y-%m-%d %H:%M:%S.%f') AS session_start,
               strftime(until, '%Y-%m-%d %H:%M:%S.%f') AS session_end, event_count, last_event
        FROM x_session WHERE until <= (SELECT max(ts) FROM events) - INTERVAL 60 SECOND
        UNION ALL
        SELECT NULL, 'late', NULL, NULL, count(*), NULL FROM events WHERE ts < '2024-01-04' HAVING count(*) > 0""",
    "stream_minute_counts": """
        SELECT event_type, strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M:%S.%f') AS window_start, count(*) AS row_count
        FROM events
        WHERE date_trunc('minute', ts) + INTERVAL 1 MINUTE <= (SELECT max(ts) FROM events) - INTERVAL 60 SECOND
        GROUP BY 1, date_trunc('minute', ts)""",
    "stream_bans": """
        SELECT user_id, strftime(since, '%Y-%m-%d %H:%M:%S.%f') AS banned_from, strftime(until, '%Y-%m-%d %H:%M:%S.%f') AS expires,
               worst_grade, offences
        FROM x_ban WHERE until <= (SELECT make_timestamp(max(t)) FROM x_offence) - INTERVAL 60 SECOND""",
    "comment_blacklist": """
        SELECT user_id, CAST(max(until) AS VARCHAR) AS expires, min(grade) AS worst_grade,
               count(*) AS offences, max(until) > DATE '2024-03-20' AS is_active
        FROM (SELECT *, DATE '2024-01-01' + CAST(n_chars % 30 AS INTEGER)
                     + CASE grade WHEN 'P0' THEN 365 ELSE 60 END AS until
              FROM x_grade WHERE grade IN ('P0', 'P1'))
        GROUP BY user_id""",
    "comment_totals": """
        SELECT count(*) AS comment_count, count(grade) AS sensitive_count,
               count(*) FILTER (grade = 'P0') AS p0_count,
               count(*) FILTER (grade = 'P1') AS p1_count,
               count(*) FILTER (grade = 'P2') AS p2_count,
               CAST(((20000 * count(grade) + count(*)) // (2 * count(*))) * 0.01
                    AS DECIMAL(16,2)) AS sensitive_rate
        FROM x_grade""",
    "word_membership": """
        SELECT DISTINCT word, word IN (SELECT listed FROM x_list) AS is_member
        FROM x_word WHERE word <> ''""",
    "word_semi_join": """
        SELECT comment_id, count(*) AS word_count FROM x_word
        WHERE word IN (SELECT listed FROM x_list) GROUP BY comment_id""",
    "charset_filter": """
        SELECT p_partkey AS sku_id, CASE WHEN p_size > 25 THEN p_name
                   WHEN p_size > 20 THEN p_brand || chr(10) ELSE p_brand END AS label,
               p_size <= 20 AS is_permitted FROM part""",
    "blank_filter": "SELECT event_id, event_type AS label FROM events WHERE value >= 15",
    # input and output
    "tsv_roundtrip": """
        SELECT o_orderkey, o_custkey, o_orderpriority AS priority,
               CASE WHEN o_orderstatus = 'P' THEN 'P' END AS status FROM orders""",
    "json_lines": "SELECT event_id, user_id, event_type, props FROM events",
    "camel_columns": """
        SELECT c_custkey AS "cCustkey", c_name AS "cName", c_nationkey AS "cNationkey",
               CAST(c_acctbal AS DECIMAL(16,2)) AS "cAcctbal", c_mktsegment AS "cMktsegment"
        FROM customer""",
    "snapshot_load": f"""
        SELECT order_id AS id, user_id, province_id,
               strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS create_time,
               original AS original_total_amount, off AS activity_reduce_amount,
               coupon AS coupon_reduce_amount, total AS total_amount, '{ORDER_DAY}' AS ds
        FROM x_order""",
    "incremental_load": """
        SELECT id, name, create_time, operate_time, '2024-01-25' AS ds FROM d_user
        WHERE create_time >= '2024-01-25' OR operate_time >= '2024-01-25'""",
    "partition_overwrite": """
        SELECT id, user_id, sku_id, date_id, create_time, '2024-01-01' AS ds FROM f_favor
        UNION ALL
        SELECT id, user_id, sku_id, date_id, create_time, '2024-01-02' FROM f_favor
        WHERE sku_id >= 50""",
    "dynamic_partition_write": """
        SELECT id, user_id, sku_id, date_id, create_time,
               sku_num + CASE WHEN ds >= '2024-01-20' THEN 1 ELSE 0 END AS sku_num, ds
        FROM f_cart""",
    "append_distinct": """
        SELECT ds, page_id, count(*) AS visit_count FROM x_log GROUP BY ds, page_id""",
    "to_json_rows": """
        SELECT '{"event_id":' || event_id || ',"user_id":' || user_id || ',"event_type":"'
               || event_type || '"}' AS value FROM events""",
    "null_safe_values": """
        SELECT event_id, props AS value FROM events WHERE event_type <> 'error'""",
    "rows_to_cells": "SELECT row_key, qualifier, value FROM x_cells WHERE value IS NOT NULL",
    "cell_point_read": """
        SELECT row_key, qualifier, value FROM x_cells
        WHERE value IS NOT NULL AND row_key = 'BUILDING_82'""",
    "cells_to_rows": "SELECT row_key, row_json FROM x_row",
    "cells_scan_limit": "SELECT row_key, row_json FROM x_row ORDER BY row_key LIMIT 100",
    "cell_row_count": "SELECT count(*) AS row_count FROM customer",
    "delete_by_keys": """
        SELECT o_orderkey, o_custkey, o_orderstatus FROM orders
        WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')""",
    "row_key": """
        SELECT o_orderkey, o_custkey || '_' || o_orderkey AS plain,
               md5(CAST(o_custkey AS VARCHAR)) || '-' || o_orderkey AS field_digest,
               md5(CAST(o_custkey AS VARCHAR) || o_orderkey) AS whole_digest FROM orders""",
    # streams
    "stream_watermark": _watermark(
        "CASE WHEN value <= 290 THEN make_timestamp(epoch_us(ts) // 1000 * 1000) END", 5),
    "stream_watermark_fallback": _watermark(
        "CASE WHEN event_type IN ('click', 'signup') THEN date_trunc('second', ts)"
        " WHEN event_type <> 'error' THEN date_trunc('second', ts) + INTERVAL 1 MINUTE END", 10),
    "stream_watermark_list": _watermark(
        "CASE WHEN event_type <> 'error' THEN make_timestamp(epoch_us(ts) // 1000 * 1000) END", 10),
    "epoch_day_bucket": """
        SELECT event_id, CASE WHEN event_type = 'error' THEN 'error_bucket'
               ELSE 'day=' || strftime(ts, '%Y%m%d') END AS bucket FROM events""",
    "epoch_day": "SELECT event_id, strftime(ts, '%Y%m%d') AS day FROM events",
    "stream_day_bucket": """
        SELECT event_id AS id, CASE WHEN value <= 290 THEN strftime(ts, '%Y%m%d')
               ELSE 'error_bucket' END AS day FROM events""",
    "stream_exactly_once": "SELECT event_id AS id FROM events",
    "stream_log_split": """
        SELECT event_id AS id, 'page' AS route FROM events WHERE value <= 300
        UNION ALL
        SELECT event_id, CASE event_type WHEN 'error' THEN 'err' WHEN 'signup' THEN 'start'
               WHEN 'view' THEN 'display' ELSE 'action' END
        FROM events WHERE value <= 300 AND event_type <> 'purchase'
        UNION ALL
        SELECT event_id, 'dirty' FROM events WHERE value > 300""",
    "stream_comment_grade": "SELECT comment_id, grade FROM x_grade",
    "stream_comment_totals": """
        SELECT count(*) AS comment_count, count(grade) AS sensitive_count,
               count(*) FILTER (grade = 'P0') AS p0_count,
               count(*) FILTER (grade = 'P1') AS p1_count,
               count(*) FILTER (grade = 'P2') AS p2_count,
               CAST(((20000 * count(grade) + count(*)) // (2 * count(*))) * 0.01
                    AS DECIMAL(16,2)) AS sensitive_rate
        FROM x_grade""",
    "cdc_apply": """
        SELECT user_id, event_type, value
        FROM (SELECT user_id, event_type, CAST(CAST(value AS DECIMAL(16,2)) AS VARCHAR) AS value,
                     row_number() OVER (PARTITION BY user_id ORDER BY ms DESC, event_id DESC) AS n
              FROM x_event)
        WHERE n = 1 AND event_type <> 'error'""",
    # keys
    "hash_bucket": """
        SELECT lpad(CAST(CAST('0x' || right(md5(CAST(o_custkey AS VARCHAR)), 3) AS INTEGER) % 128
                         AS VARCHAR), 4, '0') AS bucket, count(*) AS order_count
        FROM orders GROUP BY 1""",
    "hot_key_bucket": """
        SELECT CASE user_id WHEN 0 THEN '9001' WHEN 1 THEN '9006' ELSE
               lpad(CAST(CAST('0x' || right(md5('0x' || lpad(CAST(user_id AS VARCHAR), 40, '0')), 3)
                              AS INTEGER) % 128 AS VARCHAR), 4, '0') END AS bucket,
               count(*) AS event_count
        FROM events GROUP BY 1""",
    "token_amount_daily": """
        SELECT utc_day AS ds, CAST(sum(CASE
                   WHEN event_type = 'error' THEN '0'
                   WHEN event_type = 'click' AND user_id % 3 <> 0 THEN event_id || repeat('0', 40)
                   WHEN event_type IN ('click', 'signup') AND user_id % 3 = 0 THEN NULL
                   WHEN event_type = 'signup'
                       THEN CAST(CAST(event_id AS HUGEINT) * 18446744073709551616 AS VARCHAR)
                   ELSE CAST(event_id AS VARCHAR) END::BIGNUM) AS VARCHAR) AS amount,
               count(*) AS transfer_count,
               count(*) FILTER (event_type IN ('click', 'signup') AND user_id % 3 = 0) AS reject_count
        FROM x_event GROUP BY utc_day""",
    "log_words": """
        SELECT doc_id, CAST(i AS INTEGER) AS word_no, '0x' || substr(h, i * 64 + 1, 64) AS word
        FROM (SELECT doc_id, h, unnest(range(length(h) // 64)) AS i
              FROM (SELECT doc_id, hex(encode(text)) AS h FROM documents))""",
    "day_range": """
        SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS day, CAST(sum(n) AS BIGINT) AS event_count
        FROM (SELECT n, unnest(generate_series(CAST(first AS TIMESTAMP),
                                               TIMESTAMP '2024-01-15', INTERVAL 1 DAY)) AS d
              FROM (SELECT CAST(ts AS DATE) AS first, count(*) AS n FROM events GROUP BY 1))
        GROUP BY 1""",
    "history_append": """
        SELECT event_id, CASE WHEN event_type <> 'signup' THEN
               '[' || CASE WHEN event_type <> 'view' THEN '"' || user_id || '",'
               ELSE '' END || '"' || md5(CAST(event_id AS VARCHAR)) || '"]' END AS history
        FROM events""",
}
