"""Named sub-queries: the given tables as shop tables, facts and one-day aggregates."""

ORDER_DAY = "1998-06-30"
LOG_DAY = "2024-01-30"

VIEWS = {
    # order lines with exact amounts
    "x_line": """
        SELECT l_orderkey * 10 + l_linenumber AS id, l_orderkey AS order_id, l_partkey AS sku_id,
               CAST(l_quantity AS BIGINT) AS sku_num, l_shipdate,
               strftime(l_shipdate, '%Y-%m-%d') AS ds,
               strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS create_time,
               CAST(CAST(l_quantity AS BIGINT) * price AS DECIMAL(16,2)) AS original,
               CASE WHEN l_discount > 0
                    THEN CAST(price * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(16,2))
                    ELSE CAST(0 AS DECIMAL(16,2)) END AS off,
               CASE WHEN l_returnflag = 'R'
                    THEN CAST(price * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(16,2))
                    ELSE CAST(0 AS DECIMAL(16,2)) END AS coupon
        FROM (SELECT *, CAST(l_extendedprice AS DECIMAL(16,2)) AS price FROM lineitem)""",
    "x_head": """
        SELECT o_orderkey, o_custkey AS user_id, CAST(c_nationkey AS BIGINT) AS province_id
        FROM orders LEFT JOIN customer ON o_custkey = c_custkey""",
    "x_act": """
        SELECT DISTINCT l_orderkey * 10 + l_linenumber AS act_line,
               CAST(l_linenumber AS BIGINT) AS activity_id
        FROM lineitem WHERE l_discount > 0""",
    "x_cou": """
        SELECT l_orderkey * 10 + l_linenumber AS cou_line, min(l_suppkey) AS coupon_id
        FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1""",
    "x_paid": """
        SELECT o_orderkey AS paid_order, o_custkey AS payer, o_orderpriority,
               o_orderdate AS ordered_at,
               CAST(o_totalprice AS DECIMAL(16,2)) AS paid_amount,
               o_orderdate + to_seconds(CAST(floor(o_totalprice) AS BIGINT)) AS paid_at
        FROM orders WHERE o_orderstatus IN ('F', 'P')""",
    "f_line": """
        SELECT id, order_id, user_id, sku_id, province_id, activity_id,
               activity_id AS activity_rule_id, coupon_id, ds AS date_id, create_time, sku_num,
               original AS split_original_amount, off AS split_activity_amount,
               coupon AS split_coupon_amount,
               CAST(original - off - coupon AS DECIMAL(16,2)) AS split_total_amount, ds, l_shipdate
        FROM x_line LEFT JOIN x_head ON order_id = o_orderkey
             LEFT JOIN x_act ON id = act_line LEFT JOIN x_cou ON id = cou_line""",
    "f_pay": """
        SELECT f_line.id, order_id, payer AS user_id, sku_id, province_id, activity_id,
               activity_rule_id, coupon_id,
               CASE o_orderpriority WHEN '1-URGENT' THEN '1101' WHEN '2-HIGH' THEN '1102'
                    WHEN '3-MEDIUM' THEN '1103' ELSE '1199' END AS payment_type_code,
               CASE o_orderpriority WHEN '1-URGENT' THEN 'alipay' WHEN '2-HIGH' THEN 'wechat'
                    WHEN '3-MEDIUM' THEN 'unionpay' END AS payment_type_name,
               strftime(paid_at, '%Y-%m-%d') AS date_id,
               strftime(paid_at, '%Y-%m-%d %H:%M:%S') AS callback_time, sku_num,
               split_original_amount, split_activity_amount, split_coupon_amount,
               split_total_amount AS split_payment_amount,
               strftime(paid_at, '%Y-%m-%d') AS ds,
               strftime(ordered_at, '%Y-%m-%d') AS order_day
        FROM f_line JOIN x_paid ON order_id = paid_order""",
    "x_order": """
        SELECT o_orderkey AS order_id, o_custkey AS user_id, province_id, o_orderdate, total, off,
               coupon, CAST(total + off + coupon AS DECIMAL(16,2)) AS original, o_orderstatus
        FROM (SELECT orders.*, CAST(o_totalprice AS DECIMAL(16,2)) AS total,
                     CASE WHEN o_orderpriority = '1-URGENT'
                          THEN CAST(CAST(o_totalprice AS DECIMAL(16,2)) * 0.05 AS DECIMAL(16,2))
                          ELSE CAST(0 AS DECIMAL(16,2)) END AS off,
                     CAST(CASE WHEN o_orderpriority = '5-LOW' THEN 5 ELSE 0 END
                          AS DECIMAL(16,2)) AS coupon
              FROM orders) o JOIN x_head USING (o_orderkey)""",
    "x_flow": """
        SELECT x_order.*, paid_at, paid_amount,
               CASE WHEN o_orderstatus = 'F' THEN paid_at + INTERVAL 7 DAY END AS done_at
        FROM x_order LEFT JOIN x_paid ON order_id = paid_order""",
    "f_coupon": """
        SELECT cou_line AS id, coupon_id, payer AS user_id, paid_order AS order_id,
               strftime(paid_at, '%Y-%m-%d') AS date_id,
               strftime(paid_at, '%Y-%m-%d %H:%M:%S') AS payment_time,
               strftime(paid_at, '%Y-%m-%d') AS ds
        FROM x_cou JOIN x_paid ON cou_line // 10 = paid_order""",
    # dimensions
    "x_level": """
        SELECT split_part(p_name, ' ', 1) AS category2_id, min(p_type) AS category1_id
        FROM part GROUP BY 1""",
    "d_product": """
        SELECT p_partkey AS sku_id, p_name AS sku_name, category1_id,
               lower(category1_id) AS category1_name, category2_id,
               upper(category2_id) AS category2_name, p_name AS category3_id,
               split_part(p_name, ' ', 2) AS category3_name,
               CAST(split_part(p_brand, '#', 2) AS BIGINT) AS tm_id, p_brand AS tm_name
        FROM part JOIN x_level ON split_part(p_name, ' ', 1) = category2_id""",
    "x_coupon": """
        SELECT *, CAST(abs(s_acctbal) AS DECIMAL(16,2)) AS need,
               CAST(CAST(abs(s_acctbal) AS DECIMAL(16,2)) * 0.1 AS DECIMAL(16,2)) AS cut,
               CASE WHEN s_nationkey < 8 THEN 1 WHEN s_nationkey < 16 THEN 2 ELSE 3 END AS kind
        FROM supplier""",
    "d_coupon": """
        SELECT s_suppkey AS id, 'coupon of ' || s_name AS coupon_name,
               '320' || kind AS coupon_type_code,
               ['money off coupon', 'pieces off coupon', 'cash coupon'][kind] AS coupon_type_name,
               need AS condition_amount, CAST(s_nationkey AS BIGINT) AS condition_num,
               CAST(s_nationkey AS BIGINT) AS activity_id, cut AS benefit_amount,
               CAST(s_nationkey AS DECIMAL(16,2)) AS benefit_discount,
               CASE kind WHEN 1 THEN '满' || need || '元减' || cut || '元'
                    WHEN 2 THEN '满' || s_nationkey || '件打'
                                || CAST(s_nationkey AS DECIMAL(16,2)) || ' 折'
                    ELSE '减' || cut || '元' END AS benefit_rule,
               '1994-12-31 00:00:00' AS create_time,
               CASE WHEN s_acctbal < 0 THEN '3301' WHEN s_acctbal < 5000 THEN '3302'
                    WHEN s_acctbal < 9000 THEN '3303' ELSE '3399' END AS range_type_code,
               CASE WHEN s_acctbal < 0 THEN 'category' WHEN s_acctbal < 5000 THEN 'brand'
                    WHEN s_acctbal < 9000 THEN 'single product' END AS range_type_name,
               CAST(100 AS BIGINT) AS limit_num, CAST(s_nationkey AS BIGINT) AS taken_count,
               '1995-01-01 00:00:00' AS start_time, '2001-12-31 00:00:00' AS end_time,
               CAST(NULL AS VARCHAR) AS operate_time, '2002-12-31 00:00:00' AS expire_time
        FROM x_coupon""",
    "d_province": """
        SELECT CAST(n_nationkey AS BIGINT) AS id, n_name AS province_name,
               lpad(CAST(n_nationkey AS VARCHAR), 6, '0') AS area_code,
               'CN-' || n_nationkey AS iso_code, 'CN-N' || n_nationkey AS iso_3166_2,
               CAST(n_regionkey AS BIGINT) AS region_id, r_name AS region_name
        FROM nation LEFT JOIN region ON n_regionkey = r_regionkey""",
    "x_user": """
        SELECT *, TIMESTAMP '2024-01-05 09:00:00' + to_days(CAST(c_nationkey AS INTEGER)) AS born
        FROM customer""",
    "d_user": """
        SELECT c_custkey AS id, substr(c_name, 1, 1) || '*' AS name,
               CASE WHEN c_acctbal >= 0 AND length(CAST(c_custkey AS VARCHAR)) <= 8
                    THEN '138*' END AS phone_num,
               CASE WHEN c_mktsegment NOT IN ('FURNITURE', 'BUILDING')
                    THEN '*@shop.example.com' END AS email,
               substr(c_mktsegment, 1, 1) AS user_level,
               CAST(DATE '1980-01-01' + CAST(floor(c_acctbal) AS INTEGER) AS VARCHAR) AS birthday,
               CASE WHEN c_nationkey < 12 THEN 'F' ELSE 'M' END AS gender,
               strftime(born, '%Y-%m-%d %H:%M:%S') AS create_time,
               CASE WHEN c_acctbal < 0
                    THEN strftime(born + INTERVAL 3 DAY, '%Y-%m-%d %H:%M:%S') END AS operate_time
        FROM x_user""",
    # events and log
    "x_event": """
        SELECT event_id, ts, user_id, event_type, value,
               CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
               strftime(ts, '%Y-%m-%d') AS utc_day, epoch_us(ts) // 1000 AS ms,
               strftime(make_timestamp(epoch_us(ts) // 1000 * 1000) + INTERVAL 8 HOUR, '%Y-%m-%d') AS ds,
               strftime(make_timestamp(epoch_us(ts) // 1000 * 1000) + INTERVAL 8 HOUR,
                        '%Y-%m-%d %H:%M:%S') AS shop_time,
               hour(ts + INTERVAL 8 HOUR) AS shop_hour
        FROM events""",
    "x_log": """
        SELECT *, CAST(user_id % 25 AS VARCHAR) AS province_id, 'brand' || (user_id % 4) AS brand,
               'channel' || (user_id % 3) AS channel,
               CASE WHEN k < 50 THEN '1' ELSE '0' END AS is_new,
               'brand' || (user_id % 4) || ' X' AS model, 'm' || user_id AS mid_id,
               CASE WHEN user_id % 2 = 0 THEN 'Android' ELSE 'iOS' END AS operate_system,
               's' || user_id || strftime(ts, '-%Y%m%d') AS session_id,
               CASE WHEN event_type <> 'error' THEN user_id END AS uid,
               'v2.' || (user_id % 5) AS version_code,
               ['home', 'good_detail', 'cart', 'order', 'payment'][(k + 1) % 5 + 1] AS last_page_id,
               ['home', 'good_detail', 'cart', 'order', 'payment'][k % 5 + 1] AS page_id,
               CAST(floor(value * 1000) AS BIGINT) AS during_time
        FROM x_event WHERE value <= 290""",
    "f_login": """
        SELECT uid AS user_id, ds AS date_id, shop_time AS login_time, channel, province_id,
               version_code, mid_id, brand, model, operate_system, ds
        FROM x_log WHERE uid IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY session_id ORDER BY ms, event_id) = 1""",
    "f_cart": """
        SELECT event_id AS id, user_id, k AS sku_id, utc_day AS date_id,
               strftime(ts, '%Y-%m-%d %H:%M:%S') AS create_time,
               CAST(floor(value / 100) + 1 AS BIGINT) AS sku_num, utc_day AS ds, value
        FROM x_event WHERE event_type = 'click'""",
    "f_favor": """
        SELECT event_id AS id, user_id, k AS sku_id, utc_day AS date_id,
               strftime(ts, '%Y-%m-%d %H:%M:%S') AS create_time, utc_day AS ds
        FROM x_event WHERE event_type = 'signup'""",
    # one-day aggregates
    "a_user_product": """
        SELECT user_id, sku_id, sku_name, category1_id, category1_name, category2_id,
               category2_name, category3_id, category3_name, tm_id, tm_name, order_count_1d,
               distinct_order_count_1d, order_num_1d, order_original_amount_1d,
               activity_reduce_amount_1d, coupon_reduce_amount_1d, order_total_amount_1d, ds
        FROM (SELECT user_id, sku_id, ds, count(*) AS order_count_1d,
                     count(DISTINCT order_id) AS distinct_order_count_1d,
                     CAST(sum(sku_num) AS BIGINT) AS order_num_1d,
                     CAST(sum(original) AS DECIMAL(26,2)) AS order_original_amount_1d,
                     CAST(sum(off) AS DECIMAL(26,2)) AS activity_reduce_amount_1d,
                     CAST(sum(coupon) AS DECIMAL(26,2)) AS coupon_reduce_amount_1d,
                     CAST(sum(CAST(original - off - coupon AS DECIMAL(16,2))) AS DECIMAL(26,2))
                         AS order_total_amount_1d
              FROM x_line LEFT JOIN x_head ON order_id = o_orderkey GROUP BY 1, 2, 3)
             LEFT JOIN d_product USING (sku_id)""",
    "a_user": """
        SELECT user_id, count(DISTINCT order_id) AS order_count_1d,
               CAST(sum(sku_num) AS BIGINT) AS order_num_1d,
               CAST(sum(original) AS DECIMAL(26,2)) AS order_original_amount_1d,
               CAST(sum(off) AS DECIMAL(26,2)) AS activity_reduce_amount_1d,
               CAST(sum(coupon) AS DECIMAL(26,2)) AS coupon_reduce_amount_1d,
               CAST(sum(original - off - coupon) AS DECIMAL(26,2)) AS order_total_amount_1d, ds
        FROM x_line LEFT JOIN x_head ON order_id = o_orderkey GROUP BY user_id, ds""",
    "a_province": """
        SELECT province_id, province_name, area_code, iso_code, iso_3166_2,
               count(DISTINCT order_id) AS order_count_1d,
               CAST(sum(original) AS DECIMAL(26,2)) AS order_original_amount_1d,
               CAST(sum(off) AS DECIMAL(26,2)) AS activity_reduce_amount_1d,
               CAST(sum(coupon) AS DECIMAL(26,2)) AS coupon_reduce_amount_1d,
               CAST(sum(original - off - coupon) AS DECIMAL(26,2)) AS order_total_amount_1d, ds
        FROM x_line LEFT JOIN x_head ON order_id = o_orderkey
             LEFT JOIN d_province ON province_id = d_province.id
        GROUP BY ALL""",
    "a_coupon": """
        SELECT user_id, coupon_id, coupon_name, coupon_type_code, coupon_type_name, benefit_rule,
               count(*) AS used_count_1d, ds
        FROM f_coupon LEFT JOIN d_coupon ON coupon_id = d_coupon.id GROUP BY ALL""",
    "a_favor": """
        SELECT sku_id, sku_name, category1_id, category1_name, category2_id, category2_name,
               category3_id, category3_name, tm_id, tm_name, count(*) AS favor_add_count_1d, ds
        FROM f_favor LEFT JOIN d_product USING (sku_id) GROUP BY ALL""",
    "a_session": """
        SELECT session_id, mid_id, brand, model, operate_system, version_code, channel,
               CAST(sum(during_time) AS BIGINT) AS during_time_1d, count(*) AS page_count_1d, ds
        FROM x_log GROUP BY ALL""",
    "a_visitor": """
        SELECT mid_id, brand, model, operate_system, page_id,
               CAST(sum(during_time) AS BIGINT) AS during_time_1d, count(*) AS view_count_1d, ds
        FROM x_log GROUP BY ALL""",
    # horizons and totals
    "h_user_product": f"""
        SELECT user_id, sku_id, sku_name, category1_id, category1_name, category2_id,
               category2_name, category3_id, category3_name, tm_id, tm_name,
               CAST(coalesce(sum(order_count_1d) FILTER (ds >= '1998-06-24'), 0) AS BIGINT)
                   AS order_count_7d,
               CAST(coalesce(sum(order_num_1d) FILTER (ds >= '1998-06-24'), 0) AS BIGINT)
                   AS order_num_7d,
               CAST(coalesce(sum(order_original_amount_1d) FILTER (ds >= '1998-06-24'), 0)
                    AS DECIMAL(26,2)) AS order_original_amount_7d,
               CAST(coalesce(sum(activity_reduce_amount_1d) FILTER (ds >= '1998-06-24'), 0)
                    AS DECIMAL(26,2)) AS activity_reduce_amount_7d,
               CAST(coalesce(sum(coupon_reduce_amount_1d) FILTER (ds >= '1998-06-24'), 0)
                    AS DECIMAL(26,2)) AS coupon_reduce_amount_7d,
               CAST(coalesce(sum(order_total_amount_1d) FILTER (ds >= '1998-06-24'), 0)
                    AS DECIMAL(26,2)) AS order_total_amount_7d,
               CAST(sum(order_count_1d) AS BIGINT) AS order_count_30d,
               CAST(sum(order_num_1d) AS BIGINT) AS order_num_30d,
               CAST(sum(order_original_amount_1d) AS DECIMAL(26,2)) AS order_original_amount_30d,
               CAST(sum(activity_reduce_amount_1d) AS DECIMAL(26,2)) AS activity_reduce_amount_30d,
               CAST(sum(coupon_reduce_amount_1d) AS DECIMAL(26,2)) AS coupon_reduce_amount_30d,
               CAST(sum(order_total_amount_1d) AS DECIMAL(26,2)) AS order_total_amount_30d,
               '{ORDER_DAY}' AS ds
        FROM a_user_product WHERE ds BETWEEN '1998-06-01' AND '{ORDER_DAY}'
        GROUP BY user_id, sku_id, sku_name, category1_id, category1_name, category2_id,
                 category2_name, category3_id, category3_name, tm_id, tm_name""",
    "h_province": f"""
        SELECT province_id, province_name, area_code, iso_code, iso_3166_2,
               CAST(coalesce(sum(order_count_1d) FILTER (ds >= '1998-06-24'), 0) AS BIGINT)
                   AS order_count_7d,
               CAST(coalesce(sum(order_original_amount_1d) FILTER (ds >= '1998-06-24'), 0)
                    AS DECIMAL(26,2)) AS order_original_amount_7d,
               CAST(coalesce(sum(activity_reduce_amount_1d) FILTER (ds >= '1998-06-24'), 0)
                    AS DECIMAL(26,2)) AS activity_reduce_amount_7d,
               CAST(coalesce(sum(coupon_reduce_amount_1d) FILTER (ds >= '1998-06-24'), 0)
                    AS DECIMAL(26,2)) AS coupon_reduce_amount_7d,
               CAST(coalesce(sum(order_total_amount_1d) FILTER (ds >= '1998-06-24'), 0)
                    AS DECIMAL(26,2)) AS order_total_amount_7d,
               CAST(sum(order_count_1d) AS BIGINT) AS order_count_30d,
               CAST(sum(order_original_amount_1d) AS DECIMAL(26,2)) AS order_original_amount_30d,
               CAST(sum(activity_reduce_amount_1d) AS DECIMAL(26,2)) AS activity_reduce_amount_30d,
               CAST(sum(coupon_reduce_amount_1d) AS DECIMAL(26,2)) AS coupon_reduce_amount_30d,
               CAST(sum(order_total_amount_1d) AS DECIMAL(26,2)) AS order_total_amount_30d,
               '{ORDER_DAY}' AS ds
        FROM a_province WHERE ds BETWEEN '1998-06-01' AND '{ORDER_DAY}'
        GROUP BY province_id, province_name, area_code, iso_code, iso_3166_2""",
    "t_user": f"""
        SELECT user_id, min(ds) AS order_date_first, max(ds) AS order_date_last,
               CAST(sum(order_count_1d) AS BIGINT) AS order_count_td,
               CAST(sum(order_num_1d) AS BIGINT) AS order_num_td,
               CAST(sum(order_original_amount_1d) AS DECIMAL(26,2)) AS original_amount_td,
               CAST(sum(activity_reduce_amount_1d) AS DECIMAL(26,2)) AS activity_reduce_amount_td,
               CAST(sum(coupon_reduce_amount_1d) AS DECIMAL(26,2)) AS coupon_reduce_amount_td,
               CAST(sum(order_total_amount_1d) AS DECIMAL(26,2)) AS total_amount_td,
               '{ORDER_DAY}' AS ds
        FROM a_user WHERE a_user.ds <= '{ORDER_DAY}' GROUP BY user_id""",
    "t_login": f"""
        SELECT c_custkey AS user_id, coalesce(max(f_login.ds), strftime(born, '%Y-%m-%d'))
                   AS login_date_last,
               strftime(born, '%Y-%m-%d') AS login_date_first,
               greatest(count(f_login.ds), 1) AS login_count_td, '{LOG_DAY}' AS ds
        FROM x_user LEFT JOIN f_login ON c_custkey = user_id AND f_login.ds <= '{LOG_DAY}'
        WHERE strftime(born, '%Y-%m-%d') <= '{LOG_DAY}' GROUP BY c_custkey, born""",
    "t_login_before": f"""
        SELECT c_custkey AS user_id, coalesce(max(f_login.ds), strftime(born, '%Y-%m-%d'))
                   AS login_date_last
        FROM x_user LEFT JOIN f_login ON c_custkey = user_id AND f_login.ds <= '2024-01-29'
        WHERE strftime(born, '%Y-%m-%d') <= '2024-01-29' GROUP BY c_custkey, born""",
    # moderation
    "x_grade": """
        SELECT doc_id AS comment_id, source AS user_id, n_chars,
               CASE WHEN regexp_matches(lower(text), 'scum|moron') THEN 'P0'
                    WHEN regexp_matches(lower(text), 'trash|idiot|stupid|loser') THEN 'P1'
                    WHEN regexp_matches(lower(text), 'worthless|pathetic|disgusting|clown')
                         THEN 'P2' END AS grade
        FROM documents""",
    "x_word": """
        SELECT DISTINCT doc_id AS comment_id,
               unnest(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+')) AS word
        FROM documents""",
    "x_stem": """
        SELECT DISTINCT word, CASE WHEN length(word) >= 12 THEN 'P0' WHEN length(word) >= 10 THEN 'P1' ELSE 'P2' END AS grade
        FROM (SELECT unnest(regexp_split_to_array(lower(text), '[^a-z]+')) AS word FROM benchmark)
        WHERE length(word) >= 7""",
    "x_stem_found": """
        SELECT doc_id, word, grade FROM documents JOIN x_stem ON contains(lower(text), word)""",
    # windows
    "x_session": """
        SELECT user_id, min(ts) AS since, max(ts) + INTERVAL 6 HOUR AS until, count(*) AS event_count,
               max(event_id) AS last_event
        FROM (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS no
              FROM (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)
                                        <= INTERVAL 6 HOUR THEN 0 ELSE 1 END AS fresh
                    FROM events WHERE user_id IS NOT NULL))
        GROUP BY user_id, no""",
    "x_offence": """
        SELECT event_id, user_id, (epoch_us(ts) - 1704067200000000) * 50 + 1704067200000000 AS t,
               CASE WHEN value < 5 THEN 'P0' WHEN value < 30 THEN 'P1' ELSE 'P2' END AS grade
        FROM events WHERE event_type = 'error'""",
    "x_ban": """
        SELECT user_id, make_timestamp(min(t)) AS since, make_timestamp(max(until)) AS until, min(grade) AS worst_grade,
               count(*) AS offences
        FROM (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY t, event_id ROWS UNBOUNDED PRECEDING) AS no
              FROM (SELECT *, CASE WHEN t <= max(until) OVER (PARTITION BY user_id ORDER BY t, event_id
                                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS fresh
                    FROM (SELECT *, t + CASE grade WHEN 'P0' THEN 365 ELSE 60 END * 86400000000 AS until
                          FROM x_offence WHERE grade <> 'P2' AND user_id IS NOT NULL)))
        GROUP BY user_id, no""",
    "x_list": """
        SELECT * FROM (VALUES ('scum', 'P0'), ('moron', 'P0'), ('trash', 'P1'), ('idiot', 'P1'),
            ('stupid', 'P1'), ('loser', 'P1'), ('worthless', 'P2'), ('pathetic', 'P2'),
            ('disgusting', 'P2'), ('clown', 'P2')) AS w(listed, grade)""",
    "x_cells": """
        SELECT c_mktsegment || '_' || c_custkey AS row_key,
               unnest(['c_acctbal', 'c_mktsegment', 'c_name', 'c_nationkey']) AS qualifier,
               unnest([CAST(CAST(c_acctbal AS DECIMAL(16,2)) AS VARCHAR), c_mktsegment, c_name,
                       CASE WHEN c_nationkey > 4 THEN CAST(c_nationkey AS VARCHAR) END]) AS value
        FROM customer""",
    "x_row": """
        SELECT row_key, '{"row_key":"' || row_key || '",'
               || string_agg('"' || qualifier || '":"' || value || '"', ',' ORDER BY qualifier)
               || '}' AS row_json
        FROM x_cells WHERE value IS NOT NULL GROUP BY row_key""",
}
