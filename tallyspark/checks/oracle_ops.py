"""DuckDB formulations of the operator queries (``plans.operator_queries``)."""

from __future__ import annotations

from tallyspark.checks.oracle import JOB_SQL, MTD

_REVOLVING = """SELECT DISTINCT user_id FROM decisions
        WHERE biz_id = '12001' AND inserttime >= TIMESTAMP '2024-01-10 12:00:00' AND is_cyclic = 'true'"""

_NOOP = "x_ AS (SELECT 1)\n"

OP_SQL: dict[str, str] = {}

OP_SQL["loan_sequence"] = _NOOP + """
SELECT user_id, listing_id, withdraw_time,
       CAST(row_number() OVER (PARTITION BY user_id ORDER BY withdraw_time, listing_id) AS INTEGER) AS loan_n
FROM listings
"""

OP_SQL["partition_pruned_scan"] = _NOOP + """
SELECT flow_id, user_id, dt FROM decisions WHERE dt >= DATE '2024-01-15'
"""

OP_SQL["latest_snapshot"] = _NOOP + """
SELECT user_id, register_time, dt FROM registrations WHERE dt = (SELECT max(dt) FROM registrations)
"""

OP_SQL["month_to_date_filter"] = _NOOP + """
SELECT listing_id, user_id, withdraw_time, CAST(real_amount AS DOUBLE) AS real_amount
FROM listings WHERE CAST(withdraw_time AS DATE) BETWEEN DATE '2024-01-01' AND DATE '2024-01-10'
"""

OP_SQL["distinct_members"] = _NOOP + _REVOLVING

OP_SQL["in_list_filter"] = _NOOP + """
SELECT dt, biz_id, count(*) AS n FROM decisions WHERE biz_id IN ('10000', '10001', '11000') GROUP BY 1, 2
"""

OP_SQL["two_day_filter"] = _NOOP + """
SELECT flow_id, user_id, dt FROM decisions
WHERE CAST(inserttime AS DATE) IN (DATE '2024-01-09', DATE '2024-01-10')
"""

OP_SQL["not_in_filter"] = _NOOP + """
SELECT user_id, fst_level_channel FROM register_channel WHERE fst_level_channel NOT IN ('building')
"""

OP_SQL["null_tolerant_filter"] = _NOOP + """
SELECT dt,
       CAST(sum(CASE WHEN CAST(is_white_list AS INTEGER) = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_strict,
       CAST(sum(CASE WHEN CAST(is_white_list AS INTEGER) = 0 OR is_white_list IS NULL THEN 1 ELSE 0 END) AS BIGINT)
         AS n_tolerant
FROM decisions WHERE biz_id IN ('10000', '10001', '11000') GROUP BY dt
"""

OP_SQL["slice_at_date"] = f"""
j9 AS (WITH {JOB_SQL['limit_application_panel'].strip()}),
s AS (SELECT *, limit_date = DATE '2024-01-10' AND biz_type = 'cashloan' AS sel FROM j9)
SELECT CAST(coalesce(sum(CASE WHEN sel THEN limit_num END), 0) AS DOUBLE) AS users_sum,
       CAST(coalesce(sum(CASE WHEN sel THEN num END), 0) AS DOUBLE) AS num_sum,
       max(CASE WHEN sel THEN pass_rate END) AS pass_rate_max,
       avg(CASE WHEN sel THEN pass_rate END) AS pass_rate_mean,
       max(CASE WHEN sel AND is_reloan = '1' THEN pass_rate_newtoold END) AS n2o_max,
       coalesce(max(pass_rate) FILTER (sel), 0.0) AS pass_rate_pick
FROM s
"""

OP_SQL["join_on_predicate"] = """
lim AS (SELECT flow_id, dt FROM decisions WHERE biz_id IN ('10000', '10001'))
SELECT l.dt, count(*) AS row_cnt, count(m.limit_flow_no) AS matched_cnt
FROM lim l LEFT JOIN limit_loan m ON l.flow_id = m.limit_flow_no AND m.asset_product = 'cashloan'
GROUP BY 1
"""

OP_SQL["first_event_per_key"] = """
r AS (SELECT user_id, withdraw_time, listing_id, CAST(real_amount AS DOUBLE) AS real_amount,
             row_number() OVER (PARTITION BY user_id ORDER BY withdraw_time, listing_id) AS rn
      FROM loans)
SELECT user_id, withdraw_time, listing_id, real_amount FROM r WHERE rn = 1
"""

OP_SQL["membership_flag"] = f"""
m AS ({_REVOLVING})
SELECT l.listing_id, l.user_id, m.user_id IS NOT NULL AS is_member
FROM listings l LEFT JOIN m ON l.user_id = m.user_id
"""

OP_SQL["chained_enrichment"] = _NOOP + """
SELECT lo.listing_id, lo.asset_product, mid.loan_apply_no, d.down_payment_ratio
FROM loans lo
LEFT JOIN limit_loan mid ON lo.listing_id = mid.listing_id
LEFT JOIN merchant_orders d ON mid.loan_apply_no = d.loan_apply_no
"""

OP_SQL["allow_list_join"] = """
reg AS (SELECT user_id, CAST(register_time AS DATE) AS reg_day FROM registrations
        WHERE dt = (SELECT max(dt) FROM registrations))
SELECT reg.user_id, reg.reg_day FROM reg JOIN register_channel c ON reg.user_id = c.user_id
WHERE c.fst_level_channel NOT IN ('building')
"""

OP_SQL["daily_rollup_sum"] = _NOOP + """
SELECT biz_date, user_type, CAST(sum(deal_cnt) AS BIGINT) AS deal_cnt, CAST(sum(deal_amount) AS DOUBLE) AS deal_amount
FROM daily_deals GROUP BY 1, 2
"""

OP_SQL["weighted_ratio"] = """
l AS (SELECT CAST(withdraw_time AS DATE) AS withdraw_date, asset_product, real_amount,
             TRY_CAST(period_no AS INTEGER) AS period FROM listings)
SELECT withdraw_date, asset_product,
       CAST(sum(period * real_amount) AS DOUBLE) / nullif(CAST(sum(real_amount) AS DOUBLE), 0) AS avg_term,
       CAST(sum(real_amount) AS DOUBLE) AS avg_term_weight
FROM l GROUP BY 1, 2
"""

OP_SQL["flag_rate"] = _NOOP + """
SELECT dt, biz_id, avg(CAST(process_flag AS INTEGER)) AS pass_rate FROM decisions GROUP BY 1, 2
"""

OP_SQL["conditional_rate"] = _NOOP + """
SELECT dt, avg(CASE WHEN paid_loans_cnt = '1' THEN CAST(process_flag AS INTEGER) ELSE NULL END) AS pass_rate_newtoold
FROM decisions WHERE biz_id IN ('10000', '10001') GROUP BY dt
"""

OP_SQL["conditional_count"] = _NOOP + """
SELECT dt,
       CAST(sum(CASE WHEN CAST(credit_limit AS FLOAT) > 0 THEN 1 ELSE 0 END) AS BIGINT) AS has_limit_cnt,
       CAST(sum(CASE WHEN CAST(credit_limit AS FLOAT) > 0 AND risk_grade IN ('A', 'B', 'C') THEN 1 ELSE 0 END)
            AS BIGINT) AS prime_has_limit_cnt
FROM decisions WHERE biz_id IN ('10000', '10001') GROUP BY dt
"""

OP_SQL["distinct_users_daily"] = _NOOP + """
SELECT dt, biz_id, count(DISTINCT user_id) AS users FROM decisions GROUP BY 1, 2
"""

OP_SQL["conditional_distinct"] = _NOOP + """
SELECT CAST(withdraw_time AS DATE) AS wday, count(DISTINCT user_id) AS users,
       count(DISTINCT CASE WHEN is_deal = 1 AND is_calm_period_repay = 0 THEN user_id END) AS ok_users
FROM limit_loan_b GROUP BY 1
"""

OP_SQL["group_by_case"] = f"""
m AS ({_REVOLVING})
SELECT CASE WHEN m.user_id IS NULL THEN 'notre' ELSE 're' END AS re_type, l.asset_product,
       count(*) AS num, CAST(sum(l.real_amount) AS DOUBLE) AS amount_sum
FROM listings l LEFT JOIN m ON l.user_id = m.user_id
GROUP BY 1, 2
"""

OP_SQL["funnel_ratio"] = """
g AS (SELECT register_date, asset_product,
             CAST(sum(register_user_cnt) AS BIGINT) AS register_user_cnt,
             CAST(sum(apply_limit_user_cnt) AS BIGINT) AS apply_limit_user_cnt,
             CAST(sum(fst_has_limit_user_cnt) AS BIGINT) AS fst_has_limit_user_cnt,
             CAST(sum(withdraw_succ_user_cnt) AS BIGINT) AS withdraw_succ_user_cnt
      FROM register_funnel GROUP BY 1, 2)
SELECT *,
       CAST(apply_limit_user_cnt AS DOUBLE) / nullif(CAST(register_user_cnt AS DOUBLE), 0) AS apply_rate,
       CAST(withdraw_succ_user_cnt AS DOUBLE) / nullif(CAST(fst_has_limit_user_cnt AS DOUBLE), 0) AS withdraw_rate
FROM g
"""

OP_SQL["amount_to_count_ratio"] = """
i AS (SELECT CAST(date_trunc('month', due_date) AS DATE) AS due_month, asset_product, principal,
             CASE WHEN debt_status = 2 THEN 0 ELSE 1 END AS unpaid
      FROM installments WHERE period_seq = 1),
g AS (SELECT due_month, asset_product,
             CAST(coalesce(sum(CASE WHEN unpaid = 1 THEN principal END), 0) AS DOUBLE)
               / nullif(CAST(sum(principal) AS DOUBLE), 0) AS a,
             avg(CAST(unpaid AS DOUBLE)) AS c
      FROM i GROUP BY 1, 2)
SELECT due_month, asset_product, a AS unpaid_amt_to_cnt_amount_rate, c AS unpaid_amt_to_cnt_count_rate,
       a / nullif(c, 0) AS unpaid_amt_to_cnt
FROM g
"""

OP_SQL["mtd_cumulative"] = f"""
g AS (SELECT biz_date, user_type, CAST(sum(deal_cnt) AS BIGINT) AS deal_cnt, sum(deal_amount) AS amt
      FROM daily_deals GROUP BY 1, 2)
SELECT biz_date, user_type, deal_cnt, CAST(sum(deal_cnt) OVER w AS BIGINT) AS mtd_cnt,
       CAST(amt AS DOUBLE) AS deal_amount, CAST(sum(amt) OVER w AS DOUBLE) AS mtd_amount
FROM g
WINDOW w AS (PARTITION BY user_type, date_trunc('month', biz_date) ORDER BY biz_date {MTD})
"""

OP_SQL["day_over_day_change"] = f"""
j9 AS (WITH {JOB_SQL['limit_application_panel'].strip()}),
g AS (SELECT limit_date, is_reloan, pass_rate FROM j9 WHERE biz_type = 'cashloan')
SELECT g.*, g.pass_rate - p.pass_rate AS pass_rate_dod
FROM g LEFT JOIN g p ON p.is_reloan = g.is_reloan AND p.limit_date = g.limit_date - 1
"""

OP_SQL["map_attribute"] = _NOOP + """
SELECT flow_id, biz_id, CAST(process_flag AS INTEGER) AS process_flag,
       CAST(is_white_list AS INTEGER) AS is_white_list, CAST(credit_limit AS DOUBLE) AS credit_limit,
       risk_grade, CAST(NULL AS VARCHAR) AS missing_key
FROM decisions
"""

OP_SQL["fill_nulls"] = """
cal AS (SELECT DISTINCT dt FROM decisions),
rev AS (SELECT dt, avg(CAST(process_flag AS INTEGER)) AS pass_rate, count(*) AS n FROM decisions
        WHERE biz_id = '12001' AND CAST(is_reloan AS INTEGER) = 1 AND risk_grade = 'A' GROUP BY dt)
SELECT cal.dt, coalesce(rev.pass_rate, 0) AS pass_rate, coalesce(rev.n, 0) AS n
FROM cal LEFT JOIN rev ON cal.dt = rev.dt
"""

OP_SQL["currency_convert"] = _NOOP + """
SELECT CAST(withdraw_time AS DATE) AS withdraw_date,
       CAST(sum(real_amount) AS DOUBLE) / CAST(284 AS DOUBLE) AS amount_usd
FROM listings GROUP BY 1
"""

OP_SQL["cohort_conversion"] = """
lim AS (SELECT flow_id, CAST(inserttime AS DATE) AS limit_date, is_reloan FROM decisions
        WHERE biz_id IN ('10000', '10001') AND CAST(is_white_list AS INTEGER) = 0 AND process_flag = '1'),
mid AS (SELECT limit_flow_no, CAST(withdraw_time AS DATE) AS withdraw_date
        FROM limit_loan WHERE asset_product = 'cashloan'),
per AS (SELECT l.flow_id, l.limit_date, l.is_reloan,
               max(CASE WHEN date_diff('day', l.limit_date, m.withdraw_date) <= 0 THEN 1 ELSE 0 END) AS c0,
               max(CASE WHEN date_diff('day', l.limit_date, m.withdraw_date) <= 7 THEN 1 ELSE 0 END) AS c7
        FROM lim l LEFT JOIN mid m ON l.flow_id = m.limit_flow_no
        GROUP BY 1, 2, 3)
SELECT limit_date AS limit_day, is_reloan,
       count(*) AS t0_rows, CAST(sum(c0) AS BIGINT) AS t0_conv, avg(c0) AS t0_rate,
       count(*) AS t7_rows, CAST(sum(c7) AS BIGINT) AS t7_conv, avg(c7) AS t7_rate
FROM per GROUP BY 1, 2
"""

OP_SQL["same_day_conversion"] = """
e AS (SELECT DISTINCT user_id, dt AS entry_day FROM decisions WHERE biz_id IN ('10000', '10001')),
c AS (SELECT DISTINCT user_id, CAST(withdraw_time AS DATE) AS conv_day FROM loans)
SELECT e.entry_day, count(DISTINCT e.user_id) AS entry_users, count(DISTINCT c.user_id) AS conv_users,
       CAST(count(DISTINCT c.user_id) AS DOUBLE) / nullif(CAST(count(DISTINCT e.user_id) AS DOUBLE), 0) AS rate
FROM e LEFT JOIN c ON e.user_id = c.user_id AND e.entry_day = c.conv_day
GROUP BY 1
"""

OP_SQL["cost_per_acquisition"] = """
c AS (SELECT biz_date, sum(cost) AS cost FROM ad_cost GROUP BY 1),
v AS (SELECT biz_date, sum(fst_withdraw_succ_cnt) AS conv FROM daily_conversions GROUP BY 1)
SELECT c.biz_date, CAST(c.cost AS DOUBLE) AS cost, CAST(v.conv AS BIGINT) AS conversions,
       CAST(c.cost AS DOUBLE) / nullif(CAST(v.conv AS DOUBLE), 0) AS cps
FROM c LEFT JOIN v ON c.biz_date = v.biz_date
"""

OP_SQL["latest_snapshot_partition"] = _NOOP + """
SELECT user_id, register_time, DATE '2024-01-31' AS dt FROM first_signup
"""

_DIRTY = """
d AS (SELECT *, CAST(flow_id AS BIGINT) AS n FROM decisions)
"""

OP_SQL["stored_decision_log"] = _DIRTY + """
SELECT user_id, flow_id, listing_id, if(n % 101 = 0, NULL, date_trunc('second', inserttime)) AS inserttime, dt, biz_id,
       if(n % 97 = 0, NULL, process_flag) AS process_flag, if(n % 89 = 0, '1', is_reloan) AS is_reloan,
       if(n % 83 = 0, NULL, is_white_list) AS is_white_list, if(n % 73 = 0, NULL, is_cyclic) AS is_cyclic, paid_loans_cnt,
       if(n % 79 = 0, NULL, if(credit_limit = 0, '0', CAST(credit_limit AS VARCHAR))) AS credit_limit, risk_grade
FROM d
"""

OP_SQL["rejected_values"] = _DIRTY + """,
v AS (SELECT * FROM (VALUES ('process_flag', 97, 'yes'), ('is_reloan', NULL, NULL), ('is_white_list', 83, ''), ('is_cyclic', 73, 'cyclic'),
                            ('paid_loans_cnt', NULL, NULL), ('credit_limit', 79, '1,000'), ('inserttime', 101, 'not a time'),
                            ('dt', NULL, NULL)) t(name, step, txt))
SELECT v.name AS "column", count(d.n) AS rejected, if(count(d.n) > 0, any_value(v.txt), NULL) AS example
FROM v LEFT JOIN d ON d.n % v.step = 0 GROUP BY v.name
"""

OP_SQL["first_in_window_conversion"] = """
e AS (SELECT user_id, dt AS entry_day, biz_id IN ('10000', '10001') AS counted FROM decisions),
w AS (SELECT user_id, withdraw_time, CAST(withdraw_time AS DATE) AS d FROM loans),
firsts AS (SELECT r.d, w.user_id, min(w.withdraw_time) AS first_time
           FROM (SELECT DISTINCT entry_day AS d FROM e) r JOIN w ON w.d BETWEEN r.d - 1 AND r.d GROUP BY ALL),
own AS (SELECT DISTINCT user_id, d FROM w)
SELECT e.entry_day, count(*) FILTER (e.counted) AS entries,
       count(*) FILTER (e.counted AND CAST(f.first_time AS DATE) = e.entry_day) AS "first",
       count(*) FILTER (e.counted AND o.user_id IS NOT NULL) AS "any"
FROM e LEFT JOIN firsts f ON f.user_id = e.user_id AND f.d = e.entry_day
LEFT JOIN own o ON o.user_id = e.user_id AND o.d = e.entry_day
GROUP BY ALL
"""
