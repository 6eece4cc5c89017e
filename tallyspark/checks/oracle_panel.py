"""DuckDB formulation of the panel for any list of reporting days: the twenty job
slices, last-writer-wins merge, attainment, completeness and report.

A slice joins the reporting days ``a`` with a job's daily rows ``g`` and reduces
them by day.  Targets, attainment, catalogue and layouts are those of
``checks.pinned``, not the engine's.
"""

from __future__ import annotations

import datetime as _dt

from tallyspark.checks import pinned
from tallyspark.checks.oracle import BNPL, BOOK, DUE, JOB_SQL, rnd

DAY = "DATE '2024-01-10'"
MONTH = [f"DATE '{_dt.date(2024, 1, d)}'" for d in range(1, 31)]
TARGET = dict(pinned.TARGETS)
AE = "a.as_of"


def _over(name: str) -> str:
    """A job's daily rows beside each reporting day."""
    return f"days a LEFT JOIN (WITH {JOB_SQL[name].strip()}) g ON true GROUP BY a.as_of"


def _pick(v: str, cond: str, empty: str = "0.0") -> str:
    return f"coalesce(max({v}) FILTER ({cond}), {empty})"


def _ssum(v: str, cond: str) -> str:
    return f"coalesce(sum({v}) FILTER ({cond}), 0)"


def _d(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


SLICES: dict[str, str] = {}

_kept = "is_calm_period_repay <> 1"
_usd, _new, _old = (f"{float(TARGET[k])!r}" for k in ("month_loan_amount_usd", "month_new_loan_cnt", "month_old_loan_cnt"))
_fx = f"{float(TARGET['fx_rate'])!r}"
SLICES["daily_loan_panel"] = f"""
b1 AS (SELECT a.as_of,
   {_d(_ssum('deal_amount', f"biz_date = {AE} AND {_kept}"))} AS amt_today,
   {_d(_ssum('deal_amount', _kept))} AS amt_mtd,
   {_d(_ssum('deal_cnt', f"biz_date = {AE} AND {_kept} AND user_type = 'new'"))} AS new_cnt,
   {_d(_ssum('deal_cnt', f"biz_date = {AE} AND {_kept} AND user_type = 'old'"))} AS old_cnt,
   {_d(_ssum('deal_amount', f"biz_date = {AE} AND {_kept} AND user_type = 'new'"))} AS new_amt,
   {_d(_ssum('deal_amount', f"biz_date = {AE} AND {_kept} AND user_type = 'old'"))} AS old_amt,
   {_d(_ssum('deal_cnt', f"{_kept} AND user_type = 'new'"))} AS new_mtd,
   {_d(_ssum('deal_cnt', f"{_kept} AND user_type = 'old'"))} AS old_mtd
   FROM days a LEFT JOIN daily_deals g
     ON g.product_type <> 32 AND g.biz_date BETWEEN date_trunc('month', {AE}) AND {AE} GROUP BY a.as_of),
s_daily_loan_panel AS (SELECT as_of,
   {rnd(f'amt_today / {_fx}', 1)} AS loan_amount_usd,
   {rnd(rnd(f'amt_today / {_fx}', 1) + f' / {_usd}', 4)} AS loan_amount_vs_month_target,
   {rnd(f'amt_mtd / {_fx} / {_usd}', 4)} AS loan_amount_mtd_vs_target,
   new_cnt AS new_loan_cnt, old_cnt AS old_loan_cnt,
   {rnd(f'new_amt / {_fx}', 1)} AS new_loan_amount_usd,
   {rnd(f'old_amt / {_fx}', 1)} AS old_loan_amount_usd,
   {rnd(f'new_cnt / {_new}', 4)} AS new_loan_cnt_vs_target,
   {rnd(f'old_cnt / {_old}', 4)} AS old_loan_cnt_vs_target,
   {rnd(f'new_mtd / {_new}', 4)} AS new_loan_cnt_mtd_vs_target,
   {rnd(f'old_mtd / {_old}', 4)} AS old_loan_cnt_mtd_vs_target
   FROM b1)"""

SLICES["bid_pass_rate_daily"] = f"""
s_bid_pass_rate_daily AS (SELECT a.as_of, {_d(f"max(pass_rate) FILTER (dt = {AE})")} AS revolving_bid_pass_rate
   FROM {_over('bid_pass_rate_daily')})"""

SLICES["registration_cohort_funnel"] = f"""
s_registration_cohort_funnel AS (SELECT a.as_of,
   {_d(_ssum('haslimit_withdraw_rate', f'register_date = {AE}'))} AS new_haslimit_withdraw_rate,
   {_d(_ssum('register_apply_rate', f'register_date = {AE} - 3'))} AS register_apply_rate_t3
   FROM {_over('registration_cohort_funnel')})"""

SLICES["natural_day_funnel"] = f"""
s_natural_day_funnel AS (SELECT a.as_of,
   {_d(_ssum('reapply_rate_t0', f'biz_date = {AE}'))} AS reapply_rate_t0,
   {_d(_ssum('first_apply_pass_rate', f'biz_date = {AE}'))} AS first_apply_pass_rate
   FROM {_over('natural_day_funnel')})"""

SLICES["settlement_reloan_funnel"] = f"""
s_settlement_reloan_funnel AS (SELECT a.as_of,
   {_d(_ssum('old_haslimit_withdraw_rate', f'repay_date = {AE}'))} AS old_haslimit_withdraw_rate
   FROM {_over('settlement_reloan_funnel')})"""

SLICES["static_cps"] = f"""
s_static_cps AS (SELECT a.as_of, {_d(_ssum('s_cps', f'biz_date = {AE}'))} AS static_cps FROM {_over('static_cps')})"""


def _fpd_amt(k: int, cond: str) -> str:
    return (f"CAST({_ssum('principal', f'{cond} AND coalesce(late, {k}) >= {k}')} AS DOUBLE)"
            f" / nullif(CAST(sum(principal) FILTER ({cond}) AS DOUBLE), 0)")


def _fpd_cnt(k: int, cond: str) -> str:
    return (f"CAST(count(*) FILTER ({cond} AND coalesce(late, {k}) >= {k}) AS DOUBLE)"
            f" / nullif(CAST(count(*) FILTER ({cond}) AS DOUBLE), 0)")


_N1 = f"due_date = {AE} AND product_user_type = 'new' AND asset_product = 'cashloan'"
_O1 = f"due_date = {AE} AND product_user_type = 'old' AND asset_product = 'cashloan'"
_N7 = f"due_date = {AE} - 6 AND product_user_type = 'new' AND asset_product = 'cashloan'"
_O7 = f"due_date = {AE} - 6 AND product_user_type = 'old' AND asset_product = 'cashloan'"
_B1 = f"due_date = {AE} AND asset_product = 'bnpl'"
_B7 = f"due_date = {AE} - 6 AND asset_product = 'bnpl'"

SLICES["first_payment_default"] = f"""
{DUE.strip()},
s_first_payment_default AS (SELECT a.as_of,
   CAST(strftime(max(due_date) FILTER ({_N1}) - 14, '%Y%m%d') AS DOUBLE) AS fpd1_cohort_date,
   {_fpd_amt(1, _N1)} AS new_fpd1_amt,
   {_fpd_amt(1, _O1)} AS old_fpd1_amt,
   CAST(strftime(max(due_date) FILTER ({_N7}) - 14, '%Y%m%d') AS DOUBLE) AS fpd7_cohort_date,
   {_fpd_amt(7, _N7)} AS new_fpd7_amt,
   ({_fpd_amt(7, _N7)}) / nullif({_fpd_cnt(7, _N7)}, 0) AS new_fpd7_amt_to_cnt,
   {_fpd_amt(7, _O7)} AS old_fpd7_amt,
   ({_fpd_amt(7, _O7)}) / nullif({_fpd_cnt(7, _O7)}, 0) AS old_fpd7_amt_to_cnt,
   {_fpd_amt(1, _B1)} AS bnpl_fpd1_amt,
   CAST(count(*) FILTER ({_B1}) AS DOUBLE) AS bnpl_fpd1_due_cnt,
   {_fpd_amt(7, _B7)} AS bnpl_fpd7_amt,
   CAST(count(*) FILTER ({_B7}) AS DOUBLE) AS bnpl_fpd7_due_cnt
   FROM days a LEFT JOIN due ON due.due_date BETWEEN {AE} - 6 AND {AE} GROUP BY a.as_of)"""

SLICES["settled_loans"] = f"""
s_settled_loans AS (SELECT a.as_of,
   {_d(_ssum('settled_cnt', f"repay_date = {AE} AND user_type = 'new'"))} AS new_settled_cnt,
   {_d(_ssum('settled_cnt', f"repay_date = {AE} AND user_type = 'old'"))} AS old_settled_cnt
   FROM {_over('settled_loans')})"""

_C9 = f"limit_date = {AE} AND biz_type = 'cashloan'"
SLICES["limit_application_panel"] = f"""
s_limit_application_panel AS (SELECT a.as_of,
   {_d(_ssum('limit_num', f"limit_date = {AE} AND biz_type = 'bnpl'"))} AS bnpl_apply_users,
   {_d(_ssum('num', f"biz_type = 'bnpl' AND limit_date BETWEEN date_trunc('month', {AE}) AND {AE}"))} AS bnpl_apply_mtd,
   {_d(_ssum('is_pass', f"limit_date = {AE} AND biz_type = 'bnpl'"))}
     / nullif({_d(_ssum('num', f"limit_date = {AE} AND biz_type = 'bnpl'"))}, 0) AS bnpl_apply_pass_rate,
   {_d(_ssum('limit_num', _C9 + " AND is_reloan = '0'"))} AS new_limit_users,
   avg(pass_rate) FILTER ({_C9} AND is_reloan = '0') AS new_limit_pass_rate,
   {_d(_ssum('limit_num', _C9 + " AND is_reloan = '1'"))} AS old_limit_users,
   avg(pass_rate) FILTER ({_C9} AND is_reloan = '1') AS old_limit_pass_rate,
   avg(pass_rate_newtoold) FILTER ({_C9} AND is_reloan = '1') AS new_to_old_limit_pass_rate
   FROM {_over('limit_application_panel')})"""


def _ticket(cond: str) -> str:
    return (f"{_d(_ssum('a', cond))} / {_fx} / nullif({_d(_ssum('num', cond))}, 0)")


def _term(cond: str, unit: int) -> str:
    return f"{_d(_ssum('pa', cond))} / nullif({_d(_ssum('a', cond))}, 0) * {unit}.0"


_T10 = f"withdraw_date = {AE} AND asset_product = 'cashloan'"
SLICES["ticket_size_and_term"] = f"""
{BOOK.strip()},
s_ticket_size_and_term AS (SELECT a.as_of,
   {_ticket(_T10 + ' AND NOT back')} AS new_ticket_usd,
   {_ticket(_T10 + ' AND back')} AS old_ticket_usd,
   {_term(_T10 + ' AND NOT back', 15)} AS new_term_days,
   {_term(_T10 + ' AND back', 15)} AS old_term_days,
   {_ticket(_T10 + " AND back AND re_type = 're'")} AS revolving_ticket_usd,
   {_d(_ssum('num', _T10 + " AND back AND re_type = 're'"))} AS revolving_loan_cnt,
   {_d(_ssum('a', _T10 + " AND back AND re_type = 're'"))} / {_fx} AS revolving_loan_amount_usd,
   {_ticket(_T10 + " AND back AND re_type = 'notre'")} AS nonrevolving_ticket_usd,
   {_term(f"withdraw_date = {AE} AND asset_product = 'bnpl'", 30)} AS bnpl_term_days
   FROM days a LEFT JOIN book ON withdraw_date = {AE} GROUP BY a.as_of)"""

SLICES["limit_to_withdraw_t0_t7"] = f"""
s_limit_to_withdraw_t0_t7 AS (SELECT a.as_of,
   {_pick('t0_rate', f"limit_day = {AE} AND is_reloan = '0'")} AS new_withdraw_rate_t0,
   {_pick('t0_rate', f"limit_day = {AE} AND is_reloan = '1'")} AS old_withdraw_rate_t0,
   {_pick('t7_rate', f"limit_day = {AE} - 7 AND is_reloan = '0'")} AS new_withdraw_rate_t7,
   {_pick('t7_rate', f"limit_day = {AE} - 7 AND is_reloan = '1'")} AS old_withdraw_rate_t7
   FROM {_over('limit_to_withdraw_t0_t7')})"""

SLICES["register_to_deal_same_day"] = f"""
s_register_to_deal_same_day AS (SELECT a.as_of,
   {_d(f"max(register_deal_rate) FILTER (day = {AE})")} AS register_deal_rate
   FROM {_over('register_to_deal_same_day')})"""

SLICES["register_to_limit_t0_t7"] = f"""
s_register_to_limit_t0_t7 AS (SELECT a.as_of,
   max(t0_rate) FILTER (reg_day = {AE}) AS register_limit_row_t0,
   max(t7_rate) FILTER (reg_day = {AE} - 7) AS register_limit_row_t7
   FROM {_over('register_to_limit_t0_t7')})"""

SLICES["cohort_cps_t0_t3"] = f"""
s_cohort_cps_t0_t3 AS (SELECT a.as_of,
   max(cps_t0) FILTER (reg_day = {AE}) AS cps_t0,
   max(cps_t3) FILTER (reg_day = {AE} - 2) AS cps_t3
   FROM {_over('cohort_cps_t0_t3')})"""

SLICES["bnpl_deal_panel"] = f"""
{BNPL.strip()},
s_bnpl_deal_panel AS (SELECT a.as_of,
   CAST(count(*) FILTER (dt = {AE}) AS DOUBLE) AS bnpl_deal_cnt,
   CAST(count(dt) AS DOUBLE) AS bnpl_deal_cnt_mtd,
   {_d(_ssum('real_amount', f'dt = {AE}'))} / {_fx} AS bnpl_deal_amount_usd,
   avg(periods) FILTER (dt = {AE}) * 30.0 AS bnpl_term_days,
   avg(down) FILTER (dt = {AE}) / 100.0 AS bnpl_down_payment
   FROM days a LEFT JOIN bnpl ON dt >= date_trunc('month', {AE}) GROUP BY a.as_of)"""


def _dod(v: str, prev: str, day: str, cond: str | None, name: str) -> str:
    c = f" AND {cond}" if cond else ""
    y = _pick(v, f"{day} = {AE}{c}")
    b = _pick(prev, f"{day} = {AE} - 1{c}", "NULL")
    return f"{y} AS {name}, ({y}) - ({b}) AS {name}_dod"


SLICES["same_day_withdraw_dod"] = f"""
s_same_day_withdraw_dod AS (SELECT a.as_of,
   {_dod('withdraw_rate', 'withdraw_rate', 'limit_day', "loan_type = 'n2o'", 'n2o_same_day_withdraw')},
   {_dod('withdraw_rate', 'withdraw_rate', 'limit_day', "loan_type = 'other'", 'other_same_day_withdraw')}
   FROM {_over('same_day_withdraw_dod')})"""

SLICES["revolving_withdraw_dod"] = f"""
s_revolving_withdraw_dod AS (SELECT a.as_of,
   {_dod('withdraw_rate', 'prev_day_rate', 'limit_day', None, 'revolving_withdraw_t0')}
   FROM {_over('revolving_withdraw_dod')})"""

SLICES["limit_to_bid_dod"] = f"""
s_limit_to_bid_dod AS (SELECT a.as_of,
   {_dod('bid_rate', 'bid_rate', 'limit_day', None, 'new_bid_rate_t0')},
   {_dod('prime_bid_rate', 'prime_bid_rate', 'limit_day', None, 'prime_bid_rate_t0')}
   FROM {_over('limit_to_bid_dod')})"""

SLICES["register_to_limit_dod"] = f"""
s_register_to_limit_dod AS (SELECT a.as_of,
   {_dod('reg_to_lim_rate', 'reg_to_lim_rate', 'reg_day', None, 'register_limit_user_t0')}
   FROM {_over('register_to_limit_dod')})"""

_R0 = f"dt = {AE} AND is_reloan = 0"
_R1 = f"dt = {AE} AND is_reloan = 1"
_R2 = f"dt = {AE} AND is_reloan = 1 AND is_new_to_old = 1"
SLICES["bid_panel_rollup"] = f"""
p20 AS (SELECT dt, CAST(is_reloan AS INTEGER) AS is_reloan, if(paid_loans_cnt = '1', 1, 0) AS is_new_to_old,
               count(process_flag) AS listing_num, sum(CAST(process_flag AS INTEGER)) AS pass_num
        FROM decisions WHERE biz_id IN ('20050', '22050') GROUP BY ALL),
s_bid_panel_rollup AS (SELECT a.as_of,
   {_d(_ssum('listing_num', _R0))} AS new_bid_cnt,
   {_d(_ssum('listing_num', _R1))} AS old_bid_cnt,
   {_d(_ssum('pass_num', _R0))} / nullif({_d(_ssum('listing_num', _R0))}, 0) AS new_bid_pass_rate,
   {_d(_ssum('pass_num', _R1))} / nullif({_d(_ssum('listing_num', _R1))}, 0) AS old_bid_pass_rate,
   {_d(_ssum('pass_num', _R2))} / nullif({_d(_ssum('listing_num', _R2))}, 0) AS n2o_bid_pass_rate
   FROM days a LEFT JOIN p20 ON dt = {AE} GROUP BY a.as_of)"""


def _values(rows, types) -> str:
    def lit(v, t):
        if v is None:
            return f"CAST(NULL AS {t})"
        if t == "VARCHAR":
            return "'" + str(v).replace("'", "''") + "'"
        return f"CAST({v} AS {t})"
    return ",\n".join("(" + ", ".join(lit(v, t) for v, t in zip(r, types)) + ")" for r in rows)


def panel_ctes(days: list[str]) -> str:
    parts = [SLICES[job].strip() for job in pinned.OWNERS]
    longs = [f"SELECT as_of, '{job}' AS job, {i} AS ord, metric, CAST(value AS DOUBLE) AS value "
             f"FROM s_{job} UNPIVOT INCLUDE NULLS (value FOR metric IN (COLUMNS(* EXCLUDE (as_of))))"
             for i, job in enumerate(pinned.OWNERS)]
    att = _values(pinned.ATTAINMENT, ["VARCHAR", "VARCHAR", "VARCHAR"])
    tgt = _values(pinned.TARGETS, ["VARCHAR", "DOUBLE"])
    return f"days AS (SELECT * FROM (VALUES {', '.join(f'({d})' for d in days)}) t(as_of)),\n" + ",\n".join(parts) + f""",
all_long AS ({' UNION ALL '.join(longs)}),
mt AS (SELECT as_of, metric, arg_max(job, ord) AS job, arg_max({{'v': value}}, ord).v AS value FROM all_long GROUP BY as_of, metric),
att_map AS (SELECT * FROM (VALUES {att}) t(att_metric, base_metric, target_key)),
targets AS (SELECT * FROM (VALUES {tgt}) t(target_key, target)),
att AS (SELECT mt.as_of, mt.job, a.att_metric AS metric, a.base_metric, t.target,
               mt.value / coalesce(t.target, 1.0) AS value
        FROM mt JOIN att_map a ON mt.metric = a.base_metric LEFT JOIN targets t ON a.target_key = t.target_key),
panel AS (SELECT as_of, job, metric, value FROM mt UNION ALL SELECT as_of, job, metric, value FROM att)"""


def _fmt(v: str) -> str:
    pct = f"CAST({rnd(v + ' * 100', 2)} AS VARCHAR)"
    return f"""CASE
      WHEN fmt = 'pct' THEN CASE WHEN {v} IS NULL THEN 'null' ELSE {pct} || '%' END
      WHEN fmt = 'chg' THEN CASE WHEN {v} IS NULL THEN 'N/A'
                                 WHEN {rnd(v + ' * 100', 2)} >= 0 THEN '+' || {pct} || '%'
                                 ELSE {pct} || '%' END
      WHEN fmt = 'f1' THEN CASE WHEN {v} IS NULL THEN 'null' ELSE printf('%.1f', {rnd(v, 1)}) END
      WHEN fmt = 'f2' THEN CASE WHEN {v} IS NULL THEN 'null' ELSE printf('%.2f', {rnd(v, 2)}) END
      WHEN fmt = 'int' THEN CASE WHEN {v} IS NULL THEN 'null' ELSE CAST(CAST(trunc({v}) AS BIGINT) AS VARCHAR) END
      WHEN fmt = 'raw' THEN CASE WHEN {v} IS NULL THEN 'null' ELSE CAST({v} AS VARCHAR) END
    END"""


def _report(layout: list[tuple], variant: str) -> str:
    return f""",
lines AS (SELECT *, regexp_split_to_array(template, '\\{{[^}}]*\\}}') AS texts,
                 regexp_extract_all(template, '\\{{([^}}]*)\\}}', 1) AS slots
          FROM (VALUES {_values(layout, ["VARCHAR", "INTEGER", "VARCHAR"])}) t(section, line_no, template)),
slots AS (SELECT section, line_no, i, texts[i] AS txt, split_part(slots[i], ':', 1) AS metric, split_part(slots[i], ':', 2) AS fmt
          FROM (SELECT *, unnest(range(1, len(texts) + 1)) AS i FROM lines)),
pieces AS (SELECT a.as_of, l.section, l.line_no, l.i,
                  l.txt || CASE WHEN l.metric IS NULL OR l.metric = '' THEN ''
                                WHEN l.metric = '$as_of' THEN strftime(a.as_of, '%Y-%m-%d')
                                WHEN l.metric = '$unit' THEN 'USD' ELSE {_fmt('p.value')} END AS piece
           FROM days a JOIN slots l ON true LEFT JOIN panel p ON l.metric = p.metric AND a.as_of = p.as_of)
SELECT as_of, '{variant}' AS variant, section, line_no, string_agg(piece, '' ORDER BY i) AS text FROM pieces GROUP BY ALL"""


def panel_sql() -> dict[str, str]:
    day, month = panel_ctes([DAY]), panel_ctes(MONTH)
    owned = _values([(j, m) for j, names in pinned.OWNERS.items() for m in names.split()], ["VARCHAR", "VARCHAR"])
    table = "\nSELECT as_of, job, metric, value FROM panel"
    return {
        "metric_table": day + table,
        "metric_table_days": month + table,
        "metric_sink": month + """
SELECT as_of, job, metric, value + if(as_of < DATE '2024-01-15', 1, 0) AS value FROM panel""",
        "target_attainment": day + "\nSELECT as_of, job, metric, base_metric, target, value FROM att",
        "metric_completeness": month + f""",
expected AS (SELECT as_of, e.* FROM days, (VALUES {owned}) e(job, metric))
SELECT e.as_of, e.job, e.metric, p.value,
       CASE WHEN p.metric IS NULL THEN 'missing' WHEN p.value IS NULL OR isnan(p.value) THEN 'null' ELSE 'ok' END
         AS status
FROM expected e LEFT JOIN panel p ON e.metric = p.metric AND e.as_of = p.as_of""",
        "report_lines": day + _report(pinned.FULL, "full"),
        "report_lines_compact": month + _report(pinned.COMPACT, "compact"),
    }
