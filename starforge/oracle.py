"""DuckDB SQL for every registered query: an independent oracle at small scale.

The driver's tables are views; the staging adapter is a shared CTE prefix.
Where the Spark job uses a rewrite for scale (running count for the
paid-before-draw count, equi-join on expanded days for holiday proximity),
the SQL states the direct definition (correlated COUNT, EXISTS), so the
comparison also checks the rewrite.
"""

from __future__ import annotations

import datetime as dt

from starforge import schemas
from starforge.functions import calendar as cal
from starforge.functions import rules
from starforge.operators import inject as inj
from starforge.operators import quality as dq
from starforge.plans.catalog import CALENDAR_SHIFT_YEARS, EXISTING_CUTOFF, LOST_PARENTS, MANDATORY, PREV_AS_OF, SEED
from starforge.sources.adapter import AS_OF, SPINE


def _d(x: dt.date) -> str:
    return f"DATE '{x.isoformat()}'"


def _in(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _bands(expr: str, bands) -> str:
    arms = " ".join(f"WHEN {expr} BETWEEN {lo} AND {hi} THEN '{label}'" for lo, hi, label in bands)
    return f"CASE {arms} ELSE '{rules.UNKNOWN}' END"


def age_group_sql(by: str, as_of: dt.date) -> str:
    age = f"({as_of.year} - coalesce(nullif({by}, 0), {rules.DEFAULT_BIRTH_YEAR}))"
    return _bands(age, rules.AGE_GROUPS)


def income_bracket_sql(col: str) -> str:
    return _bands(f"coalesce({col}, 0)", rules.INCOME_BRACKETS)


def date_key_sql(d: str) -> str:
    return f"CAST(year({d}) * 10000 + month({d}) * 100 + day({d}) AS INTEGER)"


def scaled_sql(unscaled: str, scale: int) -> str:
    if scale == 0:
        return f"CAST({unscaled} AS DECIMAL(18,0))"
    step = f"CAST('0.{'0' * (scale - 1)}1' AS DECIMAL({scale + 1},{scale}))"
    return f"CAST(CAST({unscaled} AS DECIMAL(18,0)) * {step} AS DECIMAL({18 + scale},{scale}))"


def round_ratio_sql(num: str, den: str, scale: int) -> str:
    """num/den rounded half away from zero at ``scale`` digits, exact integers."""
    n, d = f"CAST({num} AS BIGINT)", f"CAST({den} AS BIGINT)"
    q = (f"((abs({n}) * {2 * 10 ** scale} + abs({d})) // (2 * abs({d})))"
         f" * (CASE WHEN sign({n}) * sign({d}) < 0 THEN -1 ELSE 1 END)")
    return f"(CASE WHEN {d} = 0 THEN NULL ELSE {scaled_sql(q, scale)} END)"


def months_elapsed_sql(s: str, e: str) -> str:
    mm = f"((year({e}) - year({s})) * 12 + (month({e}) - month({s})))"
    bump = f"(CASE WHEN CAST({s} + to_months(CAST({mm} AS INTEGER)) AS DATE) < {e} THEN 1 ELSE 0 END)"
    return f"CAST(coalesce(greatest(1, {mm} + {bump}), 1) AS INTEGER)"


def capped_ratio_sql(p: str, m: str) -> str:
    q = (f"CASE WHEN {p} IS NOT NULL AND {m} IS NOT NULL THEN "
         f"least(10000, (CAST({p} AS BIGINT) * 20000 + {m}) // (2 * {m})) END")
    return f"CAST({scaled_sql(q, 4)} AS DECIMAL(5,4))"


def monthly_installment_sql(target: str, dur: str) -> str:
    c, d = f"CAST({target} * 100 AS BIGINT)", f"CAST({dur} AS BIGINT)"
    q = (f"((abs({c}) * 2 + abs({d})) // (2 * abs({d})))"
         f" * (CASE WHEN sign({c}) * sign({d}) < 0 THEN -1 ELSE 1 END)")
    return (f"(CASE WHEN coalesce({dur}, 0) = 0 THEN CAST(0 AS DECIMAL(12,2))"
            f" ELSE CAST({scaled_sql(q, 2)} AS DECIMAL(12,2)) END)")


def age_years_sql(b: str, as_of: dt.date) -> str:
    md = as_of.month * 100 + as_of.day
    return (f"({as_of.year} - year({b}) - CASE WHEN {md} < month({b}) * 100 + day({b})"
            f" THEN 1 ELSE 0 END)")


def calendar_cols_sql(d: str) -> str:
    names = " ".join(f"WHEN {i + 1} THEN '{n}'" for i, n in enumerate(cal.DAY_NAMES))
    hol = ", ".join(str(m * 100 + day) for m, day in cal.FIXED_HOLIDAYS)
    ram = " OR ".join(f"({d} BETWEEN {_d(lo)} AND {_d(hi)})" for lo, hi in cal.RAMADAN_RANGES)
    return (f"{date_key_sql(d)} AS date_key, {d} AS full_date, CAST(day({d}) AS INTEGER) AS day, "
            f"CAST(month({d}) AS INTEGER) AS month, CAST(quarter({d}) AS INTEGER) AS quarter, "
            f"CAST(year({d}) AS INTEGER) AS year, CAST(isodow({d}) AS INTEGER) AS day_of_week, "
            f"CASE isodow({d}) {names} END AS day_name, isodow({d}) >= 6 AS is_weekend, "
            f"(month({d}) * 100 + day({d})) IN ({hol}) AS is_holiday, ({ram}) AS is_ramadan")


def md5_sample_sql(key: str, fraction: float, salt: str) -> str:
    return f"(md5('{SEED}:{salt}' || {key}) < '{inj.threshold_hex(fraction)}')"


def md5_int_sql(key: str, salt: str) -> str:
    return f"CAST('0x' || substr(md5('{SEED}:{salt}' || {key}), 1, 8) AS BIGINT)"


def member_id_sql(k: str) -> str:
    return f"printf('M%08d', CAST({k} AS BIGINT))"


def plan_id_sql(k: str) -> str:
    return f"printf('P%06d', CAST({k} AS BIGINT))"


PAYMENT_ORDER = ("due_date ASC NULLS LAST, paid_date ASC NULLS FIRST, plan_id ASC NULLS LAST, "
                 "due_amount ASC NULLS LAST, paid_amount ASC NULLS LAST, member_id ASC NULLS LAST, "
                 "installment_no ASC NULLS LAST, subscription_id ASC NULLS LAST")
LOTTERY_ORDER = ("lottery_date ASC NULLS LAST, plan_id ASC NULLS LAST, member_id ASC NULLS LAST, "
                 "lottery_round ASC NULLS LAST, is_winner ASC NULLS LAST")


def _member_dim_ctes(prefix: str, members: str, as_of: dt.date) -> str:
    """clean (W2), one row per member (D5), full-refresh dimension of every clean row (D3) from ``members``."""
    return f"""
{prefix}clean AS (
  SELECT member_id, full_name, tc_hash, city, district, birth_year, income, signup_date, status
  FROM {members} WHERE tc_hash IS NOT NULL AND tc_hash <> ''
  QUALIFY row_number() OVER (PARTITION BY tc_hash ORDER BY signup_date DESC NULLS FIRST,
          member_id ASC NULLS LAST, status ASC NULLS LAST) = 1),
{prefix}clean1 AS (
  SELECT * FROM {prefix}clean WHERE member_id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY member_id ORDER BY tc_hash DESC NULLS LAST) = 1),
{prefix}dim_member AS (
  SELECT member_id, full_name, tc_hash, city, district,
         {age_group_sql('birth_year', as_of)} AS age_group,
         {income_bracket_sql('income')} AS income_bracket, signup_date,
         status AS member_status,
         CASE WHEN status = '{rules.CHURN_STATUS}' THEN {_d(as_of)} END AS churn_date,
         coalesce(signup_date, {_d(as_of)}) AS valid_from, CAST(NULL AS DATE) AS valid_to,
         TRUE AS is_current, CAST(1 AS INTEGER) AS version_no
  FROM {prefix}clean)"""


BASE = f"""
WITH
m_base AS (
  SELECT c.c_custkey AS k, c.c_name, n.n_name, r.r_name, c.c_acctbal, c.c_mktsegment, f.first_order
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
  LEFT JOIN (SELECT o_custkey, min(o_orderdate) AS first_order FROM orders GROUP BY o_custkey) f
    ON c.c_custkey = f.o_custkey),
m_rows AS (
  SELECT {member_id_sql('k')} AS member_id, c_name AS full_name,
         CASE WHEN k % 13 = 0 THEN NULL WHEN k % 41 = 0 THEN '' ELSE sha256(CAST(k AS VARCHAR)) END AS tc_hash,
         n_name AS city, r_name AS district,
         CAST(CASE WHEN k % 17 = 0 THEN NULL ELSE 1940 + k % 75 END AS INTEGER) AS birth_year,
         make_date(CAST(1940 + k % 75 AS BIGINT), CAST(1 + k % 12 AS BIGINT), CAST(1 + k % 28 AS BIGINT)) AS birth_date,
         CAST(c_acctbal * 25 AS DECIMAL(12,2)) AS income,
         CAST(first_order AS DATE) AS signup_date,
         CASE WHEN k % 59 = 0 THEN 'askida' WHEN c_mktsegment = 'FURNITURE' THEN 'terk' WHEN c_mktsegment = 'MACHINERY' THEN 'gecikmeli'
              WHEN c_mktsegment = 'HOUSEHOLD' THEN 'pasif' ELSE 'aktif' END AS status,
         CAST(NULL AS VARCHAR) AS phone, CAST(NULL AS VARCHAR) AS email, k % 33 = 0 AS dup
  FROM m_base),
members AS (
  SELECT member_id, full_name, tc_hash, city, district, birth_year, birth_date, income, signup_date,
         status, phone, email FROM m_rows
  UNION ALL
  SELECT member_id, full_name, tc_hash, city, district, birth_year, birth_date, income,
         signup_date + 30, 'pasif', phone, email FROM m_rows WHERE dup),
plans AS (
  SELECT {plan_id_sql('p_partkey')} AS plan_id, p_name AS plan_name,
         CASE split_part(p_type, ' ', 1) WHEN 'STANDARD' THEN 'konut' WHEN 'ECONOMY' THEN 'arsa'
              WHEN 'MEDIUM' THEN 'ticari' WHEN 'SMALL' THEN 'arac' WHEN 'LARGE' THEN 'isyeri'
              WHEN 'PROMO' THEN 'diger' END AS plan_type,
         CAST(CASE WHEN p_partkey % 97 = 0 THEN 0 ELSE p_size END AS INTEGER) AS duration_months,
         CAST(p_retailprice * 1000 AS DECIMAL(15,2)) AS target_amount,
         CAST(NULL AS DECIMAL(12,2)) AS monthly_installment
  FROM part),
subscriptions AS (
  SELECT 'S' || CAST(o_orderkey AS VARCHAR) AS subscription_id, {member_id_sql('o_custkey')} AS member_id,
         CAST(NULL AS VARCHAR) AS plan_id, CAST(o_orderdate AS DATE) AS start_date,
         CAST(NULL AS DATE) AS expected_end_date, CAST(NULL AS DATE) AS kura_date,
         CAST(NULL AS BOOLEAN) AS kura_won,
         CASE o_orderstatus WHEN 'O' THEN 'aktif' WHEN 'P' THEN 'beklemede' WHEN 'F' THEN 'terk' END
           AS subscription_status
  FROM orders WHERE o_orderkey % 50 <> 0),
payments AS (
  SELECT 'PAY' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS payment_id,
         'S' || CAST(l_orderkey AS VARCHAR) AS subscription_id,
         {member_id_sql('o_custkey')} AS member_id, {plan_id_sql('l_partkey')} AS plan_id,
         CAST(l_linenumber AS INTEGER) AS installment_no, CAST(l_shipdate AS DATE) AS due_date,
         CASE WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN NULL
              ELSE CAST(l_shipdate AS DATE) + CAST(CAST(l_quantity AS BIGINT) % 15 - 5 AS INTEGER) END AS paid_date,
         CASE WHEN l_orderkey % 101 = 7 THEN NULL WHEN l_orderkey % 101 = 11 THEN CAST(0 AS DECIMAL(12,2))
              ELSE CAST(l_extendedprice AS DECIMAL(12,2)) END AS due_amount,
         CASE WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN CAST(0 AS DECIMAL(12,2))
              WHEN l_suppkey % 50 = 0 THEN CAST(-l_quantity AS DECIMAL(12,2))
              ELSE CAST(l_extendedprice AS DECIMAL(12,2)) END AS paid_amount,
         CASE WHEN l_orderkey % 101 = 13 THEN 'iade' WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN 'odenmedi'
              WHEN l_returnflag = 'R' THEN 'kismi'
              WHEN CAST(l_quantity AS BIGINT) % 15 > 8 THEN 'gecikmeli' ELSE 'odendi' END AS payment_status
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
lottery AS (
  SELECT 'L' || CAST(o_orderkey AS VARCHAR) AS lottery_id, {member_id_sql('o_custkey')} AS member_id,
         {plan_id_sql('o_orderkey % (SELECT count(*) FROM part)')} AS plan_id,
         CAST(NULL AS VARCHAR) AS subscription_id,
         CAST(o_orderdate AS DATE) + CAST(o_orderkey % 700 AS INTEGER) AS lottery_date,
         CAST(1 + o_orderkey % 8 AS INTEGER) AS lottery_round,
         o_orderpriority = '1-URGENT' AS is_winner
  FROM orders),{_member_dim_ctes('', 'members', AS_OF)},
dim_plan AS (
  SELECT plan_id, plan_name, plan_type, duration_months, target_amount,
         {monthly_installment_sql('target_amount', 'duration_months')} AS monthly_installment
  FROM (SELECT DISTINCT plan_id, plan_name, plan_type, duration_months, target_amount FROM plans)),
pay_rows AS (
  SELECT p.payment_id, p.member_id, p.plan_id, p.subscription_id, p.installment_no, p.due_date,
         p.paid_date, p.due_amount, p.paid_amount,
         {date_key_sql('coalesce(p.paid_date, p.due_date)')} AS date_key,
         CAST(greatest(0, coalesce(datediff('day', p.due_date, p.paid_date), 0)) AS INTEGER) AS days_late
  FROM payments p
  JOIN (SELECT member_id FROM dim_member WHERE is_current) m ON p.member_id = m.member_id
  JOIN (SELECT plan_id FROM dim_plan) pl ON p.plan_id = pl.plan_id
  WHERE p.payment_id IS NOT NULL),
fact_payments AS (
  SELECT payment_id, member_id, plan_id, date_key, installment_no, due_amount, paid_amount, days_late,
         CASE WHEN paid_date IS NULL THEN 'odenmedi' WHEN days_late > 0 THEN 'gecikmeli'
              ELSE 'zamaninda' END AS payment_status
  FROM pay_rows QUALIFY row_number() OVER (PARTITION BY payment_id ORDER BY {PAYMENT_ORDER}) = 1),
lot_rows AS (
  SELECT l.lottery_id, l.member_id, l.plan_id, l.lottery_date, l.lottery_round, l.is_winner,
         m.signup_date, {date_key_sql('l.lottery_date')} AS date_key
  FROM lottery l
  JOIN (SELECT member_id, signup_date FROM dim_member WHERE is_current) m ON l.member_id = m.member_id
  JOIN (SELECT plan_id FROM dim_plan) pl ON l.plan_id = pl.plan_id
  WHERE l.lottery_id IS NOT NULL),
lot_paid AS (
  SELECT r.*,
         (SELECT count(*) FROM payments p
           WHERE p.member_id = r.member_id AND p.payment_status IN ({_in(rules.PAID_STATUSES)})
             AND p.due_date <= r.lottery_date) AS paid_before_lottery
  FROM lot_rows r),
lot_ratio AS (
  SELECT *, {capped_ratio_sql('paid_before_lottery', 'months_elapsed')} AS cumulative_paid_ratio
  FROM (SELECT *, {months_elapsed_sql('signup_date', 'lottery_date')} AS months_elapsed FROM lot_paid)),
fact_lottery AS (
  SELECT * FROM lot_ratio QUALIFY row_number() OVER (PARTITION BY lottery_id ORDER BY {LOTTERY_ORDER}) = 1),
data_span AS (
  SELECT min(d) AS lo, max(d) AS hi FROM (
    SELECT due_date AS d FROM payments UNION ALL SELECT paid_date FROM payments
    UNION ALL SELECT lottery_date FROM lottery)),
dim_date_data AS (
  SELECT {calendar_cols_sql('d')} FROM (
    SELECT CAST(lo + CAST(i AS INTEGER) AS DATE) AS d
    FROM data_span, range(0, datediff('day', lo, hi) + 1) t(i))),
dim_date_spine AS (
  SELECT {calendar_cols_sql('d')} FROM (
    SELECT CAST({_d(SPINE[0])} + CAST(i AS INTEGER) AS DATE) AS d
    FROM range(0, {(SPINE[1] - SPINE[0]).days + 1}) t(i))),
pay_recent AS (
  SELECT * REPLACE (CAST(due_date + INTERVAL {CALENDAR_SHIFT_YEARS} YEAR AS DATE) AS due_date) FROM payments),
hol_years AS (SELECT DISTINCT CAST(year(due_date) AS INTEGER) AS year FROM pay_recent WHERE due_date IS NOT NULL),
holidays AS (
  SELECT make_date(year, m, d) AS holiday
  FROM hol_years, (VALUES {", ".join(f"({m}, {d})" for m, d in cal.FIXED_HOLIDAYS)}) f(m, d)
  UNION
  SELECT CAST(start + CAST(i AS INTEGER) AS DATE)
  FROM (VALUES {", ".join(f"({_d(dt.date(y, m, d))}, {n})" for y, m, d, n in cal.RELIGIOUS_HOLIDAYS)}) r(start, n),
       range(0, 31) t(i)
  WHERE i < n AND CAST(year(start + CAST(i AS INTEGER)) AS INTEGER) IN (SELECT year FROM hol_years)),
pay_near AS (
  SELECT p.payment_id, p.installment_no, p.due_date,
         EXISTS (SELECT 1 FROM holidays h WHERE h.holiday - p.due_date BETWEEN 0 AND 7) AS near_holiday
  FROM pay_recent p),
prev_members AS (
  SELECT * REPLACE (CASE WHEN CAST(substr(member_id, 2) AS BIGINT) % 5 = 0
                         THEN CASE WHEN status = 'aktif' THEN 'pasif' ELSE 'aktif' END
                         ELSE status END AS status)
  FROM members WHERE CAST(substr(member_id, 2) AS BIGINT) % 7 <> 0),{_member_dim_ctes('prev_', 'prev_members', PREV_AS_OF)},
scd_state AS (
  SELECT member_id, max(version_no) AS current_version, max(member_status) AS current_status
  FROM prev_dim_member WHERE is_current GROUP BY member_id),
scd_classified AS (
  SELECT c.*, s.current_version, s.current_status,
         CASE WHEN s.current_status IS NULL THEN 'insert'
              WHEN s.current_status IS DISTINCT FROM c.status THEN 'update' ELSE 'skip' END AS action
  FROM clean1 c LEFT JOIN scd_state s ON c.member_id = s.member_id),
scd_changes AS (
  SELECT *, CAST(coalesce(current_version, 0) + 1 AS INTEGER) AS new_version
  FROM scd_classified WHERE action <> 'skip'),
scd_applied AS (
  SELECT d.member_id, d.full_name, d.tc_hash, d.city, d.district, d.age_group, d.income_bracket,
         d.signup_date, d.member_status, d.churn_date, d.valid_from,
         CASE WHEN ch.member_id IS NOT NULL AND d.is_current THEN {_d(AS_OF)} ELSE d.valid_to END AS valid_to,
         CASE WHEN ch.member_id IS NOT NULL AND d.is_current THEN FALSE ELSE d.is_current END AS is_current,
         d.version_no
  FROM prev_dim_member d LEFT JOIN (SELECT member_id FROM scd_changes) ch ON d.member_id = ch.member_id
  UNION ALL
  SELECT member_id, full_name, tc_hash, city, district,
         {age_group_sql('birth_year', AS_OF)}, {income_bracket_sql('income')}, signup_date,
         status, CASE WHEN status = '{rules.CHURN_STATUS}' THEN {_d(AS_OF)} END,
         coalesce(signup_date, {_d(AS_OF)}), CAST(NULL AS DATE), TRUE, new_version
  FROM scd_changes)
"""

DIM_MEMBER_COLS = ("member_id, full_name, tc_hash, city, district, age_group, income_bracket, "
                   "signup_date, member_status, churn_date, valid_from, valid_to, is_current, version_no")
STAGING_PAYMENT_COLS = ", ".join(f.name for f in schemas.STAGING_PAYMENTS.fields)
STAGING_MEMBER_COLS = ", ".join(f.name for f in schemas.STAGING_MEMBERS.fields)


def _verdict(rule: str, table: str, count_sql: str, threshold: int = 0) -> str:
    return (f"SELECT '{rule}' AS rule, '{table}' AS table_name, CAST(n AS BIGINT) AS n, "
            f"CAST({threshold} AS BIGINT) AS threshold, "
            f"CASE WHEN n <= {threshold} THEN '{dq.PASS}' ELSE '{dq.FAIL}' END AS status, "
            f"CASE WHEN n > 0 THEN CAST(n AS VARCHAR) || '{dq.DIRTY_DETAIL_SUFFIX}' "
            f"ELSE '{dq.CLEAN_DETAIL}' END AS detail FROM ({count_sql}) v")


DQ_SQL = {
    "NULL zorunlu alan (members)": (
        "staging.members", "SELECT count(*) AS n FROM members WHERE member_id IS NULL OR tc_hash IS NULL "
        "OR city IS NULL OR income IS NULL OR signup_date IS NULL OR status IS NULL"),
    "Duplicate member_id": (
        "staging.members", "SELECT count(*) AS n FROM (SELECT member_id FROM members GROUP BY member_id "
        "HAVING count(*) > 1)"),
    "Invalid member_status": (
        "staging.members", f"SELECT count(*) AS n FROM members WHERE status NOT IN ({_in(rules.MEMBER_STATUSES)})"),
    "Invalid income": ("staging.members", "SELECT count(*) AS n FROM members WHERE income <= 0"),
    "Underage members": (
        "staging.members", f"SELECT count(*) AS n FROM members WHERE {age_years_sql('birth_date', AS_OF)} < 18"),
    "NULL payment fields": (
        "staging.payments", "SELECT count(*) AS n FROM payments WHERE payment_id IS NULL OR "
        "subscription_id IS NULL OR due_date IS NULL OR due_amount IS NULL"),
    "Duplicate payment_id": (
        "staging.payments", "SELECT count(*) AS n FROM (SELECT payment_id FROM payments GROUP BY payment_id "
        "HAVING count(*) > 1)"),
    "Negative payment": ("staging.payments", "SELECT count(*) AS n FROM payments WHERE due_amount <= 0"),
    "Invalid payment_status": (
        "staging.payments",
        f"SELECT count(*) AS n FROM payments WHERE payment_status NOT IN ({_in(rules.PAYMENT_STATUSES)})"),
    "Orphan payments": (
        "staging.payments", "SELECT count(*) AS n FROM payments p WHERE NOT EXISTS "
        "(SELECT 1 FROM subscriptions s WHERE s.subscription_id = p.subscription_id)"),
    "Invalid plan_type": (
        "staging.plans", f"SELECT count(*) AS n FROM plans WHERE plan_type NOT IN ({_in(rules.PLAN_TYPES)})"),
    "subscription → member FK": (
        "fact_subscription", "SELECT count(*) AS n FROM subscriptions s WHERE NOT EXISTS "
        "(SELECT 1 FROM dim_member d WHERE d.member_id = s.member_id)"),
}


def _dq(rule: str) -> str:
    table, sql = DQ_SQL[rule]
    return BASE + _verdict(rule, table, sql)


def _key_viol(table: str, src: str, keys: list[str]) -> str:
    k = ", ".join(keys)
    isnull = " OR ".join(f"{c} IS NULL" for c in keys)
    return (f"SELECT '{table}' AS table_name, '{','.join(keys)}' AS key_columns, "
            f"CAST(coalesce(sum(CASE WHEN {isnull} THEN c END), 0) AS BIGINT) AS n_null_keys, "
            f"CAST(count(*) FILTER (WHERE NOT ({isnull}) AND c > 1) AS BIGINT) AS n_duplicate_groups, "
            f"CAST(coalesce(sum(CASE WHEN NOT ({isnull}) AND c > 1 THEN c - 1 END), 0) AS BIGINT) "
            f"AS n_duplicate_rows FROM (SELECT {k}, count(*) AS c FROM {src} GROUP BY {k})")


def _fk_viol(table: str, src: str, col: str, parent_table: str, parent: str, pcol: str) -> str:
    return (f"SELECT '{table}' AS table_name, '{col}' AS column_name, '{parent_table}' AS parent_table, "
            f"CAST(count(*) AS BIGINT) AS n FROM {src} c WHERE c.{col} IS NOT NULL AND NOT EXISTS "
            f"(SELECT 1 FROM {parent} p WHERE p.{pcol} = c.{col})")


def _null_viol(table: str, src: str, cols: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{c}' AS column_name, "
        f"CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS n FROM {src}" for c in cols)


def _bound_viol(table: str, src: str, varchar: dict, numeric: dict) -> list[str]:
    out = []
    for c, n in varchar.items():
        out.append(f"SELECT '{table}' AS table_name, '{c}' AS column_name, 'varchar({n})' AS bound, "
                   f"CAST(count(*) FILTER (WHERE length({c}) > {n}) AS BIGINT) AS n FROM {src}")
    for c, (p, s) in numeric.items():
        out.append(f"SELECT '{table}' AS table_name, '{c}' AS column_name, 'numeric({p},{s})' AS bound, "
                   f"CAST(count(*) FILTER (WHERE {c} IS NOT NULL AND TRY_CAST({c} AS DECIMAL({p},{s})) IS NULL)"
                   f" AS BIGINT) AS n FROM {src}")
    return out


def _share(src: str, col: str) -> str:
    return (f"SELECT {col}, n, CAST({round_ratio_sql('n * 100', 'total', 2)} AS DECIMAL(5,2)) AS pct FROM "
            f"(SELECT {col}, n, sum(n) OVER () AS total FROM "
            f"(SELECT {col}, count(*) AS n FROM {src} GROUP BY {col}))")


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["scan_staging_members"] = BASE + f"SELECT {STAGING_MEMBER_COLS} FROM members"
    q["insert_ignore_payments"] = BASE + (
        f"SELECT {STAGING_PAYMENT_COLS} FROM payments "
        f"QUALIFY row_number() OVER (PARTITION BY payment_id ORDER BY {PAYMENT_ORDER}) = 1")
    q["insert_ignore_existing"] = BASE + (
        f"SELECT {STAGING_PAYMENT_COLS} FROM payments p WHERE NOT EXISTS (SELECT 1 FROM payments t "
        f"WHERE t.due_date < {_d(EXISTING_CUTOFF)} AND t.payment_id = p.payment_id) "
        f"QUALIFY row_number() OVER (PARTITION BY payment_id ORDER BY {PAYMENT_ORDER}) = 1")
    fact_cols = ("payment_id, member_id, plan_id, date_key, installment_no, due_amount, paid_amount, "
                 "days_late, CASE WHEN paid_date IS NULL THEN 'odenmedi' WHEN days_late > 0 THEN 'gecikmeli' "
                 "ELSE 'zamaninda' END AS payment_status")
    day1 = f"due_date < {_d(EXISTING_CUTOFF)}"
    q["incremental_fact_payments"] = BASE + (
        f", f1 AS (SELECT * FROM pay_rows WHERE {day1} "
        f"QUALIFY row_number() OVER (PARTITION BY payment_id ORDER BY {PAYMENT_ORDER}) = 1), "
        f"f2 AS (SELECT * FROM pay_rows r WHERE NOT coalesce({day1}, FALSE) "
        f"AND NOT EXISTS (SELECT 1 FROM f1 WHERE f1.payment_id = r.payment_id) "
        f"QUALIFY row_number() OVER (PARTITION BY payment_id ORDER BY {PAYMENT_ORDER}) = 1) "
        f"SELECT {fact_cols} FROM f1 UNION ALL SELECT {fact_cols} FROM f2")
    # as incremental_fact_payments, without the rows whose day the calendar lacks
    q["load_then_incremental"] = BASE + (
        f", dated AS (SELECT * FROM pay_rows WHERE coalesce(coalesce(paid_date, due_date) BETWEEN {_d(SPINE[0])} AND {_d(SPINE[1])}, TRUE)), "
        f"f1 AS (SELECT * FROM dated WHERE {day1} QUALIFY row_number() OVER (PARTITION BY payment_id ORDER BY {PAYMENT_ORDER}) = 1), "
        f"f2 AS (SELECT * FROM dated r WHERE NOT coalesce({day1}, FALSE) AND payment_id NOT IN (SELECT payment_id FROM f1) "
        f"QUALIFY row_number() OVER (PARTITION BY payment_id ORDER BY {PAYMENT_ORDER}) = 1), "
        # the first day's file comes twice: an instalment held unpaid that it also has paid is replaced
        f"n1 AS (SELECT * FROM dated r WHERE {day1} AND paid_date IS NOT NULL AND EXISTS (SELECT 1 FROM f1 "
        f"WHERE f1.payment_id = r.payment_id AND f1.due_date = r.due_date AND f1.paid_date IS NULL) "
        f"QUALIFY row_number() OVER (PARTITION BY payment_id ORDER BY {PAYMENT_ORDER}) = 1) "
        f"SELECT {fact_cols} FROM f1 WHERE payment_id NOT IN (SELECT payment_id FROM n1) "
        f"UNION ALL SELECT {fact_cols} FROM n1 UNION ALL SELECT {fact_cols} FROM f2")
    lost = {k: f"({md5_sample_sql('payment_id', f, 'lost-' + k)})" for k, f in LOST_PARENTS.items()}
    q["fact_rejects"] = BASE + f""",
      lost AS (SELECT * REPLACE (CASE WHEN {lost['m']} THEN 'M-none' ELSE member_id END AS member_id,
          CASE WHEN {lost['p']} THEN 'P-none' ELSE plan_id END AS plan_id,
          CASE WHEN {lost['d']} THEN NULL ELSE paid_date END AS paid_date,
          CASE WHEN {lost['d']} THEN DATE '1900-01-01' ELSE due_date END AS due_date) FROM payments),
      marked AS (SELECT *, CASE WHEN member_id IS NULL OR member_id NOT IN (SELECT member_id FROM dim_member WHERE is_current AND member_id IS NOT NULL) THEN 'no member'
          WHEN plan_id IS NULL OR plan_id NOT IN (SELECT plan_id FROM dim_plan WHERE plan_id IS NOT NULL) THEN 'no plan'
          WHEN coalesce(paid_date, due_date) NOT BETWEEN {_d(SPINE[0])} AND {_d(SPINE[1])} THEN 'no date' END AS reason FROM lost)
      SELECT payment_id, member_id, plan_id, due_date, reason FROM marked WHERE reason IS NOT NULL UNION ALL
      SELECT payment_id, member_id, plan_id, due_date, 'taken' FROM (SELECT * FROM marked WHERE reason IS NULL AND payment_id IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY payment_id ORDER BY {PAYMENT_ORDER}) = 1)"""
    q["dense_member_keys"] = BASE + """,
      one AS (SELECT member_id, tc_hash, version_no, row_number() OVER (ORDER BY member_id NULLS FIRST, tc_hash) AS member_no FROM prev_dim_member),
      new AS (SELECT member_id, tc_hash, version_no FROM scd_applied WHERE is_current
        EXCEPT SELECT member_id, tc_hash, version_no FROM one)
      SELECT * FROM one UNION ALL
      SELECT *, (SELECT count(*) FROM one) + row_number() OVER (ORDER BY member_id NULLS FIRST, tc_hash, version_no) FROM new"""
    row_text = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in schemas.STAGING_PAYMENTS.fieldNames())
    q["exact_sample"] = BASE + (
        f"SELECT {STAGING_PAYMENT_COLS} FROM payments QUALIFY row_number() OVER (ORDER BY "
        f"md5(concat_ws('|', '{SEED}:s', coalesce(payment_id, ''))) || md5(concat_ws('|', '{SEED}:t', {row_text}))) "
        f"<= CAST(floor((SELECT count(*) FROM payments) * 0.1) AS BIGINT)")
    q["dim_date"] = BASE + "SELECT * FROM dim_date_data"
    ram = " OR ".join(f"(due_date BETWEEN {_d(lo)} AND {_d(hi)})" for lo, hi in cal.RAMADAN_RANGES)
    q["is_ramadan"] = BASE + f"SELECT payment_id, installment_no, due_date, ({ram}) AS is_ramadan FROM pay_recent"
    q["holiday_calendar"] = BASE + "SELECT holiday FROM holidays"
    q["near_holiday"] = BASE + "SELECT * FROM pay_near"
    seasonal = (f"CAST(CASE WHEN month(due_date) IN ({', '.join(map(str, rules.SEASONAL_MONTHS))}) "
                f"THEN {rules.SEASONAL_BOOST} ELSE 0 END AS INTEGER)")
    hboost = f"CAST(CASE WHEN near_holiday THEN {rules.HOLIDAY_BOOST} ELSE 0 END AS INTEGER)"
    q["payment_risk_boost"] = BASE + (
        f"SELECT payment_id, installment_no, due_date, {seasonal} AS seasonal_boost, {hboost} AS holiday_boost, "
        f"CAST({seasonal} + {hboost} AS INTEGER) AS total_boost FROM pay_near")
    q["age_group"] = BASE + f"SELECT member_id, birth_year, {age_group_sql('birth_year', AS_OF)} AS age_group FROM members"
    q["income_bracket"] = BASE + f"SELECT member_id, income, {income_bracket_sql('income')} AS income_bracket FROM members"
    late = "CAST(greatest(0, coalesce(datediff('day', due_date, paid_date), 0)) AS INTEGER)"
    q["days_late"] = BASE + f"SELECT payment_id, installment_no, due_date, paid_date, {late} AS days_late FROM payments"
    q["derive_payment_status"] = BASE + (
        f"SELECT payment_id, installment_no, paid_date, {late} AS days_late, CASE WHEN paid_date IS NULL "
        f"THEN 'odenmedi' WHEN {late} > 0 THEN 'gecikmeli' ELSE 'zamaninda' END AS payment_status FROM payments")
    q["months_elapsed"] = BASE + "SELECT lottery_id, signup_date, lottery_date, months_elapsed FROM fact_lottery"
    q["cumulative_paid_ratio"] = BASE + (
        "SELECT lottery_id, paid_before_lottery, months_elapsed, cumulative_paid_ratio FROM fact_lottery")
    q["pseudonymise_id"] = BASE + "SELECT member_id, sha256(member_id) AS id_hash FROM members"
    q["format_business_id"] = BASE + (
        "SELECT member_id, printf('M%05d', CAST(substr(member_id, 2) AS BIGINT)) AS business_id FROM members")
    q["installment_schedule"] = BASE + (
        f"SELECT lottery_id, installment_no, due_date FROM ("
        f"SELECT lottery_id, CAST(k + 1 AS INTEGER) AS installment_no, "
        f"CAST(lottery_date + to_months(CAST(k AS INTEGER)) AS DATE) AS due_date FROM ("
        f"SELECT l.lottery_id, l.lottery_date, unnest(range(0, greatest(p.duration_months, 0))) AS k "
        f"FROM lottery l JOIN plans p ON l.plan_id = p.plan_id)) WHERE due_date <= {_d(AS_OF)}")
    tier = " ".join(f"WHEN income >= {lo} THEN '{lab}'" for lo, lab in rules.INCOME_TIER_BOUNDS)
    sur = " ".join(f"WHEN income < {hi} THEN {x}" for hi, x in rules.LATE_SURCHARGE)
    q["income_tier"] = BASE + (
        f"SELECT member_id, income, CASE WHEN income IS NULL THEN NULL {tier} "
        f"ELSE '{rules.INCOME_TIER_LOW}' END AS income_tier, "
        f"CAST(CASE WHEN income IS NULL THEN NULL {sur} ELSE 0 END AS INTEGER) AS late_surcharge "
        f"FROM members")
    q["latest_per_key"] = BASE + "SELECT member_id, tc_hash, signup_date, status FROM clean"
    q["dim_member_clean"] = BASE + f"SELECT {DIM_MEMBER_COLS} FROM dim_member"
    q["dim_plan"] = BASE + "SELECT * FROM dim_plan"
    q["union_all_members"] = BASE + (
        f"SELECT {STAGING_MEMBER_COLS} FROM members UNION ALL SELECT {STAGING_MEMBER_COLS} FROM members "
        f"WHERE {md5_sample_sql('member_id', 0.03, 's')}")
    q["scd2_classify"] = BASE + "SELECT member_id, action FROM scd_classified"
    q["scd2_apply"] = BASE + f"SELECT {DIM_MEMBER_COLS} FROM scd_applied"
    # day 1 (previous members) then day 2 through the stream = the batch SCD2 apply
    q["incremental_scd2"] = q["scd2_apply"]
    q["stage_audit"] = BASE + (
        f"SELECT 'dim_date' AS stage, 'success' AS status, CAST(count(*) AS BIGINT) AS rows_inserted "
        f"FROM dim_date_spine UNION ALL "
        f"SELECT 'dim_plan', 'success', CAST(count(*) AS BIGINT) FROM dim_plan UNION ALL "
        f"SELECT 'dim_member', 'success', CAST(count(*) AS BIGINT) FROM clean UNION ALL "
        f"SELECT 'fact_payments', 'success', CAST(count(*) AS BIGINT) FROM pay_rows UNION ALL "
        f"SELECT 'fact_lottery', 'success', CAST(count(*) AS BIGINT) FROM lot_rows")
    q["scd2_current"] = BASE + "SELECT member_id, member_status, valid_from, version_no FROM scd_applied WHERE is_current"
    q["scd2_counts"] = BASE + (
        "SELECT action, count(*) AS n FROM (SELECT action FROM scd_classified UNION ALL SELECT 'reject' FROM clean c "
        "WHERE NOT EXISTS (SELECT 1 FROM clean1 d WHERE d.tc_hash = c.tc_hash)) GROUP BY action")
    q["fact_payments"] = BASE + (
        "SELECT payment_id, member_id, plan_id, date_key, installment_no, due_amount, paid_amount, days_late, "
        "payment_status FROM fact_payments")
    q["fact_payment_status_share"] = BASE + _share("fact_payments", "payment_status")
    q["paid_before_lottery"] = BASE + "SELECT lottery_id, member_id, lottery_date, paid_before_lottery FROM fact_lottery"
    q["fact_lottery"] = BASE + (
        "SELECT lottery_id, member_id, plan_id, date_key, lottery_round, is_winner, cumulative_paid_ratio "
        "FROM fact_lottery")
    for key, rule in [("dq_null_members", "NULL zorunlu alan (members)"),
                      ("dq_invalid_status", "Invalid member_status"),
                      ("dq_invalid_income", "Invalid income"),
                      ("dq_underage_members", "Underage members"),
                      ("dq_null_payments", "NULL payment fields"),
                      ("dq_negative_payment", "Negative payment"),
                      ("dq_invalid_payment_status", "Invalid payment_status"),
                      ("dq_invalid_plan_type", "Invalid plan_type"),
                      ("dq_duplicate_member_id", "Duplicate member_id"),
                      ("dq_duplicate_payment_id", "Duplicate payment_id"),
                      ("dq_orphan_payments", "Orphan payments"),
                      ("dq_fk_fact_member", "subscription → member FK")]:
        q[key] = _dq(rule)
    q["dq_report"] = BASE + " UNION ALL ".join(
        f"({_verdict(r, DQ_SQL[r][0], DQ_SQL[r][1])})" for r in dq.REPORT_ORDER)
    q["dq_report_by_batches"] = q["dq_report"]  # the same report, over all batches
    q["pk_violations"] = BASE + " UNION ALL ".join([
        _key_viol("staging.members", "members", ["member_id"]),
        _key_viol("fact_payments", "pay_rows", ["payment_id"]),
        _key_viol("fact_lottery", "lot_rows", ["lottery_id"]),
        _key_viol("dim_date", "dim_date_data", ["date_key"]),
        _key_viol("dim_member", "dim_member", ["member_id", "version_no"]),
        _key_viol("dim_member", "(SELECT hash(member_id, version_no, tc_hash) AS member_key FROM dim_member)",
                  ["member_key"]),
        _key_viol("dim_plan", "(SELECT hash(plan_id, plan_name, plan_type, duration_months, target_amount) "
                  "AS plan_key FROM dim_plan)", ["plan_key"]),
    ])
    parts = []
    for name in ("fact_payments", "fact_lottery"):
        parts += [_fk_viol(name, name, "member_id", "dim_member", "dim_member", "member_id"),
                  _fk_viol(name, name, "plan_id", "dim_plan", "dim_plan", "plan_id"),
                  _fk_viol(name, name, "date_key", "dim_date", "dim_date_spine", "date_key")]
    # the declared surrogate keys, by what they stand for
    for child, col, parent, _ in schemas.FOREIGN_KEYS:
        if col == "member_key":
            parts += [_fk_viol(child, f"(SELECT member_id AS member_key FROM {child})", col, label,
                               f"(SELECT member_id AS member_key FROM {src})", col)
                      for label, src in ((parent, "dim_member"), ("dim_member, day before", "prev_dim_member"))]
        elif col == "plan_key":
            parts.append(_fk_viol(child, f"(SELECT plan_id AS plan_key FROM {child})", col, parent,
                                  "(SELECT plan_id AS plan_key FROM dim_plan)", col))
    q["fk_violations"] = BASE + " UNION ALL ".join(parts)
    q["not_null_violations"] = BASE + " UNION ALL ".join([
        _null_viol("dim_date", "dim_date_data", ["date_key", "full_date"]),
        _null_viol("dim_member", "dim_member", ["member_id", "valid_from"]),
        _null_viol("dim_plan", "dim_plan", ["plan_id"]),
        _null_viol("fact_payments", "fact_payments", ["payment_id"]),
        _null_viol("fact_lottery", "fact_lottery", ["lottery_id"]),
        *[_null_viol(f"staging.{t}", t, cols) for t, cols in MANDATORY.items()],
    ])
    bparts = []
    for t in ("members", "plans", "subscriptions", "payments", "lottery"):
        bparts += _bound_viol(f"staging.{t}", t, schemas.VARCHAR_BOUNDS.get(t, {}),
                              schemas.NUMERIC_BOUNDS.get(t, {}))
    for t in ("dim_member", "dim_plan", "fact_payments", "fact_lottery"):
        bparts += _bound_viol(t, t, schemas.VARCHAR_BOUNDS.get(t, {}), schemas.NUMERIC_BOUNDS.get(t, {}))
    q["type_bound_violations"] = BASE + " UNION ALL ".join(bparts)
    q["hash_sample"] = BASE + (
        f"SELECT {STAGING_PAYMENT_COLS} FROM payments WHERE {md5_sample_sql('payment_id', 0.10, 's')}")
    nulls = (f"SELECT * REPLACE (CASE WHEN {md5_sample_sql('member_id', 0.08, 'n')} THEN NULL "
             f"ELSE tc_hash END AS tc_hash) FROM members")
    q["inject_nulls"] = BASE + f"SELECT {STAGING_MEMBER_COLS} FROM ({nulls})"
    q["inject_duplicates"] = BASE + (
        f", nulled AS ({nulls}) SELECT {STAGING_MEMBER_COLS} FROM nulled UNION ALL "
        f"SELECT {STAGING_MEMBER_COLS} FROM nulled WHERE {md5_sample_sql('member_id', 0.03, 'd')}")
    neg = scaled_sql(f"-(100 + {md5_int_sql('payment_id', 'v')} % 999801)", 2)
    q["inject_negative"] = BASE + (
        f"SELECT {STAGING_PAYMENT_COLS} FROM (SELECT * REPLACE (CASE WHEN {md5_sample_sql('payment_id', 0.005, 'g')} "
        f"THEN CAST({neg} AS DECIMAL(12,2)) ELSE paid_amount END AS paid_amount) FROM payments)")
    back = f"CAST(1 + {md5_int_sql('payment_id', 'b')} % 10 AS INTEGER)"
    q["inject_bad_dates"] = BASE + (
        f"SELECT {STAGING_PAYMENT_COLS} FROM (SELECT * REPLACE (CASE WHEN {md5_sample_sql('payment_id', 0.003, 't')} "
        f"AND paid_date IS NOT NULL THEN due_date - {back} ELSE paid_date END AS paid_date) FROM payments)")
    q["profile_totals"] = BASE + (
        "SELECT (SELECT count(*) FROM members) AS n_members, (SELECT count(*) FROM payments) AS n_payments, "
        "(SELECT count(*) FROM lottery) AS n_lottery")
    q["profile_status"] = BASE + "SELECT status, count(*) AS n FROM members GROUP BY status"
    q["profile_city_top10"] = BASE + (
        "SELECT city, count(*) AS n FROM members GROUP BY city ORDER BY n DESC, city ASC NULLS LAST LIMIT 10")
    avg_cents = round_ratio_sql("s", "n", 0)
    q["profile_income"] = BASE + (
        f"SELECT CAST(mn AS DECIMAL(14,2)) AS min_income, CAST(mx AS DECIMAL(14,2)) AS max_income, "
        f"CAST({scaled_sql(f'CAST({avg_cents} AS BIGINT)', 2)} AS DECIMAL(14,2)) AS avg_income, "
        f"CAST(round(sd, 2) AS DECIMAL(14,2)) AS stddev_income FROM ("
        f"SELECT min(income) AS mn, max(income) AS mx, sum(CAST(income * 100 AS BIGINT)) AS s, "
        f"count(income) AS n, stddev_samp(CAST(income AS DOUBLE)) AS sd FROM members)")
    q["profile_dirty_members"] = BASE + (
        "SELECT (SELECT count(*) FROM members WHERE tc_hash IS NULL) AS null_tc_hash, "
        "(SELECT count(*) FROM (SELECT tc_hash FROM members WHERE tc_hash IS NOT NULL GROUP BY tc_hash "
        "HAVING count(*) > 1)) AS duplicate_tc_hash")
    q["profile_plans"] = BASE + (
        "SELECT plan_id, plan_name, duration_months, target_amount, monthly_installment FROM plans")
    q["profile_payment_status"] = BASE + _share("payments", "payment_status")
    q["profile_lateness"] = BASE + (
        f"SELECT CAST({round_ratio_sql('s', 'n', 1)} AS DECIMAL(10,1)) AS avg_days_late, "
        f"CAST(mx AS INTEGER) AS max_days_late, CAST(nl AS BIGINT) AS n_late FROM ("
        f"SELECT sum(datediff('day', due_date, paid_date)) AS s, count(datediff('day', due_date, paid_date)) AS n, "
        f"max(datediff('day', due_date, paid_date)) AS mx, count(*) FILTER (WHERE paid_date > due_date) AS nl "
        f"FROM payments WHERE paid_date IS NOT NULL)")
    q["profile_negative_payments"] = BASE + (
        "SELECT CAST(count(*) FILTER (WHERE paid_amount < 0) AS BIGINT) AS n_negative FROM payments")
    q["profile_lottery"] = BASE + (
        f"SELECT CAST(t AS BIGINT) AS n_total, CAST(w AS BIGINT) AS n_winners, "
        f"CAST({round_ratio_sql('w * 100', 't', 2)} AS DECIMAL(5,2)) AS win_rate FROM ("
        f"SELECT count(*) AS t, count(*) FILTER (WHERE is_winner) AS w FROM lottery)")
    q["profile_lottery_by_plan"] = BASE + (
        "SELECT p.plan_name, count(*) AS n_lottery, CAST(count(*) FILTER (WHERE l.is_winner) AS BIGINT) AS n_winners "
        "FROM lottery l JOIN plans p ON l.plan_id = p.plan_id GROUP BY p.plan_name")
    q["profile_lottery_trend"] = BASE + (
        "SELECT strftime(lottery_date, '%Y-%m') AS month, count(*) AS n FROM lottery GROUP BY 1 "
        "ORDER BY n DESC, month ASC NULLS LAST LIMIT 10")
    return q
