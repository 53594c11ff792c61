"""Declared table shapes: StructTypes, keys, foreign keys and type bounds.

The bounds mirror the DDL the star schema is declared with (VARCHAR lengths,
NUMERIC precision, NOT NULL, primary and foreign keys); Spark has no such
constraints on Parquet, so :mod:`starforge.operators.quality` checks them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

S, I, L, D, B = T.StringType(), T.IntegerType(), T.LongType(), T.DateType(), T.BooleanType()


def dec(p: int, s: int) -> T.DecimalType:
    return T.DecimalType(p, s)


def _struct(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


STAGING_MEMBERS = _struct(
    ("member_id", S), ("full_name", S), ("tc_hash", S), ("city", S), ("district", S),
    ("birth_year", I), ("birth_date", D), ("income", dec(12, 2)), ("signup_date", D),
    ("status", S), ("phone", S), ("email", S))

STAGING_PLANS = _struct(
    ("plan_id", S), ("plan_name", S), ("plan_type", S), ("duration_months", I),
    ("target_amount", dec(15, 2)), ("monthly_installment", dec(12, 2)))

STAGING_SUBSCRIPTIONS = _struct(
    ("subscription_id", S), ("member_id", S), ("plan_id", S), ("start_date", D),
    ("expected_end_date", D), ("kura_date", D), ("kura_won", B), ("subscription_status", S))

STAGING_PAYMENTS = _struct(
    ("payment_id", S), ("subscription_id", S), ("member_id", S), ("plan_id", S),
    ("installment_no", I), ("due_date", D), ("paid_date", D), ("due_amount", dec(12, 2)),
    ("paid_amount", dec(12, 2)), ("payment_status", S))

STAGING_LOTTERY = _struct(
    ("lottery_id", S), ("member_id", S), ("plan_id", S), ("subscription_id", S),
    ("lottery_date", D), ("lottery_round", I), ("is_winner", B))

STAGING = {
    "members": STAGING_MEMBERS,
    "plans": STAGING_PLANS,
    "subscriptions": STAGING_SUBSCRIPTIONS,
    "payments": STAGING_PAYMENTS,
    "lottery": STAGING_LOTTERY,
}

DIM_DATE = _struct(
    ("date_key", I), ("full_date", D), ("day", I), ("month", I), ("quarter", I), ("year", I),
    ("day_of_week", I), ("day_name", S), ("is_weekend", B), ("is_holiday", B), ("is_ramadan", B))

DIM_MEMBER = _struct(
    ("member_key", L), ("member_id", S), ("full_name", S), ("tc_hash", S), ("city", S),
    ("district", S), ("age_group", S), ("income_bracket", S), ("signup_date", D),
    ("member_status", S), ("churn_date", D), ("valid_from", D), ("valid_to", D),
    ("is_current", B), ("version_no", I))

DIM_PLAN = _struct(
    ("plan_key", L), ("plan_id", S), ("plan_name", S), ("plan_type", S),
    ("duration_months", I), ("target_amount", dec(15, 2)), ("monthly_installment", dec(12, 2)))

FACT_PAYMENTS = _struct(
    ("payment_id", S), ("member_key", L), ("plan_key", L), ("date_key", I),
    ("member_id", S), ("plan_id", S), ("subscription_id", S), ("installment_no", I),
    ("due_date", D), ("paid_date", D), ("due_amount", dec(12, 2)), ("paid_amount", dec(12, 2)),
    ("days_late", I), ("payment_status", S))

FACT_LOTTERY = _struct(
    ("lottery_id", S), ("member_key", L), ("plan_key", L), ("date_key", I),
    ("member_id", S), ("plan_id", S), ("lottery_date", D), ("signup_date", D),
    ("lottery_round", I), ("is_winner", B), ("paid_before_lottery", L), ("months_elapsed", I),
    ("cumulative_paid_ratio", dec(5, 4)))


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the schema's columns in order, cast to the declared types; missing -> NULL."""
    have = set(df.columns)
    cols = []
    for f in schema.fields:
        c = F.col(f.name) if f.name in have else F.lit(None)
        cols.append(c.cast(f.dataType).alias(f.name))
    return df.select(*cols)


# Primary keys, as declared.
PRIMARY_KEYS = {
    "dim_date": ["date_key"],
    "dim_member": ["member_key"],
    "dim_plan": ["plan_key"],
    "fact_payments": ["payment_id"],
    "fact_lottery": ["lottery_id"],
}

# (child table, child column, parent table, parent column)
FOREIGN_KEYS = [
    ("fact_payments", "member_key", "dim_member", "member_key"),
    ("fact_payments", "plan_key", "dim_plan", "plan_key"),
    ("fact_payments", "date_key", "dim_date", "date_key"),
    ("fact_lottery", "member_key", "dim_member", "member_key"),
    ("fact_lottery", "plan_key", "dim_plan", "plan_key"),
    ("fact_lottery", "date_key", "dim_date", "date_key"),
]

NOT_NULL = {
    "dim_date": ["date_key", "full_date"],
    "dim_member": ["member_key", "member_id", "valid_from"],
    "dim_plan": ["plan_key", "plan_id"],
    "fact_payments": ["payment_id"],
    "fact_lottery": ["lottery_id"],
}

# Declared VARCHAR(n) lengths, fixed values of the DDL.
VARCHAR_BOUNDS = {
    "members": {"member_id": 20, "full_name": 100, "tc_hash": 64, "city": 50, "district": 50,
                "status": 20, "phone": 30, "email": 100},
    "plans": {"plan_id": 20, "plan_name": 100, "plan_type": 20},
    "subscriptions": {"subscription_id": 15, "member_id": 20, "plan_id": 20,
                      "subscription_status": 20},
    "payments": {"payment_id": 20, "subscription_id": 15, "member_id": 20,
                 "payment_status": 20},
    "lottery": {"lottery_id": 20, "member_id": 20, "plan_id": 20, "subscription_id": 15},
    "dim_member": {"member_id": 20, "full_name": 100, "tc_hash": 64, "city": 50, "district": 50,
                   "age_group": 20, "income_bracket": 20, "member_status": 20},
    "dim_plan": {"plan_id": 20, "plan_name": 100, "plan_type": 20},
    "fact_payments": {"payment_id": 20, "payment_status": 20},
    "fact_lottery": {"lottery_id": 20},
}

# Declared NUMERIC(p, s) columns, fixed values of the DDL.
NUMERIC_BOUNDS = {
    "members": {"income": (12, 2)},
    "plans": {"target_amount": (15, 2), "monthly_installment": (12, 2)},
    "payments": {"due_amount": (12, 2), "paid_amount": (12, 2)},
    "dim_plan": {"target_amount": (15, 2), "monthly_installment": (12, 2)},
    "fact_payments": {"due_amount": (12, 2), "paid_amount": (12, 2)},
    "fact_lottery": {"cumulative_paid_ratio": (5, 4)},
}
