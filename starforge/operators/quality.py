"""Data-quality rules (Q1-Q12), DDL constraint checks (Q13-Q16) and the DQ report.

A rule yields a count of offending rows; PASS iff count <= threshold. Row rules
on one table share a single aggregate (``count_if`` per rule, one scan), in the
report together with the table's duplicate rule; anti-join rules run beside them; all end up as rows of
``rule, table_name, n, threshold, status, detail``.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starforge.functions import rules

# ---- fixed values of the reference report (must stay as written) ----
PASS, FAIL = "PASS", "FAIL"
CLEAN_DETAIL = "Temiz"
DIRTY_DETAIL_SUFFIX = " sorunlu satır"
# ----------------------------------------------------------------------


@dataclass(frozen=True)
class RowRule:
    """A per-row predicate counted over one staging table."""
    rule: str
    table: str
    source: str                       # attribute of the staging bundle
    predicate: Callable[..., Column]  # (as_of) -> Column
    threshold: int = 0


def _null_any(*cols: str) -> Column:
    out = None
    for c in cols:
        out = F.col(c).isNull() if out is None else (out | F.col(c).isNull())
    return out


def _not_in(col: str, values: list[str]) -> Column:
    # NOT IN: a NULL value is not counted (the comparison is unknown).
    return ~F.col(col).isin(values)


# ---- fixed rule names and tables of the reference checks ----
ROW_RULES = [
    RowRule("NULL zorunlu alan (members)", "staging.members", "members",
            lambda as_of: _null_any("member_id", "tc_hash", "city", "income", "signup_date",
                                    "status")),
    RowRule("Invalid member_status", "staging.members", "members",
            lambda as_of: _not_in("status", rules.MEMBER_STATUSES)),
    RowRule("Invalid income", "staging.members", "members",
            lambda as_of: F.col("income") <= 0),
    RowRule("Underage members", "staging.members", "members",
            lambda as_of: rules.age_years("birth_date", as_of) < 18),
    RowRule("NULL payment fields", "staging.payments", "payments",
            lambda as_of: _null_any("payment_id", "subscription_id", "due_date", "due_amount")),
    RowRule("Negative payment", "staging.payments", "payments",
            lambda as_of: F.col("due_amount") <= 0),
    RowRule("Invalid payment_status", "staging.payments", "payments",
            lambda as_of: _not_in("payment_status", rules.PAYMENT_STATUSES)),
    RowRule("Invalid plan_type", "staging.plans", "plans",
            lambda as_of: _not_in("plan_type", rules.PLAN_TYPES)),
]
DUPLICATE_RULES = [
    ("Duplicate member_id", "staging.members", "members", ["member_id"]),
    ("Duplicate payment_id", "staging.payments", "payments", ["payment_id"]),
]
ORPHAN_PAYMENTS = ("Orphan payments", "staging.payments")
FK_FACT_MEMBER = ("subscription → member FK", "fact_subscription")
REPORT_ORDER = [
    "NULL zorunlu alan (members)", "Duplicate member_id", "Invalid member_status",
    "Invalid income", "Underage members", "NULL payment fields", "Duplicate payment_id",
    "Negative payment", "Invalid payment_status", "Orphan payments", "Invalid plan_type",
    "subscription → member FK",
]
# --------------------------------------------------------------


def verdict(counts: DataFrame) -> DataFrame:
    """Add threshold verdict and detail text to rows of (rule, table_name, n, threshold)."""
    n = F.col("n")
    return counts.select(
        "rule", "table_name", n.cast("long").alias("n"), F.col("threshold").cast("long").alias("threshold"),
        F.when(n <= F.col("threshold"), PASS).otherwise(FAIL).alias("status"),
        F.when(n > 0, F.concat(n.cast("string"), F.lit(DIRTY_DETAIL_SUFFIX)))
         .otherwise(CLEAN_DETAIL).alias("detail"))


def _rows(*triples) -> Column:
    return F.explode(F.array(*[
        F.struct(F.lit(rule).alias("rule"), F.lit(table).alias("table_name"),
                 F.coalesce(val, F.lit(0)).cast("long").alias("n"),
                 F.lit(thr).cast("long").alias("threshold"))
        for rule, table, val, thr in triples]))


def row_rule_counts(df: DataFrame, rule_list: list[RowRule], as_of) -> DataFrame:
    """All row rules of one table in ONE scan: one count_if per rule, then unpivot."""
    aggs = [F.count_if(F.coalesce(r.predicate(as_of), F.lit(False))).alias(f"r{i}")
            for i, r in enumerate(rule_list)]
    one = df.agg(*aggs)
    return one.select(_rows(*[(r.rule, r.table, F.col(f"r{i}"), r.threshold)
                              for i, r in enumerate(rule_list)]).alias("x")).select("x.*")


def table_counts(staging, source: str, as_of) -> DataFrame:
    """The row rules and the duplicate rule of one staging table in ONE scan: the rules are
    counted per key group, with map-side combine, and the groups are added up."""
    df = getattr(staging, source)
    rule_list = [r for r in ROW_RULES if r.source == source]
    duplicate = next((d for d in DUPLICATE_RULES if d[2] == source), None)
    if duplicate is None:
        return row_rule_counts(df, rule_list, as_of)
    rule, table, _, keys = duplicate
    flags = [F.count_if(F.coalesce(r.predicate(as_of), F.lit(False))).alias(f"r{i}") for i, r in enumerate(rule_list)]
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("c"), *flags)
    one = groups.agg(F.count_if(F.col("c") > 1).alias("d"), *[F.sum(f"r{i}").alias(f"r{i}") for i in range(len(rule_list))])
    return one.select(_rows((rule, table, F.col("d"), 0),
                            *[(r.rule, r.table, F.col(f"r{i}"), r.threshold) for i, r in enumerate(rule_list)]).alias("x")).select("x.*")


def duplicate_groups(df: DataFrame, keys: list[str]) -> DataFrame:
    """Number of key groups with more than one row (a NULL key is a group).
    Partial aggregation per map task keeps a hot key cheap."""
    g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("c"))
    return g.agg(F.count_if(F.col("c") > 1).alias("n"))


def orphans(child: DataFrame, parent: DataFrame, child_keys: list[str],
            parent_keys: list[str] | None = None, skip_null: bool = False) -> DataFrame:
    """Child rows without a parent row (NOT EXISTS). With ``skip_null``
    a NULL child key is not a violation (FK semantics); otherwise it is."""
    parent_keys = parent_keys or child_keys
    p = parent.select(*[F.col(pk).alias(ck) for ck, pk in zip(child_keys, parent_keys)])
    c = child.select(*child_keys)
    if skip_null:
        c = c.where(~_null_any(*child_keys))
    # a small parent is broadcast (by measured size); otherwise a sort-merge
    # anti-join, whose hot child keys AQE splits (left-anti skew handling)
    return c.join(p, child_keys, "left_anti").agg(F.count(F.lit(1)).alias("n"))


def _single(rule: str, table: str, n_df: DataFrame, threshold: int = 0) -> DataFrame:
    return verdict(n_df.select(F.lit(rule).alias("rule"), F.lit(table).alias("table_name"),
                               F.col("n"), F.lit(threshold).alias("threshold")))


def row_rule(staging, rule_name: str, as_of) -> DataFrame:
    r = next(r for r in ROW_RULES if r.rule == rule_name)
    return verdict(row_rule_counts(getattr(staging, r.source), [r], as_of))


def duplicate_rule(staging, rule_name: str) -> DataFrame:
    rule, table, src, keys = next(d for d in DUPLICATE_RULES if d[0] == rule_name)
    return _single(rule, table, duplicate_groups(getattr(staging, src), keys))


def orphan_payments(staging) -> DataFrame:
    """Q10: payments whose subscription does not exist (NULL subscription counts)."""
    return _single(*ORPHAN_PAYMENTS, orphans(staging.payments, staging.subscriptions,
                                             ["subscription_id"]))


def fk_fact_member(child: DataFrame, dim_member: DataFrame) -> DataFrame:
    """Q12: child rows whose member_id is in no version of the member dimension."""
    return _single(*FK_FACT_MEMBER, orphans(child, dim_member, ["member_id"]))


def dq_report(staging, dim_member: DataFrame, as_of, fk_child: DataFrame | None = None) -> DataFrame:
    """The full report: staging checks (Q1-Q11) and the DWH check (Q12).

    One scan per staging table for its row and duplicate rules, one anti-join per reference rule.
    """
    parts = [table_counts(staging, src, as_of) for src in ("members", "payments", "plans")]
    fk_child = staging.subscriptions if fk_child is None else fk_child
    for (rule, table), n_df in [
        (ORPHAN_PAYMENTS, orphans(staging.payments, staging.subscriptions, ["subscription_id"])),
        (FK_FACT_MEMBER, orphans(fk_child, dim_member, ["member_id"])),
    ]:
        parts.append(n_df.select(F.lit(rule).alias("rule"), F.lit(table).alias("table_name"), "n",
                                 F.lit(0).cast("long").alias("threshold")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return verdict(out)


# ---------------- DDL constraint checks (Q13-Q16) ----------------

def key_violations(df: DataFrame, table: str, keys: list[str]) -> DataFrame:
    """Q13: primary-key violations: rows with a NULL key part, duplicate key groups
    and the surplus rows in them. One grouped aggregate with map-side combine."""
    g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("c"))
    isnull = _null_any(*keys)
    return g.agg(
        F.coalesce(F.sum(F.when(isnull, F.col("c"))), F.lit(0)).cast("long").alias("n_null_keys"),
        F.count_if(~isnull & (F.col("c") > 1)).cast("long").alias("n_duplicate_groups"),
        F.coalesce(F.sum(F.when(~isnull & (F.col("c") > 1), F.col("c") - 1)), F.lit(0))
         .cast("long").alias("n_duplicate_rows"),
    ).select(F.lit(table).alias("table_name"), F.lit(",".join(keys)).alias("key_columns"), "*")


def fk_violations(child: DataFrame, child_table: str, child_col: str,
                  parent: DataFrame, parent_table: str, parent_col: str) -> DataFrame:
    """Q14: child rows whose non-NULL key has no parent (a NULL FK passes, as in SQL)."""
    n = orphans(child, parent, [child_col], [parent_col], skip_null=True)
    return n.select(F.lit(child_table).alias("table_name"), F.lit(child_col).alias("column_name"),
                    F.lit(parent_table).alias("parent_table"), F.col("n").cast("long").alias("n"))


def null_violations(df: DataFrame, table: str, cols: list[str]) -> DataFrame:
    """Q15: NULLs in declared NOT NULL columns, all columns of a table in one scan."""
    one = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"c{i}") for i, c in enumerate(cols)])
    x = F.explode(F.array(*[
        F.struct(F.lit(table).alias("table_name"), F.lit(c).alias("column_name"),
                 F.col(f"c{i}").cast("long").alias("n")) for i, c in enumerate(cols)]))
    return one.select(x.alias("x")).select("x.*")


def bound_violations(df: DataFrame, table: str, varchar: dict[str, int],
                     numeric: dict[str, tuple[int, int]]) -> DataFrame:
    """Q16: values longer than the declared VARCHAR(n) or outside NUMERIC(p,s), one scan.

    Values of any type are held against NUMERIC(p,s), so a table should be checked as it was
    delivered (``read_raw_staging``): once cast to the declared types nothing can be outside. A
    declared column that the table lacks is left out."""
    have = set(df.columns)
    varchar, numeric = ({c: b for c, b in x.items() if c in have} for x in (varchar, numeric))
    checks = []
    for c, n in varchar.items():
        checks.append((c, f"varchar({n})", F.length(F.col(c)) > n))
    for c, (p, s) in numeric.items():
        checks.append((c, f"numeric({p},{s})",
                       F.col(c).isNotNull() & F.col(c).try_cast(f"decimal({p},{s})").isNull()))
    if not checks:
        return df.sparkSession.createDataFrame([], "table_name string, column_name string, bound string, n long")
    one = df.agg(*[F.count_if(F.coalesce(pred, F.lit(False))).alias(f"c{i}")
                   for i, (_, _, pred) in enumerate(checks)])
    x = F.explode(F.array(*[
        F.struct(F.lit(table).alias("table_name"), F.lit(c).alias("column_name"),
                 F.lit(bound).alias("bound"), F.col(f"c{i}").cast("long").alias("n"))
        for i, (c, bound, _) in enumerate(checks)]))
    return one.select(x.alias("x")).select("x.*")


def union_all(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
