"""Command line for the daily entry points: load, incremental, profile, dq.

    python -m starforge.cli load    --staging S --warehouse W --as-of 2026-12-02
    python -m starforge.cli incremental --warehouse W --as-of 2026-12-02 \\
        --members-in IM --payments-in IP --checkpoint C
    python -m starforge.cli profile --staging S
    python -m starforge.cli dq      --staging S --warehouse W --as-of 2026-12-02
    python -m starforge.cli dq      --staging NEW --warehouse W --as-of 2026-12-02 --batch 2026-12-02

Paths are Parquet staging / warehouse folders (any Hadoop file system). The
session comes from ``spark-submit`` (master, resources); an external scheduler
runs the load once a day. Only small aggregate results are shown.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json

from starforge import schemas
from starforge.session import build_session


def _date(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


def cmd_load(spark, a) -> None:
    from starforge.plans.star_load import run_star_load
    from starforge.sources.staging import read_all_staging
    st = read_all_staging(spark, a.staging)
    from starforge.functions.calendar import DEFAULT_SPINE
    spine = (a.spine_start or DEFAULT_SPINE[0], a.spine_end or DEFAULT_SPINE[1])
    size_session(spark, a.staging)
    rep = run_star_load(spark, st, a.warehouse, a.as_of, run_id=a.run_id, spine=spine, keep_runs=a.keep_runs, resume=a.resume)
    print(json.dumps({"run_id": rep.run_id, "stages": [s.__dict__ for s in rep.stages]}))


def size_session(spark, staging: str) -> None:
    """Shuffle, scan and broadcast sizes from the bytes of the staging files; a shuffled row
    takes about three times its bytes in Parquet."""
    from starforge.session import scale_conf
    from starforge.sources.snapshots import folder_bytes
    for k, v in scale_conf(3 * folder_bytes(spark, staging), spark.sparkContext.defaultParallelism).items():
        spark.conf.set(k, v)


def cmd_incremental(spark, a) -> None:
    """Member and payment files that arrived since the last call, into a warehouse that ``load``
    has filled once; then the payments that still wait for their member or plan."""
    from starforge.streaming import incremental as inc
    day = a.run_id or a.as_of.strftime("%Y%m%d")
    size_session(spark, a.payments_in)
    inc.run_incremental_scd2(spark, a.members_in, a.warehouse, f"{a.checkpoint}/members", a.as_of, prefix=day)
    inc.run_incremental_payments(spark, a.payments_in, a.warehouse, f"{a.checkpoint}/payments", prefix=day)
    inc.retry_pending_payments(spark, a.warehouse)
    if a.compact:
        inc.compact_payments(spark, a.warehouse)


def cmd_profile(spark, a) -> None:
    from starforge.operators import profile as p
    from starforge.sources.staging import read_all_staging
    st = read_all_staging(spark, a.staging)
    sections = [
        ("totals", p.totals(st)), ("member status", p.status_distribution(st.members)),
        ("cities, top 10", p.city_top(st.members, 10)), ("income", p.income_stats(st.members)),
        ("dirty members", p.dirty_members(st.members)), ("plans", p.plan_listing(st.plans)),
        ("payment status", p.payment_status_share(st.payments)),
        ("lateness", p.lateness(st.payments)), ("negative payments", p.negative_payments(st.payments)),
        ("lottery", p.lottery_summary(st.lottery)),
        ("lottery by plan", p.lottery_by_plan(st.lottery, st.plans)),
        ("lottery months, top 10", p.lottery_trend(st.lottery, 10)),
    ]
    for title, df in sections:
        print(f"== {title}")
        _report(df, title, a.out, a.rows)


def _report(df, title: str, out: str | None, rows: int | None = None) -> None:
    """A whole section: to a JSON folder under ``out``, or printed row by row."""
    if out:
        folder = title.replace(",", "").replace(" ", "_")
        df.write.mode("overwrite").json(f"{out.rstrip('/')}/{folder}")
        return
    print("\t".join(df.columns))
    for row in (df if rows is None else df.limit(rows)).toLocalIterator():
        print("\t".join("" if v is None else str(v) for v in row))


def cmd_dq(spark, a) -> None:
    from starforge.operators import dims, quality
    from starforge.sources import snapshots as snap
    from starforge.sources.staging import read_all_staging, read_raw_staging
    bounds = quality.union_all([
        quality.bound_violations(read_raw_staging(spark, a.staging, t), f"staging.{t}",
                                 schemas.VARCHAR_BOUNDS.get(t, {}), schemas.NUMERIC_BOUNDS.get(t, {})) for t in schemas.STAGING])
    _report(bounds, "type bounds", a.out, a.rows)  # on the files as delivered
    st = read_all_staging(spark, a.staging)
    if a.batch:
        from starforge.plans import daily_quality
        daily_quality.add_batch(spark, a.warehouse, a.batch, st, dims.clean_members(st.members).select("member_id"))
        if a.compact:
            daily_quality.compact(spark, a.warehouse, f"{a.batch}-compact")
        _report(daily_quality.report(spark, a.warehouse, a.as_of), "data quality", a.out, a.rows)
        return
    dm = snap.read_scd2(spark, a.warehouse, "dim_member", schemas.DIM_MEMBER) if a.warehouse else None
    dm = dims.dim_member_full(st.members, a.as_of) if dm is None else dm
    _report(quality.dq_report(st, dm, a.as_of), "data quality", a.out, a.rows)


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="starforge")
    sub = ap.add_subparsers(dest="cmd", required=True)
    for name in ("load", "profile", "dq"):
        s = sub.add_parser(name)
        s.add_argument("--staging", required=True)
        s.add_argument("--warehouse", required=(name == "load"))
        s.add_argument("--as-of", type=_date, default=None, required=(name != "profile"))
        s.add_argument("--run-id", default=None)
        s.add_argument("--rows", type=int, default=None, help="print only so many rows of a section (default: all)")
        s.add_argument("--out", default=None, help="folder for whole report sections as JSON; printed where unset")
        s.add_argument("--spine-start", type=_date, default=None)
        s.add_argument("--spine-end", type=_date, default=None)
        if name == "dq":
            s.add_argument("--batch", default=None, help="name of the day whose rows the staging folder holds: they are added to the counts in the "
                           "warehouse, and the report covers all days")
            s.add_argument("--compact", action="store_true", help="with --batch: fold the days counted so far into one")
        if name == "load":
            s.add_argument("--resume", action="store_true", help="go on with a run of that id: only stages that failed")
            s.add_argument("--keep-runs", type=int, default=None, help="snapshots to keep of each table written whole by every run (default: all)")
    s = sub.add_parser("incremental")
    for name in ("--warehouse", "--members-in", "--payments-in", "--checkpoint"):
        s.add_argument(name, required=True)
    s.add_argument("--as-of", type=_date, required=True)
    s.add_argument("--run-id", default=None)
    s.add_argument("--compact", action="store_true", help="fold the batches of the payment fact into one folder by date")
    a = ap.parse_args(argv)
    if a.cmd == "dq" and a.batch and not a.warehouse:
        ap.error("dq --batch needs --warehouse")
    spark = build_session(app=f"starforge-{a.cmd}")
    {"load": cmd_load, "incremental": cmd_incremental, "profile": cmd_profile, "dq": cmd_dq}[a.cmd](spark, a)


if __name__ == "__main__":
    main()
