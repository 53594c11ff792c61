"""Benchmark: the star-schema jobs at $BENCH_SF_DIR on local[$BENCH_CPUS].

As in production, the staging tables are Parquet written upstream: the driver
tables are reshaped into staging once (S2, timed as ``staging_write``) and every
job then reads staging through the declared-schema scan (S1). Each headline job
runs in full with the ``noop`` sink (every row computed, nothing collected);
``star_load`` is the whole daily run (five stages writing Parquet snapshots plus
the audit), the counterpart of the reference's logged "full pipeline" time.
Prints one JSON line. ``--explain`` prints the formatted physical plans of the
headline jobs instead.
"""

from __future__ import annotations

import json
import os
import sys
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from starforge.session import build_session, work_dir, work_path  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    extra = {"spark.ui.showConsoleProgress": "false",
             "spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g"),
             "spark.eventLog.enabled": "false"}
    spark = build_session(f"local[{cpus}]", app="starforge-bench",
                          shuffle_partitions=max(8, 2 * cpus), extra=extra)
    spark.sparkContext.setLogLevel("ERROR")
    work_dir(spark)  # spark.checkpoint.dir, or a scratch folder only where it is unset

    from starforge import schemas
    from starforge.operators import calendar, dims, facts, profile, quality, scd2
    from starforge.plans.star_load import run_star_load
    from starforge.sources import snapshots as snap
    from starforge.sources.adapter import AS_OF, SPINE, previous_members, staging_from_driver
    from starforge.sources.staging import read_all_staging, write_staging

    times: dict[str, float] = {}
    root = work_path(spark, "bench", uuid.uuid4().hex)

    t0 = time.time()
    write_staging(staging_from_driver(spark, sf_dir, spread=cpus), f"{root}/staging")
    times["staging_write"] = round(time.time() - t0, 3)
    st = read_all_staging(spark, f"{root}/staging")

    def run(name, df):
        t = time.time()
        df.write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t, 3)

    if "--explain" in sys.argv:  # print the formatted physical plans instead of timing
        dm, dp = dims.dim_member_full(st.members, AS_OF), dims.dim_plan(st.plans)
        prev = dims.dim_member_full(previous_members(st.members), AS_OF)
        for name, df in {
            "fact_payments": facts.fact_payments(st.payments, dm, dp),
            "fact_lottery": facts.fact_lottery(st.lottery, st.payments, dm, dp),
            "scd2_apply": scd2.scd2_apply(prev, st.members, AS_OF),
            "dq_report": quality.dq_report(st, dm, AS_OF),
        }.items():
            print(f"===== {name}")
            df.explain("formatted")
        spark.stop()
        return

    run("warmup", dims.dim_plan(st.plans))
    del times["warmup"]
    dm, dp = dims.dim_member_full(st.members, AS_OF), dims.dim_plan(st.plans)
    prev = dims.dim_member_full(previous_members(st.members), AS_OF)
    headline = {
        "dim_date": calendar.dim_date(spark, *SPINE),
        "dim_plan": dp,
        "dim_member_clean": dm,
        "scd2_apply": scd2.scd2_apply(prev, st.members, AS_OF),
        "fact_payments": facts.fact_payments(st.payments, dm, dp),
        "fact_lottery": facts.fact_lottery(st.lottery, st.payments, dm, dp),
        "dq_report": quality.dq_report(st, dm, AS_OF),
        "profile_payment_status": profile.payment_status_share(st.payments),
        "profile_lottery_by_plan": profile.lottery_by_plan(st.lottery, st.plans),
    }
    for name, df in headline.items():
        run(name, df)

    # a second day of the member dimension alone: inserts, updates and unchanged members
    first = scd2.scd2_delta(scd2.empty_dim_member(spark), previous_members(st.members), AS_OF)
    snap.write_snapshot(first, f"{root}/days", "dim_member", "1", partition_by=["is_current"])
    t0 = time.time()
    current = snap.read_scd2_current(spark, f"{root}/days", "dim_member", schemas.DIM_MEMBER, before="2")
    snap.write_snapshot(scd2.scd2_delta(current, st.members, AS_OF), f"{root}/days", "dim_member", "2", partition_by=["is_current"])
    times["dim_member_second_day"] = round(time.time() - t0, 3)

    t0 = time.time()
    rep = run_star_load(spark, st, f"{root}/star", AS_OF, spine=SPINE)
    times["star_load"] = round(time.time() - t0, 3)
    for s in rep.stages:
        times[f"star_load.{s.stage}"] = s.duration
    failed = [s.stage for s in rep.stages if s.status != "success"]
    throughput = {s.stage: {"rows": s.rows, "rows_per_sec": round(s.rows / s.duration) if s.duration else None}
                  for s in rep.stages}

    sf = sf_dir.rsplit("sf", 1)[-1]
    out = {"metric": "star_load_wall_clock", "value": times["star_load"], "unit": "sec",
           "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
           "cpus": cpus, "failed_stages": failed, "star_load_throughput": throughput,
           "total_headline_sec": round(sum(times[q] for q in headline), 3)}
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
