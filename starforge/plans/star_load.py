"""The daily star-schema load, stage by stage, with failure isolation and audit.

Stage order: dim_date, dim_plan, dim_member (SCD2), fact_payments,
fact_lottery. A failing stage is audited as "failed" and the rest still run;
a fact stage reads the newest complete dimension snapshot (this run's if its
stage succeeded, an earlier one otherwise). Each stage writes a snapshot and
reads it back, which also cuts the lineage between stages.

The three dimension stages do not depend on each other, nor do the two fact
stages; with ``concurrent=True`` each group is submitted as concurrent Spark
jobs (one driver thread per stage), so small dimension jobs do not leave the
cluster idle. The facts start only after every dimension stage has ended.

A large fact is loaded in parts by the hash of its id, so that the shuffles of
one part at a time lie on disk; its snapshot is complete with the last part.
"""

from __future__ import annotations

import datetime as dt
import threading
import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from starforge import schemas
from starforge.functions.calendar import DEFAULT_SPINE
from starforge.operators import calendar, dims, facts, foreign_keys, scd2
from starforge.schemas import conform
from starforge.session import load_settings
from starforge.sources import snapshots as snap
from starforge.sources.table_state import drop_unnamed, publish, read_state
from starforge.streaming import incremental as inc

#: Name of the state that says which run is published as a whole.
PUBLISHED = "star_runs"
STAGES = ["dim_date", "dim_plan", "dim_member", "fact_payments", "fact_lottery"]
#: A fact's rows are loaded in parts of about so many rows, by the hash of the id, at most so many parts: only the shuffles
#: of one part lie on disk at a time. Each part reads the staging table again.
PART_ROWS, MOST_PARTS = 1_000_000, 4


@dataclass
class StageResult:
    stage: str
    status: str
    rows: int = 0
    duration: float = 0.0
    error: str | None = None
    rejected: int = 0


@dataclass
class LoadReport:
    run_id: str
    stages: list[StageResult] = field(default_factory=list)


def by_date(fact: DataFrame) -> DataFrame:
    """Rows of each file in the order of their date, so that a read of a date range skips
    row groups and pages by their bounds. No shuffle, and no folder per month and task."""
    return fact.sortWithinPartitions("date_key")


def parts_for(rows: int) -> int:
    return max(1, min(MOST_PARTS, -(-rows // PART_ROWS)))


def part_of(key: str, parts: int):
    """Part of a row; all rows of an id share one, so a part's first rows per id are those of the whole."""
    return F.pmod(F.xxhash64(key), F.lit(parts))


def _succeeded(spark: SparkSession, base: str, run_id: str) -> dict[str, int]:
    """Stages of a run whose newest audit row says success, with their rows (five rows for each call of the run)."""
    if not snap.list_names(spark, f"{base.rstrip('/')}/stage_runs"):
        return {}
    rows = snap.read_audit(spark, base).where(F.col("run_id") == run_id).orderBy("logged_at").collect()
    last = {r["stage"]: r for r in rows}
    return {n: r["rows_inserted"] for n, r in last.items() if r["status"] == "success"}


def read_star(spark: SparkSession, base: str) -> dict[str, DataFrame] | None:
    """The five tables of the newest run that succeeded as a whole; None before the first one. Runs that failed in part,
    and tables of runs still at work, are not seen, so days are never mixed. Batches on top of the payment fact are in
    ``streaming.incremental.fact_batches``."""
    run_id = read_state(spark, base, PUBLISHED).base
    if run_id is None:
        return None
    whole = {t: spark.read.parquet(f"{base.rstrip('/')}/{t}/run_id={run_id}") for t in ("dim_date", "dim_plan", "fact_payments", "fact_lottery")}
    return whole | {"dim_member": snap.read_scd2(spark, base, "dim_member", schemas.DIM_MEMBER, upto=run_id)}


def run_star_load(spark: SparkSession, staging, base: str, as_of: dt.date,
                  run_id: str | None = None, spine=DEFAULT_SPINE,
                  fail_stages: tuple[str, ...] = (), concurrent: bool = True,
                  keep_runs: int | None = None, resume: bool = False) -> LoadReport:
    """Run all stages for one day. ``fail_stages`` forces failures (for tests).

    ``keep_runs``: snapshots to keep of each table that every run writes whole (all of
    them by default); older ones are deleted once every stage has succeeded. A failed
    audit write does not stop the other stages; it is raised after them.

    ``resume`` goes on with a run of that id that did not get through: stages whose last
    audit row says success are kept (status "kept", not audited again), unless they are
    facts and a dimension is loaded again. Once all five stages of a run have succeeded
    the run is published as a whole, see :func:`read_star`.
    """
    run_id = run_id or as_of.strftime("%Y%m%d")
    report = LoadReport(run_id)
    lock = threading.Lock()
    unaudited: list[Exception] = []

    kept = _succeeded(spark, base, run_id) if resume else {}
    if any(d not in kept for d in STAGES[:3]):
        kept = {n: r for n, r in kept.items() if n in STAGES[:3]}  # these facts were loaded against other dimensions

    def stage(name, fn):
        t0 = time.time()
        if name in kept:
            with lock:
                report.stages.append(StageResult(name, "kept", kept[name]))
            return
        try:
            if name in fail_stages:
                raise RuntimeError(f"forced failure of {name}")
            rows, rejected = fn()
            res = StageResult(name, "success", rows, round(time.time() - t0, 2), rejected=rejected)
        except Exception as e:  # isolate the stage, keep going
            res = StageResult(name, "failed", 0, round(time.time() - t0, 2), str(e))
        try:
            snap.append_audit(spark, base, run_id, res.stage, res.status, res.rows, res.duration, res.error, res.rejected)
        except Exception as e:
            unaudited.append(e)
        with lock:
            report.stages.append(res)

    def load_dim_date():
        return spark.read.parquet(snap.write_snapshot(calendar.dim_date(spark, *spine), base, "dim_date", run_id)).count(), 0

    def load_dim_plan():
        return spark.read.parquet(snap.write_snapshot(dims.dim_plan(staging.plans), base, "dim_plan", run_id)).count(), 0

    def load_dim_member():
        # only the current rows are read; the run stores the new current set and
        # the rows it closed (history is append-only, see sources.snapshots)
        prev = snap.read_scd2_current(spark, base, "dim_member", schemas.DIM_MEMBER, before=run_id)
        prev = scd2.empty_dim_member(spark) if prev is None else prev
        obs = Observation("dim_member")
        delta = scd2.scd2_delta(prev, staging.members, as_of, observation=obs)
        snap.write_snapshot(delta, base, "dim_member", run_id, partition_by=["is_current"])
        # Inserted + updated + skipped + rejected = clean rows read. Rejects are always written: counts of a
        # run whose tasks ran twice can't tell that there are none
        rejects = spark.read.parquet(snap.write_snapshot(dims.rejected_members(staging.members), base, "dim_member_rejects", run_id)).count()
        return int(sum(obs.get.get(k, 0) for k in (scd2.INSERT, scd2.UPDATE, scd2.SKIP))) + rejects, rejects

    def dims_for_facts():
        # newest snapshots up to this run: a replayed older day never joins against a later day's dimensions
        dm = snap.read_scd2_current(spark, base, "dim_member", schemas.DIM_MEMBER, upto=run_id)
        dp = snap.read_latest(spark, base, "dim_plan", upto=run_id)
        dd = snap.read_latest(spark, base, "dim_date", upto=run_id)
        if dm is None or dp is None or dd is None:
            raise RuntimeError("no complete dimension snapshot to load facts against")
        return dm, dp, dd

    def held(rows, date, parents, table, **columns):
        """The rows held against their parents in one pass, stored for the fact and the rejects; dropped with them."""
        dm, dp, dd = parents
        path = snap.write_snapshot(foreign_keys.held_against(rows, date, dm, dp, dd, **columns), base, f"{table}_held", run_id)
        return spark.read.parquet(path)

    def load_by_parts(rows, key, date, parents, table, rejects, schema, fact_of, **columns):
        """Hold the rows against their parents and write the fact and the rows that it can't take, with the reason, part by
        part. Returns the joined rows before the calendar check and de-duplication, as the source reports them."""
        joined, n = 0, parts_for(rows.count())
        for i in range(n):
            part = held(rows if n == 1 else rows.where(part_of(key, n) == i), date, parents, table, **columns)
            joined += part.where(foreign_keys.joined() & F.col(key).isNotNull()).count()
            snap.append_part(by_date(conform(fact_of(foreign_keys.taken(part)), schema)), base, table, run_id, first=i == 0)
            snap.append_part(foreign_keys.rejected(part, rows.columns), base, rejects, run_id, first=i == 0)
            drop_aside(f"{table}_held")
        for t in (table, rejects):
            snap.complete(spark, base, t, run_id)
        return joined

    def drop_aside(table):
        snap.remove(spark, f"{base.rstrip('/')}/{table}/run_id={run_id}")

    def load_fact_payments():
        dims_now = dims_for_facts()
        state = read_state(spark, base, inc.FACT)
        known = tuple(snap.runs_upto(spark, base, t, run_id)[-1] for t in ("dim_member", "dim_plan"))
        joined = load_by_parts(staging.payments, "payment_id", F.coalesce("paid_date", "due_date"), dims_now, inc.FACT, inc.REJECTS,
                               schemas.FACT_PAYMENTS, facts.first_payments)
        rejected = spark.read.parquet(f"{base.rstrip('/')}/{inc.REJECTS}/run_id={run_id}")
        snap.write_snapshot(inc.waiting_rows(rejected), base, inc.PENDING, run_id)
        # a full load replaces the fact and its batches; a replay of an older day changes only that day's folder
        if state.base is None or snap.run_order(state.base) < snap.run_order(run_id):
            publish(spark, base, inc.FACT, state.with_base(run_id, (run_id,), known))
        return joined, rejected.count()

    def load_fact_lottery():
        table = "fact_lottery"
        dims_now = dims_for_facts()
        counts = spark.read.parquet(snap.write_snapshot(facts.paid_counts(staging.payments, staging.lottery), base, f"{table}_counts", run_id))
        joined = load_by_parts(staging.lottery, "lottery_id", F.col("lottery_date"), dims_now, table, f"{table}_rejects", schemas.FACT_LOTTERY,
                               lambda taken: facts.with_ratio_of(facts.lottery_columns(taken), counts), member_columns=("member_key", "signup_date"))
        drop_aside(f"{table}_counts")
        return joined, spark.read.parquet(f"{base.rstrip('/')}/{table}_rejects/run_id={run_id}").count()

    fns = dict(zip(STAGES, [load_dim_date, load_dim_plan, load_dim_member,
                            load_fact_payments, load_fact_lottery]))
    waves = [STAGES[:3], STAGES[3:]]
    with load_settings(spark):
        for wave in waves:
            if concurrent:
                with ThreadPoolExecutor(max_workers=len(wave)) as pool:
                    list(pool.map(lambda n: stage(n, fns[n]), wave))
            else:
                for n in wave:
                    stage(n, fns[n])
    report.stages.sort(key=lambda r: STAGES.index(r.stage))
    if unaudited:
        raise RuntimeError(f"{len(unaudited)} stages of run {run_id} were not audited") from unaudited[0]
    whole = all(r.status in ("success", "kept") for r in report.stages)
    if whole:
        state = read_state(spark, base, PUBLISHED)
        if state.base is None or snap.run_order(state.base) <= snap.run_order(run_id):
            publish(spark, base, PUBLISHED, state.with_base(run_id))
    if keep_runs is not None and whole:
        for table in ("dim_date", "dim_plan", "fact_lottery", "fact_lottery_rejects", "dim_member_rejects"):
            snap.drop_old_runs(spark, base, table, keep_runs)
        inc.drop_unnamed_payments(spark, base, keep_runs)
        drop_unnamed(spark, base, PUBLISHED, keep=keep_runs)
    return report
