"""The daily load holds few bytes on disk: facts are loaded in parts, shuffle files go with the job that made them (F1, F2)."""

import datetime as dt
import os
import time
import uuid
from decimal import Decimal

import pytest

from starforge import schemas
from starforge.functions import rules
from starforge.plans import star_load
from starforge.session import LOAD_CONF, load_settings, work_path
from starforge.sources import snapshots as snap
from starforge.sources.adapter import Staging
from starforge.sources.table_state import read_state

D = dt.date
DAY = D(2001, 6, 1)
SPINE = (D(2001, 1, 1), D(2001, 12, 31))


@pytest.fixture
def staging(spark):
    """Repeated and NULL ids, ids and days without a parent, two variants of a plan."""
    member = lambda m: (m, "n", f"hash-{m}", "c", "d", 1980, D(1980, 1, 1), Decimal("1.00"), D(2001, 1, 1), "aktif", None, None)
    paid = rules.PAID_STATUSES[0]
    pay = lambda i, m, p, due: (i, "S1", m, p, 1, due, None, Decimal("10.00"), Decimal("10.00"), paid)
    payments = [pay(f"P{i % 30}", f"M{i % 5}", f"L{i % 3}", D(2001, 1 + i % 12, 1)) for i in range(60)]
    payments += [pay("X1", "M9", "L0", DAY), pay("X2", "M0", "L9", DAY), pay("X3", "M0", "L0", D(1900, 1, 1)),
                 pay(None, "M0", "L0", DAY), pay(None, None, "L0", DAY), pay("X1", "M9", "L0", DAY), pay("X4", "M0", None, None)]
    lottery = [(f"D{i % 20}", f"M{i % 5}", f"L{i % 3}", None, D(2001, 1 + i % 12, 15), i % 4, i % 7 == 0) for i in range(40)]
    lottery += [(None, "M0", "L0", None, DAY, 1, True), ("D90", "M9", "L0", None, DAY, 1, True), ("D91", "M0", "L0", None, None, 1, False)]
    tables = {"members": [member(f"M{i}") for i in range(4)], "subscriptions": [], "payments": payments, "lottery": lottery,
              "plans": [(f"L{i}", "p", "konut", 12, Decimal("120.00"), None) for i in range(3)] + [("L1", "q", "arsa", 6, Decimal("60.00"), None)]}
    return Staging(**{t: spark.createDataFrame(rows, schemas.STAGING[t]) for t, rows in tables.items()})


def _loaded(spark, staging, base, **kwargs):
    rep = star_load.run_star_load(spark, staging, base, DAY, spine=SPINE, **kwargs)
    rows = {t: sorted(map(str, spark.read.parquet(f"{base}/{t}/run_id={rep.run_id}").collect()))
            for t in ("fact_payments", "fact_payments_rejects", "payments_pending", "fact_lottery", "fact_lottery_rejects")}
    return [(s.stage, s.status, s.rows, s.rejected) for s in rep.stages], rows


def test_parts_of_a_load_add_up_to_the_whole(spark, staging, monkeypatch):
    whole = _loaded(spark, staging, work_path(spark, "test-parts", uuid.uuid4().hex))
    assert [s[1] for s in whole[0]] == ["success"] * 5 and min(map(len, whole[1].values())) > 0
    monkeypatch.setattr(star_load, "PART_ROWS", 20)
    seen, held = [], snap.write_snapshot
    monkeypatch.setattr(snap, "write_snapshot", lambda df, base, table, *a, **k: seen.append((table, df.count())) or held(df, base, table, *a, **k))
    base = work_path(spark, "test-parts", uuid.uuid4().hex)
    assert _loaded(spark, staging, base) == whole
    assert _loaded(spark, staging, base) == whole  # the first part of a replay replaces what the run had
    parts = [n for t, n in seen if t == "fact_payments_held"]
    assert len(parts) == 2 * 4 and max(parts) < sum(parts) / 4
    assert not snap.list_names(spark, f"{base}/fact_payments_held") and not snap.list_names(spark, f"{base}/fact_lottery_counts")


def test_fact_without_its_last_part_is_not_seen(spark, staging, monkeypatch):
    monkeypatch.setattr(star_load, "PART_ROWS", 20)
    calls, first = [], star_load.facts.first_payments

    def fails(taken):
        calls.append(taken)
        if len(calls) == 3:
            raise RuntimeError("lost")
        return first(taken)

    monkeypatch.setattr(star_load.facts, "first_payments", fails)
    base = work_path(spark, "test-parts", uuid.uuid4().hex)
    rep = star_load.run_star_load(spark, staging, base, DAY, spine=SPINE)
    assert {s.stage: s.status for s in rep.stages}["fact_payments"] == "failed"
    assert any(n.endswith(".parquet") for n in snap.list_names(spark, f"{base}/fact_payments/run_id={rep.run_id}"))
    assert snap.snapshot_runs(spark, base, "fact_payments") == [] and read_state(spark, base, "fact_payments").base is None
    again = star_load.run_star_load(spark, staging, base, DAY, spine=SPINE, resume=True)
    assert {s.stage: s.status for s in again.stages}["fact_payments"] == "success"
    assert snap.snapshot_runs(spark, base, "fact_payments") == [rep.run_id]


def _shuffle_files(spark):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {f for d in disk.localDirsString() for _, _, names in os.walk(d) for f in names if f.startswith("shuffle_")}


def test_load_leaves_no_shuffle_files(spark, staging):
    before = _shuffle_files(spark)
    _loaded(spark, staging, work_path(spark, "test-parts", uuid.uuid4().hex))
    until = time.time() + 20
    while (left := _shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.2)
    assert not left


def test_load_settings_are_restored(spark):
    key = next(iter(LOAD_CONF))
    before = {k: spark.conf.get(k, None) for k in LOAD_CONF}
    with pytest.raises(ValueError), load_settings(spark):
        assert spark.conf.get(key) == "true"
        raise ValueError
    assert {k: spark.conf.get(k, None) for k in LOAD_CONF} == before
