"""Queries that use derived rows several times make them once."""

import datetime as dt

import pytest

from starforge import schemas
from starforge.operators import quality
from starforge.plans import catalog, daily_quality, star_load
from starforge.sources.adapter import Staging


class Seen(Exception):
    pass


@pytest.fixture
def staging(spark, monkeypatch):
    tables = {t: [] for t in schemas.STAGING}
    tables["payments"] = [(f"P{i}", f"S{i}", "M1", "P1", 1, dt.date(1997 + i, 2, 3), None, None, None, "odenmedi") for i in range(4)]
    st = Staging(**{t: spark.createDataFrame(rows, schemas.STAGING[t]) for t, rows in tables.items()})
    monkeypatch.setattr(catalog, "_st", lambda spark, sf_dir: st)
    return st


def _stop_at(monkeypatch, module, name, frame):
    """Files of the frame that the call gets; nothing runs after it."""
    got = []

    def stop(*args, **kwargs):
        got.append(frame(*args, **kwargs))
        raise Seen

    monkeypatch.setattr(module, name, stop)
    return got


def test_load_then_incremental_loads_the_day_file(spark, staging, monkeypatch):
    got = _stop_at(monkeypatch, star_load, "run_star_load", lambda spark, st, *a, **k: st.payments)
    with pytest.raises(Seen):
        catalog.q_load_then_incremental(spark, "")
    assert got[0].inputFiles() and all("/day=1/" in f for f in got[0].inputFiles())
    assert sorted(r.payment_id for r in got[0].collect()) == ["P0", "P1"]


def test_quality_batches_are_read_from_their_files(spark, staging, monkeypatch):
    got = _stop_at(monkeypatch, daily_quality, "add_batch", lambda spark, base, run, st, ids: st.payments)
    with pytest.raises(Seen):
        catalog.q_dq_report_by_batches(spark, "")
    assert got[0].inputFiles() and got[0].schema == staging.payments.schema
    assert [r.payment_id for r in got[0].collect()] == ["P1"]  # due in 1998, the year of day 0


def test_foreign_keys_are_checked_on_a_stored_fact(spark, staging, monkeypatch):
    got = _stop_at(monkeypatch, quality, "fk_violations", lambda child, *a: child)
    with pytest.raises(Seen):
        catalog.q_fk_violations(spark, "")
    assert set(got[0].columns) == {"member_id", "plan_id", "member_key", "plan_key", "date_key"}
