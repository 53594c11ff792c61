"""The state of a table made of several folders: which of them belong to it.

A full load writes a table whole, a batch adds to it, a compaction folds batches into one folder. All write folders of
their own, ``<table>/run_id=<id>``, and then publish a state: a small numbered file under ``<table>/_state`` that
names the folders. It is written beside its place and renamed, so readers see the old table or the new one, never a
part; a writer publishes on top of the state it has read, and fails where another one came first, leaving its folders
unnamed. Folders that no kept state names belong to nothing and are removed by :func:`drop_unnamed`.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, replace

from pyspark.sql import SparkSession

from starforge.sources import snapshots as snap

#: States kept for readers that began before the newest one.
KEPT_STATES = 5


@dataclass(frozen=True)
class TableState:
    """``base`` is the folder of a full load, ``batches`` what came on top of it, oldest first; ``pending`` the folders of
    rows that wait for a parent and ``parents`` the runs of the dimensions they were last held against; ``buckets`` the
    number of buckets of the key index; ``indexed`` says whether the base's keys are in it; ``folded`` names the batches that
    a compaction made part of the base (daily counts only)."""
    version: int = 0
    base: str | None = None
    batches: tuple[str, ...] = ()
    pending: tuple[str, ...] = ()
    parents: tuple[str, ...] = ()
    buckets: int = 64
    indexed: bool = False
    folded: tuple[str, ...] = ()

    @property
    def folders(self) -> list[str]:
        return ([self.base] if self.base else []) + list(self.batches)

    def with_base(self, run: str, pending: tuple[str, ...] = (), parents: tuple[str, ...] = (), buckets: int = 64) -> TableState:
        return TableState(self.version, run, (), pending, parents, buckets)

    def with_batch(self, run: str, pending: tuple[str, ...], parents: tuple[str, ...]) -> TableState:
        return replace(self, batches=(*self.batches, run), pending=pending, parents=parents)


def _folder(base: str, table: str) -> str:
    return f"{base.rstrip('/')}/{table}/_state"


def versions(spark: SparkSession, base: str, table: str) -> list[int]:
    """Published versions, oldest first (a directory listing)."""
    names = snap.list_names(spark, _folder(base, table))
    return sorted(int(n[1:-5]) for n in names if n.startswith("v") and n.endswith(".json"))


def _file(base: str, table: str, version: int) -> str:
    return f"{_folder(base, table)}/v{version:010d}.json"


def read_state(spark: SparkSession, base: str, table: str, version: int | None = None) -> TableState:
    """The newest state, or that of ``version``; an empty one (version 0) where the table has none."""
    if version is None:
        version = max(versions(spark, base, table), default=0)
    text = snap.read_small(spark, _file(base, table, version)) if version else None
    if text is None:
        return TableState()
    held = json.loads(text)
    return TableState(**{k: tuple(v) if isinstance(v, list) else v for k, v in held.items()})


def publish(spark: SparkSession, base: str, table: str, state: TableState) -> TableState:
    """Make ``state``, derived from the newest one, the table's next state; an error if that is no longer the newest."""
    newest = max(versions(spark, base, table), default=0)
    if newest != state.version:
        raise RuntimeError(f"{table} changed while it was written: read at version {state.version}, now {newest}")
    made = replace(state, version=newest + 1)
    snap.write_small(spark, _file(base, table, made.version), json.dumps(asdict(made)))
    return made


def drop_unnamed(spark: SparkSession, base: str, table: str, beside: tuple[str, ...] = (), keep: int = KEPT_STATES) -> list[str]:
    """Keep the newest ``keep`` states and the folders they name, in ``table`` and in the tables ``beside`` it (key
    index, replaced, pending and rejected rows); remove all older states and folders. Not while a batch runs."""
    have = versions(spark, base, table)
    kept = [read_state(spark, base, table, v) for v in have[-max(1, keep):]]
    for v in have[:-max(1, keep)]:
        snap.remove(spark, _file(base, table, v))
    if not kept:
        return []
    named = {r for s in kept for r in (*s.folders, *s.pending)}
    gone = []
    for t in (table, *beside):
        for name in snap.list_names(spark, f"{base.rstrip('/')}/{t}"):
            if name.startswith("run_id=") and name[len("run_id="):] not in named:
                snap.remove(spark, f"{base.rstrip('/')}/{t}/{name}")
                gone.append(f"{t}/{name}")
    return gone
