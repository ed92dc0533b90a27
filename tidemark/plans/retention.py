"""Deleting what no publication lists any more, so that an erasure ends."""

from __future__ import annotations

from datetime import datetime, timezone

from tidemark.plans.warehouse import Warehouse
from tidemark.sources.tables import PART, SnapshotTables


def expire(wh: Warehouse, before: datetime) -> list[str]:
    """Delete folders of stored tables that were superseded and written before ``before`` (UTC); returns their paths.

    A person who was erased stays in superseded folders until then. Choose ``before`` so that no reader of an earlier
    publication and no running job is older. The current publication and what it lists are never touched.
    """
    limit = int(before.replace(tzinfo=timezone.utc).timestamp() * 1000)
    return [path for tables in (wh.clean, wh.served, wh.sessions) for path in _expire(tables, limit)]


def _expire(tables: SnapshotTables, limit: int) -> list[str]:
    jvm = tables.spark._jvm
    at = lambda path: jvm.org.apache.hadoop.fs.Path(path)
    fs = at(tables.root).getFileSystem(tables.spark._jsc.hadoopConfiguration())
    snap = tables.snapshot()
    listed = {fs.makeQualified(at(f)).toString() for parts in snap.folders.values() for f in parts.values()}
    current = fs.makeQualified(at(f"{tables.root}/control/publication={snap.version}")).toString()

    def below(path: str, start: str) -> list:
        found = fs.listStatus(at(path)) if fs.exists(at(path)) else []
        return [s for s in found if s.isDirectory() and s.getPath().getName().startswith(start)]

    doomed = [s for s in below(f"{tables.root}/control", "publication=") if s.getPath().toString() != current]
    for name in tables.schemas:
        for run in below(f"{tables.root}/{name}", "run="):
            parts = below(run.getPath().toString(), f"{PART}=")
            gone = [s for s in parts if s.getPath().toString() not in listed]
            doomed += [run] if len(gone) == len(parts) else gone
    old = [s.getPath().toString() for s in doomed if s.getModificationTime() < limit]
    for path in old:
        fs.delete(at(path), True)
    return old
