"""The right-to-delete job over a warehouse."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators import erasure
from tidemark.operators.joins import without
from tidemark.plans.warehouse import Warehouse
from tidemark.sources.scratch import cut_lineage, new_folder
from tidemark.sources.tables import BATCH


class UnknownPeopleError(ValueError):
    """None of the requested ids is valid and known to any layer."""


def _raw(wh: Warehouse) -> dict[str, DataFrame]:
    return {name: log.rows() for name, log in wh.raw.items() if name != "products"}


def _clean(wh: Warehouse) -> dict[str, DataFrame]:
    snap = wh.clean.snapshot()
    tables = {name: wh.clean.read(name, snap) for name in ("customers", "orders", "payments", "returns")}
    return {**tables, "events": wh.clean_events.rows()}


def erase_people(
    wh: Warehouse, people: DataFrame, requested_by: str, batch: int, run_ts: Column, request_id: str | None = None
) -> str:
    """Erase the people in column ``customer_id``; returns the request id.

    Suppression comes first, so nothing that arrives meanwhile brings a person back;
    the audit is written before rows go, so no deletion is without one. Every step may
    run again: a request repeated under its id keeps what it first recorded, one under its
    id for other people records those, and one under a new id records only what is new.
    ``batch`` is the caller's name for the run.
    """
    request_id = request_id or str(uuid.uuid4())
    raw, clean = _raw(wh), _clean(wh)
    dim = wh.served.read("dim_customer")
    asked = erasure.requests(people)
    known = cut_lineage(erasure.found_in(asked, raw["customers"], clean["customers"], dim))
    if known.isEmpty():
        raise UnknownPeopleError("no requested customer_id was found in any layer")

    fresh = cut_lineage(erasure.not_audited(known, wh.audit.rows(), request_id))
    audit = cut_lineage(
        erasure.audit_rows(raw, clean, dim, wh.suppressed.rows(), fresh, requested_by, run_ts, request_id)
    )
    doomed = cut_lineage(
        erasure.orders_of(raw["orders"], known).unionByName(erasure.orders_of(clean["orders"], known)).distinct()
    )
    record_request(wh, known, doomed, audit, requested_by, run_ts, request_id)

    _remove(wh, known, doomed)

    served = wh.served.snapshot()
    stored = wh.served.read_stored("dim_customer", served)
    redacted = erasure.anonymise(stored, known, run_ts)
    wh.served.publish(served, {"dim_customer": wh.served.write("dim_customer", redacted, served.next)}, {})
    return request_id


def record_request(
    wh: Warehouse, people: DataFrame, doomed: DataFrame, audit: DataFrame, requested_by: str, run_ts: Column, request_id: str
) -> None:
    """Put people on the suppression list, remember their orders, and append the audit entries.

    Entries are kept under the request and whom it is for, so the same id for other people does not find itself done.
    """
    mark = people.agg(F.count("*"), F.sum(F.xxhash64("customer_id").cast("decimal(38,0)"))).first()
    key = f"{request_id}:{mark[0]}:{mark[1]}"
    wh.suppressed.append_once(erasure.suppression_rows(wh.suppressed.rows(), people, requested_by, run_ts), key)
    wh.suppressed_orders.append_once(doomed, key)
    wh.audit.append_once(audit, key)


def sweep_suppressed(wh: Warehouse, batch: int) -> None:
    """Remove what belongs to suppressed people though it was loaded before that could be known.

    A payment may be loaded before the order that shows whose it is. Ingest remembers
    such orders when they arrive; this job then takes the payment out.
    """
    _remove(wh, cut_lineage(wh.suppressed.rows()), cut_lineage(wh.suppressed_orders.rows().distinct()))


def _remove(wh: Warehouse, people: DataFrame, doomed: DataFrame) -> None:
    """Delete people's rows, and payments of the doomed orders, from the raw tables, the rejects and the clean tables."""
    for name in wh.raw:
        column, values = _whose(name, people, doomed)
        if column:
            wh.raw[name].remove(values, column, new_folder(wh.spark, f"erase-raw-{name}"))
            of = F.try_variant_get("v", f"$.{column}", "string") if name == "events" else None
            wh.rejects[name].remove(values, column, new_folder(wh.spark, f"erase-rejects-{name}"), of)
    users = people.select(F.col("customer_id").alias("user_id"))
    wh.clean_events.remove(users, "user_id", new_folder(wh.spark, "erase-clean-events"))

    snap, folders = wh.clean.snapshot(), {}
    for name in ("customers", "orders", "payments", "returns"):
        values, column = (doomed, "order_id") if name == "payments" else (people, erasure.OWNER[name])
        folders[name] = _without(wh, name, values, column, snap)
    wh.clean.publish(snap, folders, {})


def _whose(name: str, people: DataFrame, doomed: DataFrame) -> tuple[str | None, DataFrame]:
    """The column of a feed that says whose a row is, and the values to look for in it."""
    if name == "payments":
        return "order_id", doomed
    owner = erasure.OWNER.get(name)
    return owner, people.select(F.col("customer_id").alias(owner)) if owner else people


def _without(wh: Warehouse, name: str, values: DataFrame, column: str, snap) -> dict[str, str]:
    """New listing of a clean table with the partitions rewritten that hold listed values."""
    listed = snap.folders.get(name, {})
    part = wh.clean.layouts[name].part
    held = wh.clean.read_stored(name, snap).join(values, column, "left_semi")
    touched = {r[0] for r in held.select(F.lit("all") if part is None else part).distinct().collect()}
    if not touched:
        return listed
    kept = without(wh.clean.read_stored(name, snap, touched), column, values, column)
    columns = [*wh.clean.schemas[name].fieldNames(), BATCH]
    survivors = wh.clean.write(name, kept.select(columns), snap.next)
    return {**{p: f for p, f in listed.items() if p not in touched}, **survivors}
