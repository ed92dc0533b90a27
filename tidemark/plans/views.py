"""What consumers read: reports and checked or masked tables over a warehouse, as DataFrames and as temporary views."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame

from tidemark.operators import governance, quality, recon, sessions
from tidemark.plans.warehouse import Warehouse


def revenue_reconciliation(wh: Warehouse, as_of: date) -> DataFrame:
    """Every order with what was paid and returned, and its status."""
    snap = wh.served.snapshot()
    orders, payments, returns = (wh.served.read(f"fact_{n}", snap) for n in ("orders", "payments", "returns"))
    return recon.reconcile(orders, payments, returns, as_of)


def recon_summary(wh: Warehouse, as_of: date) -> DataFrame:
    return recon.summarise(revenue_reconciliation(wh, as_of))


def conversion_funnel(wh: Warehouse, sourced_only: bool = False) -> DataFrame:
    return sessions.conversion_funnel(sessions.session_steps(wh.fact_events.rows(), sourced_only))


def session_kpis(wh: Warehouse) -> DataFrame:
    return sessions.session_kpis(wh.fact_sessions())


def customers_for(wh: Warehouse, role: str, tag: str | None = None) -> DataFrame:
    """The customer dimension as a role may read it: columns masked, rows of its region."""
    return governance.region_view(governance.masked_view(wh.served.read("dim_customer"), role), role, tag)


def check_views(wh: Warehouse, clock: Column) -> dict[str, DataFrame]:
    """Views of the check results and the run log."""
    results = wh.check_results.rows()
    return {
        "dq_failures": quality.failures(results),
        "dq_latest_status": quality.latest_status(results),
        "dq_failure_trend": quality.failure_trend(results, clock),
        "dq_summary": quality.summary(results),
        "dq_alert": quality.alert(results, clock),
        "recent_runs": quality.recent_runs(wh.run_log.rows(), clock),
    }


def create_views(wh: Warehouse, as_of: date, clock: Column, role: str, tag: str | None = None) -> list[str]:
    """Register what ``role`` may query in SQL as temporary views of the session; returns their names.

    Views show the publication that is current now.
    """
    snap = wh.served.snapshot()
    views = {name: wh.served.read(name, snap) for name in wh.served.schemas if name.startswith(("fact_", "daily_", "dim_product"))}
    views |= {
        "fact_events": wh.fact_events.rows(),
        "fact_sessions": wh.fact_sessions(),
        "dim_customer": customers_for(wh, role, tag),
        "revenue_reconciliation": revenue_reconciliation(wh, as_of),
        "recon_summary": recon_summary(wh, as_of),
        "conversion_funnel": conversion_funnel(wh),
        "session_kpis": session_kpis(wh),
        **check_views(wh, clock),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return sorted(views)
