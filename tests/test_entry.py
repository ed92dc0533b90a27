"""The entry points the check tool calls."""

import __spark_entry__ as entry_points


def test_entry_yields_every_order(spark):
    result = entry_points.entry(spark)
    assert result.columns[0] == "order_id" and "recon_status" in result.columns
    assert result.count() == spark.read.parquet("/root/testdata/sf0.001/orders.parquet").count()
    assert {r.recon_status for r in result.select("recon_status").distinct().collect()} == {
        "NO_PAYMENT", "FULLY_PAID", "PAID_WITH_RETURN", "PARTIAL_PENDING", "UNDERPAID", "OVERPAID",
    }


def test_names_agree():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())
