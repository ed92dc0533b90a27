"""Masks, row filters, suppression with nulls, and erasure."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.functions.masks import mask_email, mask_name, mask_phone
from tidemark.functions.time import timestamp
from tidemark.operators import erasure, governance, suppression
from tidemark.schemas import DIM_CUSTOMER

T0 = datetime(2026, 1, 1)
def run_ts():
    return timestamp("2026-05-01 00:00:00")



def dim(spark):
    people = [(1, "a", "Ann", "Bee", "ann@mail.co.uk", "12345", "US_WEST"), (2, "b", None, "", "bob@localhost", None, "EU_WEST")]
    return spark.createDataFrame([(*p, T0, T0, True, "h", "s", T0) for p in people], DIM_CUSTOMER)


def test_masks(spark):
    seen = governance.masked_view(dim(spark), "analyst").orderBy("customer_sk").collect()
    assert tuple(seen[0])[2:6] == ("A***", "B***", "a***@***.uk", "***-**45")
    assert tuple(seen[1])[2:6] == (None, "***", "b***@***.***", None), "a domain without a dot is not shown"
    one = spark.range(1).select(mask_email(F.lit("j@x.com")), mask_name(F.lit("Jo")), mask_phone(F.lit("7")))
    assert tuple(one.first()) == ("j***@***.com", "J***", "***-**7")


@pytest.mark.parametrize("role", ["admin", "transform", "ingest", "sysadmin"])
def test_engineers_see_everything(spark, role):
    assert governance.masked_view(dim(spark), role).collect() == dim(spark).collect()


def test_region_filter(spark):
    ids = lambda *a: {r.customer_id for r in governance.region_view(dim(spark), *a).collect()}
    assert ids("analyst", "US_WEST") == {"a"}
    assert ids("ingest", "US_WEST") == {"a"}, "the ingest role is filtered"
    assert ids("analyst", "ALL") == ids("analyst") == ids("admin", "US_EAST") == {"a", "b"}
    with pytest.raises(ValueError):
        governance.region_view(dim(spark), "analyst", "MARS")


def test_not_in_treats_null_as_sql_does(spark):
    df = spark.createDataFrame([("x",), ("y",), (None,)], "k string")
    for listed in ([("x",)], []):
        blocked = spark.createDataFrame(listed, "id string")
        df.createOrReplaceTempView("probe")
        blocked.createOrReplaceTempView("blocked")
        sql = spark.sql("SELECT k FROM probe WHERE k NOT IN (SELECT id FROM blocked)")
        ours = suppression.not_in(df, "k", blocked, "id")
        assert sorted(map(str, ours.collect())) == sorted(map(str, sql.collect()))


def layer(spark):
    return {
        "customers": spark.createDataFrame([("a",), ("b",)], "customer_id string"),
        "orders": spark.createDataFrame([("o1", "a"), ("o2", "b"), ("o3", None)], "order_id string, customer_id string"),
        "payments": spark.createDataFrame([("p1", "o1"), ("p2", "o2"), ("p3", None)], "payment_id string, order_id string"),
        "returns": spark.createDataFrame([("r1", "o1", "a")], "return_id string, order_id string, customer_id string"),
        "events": spark.createDataFrame([("e1", "a"), ("e2", None)], "event_id string, user_id string"),
        "products": spark.createDataFrame([("g",)], "product_id string"),
    }


def test_purge_resolves_orders_before_they_go(spark):
    people = spark.createDataFrame([("a",)], "customer_id string")
    nothing = spark.createDataFrame([], "order_id string")
    kept = suppression.purge_feeds(layer(spark), people, nothing)
    assert {n: df.count() for n, df in kept.items()} == {
        "customers": 1, "orders": 2, "payments": 2, "returns": 0, "events": 1, "products": 1,
    }
    only_payments = suppression.purge_feeds(
        {"payments": layer(spark)["payments"]}, people, spark.createDataFrame([("o1",)], "order_id string")
    )
    assert only_payments["payments"].count() == 2, "remembered order ids still match"


def test_erase_counts_what_it_removes(spark):
    people = erasure.requests(spark.createDataFrame([("a",), ("a",), (" ",), (None,)], "customer_id string"))
    assert people.count() == 1
    tables = layer(spark)
    counted = {r.feed: r.rows for r in erasure.erased_counts(tables, people).collect()}
    kept = erasure.erase(tables, people)
    for feed, n in counted.items():
        assert tables[feed].count() - kept[feed].count() == n, feed
    assert counted == {"customers": 1, "orders": 1, "payments": 1, "returns": 1, "events": 1}


def test_anonymise_keeps_keys_and_region(spark):
    people = spark.createDataFrame([("a",)], "customer_id string")
    row = erasure.anonymise(dim(spark), people, run_ts()).filter("customer_id = 'a'").first()
    assert (row.customer_sk, row.first_name, row.phone, row.region, row.valid_from) == (1, "REDACTED", "REDACTED", "US_WEST", T0)
    assert row.hash_diff == spark.range(1).select(F.sha2(F.lit("REDACTED"), 256)).first()[0]


def test_second_request_suppresses_nothing_new(spark):
    people = spark.createDataFrame([("a",)], "customer_id string")
    first = erasure.suppression_rows(spark.createDataFrame([], "customer_id string"), people, "me", run_ts())
    assert first.count() == 1
    assert erasure.suppression_rows(first, people, "me", run_ts()).isEmpty()
    audit = erasure.audit_rows(layer(spark), layer(spark), dim(spark), first, people, "me", run_ts())
    assert audit.count() == 13
    assert audit.filter("action = 'SUPPRESS'").first().rows_affected == 0
    assert len({r.request_id for r in audit.collect()}) == 1
