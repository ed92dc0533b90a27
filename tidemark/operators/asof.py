"""Point-in-time lookup of the dimension version in force."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.joins import spread_nulls

#: Versions of one customer from which on a fact is no longer compared with each of them.
LONG_HISTORY = 256


def lookup_for(dim: DataFrame):
    """The lookup that suits the dimension: merged once a customer has very many versions. Runs a job."""
    long = dim.groupBy("customer_id").count().filter(F.col("count") > LONG_HISTORY)
    return as_of_customer if long.isEmpty() else as_of_merged


def as_of_customer(facts: DataFrame, dim: DataFrame, person: str, at: str) -> DataFrame:
    """Add ``customer_sk``: the customer's version with ``valid_from <= at < valid_to``, else null.

    The person is the join key and the interval its residual condition, so the
    facts are shuffled once, or not at all when the dimension is small enough to be
    broadcast. The join is left outer with the facts on the left, so adaptive
    execution can split a person with very many facts. Facts without a person, who
    may be a large share of the clickstream, are spread over the tasks.
    """
    versions = dim.select(
        F.col("customer_id").alias("_person"),
        F.col("valid_from").alias("_from"),
        F.col("valid_to").alias("_to"),
        "customer_sk",
    )
    in_force = (
        (F.col("_probe") == F.col("_person")) & (F.col(at) >= F.col("_from")) & (F.col(at) < F.col("_to"))
    )
    probe = facts.withColumn("_probe", spread_nulls(person, [at]))
    return probe.join(versions, in_force, "left").drop("_probe", "_person", "_from", "_to")


def as_of_merged(facts: DataFrame, dim: DataFrame, person: str, at: str) -> DataFrame:
    """:func:`as_of_customer` for long histories, in time linear in facts and versions.

    Facts and versions are merged into one stream per person and month, in order of time, and each fact takes the last
    version that began before it, if that has not ended: a person with very many versions and facts costs one sort, where
    a join would compare each fact with all versions. What was in force when a month began is carried over from the months
    before, by one row per person and month. So the facts are shuffled once, a person who holds a large share of them is
    spread over the months, and facts without a person are spread over all tasks.

    Each fact gives one row. Of versions that overlap, which a sound dimension does not have, the one that began last
    counts. A version that ends before or when it begins is never in force.
    """
    columns = facts.columns
    version = F.struct("valid_from", "valid_to", "customer_sk")
    versions = dim.filter("valid_from < valid_to and customer_id is not null").select(
        F.col("customer_id").alias("_who"), F.col("valid_from").alias("_at"), version.alias("_version"),
    )
    stream = facts.select(
        spread_nulls(person, [at]).alias("_who"), F.col(at).alias("_at"), F.struct(*columns).alias("_fact")
    ).unionByName(versions, allowMissingColumns=True)
    stream = stream.withColumn("_month", F.trunc("_at", "month"))
    place = ["_who", "_month"]
    # At one instant versions come before facts; of several the one that lasts longest comes last.
    order = [F.col("_at"), F.col("_fact").isNotNull(), F.col("_version.valid_to"), F.col("_version.customer_sk")]
    upto = Window.partitionBy(*place).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    near = stream.withColumn("_near", F.last("_version", ignorenulls=True).over(upto)).filter("_fact is not null")
    before = Window.partitionBy("_who").orderBy("_month").rowsBetween(Window.unboundedPreceding, -1)
    months = stream.groupBy(*place).agg(F.max("_version").alias("_newest"))
    carried = months.select(*place, F.last("_newest", ignorenulls=True).over(before).alias("_carried"))
    found = near.join(carried.filter("_carried is not null"), place, "left")
    last = F.coalesce("_near", "_carried")
    in_force = (F.col("_at") >= last["valid_from"]) & (F.col("_at") < last["valid_to"])
    return found.select("_fact.*", F.when(in_force, last["customer_sk"]).alias("customer_sk"))
