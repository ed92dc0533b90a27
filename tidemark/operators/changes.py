"""Change images: what turned one state of a table into another."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The actions of change rows. A row's new version is an insert or an update.
INSERT, UPDATE, UPDATE_BEFORE, DELETE = "INSERT", "UPDATE", "UPDATE_BEFORE", "DELETE"


def change_images(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``after``'s columns and ``_action``: what was added, changed or taken away since ``before``.

    ``keys`` identify the rows of either state; a row without one has no identity and is left out. A changed row gives
    its old and its new image, an unchanged one gives nothing. The two states meet once, by key, and rows are compared
    whole, nulls being equal to each other; columns that have no order, such as variants, are compared by their text.
    """
    columns = after.columns
    known = " and ".join(f"`{k}` is not null" for k in keys)
    old = before.filter(known).select(*keys, F.struct(*columns).alias("_old"))
    new = after.filter(known).select(*keys, F.struct(*columns).alias("_new"))
    same = F.lit(True)
    for name, kind in after.dtypes:
        a, b = F.col(f"_old.`{name}`"), F.col(f"_new.`{name}`")
        same = same & (F.to_json(a).eqNullSafe(F.to_json(b)) if kind == "variant" else a.eqNullSafe(b))
    image = lambda row, action: F.struct(F.col(row).alias("row"), F.lit(action).alias("action"))
    images = (
        F.when(F.col("_old").isNull(), F.array(image("_new", INSERT)))
        .when(F.col("_new").isNull(), F.array(image("_old", DELETE)))
        .when(~same, F.array(image("_old", UPDATE_BEFORE), image("_new", UPDATE)))
    )
    met = old.join(new, list(keys), "full_outer")
    return met.select(F.explode(images).alias("i")).select("i.row.*", F.col("i.action").alias("_action"))
