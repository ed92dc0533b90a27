"""Masks for personal data. Null stays null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The filler text of each mask.
EMAIL_FILL = "***@***."
PHONE_FILL = "***-**"
NAME_FILL = "***"


def mask_email(c: Column) -> Column:
    """First character, filler, and the text after the last dot of the domain.

    An address without a dot after its ``@`` has no suffix that may be shown, so
    it ends in filler instead.
    """
    domain = F.substring_index(c, "@", -1)
    suffix = F.when(domain.contains("."), F.substring_index(domain, ".", -1)).otherwise(F.lit("***"))
    return F.concat(F.left(c, F.lit(1)), F.lit(EMAIL_FILL), suffix)


def mask_phone(c: Column) -> Column:
    return F.concat(F.lit(PHONE_FILL), F.right(c, F.lit(2)))


def mask_name(c: Column) -> Column:
    return F.concat(F.left(c, F.lit(1)), F.lit(NAME_FILL))
