"""What a role may see of the customer dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.masks import mask_email, mask_name, mask_phone

# Roles that see unmasked columns, roles that see all rows, and the region tags.
UNMASKED_ROLES = frozenset({"admin", "transform", "ingest", "sysadmin"})
ALL_ROWS_ROLES = frozenset({"admin", "transform", "sysadmin"})
ALL_REGIONS = "ALL"
REGION_TAGS = ("US_WEST", "US_EAST", "EU_WEST", ALL_REGIONS)

MASKED_COLUMNS = {"email": mask_email, "phone": mask_phone, "first_name": mask_name, "last_name": mask_name}


def masked_view(df: DataFrame, role: str) -> DataFrame:
    """``df`` as ``role`` may read it. The choice is made in the plan, not per row."""
    if role in UNMASKED_ROLES:
        return df
    return df.select(*[MASKED_COLUMNS[c](F.col(c)).alias(c) if c in MASKED_COLUMNS else F.col(c) for c in df.columns])


def region_view(df: DataFrame, role: str, tag: str | None = None, tags: tuple[str, ...] = REGION_TAGS) -> DataFrame:
    """Rows of the region a role is tagged with; untagged roles and ``ALL`` see every row."""
    if tag is not None and tag not in tags:
        raise ValueError(f"region tag {tag!r} is not one of {', '.join(tags)}")
    if role in ALL_ROWS_ROLES or tag in (None, ALL_REGIONS):
        return df
    return df.filter(F.col("region") == tag)
