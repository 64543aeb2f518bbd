"""Identity of an element: its case-insensitive key, and ids made from that key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Separates the parts of an id seed; it does not occur at the ends of a cleaned cell.
UNIT = "\x1f"


def with_keys(df: DataFrame) -> DataFrame:
    """Add ``k_project``, ``k_name`` and ``k_type``; two elements are the same when all three agree.

    A table that stores these columns (for example one that is bucketed by them) is taken as it is.
    """
    keys = {"k_project": "lower(PROJECT_ID)", "k_name": "upper(NAME)", "k_type": "upper(TYPE)"}
    return df.selectExpr("*", *(f"{value} as {key}" for key, value in keys.items() if key not in df.columns))


def uuid_from(*parts: Column | str) -> Column:
    """A UUID-shaped digest of the parts.

    A random id would change when a lost partition is computed again and would cut the links from children that were
    already written.  A digest of the key is the same in every attempt, and a child can name its parent without a join.
    """
    text = F.md5(F.concat_ws(UNIT, *parts))
    # Each step refers to the one before once, so the digest is evaluated once wherever the id is used.
    for place in (9, 14, 19, 24):
        text = F.overlay(text, F.lit("-"), place, 0)
    return text


def element_id(kind: Column | str, project: Column | str, name: Column | str, *occurrence: Column | str) -> Column:
    """Id of a new element.  ``occurrence`` (file, row, column) is given only when equal names stay apart."""
    def c(x: Column | str) -> Column:
        return F.col(x) if isinstance(x, str) else x

    seen_at = [c(o).cast("string") for o in occurrence]
    return uuid_from(F.upper(c(kind)), F.lower(c(project)), F.upper(c(name)), *seen_at)
