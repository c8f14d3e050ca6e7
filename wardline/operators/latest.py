"""Last write wins: the newest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DELETED = "_deleted"


def latest_per_key(
    changes: DataFrame, keys: Sequence[str], order: Sequence[str], deleted: str | None = None
) -> DataFrame:
    """The row with the highest ``order`` of each key; keys whose last row is deleted vanish.

    An aggregate, not a window: each map task keeps one row per key, so a key written very
    often never gathers its versions in one place. ``order`` must tell versions of a key apart.
    """
    rest = [c for c in changes.columns if c not in keys]
    newest = changes.groupBy(*keys).agg(
        F.max_by(F.struct(*rest), F.struct(*order)).alias("_row")
    )
    rows = newest.select(*keys, *(F.col(f"_row.{c}").alias(c) for c in rest))
    if deleted is not None:
        rows = rows.filter(~F.coalesce(F.col(deleted), F.lit(False))).drop(deleted)
    return rows.select(*(c for c in changes.columns if c != deleted))


def apply_cdc(changes: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The current table from change events ``op, before, after`` and the order columns.

    ``op`` is ``r`` (first snapshot), ``c``, ``u`` or ``d``; the key of a delete comes from
    ``before``, that of anything else from ``after``.
    """
    fields = changes.schema["after"].dataType.names
    return latest_per_key(cdc_rows(changes, order), keys, order, DELETED).select(*fields)


def cdc_rows(changes: DataFrame, order: Sequence[str]) -> DataFrame:
    """Change events as rows with ``_deleted`` and the order columns, one by one; works on streams."""
    fields = changes.schema["after"].dataType.names
    gone = F.col("op") == "d"
    return changes.select(
        *(
            F.when(gone, F.col(f"before.{c}")).otherwise(F.col(f"after.{c}")).alias(c)
            for c in fields
        ),
        gone.alias(DELETED),
        *order,
    )
