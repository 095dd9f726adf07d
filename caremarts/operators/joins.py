"""Join helpers: orphans, point-in-time lookup.

Equi joins themselves are Spark's: AQE picks broadcast-hash or sort-merge from
the sides' real sizes and splits skewed partitions. Nothing here hints at or
measures a side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows whose non-null key has no parent (J6): a left anti join.

    Anti joins plan as sort-merge (or broadcast when AQE sees a small parent);
    never ``NOT IN``, which plans a null-aware broadcast of the parent.
    """
    parents = parent.select(F.col(parent_key).alias("__parent_key")).filter(
        F.col("__parent_key").isNotNull()
    )
    return child.filter(F.col(child_key).isNotNull()).join(
        parents, F.col(child_key) == F.col("__parent_key"), "left_anti"
    )


def as_of(
    facts: DataFrame,
    history: DataFrame,
    key: str,
    time_col: str | Column,
    *,
    valid_from: str = "valid_from",
    valid_to: str = "valid_to",
    history_key: str | None = None,
) -> DataFrame:
    """Point-in-time lookup (J8): each fact gets the version valid at its time.

    Equi join on the key plus the residual ``valid_from <= t < valid_to``
    (open versions have a null ``valid_to``). Versions of one key never
    overlap, so each fact matches at most one version; a left join keeps facts
    without a version. History grows by at most one version per key per run,
    so a key's version list stays short however many facts share the key.
    """
    t = F.col(time_col) if isinstance(time_col, str) else time_col
    hk = history_key or key
    h = history.select(
        F.col(hk).alias("__h_key"),
        *[F.col(c) for c in history.columns if c != hk],
    )
    cond = (
        (F.col(key) == F.col("__h_key"))
        & (F.col(valid_from) <= t)
        & (F.col(valid_to).isNull() | (t < F.col(valid_to)))
    )
    return facts.join(h, cond, "left").drop("__h_key")
