"""Type-2 history of tracked columns, check strategy (H4-H6).

``scd2_apply`` compares the open versions with the current source in one
full outer join on the key (one shuffle; both sides hold at most one row per
key, so no key can be hot) and emits, per key, zero to two output versions
from the joined row itself: no second join, no window.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caremarts.plans.staging import fraud_flag
from caremarts.warehouse import Warehouse

VALID_FROM = "valid_from"
VALID_TO = "valid_to"
CHANGED = "changed"
OPEN_SLOT, CLOSED_SLOT = "open", "closed"


def _null_safe_equal(cols: list[str]) -> Column:
    eq: Column = F.lit(True)
    for c in cols:
        eq = eq & F.col(f"__o_{c}").eqNullSafe(F.col(f"__c_{c}"))
    return eq


def scd2_apply(
    history: DataFrame | None,
    current: DataFrame,
    key: str,
    check_cols: list[str],
    ts: dt.datetime,
    *,
    invalidate_hard_deletes: bool = True,
) -> DataFrame:
    """New history after taking a snapshot of ``current`` at ``ts``.

    The closed versions of before and what ``scd2_changes`` makes of the rest.
    """
    emitted = scd2_changes(history, current, key, check_cols, ts, invalidate_hard_deletes=invalidate_hard_deletes)
    if history is None:
        return emitted.drop(CHANGED)
    return history.where(F.col(VALID_TO).isNotNull()).select(*emitted.drop(CHANGED).columns).unionByName(emitted.drop(CHANGED))


def scd2_changes(
    open_versions: DataFrame | None,
    current: DataFrame,
    key: str,
    check_cols: list[str],
    ts: dt.datetime,
    *,
    invalidate_hard_deletes: bool = True,
) -> DataFrame:
    """What a snapshot of ``current`` at ``ts`` makes of the open versions.

    Open versions after it, and the versions it closes; ``changed`` tells the
    versions it opened or closed from those it left alone. Closed rows of
    ``open_versions`` are ignored: they never change again.


    * unchanged (null-safe equal on ``check_cols``): open version kept as is;
    * changed: open version closed at ``ts`` and a new version opened at ``ts``;
    * new or reappearing key: a version opened at ``ts``;
    * key gone from ``current``: its open version closed at ``ts`` when
      ``invalidate_hard_deletes``, else kept open.

    A changed or deleted key whose open version starts at or after ``ts`` fails
    the job (two versions would share an instant and escape overlap checks). A
    key that ``current`` holds more than once fails it too.
    """
    ts_col = F.lit(ts).cast("timestamp")
    tracked = [key, *check_cols]
    twice = F.concat(F.lit("scd2: the source holds a key more than once: "), F.col(key).cast("string"))
    rest = [c for c in tracked if c != key]
    cur = (
        current.select(*tracked)
        .groupBy(key)
        .agg(F.count("*").alias("__n"), *[F.first(c).alias(c) for c in rest])
        .select(
            F.when(F.col("__n") == 1, F.col(key)).otherwise(F.raise_error(twice).cast(current.schema[key].dataType)).alias(f"__c_{key}"),
            *[F.col(c).alias(f"__c_{c}") for c in rest],
            F.lit(True).alias("__c_present"),
        )
    )
    if open_versions is None:
        return cur.select(
            *[F.col(f"__c_{c}").alias(c) for c in tracked],
            ts_col.alias(VALID_FROM),
            F.lit(None).cast("timestamp").alias(VALID_TO),
            F.lit(True).alias(CHANGED),
        )

    open_v = open_versions.filter(F.col(VALID_TO).isNull())
    old = open_v.select(
        *[F.col(c).alias(f"__o_{c}") for c in tracked],
        F.col(VALID_FROM).alias("__o_from"),
        F.lit(True).alias("__o_present"),
    )
    j = old.join(cur, F.col(f"__o_{key}") == F.col(f"__c_{key}"), "full_outer")

    o_here = F.col("__o_present").isNotNull()
    c_here = F.col("__c_present").isNotNull()
    same = _null_safe_equal(check_cols)
    changed = o_here & c_here & ~same
    deleted = o_here & ~c_here
    closes = changed | (deleted & F.lit(invalidate_hard_deletes))
    opens = c_here & (~o_here | changed)

    guard = F.when(
        closes & (F.col("__o_from") >= ts_col),
        F.raise_error(F.lit(f"scd2_apply: snapshot time {ts} is not after an open version")),
    )

    def version(prefix: str, start: Column, end: Column, moved: Column) -> Column:
        return F.struct(
            *[F.col(f"{prefix}{c}").alias(c) for c in tracked],
            start.alias(VALID_FROM),
            end.alias(VALID_TO),
            moved.alias(CHANGED),
        )

    null_ts = F.lit(None).cast("timestamp")
    old_version = F.when(
        o_here,
        version("__o_", F.col("__o_from"), F.when(closes, F.coalesce(guard.cast("timestamp"), ts_col)).otherwise(null_ts), closes),
    )
    new_version = F.when(opens, version("__c_", ts_col, null_ts, F.lit(True)))
    emitted = j.select(F.explode(F.array_compact(F.array(old_version, new_version))).alias("v"))
    return emitted.select("v.*")


def provider_snapshot_source(raw_providers: DataFrame) -> DataFrame:
    """What the provider snapshot tracks: the label as a three-valued boolean."""
    return raw_providers.select(
        F.col("Provider").alias("provider_id"),
        fraud_flag(F.col("PotentialFraud")).alias("is_potential_fraud"),
    )


def snapshot_providers(
    history: DataFrame | None, raw_providers: DataFrame, ts: dt.datetime
) -> DataFrame:
    """One run of the provider fraud-label snapshot (reads raw providers directly)."""
    return scd2_apply(
        history,
        provider_snapshot_source(raw_providers),
        "provider_id",
        ["is_potential_fraud"],
        ts,
        invalidate_hard_deletes=True,
    )


def snapshot_table(
    wh: Warehouse, table: str, raw_providers: DataFrame, ts: dt.datetime, run: str, notes: dict | None = None
) -> int | None:
    """Take a provider snapshot in the warehouse and commit it.

    Closed versions are only ever appended; the part of open versions is
    rewritten, and nothing is written at all when no label changed.
    """
    history = wh.read("snapshots", table, slots=[OPEN_SLOT])
    delta = scd2_changes(history, provider_snapshot_source(raw_providers), "provider_id", ["is_potential_fraud"], ts)
    delta = wh.stage(run, table, delta)
    if history is not None and delta.where(CHANGED).isEmpty():
        return None
    slot = F.when(F.col(VALID_TO).isNull(), OPEN_SLOT).otherwise(CLOSED_SLOT)
    return wh.rewrite("snapshots", table, delta.drop(CHANGED), slot=slot, replaced=[OPEN_SLOT], notes=notes)


def snapshot_first(raw_providers: DataFrame, ts: dt.datetime) -> DataFrame:
    return snapshot_providers(None, raw_providers, ts)
