"""Keyed loads into a raw table (K1-K4).

``upsert`` is one full outer join on the natural key: both sides are unique on
the key (the table by construction, the batch by validation or by the check
below), so every key meets at most one row per side and no key can skew a
task. Presence of a side is tested with a literal marker column, never by
testing data columns for null, so a batch null overwrites an old value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caremarts.warehouse import SLOT, DuplicateKeyError, Warehouse

INGESTED_AT = "ingested_at"
MODES = ("upsert", "replace")


def assert_unique(batch: DataFrame, key: str) -> None:
    """Refuse a batch holding a key twice (the database refuses it too).

    A partially aggregated count on the key column alone; stops at the first
    duplicate found.
    """
    dup = (
        batch.select(key)
        .groupBy(key)
        .count()
        .filter(F.col("count") > 1)
        .limit(1)
        .collect()
    )
    if dup:
        raise DuplicateKeyError(f"batch holds key {dup[0][0]!r} of {key} more than once")


def assert_known_columns(existing: DataFrame, batch: DataFrame) -> None:
    unknown = [c for c in batch.columns if c not in existing.columns]
    if unknown:
        raise ValueError(f"batch columns not in the table: {', '.join(unknown)}")


def upsert(
    existing: DataFrame | None,
    batch: DataFrame,
    key: str,
    *,
    preserve: tuple[str, ...] = (INGESTED_AT,),
    check_unique: bool = True,
) -> DataFrame:
    """Insert new keys; on a known key overwrite every non-key column of the
    batch except ``preserve``; keys absent from the batch stay (K1, K2).

    Columns of the table that the batch lacks keep their old value on update
    and are null on insert. A batch column unknown to the table is an error.
    With no updatable column a known key is left untouched (K2).
    """
    if check_unique:
        assert_unique(batch, key)
    if existing is None:
        return batch
    assert_known_columns(existing, batch)
    old = existing.select(
        *[F.col(f"`{c}`").alias(f"__o_{c}") for c in existing.columns],
        F.lit(True).alias("__o_present"),
    )
    new = batch.select(
        *[F.col(f"`{c}`").alias(f"__n_{c}") for c in batch.columns],
        F.lit(True).alias("__n_present"),
    )
    j = old.join(new, F.col(f"__o_{key}") == F.col(f"__n_{key}"), "full_outer")
    o_here = F.col("__o_present").isNotNull()
    n_here = F.col("__n_present").isNotNull()

    out = []
    for c in existing.columns:
        o, n = F.col(f"__o_{c}"), (F.col(f"__n_{c}") if c in batch.columns else None)
        if c == key:
            expr = F.coalesce(o, n)
        elif n is None:
            expr = o
        elif c in preserve:
            expr = F.when(o_here, o).otherwise(n)
        else:
            expr = F.when(n_here, n).otherwise(o)
        out.append(expr.alias(c))
    return j.select(*out)


def replace_load(batch: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """K4: the table holds exactly the batch afterwards (shaped like the table).

    A batch column unknown to the table is an error, as in ``upsert``.
    """
    if existing is None:
        return batch
    assert_known_columns(existing, batch)
    return batch.select(
        *[
            F.col(f"`{c}`") if c in batch.columns else F.lit(None).cast(t).alias(c)
            for c, t in existing.dtypes
        ]
    )


def load(
    existing: DataFrame | None,
    batch: DataFrame,
    key: str,
    mode: str = "upsert",
    **kw,
) -> DataFrame:
    """Dispatch on the load mode; an unknown mode is a ``ValueError``."""
    if mode == "upsert":
        return upsert(existing, batch, key, **kw)
    if mode == "replace":
        return replace_load(batch, existing)
    raise ValueError(f"Unknown load mode: {mode!r} (use 'upsert' or 'replace')")


#: The fewest slots of a raw table, and the bytes of a slot beyond which the table gets more.
RAW_SLOTS = 16
SLOT_BYTES = 128 << 20


def key_slot(key: str, slots: int = RAW_SLOTS) -> Column:
    """The key's slot by linear hashing: a table of ``slots`` + 1 differs in one slot, which is divided.

    The hash modulo the next power of two; where the table has no such slot yet,
    modulo the one before.
    """
    top = 1 << max(0, (slots - 1).bit_length())
    h = F.xxhash64(F.col(f"`{key}`"))
    high, low = F.pmod(h, F.lit(top)), F.pmod(h, F.lit(max(1, top // 2)))
    return F.when(high < slots, high).otherwise(low).cast("string")


def divided(old: int, new: int) -> set[str]:
    """The slots of a table of ``old`` slots that lose keys to others when it gets ``new``."""
    out = set()
    for slot in range(old, new):
        while slot >= old:
            slot -= 1 << (slot.bit_length() - 1)
        out.add(str(slot))
    return out


def slots_for(size: int, slot_bytes: int, least: int) -> int:
    return max(least, -(-size // slot_bytes))


def estimated_bytes(df: DataFrame) -> int:
    """Spark's estimate of a frame's size; 0 where it has none."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return size if size < 1 << 60 else 0


def changed_rows(batch: DataFrame, existing: DataFrame, key: str, preserve: tuple[str, ...] = (INGESTED_AT,)) -> DataFrame:
    """Rows of the batch that an upsert would insert, or that differ from the table's in a column it overwrites."""
    columns = [c for c in batch.columns if c != key and c not in preserve]
    old = existing.select(F.col(f"`{key}`").alias("__k"), *[F.col(f"`{c}`").alias(f"__o_{c}") for c in columns])
    j = batch.join(old, F.col(f"`{key}`") == F.col("__k"), "left")
    same = F.col("__k").isNotNull()
    for c in columns:
        same = same & F.col(f"`{c}`").eqNullSafe(F.col(f"`__o_{c}`"))
    return j.where(~same).select(*[F.col(f"`{c}`") for c in batch.columns])


def load_table(
    wh: Warehouse,
    table: str,
    batch: DataFrame,
    key: str,
    mode: str = "upsert",
    slots: int = RAW_SLOTS,
    *,
    slot_bytes: int = SLOT_BYTES,
    notes: dict | None = None,
) -> int:
    """Load a batch into a raw table (K1-K4); the version that the table has then.

    An upsert looks which slots hold rows that the batch inserts or changes, and
    reads and rewrites those alone; where there are none, nothing is written or
    committed. The table has as many slots as keep one at about ``slot_bytes``
    (``slots`` at least): as it grows, slots are divided one by one in the same
    commit, so a batch rewrites what it touches at any size. Each slot is one
    full outer join of unique keys. The key is asserted unique before the commit.
    ``batch`` should be a stored frame: its slots are looked at first.
    """
    if mode not in MODES:
        raise ValueError(f"Unknown load mode: {mode!r} (use 'upsert' or 'replace')")
    known = wh.manifest("raw", table)
    size = estimated_bytes(batch)
    if mode == "replace" or known is None:
        existing = wh.read("raw", table)
        rows = batch if existing is None else replace_load(batch, existing)
        n = slots_for(size, slot_bytes, slots)
        return wh.publish("raw", table, rows, key=key, slot=key_slot(key, n), notes={**(notes or {}), "slots": n})
    before = known.notes.get("slots")
    if before is None:  # written by other means, undivided
        new, n = upsert(wh.read("raw", table), batch, key, check_unique=False), slots_for(known.bytes + size, slot_bytes, slots)
        return wh.publish("raw", table, new, key=key, slot=key_slot(key, n), notes={**(notes or {}), "slots": n})
    slot = key_slot(key, before)
    own = [r[0] for r in batch.select(slot.alias(SLOT)).distinct().collect()]  # at most ``before``
    assert_known_columns(wh.read("raw", table, slots=[]), batch)
    changed = changed_rows(batch, wh.read("raw", table, slots=own), key)
    touched = {r[0] for r in changed.select(slot.alias(SLOT)).distinct().collect()}
    if not touched:
        return known.version
    after = slots_for(known.bytes + size, slot_bytes, before)
    touched |= divided(before, after)
    old = wh.read("raw", table, slots=sorted(touched))
    rows = batch if len(touched) >= before else batch.where(slot.isin(sorted(touched)))
    new = upsert(old, rows, key, check_unique=False)  # the commit asserts it
    return wh.rewrite(
        "raw", table, new, slot=key_slot(key, after), replaced=sorted(touched), key=key, notes={**(notes or {}), "slots": after}
    )
