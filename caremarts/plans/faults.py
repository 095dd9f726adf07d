"""Models with known faults, so that a check has something to find.

Each fault is put on the rows of one hash bucket of the key (one row in seven),
so a check must report those rows and no others. Nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caremarts.functions.columns import hash_bucket

BUCKETS = 7


def hit(key: str, bucket: int = 0) -> Column:
    return hash_bucket(F.col(key).cast("string"), BUCKETS) == bucket


def repeated(df: DataFrame, key: str) -> DataFrame:
    """The rows of the bucket a second time."""
    return df.unionByName(df.where(hit(key)))


def changed(df: DataFrame, key: str, column: str, value: Column, bucket: int = 0) -> DataFrame:
    """``column`` replaced by ``value`` (of the same type) in the bucket's rows."""
    kind = df.schema[column].dataType
    return df.withColumn(column, F.when(hit(key, bucket), value.cast(kind)).otherwise(F.col(column)))


def without(df: DataFrame, key: str) -> DataFrame:
    """The bucket's rows gone."""
    return df.where(~hit(key))


def overlapping_history(first: DataFrame, second: DataFrame) -> DataFrame:
    """The first vintage with its versions still open, and the versions the second opened."""
    opened = second.join(first.select("provider_id", "valid_from"), ["provider_id", "valid_from"], "left_anti")
    return first.unionByName(opened.select(*first.columns))


def bad_encounters(prepared: DataFrame) -> DataFrame:
    """Encounters as text with an unknown type, a length of stay that is no number, and ``12.0``."""
    df = prepared.withColumns({c: F.col(c).cast("string") for c in ("admission_type_id", "time_in_hospital")})
    df = changed(df, "encounter_id", "admission_type_id", F.lit("9"), 0)
    df = changed(df, "encounter_id", "time_in_hospital", F.lit("three"), 1)
    return changed(df, "encounter_id", "time_in_hospital", F.lit("12.0"), 2)
