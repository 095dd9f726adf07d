"""Upsert, incremental facts and SCD2 history: the stateful properties."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from caremarts.operators.incremental import incremental_append
from caremarts.operators.scd2 import scd2_apply
from caremarts.operators.upsert import DuplicateKeyError, load, upsert

T1, T2, T3 = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1), dt.datetime(2024, 3, 1)


def batch(spark, rows, ts):
    return spark.createDataFrame(rows, "id string, val string").withColumn(
        "ingested_at", F.lit(ts).cast("timestamp")
    )


def as_dict(df):
    return {r["id"]: r.asDict() for r in df.collect()}


def test_upsert_twice_is_once_and_keeps_first_seen(spark):
    b = [("a", "1"), ("b", "2")]
    once = upsert(None, batch(spark, b, T1), "id")
    twice = upsert(once, batch(spark, b, T2), "id")
    assert as_dict(twice) == as_dict(once)
    assert all(r["ingested_at"] == T1 for r in as_dict(twice).values())


def test_upsert_updates_values_including_nulls_and_inserts(spark):
    first = upsert(None, batch(spark, [("a", "1"), ("b", "2")], T1), "id")
    out = as_dict(upsert(first, batch(spark, [("a", None), ("c", "3")], T2), "id"))
    assert out["a"]["val"] is None and out["a"]["ingested_at"] == T1
    assert out["b"]["val"] == "2"  # absent keys stay
    assert out["c"]["ingested_at"] == T2


def test_upsert_refuses_duplicate_batch_keys(spark):
    with pytest.raises(DuplicateKeyError):
        upsert(None, batch(spark, [("a", "1"), ("a", "2")], T1), "id")


def test_replace_and_unknown_mode(spark):
    full = batch(spark, [("a", "1"), ("b", "2")], T1)
    out = load(full, batch(spark, [("c", "3")], T2), "id", mode="replace")
    assert set(as_dict(out)) == {"c"}
    with pytest.raises(ValueError, match="Unknown load mode"):
        load(full, full, "id", mode="merge")


def test_key_only_table_upsert_leaves_rows(spark):
    t = spark.createDataFrame([("a",)], "id string")
    out = upsert(t, spark.createDataFrame([("a",), ("b",)], "id string"), "id")
    assert sorted(r["id"] for r in out.collect()) == ["a", "b"]


def test_incremental_a_then_b_equals_full_and_rerun_is_noop(spark):
    src = spark.createDataFrame([(i, i * 10) for i in range(10)], "k int, v int")
    part_a = src.filter("k < 5")
    _, t_a = incremental_append(part_a, None, "k")
    new_b, t_b = incremental_append(src, t_a, "k")
    assert new_b.count() == 5 and sorted(t_b.collect()) == sorted(src.collect())
    new_c, t_c = incremental_append(src, t_b, "k")
    assert new_c.count() == 0 and t_c.count() == 10


def test_incremental_skip_keeps_stale_rows_replace_refreshes(spark):
    old = spark.createDataFrame([(1, 0)], "k int, v int")
    src = spark.createDataFrame([(1, 5), (2, 6)], "k int, v int")
    _, skipped = incremental_append(src, old, "k")
    _, replaced = incremental_append(src, old, "k", on_match="replace")
    assert dict(skipped.collect()) == {1: 0, 2: 6}
    assert dict(replaced.collect()) == {1: 5, 2: 6}


def labels(spark, rows):
    return spark.createDataFrame(rows, "provider_id string, is_potential_fraud boolean")


def scd(h, cur, ts):
    return scd2_apply(h, cur, "provider_id", ["is_potential_fraud"], ts)


def test_scd2_null_to_yes_opens_version_and_replay_is_noop(spark):
    h1 = scd(None, labels(spark, [("P1", None), ("P2", False)]), T1)
    h2 = scd(h1, labels(spark, [("P1", True), ("P2", False)]), T2)
    rows = sorted(h2.collect(), key=lambda r: (r["provider_id"], r["valid_from"]))
    assert [(r["provider_id"], r["is_potential_fraud"], r["valid_to"]) for r in rows] == [
        ("P1", None, T2),
        ("P1", True, None),
        ("P2", False, None),
    ]
    h3 = scd(h2, labels(spark, [("P1", True), ("P2", False)]), T3)
    assert sorted(h3.collect(), key=str) == sorted(h2.collect(), key=str)


def test_scd2_delete_then_reappear(spark):
    h1 = scd(None, labels(spark, [("P1", False), ("P2", True)]), T1)
    h2 = scd(h1, labels(spark, [("P1", False)]), T2)
    closed = {r["provider_id"]: r["valid_to"] for r in h2.collect()}
    assert closed["P2"] == T2 and closed["P1"] is None
    h3 = scd(h2, labels(spark, [("P1", False), ("P2", True)]), T3)
    p2 = sorted((r["valid_from"], r["valid_to"]) for r in h3.collect() if r["provider_id"] == "P2")
    assert p2 == [(T1, T2), (T3, None)]


def test_scd2_refuses_same_instant_change(spark):
    h1 = scd(None, labels(spark, [("P1", False)]), T1)
    with pytest.raises(Exception, match="not after an open version"):
        scd(h1, labels(spark, [("P1", True)]), T1).collect()
