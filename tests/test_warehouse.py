"""Commits that survive a crash at any step, appends, slot rewrites, vacuum."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from caremarts.operators.incremental import incremental_append, sync_columns
from caremarts.operators.scd2 import snapshot_table
from caremarts.operators.upsert import divided, key_slot, load_table, replace_load
from caremarts.plans.flow import update_fact
from caremarts.warehouse import ConcurrentCommit, DuplicateKeyError, SchemaChangeError, Warehouse


@pytest.fixture
def wh(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "wh"))


def part_files(wh, layer, table):
    found = []
    for part in wh._list(f"{wh.path(layer, table)}/parts"):
        fs, p, _ = wh._hadoop(part.getPath().toString())
        it = fs.listFiles(p, True)
        while it.hasNext():
            name = it.next().getPath().toString()
            if name.endswith(".parquet"):
                found.append(name)
    return sorted(found)


class Crash(Exception):
    pass


@pytest.mark.parametrize("step", ["_write_part", "_assert_unique", "_commit"])
@pytest.mark.parametrize("late", [False, True])
def test_crash_while_publishing_leaves_the_old_table_or_the_new(wh, spark, monkeypatch, step, late):
    wh.publish("raw", "t", spark.range(7), key="id")
    real = getattr(Warehouse, step)

    def dies(self, *args, **kw):
        if late:
            real(self, *args, **kw)
        raise Crash

    with monkeypatch.context() as m:
        m.setattr(Warehouse, step, dies)
        with pytest.raises(Crash):
            wh.publish("raw", "t", spark.range(9), key="id")
    committed = step == "_commit" and late
    assert wh.read("raw", "t").count() == (9 if committed else 7)
    # the next writer goes on from there and overwrites nothing
    before = part_files(wh, "raw", "t")
    wh.publish("raw", "t", spark.range(4), key="id")
    assert wh.read("raw", "t").count() == 4
    assert set(before) <= set(part_files(wh, "raw", "t"))


def test_crash_between_temporary_file_and_rename(wh, spark, monkeypatch):
    wh.publish("raw", "t", spark.range(7))
    fs, _, _ = wh._hadoop(wh.root)
    wh._hadoop(f"{wh.path('raw', 't')}/commits/.half.tmp")[0].create(
        wh._hadoop(f"{wh.path('raw', 't')}/commits/.half.tmp")[1], False
    ).close()
    assert wh.read("raw", "t").count() == 7
    wh.publish("raw", "t", spark.range(3))
    assert wh.read("raw", "t").count() == 3


def test_two_writers_of_one_version_do_not_lose_each_other(wh, spark):
    wh.publish("raw", "t", spark.range(2))
    base = wh.manifest("raw", "t")
    wh.append("raw", "t", spark.range(2, 4))
    with pytest.raises(ConcurrentCommit):
        wh._commit("raw", "t", base, base.schema, [])
    assert wh.read("raw", "t").count() == 4


def test_duplicate_key_is_never_committed(wh, spark):
    wh.publish("raw", "t", spark.range(2), key="id")
    with pytest.raises(DuplicateKeyError):
        wh.publish("raw", "t", spark.range(3).union(spark.range(1)), key="id")
    assert wh.read("raw", "t").count() == 2


def fact(wh, src, **kw):
    update_fact(wh, "f", "k", src, lambda d: d, **{"full_refresh": False, "on_match": "skip", **kw})


def test_incremental_fact_appends_only_what_is_new(wh, spark):
    rows = lambda n, v=0: spark.createDataFrame([(i, v) for i in range(n)], "k int, v int")
    fact(wh, rows(5))
    first = part_files(wh, "marts", "f")
    fact(wh, rows(5))  # nothing new: no data file, no version
    assert part_files(wh, "marts", "f") == first and wh.current_version("marts", "f") == 1
    fact(wh, rows(6, 9))
    assert set(first) < set(part_files(wh, "marts", "f")) and len(wh.manifest("marts", "f").parts) == 2
    assert dict(map(tuple, wh.read("marts", "f").collect())) == {0: 0, 1: 0, 2: 0, 3: 0, 4: 0, 5: 9}
    fact(wh, rows(6, 3), on_match="replace")
    assert {r["v"] for r in wh.read("marts", "f").collect()} == {3}


def test_columns_follow_the_new_rows(wh, spark):
    wh.publish("marts", "f", spark.createDataFrame([(1, "old")], "k int, gone string"))
    new = spark.createDataFrame([(2, 5)], "k int, added int")
    target = wh.read("marts", "f")
    synced = sync_columns(target, new)
    assert synced.columns == ["k", "added"] and {tuple(r) for r in synced.collect()} == {(1, None), (2, 5)}
    rows, _ = incremental_append(new, target, "k")
    wh.append("marts", "f", rows)
    got = wh.read("marts", "f")
    assert got.columns == ["k", "added"] and {tuple(r) for r in got.collect()} == {(1, None), (2, 5)}


def values(wh, layer="marts", table="f"):
    return sorted(map(tuple, wh.read(layer, table).collect()), key=str)


def test_a_type_that_changes_is_cast_in_old_parts(wh, spark):
    wh.append("marts", "f", spark.createDataFrame([(1, 5, "1.25"), (2, None, "9.99")], "k int, v int, d string").selectExpr("k", "v", "cast(d as decimal(5,2)) d"))
    wh.append("marts", "f", spark.sql("select 3 as k, 'x7' as v, cast(12345.678 as decimal(12,3)) as d"))
    assert dict(wh.read("marts", "f").dtypes) == {"k": "int", "v": "string", "d": "decimal(12,3)"}
    assert [(k, v, str(d)) for k, v, d in values(wh)] == [(1, "5", "1.250"), (2, None, "9.990"), (3, "x7", "12345.678")]
    wh.append("marts", "f", spark.sql("select 4L as k, 'y' as v, cast(1 as decimal(12,3)) as d"))  # int to bigint
    assert [r[0] for r in values(wh)] == [1, 2, 3, 4] and wh.read("marts", "f").where("k = 4 or v = '5'").count() == 2


def test_a_type_that_old_values_do_not_fit_is_refused_before_the_commit(wh, spark):
    wh.append("marts", "f", spark.createDataFrame([(1, "5"), (2, "x")], "k int, v string"))
    files = part_files(wh, "marts", "f")
    with pytest.raises(SchemaChangeError, match=r"v \(1 values\)"):
        wh.append("marts", "f", spark.createDataFrame([(3, 7)], "k int, v int"))
    with pytest.raises(SchemaChangeError):  # no cast at all
        wh.append("marts", "f", spark.sql("select 3 as k, array('a') as v"))
    assert part_files(wh, "marts", "f") == files and values(wh) == [(1, "5"), (2, "x")]
    wh.publish("marts", "g", spark.createDataFrame([(1, "5")], "k int, v string"))
    wh.append("marts", "g", spark.createDataFrame([(3, 7)], "k int, v int"))  # every value is a number
    assert values(wh, table="g") == [(1, 5), (3, 7)]


def test_a_dropped_column_does_not_come_back(wh, spark):
    wh.append("marts", "f", spark.createDataFrame([(1, 10)], "k int, c int"))
    wh.append("marts", "f", spark.createDataFrame([(2,)], "k int"))
    wh.append("marts", "f", spark.createDataFrame([(3, "new")], "k int, c string"))
    assert values(wh) == [(1, None), (2, None), (3, "new")]
    assert len(wh.manifest("marts", "f").parts) == 3
    none = spark.createDataFrame([], "k int")
    assert wh.append("marts", "f", none) is not None and values(wh) == [(1,), (2,), (3,)]  # a schema alone commits


def test_slots_that_stay_follow_the_schema_too(wh, spark):
    slot = lambda: (F.col("k") % 2).cast("string")
    wh.publish("raw", "t", spark.createDataFrame([(0, 1), (1, 2)], "k int, v int"), slot=slot())
    wh.rewrite("raw", "t", spark.createDataFrame([(0, "a")], "k int, v string"), slot=slot(), replaced=["0"])
    assert values(wh, "raw", "t") == [(0, "a"), (1, "2")]
    old = spark.createDataFrame([(1, 5)], "k int, v int")
    assert [tuple(r) for r in sync_columns(old, spark.createDataFrame([(2, "x")], "k int, v string")).collect()] == [(1, "5"), (2, "x")]


def test_upsert_rewrites_only_the_slots_of_the_batch(wh, spark):
    rows = [(f"k{i}", i) for i in range(200)]
    table = spark.createDataFrame(rows, "id string, val int")
    load_table(wh, "t", table, "id")
    before = wh.manifest("raw", "t").parts
    load_table(wh, "t", spark.createDataFrame([("k3", -1)], "id string, val int"), "id")
    after = wh.manifest("raw", "t").parts
    assert len([p for p in after if p not in before]) == 1 and len([p for p in before if p not in after]) == 1
    got = dict(map(tuple, wh.read("raw", "t").collect()))
    assert got.pop("k3") == -1 and got == {k: v for k, v in rows if k != "k3"}
    load_table(wh, "t", spark.createDataFrame([("k3", -2)], "id string, val int"), "id", slots=5)
    assert dict(map(tuple, wh.read("raw", "t").collect()))["k3"] == -2  # the table keeps its own slots
    assert wh.read("raw", "t").count() == 200
    with pytest.raises(ValueError, match="not in the table"):
        load_table(wh, "t", spark.createDataFrame([("a", 1, 2)], "id string, val int, new int"), "id", "replace")


def test_slots_are_divided_as_the_table_grows(wh, spark):
    rows = lambda a, b: spark.range(a, b).selectExpr("concat('k', id) as id", "md5(cast(id as string)) as val")
    size = lambda p: p["bytes"]
    load_table(wh, "t", rows(0, 1000), "id", slots=2, slot_bytes=30_000)
    for n in range(1000, 20_000, 1000):  # 20-fold
        before = {p["path"] for p in wh.manifest("raw", "t").parts}
        load_table(wh, "t", rows(n, n + 1000), "id", slots=2, slot_bytes=30_000)
        assert before != {p["path"] for p in wh.manifest("raw", "t").parts}
    m = wh.manifest("raw", "t")
    assert m.notes["slots"] > 10 and len({p["slot"] for p in m.parts}) == m.notes["slots"]
    assert max(map(size, m.parts)) < 3 * 30_000
    assert wh.read("raw", "t").distinct().count() == 20_000
    # a row is found in the slot that its key says, and a small batch rewrites no other
    where = {r.id: r.s for r in wh.read("raw", "t").select("id", key_slot("id", m.notes["slots"]).alias("s")).collect()}
    for p in m.parts[:5]:
        own = wh.read("raw", "t", slots=[p["slot"]]).select("id").collect()
        assert own and {where[r.id] for r in own} == {p["slot"]}
    load_table(wh, "t", spark.createDataFrame([("k5", "new")], "id string, val string"), "id", slot_bytes=30_000)
    after = wh.manifest("raw", "t").parts
    assert len([p for p in after if p["path"] not in {q["path"] for q in m.parts}]) <= 2


def test_divided_slots_and_linear_hashing(spark):
    keys = [f"k{i}" for i in range(500)]
    df = spark.createDataFrame([(k,) for k in keys], "id string")
    at = lambda n: {r.id: r.s for r in df.select("id", key_slot("id", n).alias("s")).collect()}
    for old, new in [(1, 2), (5, 6), (5, 13), (16, 17), (3, 64)]:
        a, b = at(old), at(new)
        assert set(a.values()) <= {str(i) for i in range(old)} and set(b.values()) <= {str(i) for i in range(new)}
        assert {a[k] for k in keys if a[k] != b[k]} <= divided(old, new)


def test_a_batch_that_changes_nothing_commits_nothing(wh, spark):
    schema = "id string, val double, ingested_at timestamp"
    rows = lambda day, *extra: spark.createDataFrame(
        [("a", float("nan"), dt.datetime(2024, 1, day)), ("b", None, dt.datetime(2024, 1, day)), *extra], schema
    )
    load_table(wh, "t", rows(1), "id")
    assert load_table(wh, "t", rows(2), "id") == 1 == wh.current_version("raw", "t")
    assert load_table(wh, "t", rows(3, ("c", 1.0, dt.datetime(2024, 1, 3))), "id") == 2
    assert sorted(r.ingested_at.day for r in wh.read("raw", "t").collect()) == [1, 1, 3]
    wh.publish("raw", "u", spark.createDataFrame([("x", 1)], "id string, v int"))  # not divided by a load
    load_table(wh, "u", spark.createDataFrame([("y", 2)], "id string, v int"), "id")
    assert values(wh, "raw", "u") == [("x", 1), ("y", 2)] and wh.manifest("raw", "u").notes["slots"] == 16


def test_replace_rewrites_only_parts_that_hold_the_keys(wh, spark):
    rows = lambda ids, v: spark.createDataFrame([(i, v) for i in ids], "k int, v string")
    slot = lambda: key_slot("k", 4)
    wh.publish("marts", "f", rows(range(40), "a"), key="k", slot=slot(), notes={"slots": 4})
    wh.append("marts", "f", rows([50, 51], "a"), key="k")
    wh.append("marts", "f", rows([60], "a"), key="k")
    before = wh.manifest("marts", "f").parts
    wh.replace_rows("marts", "f", rows([3, 51, 70], "b"), "k", slot=slot())
    after = wh.manifest("marts", "f").parts
    assert len([p for p in before if p in after]) == len(before) - 2  # one slot and one appended part
    want = {**{i: "a" for i in [*range(40), 50, 60]}, 3: "b", 51: "b", 70: "b"}
    assert dict(values(wh)) == want
    wh.replace_rows("marts", "f", spark.createDataFrame([(60, 1, 2)], "k int, v int, w int").selectExpr("k", "cast(v as string) v", "w"), "k", slot=slot())
    assert {r.k: (r.v, r.w) for r in wh.read("marts", "f").collect()}[60] == ("1", 2)


def test_replace_load_refuses_unknown_columns(spark):
    old = spark.createDataFrame([("a", 1)], "id string, v int")
    with pytest.raises(ValueError, match="extra"):
        replace_load(spark.createDataFrame([("b", 2, "x")], "id string, v int, extra string"), old)


def test_history_writes_only_what_changed(wh, spark):
    labels = lambda *rows: spark.createDataFrame(rows, "Provider string, PotentialFraud string")
    snap = lambda df, day: snapshot_table(wh, "s", df, dt.datetime(2024, 1, day), f"run{day}")
    snap(labels(("P1", "No"), ("P2", "Yes")), 1)
    assert snap(labels(("P1", "No"), ("P2", "Yes")), 2) is None
    snap(labels(("P1", "Yes"), ("P2", "Yes")), 3)
    closed = [p for p in wh.manifest("snapshots", "s").parts if p["slot"] == "closed"]
    snap(labels(("P1", "No"), ("P2", "Yes")), 4)
    assert closed[0] in wh.manifest("snapshots", "s").parts  # closed versions are never written again
    rows = wh.read("snapshots", "s").collect()
    assert len(rows) == 4 and sum(r["valid_to"] is None for r in rows) == 2
    with pytest.raises(Exception, match="more than once"):
        snap(labels(("P1", "No"), ("P1", "Yes")), 5)


def test_quarantine_keeps_every_batch(wh, spark):
    wh.quarantine("t", spark.range(3), "a")
    wh.quarantine("t", spark.range(1), "b")
    with pytest.raises(Exception, match="exist"):
        wh.quarantine("t", spark.range(1), "a")
    assert spark.read.parquet(wh.path("rejected", "t")).count() == 4


def test_vacuum_keeps_listed_and_young_parts(wh, spark):
    wh.publish("raw", "t", spark.range(3))
    wh.append("raw", "t", spark.range(3, 5))
    wh.publish("raw", "t", spark.range(2))
    wh._write_part("raw", "t", spark.range(1), None)  # a writer at work
    assert len(wh.vacuum("raw", "t", keep=1)) == 2
    assert wh.read("raw", "t").count() == 2 and wh.versions("raw", "t") == [3]
    assert len(wh.vacuum("raw", "t", keep=1, orphan_hours=-1)) == 1 and wh.read("raw", "t").count() == 2
