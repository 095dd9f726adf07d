"""File-stream ingest: two drops, an update, a replay."""

from __future__ import annotations

import datetime as dt

import pytest
from test_contracts import diabetes_row, hospital_row

from caremarts.operators.contracts import SOURCE_RENAMES
from caremarts.streaming.ingest import start_file_ingest
from caremarts.warehouse import Warehouse


def drop(path, name, rows):
    lines = ["Provider,PotentialFraud"] + [f"{p},{f}" for p, f in rows]
    (path / name).write_text("\n".join(lines) + "\n")


def test_stream_upserts_and_quarantines(spark, tmp_path):
    src, wh_root, ckpt = tmp_path / "in", str(tmp_path / "wh"), str(tmp_path / "ckpt")
    src.mkdir()
    drop(src, "a.csv", [("PRV1", "Yes"), ("PRV2", "Yes"), ("PRV2", "No")])
    q = start_file_ingest(spark, "providers", str(src), wh_root, checkpoint=ckpt, clock=lambda: dt.datetime(2024, 1, 1))
    q.awaitTermination()
    wh = Warehouse(spark, wh_root)
    # PRV2 appears twice in the drop: the first row of the file stays
    first = {r["Provider"]: r["PotentialFraud"] for r in wh.read("raw", "providers").collect()}
    assert first == {"PRV1": "Yes", "PRV2": "Yes"}

    drop(src, "b.csv", [("PRV2", "No"), ("PRV3", "NA")])
    q = start_file_ingest(spark, "providers", str(src), wh_root, checkpoint=ckpt, clock=lambda: dt.datetime(2024, 2, 1))
    q.awaitTermination()
    rows = {r["Provider"]: r for r in wh.read("raw", "providers").collect()}
    assert rows["PRV2"]["PotentialFraud"] == "No"
    assert rows["PRV2"]["ingested_at"] == dt.datetime(2024, 1, 1)  # first-seen kept
    assert rows["PRV3"]["PotentialFraud"] is None  # 'NA' is a missing token
    version = wh.current_version("raw", "providers")

    # nothing new: the stream commits no batch and the table is unchanged
    q = start_file_ingest(spark, "providers", str(src), wh_root, checkpoint=ckpt)
    q.awaitTermination()
    assert wh.current_version("raw", "providers") == version


def spelled(table, row):
    back = {new: old for old, new in SOURCE_RENAMES[table].items()}
    return {back.get(c, c): "" if v is None else v for c, v in row.items()}


def lines_of(rows, columns):
    return "\n".join([",".join(columns), *[",".join(str(r[c]) for c in columns) for r in rows]]) + "\n"


@pytest.mark.parametrize(
    "table, make, key, fact",
    [
        ("hospital_admissions", hospital_row, "case_id", "fct_hospital_admissions"),
        ("diabetes_encounters", diabetes_row, "encounter_id", "fct_encounters"),
    ],
)
def test_stream_reads_by_header_and_updates_the_fact(spark, tmp_path, table, make, key, fact):
    src, root, ckpt = tmp_path / "in", str(tmp_path / "wh"), str(tmp_path / "ckpt")
    src.mkdir()
    rows = [spelled(table, make(**{key: i})) for i in (1, 2)]
    columns = sorted(rows[0], reverse=True)  # neither the contract's order nor its spelling
    (src / "a.csv").write_text(lines_of(rows, columns) + ",".join(["x"] * (len(columns) + 2)) + "\n")
    start_file_ingest(spark, table, str(src), root, checkpoint=ckpt).awaitTermination()
    wh = Warehouse(spark, root)
    got = wh.read("raw", table)
    assert sorted(str(r[key]) for r in got.collect()) == ["1", "2"]
    assert wh.read("marts", fact).count() == 2
    (batch,) = [s.getPath().toString() for s in wh._list(wh.path("rejected", table))]
    (reject,) = spark.read.parquet(batch).collect()
    assert "row:malformed" in reject["_reject_reasons"]

    (src / "b.csv").write_text(lines_of([spelled(table, make(**{key: 3}))], columns))
    start_file_ingest(spark, table, str(src), root, checkpoint=ckpt).awaitTermination()
    assert wh.read("marts", fact).count() == 3
    assert len(wh.manifest("marts", fact).parts) == 2  # the new row is a part of its own
    # a stream with a new checkpoint starts at epoch 0 and keeps the first one's rejects
    start_file_ingest(spark, table, str(src), root, checkpoint=str(tmp_path / "ckpt2")).awaitTermination()
    assert spark.read.parquet(batch).count() == 1
    assert wh.read("marts", fact).count() == 3

    (src / "c.csv").write_text(lines_of([spelled(table, make(**{key: 4}))], sorted(columns)))
    with pytest.raises(Exception):  # another header in the folder is refused
        start_file_ingest(spark, table, str(src), root, checkpoint=ckpt, columns=tuple(columns)).awaitTermination()


def test_an_epoch_that_is_replayed_is_not_loaded_again(spark, tmp_path, monkeypatch):
    from caremarts.streaming import ingest

    src, root, ckpt = tmp_path / "in", str(tmp_path / "wh"), str(tmp_path / "ckpt")
    src.mkdir()
    rows = [spelled("hospital_admissions", hospital_row(case_id=i)) for i in (1, 2)]
    (src / "a.csv").write_text(lines_of(rows, sorted(rows[0])))
    start = lambda: start_file_ingest(spark, "hospital_admissions", str(src), root, checkpoint=ckpt)
    with monkeypatch.context() as m:

        def dies(*args, **kw):
            raise RuntimeError("between load and facts")

        m.setattr(ingest, "update_facts", dies)
        with pytest.raises(Exception, match="between load and facts"):
            start().awaitTermination()
    wh = Warehouse(spark, root)
    loaded = wh.manifest("raw", "hospital_admissions")
    assert len(loaded.notes["epochs"]) == 1 and not wh.exists("marts", "fct_hospital_admissions")
    with monkeypatch.context() as m:
        m.setattr(ingest, "load_table", dies)  # the replay must not get there
        start().awaitTermination()
    assert wh.current_version("raw", "hospital_admissions") == loaded.version
    assert wh.read("marts", "fct_hospital_admissions").count() == 2
    version = wh.current_version("marts", "fct_hospital_admissions")
    (src / "b.csv").write_text(lines_of(rows, sorted(rows[0])))  # the next epoch brings known rows only
    start().awaitTermination()
    assert wh.current_version("marts", "fct_hospital_admissions") == version
