"""Data-quality checks, the warehouse, the end-to-end job and the driver entry."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from helpers import SF_SMOKE
from pyspark.sql import functions as F

from caremarts.operators import quality as Q
from caremarts.plans.flow import FlowConfig, run_flow
from caremarts.plans.models import MART_READS, Models
from caremarts.warehouse import Warehouse


def test_declared_generic_tests_number_ninety():
    kinds = [t.kind for t in Q.GENERIC_TESTS]
    assert len(kinds) == 90 and len(Q.SINGULAR_TESTS) == 8
    assert (kinds.count("unique"), kinds.count("not_null"), kinds.count("accepted_values"), kinds.count("relationships")) == (19, 52, 13, 6)


def test_unique_and_accepted_values(spark):
    df = spark.createDataFrame([("a", "X"), ("a", "Y"), ("b", None), (None, "Z")], "k string, v string")
    assert Q.check_unique(df, "k").collect()[0]["k"] == "a"
    assert {r["v"] for r in Q.check_accepted_values(df, "v", ("X", "Y")).collect()} == {"Z"}


def test_history_checks(spark):
    t = lambda d: dt.datetime(2024, 1, d)
    h = spark.createDataFrame(
        [("P1", t(1), t(5)), ("P1", t(3), None), ("P2", t(1), t(2)), ("P2", t(2), None), ("P3", t(1), t(2))],
        "provider_id string, valid_from timestamp, valid_to timestamp",
    ).withColumn("is_current", F.col("valid_to").isNull())
    overlap = {(r["provider_id"], r["valid_from"]) for r in Q.check_history_no_overlap(h).collect()}
    assert overlap == {("P1", t(1)), ("P1", t(3))}
    assert {r["provider_id"] for r in Q.check_history_one_current(h).collect()} == {"P3"}


def test_warehouse_versions_and_reset(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    wh.publish("raw", "t", spark.range(3))
    wh.publish("raw", "t", spark.range(5))
    wh.publish("snapshots", "s", spark.range(2))
    assert wh.current_version("raw", "t") == 2 and wh.read("raw", "t").count() == 5
    wh.reset_raw(["t", "absent"])
    assert wh.read("raw", "t").count() == 0 and wh.read("snapshots", "s").count() == 2
    assert len(wh.vacuum("raw", "t", keep=1)) == 2 and wh.read("raw", "t").count() == 0


def test_gate_raises_on_empty_mart(spark):
    counts = spark.createDataFrame([("fct_claims", 0), ("dim_provider", 3)], "mart string, row_count long")
    with pytest.raises(Q.EmptyMartError, match="fct_claims"):
        Q.gate_marts(counts)


@pytest.mark.skipif(not os.path.exists(SF_SMOKE), reason="test data not present")
def test_flow_end_to_end_modes(spark, tmp_path):
    wh = str(tmp_path / "wh")
    cfg = FlowConfig(warehouse=wh, source=SF_SMOKE, batch_ts=dt.datetime(2024, 1, 1), fail_on_test_error=False)
    first = run_flow(spark, cfg)
    counts = first.summary["mart_row_counts"]
    assert all(n > 0 for n in counts.values()) and len(counts) == 10
    assert first.summary["tests"]["total"] == 98
    # idempotent rerun: same marts, history unchanged
    store = Warehouse(spark, wh)
    tables = [*(("raw", t) for t in first.summary["ingestion"]), ("snapshots", "snap_provider_fraud"), *(("marts", n) for n in MART_READS)]
    versions = {t: store.current_version(*t) for t in tables}
    cfg.batch_ts = dt.datetime(2024, 1, 2)
    again = run_flow(spark, cfg)
    assert again.summary["mart_row_counts"] == counts
    assert again.summary["tests"] == first.summary["tests"] and again.summary["ingestion"] == first.summary["ingestion"]
    assert {t: store.current_version(*t) for t in tables} == versions  # nothing moved, so nothing was written
    # ingest only, then transform only
    only_ingest = run_flow(spark, FlowConfig(warehouse=wh, source=SF_SMOKE, transform=False, batch_ts=dt.datetime(2024, 1, 3)))
    assert set(only_ingest.summary["ingestion"]) == {
        "beneficiary", "inpatient_claims", "outpatient_claims", "providers",
        "diabetes_encounters", "hospital_admissions",
    }
    # reset: raw replaced, incremental facts rebuilt, history kept
    reset = run_flow(spark, FlowConfig(warehouse=wh, source=SF_SMOKE, reset=True, batch_ts=dt.datetime(2024, 1, 4), fail_on_test_error=False))
    assert reset.summary["mart_row_counts"] == counts
    w = Warehouse(spark, wh)
    assert w.read("snapshots", "snap_provider_fraud").count() == counts["dim_provider_history"]


@pytest.mark.skipif(not os.path.exists(SF_SMOKE), reason="test data not present")
def test_flow_fails_on_error_tests(spark, tmp_path):
    from caremarts.plans.flow import TestFailure

    with pytest.raises(TestFailure, match="assert_"):
        run_flow(spark, FlowConfig(warehouse=str(tmp_path / "w"), source=SF_SMOKE, batch_ts=dt.datetime(2024, 1, 1)))


@pytest.mark.skipif(not os.path.exists(SF_SMOKE), reason="test data not present")
def test_models_read_what_they_are_said_to_read(spark):
    """A model is skipped where the tables it is said to read have not moved."""
    from caremarts.plans.registry import context

    ctx = context(spark, SF_SMOKE)
    for name, said in MART_READS.items():
        read = set()

        def raw(table, read=read):
            read.add(f"raw/{table}")
            return ctx.raw(table)

        getattr(Models(spark, raw, snapshot=ctx.models.snapshot), name)
        if name == "fct_claims":  # reads the published int_claims_enriched
            said = MART_READS["int_claims_enriched"]
        assert read == {t for t in said if t.startswith("raw/")}, name


def test_missing_csv_source_raises(spark, tmp_path):
    from caremarts.sources.csv import read_source

    with pytest.raises(FileNotFoundError, match="Train-"):
        read_source(spark, str(tmp_path / "Train-*.csv"))


def test_csv_source_renames_and_keeps_text(spark, tmp_path):
    from caremarts.sources.csv import read_source

    p = tmp_path / "h.csv"
    p.write_text("case_id,Bed Grade,code\n1,NA,4019\n")
    df = read_source(spark, str(p), renames={"Bed Grade": "bed_grade"})
    row = df.first()
    assert row["bed_grade"] is None and row["code"] == "4019" and row["_source_file"].endswith("h.csv")


@pytest.mark.skipif(not os.path.exists(SF_SMOKE), reason="test data not present")
def test_entry_and_registry(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.count() > 0 and "avg_reimbursement_per_claim" in df.columns
    qs, sqls = entry.queries(), entry.oracle_sql()
    assert set(sqls) <= set(qs)
    assert len(qs) >= 70
