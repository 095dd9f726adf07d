"""The job over CSV extracts laid out as the sources ship them."""

from __future__ import annotations

import datetime as dt
import glob
import os
import shutil

import pytest
from helpers import SF_SMOKE

from caremarts.functions.columns import hash_bucket
from caremarts.operators.contracts import SOURCE_RENAMES
from caremarts.plans.flow import FlowConfig, run_flow
from caremarts.sources.fixtures import raw_sources


def write_csv(df, path: str) -> None:
    """One CSV file with a header at ``path``, columns in source spelling."""
    tmp = path + ".dir"
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(tmp)
    (part,) = glob.glob(os.path.join(tmp, "part-*.csv"))
    shutil.move(part, path)
    shutil.rmtree(tmp)


def source_spelling(df, table: str):
    for src, canon in SOURCE_RENAMES.get(table, {}).items():
        df = df.withColumnRenamed(canon, src)
    return df


@pytest.mark.skipif(not os.path.exists(SF_SMOKE), reason="test data not present")
def test_csv_layout_matches_fixture_run(spark, tmp_path):
    s = raw_sources(spark, SF_SMOKE)
    root = tmp_path / "landing"
    (root / "claims_fraud").mkdir(parents=True)
    (root / "diabetes_readmission").mkdir()
    (root / "synthetic_hospital").mkdir()
    cf = str(root / "claims_fraud")
    write_csv(s.beneficiary_train, f"{cf}/Train_Beneficiarydata-1.csv")
    write_csv(s.beneficiary_test, f"{cf}/Test_Beneficiarydata-1.csv")
    for name, df in (("Inpatientdata", s.inpatient), ("Outpatientdata", s.outpatient)):
        write_csv(df.filter(hash_bucket("ClaimID", 2) == 0), f"{cf}/Train_{name}-1.csv")
        write_csv(df.filter(hash_bucket("ClaimID", 2) == 1), f"{cf}/Test_{name}-1.csv")
    write_csv(s.providers_train, f"{cf}/Train-1.csv")
    write_csv(s.providers_test, f"{cf}/Test-1.csv")
    write_csv(
        source_spelling(s.diabetes, "diabetes_encounters"),
        str(root / "diabetes_readmission" / "diabetic_data.csv"),
    )
    write_csv(
        source_spelling(s.hospital, "hospital_admissions"),
        str(root / "synthetic_hospital" / "HospitalSynthetic1.csv"),
    )

    ts = dt.datetime(2024, 1, 1)
    from_csv = run_flow(
        spark,
        FlowConfig(warehouse=str(tmp_path / "w1"), source=str(root), source_kind="csv", batch_ts=ts, fail_on_test_error=False),
    )
    from_fixtures = run_flow(
        spark,
        FlowConfig(warehouse=str(tmp_path / "w2"), source=SF_SMOKE, batch_ts=ts, fail_on_test_error=False),
    )
    assert from_csv.summary["ingestion"] == from_fixtures.summary["ingestion"]
    assert from_csv.summary["mart_row_counts"] == from_fixtures.summary["mart_row_counts"]
    assert from_csv.summary["tests"]["failed"] == from_fixtures.summary["tests"]["failed"]
