"""Contract validation: one valid row per table, one field mutated per case."""

from __future__ import annotations

import pytest
from helpers import text_frame

from caremarts.operators.contracts import (
    CHRONIC_CONDITION_COLS,
    CONTRACTS,
    DIABETES_MED_COLS,
    DIAGNOSIS_COLS,
    PROCEDURE_COLS,
)
from caremarts.operators.prepare import prepare_diabetes, prepare_hospital
from caremarts.operators.validate import ContractError, validate
from caremarts.sources.csv import na_token_recode


def bene_row(**kw):
    flags = {c: 2 - i % 2 for i, c in enumerate(CHRONIC_CONDITION_COLS)}
    row = {
        "BeneID": "B-0007",
        "DOB": "1951-03-30",
        "DOD": None,
        "Gender": 2,
        "Race": 5,
        "RenalDiseaseIndicator": "Y",
        "State": 17,
        "County": 480,
        "NoOfMonths_PartACov": 5,
        "NoOfMonths_PartBCov": 9,
        "IPAnnualReimbursementAmt": 0,
        "IPAnnualDeductibleAmt": 11,
        "OPAnnualReimbursementAmt": 930,
        "OPAnnualDeductibleAmt": 215,
    }
    return {**row, **flags, **kw}


def claim_row(inpatient=True, **kw):
    codes = {c: None for c in (*DIAGNOSIS_COLS, *PROCEDURE_COLS)} | {"ClmDiagnosisCode_1": "0388"}
    stay = {"AdmissionDt": "2009-11-02", "DischargeDt": "2009-11-05", "DiagnosisGroupCode": "077"}
    row = {
        "ClaimID": "C-100",
        "BeneID": "B-0007",
        "Provider": "P-31",
        "ClaimStartDt": "2009-11-02",
        "ClaimEndDt": "2009-11-05",
        "AttendingPhysician": "D-5",
        "OperatingPhysician": "D-6",
        "OtherPhysician": None,
        "InscClaimAmtReimbursed": 750,
        "DeductibleAmtPaid": None,
        "ClmAdmitDiagnosisCode": "5990",
    }
    return {**row, **codes, **(stay if inpatient else {}), **kw}


def diabetes_row(**kw):
    counts = dict.fromkeys(
        (
            "num_lab_procedures",
            "num_procedures",
            "num_medications",
            "number_outpatient",
            "number_emergency",
            "number_inpatient",
            "number_diagnoses",
        ),
        4,
    )
    unknown = dict.fromkeys(("weight", "payer_code", "medical_specialty", "max_glu_serum", "diag_2", "diag_3"))
    row = {
        "encounter_id": 501,
        "patient_nbr": 77,
        "gender": "Male",
        "race": "Hispanic",
        "age": "[30-40)",
        "admission_type_id": 2,
        "discharge_disposition_id": 3,
        "admission_source_id": 4,
        "time_in_hospital": 8,
        "diag_1": "786",
        "A1Cresult": "Norm",
        "change": "No",
        "diabetesMed": "No",
        "readmitted": ">30",
    }
    medication = {m: "Steady" if m == "metformin" else "No" for m in DIABETES_MED_COLS}
    return {**row, **counts, **unknown, **medication, **kw}


def hospital_row(**kw):
    hospital = {
        "Hospital_code": 3,
        "Hospital_type_code": "e",
        "Hospital_region_code": "Z",
        "City_Code_Hospital": 6,
        "Department": "surgery",
        "Ward_Type": "S",
        "Ward_Facility_Code": "B",
        "available_extra_rooms": 1,
        "bed_grade": 2,
    }
    patient = {
        "case_id": 12,
        "patientid": 340,
        "City_Code_Patient": 5,
        "type_of_admission": "Urgent",
        "severity_of_illness": "Minor",
        "visitors_with_patient": 6,
        "Age": "71-80",
        "Admission_Deposit": 2900,
        "Stay": "20-Nov",
    }
    return {**hospital, **patient, **kw}


def split(spark, table, rows):
    v = validate(text_frame(spark, rows), CONTRACTS[table])
    return v.valid.count(), v.rejected.collect()


def test_beneficiary_valid_row_passes_with_null_death_date(spark):
    n_valid, rejected = split(spark, "beneficiary", [bene_row()])
    assert (n_valid, len(rejected)) == (1, 0)


@pytest.mark.parametrize(
    "mutation, reason",
    [
        ({"IPAnnualReimbursementAmt": -5}, "IPAnnualReimbursementAmt:ge"),
        ({"ChronicCond_Cancer": 3}, "ChronicCond_Cancer:isin"),
        ({"BeneID": None}, "BeneID:not_null"),
        ({"Gender": "male"}, "Gender:dtype"),
    ],
)
def test_beneficiary_bad_rows_rejected_with_reason(spark, mutation, reason):
    rows = [bene_row(), bene_row(**{"BeneID": "B-0008", **mutation})]
    n_valid, rejected = split(spark, "beneficiary", rows)
    assert n_valid == 1
    assert len(rejected) == 1 and reason in rejected[0]["_reject_reasons"]


def test_duplicate_key_rejects_every_copy(spark):
    rows = [bene_row(), bene_row(), bene_row(BeneID="B-0008")]
    n_valid, rejected = split(spark, "beneficiary", rows)
    assert n_valid == 1 and len(rejected) == 2
    assert all("BeneID:unique" in r["_reject_reasons"] for r in rejected)


def test_inpatient_negative_amount_and_null_key(spark):
    rows = [claim_row(), claim_row(ClaimID="C2", InscClaimAmtReimbursed=-1), claim_row(ClaimID=None)]
    n_valid, rejected = split(spark, "inpatient_claims", rows)
    assert n_valid == 1 and len(rejected) == 2


def test_outpatient_passes_without_admission_columns(spark):
    n_valid, rejected = split(spark, "outpatient_claims", [claim_row(inpatient=False)])
    assert (n_valid, len(rejected)) == (1, 0)


def test_code_stays_text(spark):
    v = validate(text_frame(spark, [claim_row()]), CONTRACTS["inpatient_claims"])
    assert v.valid.first()["ClmDiagnosisCode_1"] == "0388"


def test_providers_null_label_passes_duplicate_and_null_key_fail(spark):
    rows = [
        {"Provider": "PRV1", "PotentialFraud": None},
        {"Provider": "PRV2", "PotentialFraud": "Yes"},
        {"Provider": "PRV2", "PotentialFraud": "No"},
        {"Provider": None, "PotentialFraud": "No"},
    ]
    n_valid, rejected = split(spark, "providers", rows)
    assert n_valid == 1 and len(rejected) == 3


def test_missing_declared_column_fails_whole_load(spark):
    df = text_frame(spark, [bene_row()]).drop("DOB")
    with pytest.raises(ContractError, match="DOB"):
        validate(df, CONTRACTS["beneficiary"])


def test_extra_columns_pass_through(spark):
    df = text_frame(spark, [bene_row(extra="x")])
    v = validate(df, CONTRACTS["beneficiary"])
    assert v.valid.first()["extra"] == "x"


def diabetes_valid(spark, rows):
    df = prepare_diabetes(na_token_recode(text_frame(spark, rows)))
    return validate(df, CONTRACTS["diabetes_encounters"])


def test_diabetes_int_id_becomes_text_and_sentinel_is_null(spark):
    v = diabetes_valid(spark, [diabetes_row(race="?", max_glu_serum="None")])
    row = v.valid.first()
    assert row["encounter_id"] == "501"
    assert row["race"] is None and row["max_glu_serum"] is None


@pytest.mark.parametrize(
    "mutation", [{"readmitted": "60"}, {"glipizide": "Halved"}, {"age": "[30,40)"}, {"admission_type_id": 0}]
)
def test_diabetes_bad_values_rejected(spark, mutation):
    v = diabetes_valid(spark, [diabetes_row(), diabetes_row(encounter_id=2, **mutation)])
    assert v.valid.count() == 1 and v.rejected.count() == 1


def test_diabetes_duplicate_quarantined_total_preserved(spark):
    v = diabetes_valid(spark, [diabetes_row(), diabetes_row(), diabetes_row(encounter_id=3)])
    assert v.rejected.count() >= 1
    assert v.valid.count() + v.rejected.count() == 3


def hospital_valid(spark, rows):
    return validate(prepare_hospital(text_frame(spark, rows)), CONTRACTS["hospital_admissions"])


def test_hospital_recode_and_minted_key(spark):
    import hashlib

    v = hospital_valid(spark, [hospital_row(Age="20-Nov")])
    row = v.valid.first()
    assert row["Age"] == "11-20" and row["Stay"] == "11-20"
    assert row["admission_id"] == hashlib.md5(b"12-340").hexdigest()


@pytest.mark.parametrize("mutation", [{"type_of_admission": "Transfer"}, {"Stay": "11 to 20"}])
def test_hospital_bad_values_rejected(spark, mutation):
    v = hospital_valid(spark, [hospital_row(), hospital_row(case_id=2, **mutation)])
    assert v.valid.count() == 1 and v.rejected.count() == 1


def test_hospital_null_bed_grade_passes_duplicate_pair_quarantined(spark):
    v = hospital_valid(spark, [hospital_row(bed_grade=None), hospital_row(case_id=9), hospital_row(case_id=9)])
    assert v.valid.count() == 1
    assert v.rejected.count() == 2


@pytest.mark.parametrize("table", sorted(CONTRACTS))
def test_no_generated_method_is_too_large_to_be_compiled(spark, tmp_path, table):
    """The JVM does not compile methods of more than 8,000 bytes."""
    columns = list(CONTRACTS[table].columns)
    text_frame(spark, [dict.fromkeys(columns, "1")], columns).write.parquet(str(tmp_path / "t"))
    v = validate(spark.read.parquet(str(tmp_path / "t")), CONTRACTS[table])
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # else code is generated as stages run
    try:
        plan = v.valid._jdf.queryExecution().executedPlan()
        debug = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
        found, sizes = debug.codegenStringSeq(plan).iterator(), []
        while found.hasNext():
            sizes.append(found.next()._3().maxMethodCodeSize())
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
    assert sizes and max(sizes) < 8000


def test_counts_come_from_the_write(spark, tmp_path):
    rows = [{"Provider": f"P{i}", "PotentialFraud": "Yes"} for i in (1, 2, 3, 4, 4)]
    v = validate(text_frame(spark, rows), CONTRACTS["providers"])
    v.annotated.write.parquet(str(tmp_path / "t"))
    stored = v.over(spark.read.parquet(str(tmp_path / "t")))
    spark.sparkContext.setJobGroup("counts", "counts")
    try:
        counts = stored.counts()
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("counts")) == 0
    finally:
        spark.sparkContext._jsc.clearJobGroup()
    assert counts == {"loaded": 3, "rejected": 2} == {"loaded": stored.valid.count(), "rejected": stored.rejected.count()}
