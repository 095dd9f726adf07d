"""Staging models (G1-G6): one row in, one row out; rename, cast, recode.

Input of each is a raw table as loaded (validated rows, contract types).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caremarts.functions.columns import case_map
from caremarts.operators.contracts import CHRONIC_CONDITION_COLS, DIABETES_MED_COLS

MONEY = "decimal(12,2)"
# Unconstrained numeric in the source model; Spark needs a bound. 18,4 holds
# any deposit below 10^14 exactly at the precision the extracts carry.
NUMERIC = "decimal(18,4)"

# -- fixed values: code labels of the beneficiary extract ---------------------
GENDER_LABELS = {1: "Male", 2: "Female"}
RACE_LABELS = {1: "White", 2: "Black", 3: "Other", 5: "Hispanic"}
RACE_DEFAULT = "Unknown"
FRAUD_LABELS = {"Yes": True, "No": False}

# -- fixed values: boolean names of the chronic-condition flags (same order) --
CHRONIC_FLAG_NAMES = (
    "has_alzheimers",
    "has_heart_failure",
    "has_kidney_disease",
    "has_cancer",
    "has_obstr_pulmonary",
    "has_depression",
    "has_diabetes",
    "has_ischemic_heart",
    "has_osteoporosis",
    "has_rheumatoid_arthritis",
    "has_stroke",
)

DIAGNOSIS_NAMES = tuple(f"diagnosis_code_{i}" for i in range(1, 11))
PROCEDURE_NAMES = tuple(f"procedure_code_{i}" for i in range(1, 7))


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def _date(name: str) -> Column:
    return _c(name).cast("date")


def _int_rint(name: str) -> Column:
    """float -> int rounding half to even, as a database cast does."""
    return F.rint(_c(name)).cast("int")


def _codes() -> list[Column]:
    return [
        *[_c(f"ClmDiagnosisCode_{i}").alias(n) for i, n in enumerate(DIAGNOSIS_NAMES, 1)],
        *[_c(f"ClmProcedureCode_{i}").alias(n) for i, n in enumerate(PROCEDURE_NAMES, 1)],
    ]


def stg_beneficiary(raw: DataFrame) -> DataFrame:
    return raw.select(
        _c("BeneID").alias("bene_id"),
        _date("DOB").alias("date_of_birth"),
        _date("DOD").alias("date_of_death"),
        case_map("Gender", GENDER_LABELS).alias("gender"),
        case_map("Race", RACE_LABELS, RACE_DEFAULT).alias("race"),
        _c("RenalDiseaseIndicator").alias("renal_disease_indicator"),
        _c("State").alias("state_code"),
        _c("County").alias("county_code"),
        _c("NoOfMonths_PartACov").alias("months_part_a_coverage"),
        _c("NoOfMonths_PartBCov").alias("months_part_b_coverage"),
        *[
            (_c(src) == F.lit(1)).alias(dst)
            for src, dst in zip(CHRONIC_CONDITION_COLS, CHRONIC_FLAG_NAMES, strict=True)
        ],
        _c("IPAnnualReimbursementAmt").cast(MONEY).alias("ip_annual_reimbursement"),
        _c("IPAnnualDeductibleAmt").cast(MONEY).alias("ip_annual_deductible"),
        _c("OPAnnualReimbursementAmt").cast(MONEY).alias("op_annual_reimbursement"),
        _c("OPAnnualDeductibleAmt").cast(MONEY).alias("op_annual_deductible"),
    )


def stg_inpatient_claims(raw: DataFrame) -> DataFrame:
    return raw.select(
        _c("BeneID").alias("bene_id"),
        _c("ClaimID").alias("claim_id"),
        _c("Provider").alias("provider_id"),
        F.lit("inpatient").alias("claim_type"),
        _date("ClaimStartDt").alias("claim_start_date"),
        _date("ClaimEndDt").alias("claim_end_date"),
        _date("AdmissionDt").alias("admission_date"),
        _date("DischargeDt").alias("discharge_date"),
        F.datediff(_date("DischargeDt"), _date("AdmissionDt")).alias("claim_duration_days"),
        _c("InscClaimAmtReimbursed").cast(MONEY).alias("reimbursement_amount"),
        _c("DeductibleAmtPaid").cast(MONEY).alias("deductible_amount"),
        _c("AttendingPhysician").alias("attending_physician"),
        _c("OperatingPhysician").alias("operating_physician"),
        _c("OtherPhysician").alias("other_physician"),
        _c("ClmAdmitDiagnosisCode").alias("admit_diagnosis_code"),
        _c("DiagnosisGroupCode").alias("diagnosis_group_code"),
        *_codes(),
    )


def stg_outpatient_claims(raw: DataFrame) -> DataFrame:
    return raw.select(
        _c("BeneID").alias("bene_id"),
        _c("ClaimID").alias("claim_id"),
        _c("Provider").alias("provider_id"),
        F.lit("outpatient").alias("claim_type"),
        _date("ClaimStartDt").alias("claim_start_date"),
        _date("ClaimEndDt").alias("claim_end_date"),
        _c("InscClaimAmtReimbursed").cast(MONEY).alias("reimbursement_amount"),
        _c("DeductibleAmtPaid").cast(MONEY).alias("deductible_amount"),
        _c("AttendingPhysician").alias("attending_physician"),
        _c("OperatingPhysician").alias("operating_physician"),
        _c("OtherPhysician").alias("other_physician"),
        _c("ClmAdmitDiagnosisCode").alias("admit_diagnosis_code"),
        *_codes(),
    )


def fraud_flag(label: Column) -> Column:
    """``Yes`` -> true, ``No`` -> false, anything else -> null."""
    return case_map(label, FRAUD_LABELS)


def stg_providers(raw: DataFrame) -> DataFrame:
    return raw.select(
        _c("Provider").alias("provider_id"),
        fraud_flag(_c("PotentialFraud")).alias("is_potential_fraud"),
    )


_DIABETES_INTS = (
    "admission_type_id",
    "discharge_disposition_id",
    "admission_source_id",
)
_DIABETES_MEASURES = (
    "time_in_hospital",
    "num_lab_procedures",
    "num_procedures",
    "num_medications",
    "number_outpatient",
    "number_emergency",
    "number_inpatient",
    "number_diagnoses",
)


def stg_diabetes_encounters(raw: DataFrame) -> DataFrame:
    return raw.select(
        _c("encounter_id"),
        _c("patient_nbr"),
        _c("race"),
        _c("gender"),
        _c("age").alias("age_bracket"),
        _c("weight"),
        *[_c(n).cast("int").alias(n) for n in _DIABETES_INTS],
        _c("medical_specialty"),
        _c("payer_code"),
        *[_c(n).cast("int").alias(n) for n in _DIABETES_MEASURES],
        _c("diag_1"),
        _c("diag_2"),
        _c("diag_3"),
        _c("max_glu_serum"),
        _c("A1Cresult").alias("a1c_result"),
        *[_c(m) for m in DIABETES_MED_COLS],
        (_c("change") == F.lit("Ch")).alias("had_med_change"),
        (_c("diabetesMed") == F.lit("Yes")).alias("on_diabetes_med"),
        _c("readmitted").alias("readmitted_status"),
        (_c("readmitted") == F.lit("<30")).alias("is_readmitted_30d"),
    )


def stg_hospital_admissions(raw: DataFrame) -> DataFrame:
    return raw.select(
        _c("admission_id"),
        _c("case_id"),
        _c("patientid").alias("patient_id"),
        _c("Hospital_code").cast("int").alias("hospital_code"),
        _c("Hospital_type_code").alias("hospital_type_code"),
        _c("City_Code_Hospital").cast("int").alias("city_code_hospital"),
        _c("Hospital_region_code").alias("hospital_region_code"),
        _c("Ward_Type").alias("ward_type"),
        _c("Ward_Facility_Code").alias("ward_facility_code"),
        _c("Department").alias("department"),
        _int_rint("bed_grade").alias("bed_grade"),
        _c("available_extra_rooms").cast("int").alias("available_extra_rooms"),
        _int_rint("City_Code_Patient").alias("city_code_patient"),
        _c("type_of_admission"),
        _c("severity_of_illness"),
        _c("visitors_with_patient").cast("int").alias("visitors_with_patient"),
        _c("Age").alias("age_bracket"),
        _c("Admission_Deposit").cast(NUMERIC).alias("admission_deposit"),
        _c("Stay").alias("length_of_stay_bracket"),
    )
