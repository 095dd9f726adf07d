"""Intermediate models."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caremarts.functions.columns import age_years, case_map, flag_sum
from caremarts.operators.contracts import DIABETES_MED_COLS
from caremarts.plans.staging import CHRONIC_FLAG_NAMES, DIAGNOSIS_NAMES, PROCEDURE_NAMES

# Column order of the unified claim relation.
CLAIM_COLUMNS = (
    "bene_id",
    "claim_id",
    "provider_id",
    "claim_type",
    "claim_start_date",
    "claim_end_date",
    "admission_date",
    "discharge_date",
    "claim_duration_days",
    "reimbursement_amount",
    "deductible_amount",
    "attending_physician",
    "operating_physician",
    "other_physician",
    "admit_diagnosis_code",
    "diagnosis_group_code",
    *DIAGNOSIS_NAMES,
    *PROCEDURE_NAMES,
)

# Typed nulls standing in for inpatient-only columns on outpatient rows.
OUTPATIENT_NULLS = {
    "admission_date": "date",
    "discharge_date": "date",
    "claim_duration_days": "int",
    "diagnosis_group_code": "string",
}

# -- fixed values: length-of-stay bracket -> midpoint in days -----------------
STAY_MIDPOINT_DAYS = {
    "0-10": 5,
    "11-20": 15,
    "21-30": 25,
    "31-40": 35,
    "41-50": 45,
    "51-60": 55,
    "61-70": 65,
    "71-80": 75,
    "81-90": 85,
    "91-100": 95,
    "More than 100 Days": 105,
}
LONG_STAY_DAYS = 30


def int_claims_unified(inpatient: DataFrame, outpatient: DataFrame) -> DataFrame:
    """Inpatient UNION ALL outpatient with aligned columns.

    A plain union: no shuffle, and Catalyst pushes column pruning and filters
    into both branches.
    """
    out = outpatient
    for name, dtype in OUTPATIENT_NULLS.items():
        out = out.withColumn(name, F.lit(None).cast(dtype))
    cols = list(CLAIM_COLUMNS)
    return inpatient.select(*cols).unionByName(out.select(*cols))


def int_claims_enriched(claims: DataFrame, beneficiary: DataFrame) -> DataFrame:
    """Claims with beneficiary demographics, age at claim and conditions.

    A left join on ``bene_id``; AQE chooses broadcast when the beneficiary
    side is small at runtime and splits a beneficiary with very many claims.
    """
    b = beneficiary.select(
        F.col("bene_id").alias("__b_bene_id"),
        "gender",
        "race",
        "date_of_birth",
        *CHRONIC_FLAG_NAMES,
    )
    joined = claims.join(b, F.col("bene_id") == F.col("__b_bene_id"), "left")
    return joined.select(
        "claim_id",
        "bene_id",
        *[c for c in CLAIM_COLUMNS if c not in ("claim_id", "bene_id")],
        "gender",
        "race",
        "date_of_birth",
        age_years("claim_start_date", "date_of_birth").alias("age_at_claim"),
        *CHRONIC_FLAG_NAMES,
    )


def int_encounters_enriched(stg: DataFrame) -> DataFrame:
    """Encounters with prior-visit and active-medication counts."""
    return stg.select(
        "encounter_id",
        "patient_nbr",
        "race",
        "gender",
        "age_bracket",
        "admission_type_id",
        "discharge_disposition_id",
        "admission_source_id",
        "medical_specialty",
        "time_in_hospital",
        "num_lab_procedures",
        "num_procedures",
        "num_medications",
        "number_outpatient",
        "number_emergency",
        "number_inpatient",
        "number_diagnoses",
        (F.col("number_outpatient") + F.col("number_emergency") + F.col("number_inpatient")).alias(
            "num_prior_visits"
        ),
        flag_sum([F.col(m) != F.lit("No") for m in DIABETES_MED_COLS]).alias("num_diabetes_meds"),
        "diag_1",
        "diag_2",
        "diag_3",
        "max_glu_serum",
        "a1c_result",
        "insulin",
        "metformin",
        "had_med_change",
        "on_diabetes_med",
        "readmitted_status",
        "is_readmitted_30d",
    )


def int_admissions_enriched(stg: DataFrame) -> DataFrame:
    """Admissions with stay midpoint in days and the long-stay flag (I4)."""
    days = case_map("length_of_stay_bracket", STAY_MIDPOINT_DAYS)
    return stg.select(
        "admission_id",
        "case_id",
        "patient_id",
        "hospital_code",
        "hospital_type_code",
        "city_code_hospital",
        "hospital_region_code",
        "ward_type",
        "ward_facility_code",
        "department",
        "bed_grade",
        "available_extra_rooms",
        "city_code_patient",
        "type_of_admission",
        "severity_of_illness",
        "visitors_with_patient",
        "age_bracket",
        "admission_deposit",
        "length_of_stay_bracket",
        days.alias("length_of_stay_days"),
        (days > F.lit(LONG_STAY_DAYS)).alias("is_long_stay"),
    )
