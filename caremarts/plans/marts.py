"""Mart models (M1-M10): three independent star schemas.

Facts are built from their enriched relation; incremental maintenance of a
fact lives in ``operators.incremental``. Dimensions are full rebuilds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caremarts.functions.columns import exact_ratio, flag_sum
from caremarts.plans.staging import CHRONIC_FLAG_NAMES, DIAGNOSIS_NAMES, PROCEDURE_NAMES

FCT_CLAIMS_COLUMNS = (
    "claim_id",
    "bene_id",
    "provider_id",
    "claim_type",
    "claim_start_date",
    "claim_end_date",
    "admission_date",
    "discharge_date",
    "claim_duration_days",
    "reimbursement_amount",
    "deductible_amount",
    "age_at_claim",
    "attending_physician",
    "operating_physician",
    "other_physician",
    "admit_diagnosis_code",
    "diagnosis_group_code",
    *DIAGNOSIS_NAMES,
    *PROCEDURE_NAMES,
)

FCT_ENCOUNTERS_COLUMNS = (
    "encounter_id",
    "patient_nbr",
    "admission_type_id",
    "discharge_disposition_id",
    "admission_source_id",
    "medical_specialty",
    "age_bracket",
    "time_in_hospital",
    "num_lab_procedures",
    "num_procedures",
    "num_medications",
    "number_outpatient",
    "number_emergency",
    "number_inpatient",
    "number_diagnoses",
    "num_prior_visits",
    "num_diabetes_meds",
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

FCT_ADMISSIONS_COLUMNS = (
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
    "city_code_patient",
    "type_of_admission",
    "severity_of_illness",
    "age_bracket",
    "available_extra_rooms",
    "visitors_with_patient",
    "admission_deposit",
    "length_of_stay_bracket",
    "length_of_stay_days",
    "is_long_stay",
)

MONEY = "decimal(12,2)"


# -- claims star ---------------------------------------------------------------


def fct_claims(claims_enriched: DataFrame) -> DataFrame:
    """M1: one row per claim (the incremental boundary is applied by the caller)."""
    return claims_enriched.select(*FCT_CLAIMS_COLUMNS)


def dim_beneficiary(stg_beneficiary: DataFrame) -> DataFrame:
    """M2: beneficiary attributes plus the count of chronic conditions."""
    return stg_beneficiary.select(
        "bene_id",
        "date_of_birth",
        "date_of_death",
        "gender",
        "race",
        "renal_disease_indicator",
        "state_code",
        "county_code",
        "months_part_a_coverage",
        "months_part_b_coverage",
        *CHRONIC_FLAG_NAMES,
        F.col("ip_annual_reimbursement").alias("total_ip_reimbursement"),
        F.col("op_annual_reimbursement").alias("total_op_reimbursement"),
        flag_sum(CHRONIC_FLAG_NAMES).alias("chronic_condition_count"),
    )


def provider_claim_metrics(claims: DataFrame) -> DataFrame:
    """Per-provider claim count, amount, distinct beneficiaries, mean amount.

    Partial + final hash aggregation; the distinct count is planned as an
    aggregate on (provider, beneficiary) first, so even a provider with a
    third of all claims spreads over many tasks.
    """
    return claims.groupBy("provider_id").agg(
        F.count(F.lit(1)).alias("total_claims"),
        F.sum("reimbursement_amount").alias("total_reimbursement"),
        F.count_distinct("bene_id").alias("unique_beneficiaries"),
        F.sum("reimbursement_amount").alias("__sum_amt"),
        F.count("reimbursement_amount").alias("__n_amt"),
    )


def dim_provider(stg_providers: DataFrame, claims_unified: DataFrame) -> DataFrame:
    """M3: every provider with its claim metrics; no claims -> zeros."""
    m = provider_claim_metrics(claims_unified).withColumnRenamed("provider_id", "__m_provider")
    joined = stg_providers.join(m, F.col("provider_id") == F.col("__m_provider"), "left")
    avg = exact_ratio("__sum_amt", "__n_amt", 2).cast(MONEY)
    return joined.select(
        "provider_id",
        "is_potential_fraud",
        F.coalesce(F.col("total_claims"), F.lit(0)).cast("bigint").alias("total_claims"),
        F.coalesce(F.col("total_reimbursement"), F.lit(0)).alias("total_reimbursement"),
        F.coalesce(F.col("unique_beneficiaries"), F.lit(0)).cast("bigint").alias(
            "unique_beneficiaries"
        ),
        F.coalesce(avg, F.lit(0).cast(MONEY)).alias("avg_reimbursement_per_claim"),
    )


def dim_provider_history(snapshot: DataFrame) -> DataFrame:
    """M4, H6: validity windows of the fraud label."""
    return snapshot.select(
        "provider_id",
        "is_potential_fraud",
        "valid_from",
        "valid_to",
        F.col("valid_to").isNull().alias("is_current"),
    )


# -- diabetes star ---------------------------------------------------------------


def fct_encounters(encounters_enriched: DataFrame) -> DataFrame:
    """M5: one row per encounter."""
    return encounters_enriched.select(*FCT_ENCOUNTERS_COLUMNS)


def dim_patient(stg_encounters: DataFrame) -> DataFrame:
    """M6: demographics of the numerically latest encounter plus readmission rollup.

    One aggregate: ``max_by`` picks the latest encounter's demographics in the
    same partial/final aggregation as the counts, so there is no second pass
    and no join; a patient with very many encounters is combined map-side.
    """
    readmit = F.when(F.col("is_readmitted_30d"), 1).otherwise(0)
    latest = F.max_by(
        F.struct("race", "gender", "age_bracket"), F.col("encounter_id").cast("bigint")
    )
    agg = stg_encounters.groupBy("patient_nbr").agg(
        latest.alias("__latest"),
        F.count(F.lit(1)).alias("total_encounters"),
        F.sum(readmit).alias("num_readmissions_30d"),
    )
    return agg.select(
        "patient_nbr",
        F.col("__latest.race").alias("race"),
        F.col("__latest.gender").alias("gender"),
        F.col("__latest.age_bracket").alias("latest_age_bracket"),
        F.col("total_encounters").cast("bigint").alias("total_encounters"),
        F.col("num_readmissions_30d").cast("bigint").alias("num_readmissions_30d"),
        exact_ratio("num_readmissions_30d", "total_encounters", 4)
        .cast("decimal(18,4)")
        .alias("readmission_30d_rate"),
    )


def dim_admission_type(admission_type_mapping: DataFrame) -> DataFrame:
    """M7: the admission-type seed as a dimension."""
    return admission_type_mapping.select("admission_type_id", "admission_type_label")


# -- hospital star ---------------------------------------------------------------


def fct_hospital_admissions(admissions_enriched: DataFrame) -> DataFrame:
    """M8: one row per admission."""
    return admissions_enriched.select(*FCT_ADMISSIONS_COLUMNS)


def dim_hospital_patient(admissions_enriched: DataFrame) -> DataFrame:
    """M9: behavioural rollup per patient."""
    agg = admissions_enriched.groupBy("patient_id").agg(
        F.count(F.lit(1)).alias("total_admissions"),
        F.count_distinct("hospital_code").alias("distinct_hospitals"),
        F.sum("length_of_stay_days").alias("total_length_of_stay_days"),
        F.count("length_of_stay_days").alias("__n_los"),
        F.sum("admission_deposit").alias("total_admission_deposit"),
        F.count("admission_deposit").alias("__n_dep"),
    )
    return agg.select(
        "patient_id",
        F.col("total_admissions").cast("bigint").alias("total_admissions"),
        F.col("distinct_hospitals").cast("bigint").alias("distinct_hospitals"),
        exact_ratio("total_length_of_stay_days", "__n_los", 2)
        .cast("decimal(18,2)")
        .alias("avg_length_of_stay_days"),
        F.col("total_length_of_stay_days").cast("bigint").alias("total_length_of_stay_days"),
        F.col("total_admission_deposit").cast("decimal(38,4)").alias("total_admission_deposit"),
        exact_ratio("total_admission_deposit", "__n_dep", 2)
        .cast("decimal(18,2)")
        .alias("avg_admission_deposit"),
    )


def dim_severity(severity_mapping: DataFrame) -> DataFrame:
    """The severity seed as a dimension."""
    return severity_mapping.select("severity_of_illness", "severity_rank", "severity_description")
