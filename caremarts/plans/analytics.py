"""Documented analytical questions over the marts.

Seed joins broadcast the seed (a fixed handful of rows); everything else is a
partially aggregated ``groupBy`` or a shuffle join chosen by AQE.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caremarts.functions.columns import exact_ratio
from caremarts.operators.joins import as_of
from caremarts.sources.seeds import seed_join


def avg_stay_by_severity(fct_admissions: DataFrame, dim_severity: DataFrame) -> DataFrame:
    """Admissions and mean stay (days) per severity, with its rank."""
    agg = fct_admissions.groupBy("severity_of_illness").agg(
        F.count(F.lit(1)).alias("admissions"),
        F.sum("length_of_stay_days").alias("__days"),
        F.count("length_of_stay_days").alias("__n"),
    )
    return seed_join(agg, dim_severity, "severity_of_illness").select(
        "severity_of_illness",
        "severity_rank",
        F.col("admissions").cast("bigint").alias("admissions"),
        exact_ratio("__days", "__n", 2).cast("decimal(18,2)").alias("avg_length_of_stay_days"),
    )


def providers_by_fraud_label(dim_provider: DataFrame) -> DataFrame:
    """N2."""
    return dim_provider.groupBy("is_potential_fraud").agg(
        F.count(F.lit(1)).cast("bigint").alias("providers")
    )


def readmission_rate(fct_encounters: DataFrame) -> DataFrame:
    """Share of encounters readmitted within 30 days (null counts as no)."""
    return fct_encounters.agg(
        F.count(F.lit(1)).cast("bigint").alias("encounters"),
        F.sum(F.when(F.col("is_readmitted_30d"), 1).otherwise(0)).cast("bigint").alias("readmitted_30d"),
    ).select(
        "encounters",
        "readmitted_30d",
        exact_ratio("readmitted_30d", "encounters", 4).cast("decimal(18,4)").alias("readmission_30d_rate"),
    )


def long_stay_share(fct_admissions: DataFrame) -> DataFrame:
    """Share of admissions staying more than 30 days."""
    return fct_admissions.agg(
        F.count(F.lit(1)).cast("bigint").alias("admissions"),
        F.sum(F.when(F.col("is_long_stay"), 1).otherwise(0)).cast("bigint").alias("long_stays"),
    ).select(
        "admissions",
        "long_stays",
        exact_ratio("long_stays", "admissions", 4).cast("decimal(18,4)").alias("long_stay_share"),
    )


def claims_by_provider_label(fct_claims: DataFrame, dim_provider: DataFrame) -> DataFrame:
    """Claims and amounts by the provider's fraud label (fact -> dimension).

    The fact is pre-aggregated per provider before the join, so the join
    touches one row per provider whatever the claim volume or skew.
    """
    per_provider = fct_claims.groupBy("provider_id").agg(
        F.count(F.lit(1)).alias("__n"), F.sum("reimbursement_amount").alias("__amt")
    )
    joined = per_provider.join(dim_provider.select("provider_id", "is_potential_fraud"), "provider_id")
    return joined.groupBy("is_potential_fraud").agg(
        F.sum("__n").cast("bigint").alias("claims"),
        F.sum("__amt").cast("decimal(38,2)").alias("total_reimbursement"),
    )


def first_flagged(history: DataFrame) -> DataFrame:
    """When each provider was first seen flagged."""
    return (
        history.filter(F.col("is_potential_fraud"))
        .groupBy("provider_id")
        .agg(F.min("valid_from").alias("first_flagged_at"))
    )


def label_as_of(claims: DataFrame, history: DataFrame, time_col: str) -> DataFrame:
    """Each claim's provider label as known at ``time_col``."""
    return as_of(
        claims.select(
            F.col("ClaimID").alias("claim_id"), F.col("Provider").alias("provider_id"), time_col
        ),
        history.select("provider_id", "is_potential_fraud", "valid_from", "valid_to"),
        "provider_id",
        time_col,
    ).select("claim_id", "provider_id", time_col, "is_potential_fraud")


def repeat_admission_cohort(dim_hospital_patient: DataFrame) -> DataFrame:
    """Patients admitted more than once."""
    return dim_hospital_patient.filter(F.col("total_admissions") > 1)


def encounters_by_admission_type(
    fct_encounters: DataFrame, dim_admission_type: DataFrame
) -> DataFrame:
    """Encounters and readmission rate per labelled admission type."""
    agg = fct_encounters.groupBy("admission_type_id").agg(
        F.count(F.lit(1)).alias("encounters"),
        F.sum(F.when(F.col("is_readmitted_30d"), 1).otherwise(0)).alias("readmitted_30d"),
    )
    return seed_join(agg, dim_admission_type, "admission_type_id").select(
        "admission_type_id",
        "admission_type_label",
        F.col("encounters").cast("bigint").alias("encounters"),
        exact_ratio("readmitted_30d", "encounters", 4).cast("decimal(18,4)").alias("readmission_30d_rate"),
    )


def reconcile_provider_claims(dim_provider: DataFrame, fct_claims: DataFrame) -> DataFrame:
    """A10: the providers' claim counts add up to the fact's row count.

    Holds only when every claim's provider is known (the dimension drops
    unknown providers). Two one-row aggregates stacked and folded; no join.
    """
    parts = dim_provider.agg(F.sum("total_claims").cast("bigint").alias("v")).select(
        F.lit("provider_claims").alias("k"), "v"
    ).unionByName(
        fct_claims.agg(F.count(F.lit(1)).cast("bigint").alias("v")).select(F.lit("fact_rows").alias("k"), "v")
    )
    wide = parts.agg(
        F.max(F.when(F.col("k") == "provider_claims", F.col("v"))).alias("provider_claims"),
        F.max(F.when(F.col("k") == "fact_rows", F.col("v"))).alias("fact_rows"),
    )
    return wide.withColumn("reconciled", F.col("provider_claims") == F.col("fact_rows"))
