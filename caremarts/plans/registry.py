"""Registered queries: every operator as a DataFrame over the test tables.

Each entry takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
whole tables in ``sf_dir``; only ``check_suite``, ``proof_incremental`` and the
incremental queries write tables that many of their branches read. Queries share nothing
and cache nothing. The six raw extracts are the clinical fixture views, and every query runs the operator's real work on them (stateful ones
apply two batches derived from the same tables). Output columns are aliased
and typed to match the DuckDB oracle one-for-one.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caremarts.functions.columns import hash_bucket
from caremarts.operators.prepare import (
    SPLIT_RANK_COL,
    bracket_recode,
    dedup_keep_first,
    mint_admission_id,
    sentinel_recode,
    split_union,
)
from caremarts.operators.contracts import CONTRACTS
from caremarts.operators.validate import REASONS_COL, Validation, ingest_summary, validate
from caremarts.operators import quality as Q
from caremarts.plans import analytics as A
from caremarts.plans import faults as X
from caremarts.plans import ingest
from caremarts.plans import marts as M
from caremarts.plans import proofs as P
from caremarts.plans import scenarios as SC
from caremarts.operators.scd2 import snapshot_first
from caremarts.plans.models import Models
from caremarts.session import configure, cut_lineage
from caremarts.sources.csv import na_token_recode
from caremarts.sources.fixtures import RawSources, raw_sources

# Fixed batch times of the registered stateful queries (first and second run).
BATCH_1 = dt.datetime(2024, 1, 1, 0, 0, 0)
BATCH_2 = dt.datetime(2024, 2, 1, 0, 0, 0)

Query = Callable[[SparkSession, str], DataFrame]


class Context:
    """Shared lazy building blocks for one (session, test-data directory)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        configure(spark)
        self.spark = spark
        self.sf_dir = sf_dir
        self._validations: dict[str, Validation] = {}

    @cached_property
    def sources(self) -> RawSources:
        return raw_sources(self.spark, self.sf_dir)

    @cached_property
    def prepared(self) -> dict[str, DataFrame]:
        return ingest.prepared_sources(self.sources)

    def validation(self, table: str) -> Validation:
        if table not in self._validations:
            self._validations[table] = validate(self.prepared[table], CONTRACTS[table])
        return self._validations[table]

    def valid(self, table: str) -> DataFrame:
        """Validated rows of a raw table, not yet stamped."""
        return self.validation(table).valid

    def raw(self, table: str) -> DataFrame:
        """The raw table after one full ingest at ``BATCH_1``."""
        return ingest.load_batch(self.validation(table), BATCH_1)

    @cached_property
    def models(self) -> Models:
        snap = snapshot_first(self.raw("providers"), BATCH_1)
        return Models(self.spark, self.raw, snapshot=snap)


def context(spark: SparkSession, sf_dir: str) -> Context:
    """A context of its own for each query: nothing is shared or cached between queries."""
    return Context(spark, sf_dir)


def _model(name: str, casts: dict[str, str] | None = None) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = getattr(context(spark, sf_dir).models, name)
        for col, typ in (casts or {}).items():
            df = df.withColumn(col, F.col(col).cast(typ))
        return df

    run.__name__ = name
    return run


# -- frame preparation -------------------------------------------------------------


def q_split_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = context(spark, sf_dir).sources
    return split_union(s.beneficiary_train, s.beneficiary_test).withColumnRenamed(
        SPLIT_RANK_COL, "split_rank"
    )


def q_dedup_keep_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = context(spark, sf_dir).sources
    return dedup_keep_first(split_union(s.providers_train, s.providers_test), "Provider").drop(
        SPLIT_RANK_COL
    )


def q_na_token_recode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return na_token_recode(context(spark, sf_dir).sources.diabetes)


def q_sentinel_recode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentinel_recode(na_token_recode(context(spark, sf_dir).sources.diabetes))


def q_bracket_recode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bracket_recode(context(spark, sf_dir).sources.hospital)


def q_surrogate_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mint_admission_id(context(spark, sf_dir).sources.hospital).select(
        "admission_id", "case_id", "patientid"
    )


def q_hash_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = context(spark, sf_dir).sources
    claims = s.inpatient.select("ClaimID").unionByName(s.outpatient.select("ClaimID"))
    return claims.select(
        "ClaimID",
        hash_bucket("ClaimID", 2).alias("bucket_2"),
        hash_bucket("ClaimID", 7).alias("bucket_7"),
    )


# -- contracts ----------------------------------------------------------------------


def _valid(table: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return context(spark, sf_dir).validation(table).valid

    return run


def _with_reasons(v: Validation) -> DataFrame:
    return v.rejected.withColumn("reject_reasons", F.array_join(REASONS_COL, ";")).drop(REASONS_COL)


def _rejects(table: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _with_reasons(context(spark, sf_dir).validation(table))

    return run


def q_rejects_providers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Providers of a bucket come twice: the extract itself holds no bad provider."""
    df = X.repeated(context(spark, sf_dir).prepared["providers"], "Provider")
    return _with_reasons(validate(df, CONTRACTS["providers"]))


def q_rejects_bad_encounters(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = X.bad_encounters(context(spark, sf_dir).prepared["diabetes_encounters"])
    return _with_reasons(validate(df, CONTRACTS["diabetes_encounters"]))


def q_valid_bad_encounters(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = X.bad_encounters(context(spark, sf_dir).prepared["diabetes_encounters"])
    return validate(df, CONTRACTS["diabetes_encounters"]).valid


def q_dedup_by_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Beneficiaries of which a bucket comes again later, in another state: the earlier row stays."""
    s = context(spark, sf_dir).sources
    once = dedup_keep_first(s.beneficiary_train, "BeneID")
    later = once.where(X.hit("BeneID")).withColumn("State", F.lit(0).cast(once.schema["State"].dataType))
    rows = once.withColumn("row_number", F.lit(1)).unionByName(later.withColumn("row_number", F.lit(2)))
    return dedup_keep_first(rows, "BeneID", order=["row_number"])


def q_ingest_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    ctx = context(spark, sf_dir)
    return ingest_summary({t: ctx.validation(t) for t in ingest.TABLE_ORDER})


CONTRACT_TABLES = ingest.TABLE_ORDER


# -- loads, incremental, history ------------------------------------------------------


def q_upsert_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return SC.upsert_merge(context(spark, sf_dir).valid("inpatient_claims"))


def q_upsert_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return SC.upsert_twice(context(spark, sf_dir).valid("inpatient_claims"))


def q_replace_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return SC.replace_then(context(spark, sf_dir).valid("inpatient_claims"))


def q_incremental_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    return SC.incremental_claims(context(spark, sf_dir).valid).fct_b


def q_incremental_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    return SC.incremental_claims(context(spark, sf_dir).valid, on_match="replace").fct_b


def q_scd2_two_vintages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return SC.history_two_vintages(context(spark, sf_dir).valid("providers"))[1]


def q_scd2_hard_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    return SC.history_delete_reappear(context(spark, sf_dir).valid("providers"))[1]


def q_provider_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = SC.history_two_vintages(context(spark, sf_dir).valid("providers"))[1]
    return M.dim_provider_history(h)


def q_label_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    ctx = context(spark, sf_dir)
    h = SC.history_two_vintages(ctx.valid("providers"))[1]
    return A.label_as_of(SC.claims_with_arrival(ctx.valid), h, "ingested_at")


# -- checks -------------------------------------------------------------------------------


def _on_models(fn: Callable[[Models], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(context(spark, sf_dir).models)

    return run


#: Models with a join or a grouping that several tests read.
JOINED_MODELS = ("int_claims_enriched", "dim_provider", "dim_patient", "dim_hospital_patient")


def q_check_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All tests over raw tables and joined models that are written once in the shared folder."""
    ctx = context(spark, sf_dir)
    raw = {t: cut_lineage(ctx.raw(t)) for t in ingest.TABLE_ORDER}
    models = Models(spark, raw.__getitem__, snapshot=snapshot_first(raw["providers"], BATCH_1))
    for name in JOINED_MODELS:  # in this order: a model reads the ones before it as they were written
        setattr(models, name, cut_lineage(getattr(models, name)))
    return Q.run_suite(models)


def q_check_history_no_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second = SC.history_two_vintages(context(spark, sf_dir).valid("providers"))
    return Q.check_history_no_overlap(M.dim_provider_history(X.overlapping_history(first, second)))


def q_check_history_one_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = SC.history_delete_reappear(context(spark, sf_dir).valid("providers"))[0]
    return Q.check_history_one_current(M.dim_provider_history(h))


def q_proof_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.proof_incremental(context(spark, sf_dir).valid)


def q_proof_scd2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.proof_scd2(context(spark, sf_dir).valid("providers"))


def q_first_flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = SC.history_two_vintages(context(spark, sf_dir).valid("providers"))[1]
    return A.first_flagged(h)


def registry() -> dict[str, Query]:
    out: dict[str, Query] = {
        # staging
        "stg_beneficiary": _model("stg_beneficiary"),
        "stg_inpatient_claims": _model("stg_inpatient_claims"),
        "stg_outpatient_claims": _model("stg_outpatient_claims"),
        "stg_providers": _model("stg_providers"),
        "stg_diabetes_encounters": _model("stg_diabetes_encounters"),
        "stg_hospital_admissions": _model("stg_hospital_admissions"),
        # intermediate
        "int_claims_unified": _model("int_claims_unified"),
        "int_claims_enriched": _model("int_claims_enriched"),
        "int_encounters_enriched": _model("int_encounters_enriched"),
        "int_admissions_enriched": _model("int_admissions_enriched"),
        # marts
        "fct_claims": _model("fct_claims"),
        "dim_beneficiary": _model("dim_beneficiary"),
        "dim_provider": _model("dim_provider", {"total_reimbursement": "decimal(38,2)"}),
        "dim_provider_history": _model("dim_provider_history"),
        "fct_encounters": _model("fct_encounters"),
        "dim_patient": _model("dim_patient"),
        "fct_hospital_admissions": _model("fct_hospital_admissions"),
        "dim_hospital_patient": _model("dim_hospital_patient"),
        # preparation
        "split_union": q_split_union,
        "dedup_keep_first": q_dedup_keep_first,
        "na_token_recode": q_na_token_recode,
        "sentinel_recode": q_sentinel_recode,
        "bracket_recode": q_bracket_recode,
        "surrogate_key": q_surrogate_key,
        "hash_bucket": q_hash_bucket,
        "ingest_summary": q_ingest_summary,
    }
    for t in CONTRACT_TABLES:
        out[f"contract_valid_{t}"] = _valid(t)
        out[f"contract_rejects_{t}"] = _rejects(t)
    out["contract_rejects_providers"] = q_rejects_providers
    out["contract_rejects_bad_encounters"] = q_rejects_bad_encounters
    out["contract_valid_bad_encounters"] = q_valid_bad_encounters
    out["dedup_by_row"] = q_dedup_by_row
    out.update(
        {
            # loads, incremental facts, history
            "upsert_merge": q_upsert_merge,
            "upsert_idempotent": q_upsert_idempotent,
            "replace_load": q_replace_load,
            "incremental_append": q_incremental_append,
            "incremental_replace": q_incremental_replace,
            "scd2_two_vintages": q_scd2_two_vintages,
            "scd2_hard_delete": q_scd2_hard_delete,
            "provider_history": q_provider_history,
            "label_as_of": q_label_as_of,
            # data-quality checks
            "check_unique": _on_models(
                lambda m: Q.check_unique(X.repeated(m.int_claims_unified, "claim_id"), "claim_id")
            ),
            "check_not_null": _on_models(
                lambda m: Q.check_not_null(
                    X.changed(m.fct_claims, "claim_id", "bene_id", F.lit(None)), "bene_id"
                )
            ),
            "check_accepted_values": _on_models(
                lambda m: Q.check_accepted_values(
                    X.changed(m.stg_beneficiary, "bene_id", "race", F.concat(F.lit("not "), F.col("race"))),
                    "race",
                    Q.RACES,
                )
            ),
            "check_relationships": _on_models(
                lambda m: Q.check_relationships(
                    m.fct_encounters, "patient_nbr", X.without(m.dim_patient, "patient_nbr"), "patient_nbr"
                )
            ),
            "check_relationships_warn": _on_models(
                lambda m: Q.check_relationships(
                    m.fct_claims, "bene_id", m.dim_beneficiary, "bene_id"
                ).select("claim_id", "bene_id")
            ),
            "check_age_at_claim": _on_models(lambda m: Q.check_age_at_claim(m.int_claims_enriched)),
            "check_claim_dates_ordered": _on_models(
                lambda m: Q.check_claim_dates_ordered(m.int_claims_enriched)
            ),
            "check_reimbursement_non_negative": _on_models(
                lambda m: Q.check_reimbursement_non_negative(
                    X.changed(m.fct_claims, "claim_id", "reimbursement_amount", F.lit(-1))
                )
            ),
            "check_length_of_stay": _on_models(
                lambda m: Q.check_length_of_stay(
                    X.changed(
                        X.changed(m.fct_hospital_admissions, "admission_id", "length_of_stay_days", F.lit(None)),
                        "admission_id",
                        "length_of_stay_days",
                        F.lit(-5),
                        bucket=1,
                    )
                )
            ),
            "check_long_stay_flag": _on_models(
                lambda m: Q.check_long_stay_flag(
                    X.changed(m.fct_hospital_admissions, "admission_id", "is_long_stay", ~F.col("is_long_stay"))
                )
            ),
            "check_readmitted_flag": _on_models(
                lambda m: Q.check_readmitted_flag(
                    X.changed(m.fct_encounters, "encounter_id", "is_readmitted_30d", ~F.col("is_readmitted_30d"))
                )
            ),
            "check_history_no_overlap": q_check_history_no_overlap,
            "check_history_one_current": q_check_history_one_current,
            "check_mart_row_counts": _on_models(Q.mart_row_counts),
            "check_suite": q_check_suite,
            # seeded proofs
            "proof_incremental": q_proof_incremental,
            "proof_scd2": q_proof_scd2,
            # analytical questions
            "avg_stay_by_severity": _on_models(
                lambda m: A.avg_stay_by_severity(m.fct_hospital_admissions, m.dim_severity)
            ),
            "providers_by_fraud_label": _on_models(
                lambda m: A.providers_by_fraud_label(m.dim_provider)
            ),
            "readmission_rate": _on_models(lambda m: A.readmission_rate(m.fct_encounters)),
            "long_stay_share": _on_models(lambda m: A.long_stay_share(m.fct_hospital_admissions)),
            "claims_by_provider_label": _on_models(
                lambda m: A.claims_by_provider_label(m.fct_claims, m.dim_provider)
            ),
            "first_flagged": q_first_flagged,
            "reconcile_provider_claims": _on_models(
                lambda m: A.reconcile_provider_claims(m.dim_provider, m.fct_claims)
            ),
            "repeat_admission_cohort": _on_models(
                lambda m: A.repeat_admission_cohort(m.dim_hospital_patient)
            ),
            "repeat_urgent_surgery_cohort": _on_models(
                lambda m: A.repeat_admission_cohort(
                    M.dim_hospital_patient(
                        m.fct_hospital_admissions.where(
                            "department = 'surgery' and type_of_admission = 'Urgent' and severity_of_illness = 'Extreme'"
                        )
                    )
                )
            ),
            "encounters_by_admission_type": _on_models(
                lambda m: A.encounters_by_admission_type(m.fct_encounters, m.dim_admission_type)
            ),
        }
    )
    return out
