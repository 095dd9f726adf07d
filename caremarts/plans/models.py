"""Model graph: raw tables -> staging -> intermediate -> marts.

``Models`` wires the pure model functions over a mapping of raw tables
(anything that yields DataFrames: a fresh ingest batch, or the current
versions in the warehouse). Nothing runs until an action is taken.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from caremarts.plans import intermediate as I
from caremarts.plans import marts as M
from caremarts.plans import staging as S
from caremarts.sources import seeds


@dataclass
class Models:
    spark: SparkSession
    raw: Callable[[str], DataFrame]  # raw table name -> DataFrame
    snapshot: DataFrame | None = None  # SCD2 history of the provider label

    # staging
    @cached_property
    def stg_beneficiary(self) -> DataFrame:
        return S.stg_beneficiary(self.raw("beneficiary"))

    @cached_property
    def stg_inpatient_claims(self) -> DataFrame:
        return S.stg_inpatient_claims(self.raw("inpatient_claims"))

    @cached_property
    def stg_outpatient_claims(self) -> DataFrame:
        return S.stg_outpatient_claims(self.raw("outpatient_claims"))

    @cached_property
    def stg_providers(self) -> DataFrame:
        return S.stg_providers(self.raw("providers"))

    @cached_property
    def stg_diabetes_encounters(self) -> DataFrame:
        return S.stg_diabetes_encounters(self.raw("diabetes_encounters"))

    @cached_property
    def stg_hospital_admissions(self) -> DataFrame:
        return S.stg_hospital_admissions(self.raw("hospital_admissions"))

    # intermediate
    @cached_property
    def int_claims_unified(self) -> DataFrame:
        return I.int_claims_unified(self.stg_inpatient_claims, self.stg_outpatient_claims)

    @cached_property
    def int_claims_enriched(self) -> DataFrame:
        return I.int_claims_enriched(self.int_claims_unified, self.stg_beneficiary)

    @cached_property
    def int_encounters_enriched(self) -> DataFrame:
        return I.int_encounters_enriched(self.stg_diabetes_encounters)

    @cached_property
    def int_admissions_enriched(self) -> DataFrame:
        return I.int_admissions_enriched(self.stg_hospital_admissions)

    # seeds
    @cached_property
    def admission_type_mapping(self) -> DataFrame:
        return seeds.admission_type_mapping(self.spark)

    @cached_property
    def severity_mapping(self) -> DataFrame:
        return seeds.severity_mapping(self.spark)

    # marts (full builds)
    @cached_property
    def fct_claims(self) -> DataFrame:
        return M.fct_claims(self.int_claims_enriched)

    @cached_property
    def dim_beneficiary(self) -> DataFrame:
        return M.dim_beneficiary(self.stg_beneficiary)

    @cached_property
    def dim_provider(self) -> DataFrame:
        return M.dim_provider(self.stg_providers, self.int_claims_unified)

    @cached_property
    def dim_provider_history(self) -> DataFrame:
        if self.snapshot is None:
            raise ValueError("dim_provider_history needs the provider snapshot")
        return M.dim_provider_history(self.snapshot)

    @cached_property
    def fct_encounters(self) -> DataFrame:
        return M.fct_encounters(self.int_encounters_enriched)

    @cached_property
    def dim_patient(self) -> DataFrame:
        return M.dim_patient(self.stg_diabetes_encounters)

    @cached_property
    def dim_admission_type(self) -> DataFrame:
        return M.dim_admission_type(self.admission_type_mapping)

    @cached_property
    def fct_hospital_admissions(self) -> DataFrame:
        return M.fct_hospital_admissions(self.int_admissions_enriched)

    @cached_property
    def dim_hospital_patient(self) -> DataFrame:
        return M.dim_hospital_patient(self.int_admissions_enriched)

    @cached_property
    def dim_severity(self) -> DataFrame:
        return M.dim_severity(self.severity_mapping)

    def mart(self, name: str) -> DataFrame:
        if name not in MART_NAMES:
            raise KeyError(name)
        return getattr(self, name)


MART_NAMES = (
    "fct_claims",
    "dim_beneficiary",
    "dim_provider",
    "dim_provider_history",
    "fct_encounters",
    "dim_patient",
    "dim_admission_type",
    "fct_hospital_admissions",
    "dim_hospital_patient",
    "dim_severity",
)

#: The tables of the warehouse that each published model reads, as ``layer/table``.
MART_READS = {
    "int_claims_enriched": ("raw/inpatient_claims", "raw/outpatient_claims", "raw/beneficiary"),
    "fct_claims": ("marts/int_claims_enriched",),
    "dim_beneficiary": ("raw/beneficiary",),
    "dim_provider": ("raw/providers", "raw/inpatient_claims", "raw/outpatient_claims"),
    "dim_provider_history": ("snapshots/snap_provider_fraud",),
    "fct_encounters": ("raw/diabetes_encounters",),
    "dim_patient": ("raw/diabetes_encounters",),
    "dim_admission_type": (),
    "fct_hospital_admissions": ("raw/hospital_admissions",),
    "dim_hospital_patient": ("raw/hospital_admissions",),
    "dim_severity": (),
}
