"""Ingest of the six raw tables (E3): prepare -> validate -> stamp.

Produces, per table, the validation result and the batch to load into the raw
layer (valid rows + ``ingested_at``). Loading itself (upsert / replace into a
versioned table) is ``operators.upsert`` + ``warehouse``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caremarts.operators.contracts import CONTRACTS
from caremarts.operators.prepare import (
    prepare_beneficiary,
    prepare_claims,
    prepare_diabetes,
    prepare_hospital,
    prepare_providers,
)
from caremarts.operators.validate import Validation, validate
from caremarts.sources.csv import na_token_recode
from caremarts.sources.fixtures import RawSources

INGESTED_AT_COL = "ingested_at"

# Ingest order of the loaders.
TABLE_ORDER = (
    "beneficiary",
    "inpatient_claims",
    "outpatient_claims",
    "providers",
    "diabetes_encounters",
    "hospital_admissions",
)

NATURAL_KEYS = {name: CONTRACTS[name].key for name in TABLE_ORDER}


def prepared_sources(raw: RawSources) -> dict[str, DataFrame]:
    """Each source cleaned up to (not including) validation.

    ``na_token_recode`` stands in for the text reader's missing-token parsing
    (S3) on extracts that did not come through ``read_source``.
    """
    na = na_token_recode
    return {
        "beneficiary": prepare_beneficiary(na(raw.beneficiary_train), na(raw.beneficiary_test)),
        "inpatient_claims": prepare_claims(na(raw.inpatient)),
        "outpatient_claims": prepare_claims(na(raw.outpatient)),
        "providers": prepare_providers(na(raw.providers_train), na(raw.providers_test)),
        "diabetes_encounters": prepare_diabetes(na(raw.diabetes)),
        "hospital_admissions": prepare_hospital(na(raw.hospital)),
    }


def validate_one(raw: RawSources, table: str) -> Validation:
    return validate(prepared_sources(raw)[table], CONTRACTS[table])


def validate_all(raw: RawSources) -> dict[str, Validation]:
    prepared = prepared_sources(raw)
    return {t: validate(prepared[t], CONTRACTS[t]) for t in TABLE_ORDER}


def stamp(df: DataFrame, ingested_at: dt.datetime) -> DataFrame:
    """K3: one batch timestamp on every row of every table of a run."""
    return df.withColumn(INGESTED_AT_COL, F.lit(ingested_at).cast("timestamp"))


def load_batch(v: Validation, ingested_at: dt.datetime) -> DataFrame:
    """The rows a run loads into a raw table: valid rows, stamped."""
    return stamp(v.valid, ingested_at)
