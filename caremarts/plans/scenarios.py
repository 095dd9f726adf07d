"""Two-vintage runs over the raw tables: upsert, incremental facts, SCD2.

The second vintage is derived from the same extracts, as the seeded proofs
do: claims are split by a stable hash bucket of ``ClaimID`` (bucket 0 arrives
first, bucket 1 later), beneficiaries by a bucket of ``BeneID`` (late
arrivals), and the five smallest providers labelled ``No`` flip to ``Yes``.
Every function returns lazy DataFrames; nothing is collected, and only
``incremental_claims`` writes what several of its steps read.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caremarts.functions.columns import hash_bucket
from caremarts.operators.incremental import incremental_append
from caremarts.operators.scd2 import snapshot_providers
from caremarts.operators.upsert import load, upsert
from caremarts.plans import intermediate as I
from caremarts.plans import marts as M
from caremarts.plans import staging as S
from caremarts.plans.ingest import INGESTED_AT_COL
from caremarts.session import cut_lineage

B1 = dt.datetime(2024, 1, 1)
B2 = dt.datetime(2024, 2, 1)
B3 = dt.datetime(2024, 3, 1)

FLIP_K = 5

Raw = Callable[[str], DataFrame]  # validated rows of a raw table (unstamped)


def stamp(df: DataFrame, ts: dt.datetime) -> DataFrame:
    return df.withColumn(INGESTED_AT_COL, F.lit(ts).cast("timestamp"))


def bucket(df: DataFrame, key: str, b: int, n: int = 2) -> DataFrame:
    return df.filter(hash_bucket(key, n) == b)


# -- K1-K4 -------------------------------------------------------------------------


def upsert_merge(valid: DataFrame) -> DataFrame:
    """Bucket 0 first; then the whole extract, with a corrected (nulled)
    ``OtherPhysician`` on the claims of hash bucket 0 of 7. Known keys take
    the new values (including the nulls) and keep their first ``ingested_at``;
    bucket 1 arrives new."""
    first = upsert(None, stamp(bucket(valid, "ClaimID", 0), B1), "ClaimID", check_unique=False)
    corrected = valid.withColumn(
        "OtherPhysician",
        F.when(hash_bucket("ClaimID", 7) == 0, F.lit(None).cast("string")).otherwise(
            F.col("OtherPhysician")
        ),
    )
    return upsert(first, stamp(corrected, B2), "ClaimID", check_unique=False)


def upsert_twice(valid: DataFrame) -> DataFrame:
    """Loading the same extract twice equals loading it once."""
    once = upsert(None, stamp(valid, B1), "ClaimID", check_unique=False)
    return upsert(once, stamp(valid, B2), "ClaimID", check_unique=False)


def replace_then(valid: DataFrame) -> DataFrame:
    """Full load, then a replace load of bucket 1: only bucket 1 remains."""
    full = stamp(valid, B1)
    return load(full, stamp(bucket(valid, "ClaimID", 1), B2), "ClaimID", mode="replace")


# -- H1-H3 -------------------------------------------------------------------------


@dataclass
class IncrementalRun:
    enriched_a: DataFrame
    fct_a: DataFrame
    enriched_b: DataFrame
    fct_b: DataFrame
    fct_new_b: DataFrame
    batch_b: DataFrame  # claims added in phase B (unified)
    claims: DataFrame  # all claims (unified)


def unified_claims(raw: Raw, claim_bucket: int | None = None) -> DataFrame:
    """Both claim tables, staged and unioned; optionally one hash bucket only."""
    inp, out = raw("inpatient_claims"), raw("outpatient_claims")
    if claim_bucket is not None:
        inp, out = bucket(inp, "ClaimID", claim_bucket), bucket(out, "ClaimID", claim_bucket)
    return I.int_claims_unified(S.stg_inpatient_claims(inp), S.stg_outpatient_claims(out))


def incremental_claims(raw: Raw, on_match: str = "skip", late_beneficiaries: bool = True) -> IncrementalRun:
    """Phase A: claims of bucket 0 (and, with ``late_beneficiaries``, only
    beneficiaries of bucket 0) with a full refresh. Phase B: everything, with
    an incremental run of ``int_claims_enriched`` and then ``fct_claims``.

    The raw tables and both states of ``int_claims_enriched`` are read by several
    steps, as loaded and published tables are: each is written once.
    """
    raw = {t: cut_lineage(raw(t)) for t in ("beneficiary", "inpatient_claims", "outpatient_claims")}.__getitem__
    bene_all = S.stg_beneficiary(raw("beneficiary"))
    bene_a = S.stg_beneficiary(bucket(raw("beneficiary"), "BeneID", 0)) if late_beneficiaries else bene_all

    unified_a = unified_claims(raw, 0)
    enriched_a = cut_lineage(I.int_claims_enriched(unified_a, bene_a))
    fct_a = M.fct_claims(enriched_a)

    unified_b = unified_claims(raw, None)
    _, enriched_b = incremental_append(
        unified_b,
        enriched_a,
        "claim_id",
        lambda src: I.int_claims_enriched(src, bene_all),
        on_match=on_match,
    )
    enriched_b = cut_lineage(enriched_b)
    fct_new_b, fct_b = incremental_append(
        enriched_b, fct_a, "claim_id", M.fct_claims, on_match=on_match
    )
    return IncrementalRun(enriched_a, fct_a, enriched_b, fct_b, fct_new_b, unified_claims(raw, 1), unified_b)


# -- H4-H6, J8 -------------------------------------------------------------------


def flip_labels(raw_providers: DataFrame, k: int = FLIP_K) -> DataFrame:
    """Second vintage: the ``k`` smallest providers (by id) labelled ``No``
    become ``Yes``. The k ids come from a top-k (TakeOrderedAndProject), so the
    broadcast side is bounded by ``k``."""
    flipped = (
        raw_providers.filter(F.col("PotentialFraud") == "No")
        .select(F.col("Provider").alias("__flip"))
        .orderBy("__flip")
        .limit(k)
    )
    return (
        raw_providers.join(F.broadcast(flipped), F.col("Provider") == F.col("__flip"), "left")
        .withColumn(
            "PotentialFraud",
            F.when(F.col("__flip").isNotNull(), F.lit("Yes")).otherwise(F.col("PotentialFraud")),
        )
        .drop("__flip")
    )


def history_two_vintages(raw_providers: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(history after the first snapshot, history after the flip snapshot)."""
    h1 = snapshot_providers(None, raw_providers, B1)
    h2 = snapshot_providers(h1, flip_labels(raw_providers), B2)
    return h1, h2


def history_delete_reappear(raw_providers: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Bucket 1 of providers vanishes at B2 and comes back at B3.

    Returns (history after the deletion, history after the reappearance).
    """
    h1 = snapshot_providers(None, raw_providers, B1)
    h2 = snapshot_providers(h1, bucket(raw_providers, "Provider", 0), B2)
    h3 = snapshot_providers(h2, raw_providers, B3)
    return h2, h3


def claims_with_arrival(raw: Raw) -> DataFrame:
    """Raw claims (both tables) after bucket 0 at B1 and an upsert of all at B2."""
    parts = []
    for t in ("inpatient_claims", "outpatient_claims"):
        valid = raw(t)
        first = upsert(None, stamp(bucket(valid, "ClaimID", 0), B1), "ClaimID", check_unique=False)
        parts.append(
            upsert(first, stamp(valid, B2), "ClaimID", check_unique=False).select(
                "ClaimID", "Provider", INGESTED_AT_COL
            )
        )
    return parts[0].unionByName(parts[1])
