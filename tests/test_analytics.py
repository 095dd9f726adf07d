"""Point-in-time label lookup and claim-count reconciliation."""

from __future__ import annotations

import datetime as dt

from caremarts.operators.joins import as_of
from caremarts.plans.analytics import reconcile_provider_claims


def test_as_of_picks_the_version_valid_at_the_time(spark):
    t = lambda d: dt.datetime(2024, 1, d)
    history = spark.createDataFrame(
        [("P1", False, t(1), t(10)), ("P1", True, t(10), None)],
        "provider_id string, is_potential_fraud boolean, valid_from timestamp, valid_to timestamp",
    )
    facts = spark.createDataFrame(
        [("c1", "P1", t(5)), ("c2", "P1", t(10)), ("c3", "P1", t(20)), ("c4", "P9", t(5)), ("c5", "P1", dt.datetime(2023, 12, 1))],
        "claim_id string, provider_id string, at timestamp",
    )
    got = {r["claim_id"]: r["is_potential_fraud"] for r in as_of(facts, history, "provider_id", "at").collect()}
    assert got == {"c1": False, "c2": True, "c3": True, "c4": None, "c5": None}


def test_reconcile_counts(spark):
    dim = spark.createDataFrame([("P1", 2), ("P2", 1)], "provider_id string, total_claims long")
    fct = spark.createDataFrame([("a",), ("b",), ("c",)], "claim_id string")
    row = reconcile_provider_claims(dim, fct).first()
    assert (row["provider_claims"], row["fact_rows"], row["reconciled"]) == (3, 3, True)
    row = reconcile_provider_claims(dim, fct.limit(2)).first()
    assert row["reconciled"] is False
