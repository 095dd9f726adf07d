"""Frame preparation and column expressions."""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib

from helpers import text_frame
from pyspark.sql import functions as F

from caremarts.functions.columns import age_years, exact_ratio, hash_bucket, surrogate_key
from caremarts.operators.prepare import (
    bracket_recode,
    dedup_keep_first,
    sentinel_recode,
    split_union,
)
from caremarts.sources.csv import na_token_recode


def test_split_union_fills_missing_columns(spark):
    train = text_frame(spark, [{"Provider": "P1", "PotentialFraud": "Yes"}])
    test = text_frame(spark, [{"Provider": "P2"}])
    rows = {r["Provider"]: r for r in split_union(train, test).collect()}
    assert rows["P2"]["PotentialFraud"] is None and rows["P2"]["_split_rank"] == 1


def test_dedup_keeps_train_row(spark):
    train = text_frame(spark, [{"Provider": "P1", "PotentialFraud": "Yes"}])
    test = text_frame(spark, [{"Provider": "P1"}, {"Provider": "P2"}])
    out = {r["Provider"]: r["PotentialFraud"] for r in dedup_keep_first(split_union(train, test), "Provider").collect()}
    assert out == {"P1": "Yes", "P2": None}


def test_sentinel_and_tokens(spark):
    df = text_frame(spark, [{"a": "?", "b": "None", "c": "x?"}])
    row = sentinel_recode(na_token_recode(df)).first()
    assert (row["a"], row["b"], row["c"]) == (None, None, "x?")


def test_bracket_recode_only_named_columns(spark):
    df = text_frame(spark, [{"Age": "20-Nov", "Stay": "20-Nov", "Other": "20-Nov"}])
    row = bracket_recode(df).first()
    assert (row["Age"], row["Stay"], row["Other"]) == ("11-20", "11-20", "20-Nov")


def test_surrogate_key_matches_python_md5(spark):
    df = spark.createDataFrame([(784, 91534)], "case_id long, patientid long")
    got = df.select(surrogate_key("case_id", "patientid").alias("k")).first()["k"]
    assert got == hashlib.md5(b"784-91534").hexdigest()


def test_hash_bucket_matches_python_for_many_ids(spark):
    ids = [f"CLM{i}" for i in range(500)]
    df = spark.createDataFrame([(i,) for i in ids], "id string")
    for n in (2, 7, 1000003):
        got = {r["id"]: r["b"] for r in df.select("id", hash_bucket("id", n).alias("b")).collect()}
        assert all(got[i] == int(hashlib.md5(i.encode()).hexdigest(), 16) % n for i in ids)


def test_age_truncates_leap_day(spark):
    df = spark.createDataFrame([(dt.date(2008, 2, 29), dt.date(2009, 2, 28))], "dob date, d date")
    assert df.select(age_years("d", "dob").alias("a")).first()["a"] == 0


def test_exact_ratio_rounds_once(spark):
    df = spark.createDataFrame([(5, 11), (201, 200)], "s long, n long")
    got = [r["r"] for r in df.select(exact_ratio("s", "n", 4).alias("r")).collect()]
    assert got == [decimal.Decimal("0.4545"), decimal.Decimal("1.0050")]


def test_exact_ratio_half_up_on_money(spark):
    df = spark.createDataFrame([(decimal.Decimal("2.01"), 2)], "s decimal(22,2), n long")
    assert df.select(exact_ratio("s", "n", 2).alias("r")).first()["r"] == decimal.Decimal("1.01")


def test_money_cast_rounds_decimal_text(spark):
    # 275.655 as a double is 275.65499..., the decimal text rounds half up
    df = spark.createDataFrame([(275.655,)], "x double")
    assert df.select(F.col("x").cast("decimal(12,2)").alias("m")).first()["m"] == decimal.Decimal("275.66")
