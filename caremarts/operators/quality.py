"""Data-quality assertions (Q1-Q15): a failing test is a returned row.

Generic tests (unique, not_null, accepted_values, relationships) are declared
as data in ``GENERIC_TESTS``; singular tests are functions over the models.
``run_suite`` evaluates all of them as one Spark job: the unique, not-null and
row-level singular tests of a model in one grouped pass over it, its accepted
values in one scan, each relationship as one anti join; the per-test counts are
stacked into ``(check_name, severity, failing_rows, status)`` rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caremarts.functions.columns import union_all
from caremarts.operators.joins import orphans

FAR_FUTURE = "9999-12-31 00:00:00"


@dataclass(frozen=True)
class Test:
    model: str
    kind: str  # unique | not_null | accepted_values | relationships
    column: str
    values: tuple | None = None  # accepted_values
    to: tuple[str, str] | None = None  # relationships: (parent model, field)
    severity: str = "error"

    @property
    def name(self) -> str:
        base = f"{self.kind}_{self.model}_{self.column}"
        return f"{base}__{self.to[0]}" if self.to else base


def _u(model: str, col: str) -> list[Test]:
    return [Test(model, "unique", col), Test(model, "not_null", col)]


def _nn(model: str, *cols: str) -> list[Test]:
    return [Test(model, "not_null", c) for c in cols]


def _av(model: str, col: str, values: tuple) -> Test:
    return Test(model, "accepted_values", col, values=values)


def _rel(model: str, col: str, parent: str, field: str, severity: str = "error") -> Test:
    return Test(model, "relationships", col, to=(parent, field), severity=severity)


# -- fixed values: the accepted-value sets of the declared tests --------------
GENDERS = ("Male", "Female")
RACES = ("White", "Black", "Other", "Hispanic", "Unknown")
CLAIM_TYPES = ("inpatient", "outpatient")
DIABETES_GENDERS = ("Female", "Male", "Unknown/Invalid")
READMITTED = ("NO", ">30", "<30")
ADMISSION_TYPES = ("Emergency", "Trauma", "Urgent")
SEVERITIES = ("Minor", "Moderate", "Extreme")
STAY_BRACKETS = (
    "0-10",
    "11-20",
    "21-30",
    "31-40",
    "41-50",
    "51-60",
    "61-70",
    "71-80",
    "81-90",
    "91-100",
    "More than 100 Days",
)

# -- fixed values: the declared tests of the models
GENERIC_TESTS: tuple[Test, ...] = (
    # staging
    *_u("stg_beneficiary", "bene_id"),
    *_nn("stg_beneficiary", "date_of_birth"),
    _av("stg_beneficiary", "gender", GENDERS),
    _av("stg_beneficiary", "race", RACES),
    *_u("stg_inpatient_claims", "claim_id"),
    *_nn("stg_inpatient_claims", "bene_id", "provider_id"),
    _av("stg_inpatient_claims", "claim_type", ("inpatient",)),
    *_u("stg_outpatient_claims", "claim_id"),
    *_nn("stg_outpatient_claims", "bene_id", "provider_id"),
    _av("stg_outpatient_claims", "claim_type", ("outpatient",)),
    *_u("stg_providers", "provider_id"),
    *_u("stg_diabetes_encounters", "encounter_id"),
    *_nn("stg_diabetes_encounters", "patient_nbr"),
    _av("stg_diabetes_encounters", "gender", DIABETES_GENDERS),
    *_nn("stg_diabetes_encounters", "readmitted_status"),
    _av("stg_diabetes_encounters", "readmitted_status", READMITTED),
    *_nn("stg_diabetes_encounters", "is_readmitted_30d"),
    *_u("stg_hospital_admissions", "admission_id"),
    *_nn("stg_hospital_admissions", "case_id", "patient_id"),
    _av("stg_hospital_admissions", "type_of_admission", ADMISSION_TYPES),
    _av("stg_hospital_admissions", "severity_of_illness", SEVERITIES),
    _av("stg_hospital_admissions", "length_of_stay_bracket", STAY_BRACKETS),
    # intermediate
    *_u("int_claims_unified", "claim_id"),
    *_nn("int_claims_unified", "bene_id", "provider_id"),
    _av("int_claims_unified", "claim_type", CLAIM_TYPES),
    *_nn("int_claims_unified", "claim_start_date", "reimbursement_amount"),
    *_u("int_claims_enriched", "claim_id"),
    *_nn("int_claims_enriched", "claim_start_date"),
    *_u("int_encounters_enriched", "encounter_id"),
    *_nn("int_encounters_enriched", "patient_nbr", "is_readmitted_30d"),
    *_u("int_admissions_enriched", "admission_id"),
    *_nn("int_admissions_enriched", "patient_id", "length_of_stay_days", "is_long_stay"),
    # marts
    *_u("fct_claims", "claim_id"),
    *_nn("fct_claims", "bene_id"),
    _rel("fct_claims", "bene_id", "dim_beneficiary", "bene_id", severity="warn"),
    *_nn("fct_claims", "provider_id"),
    _rel("fct_claims", "provider_id", "dim_provider", "provider_id"),
    _av("fct_claims", "claim_type", CLAIM_TYPES),
    *_u("dim_beneficiary", "bene_id"),
    *_u("dim_provider", "provider_id"),
    *_nn("dim_provider_history", "provider_id", "valid_from", "is_current"),
    *_u("fct_encounters", "encounter_id"),
    *_nn("fct_encounters", "patient_nbr"),
    _rel("fct_encounters", "patient_nbr", "dim_patient", "patient_nbr"),
    _rel("fct_encounters", "admission_type_id", "dim_admission_type", "admission_type_id"),
    *_nn("fct_encounters", "readmitted_status"),
    _av("fct_encounters", "readmitted_status", READMITTED),
    *_nn("fct_encounters", "is_readmitted_30d"),
    *_u("dim_patient", "patient_nbr"),
    *_u("dim_admission_type", "admission_type_id"),
    *_nn("dim_admission_type", "admission_type_label"),
    *_u("fct_hospital_admissions", "admission_id"),
    *_nn("fct_hospital_admissions", "patient_id"),
    _rel("fct_hospital_admissions", "patient_id", "dim_hospital_patient", "patient_id"),
    *_nn("fct_hospital_admissions", "severity_of_illness"),
    _rel("fct_hospital_admissions", "severity_of_illness", "dim_severity", "severity_of_illness"),
    _av("fct_hospital_admissions", "type_of_admission", ADMISSION_TYPES),
    *_nn("fct_hospital_admissions", "is_long_stay"),
    *_u("dim_hospital_patient", "patient_id"),
    *_u("dim_severity", "severity_of_illness"),
    *_nn("dim_severity", "severity_rank"),
)


# -- generic tests, as failing-row DataFrames --------------------------------------


def check_unique(df: DataFrame, col: str) -> DataFrame:
    """Q1: non-null values held by more than one row, with their count."""
    return (
        df.select(col)
        .filter(F.col(col).isNotNull())
        .groupBy(col)
        .agg(F.count(F.lit(1)).alias("n_records"))
        .filter(F.col("n_records") > 1)
    )


def check_not_null(df: DataFrame, col: str) -> DataFrame:
    """Q2: rows where ``col`` is null."""
    return df.filter(F.col(col).isNull())


def check_accepted_values(df: DataFrame, col: str, values: tuple) -> DataFrame:
    """Q3: each value outside the accepted set (nulls pass), with its count."""
    return (
        df.select(col)
        .filter(F.col(col).isNotNull() & ~F.col(col).isin(list(values)))
        .groupBy(col)
        .agg(F.count(F.lit(1)).alias("n_records"))
    )


def check_relationships(child: DataFrame, col: str, parent: DataFrame, field: str) -> DataFrame:
    """Q4, Q5: child rows whose non-null ``col`` has no parent ``field``."""
    return orphans(child, parent, col, field)


# -- singular tests -------------------------------------------------------------------


def _age_is_wrong() -> Column:
    age = F.col("age_at_claim")
    return age.isNotNull() & ((age < 0) | (age > 120))


def _dates_are_reversed() -> Column:
    return F.col("claim_start_date") > F.col("claim_end_date")


def _amount_is_negative() -> Column:
    return F.col("reimbursement_amount") < 0


def _stay_is_wrong() -> Column:
    days = F.col("length_of_stay_days")
    return days.isNull() | (days < 0)


def _long_stay_disagrees() -> Column:
    return F.col("is_long_stay") != (F.col("length_of_stay_days") > 30)


def _readmission_disagrees() -> Column:
    return F.col("is_readmitted_30d") != (F.col("readmitted_status") == "<30")


def check_age_at_claim(claims_enriched: DataFrame) -> DataFrame:
    """Q6: age outside [0, 120] (null age passes)."""
    return claims_enriched.filter(_age_is_wrong()).select("claim_id", "age_at_claim")


def check_claim_dates_ordered(claims_enriched: DataFrame) -> DataFrame:
    """Q7: claim starting after it ends."""
    return claims_enriched.filter(_dates_are_reversed()).select("claim_id", "claim_start_date", "claim_end_date")


def check_reimbursement_non_negative(fct_claims: DataFrame) -> DataFrame:
    """Q8."""
    return fct_claims.filter(_amount_is_negative()).select("claim_id", "reimbursement_amount")


def check_length_of_stay(fct_admissions: DataFrame) -> DataFrame:
    """Q9: stay days null or negative."""
    return fct_admissions.filter(_stay_is_wrong()).select("admission_id", "length_of_stay_bracket", "length_of_stay_days")


def check_long_stay_flag(fct_admissions: DataFrame) -> DataFrame:
    """Q10: flag disagrees with days > 30 (a null comparison passes)."""
    return fct_admissions.filter(_long_stay_disagrees()).select("admission_id", "length_of_stay_days", "is_long_stay")


def check_readmitted_flag(fct_encounters: DataFrame) -> DataFrame:
    """Q11: flag disagrees with status '<30' (a null comparison passes)."""
    return fct_encounters.filter(_readmission_disagrees()).select("encounter_id", "readmitted_status", "is_readmitted_30d")


def check_history_no_overlap(history: DataFrame, key: str = "provider_id") -> DataFrame:
    """Q12: versions overlapping another version of the same key.

    Version ``a`` overlaps some ``b`` with a different start iff an earlier
    start has an end after ``a``'s start, or a later start comes before
    ``a``'s end: a running max / min over the key's versions ordered by
    start, with the equal-start peers excluded by the range frame. No
    self-join, so no pairs are ever materialised; each offending version is
    reported once. A key's version list grows by at most one per snapshot
    run, which bounds the window partition.
    """
    end = F.coalesce(F.col("valid_to"), F.lit(FAR_FUTURE).cast("timestamp"))
    h = history.select(key, "valid_from", end.alias("__end")).withColumn(
        "__from_us", F.unix_micros("valid_from")
    )
    w = Window.partitionBy(key).orderBy("__from_us")
    earlier_end = F.max("__end").over(w.rangeBetween(Window.unboundedPreceding, -1))
    later_start = F.min("valid_from").over(w.rangeBetween(1, Window.unboundedFollowing))
    flagged = h.select(
        key,
        "valid_from",
        F.col("__end").alias("valid_to"),
        ((earlier_end > F.col("valid_from")) | (later_start < F.col("__end"))).alias("__bad"),
    )
    return flagged.filter(F.col("__bad")).drop("__bad")


def check_history_one_current(history: DataFrame, key: str = "provider_id") -> DataFrame:
    """Q13: keys without exactly one current version."""
    return (
        history.groupBy(key)
        .agg(F.count_if(F.col("is_current")).alias("current_rows"))
        .filter(F.col("current_rows") != 1)
    )


SINGULAR_TESTS = {
    "assert_age_at_claim_valid": ("int_claims_enriched", check_age_at_claim),
    "assert_claim_dates_ordered": ("int_claims_enriched", check_claim_dates_ordered),
    "assert_reimbursement_non_negative": ("fct_claims", check_reimbursement_non_negative),
    "assert_length_of_stay_non_negative": ("fct_hospital_admissions", check_length_of_stay),
    "assert_long_stay_flag_consistent": ("fct_hospital_admissions", check_long_stay_flag),
    "assert_readmitted_flag_consistent": ("fct_encounters", check_readmitted_flag),
    "assert_provider_history_no_overlap": ("dim_provider_history", check_history_no_overlap),
    "assert_provider_history_one_current": ("dim_provider_history", check_history_one_current),
}

#: Singular tests that look at one row at a time: the model, and what is wrong with a row.
ROW_TESTS = {
    "assert_age_at_claim_valid": ("int_claims_enriched", _age_is_wrong),
    "assert_claim_dates_ordered": ("int_claims_enriched", _dates_are_reversed),
    "assert_reimbursement_non_negative": ("fct_claims", _amount_is_negative),
    "assert_length_of_stay_non_negative": ("fct_hospital_admissions", _stay_is_wrong),
    "assert_long_stay_flag_consistent": ("fct_hospital_admissions", _long_stay_disagrees),
    "assert_readmitted_flag_consistent": ("fct_encounters", _readmission_disagrees),
}


# -- the suite -------------------------------------------------------------------------


def _model_pass(df: DataFrame, tests: list[Test], singular: dict[str, Column]) -> DataFrame:
    """Uniqueness, not-null and row checks of a model in one grouped pass.

    Rows are counted by the unique column, each with the sums of its checks'
    flags (both combined before the shuffle); the second aggregate adds those up
    and counts the values held more than once.
    """
    (unique,) = [t for t in tests if t.kind == "unique"] or [None]
    flags = {t.name: F.col(t.column).isNull() for t in tests if t.kind == "not_null"} | singular
    names = list(flags)
    key = F.col(unique.column) if unique else F.lit(0)
    by_key = df.groupBy(key.alias("__key")).agg(
        F.count(F.lit(1)).alias("__n"),
        *[F.count_if(flags[name]).alias(f"f{i}") for i, name in enumerate(names)],
    )
    sums = [(name, "error", F.sum(f"f{i}")) for i, name in enumerate(names)]
    if unique:
        sums.append((unique.name, unique.severity, F.count_if(F.col("__key").isNotNull() & (F.col("__n") > 1))))
    return _stack(sums, by_key)


def _accepted_pass(df: DataFrame, tests: list[Test]) -> DataFrame:
    """Distinct values outside the accepted sets: only offending cells leave the scan."""
    bad = [
        F.when(F.col(t.column).isNotNull() & ~F.col(t.column).isin(list(t.values)), F.struct(F.lit(t.name).alias("t"), F.col(t.column).alias("v")))
        for t in tests
    ]
    cells = df.select(F.explode(F.array(*bad)).alias("c")).where("c is not null").distinct()
    return _stack([(t.name, t.severity, F.count_if(F.col("c.t") == t.name)) for t in tests], cells)


def _stack(parts: list[tuple[str, str, Column]], df: DataFrame) -> DataFrame:
    """One aggregate over ``df``, reshaped to one row per check."""
    agg = df.agg(*[F.coalesce(expr, F.lit(0)).cast("bigint").alias(f"c{i}") for i, (_, _, expr) in enumerate(parts)])
    body = ", ".join(
        f"'{name}', '{sev}', c{i}" for i, (name, sev, _) in enumerate(parts)
    )
    return agg.selectExpr(f"stack({len(parts)}, {body}) AS (check_name, severity, failing_rows)")


def run_suite(models, tests: tuple[Test, ...] = GENERIC_TESTS) -> DataFrame:
    """Q15: every declared test, one result row each.

    One pass over each model for its uniqueness, not-null and row-level singular
    tests, one scan for its accepted values, an anti join for each
    relationship, and one aggregate for each of the two history tests.
    ``models`` resolves a model name to a DataFrame (``Models.mart`` or any
    object with those attributes).
    """

    def m(name: str) -> DataFrame:
        return getattr(models, name)

    def failing(df: DataFrame, name: str, severity: str) -> DataFrame:
        count = df.agg(F.count(F.lit(1)).cast("bigint").alias("failing_rows"))
        return count.select(F.lit(name).alias("check_name"), F.lit(severity).alias("severity"), "failing_rows")

    results: list[DataFrame] = []
    by_model: dict[str, list[Test]] = {}
    for t in tests:
        by_model.setdefault(t.model, []).append(t)

    for model, ts in by_model.items():
        df = m(model)
        rows = {name: wrong() for name, (own, wrong) in ROW_TESTS.items() if own == model}
        results.append(_model_pass(df, ts, rows))
        accepted = [t for t in ts if t.kind == "accepted_values"]
        if accepted:
            results.append(_accepted_pass(df, accepted))
        for t in ts:
            if t.kind == "relationships":
                results.append(failing(check_relationships(df, t.column, m(t.to[0]), t.to[1]), t.name, t.severity))
    for name, (model, fn) in SINGULAR_TESTS.items():
        if name not in ROW_TESTS:
            results.append(failing(fn(m(model)), name, "error"))

    out = union_all(results)
    status = (
        F.when(F.col("failing_rows") == 0, "pass")
        .when(F.col("severity") == "warn", "warn")
        .otherwise("fail")
    )
    return out.withColumn("status", status)


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


def mart_row_counts(models, marts: tuple[str, ...] = MART_NAMES) -> DataFrame:
    """Q14: row count of every mart, as one job."""
    parts = [
        getattr(models, name).agg(F.count(F.lit(1)).cast("bigint").alias("row_count")).select(
            F.lit(name).alias("mart"), "row_count"
        )
        for name in marts
    ]
    return union_all(parts)


class EmptyMartError(RuntimeError):
    pass


def gate_marts(counts: DataFrame) -> dict[str, int]:
    """Q14 gate: raise if any mart is empty; returns the counts (10 rows)."""
    rows = {r["mart"]: r["row_count"] for r in counts.collect()}
    empty = [m for m, n in rows.items() if n == 0]
    if empty:
        raise EmptyMartError(f"empty mart table(s): {', '.join(empty)}")
    return rows
