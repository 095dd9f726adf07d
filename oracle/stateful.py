"""Oracle SQL for loads, incremental facts, history, checks, proofs, analytics."""

from __future__ import annotations

from oracle import models as m
from oracle.queries import with_ctes
from oracle.raw import RULES, rules_text

B1 = "timestamp '2024-01-01 00:00:00'"
B2 = "timestamp '2024-02-01 00:00:00'"
B3 = "timestamp '2024-03-01 00:00:00'"


def bucket(col: str, n: int) -> str:
    return f"cast((('0x' || md5({col}))::uhugeint % {n}) as integer)"


FLIP = "select Provider from raw_providers where PotentialFraud = 'No' order by Provider limit 5"
H1 = f"select provider_id, is_potential_fraud, {B1} as valid_from, cast(null as timestamp) as valid_to from stg_providers"
H2 = (
    f"select provider_id, is_potential_fraud, {B1} as valid_from, "
    f"case when provider_id in (select Provider from flip) then {B2} end as valid_to from stg_providers "
    f"union all select provider_id, true, {B2}, cast(null as timestamp) from stg_providers "
    "where provider_id in (select Provider from flip)"
)
H_DEL = (
    f"select provider_id, is_potential_fraud, {B1} as valid_from, "
    f"case when {bucket('provider_id', 2)} = 1 then {B2} end as valid_to from stg_providers"
)
H_BACK = H_DEL + (
    f" union all select provider_id, is_potential_fraud, {B3}, cast(null as timestamp) "
    f"from stg_providers where {bucket('provider_id', 2)} = 1"
)
HIST_CTES = [("flip", FLIP), ("h1", H1), ("h2", H2), ("h_del", H_DEL), ("h_back", H_BACK)]


def dim_hist(src: str) -> str:
    return f"select *, valid_to is null as is_current from {src}"


def enriched_with(source: str, bene: str) -> str:
    return m.claims_enriched_from(source).replace("left join stg_beneficiary b", f"left join {bene} b")


INCR_CTES = [
    ("bene_a", f"select * from stg_beneficiary where {bucket('bene_id', 2)} = 0"),
    ("unified_a", f"select * from int_claims_unified where {bucket('claim_id', 2)} = 0"),
    ("unified_b1", f"select * from int_claims_unified where {bucket('claim_id', 2)} = 1"),
    ("enr_a", enriched_with("unified_a", "bene_a")),
    ("enr_b1", enriched_with("unified_b1", "stg_beneficiary")),
]


def checks_and_analytics() -> dict[str, str]:
    out: dict[str, str] = {}
    x = lambda final, extra=None: with_ctes(final, HIST_CTES + INCR_CTES + (extra or []))

    # loads
    out["upsert_merge"] = x(
        "select * exclude (ingested_at) replace (case when "
        + bucket("ClaimID", 7)
        + " = 0 then null else OtherPhysician end as OtherPhysician), "
        f"case when {bucket('ClaimID', 2)} = 0 then {B1} else {B2} end as ingested_at "
        "from raw_inpatient_claims"
    )
    out["upsert_idempotent"] = x("select * from raw_inpatient_claims")
    out["replace_load"] = x(
        f"select * exclude (ingested_at), {B2} as ingested_at from raw_inpatient_claims "
        f"where {bucket('ClaimID', 2)} = 1"
    )
    # incremental
    out["incremental_append"] = x(
        f"select {m.FCT_CLAIMS_COLS} from enr_a union all select {m.FCT_CLAIMS_COLS} from enr_b1"
    )
    out["incremental_replace"] = x("select * from fct_claims")
    # history
    out["scd2_two_vintages"] = x("select * from h2")
    out["scd2_hard_delete"] = x("select * from h_back")
    out["provider_history"] = x(dim_hist("h2"))
    out["label_as_of"] = x(
        "select c.ClaimID as claim_id, c.Provider as provider_id, c.ingested_at, h.is_potential_fraud "
        "from (select ClaimID, Provider, case when " + bucket("ClaimID", 2) + f" = 0 then {B1} else {B2} end "
        "as ingested_at from (select ClaimID, Provider from raw_inpatient_claims union all "
        "select ClaimID, Provider from raw_outpatient_claims)) c "
        "left join h2 h on h.provider_id = c.Provider and h.valid_from <= c.ingested_at "
        "and (h.valid_to is null or c.ingested_at < h.valid_to)"
    )
    first_flag = "select provider_id, min(valid_from) as first_flagged_at from h2 where is_potential_fraud group by provider_id"
    out["first_flagged"] = x(first_flag)

    # contracts over faulty input
    hit7 = lambda c, b: f"{bucket(f'cast({c} as varchar)', 7)} = {b}"
    reasons, typed = rules_text(RULES["providers"])
    out["contract_rejects_providers"] = x(
        f"select * exclude (reasons), reasons as reject_reasons from (select *, {reasons} as reasons from "
        f"(select * from src_providers union all select * from src_providers where {hit7('Provider', 0)})) where reasons <> ''"
    )
    reasons, typed = rules_text(RULES["diabetes_encounters"])
    bad = (
        f"select * exclude (t), t as time_in_hospital from (select * exclude (time_in_hospital) replace "
        f"(case when {hit7('encounter_id', 0)} then '9' else cast(admission_type_id as varchar) end as admission_type_id), "
        f"case when {hit7('encounter_id', 1)} then 'three' when {hit7('encounter_id', 2)} then '12.0' "
        "else cast(time_in_hospital as varchar) end as t from src_diabetes_encounters)"
    )
    marked = f"select *, {reasons} as reasons from ({bad})"
    out["contract_rejects_bad_encounters"] = x(
        f"select * exclude (reasons), reasons as reject_reasons from ({marked}) where reasons <> ''"
    )
    out["contract_valid_bad_encounters"] = x(f"select {typed} from ({marked}) where reasons = ''")
    first = (
        "select * exclude (rn) from (select *, row_number() over (partition by BeneID order by BeneID) as rn from bene_train) where rn = 1"
    )
    out["dedup_by_row"] = x(
        f"with once as ({first}), again as (select *, 1 as row_number from once union all "
        f"select * replace (0 as State), 2 as row_number from once where {hit7('BeneID', 0)}) "
        "select * exclude (place) from (select *, row_number() over (partition by BeneID order by row_number) as place from again) where place = 1"
    )

    # single checks
    # faults are put on the rows of bucket 0 (and 1) of 7 of the key
    hit = lambda c, b=0: f"{bucket(f'cast({c} as varchar)', 7)} = {b}"
    out["check_unique"] = x(
        "select claim_id, count(*) as n_records from (select claim_id from int_claims_unified union all "
        f"select claim_id from int_claims_unified where {hit('claim_id')}) group by claim_id having count(*) > 1"
    )
    out["check_not_null"] = x(
        f"select * replace (cast(null as varchar) as bene_id) from fct_claims where bene_id is null or {hit('claim_id')}"
    )
    out["check_accepted_values"] = x(
        "select 'not ' || race as race, count(*) as n_records from stg_beneficiary "
        f"where race is not null and {hit('bene_id')} group by race"
    )
    out["check_relationships"] = x(
        "select * from fct_encounters f where patient_nbr is not null and not exists "
        f"(select 1 from dim_patient p where p.patient_nbr = f.patient_nbr and not ({hit('p.patient_nbr')}))"
    )
    out["check_relationships_warn"] = x(
        "select claim_id, bene_id from fct_claims f where bene_id is not null and not exists "
        "(select 1 from dim_beneficiary d where d.bene_id = f.bene_id)"
    )
    out["check_age_at_claim"] = x(
        "select claim_id, age_at_claim from int_claims_enriched where age_at_claim is not null "
        "and (age_at_claim < 0 or age_at_claim > 120)"
    )
    out["check_claim_dates_ordered"] = x(
        "select claim_id, claim_start_date, claim_end_date from int_claims_enriched "
        "where claim_start_date > claim_end_date"
    )
    out["check_reimbursement_non_negative"] = x(
        "select claim_id, case when " + hit("claim_id") + " then cast(-1 as decimal(18,2)) else reimbursement_amount "
        "end as reimbursement_amount from fct_claims where reimbursement_amount < 0 or " + hit("claim_id")
    )
    out["check_length_of_stay"] = x(
        "select * from (select admission_id, length_of_stay_bracket, case when " + hit("admission_id") + " then null "
        "when " + hit("admission_id", 1) + " then -5 else length_of_stay_days end as length_of_stay_days "
        "from fct_hospital_admissions) where length_of_stay_days is null or length_of_stay_days < 0"
    )
    out["check_long_stay_flag"] = x(
        "select admission_id, length_of_stay_days, not is_long_stay as is_long_stay from fct_hospital_admissions "
        f"where {hit('admission_id')} and length_of_stay_days is not null and is_long_stay is not null"
    )
    out["check_readmitted_flag"] = x(
        "select encounter_id, readmitted_status, not is_readmitted_30d as is_readmitted_30d from fct_encounters "
        f"where {hit('encounter_id')} and readmitted_status is not null and is_readmitted_30d is not null"
    )
    overlap = (
        "with hh as (select provider_id, valid_from, coalesce(valid_to, timestamp '9999-12-31') as valid_to "
        "from {src}) select distinct a.provider_id, a.valid_from, a.valid_to from hh a join hh b "
        "on a.provider_id = b.provider_id and a.valid_from <> b.valid_from "
        "and a.valid_from < b.valid_to and b.valid_from < a.valid_to"
    )
    out["check_history_no_overlap"] = x(
        overlap.format(src=f"(select * from h1 union all select * from h2 where valid_from = {B2})")
    )
    one_current = (
        "select provider_id, count(*) filter (where is_current) as current_rows from ({src}) "
        "group by provider_id having count(*) filter (where is_current) <> 1"
    )
    out["check_history_one_current"] = x(one_current.format(src=dim_hist("h_del")))

    marts = {
        "fct_claims": "fct_claims",
        "dim_beneficiary": "dim_beneficiary",
        "dim_provider": "dim_provider",
        "dim_provider_history": "h1",
        "fct_encounters": "fct_encounters",
        "dim_patient": "dim_patient",
        "dim_admission_type": "seed_admission_types",
        "fct_hospital_admissions": "fct_hospital_admissions",
        "dim_hospital_patient": "dim_hospital_patient",
        "dim_severity": "seed_severity",
    }
    out["check_mart_row_counts"] = x(
        " union all ".join(f"select '{k}' as mart, count(*) as row_count from {v}" for k, v in marts.items())
    )
    out["check_suite"] = x(suite_sql(overlap, one_current), [("dim_provider_history", dim_hist("h1"))])

    # proofs
    out["proof_incremental"] = x(
        "with loaded as (select claim_id from enr_a union all select claim_id from enr_b1), "
        "c as (select "
        "(select count(*) - count(distinct claim_id) from enr_a) as repeats_a, "
        "(select count(*) - count(distinct claim_id) from loaded) as repeats_all, "
        "(select count(*) from loaded where claim_id not in (select claim_id from enr_a)) as growth, "
        "(select count(*) from unified_b1) as second_half, "
        "(select count(*) from int_claims_unified where claim_id not in (select claim_id from loaded)) as left_out, "
        "(select count(*) from loaded where claim_id not in (select claim_id from int_claims_unified)) as made_up, "
        "(select count(*) from enr_b1 where claim_id not in (select claim_id from loaded)) as replayed) "
        "select * from (values ('claims_unique_after_full_load', (select repeats_a = 0 from c)), "
        "('claims_unique_after_incremental_load', (select repeats_all = 0 from c)), "
        "('incremental_load_adds_the_second_half', (select growth = second_half from c)), "
        "('both_halves_make_all_claims', (select left_out = 0 and made_up = 0 from c)), "
        "('replay_adds_and_loses_nothing', (select replayed = 0 from c))) t(check_name, passed)"
    )
    out["proof_scd2"] = x(
        "with hist as (select h2.* from h2 join flip on h2.provider_id = flip.Provider), "
        "c as (select (select count(*) from h1) as before, (select count(*) from h2) as after, "
        "(select count(*) from (select provider_id from hist group by provider_id having count(*) <> 2)) as not_in_two, "
        "(select count(*) from hist where valid_to is null and is_potential_fraud) as open_flagged, "
        "(select count(*) from hist where valid_to is not null and not is_potential_fraud) as closed_unflagged) "
        "select * from (values ('history_gains_a_version_per_flip', (select after - before = 5 from c)), "
        "('no_flipped_provider_lacks_a_version', (select not_in_two = 0 from c)), "
        "('open_versions_carry_the_new_label', (select open_flagged = 5 from c)), "
        "('earlier_versions_are_closed', (select closed_unflagged = 5 from c))) t(check_name, passed)"
    )

    # analytics
    out["avg_stay_by_severity"] = x(
        "select f.severity_of_illness, s.severity_rank, cast(count(*) as bigint) as admissions, "
        + m.exact_mean("sum(f.length_of_stay_days)", "count(f.length_of_stay_days)", 2, "decimal(18,2)")
        + " as avg_length_of_stay_days from fct_hospital_admissions f left join seed_severity s "
        "on f.severity_of_illness = s.severity_of_illness group by f.severity_of_illness, s.severity_rank"
    )
    out["providers_by_fraud_label"] = x(
        "select is_potential_fraud, count(*) as providers from dim_provider group by is_potential_fraud"
    )
    out["readmission_rate"] = x(
        "select count(*) as encounters, cast(sum(case when is_readmitted_30d then 1 else 0 end) as bigint) "
        "as readmitted_30d, "
        + m.exact_mean("sum(case when is_readmitted_30d then 1 else 0 end)", "count(*)", 4, "decimal(18,4)")
        + " as readmission_30d_rate from fct_encounters"
    )
    out["long_stay_share"] = x(
        "select count(*) as admissions, cast(sum(case when is_long_stay then 1 else 0 end) as bigint) as long_stays, "
        + m.exact_mean("sum(case when is_long_stay then 1 else 0 end)", "count(*)", 4, "decimal(18,4)")
        + " as long_stay_share from fct_hospital_admissions"
    )
    out["claims_by_provider_label"] = x(
        "select p.is_potential_fraud, count(*) as claims, cast(sum(f.reimbursement_amount) as decimal(38,2)) "
        "as total_reimbursement from fct_claims f join dim_provider p on f.provider_id = p.provider_id "
        "group by p.is_potential_fraud"
    )
    out["reconcile_provider_claims"] = x(
        "select p.s as provider_claims, f.n as fact_rows, p.s = f.n as reconciled from "
        "(select cast(sum(total_claims) as bigint) as s from dim_provider) p, "
        "(select count(*) as n from fct_claims) f"
    )
    out["repeat_admission_cohort"] = x("select * from dim_hospital_patient where total_admissions > 1")
    urgent = "department = 'surgery' and type_of_admission = 'Urgent' and severity_of_illness = 'Extreme'"
    out["repeat_urgent_surgery_cohort"] = x(
        "select * from (" + m.DIM_HOSPITAL_PATIENT.replace("int_admissions_enriched", f"(select * from fct_hospital_admissions where {urgent})")
        + ") where total_admissions > 1"
    )
    out["encounters_by_admission_type"] = x(
        "select f.admission_type_id, a.admission_type_label, cast(count(*) as bigint) as encounters, "
        + m.exact_mean("sum(case when f.is_readmitted_30d then 1 else 0 end)", "count(*)", 4, "decimal(18,4)")
        + " as readmission_30d_rate from fct_encounters f left join seed_admission_types a "
        "on f.admission_type_id = a.admission_type_id group by f.admission_type_id, a.admission_type_label"
    )
    return out


# -- the 98-test suite ----------------------------------------------------------------
# (model, column) pairs per generic test kind, as declared by the models' schema files

UNIQUE_NOT_NULL = [
    ("stg_beneficiary", "bene_id"), ("stg_inpatient_claims", "claim_id"),
    ("stg_outpatient_claims", "claim_id"), ("stg_providers", "provider_id"),
    ("stg_diabetes_encounters", "encounter_id"), ("stg_hospital_admissions", "admission_id"),
    ("int_claims_unified", "claim_id"), ("int_claims_enriched", "claim_id"),
    ("int_encounters_enriched", "encounter_id"), ("int_admissions_enriched", "admission_id"),
    ("fct_claims", "claim_id"), ("dim_beneficiary", "bene_id"), ("dim_provider", "provider_id"),
    ("fct_encounters", "encounter_id"), ("dim_patient", "patient_nbr"),
    ("dim_admission_type", "admission_type_id"), ("fct_hospital_admissions", "admission_id"),
    ("dim_hospital_patient", "patient_id"), ("dim_severity", "severity_of_illness"),
]
NOT_NULL = [
    ("stg_beneficiary", "date_of_birth"), ("stg_inpatient_claims", "bene_id"),
    ("stg_inpatient_claims", "provider_id"), ("stg_outpatient_claims", "bene_id"),
    ("stg_outpatient_claims", "provider_id"), ("stg_diabetes_encounters", "patient_nbr"),
    ("stg_diabetes_encounters", "readmitted_status"), ("stg_diabetes_encounters", "is_readmitted_30d"),
    ("stg_hospital_admissions", "case_id"), ("stg_hospital_admissions", "patient_id"),
    ("int_claims_unified", "bene_id"), ("int_claims_unified", "provider_id"),
    ("int_claims_unified", "claim_start_date"), ("int_claims_unified", "reimbursement_amount"),
    ("int_claims_enriched", "claim_start_date"), ("int_encounters_enriched", "patient_nbr"),
    ("int_encounters_enriched", "is_readmitted_30d"), ("int_admissions_enriched", "patient_id"),
    ("int_admissions_enriched", "length_of_stay_days"), ("int_admissions_enriched", "is_long_stay"),
    ("fct_claims", "bene_id"), ("fct_claims", "provider_id"),
    ("dim_provider_history", "provider_id"), ("dim_provider_history", "valid_from"),
    ("dim_provider_history", "is_current"), ("fct_encounters", "patient_nbr"),
    ("fct_encounters", "readmitted_status"), ("fct_encounters", "is_readmitted_30d"),
    ("dim_admission_type", "admission_type_label"), ("fct_hospital_admissions", "patient_id"),
    ("fct_hospital_admissions", "severity_of_illness"), ("fct_hospital_admissions", "is_long_stay"),
    ("dim_severity", "severity_rank"),
]
STAYS = "'0-10', '11-20', '21-30', '31-40', '41-50', '51-60', '61-70', '71-80', '81-90', '91-100', 'More than 100 Days'"
ACCEPTED = [
    ("stg_beneficiary", "gender", "'Male', 'Female'"),
    ("stg_beneficiary", "race", "'White', 'Black', 'Other', 'Hispanic', 'Unknown'"),
    ("stg_inpatient_claims", "claim_type", "'inpatient'"),
    ("stg_outpatient_claims", "claim_type", "'outpatient'"),
    ("stg_diabetes_encounters", "gender", "'Female', 'Male', 'Unknown/Invalid'"),
    ("stg_diabetes_encounters", "readmitted_status", "'NO', '>30', '<30'"),
    ("stg_hospital_admissions", "type_of_admission", "'Emergency', 'Trauma', 'Urgent'"),
    ("stg_hospital_admissions", "severity_of_illness", "'Minor', 'Moderate', 'Extreme'"),
    ("stg_hospital_admissions", "length_of_stay_bracket", STAYS),
    ("int_claims_unified", "claim_type", "'inpatient', 'outpatient'"),
    ("fct_claims", "claim_type", "'inpatient', 'outpatient'"),
    ("fct_encounters", "readmitted_status", "'NO', '>30', '<30'"),
    ("fct_hospital_admissions", "type_of_admission", "'Emergency', 'Trauma', 'Urgent'"),
]
RELATIONSHIPS = [
    ("fct_claims", "bene_id", "dim_beneficiary", "bene_id", "warn"),
    ("fct_claims", "provider_id", "dim_provider", "provider_id", "error"),
    ("fct_encounters", "patient_nbr", "dim_patient", "patient_nbr", "error"),
    ("fct_encounters", "admission_type_id", "dim_admission_type", "admission_type_id", "error"),
    ("fct_hospital_admissions", "patient_id", "dim_hospital_patient", "patient_id", "error"),
    ("fct_hospital_admissions", "severity_of_illness", "dim_severity", "severity_of_illness", "error"),
]
SEED_MODELS = {"dim_admission_type": "seed_admission_types", "dim_severity": "seed_severity"}


def suite_sql(overlap: str, one_current: str) -> str:
    rel = lambda t: SEED_MODELS.get(t, t)
    parts = []
    for t, c in UNIQUE_NOT_NULL:
        parts.append(
            f"select 'unique_{t}_{c}', 'error', (select count(*) from (select {c} from {rel(t)} "
            f"where {c} is not null group by {c} having count(*) > 1))"
        )
    for t, c in UNIQUE_NOT_NULL + NOT_NULL:
        parts.append(f"select 'not_null_{t}_{c}', 'error', (select count(*) from {rel(t)} where {c} is null)")
    for t, c, vals in ACCEPTED:
        parts.append(
            f"select 'accepted_values_{t}_{c}', 'error', (select count(distinct {c}) from {rel(t)} "
            f"where {c} is not null and {c} not in ({vals}))"
        )
    for t, c, p, f, sev in RELATIONSHIPS:
        parts.append(
            f"select 'relationships_{t}_{c}__{p}', '{sev}', (select count(*) from {rel(t)} x where {c} is not null "
            f"and not exists (select 1 from {rel(p)} y where y.{f} = x.{c}))"
        )
    singular = {
        "assert_age_at_claim_valid": "select * from int_claims_enriched where age_at_claim is not null and (age_at_claim < 0 or age_at_claim > 120)",
        "assert_claim_dates_ordered": "select * from int_claims_enriched where claim_start_date > claim_end_date",
        "assert_reimbursement_non_negative": "select * from fct_claims where reimbursement_amount < 0",
        "assert_length_of_stay_non_negative": "select * from fct_hospital_admissions where length_of_stay_days is null or length_of_stay_days < 0",
        "assert_long_stay_flag_consistent": "select * from fct_hospital_admissions where is_long_stay <> (length_of_stay_days > 30)",
        "assert_readmitted_flag_consistent": "select * from fct_encounters where is_readmitted_30d <> (readmitted_status = '<30')",
        "assert_provider_history_no_overlap": overlap.format(src="dim_provider_history"),
        "assert_provider_history_one_current": one_current.format(src="select * from dim_provider_history"),
    }
    for name, q in singular.items():
        parts.append(f"select '{name}', 'error', (select count(*) from ({q}))")
    body = " union all ".join(parts)
    return (
        "select check_name, severity, cast(failing_rows as bigint) as failing_rows, "
        "case when failing_rows = 0 then 'pass' when severity = 'warn' then 'warn' else 'fail' end as status "
        f"from ({body}) t(check_name, severity, failing_rows)"
    )
