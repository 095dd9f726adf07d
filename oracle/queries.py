"""Oracle SQL per registered query name."""

from __future__ import annotations

from oracle import models as m
from oracle.raw import BATCH_TS, NA, RULES, raw_ctes


def with_ctes(final: str, extra: list[tuple[str, str]] | None = None) -> str:
    ctes = raw_ctes() + m.model_ctes() + (extra or [])
    if final.lstrip().lower().startswith("with "):
        final = f"select * from ({final})"
    return "with " + ",\n".join(f"{n} as ({body})" for n, body in ctes) + "\n" + final


def table(name: str) -> str:
    return with_ctes(f"select * from {name}")


HISTORY_1 = (
    "select provider_id, is_potential_fraud, timestamp '" + BATCH_TS + "' as valid_from, "
    "cast(null as timestamp) as valid_to from stg_providers"
)


def base() -> dict[str, str]:
    out: dict[str, str] = {}
    for name in [
        "stg_beneficiary",
        "stg_inpatient_claims",
        "stg_outpatient_claims",
        "stg_providers",
        "stg_diabetes_encounters",
        "stg_hospital_admissions",
        "int_claims_unified",
        "int_claims_enriched",
        "int_encounters_enriched",
        "int_admissions_enriched",
        "fct_claims",
        "dim_beneficiary",
        "dim_provider",
        "fct_encounters",
        "dim_patient",
        "fct_hospital_admissions",
        "dim_hospital_patient",
    ]:
        out[name] = table(name)
    out["dim_provider_history"] = with_ctes(
        "select provider_id, is_potential_fraud, valid_from, valid_to, valid_to is null as is_current "
        "from history_1",
        [("history_1", HISTORY_1)],
    )

    # preparation
    out["split_union"] = with_ctes(
        "select *, 0 as split_rank from bene_train union all select *, 1 from bene_test"
    )
    out["dedup_keep_first"] = with_ctes("select * from src_providers")
    diab_cols = [r[0] for r in RULES["diabetes_encounters"]]
    na_sel = ", ".join(
        f'case when "{c}" in ({NA}) then null else "{c}" end as "{c}"' if t == "varchar" else f'"{c}"'
        for c, t, *_ in RULES["diabetes_encounters"]
    )
    # integer columns of the extract stay integer: only text cells are recoded
    out["na_token_recode"] = with_ctes(f"select {na_sel} from diab_raw")
    out["sentinel_recode"] = with_ctes("select * from src_diabetes_encounters")
    assert diab_cols
    out["bracket_recode"] = with_ctes(
        "select * replace (case when Age = '20-Nov' then '11-20' else Age end as Age, "
        "case when Stay = '20-Nov' then '11-20' else Stay end as Stay) from hosp_raw"
    )
    out["surrogate_key"] = with_ctes(
        "select md5(case_id || '-' || patientid) as admission_id, case_id, patientid from hosp_raw"
    )
    out["hash_bucket"] = with_ctes(
        "select ClaimID, cast((('0x' || md5(ClaimID))::uhugeint % 2) as integer) as bucket_2, "
        "cast((('0x' || md5(ClaimID))::uhugeint % 7) as integer) as bucket_7 from "
        "(select ClaimID from src_inpatient_claims union all select ClaimID from src_outpatient_claims)"
    )

    # contracts
    for t, rules in RULES.items():
        out[f"contract_valid_{t}"] = with_ctes(
            f"select * exclude (ingested_at) from raw_{t}"
        )
        out[f"contract_rejects_{t}"] = with_ctes(
            f"select * exclude (reasons), reasons as reject_reasons from ann_{t} where reasons <> ''"
        )
    out["ingest_summary"] = with_ctes(
        " union all ".join(
            f"select '{t}' as table_name, cast(count(*) filter (where reasons = '') as bigint) as loaded, "
            f"cast(count(*) filter (where reasons <> '') as bigint) as rejected from ann_{t}"
            for t in RULES
        )
    )
    return out


def all_sql() -> dict[str, str]:
    from oracle.stateful import checks_and_analytics

    out = base()
    out.update(checks_and_analytics())
    return out
