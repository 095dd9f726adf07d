"""Raw layer in DuckDB SQL: fixture extracts -> cleaned -> validated.

Each table gets three CTEs: ``src_<t>`` (cleaned source rows), ``ann_<t>``
(source rows + ``reasons`` text, '' when the row passes) and ``raw_<t>``
(passing rows with contract types, plus the batch ``ingested_at``).
"""

from __future__ import annotations

from caremarts.sources import fixtures as fx

BATCH_TS = "2024-01-01 00:00:00"

# pandas' default missing tokens (the text reader's behaviour the loader relies on)
NA = (
    "'', '#N/A', '#N/A N/A', '#NA', '-1.#IND', '-1.#QNAN', '-NaN', '-nan', '1.#IND', "
    "'1.#QNAN', '<NA>', 'N/A', 'NA', 'NULL', 'NaN', 'None', 'n/a', 'nan', 'null'"
)


def view(sql: str, **tables: str) -> str:
    """A section-B view text over the given table expressions."""
    return sql.format(**tables)


def q(name: str) -> str:
    return '"' + name + '"'


# (column, duckdb type, nullable, unique, checks) with checks a list of
# (tag, SQL predicate over the typed value "@v" that is TRUE on failure)
def rules_text(rules) -> tuple[str, str]:
    """-> (reasons expression, typed select list)."""
    parts = []
    typed = []
    for col, typ, nullable, unique, checks in rules:
        c = q(col)
        v = f"try_cast({c} as {typ})"
        parts.append(f"case when {c} is not null and {v} is null then '{col}:dtype' end")
        if not nullable:
            parts.append(f"case when {c} is null then '{col}:not_null' end")
        if unique:
            parts.append(
                f"case when {v} is not null and count(*) over (partition by {v}) > 1 "
                f"then '{col}:unique' end"
            )
        for tag, pred in checks:
            parts.append(f"case when {v} is not null and ({pred.replace('@v', v)}) then '{col}:{tag}' end")
        typed.append(f"cast({c} as {typ}) as {c}")
    return "concat_ws(';', " + ", ".join(parts) + ")", ", ".join(typed)


def inlist(values) -> str:
    return "not @v in (" + ", ".join("'" + x + "'" if isinstance(x, str) else str(x) for x in values) + ")"


CHRONIC = [
    "ChronicCond_Alzheimer",
    "ChronicCond_Heartfailure",
    "ChronicCond_KidneyDisease",
    "ChronicCond_Cancer",
    "ChronicCond_ObstrPulmonary",
    "ChronicCond_Depression",
    "ChronicCond_Diabetes",
    "ChronicCond_IschemicHeart",
    "ChronicCond_Osteoporasis",
    "ChronicCond_rheumatoidarthritis",
    "ChronicCond_stroke",
]
MEDS = [
    "metformin", "repaglinide", "nateglinide", "chlorpropamide", "glimepiride",
    "acetohexamide", "glipizide", "glyburide", "tolbutamide", "pioglitazone",
    "rosiglitazone", "acarbose", "miglitol", "troglitazone", "tolazamide", "examide",
    "citoglipton", "insulin", "glyburide_metformin", "glipizide_metformin",
    "glimepiride_pioglitazone", "metformin_rosiglitazone", "metformin_pioglitazone",
]
GE0 = [("ge", "@v < 0")]

BENE_RULES = [
    ("BeneID", "varchar", False, True, []),
    ("DOB", "varchar", False, False, []),
    ("DOD", "varchar", True, False, []),
    ("Gender", "bigint", False, False, []),
    ("Race", "bigint", False, False, []),
    ("RenalDiseaseIndicator", "varchar", False, False, []),
    ("State", "bigint", False, False, []),
    ("County", "bigint", False, False, []),
    ("NoOfMonths_PartACov", "bigint", False, False, []),
    ("NoOfMonths_PartBCov", "bigint", False, False, []),
    *[(c, "bigint", False, False, [("isin", "@v not in (1, 2)")]) for c in CHRONIC],
    ("IPAnnualReimbursementAmt", "double", False, False, GE0),
    ("IPAnnualDeductibleAmt", "double", False, False, GE0),
    ("OPAnnualReimbursementAmt", "double", False, False, GE0),
    ("OPAnnualDeductibleAmt", "double", False, False, GE0),
]

CODES = [(f"ClmDiagnosisCode_{i}", "varchar", True, False, []) for i in range(1, 11)] + [
    (f"ClmProcedureCode_{i}", "varchar", True, False, []) for i in range(1, 7)
]
CLAIM_HEAD = [
    ("BeneID", "varchar", False, False, []),
    ("ClaimID", "varchar", False, True, []),
    ("ClaimStartDt", "varchar", False, False, []),
    ("ClaimEndDt", "varchar", False, False, []),
    ("Provider", "varchar", False, False, []),
    ("InscClaimAmtReimbursed", "double", False, False, GE0),
    ("AttendingPhysician", "varchar", True, False, []),
    ("OperatingPhysician", "varchar", True, False, []),
    ("OtherPhysician", "varchar", True, False, []),
]
INPATIENT_RULES = CLAIM_HEAD + [
    ("AdmissionDt", "varchar", False, False, []),
    ("ClmAdmitDiagnosisCode", "varchar", True, False, []),
    ("DeductibleAmtPaid", "double", True, False, []),
    ("DischargeDt", "varchar", False, False, []),
    ("DiagnosisGroupCode", "varchar", True, False, []),
] + CODES
OUTPATIENT_RULES = CLAIM_HEAD + [
    ("ClmAdmitDiagnosisCode", "varchar", True, False, []),
    ("DeductibleAmtPaid", "double", True, False, []),
] + CODES
# -- fixed values: columns, types and legal values of providers
PROVIDER_RULES = [
    ("Provider", "varchar", False, True, []),
    ("PotentialFraud", "varchar", True, False, []),
]
# -- fixed values: columns, types and legal values of hospital admissions
HOSPITAL_AGES = ["0-10", "11-20", "21-30", "31-40", "41-50", "51-60", "61-70", "71-80", "81-90", "91-100"]
HOSPITAL_RULES = [
    ("admission_id", "varchar", False, True, []),
    ("case_id", "varchar", False, False, []),
    ("patientid", "varchar", False, False, []),
    ("Hospital_code", "bigint", False, False, []),
    ("Hospital_type_code", "varchar", False, False, [("isin", inlist(["a", "b", "c", "d", "e", "f", "g"]))]),
    ("City_Code_Hospital", "bigint", False, False, []),
    ("Hospital_region_code", "varchar", False, False, [("isin", inlist(["X", "Y", "Z"]))]),
    ("available_extra_rooms", "bigint", False, False, GE0),
    ("Department", "varchar", False, False, [("isin", inlist(
        ["TB & Chest disease", "anesthesia", "gynecology", "radiotherapy", "surgery"]))]),
    ("Ward_Type", "varchar", False, False, [("isin", inlist(["P", "Q", "R", "S", "T"]))]),
    ("Ward_Facility_Code", "varchar", False, False, [("isin", inlist(["A", "B", "C", "D", "E", "F"]))]),
    ("bed_grade", "double", True, False, [("isin", "@v not in (1.0, 2.0, 3.0, 4.0)")]),
    ("City_Code_Patient", "double", True, False, [("ge", "@v < 1")]),
    ("type_of_admission", "varchar", False, False, [("isin", inlist(["Emergency", "Trauma", "Urgent"]))]),
    ("severity_of_illness", "varchar", False, False, [("isin", inlist(["Minor", "Moderate", "Extreme"]))]),
    ("visitors_with_patient", "bigint", False, False, GE0),
    ("Age", "varchar", False, False, [("isin", inlist(HOSPITAL_AGES))]),
    ("Admission_Deposit", "double", False, False, GE0),
    ("Stay", "varchar", False, False, [("isin", inlist(HOSPITAL_AGES + ["More than 100 Days"]))]),
]
# -- fixed values: columns, types and legal values of diabetes encounters
DIABETES_AGES = [
    "[0-10)",
    "[10-20)",
    "[20-30)",
    "[30-40)",
    "[40-50)",
    "[50-60)",
    "[60-70)",
    "[70-80)",
    "[80-90)",
    "[90-100)",
]
DIABETES_RULES = [
    ("encounter_id", "varchar", False, True, []),
    ("patient_nbr", "varchar", False, False, []),
    ("race", "varchar", True, False, []),
    ("gender", "varchar", False, False, [("isin", inlist(["Female", "Male", "Unknown/Invalid"]))]),
    ("age", "varchar", False, False, [("isin", inlist(DIABETES_AGES))]),
    ("weight", "varchar", True, False, []),
    ("admission_type_id", "bigint", False, False, [("in_range", "not (@v between 1 and 8)")]),
    ("discharge_disposition_id", "bigint", False, False, [("ge", "@v < 1")]),
    ("admission_source_id", "bigint", False, False, [("ge", "@v < 1")]),
    ("time_in_hospital", "bigint", False, False, GE0),
    ("payer_code", "varchar", True, False, []),
    ("medical_specialty", "varchar", True, False, []),
    ("num_lab_procedures", "bigint", False, False, GE0),
    ("num_procedures", "bigint", False, False, GE0),
    ("num_medications", "bigint", False, False, GE0),
    ("number_outpatient", "bigint", False, False, GE0),
    ("number_emergency", "bigint", False, False, GE0),
    ("number_inpatient", "bigint", False, False, GE0),
    ("diag_1", "varchar", True, False, []),
    ("diag_2", "varchar", True, False, []),
    ("diag_3", "varchar", True, False, []),
    ("number_diagnoses", "bigint", False, False, GE0),
    ("max_glu_serum", "varchar", True, False, [("isin", inlist(["Norm", ">200", ">300"]))]),
    ("A1Cresult", "varchar", True, False, [("isin", inlist(["Norm", ">7", ">8"]))]),
    *[(m, "varchar", False, False, [("isin", inlist(["No", "Steady", "Up", "Down"]))]) for m in MEDS],
    ("change", "varchar", False, False, [("isin", inlist(["No", "Ch"]))]),
    ("diabetesMed", "varchar", False, False, [("isin", inlist(["Yes", "No"]))]),
    ("readmitted", "varchar", False, False, [("isin", inlist(["NO", ">30", "<30"]))]),
]

RULES = {
    "beneficiary": BENE_RULES,
    "inpatient_claims": INPATIENT_RULES,
    "outpatient_claims": OUTPATIENT_RULES,
    "providers": PROVIDER_RULES,
    "diabetes_encounters": DIABETES_RULES,
    "hospital_admissions": HOSPITAL_RULES,
}


def _src_ctes() -> list[tuple[str, str]]:
    even_c = "(select * from customer where c_custkey % 2 = 0)"
    test_c = "(select * from customer where c_custkey % 2 = 1 or c_custkey % 10 = 0)"
    even_s = "(select * from supplier where s_suppkey % 2 = 0)"
    diab_cols = [r[0] for r in DIABETES_RULES]
    na_diab = ", ".join(
        f"case when {q(c)} in ({NA}) then null when {q(c)} = '?' then null else {q(c)} end as {q(c)}"
        if t == "varchar"
        else q(c)
        for c, t, *_ in DIABETES_RULES
    )
    hosp_cols = [q(r[0]) for r in HOSPITAL_RULES if r[0] not in ("admission_id", "Age", "Stay", "Admission_Deposit")]
    return [
        ("bene_train", view(fx.RAW_BENEFICIARY_SQL, customer=even_c)),
        ("bene_test", view(fx.RAW_BENEFICIARY_SQL, customer=test_c)),
        (
            "src_beneficiary",
            "select * exclude (rnk, rn) from (select *, row_number() over "
            "(partition by BeneID order by rnk) as rn from "
            "(select *, 0 as rnk from bene_train union all select *, 1 as rnk from bene_test)) "
            "where rn = 1",
        ),
        ("claims_base", view(fx.CLAIMS_BASE_SQL, orders="orders", lineitem="lineitem")),
        ("src_inpatient_claims", "select * exclude (_status) from claims_base where _status = 'F'"),
        (
            "src_outpatient_claims",
            "select * exclude (_status, AdmissionDt, DischargeDt, DiagnosisGroupCode) "
            "from claims_base where _status <> 'F'",
        ),
        ("prov_train", view(fx.RAW_PROVIDERS_SQL, supplier=even_s)),
        (
            "src_providers",
            "select Provider, PotentialFraud from (select *, row_number() over "
            "(partition by Provider order by rnk) as rn from "
            "(select Provider, PotentialFraud, 0 as rnk from prov_train union all "
            "select 'PRV' || cast(s_suppkey as varchar), null, 1 from supplier)) where rn = 1",
        ),
        ("diab_raw", view(fx.RAW_DIABETES_SQL, events="events")),
        ("src_diabetes_encounters", f"select {na_diab} from diab_raw"),
        ("hosp_raw", view(fx.RAW_HOSPITAL_SQL, lineitem="lineitem")),
        (
            "src_hospital_admissions",
            "select " + ", ".join(hosp_cols) + ", "
            "case when Age = '20-Nov' then '11-20' else Age end as Age, Admission_Deposit, "
            "case when Stay = '20-Nov' then '11-20' else Stay end as Stay, "
            "md5(case_id || '-' || patientid) as admission_id from hosp_raw",
        ),
    ]


def _validation_ctes() -> list[tuple[str, str]]:
    out = []
    for table, rules in RULES.items():
        reasons, typed = rules_text(rules)
        out.append((f"ann_{table}", f"select *, {reasons} as reasons from src_{table}"))
        declared = {r[0] for r in rules}
        out.append(
            (
                f"raw_{table}",
                f"select {typed}, timestamp '{BATCH_TS}' as ingested_at "
                f"from ann_{table} where reasons = ''",
            )
        )
        assert declared
    return out


def raw_ctes() -> list[tuple[str, str]]:
    return _src_ctes() + _validation_ctes()
