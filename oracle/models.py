"""Staging, intermediate and mart models in DuckDB SQL (over ``raw_<t>`` CTEs)."""

from __future__ import annotations

from oracle.raw import CHRONIC, MEDS

FLAGS = [
    "has_alzheimers", "has_heart_failure", "has_kidney_disease", "has_cancer",
    "has_obstr_pulmonary", "has_depression", "has_diabetes", "has_ischemic_heart",
    "has_osteoporosis", "has_rheumatoid_arthritis", "has_stroke",
]
DIAG = [f"diagnosis_code_{i}" for i in range(1, 11)]
PROC = [f"procedure_code_{i}" for i in range(1, 7)]
CODES_SEL = ", ".join(
    [f'"ClmDiagnosisCode_{i}" as diagnosis_code_{i}' for i in range(1, 11)]
    + [f'"ClmProcedureCode_{i}" as procedure_code_{i}' for i in range(1, 7)]
)
CODE_NAMES = ", ".join(DIAG + PROC)

STG_BENEFICIARY = (
    "select BeneID as bene_id, cast(DOB as date) as date_of_birth, cast(DOD as date) as date_of_death, "
    "case Gender when 1 then 'Male' when 2 then 'Female' end as gender, "
    "case Race when 1 then 'White' when 2 then 'Black' when 3 then 'Other' when 5 then 'Hispanic' "
    "else 'Unknown' end as race, RenalDiseaseIndicator as renal_disease_indicator, "
    "State as state_code, County as county_code, NoOfMonths_PartACov as months_part_a_coverage, "
    "NoOfMonths_PartBCov as months_part_b_coverage, "
    + ", ".join(f'("{c}" = 1) as {f}' for c, f in zip(CHRONIC, FLAGS))
    + ", cast(cast(IPAnnualReimbursementAmt as varchar) as decimal(12,2)) as ip_annual_reimbursement"
    ", cast(cast(IPAnnualDeductibleAmt as varchar) as decimal(12,2)) as ip_annual_deductible"
    ", cast(cast(OPAnnualReimbursementAmt as varchar) as decimal(12,2)) as op_annual_reimbursement"
    ", cast(cast(OPAnnualDeductibleAmt as varchar) as decimal(12,2)) as op_annual_deductible "
    "from raw_beneficiary"
)

STG_INPATIENT = (
    "select BeneID as bene_id, ClaimID as claim_id, Provider as provider_id, 'inpatient' as claim_type, "
    "cast(ClaimStartDt as date) as claim_start_date, cast(ClaimEndDt as date) as claim_end_date, "
    "cast(AdmissionDt as date) as admission_date, cast(DischargeDt as date) as discharge_date, "
    "cast(cast(DischargeDt as date) - cast(AdmissionDt as date) as integer) as claim_duration_days, "
    "cast(cast(InscClaimAmtReimbursed as varchar) as decimal(12,2)) as reimbursement_amount, "
    "cast(cast(DeductibleAmtPaid as varchar) as decimal(12,2)) as deductible_amount, "
    "AttendingPhysician as attending_physician, OperatingPhysician as operating_physician, "
    "OtherPhysician as other_physician, ClmAdmitDiagnosisCode as admit_diagnosis_code, "
    "DiagnosisGroupCode as diagnosis_group_code, " + CODES_SEL + " from raw_inpatient_claims"
)

STG_OUTPATIENT = (
    "select BeneID as bene_id, ClaimID as claim_id, Provider as provider_id, 'outpatient' as claim_type, "
    "cast(ClaimStartDt as date) as claim_start_date, cast(ClaimEndDt as date) as claim_end_date, "
    "cast(cast(InscClaimAmtReimbursed as varchar) as decimal(12,2)) as reimbursement_amount, "
    "cast(cast(DeductibleAmtPaid as varchar) as decimal(12,2)) as deductible_amount, "
    "AttendingPhysician as attending_physician, OperatingPhysician as operating_physician, "
    "OtherPhysician as other_physician, ClmAdmitDiagnosisCode as admit_diagnosis_code, "
    + CODES_SEL + " from raw_outpatient_claims"
)

STG_PROVIDERS = (
    "select Provider as provider_id, case PotentialFraud when 'Yes' then true when 'No' then false "
    "end as is_potential_fraud from raw_providers"
)

STG_DIABETES = (
    "select encounter_id, patient_nbr, race, gender, age as age_bracket, weight, "
    "cast(admission_type_id as integer) as admission_type_id, "
    "cast(discharge_disposition_id as integer) as discharge_disposition_id, "
    "cast(admission_source_id as integer) as admission_source_id, medical_specialty, payer_code, "
    + ", ".join(
        f"cast({c} as integer) as {c}"
        for c in [
            "time_in_hospital", "num_lab_procedures", "num_procedures", "num_medications",
            "number_outpatient", "number_emergency", "number_inpatient", "number_diagnoses",
        ]
    )
    + ", diag_1, diag_2, diag_3, max_glu_serum, A1Cresult as a1c_result, "
    + ", ".join(MEDS)
    + ", (change = 'Ch') as had_med_change, (diabetesMed = 'Yes') as on_diabetes_med, "
    "readmitted as readmitted_status, (readmitted = '<30') as is_readmitted_30d "
    "from raw_diabetes_encounters"
)

STG_HOSPITAL = (
    "select admission_id, case_id, patientid as patient_id, cast(Hospital_code as integer) as hospital_code, "
    "Hospital_type_code as hospital_type_code, cast(City_Code_Hospital as integer) as city_code_hospital, "
    "Hospital_region_code as hospital_region_code, Ward_Type as ward_type, "
    "Ward_Facility_Code as ward_facility_code, Department as department, "
    "cast(bed_grade as integer) as bed_grade, cast(available_extra_rooms as integer) as available_extra_rooms, "
    "cast(City_Code_Patient as integer) as city_code_patient, type_of_admission, severity_of_illness, "
    "cast(visitors_with_patient as integer) as visitors_with_patient, Age as age_bracket, "
    "cast(cast(Admission_Deposit as varchar) as decimal(18,4)) as admission_deposit, Stay as length_of_stay_bracket "
    "from raw_hospital_admissions"
)

UNIFIED_COLS = (
    "bene_id, claim_id, provider_id, claim_type, claim_start_date, claim_end_date, admission_date, "
    "discharge_date, claim_duration_days, reimbursement_amount, deductible_amount, attending_physician, "
    "operating_physician, other_physician, admit_diagnosis_code, diagnosis_group_code, " + CODE_NAMES
)

INT_CLAIMS_UNIFIED = (
    f"select {UNIFIED_COLS} from stg_inpatient_claims union all "
    "select bene_id, claim_id, provider_id, claim_type, claim_start_date, claim_end_date, "
    "cast(null as date), cast(null as date), cast(null as integer), reimbursement_amount, deductible_amount, "
    "attending_physician, operating_physician, other_physician, admit_diagnosis_code, cast(null as varchar), "
    + CODE_NAMES + " from stg_outpatient_claims"
)


def claims_enriched_from(source: str) -> str:
    return (
        "select c.claim_id, c.bene_id, c.provider_id, c.claim_type, c.claim_start_date, c.claim_end_date, "
        "c.admission_date, c.discharge_date, c.claim_duration_days, c.reimbursement_amount, "
        "c.deductible_amount, c.attending_physician, c.operating_physician, c.other_physician, "
        "c.admit_diagnosis_code, c.diagnosis_group_code, "
        + ", ".join("c." + x for x in DIAG + PROC)
        + ", b.gender, b.race, b.date_of_birth, "
        "cast(extract(year from age(c.claim_start_date, b.date_of_birth)) as integer) as age_at_claim, "
        + ", ".join("b." + f for f in FLAGS)
        + f" from {source} c left join stg_beneficiary b on c.bene_id = b.bene_id"
    )


INT_CLAIMS_ENRICHED = claims_enriched_from("int_claims_unified")

INT_ENCOUNTERS = (
    "select encounter_id, patient_nbr, race, gender, age_bracket, admission_type_id, "
    "discharge_disposition_id, admission_source_id, medical_specialty, time_in_hospital, "
    "num_lab_procedures, num_procedures, num_medications, number_outpatient, number_emergency, "
    "number_inpatient, number_diagnoses, "
    "(number_outpatient + number_emergency + number_inpatient) as num_prior_visits, ("
    + " + ".join(f"cast(({m} <> 'No') as integer)" for m in MEDS)
    + ") as num_diabetes_meds, diag_1, diag_2, diag_3, max_glu_serum, a1c_result, insulin, metformin, "
    "had_med_change, on_diabetes_med, readmitted_status, is_readmitted_30d from stg_diabetes_encounters"
)

INT_ADMISSIONS = (
    "select admission_id, case_id, patient_id, hospital_code, hospital_type_code, city_code_hospital, "
    "hospital_region_code, ward_type, ward_facility_code, department, bed_grade, available_extra_rooms, "
    "city_code_patient, type_of_admission, severity_of_illness, visitors_with_patient, age_bracket, "
    "admission_deposit, length_of_stay_bracket, los as length_of_stay_days, (los > 30) as is_long_stay "
    "from (select *, case length_of_stay_bracket when '0-10' then 5 when '11-20' then 15 "
    "when '21-30' then 25 when '31-40' then 35 when '41-50' then 45 when '51-60' then 55 "
    "when '61-70' then 65 when '71-80' then 75 when '81-90' then 85 when '91-100' then 95 "
    "when 'More than 100 Days' then 105 end as los from stg_hospital_admissions)"
)

FCT_CLAIMS_COLS = (
    "claim_id, bene_id, provider_id, claim_type, claim_start_date, claim_end_date, admission_date, "
    "discharge_date, claim_duration_days, reimbursement_amount, deductible_amount, age_at_claim, "
    "attending_physician, operating_physician, other_physician, admit_diagnosis_code, "
    "diagnosis_group_code, " + CODE_NAMES
)
FCT_CLAIMS = f"select {FCT_CLAIMS_COLS} from int_claims_enriched"

DIM_BENEFICIARY = (
    "select bene_id, date_of_birth, date_of_death, gender, race, renal_disease_indicator, state_code, "
    "county_code, months_part_a_coverage, months_part_b_coverage, "
    + ", ".join(FLAGS)
    + ", ip_annual_reimbursement as total_ip_reimbursement, op_annual_reimbursement as total_op_reimbursement, "
    "(" + " + ".join(f"cast({f} as integer)" for f in FLAGS) + ") as chronic_condition_count "
    "from stg_beneficiary"
)

def exact_mean(sum_expr: str, count_expr: str, scale: int, out_type: str, sum_scale: int = 4) -> str:
    """round(sum / count, scale), half away from zero, in integer arithmetic.

    DuckDB divides decimals in DOUBLE, which cannot round 1.005 to 1.01.
    """
    num = f"cast(({sum_expr}) * {10 ** sum_scale} as hugeint)"
    den = f"(cast({count_expr} as hugeint) * {10 ** sum_scale})"
    quot = f"(sign({num}) * ((2 * abs({num}) * {10 ** scale} + {den}) // (2 * {den})))"
    unit = "0." + "0" * (scale - 1) + "1"
    return f"cast(cast({quot} as decimal(38,0)) * {unit} as {out_type})"


DIM_PROVIDER = (
    "select p.provider_id, p.is_potential_fraud, cast(coalesce(m.total_claims, 0) as bigint) as total_claims, "
    "cast(coalesce(m.total_reimbursement, 0) as decimal(38,2)) as total_reimbursement, "
    "cast(coalesce(m.unique_beneficiaries, 0) as bigint) as unique_beneficiaries, "
    "cast(coalesce(m.avg_amt, 0) as decimal(12,2)) as avg_reimbursement_per_claim "
    "from stg_providers p left join (select provider_id, count(*) as total_claims, "
    "sum(reimbursement_amount) as total_reimbursement, count(distinct bene_id) as unique_beneficiaries, "
    + exact_mean("sum(reimbursement_amount)", "count(reimbursement_amount)", 2, "decimal(12,2)")
    + " as avg_amt from int_claims_unified group by provider_id) m on p.provider_id = m.provider_id"
)

FCT_ENCOUNTERS = (
    "select encounter_id, patient_nbr, admission_type_id, discharge_disposition_id, admission_source_id, "
    "medical_specialty, age_bracket, time_in_hospital, num_lab_procedures, num_procedures, num_medications, "
    "number_outpatient, number_emergency, number_inpatient, number_diagnoses, num_prior_visits, "
    "num_diabetes_meds, diag_1, diag_2, diag_3, max_glu_serum, a1c_result, insulin, metformin, "
    "had_med_change, on_diabetes_med, readmitted_status, is_readmitted_30d from int_encounters_enriched"
)

DIM_PATIENT = (
    "with latest as (select patient_nbr, race, gender, age_bracket from (select *, row_number() over "
    "(partition by patient_nbr order by cast(encounter_id as bigint) desc) as rn "
    "from stg_diabetes_encounters) where rn = 1), "
    "r as (select patient_nbr, count(*) as total_encounters, "
    "sum(case when is_readmitted_30d then 1 else 0 end) as num_readmissions_30d "
    "from stg_diabetes_encounters group by patient_nbr) "
    "select r.patient_nbr, d.race, d.gender, d.age_bracket as latest_age_bracket, "
    "cast(r.total_encounters as bigint) as total_encounters, "
    "cast(r.num_readmissions_30d as bigint) as num_readmissions_30d, "
    + exact_mean("r.num_readmissions_30d", "r.total_encounters", 4, "decimal(18,4)")
    + " as readmission_30d_rate from r join latest d using (patient_nbr)"
)

FCT_ADMISSIONS = (
    "select admission_id, case_id, patient_id, hospital_code, hospital_type_code, city_code_hospital, "
    "hospital_region_code, ward_type, ward_facility_code, department, bed_grade, city_code_patient, "
    "type_of_admission, severity_of_illness, age_bracket, available_extra_rooms, visitors_with_patient, "
    "admission_deposit, length_of_stay_bracket, length_of_stay_days, is_long_stay "
    "from int_admissions_enriched"
)

DIM_HOSPITAL_PATIENT = (
    "select patient_id, cast(count(*) as bigint) as total_admissions, "
    "cast(count(distinct hospital_code) as bigint) as distinct_hospitals, "
    + exact_mean("sum(length_of_stay_days)", "count(length_of_stay_days)", 2, "decimal(18,2)")
    + " as avg_length_of_stay_days, cast(sum(length_of_stay_days) as bigint) as total_length_of_stay_days, "
    "cast(sum(admission_deposit) as decimal(38,4)) as total_admission_deposit, "
    + exact_mean("sum(admission_deposit)", "count(admission_deposit)", 2, "decimal(18,2)")
    + " as avg_admission_deposit from int_admissions_enriched group by patient_id"
)

SEED_ADMISSION_TYPES = (
    "select * from (values (1, 'Emergency'), (2, 'Urgent'), (3, 'Elective'), (4, 'Newborn'), "
    "(5, 'Not Available'), (6, 'Unknown'), (7, 'Trauma Center'), (8, 'Not Mapped')) "
    "t(admission_type_id, admission_type_label)"
)
SEED_SEVERITY = (
    "select * from (values ('Minor', 1, 'Lowest acuity — least severe presentation'), "
    "('Moderate', 2, 'Intermediate acuity'), ('Extreme', 3, 'Highest acuity — most severe presentation')) "
    "t(severity_of_illness, severity_rank, severity_description)"
)


def model_ctes() -> list[tuple[str, str]]:
    return [
        ("stg_beneficiary", STG_BENEFICIARY),
        ("stg_inpatient_claims", STG_INPATIENT),
        ("stg_outpatient_claims", STG_OUTPATIENT),
        ("stg_providers", STG_PROVIDERS),
        ("stg_diabetes_encounters", STG_DIABETES),
        ("stg_hospital_admissions", STG_HOSPITAL),
        ("int_claims_unified", INT_CLAIMS_UNIFIED),
        ("int_claims_enriched", INT_CLAIMS_ENRICHED),
        ("int_encounters_enriched", INT_ENCOUNTERS),
        ("int_admissions_enriched", INT_ADMISSIONS),
        ("fct_claims", FCT_CLAIMS),
        ("dim_beneficiary", DIM_BENEFICIARY),
        ("dim_provider", DIM_PROVIDER),
        ("fct_encounters", FCT_ENCOUNTERS),
        ("dim_patient", DIM_PATIENT),
        ("fct_hospital_admissions", FCT_ADMISSIONS),
        ("dim_hospital_patient", DIM_HOSPITAL_PATIENT),
        ("seed_admission_types", SEED_ADMISSION_TYPES),
        ("seed_severity", SEED_SEVERITY),
    ]
