"""Clinical-shaped raw inputs derived from the driver's test tables.

The test tables hold no clinical data, so each raw source is a deterministic
SQL view over them (FIXTURES.md section B). The views carry dirty rows on
purpose: negative amounts, a birth year of 1875, claims without a provider,
``?`` and ``None`` tokens, ``20-Nov`` brackets, duplicate admission pairs and
an unknown department, so that every contract and check has work to do.

The SQL is bound with DataFrame parameters (``spark.sql(text, customer=df)``)
so no global temp view is involved. ``{name}`` marks an input table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caremarts.sources.testdata import read_table

# -- fixed values: the section-B view texts, as written in FIXTURES.md --------

RAW_BENEFICIARY_SQL = """
select 'BENE' || cast(c_custkey as string) as BeneID,
  cast(case when c_custkey % 211 = 0 then date '1875-01-01' else date '1920-01-01' + cast((c_custkey * 37) % 25000 as int) end as string) as DOB,
  cast(case when c_custkey % 50 = 0 then date '2001-12-01' end as string) as DOD,
  cast(c_custkey % 2 as int) + 1 as Gender, cast(c_custkey % 5 as int) + 1 as Race,
  case when c_custkey % 9 = 0 then 'Y' else '0' end as RenalDiseaseIndicator,
  c_nationkey as State, cast(c_custkey % 999 as int) as County,
  12 as NoOfMonths_PartACov, 12 as NoOfMonths_PartBCov,
  case when (c_custkey + 0) % 3 = 0 then 1 else 2 end as ChronicCond_Alzheimer,
  case when (c_custkey + 1) % 3 = 0 then 1 else 2 end as ChronicCond_Heartfailure,
  case when (c_custkey + 2) % 3 = 0 then 1 else 2 end as ChronicCond_KidneyDisease,
  case when (c_custkey + 3) % 3 = 0 then 1 else 2 end as ChronicCond_Cancer,
  case when (c_custkey + 4) % 3 = 0 then 1 else 2 end as ChronicCond_ObstrPulmonary,
  case when (c_custkey + 5) % 3 = 0 then 1 else 2 end as ChronicCond_Depression,
  case when (c_custkey + 6) % 3 = 0 then 1 else 2 end as ChronicCond_Diabetes,
  case when (c_custkey + 7) % 3 = 0 then 1 else 2 end as ChronicCond_IschemicHeart,
  case when (c_custkey + 8) % 3 = 0 then 1 else 2 end as ChronicCond_Osteoporasis,
  case when (c_custkey + 9) % 3 = 0 then 1 else 2 end as ChronicCond_rheumatoidarthritis,
  case when (c_custkey + 10) % 3 = 0 then 1 else 2 end as ChronicCond_stroke,
  c_acctbal as IPAnnualReimbursementAmt, abs(c_acctbal) / 10 as IPAnnualDeductibleAmt,
  abs(c_acctbal) / 2 as OPAnnualReimbursementAmt, abs(c_acctbal) / 20 as OPAnnualDeductibleAmt
from {customer}
"""

CLAIMS_BASE_SQL = """
select 'BENE' || cast(o_custkey as string) as BeneID, 'CLM' || cast(o_orderkey as string) as ClaimID,
  cast(cast(o_orderdate as date) as string) as ClaimStartDt,
  cast(cast(o_orderdate as date) + (cast(o_orderkey % 15 as int) - 1) as string) as ClaimEndDt,
  'PRV' || cast(f.first_supp as string) as Provider, o_totalprice as InscClaimAmtReimbursed,
  'PHY' || cast(o_orderkey % 50 as string) as AttendingPhysician,
  case when o_orderkey % 3 = 0 then 'PHY' || cast(o_orderkey % 41 as string) end as OperatingPhysician,
  case when o_orderkey % 5 = 0 then 'PHY' || cast(o_orderkey % 31 as string) end as OtherPhysician,
  cast(cast(o_orderdate as date) as string) as AdmissionDt, cast(o_orderkey % 777 as string) as ClmAdmitDiagnosisCode,
  case when o_orderkey % 7 = 0 then null else cast(1068 as double) end as DeductibleAmtPaid,
  cast(cast(o_orderdate as date) + cast(o_orderkey % 30 as int) as string) as DischargeDt,
  cast(100 + o_orderkey % 800 as string) as DiagnosisGroupCode,
  case when o_orderkey % 1 = 0 then cast(o_orderkey % 991 as string) end as ClmDiagnosisCode_1,
  case when o_orderkey % 2 = 0 then cast(o_orderkey % 992 as string) end as ClmDiagnosisCode_2,
  case when o_orderkey % 3 = 0 then cast(o_orderkey % 993 as string) end as ClmDiagnosisCode_3,
  case when o_orderkey % 4 = 0 then cast(o_orderkey % 994 as string) end as ClmDiagnosisCode_4,
  case when o_orderkey % 5 = 0 then cast(o_orderkey % 995 as string) end as ClmDiagnosisCode_5,
  case when o_orderkey % 6 = 0 then cast(o_orderkey % 996 as string) end as ClmDiagnosisCode_6,
  case when o_orderkey % 7 = 0 then cast(o_orderkey % 997 as string) end as ClmDiagnosisCode_7,
  case when o_orderkey % 8 = 0 then cast(o_orderkey % 998 as string) end as ClmDiagnosisCode_8,
  case when o_orderkey % 9 = 0 then cast(o_orderkey % 999 as string) end as ClmDiagnosisCode_9,
  case when o_orderkey % 10 = 0 then cast(o_orderkey % 1000 as string) end as ClmDiagnosisCode_10,
  case when o_orderkey % 3 = 0 then cast(9000 + o_orderkey % 91 as string) end as ClmProcedureCode_1,
  case when o_orderkey % 6 = 0 then cast(9000 + o_orderkey % 92 as string) end as ClmProcedureCode_2,
  case when o_orderkey % 9 = 0 then cast(9000 + o_orderkey % 93 as string) end as ClmProcedureCode_3,
  case when o_orderkey % 12 = 0 then cast(9000 + o_orderkey % 94 as string) end as ClmProcedureCode_4,
  case when o_orderkey % 15 = 0 then cast(9000 + o_orderkey % 95 as string) end as ClmProcedureCode_5,
  case when o_orderkey % 18 = 0 then cast(9000 + o_orderkey % 96 as string) end as ClmProcedureCode_6,
  o_orderstatus as _status
from {orders} left join (select l_orderkey, min(l_suppkey) as first_supp from {lineitem} group by l_orderkey) f
  on f.l_orderkey = o_orderkey
"""

RAW_PROVIDERS_SQL = """
select 'PRV' || cast(s_suppkey as string) as Provider,
  case cast(s_suppkey % 3 as int) when 0 then 'Yes' when 1 then 'No' end as PotentialFraud
from {supplier}
"""

RAW_DIABETES_SQL = """
select cast(event_id as string) as encounter_id, cast(user_id as string) as patient_nbr,
  case when event_id % 10 = 0 then '?' else 'Caucasian' end as race,
  case cast(user_id % 2 as int) when 0 then 'Female' else 'Male' end as gender,
  '[' || cast(10 * (user_id % 10) as string) || '-' || cast(10 * (user_id % 10) + 10 as string) || ')' as age,
  case when event_id % 20 = 0 then '[75-100)' else '?' end as weight,
  cast(event_id % 8 as int) + 1 as admission_type_id,
  cast(event_id % 6 as int) + 1 as discharge_disposition_id, cast(event_id % 9 as int) + 1 as admission_source_id,
  cast(event_id % 14 as int) + 1 as time_in_hospital,
  case when event_id % 3 = 0 then '?' else 'MC' end as payer_code,
  case when event_id % 2 = 0 then '?' else 'InternalMedicine' end as medical_specialty,
  cast(event_id % 97 as int) as num_lab_procedures, cast(event_id % 7 as int) as num_procedures, cast(event_id % 40 as int) as num_medications,
  cast(event_id % 5 as int) as number_outpatient, cast(event_id % 4 as int) as number_emergency, cast(event_id % 6 as int) as number_inpatient,
  '250.' || cast(10 + event_id % 80 as string) as diag_1, cast(400 + event_id % 60 as string) as diag_2,
  case when event_id % 70 = 0 then '?' else 'V27' end as diag_3, cast(event_id % 16 as int) as number_diagnoses,
  case cast(event_id % 4 as int) when 0 then 'Norm' when 1 then '>200' when 2 then '>300' else 'None' end as max_glu_serum,
  case cast(event_id % 5 as int) when 0 then 'Norm' when 1 then '>7' when 2 then '>8' else 'None' end as A1Cresult,
  case cast((event_id + 0) % 9 as int) when 0 then 'Steady' when 1 then 'Up' when 2 then 'Down' else 'No' end as metformin,
  case cast((event_id + 1) % 9 as int) when 0 then 'Steady' when 1 then 'Up' when 2 then 'Down' else 'No' end as repaglinide,
  case cast((event_id + 2) % 9 as int) when 0 then 'Steady' when 1 then 'Up' when 2 then 'Down' else 'No' end as nateglinide,
  case cast((event_id + 3) % 9 as int) when 0 then 'Steady' when 1 then 'Up' when 2 then 'Down' else 'No' end as chlorpropamide,
  case cast((event_id + 4) % 9 as int) when 0 then 'Steady' when 1 then 'Up' when 2 then 'Down' else 'No' end as glimepiride,
  case cast((event_id + 5) % 9 as int) when 0 then 'Steady' when 1 then 'Up' when 2 then 'Down' else 'No' end as acetohexamide,
  case cast((event_id + 6) % 9 as int) when 0 then 'Steady' when 1 then 'Up' when 2 then 'Down' else 'No' end as glipizide,
  case cast((event_id + 7) % 9 as int) when 0 then 'Steady' when 1 then 'Up' when 2 then 'Down' else 'No' end as glyburide,
  case cast((event_id + 8) % 9 as int) when 0 then 'Steady' when 1 then 'Up' when 2 then 'Down' else 'No' end as tolbutamide,
  case cast((event_id + 9) % 9 as int) when 0 then 'Steady' when 1 then 'Up' when 2 then 'Down' else 'No' end as pioglitazone,
  case cast((event_id + 10) % 9 as int) when 0 then 'Steady' when 1 then 'Up' when 2 then 'Down' else 'No' end as rosiglitazone,
  case cast((event_id + 11) % 9 as int) when 0 then 'Steady' when 1 then 'Up' when 2 then 'Down' else 'No' end as acarbose,
  case cast((event_id + 12) % 9 as int) when 0 then 'Steady' when 1 then 'Up' when 2 then 'Down' else 'No' end as miglitol,
  case cast((event_id + 13) % 9 as int) when 0 then 'Steady' when 1 then 'Up' when 2 then 'Down' else 'No' end as troglitazone,
  case cast((event_id + 14) % 9 as int) when 0 then 'Steady' when 1 then 'Up' when 2 then 'Down' else 'No' end as tolazamide,
  case cast((event_id + 15) % 9 as int) when 0 then 'Steady' when 1 then 'Up' when 2 then 'Down' else 'No' end as examide,
  case cast((event_id + 16) % 9 as int) when 0 then 'Steady' when 1 then 'Up' when 2 then 'Down' else 'No' end as citoglipton,
  case when event_id % 101 = 0 then 'Maybe' when event_id % 2 = 0 then 'Steady' else 'No' end as insulin,
  case cast((event_id + 18) % 9 as int) when 0 then 'Steady' when 1 then 'Up' when 2 then 'Down' else 'No' end as glyburide_metformin,
  case cast((event_id + 19) % 9 as int) when 0 then 'Steady' when 1 then 'Up' when 2 then 'Down' else 'No' end as glipizide_metformin,
  case cast((event_id + 20) % 9 as int) when 0 then 'Steady' when 1 then 'Up' when 2 then 'Down' else 'No' end as glimepiride_pioglitazone,
  case cast((event_id + 21) % 9 as int) when 0 then 'Steady' when 1 then 'Up' when 2 then 'Down' else 'No' end as metformin_rosiglitazone,
  case cast((event_id + 22) % 9 as int) when 0 then 'Steady' when 1 then 'Up' when 2 then 'Down' else 'No' end as metformin_pioglitazone,
  case when event_id % 2 = 0 then 'Ch' else 'No' end as change,
  case when event_id % 4 = 0 then 'No' else 'Yes' end as diabetesMed,
  case event_type when 'error' then '<30' when 'purchase' then '>30' else 'NO' end as readmitted
from {events}
"""

RAW_HOSPITAL_SQL = """
select cast(l_orderkey % 3601 as string) as case_id, cast(l_partkey as string) as patientid,
  cast(l_suppkey % 32 as int) as Hospital_code, case cast(l_suppkey % 7 as int) when 0 then 'a' when 1 then 'b' when 2 then 'c' when 3 then 'd' when 4 then 'e' when 5 then 'f' else 'g' end as Hospital_type_code,
  cast(l_suppkey % 13 as int) as City_Code_Hospital, case cast(l_suppkey % 3 as int) when 0 then 'X' when 1 then 'Y' else 'Z' end as Hospital_region_code,
  cast(l_quantity as int) as available_extra_rooms,
  case when l_orderkey % 97 = 0 then 'ENT' else case cast(l_partkey % 5 as int) when 0 then 'TB & Chest disease' when 1 then 'anesthesia' when 2 then 'gynecology' when 3 then 'radiotherapy' else 'surgery' end end as Department,
  case cast(l_partkey % 5 as int) when 0 then 'P' when 1 then 'Q' when 2 then 'R' when 3 then 'S' else 'T' end as Ward_Type, case cast(l_partkey % 6 as int) when 0 then 'A' when 1 then 'B' when 2 then 'C' when 3 then 'D' when 4 then 'E' else 'F' end as Ward_Facility_Code,
  case when l_orderkey % 160 = 0 then null else cast(1 + l_partkey % 4 as double) end as bed_grade,
  case when l_orderkey % 41 = 0 then null else cast(1 + l_partkey % 38 as double) end as City_Code_Patient,
  case l_returnflag when 'A' then 'Emergency' when 'R' then 'Trauma' else 'Urgent' end as type_of_admission,
  case cast(l_orderkey % 3 as int) when 0 then 'Minor' when 1 then 'Moderate' else 'Extreme' end as severity_of_illness,
  l_linenumber as visitors_with_patient,
  case cast(l_partkey % 10 as int) when 0 then '0-10' when 1 then '20-Nov' when 2 then '21-30' when 3 then '31-40' when 4 then '41-50' when 5 then '51-60' when 6 then '61-70' when 7 then '71-80' when 8 then '81-90' else '91-100' end as Age, l_extendedprice as Admission_Deposit,
  case cast((l_orderkey + l_linenumber) % 11 as int) when 0 then '0-10' when 1 then '20-Nov' when 2 then '21-30' when 3 then '31-40' when 4 then '41-50' when 5 then '51-60' when 6 then '61-70' when 7 then '71-80' when 8 then '81-90' when 9 then '91-100' else 'More than 100 Days' end as Stay
from {lineitem}
"""

# Columns the outpatient extract does not have (FIXTURES.md section B).
OUTPATIENT_MISSING = ("AdmissionDt", "DischargeDt", "DiagnosisGroupCode")


@dataclass(frozen=True)
class RawSources:
    """The raw extracts of all three sources, before any cleaning."""

    beneficiary_train: DataFrame
    beneficiary_test: DataFrame
    inpatient: DataFrame
    outpatient: DataFrame
    providers_train: DataFrame
    providers_test: DataFrame
    diabetes: DataFrame
    hospital: DataFrame


def raw_beneficiary(spark: SparkSession, customer: DataFrame) -> DataFrame:
    return spark.sql(RAW_BENEFICIARY_SQL, customer=customer)


def claims_base(spark: SparkSession, orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    return spark.sql(CLAIMS_BASE_SQL, orders=orders, lineitem=lineitem)


def raw_providers(spark: SparkSession, supplier: DataFrame) -> DataFrame:
    return spark.sql(RAW_PROVIDERS_SQL, supplier=supplier)


def raw_diabetes(spark: SparkSession, events: DataFrame) -> DataFrame:
    return spark.sql(RAW_DIABETES_SQL, events=events)


def raw_hospital(spark: SparkSession, lineitem: DataFrame) -> DataFrame:
    return spark.sql(RAW_HOSPITAL_SQL, lineitem=lineitem)


def raw_inpatient(base: DataFrame) -> DataFrame:
    return base.filter(F.col("_status") == "F").drop("_status")


def raw_outpatient(base: DataFrame) -> DataFrame:
    return base.filter(F.col("_status") != "F").drop("_status", *OUTPATIENT_MISSING)


def raw_sources(spark: SparkSession, sf_dir: str) -> RawSources:
    """All raw extracts over the test tables in ``sf_dir``.

    Train/test splits (for the split union and keep-first dedup): beneficiary
    train holds even customer keys, test odd keys or multiples of 10, so keys
    that are multiples of 10 arrive twice; provider train holds even supplier
    keys, test every supplier without the label column.
    """
    customer = read_table(spark, sf_dir, "customer")
    supplier = read_table(spark, sf_dir, "supplier")
    base = claims_base(
        spark, read_table(spark, sf_dir, "orders"), read_table(spark, sf_dir, "lineitem")
    )
    key = F.col("c_custkey")
    skey = F.col("s_suppkey")
    return RawSources(
        beneficiary_train=raw_beneficiary(spark, customer.filter(key % 2 == 0)),
        beneficiary_test=raw_beneficiary(
            spark, customer.filter((key % 2 == 1) | (key % 10 == 0))
        ),
        inpatient=raw_inpatient(base),
        outpatient=raw_outpatient(base),
        providers_train=raw_providers(spark, supplier.filter(skey % 2 == 0)),
        providers_test=raw_providers(spark, supplier).drop("PotentialFraud"),
        diabetes=raw_diabetes(spark, read_table(spark, sf_dir, "events")),
        hospital=raw_hospital(spark, read_table(spark, sf_dir, "lineitem")),
    )
