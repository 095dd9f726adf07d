"""Table contracts as data (V9).

A contract lists the declared columns of a raw table with a type and row rules.
Contracts are *not strict*: undeclared columns pass through untouched, while a
declared column missing from the frame fails the whole load (V7).

Column names are the canonical ones used after reading (see
``SOURCE_RENAMES``): source spellings with spaces or hyphens are mapped to
snake_case on read.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# -- fixed values: the eleven chronic-condition flags of a beneficiary --------
CHRONIC_CONDITION_COLS = (
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
)

DIAGNOSIS_COLS = tuple(f"ClmDiagnosisCode_{i}" for i in range(1, 11))
PROCEDURE_COLS = tuple(f"ClmProcedureCode_{i}" for i in range(1, 7))

# -- fixed values: the 23 tracked diabetes medications (canonical spelling) ---
DIABETES_MED_COLS = (
    "metformin",
    "repaglinide",
    "nateglinide",
    "chlorpropamide",
    "glimepiride",
    "acetohexamide",
    "glipizide",
    "glyburide",
    "tolbutamide",
    "pioglitazone",
    "rosiglitazone",
    "acarbose",
    "miglitol",
    "troglitazone",
    "tolazamide",
    "examide",
    "citoglipton",
    "insulin",
    "glyburide_metformin",
    "glipizide_metformin",
    "glimepiride_pioglitazone",
    "metformin_rosiglitazone",
    "metformin_pioglitazone",
)

# -- fixed values: value sets of the contracts --------------------------------
DIABETES_AGE_BRACKETS = (
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
)
MED_VALUES = ("No", "Steady", "Up", "Down")
HOSPITAL_AGE_BRACKETS = (
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
)
HOSPITAL_STAY_BRACKETS = (*HOSPITAL_AGE_BRACKETS, "More than 100 Days")
HOSPITAL_TYPE_CODES = ("a", "b", "c", "d", "e", "f", "g")
HOSPITAL_REGION_CODES = ("X", "Y", "Z")
DEPARTMENTS = ("TB & Chest disease", "anesthesia", "gynecology", "radiotherapy", "surgery")
WARD_TYPES = ("P", "Q", "R", "S", "T")
WARD_FACILITY_CODES = ("A", "B", "C", "D", "E", "F")
ADMISSION_TYPES = ("Emergency", "Trauma", "Urgent")
SEVERITY_LEVELS = ("Minor", "Moderate", "Extreme")
DIABETES_GENDERS = ("Female", "Male", "Unknown/Invalid")
GLUCOSE_RESULTS = ("Norm", ">200", ">300")
A1C_RESULTS = ("Norm", ">7", ">8")
CHANGE_VALUES = ("No", "Ch")
YES_NO = ("Yes", "No")
READMITTED_VALUES = ("NO", ">30", "<30")

# -- fixed values: source spellings mapped to canonical column names ----------
SOURCE_RENAMES = {
    "hospital_admissions": {
        "Available Extra Rooms in Hospital": "available_extra_rooms",
        "Bed Grade": "bed_grade",
        "Type of Admission": "type_of_admission",
        "Severity of Illness": "severity_of_illness",
        "Visitors with Patient": "visitors_with_patient",
    },
    "diabetes_encounters": {
        "glyburide-metformin": "glyburide_metformin",
        "glipizide-metformin": "glipizide_metformin",
        "glimepiride-pioglitazone": "glimepiride_pioglitazone",
        "metformin-rosiglitazone": "metformin_rosiglitazone",
        "metformin-pioglitazone": "metformin_pioglitazone",
    },
}

# Spark types the contract coerces to.
TYPE_NAMES = {"str": "string", "int": "bigint", "float": "double"}


@dataclass(frozen=True)
class ColumnRule:
    """One declared column: type, nullability and value rules.

    Value rules skip nulls; ``nullable=False`` is its own rule.
    """

    dtype: str
    nullable: bool = False
    unique: bool = False
    isin: tuple | None = None
    ge: float | None = None
    between: tuple[float, float] | None = None

    @property
    def spark_type(self) -> str:
        return TYPE_NAMES[self.dtype]


@dataclass(frozen=True)
class Contract:
    name: str
    key: str
    columns: dict[str, ColumnRule] = field(default_factory=dict)

    @property
    def unique_columns(self) -> list[str]:
        return [c for c, r in self.columns.items() if r.unique]


def _text(nullable: bool = True, **kw) -> ColumnRule:
    return ColumnRule("str", nullable=nullable, **kw)


def _count() -> ColumnRule:
    """A whole number of things: never missing, never below zero."""
    return ColumnRule("int", nullable=False, ge=0)


# -- fixed values: columns, types and legal values of the six raw tables ------
BENEFICIARY = Contract(
    "beneficiary",
    "BeneID",
    {
        "BeneID": ColumnRule("str", unique=True),
        "DOB": ColumnRule("str"),
        "DOD": _text(),
        "Gender": ColumnRule("int"),
        "Race": ColumnRule("int"),
        "RenalDiseaseIndicator": ColumnRule("str"),
        "State": ColumnRule("int"),
        "County": ColumnRule("int"),
        "NoOfMonths_PartACov": ColumnRule("int"),
        "NoOfMonths_PartBCov": ColumnRule("int"),
        **{c: ColumnRule("int", isin=(1, 2)) for c in CHRONIC_CONDITION_COLS},
        "IPAnnualReimbursementAmt": ColumnRule("float", ge=0),
        "IPAnnualDeductibleAmt": ColumnRule("float", ge=0),
        "OPAnnualReimbursementAmt": ColumnRule("float", ge=0),
        "OPAnnualDeductibleAmt": ColumnRule("float", ge=0),
    },
)

_CLAIM_HEAD = {
    "BeneID": ColumnRule("str"),
    "ClaimID": ColumnRule("str", unique=True),
    "ClaimStartDt": ColumnRule("str"),
    "ClaimEndDt": ColumnRule("str"),
    "Provider": ColumnRule("str"),
    "InscClaimAmtReimbursed": ColumnRule("float", ge=0),
    "AttendingPhysician": _text(),
    "OperatingPhysician": _text(),
    "OtherPhysician": _text(),
}
_CODES = {c: _text() for c in (*DIAGNOSIS_COLS, *PROCEDURE_COLS)}

INPATIENT_CLAIMS = Contract(
    "inpatient_claims",
    "ClaimID",
    {
        **_CLAIM_HEAD,
        "AdmissionDt": ColumnRule("str"),
        "ClmAdmitDiagnosisCode": _text(),
        "DeductibleAmtPaid": ColumnRule("float", nullable=True),
        "DischargeDt": ColumnRule("str"),
        "DiagnosisGroupCode": _text(),
        **_CODES,
    },
)

OUTPATIENT_CLAIMS = Contract(
    "outpatient_claims",
    "ClaimID",
    {
        **_CLAIM_HEAD,
        "ClmAdmitDiagnosisCode": _text(),
        "DeductibleAmtPaid": ColumnRule("float", nullable=True),
        **_CODES,
    },
)

PROVIDERS = Contract(
    "providers",
    "Provider",
    {
        "Provider": ColumnRule("str", unique=True),
        "PotentialFraud": _text(),
    },
)

HOSPITAL_ADMISSIONS = Contract(
    "hospital_admissions",
    "admission_id",
    {
        "admission_id": ColumnRule("str", unique=True),
        "case_id": ColumnRule("str"),
        "patientid": ColumnRule("str"),
        "Hospital_code": ColumnRule("int"),
        "Hospital_type_code": ColumnRule("str", isin=HOSPITAL_TYPE_CODES),
        "City_Code_Hospital": ColumnRule("int"),
        "Hospital_region_code": ColumnRule("str", isin=HOSPITAL_REGION_CODES),
        "available_extra_rooms": _count(),
        "Department": ColumnRule("str", isin=DEPARTMENTS),
        "Ward_Type": ColumnRule("str", isin=WARD_TYPES),
        "Ward_Facility_Code": ColumnRule("str", isin=WARD_FACILITY_CODES),
        "bed_grade": ColumnRule("float", nullable=True, isin=(1.0, 2.0, 3.0, 4.0)),
        "City_Code_Patient": ColumnRule("float", nullable=True, ge=1),
        "type_of_admission": ColumnRule("str", isin=ADMISSION_TYPES),
        "severity_of_illness": ColumnRule("str", isin=SEVERITY_LEVELS),
        "visitors_with_patient": _count(),
        "Age": ColumnRule("str", isin=HOSPITAL_AGE_BRACKETS),
        "Admission_Deposit": ColumnRule("float", ge=0),
        "Stay": ColumnRule("str", isin=HOSPITAL_STAY_BRACKETS),
    },
)

DIABETES_ENCOUNTERS = Contract(
    "diabetes_encounters",
    "encounter_id",
    {
        "encounter_id": ColumnRule("str", unique=True),
        "patient_nbr": ColumnRule("str"),
        "race": _text(),
        "gender": ColumnRule("str", isin=DIABETES_GENDERS),
        "age": ColumnRule("str", isin=DIABETES_AGE_BRACKETS),
        "weight": _text(),
        "admission_type_id": ColumnRule("int", between=(1, 8)),
        "discharge_disposition_id": ColumnRule("int", ge=1),
        "admission_source_id": ColumnRule("int", ge=1),
        "time_in_hospital": _count(),
        "payer_code": _text(),
        "medical_specialty": _text(),
        "num_lab_procedures": _count(),
        "num_procedures": _count(),
        "num_medications": _count(),
        "number_outpatient": _count(),
        "number_emergency": _count(),
        "number_inpatient": _count(),
        "diag_1": _text(),
        "diag_2": _text(),
        "diag_3": _text(),
        "number_diagnoses": _count(),
        "max_glu_serum": _text(isin=GLUCOSE_RESULTS),
        "A1Cresult": _text(isin=A1C_RESULTS),
        **{c: ColumnRule("str", isin=MED_VALUES) for c in DIABETES_MED_COLS},
        "change": ColumnRule("str", isin=CHANGE_VALUES),
        "diabetesMed": ColumnRule("str", isin=YES_NO),
        "readmitted": ColumnRule("str", isin=READMITTED_VALUES),
    },
)

CONTRACTS: dict[str, Contract] = {
    c.name: c
    for c in (
        BENEFICIARY,
        INPATIENT_CLAIMS,
        OUTPATIENT_CLAIMS,
        PROVIDERS,
        DIABETES_ENCOUNTERS,
        HOSPITAL_ADMISSIONS,
    )
}
