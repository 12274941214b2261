"""Fixed values of the cohort contract.

Everything in this module is a FIXED VALUE that must equal the studied
pipeline's rules for results to match: column lists, level sets, ranges,
code groupings and thresholds.  They are stated plainly and in their natural
order; no logic lives here.
"""
from __future__ import annotations

# ---------------------------------------------------------------------------
# FIXED VALUES: raw encounter table (50 columns, natural order)
# ---------------------------------------------------------------------------
RAW_COLUMNS = [
    "encounter_id", "patient_nbr", "race", "gender", "age", "weight",
    "admission_type_id", "discharge_disposition_id", "admission_source_id",
    "time_in_hospital", "payer_code", "medical_specialty", "num_lab_procedures",
    "num_procedures", "num_medications", "number_outpatient", "number_emergency",
    "number_inpatient", "diag_1", "diag_2", "diag_3", "number_diagnoses",
    "max_glu_serum", "A1Cresult", "metformin", "repaglinide", "nateglinide",
    "chlorpropamide", "glimepiride", "acetohexamide", "glipizide", "glyburide",
    "tolbutamide", "pioglitazone", "rosiglitazone", "acarbose", "miglitol",
    "troglitazone", "tolazamide", "examide", "citoglipton", "insulin",
    "glyburide-metformin", "glipizide-metformin", "glimepiride-pioglitazone",
    "metformin-rosiglitazone", "metformin-pioglitazone", "change", "diabetesMed",
    "readmitted",
]

KEY_COLS = ["encounter_id", "patient_nbr"]
TARGET_RAW = "readmitted"
TARGET = "target"
POSITIVE_LABEL = "<30"
READMITTED_VALUES = ["<30", ">30", "NO"]
MISSING_TOKEN = "?"

# 23 drug-dose columns in raw order; two are dropped in cleaning.
ALL_DRUGS = [
    "metformin", "repaglinide", "nateglinide", "chlorpropamide", "glimepiride",
    "acetohexamide", "glipizide", "glyburide", "tolbutamide", "pioglitazone",
    "rosiglitazone", "acarbose", "miglitol", "troglitazone", "tolazamide",
    "examide", "citoglipton", "insulin", "glyburide-metformin",
    "glipizide-metformin", "glimepiride-pioglitazone", "metformin-rosiglitazone",
    "metformin-pioglitazone",
]
DROPPED_IN_CLEANING = ["weight", "examide", "citoglipton"]
MODEL_DRUGS = [d for d in ALL_DRUGS if d not in DROPPED_IN_CLEANING]
DRUG_VALUES = ["No", "Down", "Steady", "Up"]
DRUG_ORDINAL = {"No": 0, "Down": 1, "Steady": 2, "Up": 3}

CATEGORICAL_VALUES = {
    "race": ["AfricanAmerican", "Asian", "Caucasian", "Hispanic", "Other"],
    "gender": ["Male", "Female", "Unknown/Invalid"],
    "age": ["[0-10)", "[10-20)", "[20-30)", "[30-40)", "[40-50)", "[50-60)",
            "[60-70)", "[70-80)", "[80-90)", "[90-100)"],
    "max_glu_serum": [">200", ">300", "None", "Norm"],
    "A1Cresult": [">7", ">8", "None", "Norm"],
    "change": ["Ch", "No"],
    "diabetesMed": ["No", "Yes"],
}
AGE_ORDER = CATEGORICAL_VALUES["age"]

STRING_FIELDS = ["payer_code", "medical_specialty", "diag_1", "diag_2", "diag_3"]

INT_RANGES = {
    "admission_type_id": (1, 8),
    "discharge_disposition_id": (1, 30),
    "admission_source_id": (1, 26),
    "time_in_hospital": (1, 14),
    "num_lab_procedures": (0, 200),
    "num_procedures": (0, 12),
    "num_medications": (0, 150),
    "number_outpatient": (0, 100),
    "number_emergency": (0, 100),
    "number_inpatient": (0, 50),
    "number_diagnoses": (1, 16),
}
INT_COLUMNS = list(INT_RANGES)

NULLABLE = ["race", "weight", "payer_code", "medical_specialty",
            "diag_1", "diag_2", "diag_3"]

# ---------------------------------------------------------------------------
# FIXED VALUES: cleaning rules
# ---------------------------------------------------------------------------
LAB_COLS = ["A1Cresult", "max_glu_serum"]
VALID_GENDERS = ["Male", "Female"]
EXPIRED_IDS = [11, 19, 20, 21]
HOSPICE_IDS = [13, 14]
EXPIRED_HOSPICE_IDS = [11, 13, 14, 19, 20, 21]
MISSING_AS_UNKNOWN = ["payer_code", "medical_specialty", "race"]
REJECTED_GENDER = "Unknown/Invalid"

# ---------------------------------------------------------------------------
# FIXED VALUES: featurized table
# ---------------------------------------------------------------------------
N_FEATURIZED_COLUMNS = 58
POS_RATE_RANGE = (0.08, 0.12)
DIAG_COLS = ["diag_1", "diag_2", "diag_3"]
DIAG_BUCKETS = ["Circulatory", "Respiratory", "Digestive", "Diabetes", "Injury",
                "Musculoskeletal", "Genitourinary", "Neoplasms", "Other", "Missing"]
ENGINEERED_FEATURES = [
    "diag_1_bucket", "diag_2_bucket", "diag_3_bucket", "diabetes_primary",
    "n_diabetes_diag", "n_med_changes", "n_meds_used", "a1c_measured",
    "glu_measured", "a1c_state", "service_utilization", "inpatient_ge_2",
    "age_midpoint", "age_bucket", "admission_type_grp", "admission_source_grp",
    "discharge_disposition_grp", "discharged_home",
]
A1C_STATE_VALUES = ["no_test", "normal", "high_changed", "high_not_changed"]
AGE_BUCKET_VALUES = ["[0-30)", "[30-60)", "[60-100)"]
A1C_MEASURED_LEVELS = [">7", ">8", "Norm"]
GLU_MEASURED_LEVELS = [">200", ">300", "Norm"]
A1C_HIGH_LEVELS = [">7", ">8"]
MED_CHANGE_LEVELS = ["Up", "Down"]

# ICD-9 chapter ranges, checked in this order (pipeline mapper).
ICD9_PIPELINE_RANGES = [
    ("Circulatory", [(390, 459), (785, 785)]),
    ("Respiratory", [(460, 519), (786, 786)]),
    ("Digestive", [(520, 579), (787, 787)]),
    ("Injury", [(800, 999)]),
    ("Musculoskeletal", [(710, 739)]),
    ("Genitourinary", [(580, 629), (788, 788)]),
    ("Neoplasms", [(140, 239)]),
]
# ICD-9 chapter ranges of the profiling mapper, checked in this order.
ICD9_EDA_RANGES = [
    (390, 459, "Circulatory"), (785, 785, "Circulatory"),
    (460, 519, "Respiratory"), (786, 786, "Respiratory"),
    (520, 579, "Digestive"), (787, 787, "Digestive"),
    (580, 629, "Genitourinary"), (788, 788, "Genitourinary"),
    (140, 239, "Neoplasms"),
    (710, 739, "Musculoskeletal"),
    (800, 999, "Injury"),
]
ICD9_CHAPTER_ORDER = ["Circulatory", "Respiratory", "Digestive", "Diabetes",
                      "Genitourinary", "Injury", "Musculoskeletal", "Neoplasms",
                      "Other", "Missing"]

# Admin id -> coarse group (unlisted codes fall back to "Unknown").
ADMISSION_TYPE_GROUP = {
    1: "Emergency", 2: "Urgent", 7: "Trauma",
    3: "Elective",
    4: "Newborn",
    5: "Unknown", 6: "Unknown", 8: "Unknown",
}
ADMISSION_SOURCE_GROUP = {
    1: "Referral", 2: "Referral", 3: "Referral",
    4: "Transfer", 5: "Transfer", 6: "Transfer",
    10: "Transfer", 22: "Transfer", 25: "Transfer",
    7: "EmergencyRoom",
    8: "Other",
    11: "Delivery", 13: "Delivery", 14: "Delivery",
    9: "Unknown", 17: "Unknown", 20: "Unknown",
}
DISCHARGE_DISPOSITION_GROUP = {
    1: "Home", 6: "Home", 8: "Home",
    2: "Transfer", 9: "Transfer", 10: "Transfer",
    16: "Transfer", 17: "Transfer",
    3: "Facility", 4: "Facility", 5: "Facility", 15: "Facility",
    22: "Facility", 23: "Facility", 24: "Facility",
    27: "Facility", 28: "Facility",
    7: "AMA",
    12: "Unknown", 18: "Unknown", 25: "Unknown",
}
DISCHARGED_HOME_CODES = [1, 6, 8]

# ---------------------------------------------------------------------------
# FIXED VALUES: code decoders (IDs mapping) and column families
# ---------------------------------------------------------------------------
ADMISSION_TYPE_LABELS = {
    1: "Emergency", 2: "Urgent", 3: "Elective", 4: "Newborn",
    5: "Not Available", 6: "NULL", 7: "Trauma Center", 8: "Not Mapped",
}
DISCHARGE_DISPOSITION_LABELS = {
    1: "Discharged to home",
    2: "Discharged/transferred to another short term hospital",
    3: "Discharged/transferred to SNF",
    4: "Discharged/transferred to ICF",
    5: "Discharged/transferred to another inpatient care institution",
    6: "Discharged/transferred to home with home health service",
    7: "Left AMA",
    8: "Discharged/transferred to home under care of Home IV provider",
    9: "Admitted as an inpatient to this hospital",
    10: "Neonate discharged to another hospital for neonatal aftercare",
    11: "Expired",
    12: "Still patient / expected to return for outpatient services",
    13: "Hospice / home",
    14: "Hospice / medical facility",
    15: "Discharged/transferred within this institution to Medicare swing bed",
    16: "Discharged/transferred to another institution for outpatient services",
    17: "Discharged/transferred to this institution for outpatient services",
    18: "NULL",
    19: "Expired at home. Medicaid only, hospice.",
    20: "Expired in a medical facility. Medicaid only, hospice.",
    21: "Expired, place unknown. Medicaid only, hospice.",
    22: "Discharged/transferred to another rehab facility (incl. rehab units)",
    23: "Discharged/transferred to a long term care hospital",
    24: "Discharged/transferred to a nursing facility (Medicaid, not Medicare)",
    25: "Not Mapped",
    26: "Unknown/Invalid",
    27: "Discharged/transferred to a federal health care facility",
    28: "Discharged/transferred to a psychiatric hospital / unit",
    29: "Discharged/transferred to a Critical Access Hospital (CAH)",
    30: "Discharged/transferred to another type of health care institution",
}
ADMISSION_SOURCE_LABELS = {
    1: "Physician Referral", 2: "Clinic Referral", 3: "HMO Referral",
    4: "Transfer from a hospital",
    5: "Transfer from a Skilled Nursing Facility (SNF)",
    6: "Transfer from another health care facility",
    7: "Emergency Room", 8: "Court/Law Enforcement", 9: "Not Available",
    10: "Transfer from critical access hospital",
    11: "Normal Delivery", 12: "Premature Delivery", 13: "Sick Baby",
    14: "Extramural Birth", 15: "Not Available", 17: "NULL",
    18: "Transfer From Another Home Health Agency",
    19: "Readmission to Same Home Health Agency",
    20: "Not Mapped", 21: "Unknown/Invalid",
    22: "Transfer from hospital inpt/same fac, separate claim",
    23: "Born inside this hospital", 24: "Born outside this hospital",
    25: "Transfer from Ambulatory Surgery Center", 26: "Transfer from Hospice",
}
ID_DECODERS = {
    "admission_type_id": ADMISSION_TYPE_LABELS,
    "discharge_disposition_id": DISCHARGE_DISPOSITION_LABELS,
    "admission_source_id": ADMISSION_SOURCE_LABELS,
}
ADMINISTRATIVE_ID_COLS = ["admission_type_id", "discharge_disposition_id",
                          "admission_source_id"]
UTILIZATION_NUMERIC_COLS = [
    "time_in_hospital", "num_lab_procedures", "num_procedures", "num_medications",
    "number_outpatient", "number_emergency", "number_inpatient", "number_diagnoses",
]
COLUMN_FAMILY = {
    "Identifier": ["encounter_id", "patient_nbr"],
    "Demographic": ["race", "gender", "age", "weight"],
    "Administrative ID (coded)": ADMINISTRATIVE_ID_COLS,
    "Administrative text": ["payer_code", "medical_specialty"],
    "Utilization (numeric)": UTILIZATION_NUMERIC_COLS,
    "Diagnosis (ICD-9)": ["diag_1", "diag_2", "diag_3"],
    "Lab result": ["max_glu_serum", "A1Cresult"],
    "Medication (dose change)": ALL_DRUGS,
    "Indicator": ["change", "diabetesMed"],
    "Target": ["readmitted"],
}

# ---------------------------------------------------------------------------
# FIXED VALUES: profiling, metrics, fairness, drift thresholds
# ---------------------------------------------------------------------------
HIGH_CARD_THRESHOLD = 30
TOP_LEVELS = 30
MIN_LEVEL_COUNT = 30
MISSING_LEVEL = "«missing»"
OTHER_LEVEL = "«other»"
WILSON_Z = 1.96
TARGET_PRECISION = 0.30
TARGET_RECALL = 0.50
RECALL_TARGETS = [0.40, 0.50, 0.60]
LEAKAGE_AUC = 0.75
MODERATE_RISK = 0.05
DISCHARGES_PER_DAY = 50
MIN_SUPPORT = 100
DRIFT_SHARE = 0.10
PSI_THRESHOLD = 0.20
PRAUC_FLOOR = 0.15
PSI_BINS = 10
PSI_EPS = 1e-6
DRIFT_DISTANCE_THRESHOLD = 0.1
TOP_SHAP_FEATURES = [
    "discharged_home", "discharge_disposition_grp", "diag_1_bucket", "number_inpatient",
    "medical_specialty", "time_in_hospital", "age_midpoint", "service_utilization",
]
SPLIT_SEED = 42
TEST_FRACTION = 0.20
N_FOLDS = 5
TOP_K_FACTORS = 6
