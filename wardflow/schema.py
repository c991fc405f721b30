"""Column groups, record contract and the fixed values of the encounter data model.

Everything here is plain data. Operators take these lists as defaults so a
caller with a different wide table can pass its own.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the source application's for equal results).
# ---------------------------------------------------------------------------

# Token that marks a missing value in the raw encounter file.
MISSING_TOKEN = "?"

# Columns dropped by cleaning: two identifiers and three mostly-missing columns.
DROP_COLUMNS = ["encounter_id", "patient_nbr", "weight", "payer_code", "medical_specialty"]

# Target column and its negative class.
TARGET = "readmitted"
NEGATIVE_CLASS = "NO"
# Strict label mapping used by the exploration flow (anything else -> NULL, row dropped).
STRICT_LABEL_MAP = {"NO": 0.0, "<30": 1.0, ">30": 1.0}

NUMERIC_COLUMNS = [
    "time_in_hospital", "num_lab_procedures", "num_procedures",
    "num_medications", "number_outpatient", "number_emergency",
    "number_inpatient", "number_diagnoses",
]

MEDICATION_COLUMNS = [
    "metformin", "repaglinide", "nateglinide", "chlorpropamide", "glimepiride",
    "acetohexamide", "glipizide", "glyburide", "tolbutamide", "pioglitazone",
    "rosiglitazone", "acarbose", "miglitol", "troglitazone", "tolazamide",
    "examide", "citoglipton", "insulin", "glyburide-metformin", "glipizide-metformin",
    "glimepiride-pioglitazone", "metformin-rosiglitazone", "metformin-pioglitazone",
]

CATEGORICAL_COLUMNS = [
    "race", "gender", "age", "admission_type_id", "discharge_disposition_id",
    "admission_source_id", "max_glu_serum", "A1Cresult",
    *MEDICATION_COLUMNS,
    "change", "diabetesMed",
]

DIAGNOSIS_COLUMNS = ["diag_1", "diag_2", "diag_3"]

# Medication status values that count as a dose change.
CHANGE_VALUES = ["Up", "Down"]

# ICD-9 groups counted as major comorbidities.
MAJOR_DISEASE_GROUPS = ["250", "428", "414", "401", "585", "486", "493", "272"]

# Diagnosis grouping: prefix rules, then the first three characters, NULL -> UNK.
DIAG_PREFIX_GROUPS = [("^V", "V_Code"), ("^E", "E_Code")]
DIAG_GROUP_WIDTH = 3
DIAG_UNKNOWN = "UNK"

# ICD-9 category of the primary diagnosis; first match wins; string comparison.
# (name, like-prefix or None, [(low, high)], [exact codes])
DIAG_CATEGORIES = [
    ("Diabetes", "250%", [], []),
    ("Circulatory", None, [("390", "459")], ["785"]),
    ("Respiratory", None, [("460", "519")], ["786"]),
    ("Digestive", None, [("520", "579")], ["787"]),
    ("Injury", None, [("800", "999")], []),
    ("Musculoskeletal", None, [("710", "739")], []),
    ("Genitourinary", None, [("580", "629")], ["788"]),
    ("Neoplasms", None, [("140", "239")], []),
]
DIAG_CATEGORY_OTHER = "Other"

# Per-day ratios: (output, numerator); the denominator is the length of stay.
PER_DAY_RATIOS = [
    ("labs_per_day", "num_lab_procedures"),
    ("meds_per_day", "num_medications"),
    ("procs_per_day", "num_procedures"),
]
STAY_COLUMN = "time_in_hospital"

# Code-map sections of the shipped id mapping file.
CODE_MAP_COLUMNS = ["admission_type_id", "discharge_disposition_id", "admission_source_id"]

# Output of scoring.
POSITIVE_TEXT = "Readmitted"
NEGATIVE_TEXT = "Not Readmitted"

# Raw column order of the encounter file (50 columns).
RAW_COLUMNS = [
    "encounter_id", "patient_nbr", "race", "gender", "age", "weight",
    "admission_type_id", "discharge_disposition_id", "admission_source_id",
    "time_in_hospital", "payer_code", "medical_specialty",
    "num_lab_procedures", "num_procedures", "num_medications",
    "number_outpatient", "number_emergency", "number_inpatient",
    "diag_1", "diag_2", "diag_3", "number_diagnoses",
    "max_glu_serum", "A1Cresult",
    *MEDICATION_COLUMNS,
    "change", "diabetesMed", "readmitted",
]

# Fields of one scoring record: the raw columns minus ids, sparse columns and target.
RECORD_FIELDS = [c for c in RAW_COLUMNS if c not in DROP_COLUMNS and c != TARGET]

RAW_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in RAW_COLUMNS])
RECORD_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in RECORD_FIELDS])

LABEL = "label"
WEIGHT = "classWeight"
KEY = "encounter_id"


def q(name: str) -> str:
    """Back-quote a column name for Spark SQL (five medication names contain '-')."""
    return "`" + name.replace("`", "``") + "`"
