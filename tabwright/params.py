"""Parameters of the workflow, as frozen dataclasses.

IDs such as ``G5`` in docstrings throughout the package are the row IDs of the
"""

from __future__ import annotations

from dataclasses import dataclass, field

# --- fixed values: names, codes, ranges and bin edges that results depend on ---

TARGET = "readmitted"
TARGET_DOMAIN = ("NO", "YES")
TARGET_TO_BINARY = {"<30": 1, ">30": 0, "NO": 0}

SENTINELS = ("?", "Unknown/Invalid")
MISSING_LEVEL = "Missing"

CATEGORICAL = ("race", "gender", "age_group")
NUMERIC = (
    "age",
    "time_in_hospital",
    "num_lab_procedures",
    "num_procedures",
    "num_medications",
    "number_outpatient",
    "number_emergency",
    "number_inpatient",
    "number_diagnoses",
)
DROPPED = ("encounter_id", "patient_nbr", "diag_1", "diag_2", "diag_3")

REQUIRED = (
    "encounter_id",
    "patient_nbr",
    "race",
    "gender",
    "age",
    "time_in_hospital",
    "num_lab_procedures",
    "num_procedures",
    "num_medications",
    "number_outpatient",
    "number_emergency",
    "number_inpatient",
    "readmitted",
)
INTEGER_COLUMNS = ("encounter_id", "patient_nbr", "age")

AGE_EDGES = (0, 10, 20, 30, 40, 50, 60, 70, 80, 90, 100)
AGE_LABELS = (
    "[0-10)", "[10-20)", "[20-30)", "[30-40)", "[40-50)", "[50-60)", "[60-70)", "[70-80)", "[80-90)", "[90-100)",
)
STAY_EDGES = (0, 3, 7, 14, 30)
STAY_LABELS = ("short", "medium", "long", "very_long")

SPARSE_COLUMNS = ("weight", "payer_code", "medical_specialty", "examide", "citoglipton")
DEATH_DISPOSITIONS = (11, 13, 14, 19, 20, 21)
DIAGNOSIS_COLUMNS = ("diag_1", "diag_2", "diag_3")

# diagnosis group -> inclusive code ranges, first match wins
DIAGNOSIS_GROUPS = (
    ("Circulatory", ((390, 459), (785, 785))),
    ("Respiratory", ((460, 519), (786, 786))),
    ("Digestive", ((520, 579), (787, 787))),
    ("Diabetes", ((250, 250),)),
    ("Injury", ((800, 999),)),
    ("Musculoskeletal", ((710, 739),)),
    ("Genitourinary", ((580, 629), (788, 788))),
    ("Neoplasms", ((140, 239),)),
)
DIAGNOSIS_OTHER = "Other"

ID_CATEGORIES = ("admission_type_id", "discharge_disposition_id", "admission_source_id")
LEVEL_COLUMNS = (
    "race", "gender", "max_glu_serum", "A1Cresult",
    "metformin", "repaglinide", "nateglinide", "chlorpropamide", "glimepiride",
    "acetohexamide", "glipizide", "glyburide", "tolbutamide", "pioglitazone",
    "rosiglitazone", "acarbose", "miglitol", "troglitazone", "tolazamide", "insulin",
    "glyburide-metformin", "glipizide-metformin", "glimepiride-pioglitazone",
    "metformin-rosiglitazone", "metformin-pioglitazone",
    "change", "diabetesMed", "diag_1_category", "diag_2_category", "diag_3_category",
)
COUNT_COLUMNS = (
    "time_in_hospital", "num_lab_procedures", "num_procedures", "num_medications",
    "number_outpatient", "number_emergency", "number_inpatient", "number_diagnoses",
    "age_midpoint",
)

# text read as null by default; the level "None" is deliberately not among them
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "n/a", "nan", "null",
)

METRICS = ("accuracy", "precision", "recall", "f1", "roc_auc")

# --- end of fixed values ---


@dataclass(frozen=True)
class FeatureParams:
    """Columns of the modelling table and how to bin and select them."""

    target: str = TARGET
    categorical: tuple[str, ...] = CATEGORICAL
    numeric: tuple[str, ...] = NUMERIC
    dropped: tuple[str, ...] = DROPPED
    age_edges: tuple[float, ...] = AGE_EDGES
    age_labels: tuple[str, ...] = AGE_LABELS
    stay_edges: tuple[float, ...] = STAY_EDGES
    stay_labels: tuple[str, ...] = STAY_LABELS
    medication_pattern: str = "medication"
    diagnosis_pattern: str = "diagnosis"
    select_k: int = 10


@dataclass(frozen=True)
class SplitParams:
    """Shares and seed of the train / validation / test split."""

    key: str = "encounter_id"
    seed: int = 42
    test_share: float = 0.2
    validation_share: float = 0.1


@dataclass(frozen=True)
class ModelParams:
    """Classifier name and its settings; see ``operators.learn.CLASSIFIERS``."""

    name: str = "random_forest"
    seed: int = 42
    settings: dict = field(
        default_factory=lambda: {"numTrees": 100, "maxDepth": 10, "minInstancesPerNode": 1}
    )


@dataclass(frozen=True)
class WorkflowParams:
    """Everything one training run needs."""

    features: FeatureParams = FeatureParams()
    split: SplitParams = SplitParams()
    model: ModelParams = ModelParams()
    metrics: tuple[str, ...] = METRICS
    null_share_limit: float = 0.5
    class_share_floor: float = 0.01
    confidence_threshold: float = 0.8
