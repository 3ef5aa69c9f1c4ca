"""One place for every constant of the pipeline."""

from __future__ import annotations

from dataclasses import dataclass, field

# Thresholds, limits and split settings that results depend on.
ALERT_THRESHOLD = 0.45
MAX_ROWS_PER_RUN = 50
TRIAGE_SIZE = 200
TEST_SHARE = 0.2
SPLIT_SEED = 42

# Status labels.
HIGH_RISK = "HIGH_RISK"
LOW_RISK = "LOW_RISK"

# Age bands, as (label, least age, greatest age). The first also takes
# everyone younger; the last also takes an unknown age.
AGE_BANDS = (
    ("20-29", 20, 29),
    ("30-39", 30, 39),
    ("40-49", 40, 49),
    ("50-59", 50, 59),
    ("60-69", 60, 69),
    ("70+", 70, None),
)

# Texts of alert messages and of a run without input.
ALERT_SUBJECT = "Heart Health Alert Triggered"
ALERT_HEADER = " High-Risk Patients Detected:"
NO_INPUT_STATUS = 404
NO_INPUT_ERROR = "No CSV file found."

# Column names as they appear in files.
ID_COLUMN = "Patient ID"
TARGET_COLUMN = "Heart Attack Risk"
IDENTIFIER_COLUMNS = ("Patient ID", "Country", "Continent", "Hemisphere")
BLOOD_PRESSURE_COLUMN = "Blood Pressure"
BP_SYSTOLIC = "BP_Systolic"
BP_DIASTOLIC = "BP_Diastolic"
CATEGORICAL_COLUMNS = ("Sex", "Diet")

# History columns that fresh vitals replace, and the target.
STALE_HISTORY_COLUMNS = (
    "Heart Rate",
    "Blood Pressure",
    "Sleep Hours Per Day",
    "Physical Activity Days Per Week",
    "Heart Attack Risk",
)

# Dummy columns the serving side builds, as (column, level).
SERVING_LEVELS = (("Sex", "Male"), ("Diet", "Healthy"), ("Diet", "Unhealthy"))


@dataclass(frozen=True)
class TreeParams:
    """Boosted-tree settings, with their usual boosting-library names in comments."""

    # Hyper-parameters of the risk classifier.
    max_iter: int = 100  # num_round
    step_size: float = 0.1  # eta
    max_depth: int = 5  # max_depth
    subsampling_rate: float = 0.8  # subsample
    feature_subset: str = "0.8"  # colsample_bytree, taken per node by MLlib
    seed: int = SPLIT_SEED


@dataclass(frozen=True)
class Settings:
    alert_threshold: float = ALERT_THRESHOLD
    max_rows: int | None = None  # row cap per run; off unless asked for
    triage_size: int = TRIAGE_SIZE
    test_share: float = TEST_SHARE
    seed: int = SPLIT_SEED
    max_levels: int | None = None  # distinct levels allowed in one categorical column
    tree: TreeParams = field(default_factory=TreeParams)
