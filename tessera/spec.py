"""Feature specifications: which columns play which role, and the fixed rule values.

A ``FeatureSpec`` describes a labelled table: id, label, raw columns and derived-feature
rules. Two presets cover the two rule sets of the modelled project: ``PRESET_A`` (training
rules, the default) and ``PRESET_B`` (the dashboard variant).
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import asdict, dataclass, field

# ---------------------------------------------------------------------------------------
# Fixed values (must equal the modelled project's rules for equal results).
# ---------------------------------------------------------------------------------------

# Title pattern: a space, a run of letters, then a dot; group 1 is the title.
TITLE_PATTERN = r" ([A-Za-z]+)\."

# Preset A title dictionary; anything unmapped (or null) becomes "Rare".
TITLE_MAP_A = {
    "Mr": "Mr",
    "Miss": "Miss",
    "Mrs": "Mrs",
    "Master": "Master",
    "Ms": "Miss",
    "Mlle": "Miss",
    "Mme": "Mrs",
    "Dr": "Rare",
    "Rev": "Rare",
    "Col": "Rare",
    "Major": "Rare",
    "Capt": "Rare",
    "Don": "Rare",
    "Dona": "Rare",
    "Lady": "Rare",
    "Sir": "Rare",
    "Jonkheer": "Rare",
    "Countess": "Rare",
}

# Preset B title dictionary (dashboard rules); anything unmapped becomes "Rare".
TITLE_MAP_B = {
    "Mr": "Mr",
    "Miss": "Miss",
    "Mrs": "Mrs",
    "Master": "Master",
    "Dr": "Rare",
    "Rev": "Rare",
    "Col": "Rare",
    "Major": "Rare",
    "Mlle": "Rare",
    "Countess": "Rare",
    "Ms": "Rare",
    "Lady": "Rare",
    "Jonkheer": "Rare",
    "Don": "Rare",
    "Dona": "Rare",
    "Mme": "Rare",
    "Capt": "Rare",
    "Sir": "Rare",
}

TITLE_DEFAULT = "Rare"

# Age bands: shared edges, two label sets, two closure rules.
AGE_EDGES = [0.0, 12.0, 18.0, 35.0, 60.0, 100.0]
AGE_LABELS_A = ["Child", "Teen", "Young Adult", "Adult", "Senior"]  # left-closed [a, b)
AGE_LABELS_B = ["Child", "Teen", "Adult", "Middle", "Senior"]  # right-closed (a, b]

DECK_DEFAULT_A = "U"
DECK_DEFAULT_B = "Unknown"

# Request validation (score endpoint): allowed values and ranges.
REQUEST_TIERS = (1, 3)  # inclusive range
REQUEST_GROUPS = ["male", "female"]
REQUEST_PORTS = ["C", "Q", "S"]
REQUEST_AGE_RANGE = (0.0, 100.0)  # inclusive

# Allowed group values of the labelled stand-in table (market segments).
SUBJECT_GROUPS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]

# Request defaults for optional fields.
REQUEST_DEFAULTS = {"sibsp": 0, "parch": 0, "port": "S", "title": "Mr", "age_group": "Adult", "deck": "U"}

# Verdict texts of the scorer.
VERDICT_POSITIVE = "Survived"
VERDICT_NEGATIVE = "Did not survive"

# Missing-value tokens of the CSV reader (pandas defaults).
NA_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
             "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]

# Run-log core metrics a leaderboard row must have, and artifact lookup order.
CORE_METRICS = ["accuracy", "f1_macro", "roc_auc"]
KNOWN_METRICS = ["accuracy", "f1_macro", "roc_auc", "train_time_s"]
ARTIFACT_CANDIDATES = ["baseline_model", "random_forest_model", "gradient_boosting_model", "GradientBoosting_Best"]


@dataclass(frozen=True)
class FeatureSpec:
    """Roles of the columns of a labelled table, plus derived-feature rules."""

    id_col: str = "subject_id"
    label_col: str = "label"
    name_col: str = "full_name"
    age_col: str = "age"
    cabin_col: str = "cabin"
    fare_col: str = "fare"
    sibsp_col: str = "sibsp"
    parch_col: str = "parch"
    tier_col: str = "tier"
    group_col: str = "grp"
    port_col: str = "port"
    title_rule: str = "regex"  # "regex" (preset A) or "split" (preset B)
    title_map: dict = field(default_factory=lambda: dict(TITLE_MAP_A))
    age_labels: tuple = tuple(AGE_LABELS_A)
    age_right_closed: bool = False
    deck_default: str = DECK_DEFAULT_A
    fare_per_person: bool = False
    numeric: tuple = ("age", "fare", "sibsp", "parch", "family_size")
    categorical: tuple = ("tier", "grp", "port", "title", "age_group", "deck", "is_alone")
    drop: tuple = ("full_name", "cabin")

    @property
    def features(self) -> list[str]:
        return list(self.numeric) + list(self.categorical)


PRESET_A = FeatureSpec()
PRESET_B = FeatureSpec(
    title_rule="split",
    title_map=dict(TITLE_MAP_B),
    age_labels=tuple(AGE_LABELS_B),
    age_right_closed=True,
    deck_default=DECK_DEFAULT_B,
    fare_per_person=True,
    numeric=("age", "fare", "sibsp", "parch", "family_size", "fare_per_person"),
)

#: Metadata key of derived columns: the fingerprint of the spec that made them.
SPEC_MARK = "feature_spec"


def fingerprint(spec: FeatureSpec) -> str:
    """Digest of everything a spec says; equal specs have equal ones in every process."""
    return hashlib.sha256(json.dumps(asdict(spec), sort_keys=True).encode()).hexdigest()[:32]
