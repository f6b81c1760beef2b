"""Project configuration and the fixed values the results depend on."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any

# ---------------------------------------------------------------------------
# FIXED VALUES (must equal the original project's for the same results)
# ---------------------------------------------------------------------------

# Raw EV-charging CSV header -> clean column name, in the original order.
EV_RENAMES = {
    "SOC (%)": "SOC",
    "Voltage (V)": "Voltage",
    "Current (A)": "Current",
    "Battery Temp (°C)": "Battery_Temp",
    "Ambient Temp (°C)": "Ambient_Temp",
    "Charging Duration (min)": "Charging_Duration",
    "Degradation Rate (%)": "Degradation_Rate",
    "Efficiency (%)": "Efficiency",
    "Charging Cycles": "Charging_Cycles",
    "EV Model": "EV_Model",
    "Optimal Charging Duration Class": "Optimal_Charging_Duration_Class",
    "Battery Type": "Battery_Type",
    "Charging Mode": "Charging_Mode",
}

# Feature lists and target, in configuration order.
EV_NUM_FEATURES = [
    "SOC", "Voltage", "Current", "Battery_Temp", "Ambient_Temp",
    "Charging_Duration", "Degradation_Rate", "Efficiency", "Charging_Cycles",
]
EV_CAT_FEATURES = ["Battery_Type", "EV_Model", "Charging_Mode"]
EV_TARGET = "Optimal_Charging_Duration_Class"

# Null sentinels: -1.0 for measures, "Unknown" for categories, -1 for cycles.
EV_SENTINELS = {
    "SOC": -1.0, "Voltage": -1.0, "Current": -1.0, "Battery_Temp": -1.0,
    "Ambient_Temp": -1.0, "Charging_Duration": -1.0, "Degradation_Rate": -1.0,
    "Efficiency": -1.0, "Battery_Type": "Unknown", "Charging_Cycles": -1,
    "Charging_Mode": "Unknown", "EV_Model": "Unknown",
}

# Target text values kept by the domain filter.
EV_TARGET_DOMAIN = ("0", "1", "2")

# Class code -> display name for the three duration classes.
EV_CLASS_NAMES = {0: "Short", 1: "Medium", 2: "Long"}

# Binary wrapper mapping: 1 -> "alive", anything else -> "dead".
ALIVE_NAMES = {1: "alive"}
ALIVE_DEFAULT = "dead"

# Boosted-tree training parameters.
GBM_PARAMETERS = {"learning_rate": 0.01, "n_estimators": 1000, "max_depth": 6}

# Validation gate: metric limits (log_loss is an upper limit, the rest lower).
METRIC_THRESHOLDS = {
    "accuracy": 0.85,
    "f1_score": 0.80,
    "precision": 0.75,
    "recall": 0.75,
    "roc_auc": 0.85,
    "log_loss": 0.5,
}
UPPER_LIMIT_METRICS = ("log_loss",)

# Validation gate: inclusive parameter ranges.
PARAM_RANGES = {
    "learning_rate": (0.0005, 0.1),
    "n_estimators": (100, 3000),
    "max_depth": (2, 12),
}

# Promotion gate defaults (function defaults) and the values the flow passes.
PROMOTION_F1_MIN = 0.0
PROMOTION_AUC_MIN = -0.002
PROMOTION_FLOW_F1_MIN = 0.0
PROMOTION_FLOW_AUC_MIN = 0.0

# Alias names (compared lower-case).
ALIAS_CHAMPION = "champion"
ALIAS_CHALLENGER = "challenger"
ALIAS_LATEST = "latest-model"

# Environments.
ENVIRONMENTS = ("prd", "acc", "dev")

# Laptop exploratory data: the flag column and its true value.
LAPTOP_ID = "device_id"
LAPTOP_FLAG = "overheating_issues"
LAPTOP_FLAG_TRUE = "Yes"
LAPTOP_TARGET = "performance_rating"

# Clipping epsilon for log loss (float64 machine epsilon).
LOG_LOSS_EPS = 2.220446049250313e-16

# 95 % normal interval multiplier for mean curves.
Z95 = 1.96


@dataclass
class ProjectConfig:
    """Driver-side configuration (plain values, no data)."""

    num_features: list[str] = field(default_factory=lambda: list(EV_NUM_FEATURES))
    cat_features: list[str] = field(default_factory=lambda: list(EV_CAT_FEATURES))
    target: str = EV_TARGET
    parameters: dict[str, Any] = field(default_factory=lambda: dict(GBM_PARAMETERS))
    env: str = "dev"
    # From the environment's section of the configuration file.
    catalog_name: str | None = None
    schema_name: str | None = None
    input_data_path: str | None = None

    def __post_init__(self) -> None:
        if self.env not in ENVIRONMENTS:
            raise ValueError(f"unknown environment {self.env!r}; expected one of {ENVIRONMENTS}")

    @property
    def feature_columns(self) -> list[str]:
        return [*self.num_features, *self.cat_features]

    @classmethod
    def from_yaml(cls, path: str, env: str = "dev") -> "ProjectConfig":
        import yaml  # optional dependency, only for file-based configs

        with open(path) as fh:
            raw = yaml.safe_load(fh) or {}
        if env not in ENVIRONMENTS:
            raise ValueError(f"unknown environment {env!r}; expected one of {ENVIRONMENTS}")
        keys = ("num_features", "cat_features", "target", "parameters")
        section = raw.get(env) or {}
        places = ("catalog_name", "schema_name", "input_data_path")
        return cls(**{k: raw[k] for k in keys if k in raw}, env=env,
                   **{k: section[k] for k in places if k in section})

    def table_base(self, root: str) -> str:
        """Folder of this environment's tables under ``root``."""
        if not (self.catalog_name and self.schema_name):
            raise ValueError("the configuration names no catalog and schema")
        return f"{root.rstrip('/')}/{self.catalog_name}/{self.schema_name}"
