"""Everything a job needs to know about one use case, as plain frozen dataclasses."""

from __future__ import annotations

from dataclasses import dataclass, field

BINARY, MULTICLASS, REGRESSION = "binary", "multiclass", "regression"

# Which optimisation metrics each task accepts; the first is the default.
METRICS_BY_TASK = {
    BINARY: ("pr_auc", "roc_auc", "f1"),
    MULTICLASS: ("f1",),
    REGRESSION: ("rmse", "mae", "r2"),
}

# The learner names a use case may ask for.
ALGORITHMS = ("xgboost", "lightgbm", "random_forest", "logistic_regression")
BOOSTED = ("xgboost", "lightgbm")

# SQL type of a label, by task.
LABEL_TYPE = {BINARY: "bigint", MULTICLASS: "string", REGRESSION: "double"}


def score_column(task: str) -> str:
    return "PREDICTED_VALUE" if task == REGRESSION else "PREDICTED_PROBABILITY"


@dataclass(frozen=True)
class DataSpec:
    """Column lists of the training source and of the production feed."""

    keys: tuple[str, ...]
    timestamp: str
    target: str
    categorical: tuple[str, ...] = ()
    numeric: tuple[str, ...] = ()
    median_impute: tuple[str, ...] = ()
    watermark: str = "RECORD_TS"
    passthrough: tuple[str, ...] = ()
    row_id: tuple[str, ...] = ()   # what identifies a feed row; keys and watermark unless given

    @property
    def features(self) -> tuple[str, ...]:
        return self.categorical + self.numeric

    @property
    def carried(self) -> tuple[str, ...]:
        """Feed columns kept next to the encoded features: keys, watermark, descriptive columns."""
        return tuple(dict.fromkeys((*self.keys, self.watermark, *self.passthrough)))

    @property
    def feed_row(self) -> tuple[str, ...]:
        return self.row_id or (*self.keys, self.watermark)


@dataclass(frozen=True)
class SplitSpec:
    strategy: str = "temporal"
    test_fraction: float = 0.20
    hpo_validation_fraction: float = 0.20
    seed: int = 42


@dataclass(frozen=True)
class ModelSpec:
    algorithm: str = "xgboost"
    metric: str | None = None
    trials: int = 25
    early_stopping_rounds: int = 50
    search_space: dict = field(default_factory=dict)
    fixed_params: dict = field(default_factory=dict)
    parallelism: int = 1


@dataclass(frozen=True)
class ScoringSpec:
    daily_capacity: int = 500
    n_high: int = 500
    n_medium: int = 2500
    horizon_days: int = 90
    top_features: int = 15
    causes_per_row: int = 3
    business_columns: dict[str, str] = field(default_factory=dict)   # feed column -> business column, key first


@dataclass(frozen=True)
class RetrainSpec:
    holdout_fraction: float = 0.5
    min_holdout_rows: int = 1000
    min_holdout_positives: int = 20
    rerun_hpo: bool = False
    respect_maturity: bool = True
    min_primary_lift_pct: float = 5.0
    max_guardrail_drop_pct: float = 10.0
    outcome_key: str | None = None
    outcome_label: str = "OUTCOME"
    outcome_ts: str | None = None
    synthetic_labels: bool = False


@dataclass(frozen=True)
class UseCase:
    name: str
    data: DataSpec
    task: str = BINARY
    prefix: str = ""
    split: SplitSpec = SplitSpec()
    model: ModelSpec = ModelSpec()
    scoring: ScoringSpec = ScoringSpec()
    retrain: RetrainSpec = RetrainSpec()

    def __post_init__(self):
        if self.task not in METRICS_BY_TASK:
            raise ValueError(f"unknown task {self.task!r}, expected one of {sorted(METRICS_BY_TASK)}")
        if self.model.algorithm not in ALGORITHMS:
            raise ValueError(f"unsupported algorithm {self.model.algorithm!r}, expected one of {ALGORITHMS}")
        if self.metric not in METRICS_BY_TASK[self.task]:
            raise ValueError(f"metric {self.metric!r} does not fit task {self.task!r}")
        if self.split.strategy not in ("temporal", "random"):
            raise ValueError(f"unknown split strategy {self.split.strategy!r}")
        if not self.data.keys:
            raise ValueError("at least one key column is required")

    @property
    def metric(self) -> str:
        return self.model.metric or METRICS_BY_TASK[self.task][0]

    @property
    def outcome_key(self) -> str:
        return self.retrain.outcome_key or self.data.keys[0]
