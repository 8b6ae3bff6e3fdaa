"""Run settings as frozen dataclasses.

The defaults are the ones a run gets when a key is left out; ``reference_config`` holds the
values of the documented run.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# fixed values: label codes of the labelled-line format
LABEL_NAMES = {"0": "negative", "1": "positive"}


@dataclass(frozen=True)
class DataConfig:
    csv_path: str | None = None
    dataset_path: str | None = None
    dataset_key: str = "uci-sentiment-labelled-sentences"
    # SHA-256 by file name; if any are given, other files under dataset_path are refused
    dataset_digests: dict[str, str] = field(default_factory=dict, hash=False)
    allow_synthetic_fallback: bool = False
    prefer_synthetic: bool = False
    synthetic_rows: int = 400
    id_column: str = "row_id"
    text_column: str = "review_text"
    label_column: str = "sentiment"
    max_features: int = 10_000
    test_size: float = 0.2
    validation_size: float = 0.2
    random_state: int = 42


@dataclass(frozen=True)
class ModelConfig:
    type: str = "logistic_regression"
    c: float = 1.0
    max_iter: int = 1000
    # relative change of the objective at which a gradient fit stops
    tol: float = 1e-6
    # levels in which partial gradients are added up; more for many wide partitions
    aggregation_depth: int = 2
    n_estimators: int = 200
    max_depth: int = 20
    min_samples_split: int = 5
    # of the svm: rbf or linear; gamma is scale, auto or a number
    kernel: str = "rbf"
    gamma: str | float = "scale"
    # random features that stand for the rbf kernel, an even number
    components: int = 1024


@dataclass(frozen=True)
class TrainingConfig:
    cv_folds: int = 5
    scoring: str = "f1_weighted"
    # folds fitted side by side where they share no passes (forests, more than two classes)
    parallelism: int = 5


@dataclass(frozen=True)
class DataRules:
    on_failure: str = "warn"
    max_null_pct: float = 0.05
    max_duplicate_pct: float = 0.10
    min_class_ratio: float = 0.10


@dataclass(frozen=True)
class GateRules:
    min_accuracy: float = 0.85
    min_f1: float = 0.83
    min_accuracy_over_baseline: float = 0.20
    max_latency_ms: float = 100.0


@dataclass(frozen=True)
class Config:
    data: DataConfig = field(default_factory=DataConfig)
    model: ModelConfig = field(default_factory=ModelConfig)
    training: TrainingConfig = field(default_factory=TrainingConfig)
    data_rules: DataRules = field(default_factory=DataRules)
    gate: GateRules = field(default_factory=GateRules)


def reference_config() -> Config:
    """Settings of the documented run: validation refuses, gate at .75/.75/.20/100."""
    return Config(
        data_rules=DataRules(on_failure="error"),
        gate=GateRules(min_accuracy=0.75, min_f1=0.75),
    )
