"""Default parameters, grouped by the operators that take them."""

from __future__ import annotations

from dataclasses import dataclass

# The defaults below must equal the established pipeline defaults.


@dataclass(frozen=True)
class DetectionRule:
    threshold: float = 0.5
    min_on: int = 2
    high_confidence: float = 0.9
    first_band_mhz: float = 1100.0
    band_step_mhz: float = 50.0
    batch_size: int = 4048


@dataclass(frozen=True)
class LoadLimits:
    """What a caller may leave out of a load; by default everything is loaded."""

    chunk_size: int = 5000
    chunks_per_file: int | None = None
    target: int | None = None

    @property
    def rows_per_file(self) -> int | None:
        return None if self.chunks_per_file is None else self.chunk_size * self.chunks_per_file


@dataclass(frozen=True)
class LossWeights:
    beta: float = 1.5
    alpha: float = 10.0


@dataclass(frozen=True)
class SplitSizes:
    train_fraction: float = 0.8
    train_batch: int = 2048
    val_batch: int = 4096


@dataclass(frozen=True)
class Curriculum:
    total_rounds: int = 20
    snr_base: int = 10
    initial_range: int = 40
    final_range: int = 10
    decay_rate: float = -3.0
    easy_rounds: int = 5
    hard_rounds: int = 15


@dataclass(frozen=True)
class Plateau:
    base_lr: float = 0.001
    min_lr: float = 1e-6
    min_improvement: float = 0.001
    patience: int = 3
    reduction: float = 0.2


@dataclass(frozen=True)
class ForestParams:
    n_trees: int = 1000
    feature_subset: str = "sqrt"
    bootstrap: bool = True
    seed: int = 11
    max_depth: int | None = None


@dataclass(frozen=True)
class Injection:
    """Track parameters: drift noise, base width and drift-proportional width."""

    chunk_size: int = 1000
    snr_base: float = 10.0
    snr_range: float = 40.0
    slope_noise: float = 3.0
    width_hz: float = 50.0
    width_per_drift: float = 18.0
    dynamic_range: float = 1.0


@dataclass(frozen=True)
class IngestLimits:
    interval_seconds: float = 5.0
    rows: int = 100
