"""Column names of the canonical series table and the fixed settings."""

from __future__ import annotations

from dataclasses import dataclass

# Canonical series table: one row per observation.
KEY, T, Y, TIE = "series_id", "t", "y", "tiebreak"
IDX, N, SPLIT = "idx", "n", "split"

# They decide the results and must not be changed.
LAGS = (1, 3, 12)
ROLLS = (3, 12)
SEASON = 12
WINDOW = 24
TRAIN_SHARE, VALIDATION_SHARE = 0.70, 0.85
STD_EPSILON = 1e-8
ZERO_ACTUAL = 1e-8
REVIEW_STDS = 1.5
PATIENCE, MIN_GAIN = 30, 1e-6
SEED = 42
TRAIN, VALIDATION, TEST = "train", "validation", "test"
BASELINE = "Baseline"


def baseline_models(season: int = SEASON) -> tuple[str, ...]:
    """Names of the rule-based models for a season of so many rows."""
    return ("Naive", f"MovingAvg-{season}", f"SeasonalNaive-{season}", "LinearTrend")


BASELINE_MODELS = baseline_models()


@dataclass(frozen=True)
class Layout:
    """How the rows of a series are spread over tasks.

    ``auto``   series of up to ``block_rows`` rows get one task each; longer
               ones are cut into blocks. Costs one count per series up front.
    ``plain``  one task per series. Only for data whose series length is
               bounded by construction, such as one row per calendar month.
    ``blocks`` cut every series into blocks.

    Series of more than ``block_rows`` rows are long. Their blocks hold that
    many rows, or more where all long series together would have more than
    ``max_blocks`` blocks: the counts of the blocks are summed in one place.

    ``indexed`` says that the rows carry position ``idx`` and length ``n`` of
    their whole series, so that these need not be found again.
    """

    mode: str = "auto"
    block_rows: int = 1_000_000
    indexed: bool = False
    max_blocks: int = 100_000

    def __post_init__(self):
        if self.mode not in ("auto", "plain", "blocks"):
            raise ValueError(f"unknown layout mode: {self.mode}")
        if self.block_rows < 1:
            raise ValueError("block_rows must be positive")


AUTO = Layout()
PLAIN = Layout("plain")
