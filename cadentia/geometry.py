"""Shape of a cadence: observations x time bins x frequency channels."""

from __future__ import annotations

from dataclasses import dataclass, replace

# The instrument's native cadence shape and resolutions.
N_OBS = 6
TIME_BINS = 16
WIDTH = 4096
FACTOR = 8
FREQ_RESOLUTION_HZ = 2.7939677238464355
TIME_RESOLUTION_S = 18.25361108


@dataclass(frozen=True)
class Geometry:
    """Every operator takes its shape from here; nothing is hard-coded.

    An observation is one flat, time-major array of ``time_bins * width`` cells;
    even observations are ON target, odd ones OFF.
    """

    n_obs: int = N_OBS
    time_bins: int = TIME_BINS
    width: int = WIDTH
    factor: int = FACTOR
    freq_resolution_hz: float = FREQ_RESOLUTION_HZ
    time_resolution_s: float = TIME_RESOLUTION_S

    def __post_init__(self):
        if self.width % self.factor:
            raise ValueError(f"width {self.width} is not a multiple of factor {self.factor}")

    @property
    def out_width(self) -> int:
        return self.width // self.factor

    @property
    def cells_per_obs(self) -> int:
        return self.time_bins * self.width

    @property
    def stacked_rows(self) -> int:
        """Time rows of the whole cadence when its observations are stacked."""
        return self.n_obs * self.time_bins

    def downsampled(self) -> Geometry:
        """Shape after the block mean (resolutions stay those of the raw grid)."""
        return replace(self, width=self.out_width, factor=1)

    def on_row_ranges(self) -> list[tuple[int, int]]:
        """Inclusive stacked-row ranges covered by the ON observations."""
        return [(i * self.time_bins, (i + 1) * self.time_bins) for i in range(0, self.n_obs, 2)]
