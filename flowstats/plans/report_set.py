"""Reports computed from aggregations shared within one batch."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

BATCH = "batch"  # key under which the runner passes the batch itself


@dataclass(frozen=True)
class ReportSet:
    """`shared[name](batch)` builds each shared frame (the runner caches them);
    `reports[name](frames)` builds a report from them, `frames[BATCH]` being the batch.
    `uses[name]` names the shared frames that a report reads."""

    shared: dict[str, Callable[[DataFrame], DataFrame]]
    reports: dict[str, Callable[[dict[str, DataFrame]], DataFrame]]
    uses: dict[str, tuple[str, ...]] = field(default_factory=dict)

    def needed(self, names: list[str]) -> list[str]:
        """Shared frames that the named reports read."""
        return [s for s in self.shared if any(s in self.uses.get(n, tuple(self.shared)) for n in names)]

    def frames(self, batch: DataFrame) -> dict[str, DataFrame]:
        """The shared frames of `batch`, uncached (for one-off use and tests)."""
        out = {name: build(batch) for name, build in self.shared.items()}
        out[BATCH] = batch
        return out
