"""Settings of a run: defaults, overridden by a file's mapping, overridden by the command line."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, fields, replace

from tickloom.operators.indicators import DEFAULT_PACK


@dataclass(frozen=True)
class FeatureConfig:
    indicators: tuple[str, ...] = DEFAULT_PACK
    sentiment_enabled: bool = True
    use_index: bool = True
    use_turbulence: bool = True
    turbulence_lookback: int = 252
    risk_threshold: float = 100.0
    validation_share: float = 0.1
    seed: int = 42
    scorer_batch: int = 32

    def override(self, values: Mapping) -> "FeatureConfig":
        """A copy with the given values; None counts as not given, unknown names are refused."""
        known = {f.name for f in fields(self)}
        unknown = set(values) - known
        if unknown:
            raise ValueError(f"unknown settings: {', '.join(sorted(unknown))}")
        given = {k: tuple(v) if isinstance(v, list) else v for k, v in values.items() if v is not None}
        return replace(self, **given)


def resolve(file: Mapping | None = None, command_line: Mapping | None = None) -> FeatureConfig:
    return FeatureConfig().override(file or {}).override(command_line or {})
