"""Settings of a monitoring run."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, replace
from typing import Any


@dataclass(frozen=True)
class ScenarioEvent:
    """A what-if change: multiply one metric by a factor for some days."""

    kpi: str
    start_date: str
    days: int
    multiplier: float
    label: str = "Injected anomaly"


# The defaults a run must have to give the expected results.
DEFAULT_KPIS = ("revenue", "orders", "aov", "payment_fail_rate")
DEFAULT_DIMENSIONS = ("customer_state", "product_category_name", "payment_type")
DEFAULT_EVENTS = (
    ScenarioEvent("revenue", "2018-06-01", 2, 0.60, "Revenue shock (simulated outage)"),
    ScenarioEvent("orders", "2018-03-20", 3, 1.35, "Orders spike (simulated promo)"),
)


@dataclass(frozen=True)
class EngineConfig:
    """All settings, with their defaults. Row counts are rows of a daily series."""

    kpis: tuple[str, ...] = DEFAULT_KPIS

    mean_rows: int = 7
    std_rows: int = 7
    baseline_rows: int = 30
    min_rows: int = 35

    pct_deviation: float = 0.20
    z_threshold: float = 2.5
    iqr_k: float = 1.5

    forest_enabled: bool = True
    forest_trees: int = 300
    forest_contamination: float = 0.03
    forest_seed: int = 42
    forest_sample: int = 256
    """Days that a tree is grown from; all of them if a series has no more."""
    forest_tasks: int = 0
    """Tasks over which the blocks of all series are dealt; 0 takes the session's number
    of shuffle partitions."""
    forest_blocks: int = 8
    """Independent tasks the trees of one series are split over. The trees of a
    series are the same whatever this is; use 1 once there are many series."""

    z_low: float = 2.0
    z_medium: float = 2.5
    z_high: float = 3.5
    revenue_drop_pct: float = 0.30

    dimensions: tuple[str, ...] = DEFAULT_DIMENSIONS
    top_n: int = 5
    lookback_days: int = 30
    order_bands: int = 4
    """Bands of order value, where ``order_segment`` is among the dimensions."""
    order_cuts: tuple[float, ...] = ()
    """The values between bands; without them they are quantiles of all orders."""
    order_cuts_exact: bool = True
    """Whether these quantiles are exact or from a sketch."""

    scenario_enabled: bool = True
    scenario_seed: int = 42
    scenario_noise: float = 0.01
    scenario_events: tuple[ScenarioEvent, ...] = DEFAULT_EVENTS

    cooldown_days: int = 3

    def with_(self, **changes: Any) -> EngineConfig:
        return replace(self, **changes)

    @classmethod
    def from_dict(cls, settings: Mapping[str, Any]) -> EngineConfig:
        """Read the nested settings mapping users keep in a YAML or JSON document.

        Absent keys keep their defaults, but for the scenario section: a mapping
        without one runs without scenarios.
        """
        base = settings.get("baseline", {})
        det = settings.get("anomaly_detection", {})
        forest = det.get("isolation_forest", {})
        risk = settings.get("risk", {})
        cause = settings.get("root_cause", {})
        scenario = settings.get("anomaly_injection", {})
        given = {
            "kpis": settings.get("kpis"),
            "mean_rows": base.get("rolling_mean_days"),
            "std_rows": base.get("rolling_std_days"),
            "baseline_rows": base.get("baseline_days"),
            "min_rows": base.get("min_days_for_detection"),
            "pct_deviation": det.get("heuristic_pct_dev"),
            "z_threshold": det.get("zscore_threshold"),
            "iqr_k": det.get("iqr_k"),
            "forest_enabled": forest.get("enabled"),
            "forest_trees": forest.get("n_estimators"),
            "forest_contamination": forest.get("contamination"),
            "forest_seed": forest.get("random_state"),
            "forest_sample": forest.get("max_samples"),
            "z_low": risk.get("z_low"),
            "z_medium": risk.get("z_medium"),
            "z_high": risk.get("z_high"),
            "revenue_drop_pct": risk.get("revenue_drop_escalate_pct"),
            "dimensions": cause.get("dimensions"),
            "top_n": cause.get("top_n"),
            "lookback_days": cause.get("lookback_days"),
            "order_bands": cause.get("order_bands"),
            "order_cuts": cause.get("order_cuts"),
            "order_cuts_exact": cause.get("order_cuts_exact"),
            "scenario_enabled": bool(scenario.get("enabled", False)),
            "scenario_seed": scenario.get("seed"),
            "scenario_events": tuple(
                ScenarioEvent(
                    e["kpi"],
                    str(e["start_date"]),
                    int(e["days"]),
                    float(e["multiplier"]),
                    str(e.get("label", ScenarioEvent.label)),
                )
                for e in scenario.get("events", ())
            ),
        }
        for key in ("kpis", "dimensions", "order_cuts"):
            if given[key] is not None:
                given[key] = tuple(given[key])
        return cls(**{k: v for k, v in given.items() if v is not None})
