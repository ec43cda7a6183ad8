"""Spark-native monitoring of business metrics: facts, series, detectors, alerts."""

from .config import EngineConfig, ScenarioEvent
from .plans.orchestration import OrchestrationResult, orchestrate_alerts
from .plans.pipeline import PipelineResult, run_pipeline

__all__ = [
    "EngineConfig",
    "OrchestrationResult",
    "PipelineResult",
    "ScenarioEvent",
    "orchestrate_alerts",
    "run_pipeline",
]
