"""Import every query module so the registry is complete."""

from __future__ import annotations

import importlib

from riskline.plans.registry import REGISTRY, Query

_MODULES = [
    "riskline.plans.q_validate",
    "riskline.plans.q_explore",
    "riskline.plans.q_prepare",
    "riskline.plans.q_monitor",
    "riskline.plans.q_logs",
    "riskline.plans.q_balance",
    "riskline.plans.q_stream",
    "riskline.plans.q_models",
    "riskline.plans.q_synth",
    "riskline.plans.q_io",
]


def load() -> dict[str, Query]:
    for m in _MODULES:
        importlib.import_module(m)
    return REGISTRY
