"""Imports every registration module so the registry is complete."""

from __future__ import annotations

import importlib

MODULES = [
    "opsgrain.plans.items_events",
    "opsgrain.plans.items_pages",
    "opsgrain.plans.items_staging",
    "opsgrain.plans.items_measures",
    "opsgrain.plans.items_quality",
    "opsgrain.plans.items_streaming",
]


def load() -> None:
    for m in MODULES:
        importlib.import_module(m)


load()
