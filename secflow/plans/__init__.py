"""Registered queries by area."""

from __future__ import annotations

import importlib

from secflow.plans.registry import ENTRIES, Entry

AREAS = ["flows", "syscalls", "scaling", "scores", "profiles", "tests_of_significance", "selection",
         "distances", "models", "reports", "pipelines"]


def load_all() -> dict[str, Entry]:
    for area in AREAS:
        importlib.import_module(f"secflow.plans.{area}")
    return dict(ENTRIES)
