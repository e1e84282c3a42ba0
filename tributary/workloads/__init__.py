"""Named queries, one per operator of the survey; imported lazily."""

from __future__ import annotations

import importlib

MODULES = ("filtering", "envelope", "scans", "applying", "writing", "stages", "streams")


def load_all() -> None:
    for m in MODULES:
        importlib.import_module(f"tributary.workloads.{m}")
