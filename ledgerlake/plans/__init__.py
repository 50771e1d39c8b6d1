"""Layered models and the driver queries over the test tables."""

import importlib

_QUERY_MODULES = ("q_sources", "q_merge", "q_transforms", "q_joins", "q_windows", "q_text",
                  "q_quality", "q_models", "q_bronze", "q_files", "q_versions")


def load_all() -> None:
    for m in _QUERY_MODULES:
        try:
            importlib.import_module(f"ledgerlake.plans.{m}")
        except ModuleNotFoundError as e:
            if e.name != f"ledgerlake.plans.{m}":
                raise
