"""Registered queries over the given tables."""

import importlib

MODULES = ["queries_scan_route", "queries_deid", "queries_results", "queries_flows"]


def load_all() -> None:
    for name in MODULES:
        importlib.import_module(f"scanloom.plans.{name}")
