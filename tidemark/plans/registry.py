"""Loads every query module so that ``QUERIES`` / ``ORACLE_SQL`` are complete."""

from __future__ import annotations

import importlib

from .queries import ORACLE_SQL, QUERIES

MODULES = (
    "queries_monitoring",
    "queries_profile",
    "queries_clean",
    "queries_sample",
    "queries_drift",
    "queries_registry",
    "queries_model",
    "queries_stream",
    "queries_catalog",
    "queries_state",
    "queries_holes",
)


def load_all():
    for m in MODULES:
        importlib.import_module(f"{__package__}.{m}")
    return QUERIES, ORACLE_SQL
