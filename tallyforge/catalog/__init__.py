"""Registered queries and their independent SQL twins."""
from __future__ import annotations

import importlib

QUERIES = {}
ORACLES = {}


def query(name, sql=None):
    """Register ``fn(spark, sf_dir)`` under ``name``, with the SQL that must give the same rows."""

    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


MODULES = [
    "sources", "cleaning", "fitting", "splitting", "exploring", "rules",
    "drifting", "modelling", "evaluating", "explaining", "recording", "scoring",
]


def load_all():
    """Import every catalog module once so that its queries are registered."""
    for name in MODULES:
        importlib.import_module(f"{__name__}.{name}")
    return QUERIES, ORACLES
