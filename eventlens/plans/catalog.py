"""All registered queries.  Importing the query modules fills the registry."""

from __future__ import annotations

import importlib

_MODULES = (
    "eventlens.plans.sentiment_queries",
    "eventlens.plans.lake_queries",
    "eventlens.plans.security_queries",
    "eventlens.plans.ml_queries",
    "eventlens.plans.stream_queries",
    "eventlens.plans.pipeline_queries",
    "eventlens.plans.path_queries",
    "eventlens.plans.maintenance_queries",
)


def _load():
    for m in _MODULES:
        importlib.import_module(m)


def queries():
    _load()
    from eventlens.plans.registry import QUERIES
    return dict(QUERIES)


def oracle_sql():
    _load()
    from eventlens.plans.registry import ORACLES
    return dict(ORACLES)
