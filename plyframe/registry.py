"""Every query of the engine, by name, with its SQL oracle where SQL can express it."""

from __future__ import annotations

import importlib

FLAGSHIP = "flagship_material_wdl"
MODULES: tuple[str, ...] = ("plyframe.plans.positions", "plyframe.plans.moves", "plyframe.plans.aggregates", "plyframe.plans.text", "plyframe.plans.sequential", "plyframe.plans.tables", "plyframe.plans.endgames", "plyframe.plans.backed", "plyframe.plans.threats", "plyframe.streaming.requests", "plyframe.streaming.expiring")


def _modules():
    return [importlib.import_module(m) for m in MODULES]


def queries() -> dict:
    return {name: f for m in _modules() for name, f in m.QUERIES.items()}


def oracle_sql() -> dict:
    return {name: sql for m in _modules() for name, sql in m.ORACLE_SQL.items()}
