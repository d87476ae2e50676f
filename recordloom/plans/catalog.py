"""All queries of the record catalog: sources and text, records, evaluation and datasets."""

from __future__ import annotations

import importlib
import importlib.util

_PARTS = ["documents", "records", "metrics", "evaluation"]


def _parts() -> list:
    return [importlib.import_module(f"recordloom.plans.{p}") for p in _PARTS if importlib.util.find_spec(f"recordloom.plans.{p}")]


def queries() -> dict:
    return {name: f for p in _parts() for name, f in p.query.queries.items()}


def oracle_sql() -> dict:
    return {name: sql for p in _parts() for name, sql in p.query.sql.items()}
