"""The registered queries with their DuckDB counterparts, one module per area."""

from __future__ import annotations

from collections.abc import Callable

from catalog import core, modelling, profiling, sampling, selection

_MODULES = (core, profiling, selection, sampling, modelling)


def queries() -> dict[str, Callable]:
    return {name: fn for m in _MODULES for name, (fn, _) in m.REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in _MODULES for name, (_, sql) in m.REGISTRY.items() if sql is not None}
