"""Queries of the training-data problems, by name; each reads whole tables with production parameters."""

from __future__ import annotations

import importlib

_MODULES = ("neardup", "pii", "copies", "furniture", "language", "packing", "mixing", "spans")


def queries() -> dict:
    out = {}
    for m in _MODULES:
        try:
            mod = importlib.import_module(f"corpusloom.llm.{m}")
        except ModuleNotFoundError as e:
            if e.name != f"corpusloom.llm.{m}":
                raise
            continue
        out |= {k: f for k, f in vars(mod).items() if k[:1] == "p" and k[1:2].isdigit() and k[2:3] == "_" and callable(f)}
    return out


def oracle_sql() -> dict[str, str]:
    from corpusloom.llm import sql

    return {k: v for k, v in sql.ORACLE.items() if k in queries()}
