"""Queries of this package: name -> callable, and name -> SQL where SQL can say it."""

from __future__ import annotations

from importlib import import_module

MODULES = (
    "p1_pairs", "p2_ocr", "p3_quality", "p4_tokens", "p5_packing",
    "p6_overlap", "p7_encoding", "p8_mixing", "p9_spans",
)


def _modules():
    for name in MODULES:
        yield import_module(f".{name}", __package__)


def queries() -> dict:
    return {k: f for m in _modules() for k, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: s for m in _modules() for k, s in m.ORACLES.items()}
