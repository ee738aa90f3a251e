"""Registered queries. A plan module has QUERIES (name -> function of session and folder) and ORACLES (name -> SQL)."""

from importlib import import_module

NAMES = ["problems", "graph", "staging", "model", "views", "register", "flow"]


def registered() -> list:
    return [import_module(f"gridloom.plans.{n}") for n in NAMES]
