"""Pairs of a Spark query and the DuckDB SQL that must give the same rows."""

from importlib import import_module

MODULES = ("etl", "replies", "collection", "categories", "density")


def all_checks() -> dict:
    found = {}
    for name in MODULES:
        found.update(import_module(f"checks.{name}").CHECKS)
    return found
