"""Queries over the test tables, each with its SQL twin."""

from importlib import import_module

MODULES = ["flow", "stock", "values", "frames", "store", "layers", "summaries", "colocated"]


def load_all():
    for m in MODULES:
        import_module(f"registry.{m}")
    return import_module("registry.core")
