"""Registered queries: every operator applied to the given tables, with the SQL that checks it."""

from importlib import import_module

MODULES = ("strategy", "cleaning", "resampling", "indicators", "sessions", "signals", "trades", "analytics", "options",
           "sweeps", "segments", "sources", "streams")


def load() -> None:
    for name in MODULES:
        import_module(f"catalog.{name}")
