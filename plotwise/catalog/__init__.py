"""Queries registered for the driver, each paired with ANSI SQL where SQL can say it."""

from importlib import import_module

MODULES = (
    "derived", "basics", "join_queries", "group_queries", "window_queries", "scalar_queries", "check_queries", "space_queries",
    "job_queries", "standins", "model_queries",
)


def load() -> None:
    for name in MODULES:
        import_module(f"plotwise.catalog.{name}")
