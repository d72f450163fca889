"""Registered queries: one per operator, each on the given tables."""

from importlib import import_module

for _module in (
    "selection", "joins", "aggregates", "windows", "reshape", "scalars", "files",
    "quality", "ingestion", "spatial", "marts", "streams", "features", "learning",
    "evaluation", "monitoring",
):
    import_module(f"{__name__}.{_module}")

from tallyloom.queries.registry import ORACLES, QUERIES  # noqa: E402,F401
