"""Named queries over the driver tables.  Importing this package fills the
registry in ``fathom.plans.registry``."""

import importlib

from fathom.plans.registry import OPERATORS, ORACLES, QUERIES  # noqa: F401

_MODULES = [
    "slice", "splits", "profiling", "contracts", "drift", "features", "learnt",
    "aggregates", "classification", "regression", "stattests", "survival", "spatial",
    "streams", "models", "sources_casts", "diagnostics", "selection", "frames",
]

for _m in _MODULES:
    try:
        importlib.import_module(f"fathom.plans.{_m}")
    except ModuleNotFoundError as exc:  # module not written yet
        if exc.name != f"fathom.plans.{_m}":
            raise
