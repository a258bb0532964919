"""Registered queries, one module per operator family."""

import importlib
import pkgutil
import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def load() -> None:
    for module in sorted(m.name for m in pkgutil.iter_modules(__path__)):
        importlib.import_module(f"{__name__}.{module}")
