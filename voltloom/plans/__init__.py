"""Registered queries, grouped by operator family."""

from __future__ import annotations

import importlib
import pkgutil


def registry():
    """(queries, oracle texts); importing every plan module fills both."""
    from . import base

    for m in sorted(x.name for x in pkgutil.iter_modules(__path__)):
        importlib.import_module(f"{__name__}.{m}")
    return dict(base.QUERIES), dict(base.ORACLES)
