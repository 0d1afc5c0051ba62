"""Attribute change tests."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column


def changed(pairs: Iterable[tuple[Column, Column]]) -> Column:
    """Any pair differs; NULL against a value is a difference, NULL against NULL is none."""
    return reduce(lambda a, b: a | b, [~old.eqNullSafe(new) for old, new in pairs])


def changed_null_unsafe(pairs: Iterable[tuple[Column, Column]]) -> Column:
    """Any pair differs by plain ``!=``: a change from or to NULL goes unnoticed."""
    return reduce(lambda a, b: a | b, [old != new for old, new in pairs])
