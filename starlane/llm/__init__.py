"""Operators for preparing training corpora; nothing else in the library imports them."""

from starlane.session import importable

__all__ = ["importable"]
