"""Registered queries: importing this package registers them all."""

from . import catalog, texts  # noqa: F401
