"""Consolidation of scholarly-record exports as Spark jobs."""

from .config import DEFAULTS, Settings

__all__ = ["DEFAULTS", "Settings"]
