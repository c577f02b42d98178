"""Per-user and per-item behaviour metrics, tags and profiles as Spark DataFrame plans."""

from tagloom.settings import Settings

__all__ = ["Settings"]
