"""Point-in-time customer analytics as Spark DataFrame jobs."""

from orderlens.config import RunConfig

__all__ = ["RunConfig"]
