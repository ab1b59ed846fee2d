"""SQL that checks the reports, run by an independent engine."""

from .core import SQL, load

__all__ = ["SQL", "load"]
