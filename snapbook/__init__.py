"""Daily IFRS 9 loan-book snapshots as PySpark DataFrame functions."""

from snapbook.context import RunContext
from snapbook.session import configure

__all__ = ["RunContext", "configure"]
