"""Parameters of one snapshot run."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date
from typing import Any

from pyspark.sql import Column, functions as F


@dataclass(frozen=True)
class RunContext:
    """Reporting date, source tag and the optional narrowing of a run.

    ``object_id`` restricts a builder to one contract (or portfolio, or client).
    ``depth_days`` is how far back a closed contract is still looked at.
    """

    asof: date
    source: str = "loan-book"
    object_id: str | None = None
    depth_days: int = 0

    def __post_init__(self) -> None:
        if self.asof is None:
            raise ValueError("a snapshot needs a reporting date")
        if self.depth_days < 0:
            raise ValueError("depth_days must not be negative")

    @classmethod
    def today(cls, clock: Callable[[], date] = date.today, **rest: Any) -> RunContext:
        """The context of a run without a given date: the clock is asked once, and all steps share the answer."""
        return cls(clock(), **rest)

    @property
    def day(self) -> Column:
        return F.lit(self.asof).cast("date")
