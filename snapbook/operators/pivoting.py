"""Rows to named columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def pivot_min(df: DataFrame, identifier: str, name_col: str, value: str, names: Sequence[str]) -> DataFrame:
    """Smallest value per id for each of the given names; names are fixed, so no pass to find them."""
    return df.groupBy(identifier).pivot(name_col, list(names)).agg(F.min(value))
