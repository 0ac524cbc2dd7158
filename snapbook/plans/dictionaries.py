"""Dictionaries: some read from tables, some fixed."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from snapbook.context import RunContext
from snapbook.operators.lookups import const_df, max_id_per_code

Frames = Mapping[str, DataFrame]

# Extra account types for reserves on awarded penalties.
RESERVE_TYPES = [
    ("113r", "Резерв по присужденным пени по просроченной задолженности"),
    ("114r", "Резерв по присужденным пени по просроченным процентам"),
]
# Repayment schedule types.
SCHEDULE_TYPES = [
    (0, "Аннуитетный"),
    (1, "Равными долями"),
    (2, "Фиксированная сумма"),
    (3, "Погашение в конце"),
    (4, "Произвольный"),
    (5, "Аннуитетный с отсрочкой по ОД"),
    (6, "Аннуитетный с пересчетом графика"),
    (7, "АИЖК-1"),
    (8, "АИЖК-2"),
    (9, "Военная ипотека"),
    (10, "Аннуитетный с пересчетом при отсрочке платежа"),
    (11, "На погашаемую сумму"),
    (12, "АИЖК-3"),
    (13, "Аннуитетный с пересчетом (мульти)"),
    (14, "Аннуитетный с отсрочкой начала погашения"),
    (15, "Не определён"),
]
# Guarantee types, none of them a financial obligation.
GUARANTEE_TYPES = [
    (0, "Банковская гарантия", 0),
    (1, "Международная гарантия", 0),
    (2, "Контр-гарантия", 0),
    (3, "Гарантия против контр-гарантии", 0),
]
# Business segments, the same list for both segment dictionaries.
SEGMENTS = [(1, "Малый"), (2, "Средний"), (3, "Крупный"), (4, "Микропредприятие")]


def _tag(df: DataFrame, ctx: RunContext) -> DataFrame:
    return df.withColumn("source", F.lit(ctx.source))


def account_type(src: Frames, ctx: RunContext) -> DataFrame:
    """Register types as account types of the date, plus the two reserve types."""
    types = src["register_type"].select(F.col("register_type_id").cast("string").alias("oid"), "name")
    extra = const_df(types.sparkSession, RESERVE_TYPES, "oid string, name string")
    return _tag(types.unionByName(extra), ctx).withColumn("date1", ctx.day)


def loan_type(src: Frames, ctx: RunContext) -> DataFrame:
    """Active products."""
    return _tag(src["product"].filter(F.col("active") == 1).select(F.col("product_id").alias("id"), "name"), ctx)


def loan_product(src: Frames, ctx: RunContext) -> DataFrame:
    return _tag(src["product_type"].select(F.col("product_type_id").alias("id"), "name", F.col("brief").alias("short_name")), ctx)


def pledge_type(src: Frames, ctx: RunContext) -> DataFrame:
    """Collateral types, the one with the largest id for every code."""
    rows = max_id_per_code(src["collateral_type"], "code", "collateral_type_id")
    return _tag(rows.select(F.col("code").alias("id"), F.substring("name", 1, 255).alias("description")), ctx)


def schedule_type(spark: SparkSession, ctx: RunContext) -> DataFrame:
    rows = const_df(spark, SCHEDULE_TYPES, "oid int, description string")
    return _tag(rows.withColumn("day_payment", F.lit(None).cast("int")), ctx)


def guarantee_type(spark: SparkSession, ctx: RunContext) -> DataFrame:
    return _tag(const_df(spark, GUARANTEE_TYPES, "id int, description string, is_finance_obligation int"), ctx)


def segment(spark: SparkSession, ctx: RunContext) -> DataFrame:
    return _tag(const_df(spark, SEGMENTS, "id int, name string"), ctx)


def yul_segment(spark: SparkSession, ctx: RunContext) -> DataFrame:
    return _tag(const_df(spark, SEGMENTS, "id int, name string"), ctx)
