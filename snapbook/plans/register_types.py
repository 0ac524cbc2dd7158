"""Register types, account types and the links between them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from snapbook.operators.hierarchy import expand_parents
from snapbook.operators.lookups import const_df
from snapbook.session import dictionary

# Fixed values: (register type, account type) pairs allowed besides the stored ones.
EXTRA_LINKS = [
    (166, 10029), (256, 11402), (206, 231), (218, 232), (208, 234), (209, 235),
    (23, 10043), (33, 10043), (16, 10053),
    (165, 10135), (167, 10133), (168, 10078), (76, 10135), (81, 10120), (64, 10133), (77, 10078),
    (6, 10005), (8, 10005), (20, 10053), (35, 10053), (39, 10053), (43, 10053), (45, 10053),
]

# Register type, sub type (0 contract, 1 tranche, 2 portfolio), level, base register type.
TARGET_TYPES = [
    # tranche registers
    (7, 1, 0, 7), (8, 1, 0, 8), (28, 1, 0, 28), (23, 1, 0, 23), (24, 1, 0, 24), (33, 1, 0, 33),
    (49, 1, 0, 49), (50, 1, 0, 50), (57, 1, 0, 57), (69, 1, 0, 69), (74, 1, 0, 74), (75, 1, 0, 75),
    # guarantee registers
    (83, 0, 1, 83), (84, 0, 1, 84),
    # tranche reserves
    (164, 1, 0, 164), (165, 1, 0, 165), (167, 1, 0, 167), (168, 1, 0, 168), (169, 1, 0, 169),
    # contract registers
    (1, 0, 0, 1), (2, 0, 0, 2), (5, 0, 1, 7), (113, 0, 0, 113), (114, 0, 0, 114),
    # corrections by tranche
    (201, 1, 0, 201), (203, 1, 0, 203), (205, 1, 0, 205), (207, 1, 0, 207), (211, 1, 0, 211), (213, 1, 0, 213),
    (215, 1, 0, 215), (217, 1, 0, 217), (219, 1, 0, 219), (221, 1, 0, 221),
    (222, 0, 0, 223), (224, 0, 0, 225), (231, 1, 0, 231), (233, 1, 0, 233),
    # contract registers one level above their base
    (6, 0, 1, 8), (27, 0, 1, 28), (59, 0, 1, 69), (71, 0, 1, 74), (72, 0, 1, 75),
    (206, 0, 1, 207), (208, 0, 1, 208), (209, 0, 1, 209), (218, 0, 1, 219), (254, 0, 1, 254), (256, 0, 1, 256),
    # contract reserves one level above their base
    (67, 0, 1, 67), (109, 0, 1, 164), (76, 0, 1, 165), (153, 0, 1, 165), (110, 0, 1, 165), (142, 0, 1, 167),
    (77, 0, 1, 168), (111, 0, 1, 168), (120, 0, 1, 169), (81, 0, 1, 81),
]
TARGET_SCHEMA = "register_type_id int, sub_type int, level int, base_type_id int"

# Name patterns and ids with a rule of their own.
REPORTING_BRIEF = "МСФО9%"
INCOME_CODE = "%МСФО9_Доход%"
EXPENSE_CODE = "МСФО9_Расх%"
DROPPED_TARGET = 202
AWARDED_PENALTY_REGISTERS = (113, 114)
RESERVE_ACCOUNT_TYPE = 10050
RESERVE_PRIORITY = 5
PORTFOLIO, TRANCHE, CONTRACT = 2, 1, 0


def target_types(src: Mapping[str, DataFrame]) -> DataFrame:
    """Register types to report: the fixed ones, operational portfolio types and their reporting parents."""
    types = src["register_type"]
    fixed = const_df(types.sparkSession, TARGET_TYPES, TARGET_SCHEMA)
    portfolio = types.filter((F.col("sub_type") == PORTFOLIO) & (F.col("is_operational") == 1)).select(
        "register_type_id", "sub_type", F.lit(0).alias("level"), F.col("register_type_id").alias("base_type_id")
    )
    direct = fixed.unionByName(portfolio).distinct()
    ground = direct.filter(F.col("level") == 0)
    parents = (
        ground.select(F.col("register_type_id").alias("child_id"), "base_type_id")
        .join(src["register_type_link"], "child_id")
        .join(types.filter(F.col("brief").like(REPORTING_BRIEF)).withColumnRenamed("register_type_id", "parent_id"), "parent_id")
        .select(F.col("parent_id").alias("register_type_id"), "sub_type", F.lit(1).alias("level"), "base_type_id")
        .join(ground.select("register_type_id"), "register_type_id", "left_anti")
    )
    return dictionary(direct.unionByName(parents).distinct().filter(F.col("register_type_id") != DROPPED_TARGET))


def stored_links(src: Mapping[str, DataFrame]) -> DataFrame:
    """Stored pairs without portfolio registers on income and expense account types, plus the fixed pairs."""
    links = src["account_register_link"].select("register_type_id", "account_type_id")
    excluded = (
        links.join(src["register_type"].filter(F.col("sub_type") == PORTFOLIO).select("register_type_id"), "register_type_id")
        .join(
            src["account_type"].filter(F.col("code").like(INCOME_CODE) | F.col("code").like(EXPENSE_CODE)).select("account_type_id"),
            "account_type_id",
        )
        .select("register_type_id", "account_type_id")
    )
    kept = links.join(excluded, ["register_type_id", "account_type_id"], "left_anti")
    return kept.unionByName(const_df(links.sparkSession, EXTRA_LINKS, "register_type_id int, account_type_id int"))


def type_links(src: Mapping[str, DataFrame], targets: DataFrame) -> DataFrame:
    """Allowed account types per register type with their priority, 0 first."""
    base = stored_links(src).join(targets.select("register_type_id", F.col("level").alias("priority")).distinct(), "register_type_id")
    start = dictionary(base.select("register_type_id", "account_type_id", "priority"))
    lifted = expand_parents(start, src["register_type_link"], step=10, rounds=2)
    override = (F.col("account_type_id") == RESERVE_ACCOUNT_TYPE) & F.col("register_type_id").isin(*AWARDED_PENALTY_REGISTERS)
    return dictionary(lifted.withColumn("priority", F.when(override, F.lit(RESERVE_PRIORITY)).otherwise(F.col("priority"))))
