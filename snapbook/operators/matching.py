"""Choosing one partner among many without building the pairs.

A register may take any account of the same portfolio, tranche or contract whose type is linked to the
register's type. The order (priority, close date, id) depends on the account and on the two types only, so
the accounts of one owner are reduced to one per account type, then to one per register type, before a
register meets them: every join below has at most one partner per key, however many rows an owner has.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from snapbook.operators.asof import Names, as_list, first_per


def owner_rows(df: DataFrame, owners: dict[int, str], keep: Sequence[str]) -> DataFrame:
    """One row per filled owner column: ``owner_kind``, ``owner_id`` and the kept columns.

    An equality on any of several columns becomes one equality on (kind, id); empty owners vanish here.
    """
    entries = F.array(
        *[
            F.struct(F.lit(kind).alias("owner_kind"), F.col(col).cast("string").alias("owner_id"))
            for kind, col in owners.items()
        ]
    )
    return (
        df.select(*keep, F.explode(entries).alias("_owner"))
        .select(*keep, "_owner.owner_kind", "_owner.owner_id")
        .filter(F.col("owner_id").isNotNull())
    )


def match_any(left: DataFrame, right: DataFrame, keys: dict[int, str], left_id: str, right_id: str) -> DataFrame:
    """Partners of every left row that agree with it on at least one key: their number and the smallest id.

    The pairs are not built. Right rows are counted for every combination of filled keys, a left row meets one
    count per combination of its own keys, and inclusion-exclusion (odd combinations add, even ones subtract)
    counts a partner found by several keys once. ``right_id`` must be unique. Rows without a partner drop out.
    """
    columns = list(keys.values())
    masks = range(1, 1 << len(columns))

    def combinations(df: DataFrame, keep: str) -> DataFrame:
        rows = F.array(
            *[
                F.struct(
                    F.lit(mask).alias("mask"),
                    *[(F.col(c) if mask >> i & 1 else F.lit(None)).cast("string").alias(f"k{i}") for i, c in enumerate(columns)],
                )
                for mask in masks
            ]
        )
        out = df.select(keep, F.explode(rows).alias("_c")).select(keep, "_c.*")
        for i in range(len(columns)):
            # A combination counts only with all its keys filled; the others become blank for the equality.
            used = F.col("mask").bitwiseAND(F.lit(1 << i)) != 0
            out = out.filter(~used | F.col(f"k{i}").isNotNull())
        return out.withColumns({f"k{i}": F.coalesce(f"k{i}", F.lit("")) for i in range(len(columns))})

    on = ["mask", *[f"k{i}" for i in range(len(columns))]]
    counted = combinations(right, right_id).groupBy(*on).agg(F.count(F.lit(1)).alias("n"), F.min(right_id).alias("first"))
    sign = F.when(F.bit_count("mask") % 2 == 1, F.lit(1)).otherwise(F.lit(-1))
    return (
        combinations(left, left_id).join(counted, on).groupBy(left_id)
        .agg(F.sum(sign * F.col("n")).alias("partners"), F.min("first").alias("first_partner"))
    )


def prefer(df: DataFrame, key: Names, order: Sequence[Column]) -> DataFrame:
    """The preferred row of every key (largest sub type first, for accounts)."""
    return first_per(df, key, order)


def best_accounts(accounts: DataFrame, links: DataFrame, special_type: int) -> DataFrame:
    """Per owner and register type: the account to take, and the account to take of one special type.

    ``accounts``: owner_kind, owner_id, account_type_id, will_close, account_id.
    ``links``: register_type_id, account_type_id, priority.
    Both choices are the maximum of a struct, so they combine on the map side. Ties go to the largest id.
    """
    # The links are a dictionary product; only the best priority of a pair can ever win.
    best_links = links.groupBy("register_type_id", "account_type_id").agg(F.min("priority").alias("priority"))
    per_type = accounts.groupBy("owner_kind", "owner_id", "account_type_id").agg(
        F.max(F.struct("will_close", "account_id")).alias("best")
    )
    linked = per_type.join(best_links, "account_type_id")
    rank = F.struct(
        (-F.col("priority")).alias("rank"), "best.will_close", "best.account_id", F.col("account_type_id")
    )
    return linked.groupBy("owner_kind", "owner_id", "register_type_id").agg(
        F.max(rank).alias("direct"),
        F.max(F.when(F.col("account_type_id") == special_type, F.col("best"))).alias("special"),
    )


def assign_accounts(registers: DataFrame, best: DataFrame, owners: dict[int, str]) -> DataFrame:
    """Direct and special account of every register over all its owners; registers without one drop out.

    The register's own columns travel along as group keys, so nothing is joined back.
    """
    rows = owner_rows(registers, owners, registers.columns)
    return (
        rows.join(best, ["owner_kind", "owner_id", "register_type_id"])
        .groupBy(*registers.columns)
        .agg(F.max("direct").alias("direct"), F.max("special").alias("special"))
        .select(
            *registers.columns,
            F.col("direct.account_id").alias("direct_id"),
            F.col("direct.account_type_id").alias("direct_type"),
            F.col("special.account_id").alias("special_id"),
        )
    )


def class_representative(pairs: DataFrame, kind: str, class_keys: dict[int, str], base: str, level: str,
                         member: Sequence[str]) -> DataFrame:
    """One member with the lowest level per equivalence class.

    A class is (kind, id, base). It is asked for by the rows whose own kind is that kind, while every row
    that carries the id competes for it. Nothing is joined: the class keeps its best row and a mark whether
    somebody asked.
    """
    keep = [kind, base, level, *member]
    rows = owner_rows(pairs, class_keys, keep)
    return (
        rows.groupBy("owner_kind", "owner_id", base)
        .agg(
            F.min(F.struct(level, *member)).alias("best"),
            F.max(F.col(kind) == F.col("owner_kind")).alias("wanted"),
        )
        .filter("wanted")
        .select(*[F.col(f"best.{c}").alias(c) for c in member])
        .distinct()
    )
