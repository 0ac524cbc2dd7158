"""Joins against frames with a unique key, scalar lookups and existence filters."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from snapbook.operators.asof import Names, as_list, first_per, history_of
from snapbook.session import cut

NULL_SPREAD = 1024


def _once(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Rows with a whole key, checked to have it once. The check is a filter on the key's count, which leaves the partitioning as it is and is never pruned."""
    rest = [c for c in df.columns if c not in keys]
    once = df.filter(_known(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("_times"), *([F.first(F.struct(*rest)).alias("_row")] if rest else []))
    shown = F.concat_ws(", ", *[F.col(k).cast("string") for k in keys])
    alarm = F.raise_error(F.concat(F.lit(f"{name}: repeated key {', '.join(keys)}: "), shown)).cast("boolean")
    checked = once.filter(F.when(F.col("_times") > 1, alarm).otherwise(F.lit(True)))
    return checked.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])


def _known(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def unique(df: DataFrame, key: Names, name: str, keyless: bool = True) -> DataFrame:
    """``df`` with the promise that its key is there once: the job that reads the rows fails on a repeated one and names frame and key.

    The check is an aggregate by the key inside the plan, on the partitioning a join by that key needs anyway, so there is no pass of its own. It counts
    rows of the plan, not of task attempts, so a task run twice after a lost executor raises no false alarm. Rows
    with a null in the key match nothing; they stay and are not checked, or with ``keyless`` off are left to the caller: what is
    returned then keeps the partitioning by the key.
    """
    keys = as_list(key)
    once = _once(df, keys, name)
    return once.unionByName(df.filter(~_known(keys))) if keyless else once


def accumulate(parts: Sequence[DataFrame], key: Names, names: Sequence[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Inserting the rows of several parts one after another into a table with a key: what it holds then, and what it turned away.

    A row whose key an earlier part has is turned away; the second frame has the key, the part that was first (from 0) and how many rows were turned
    away. With ``names`` of the parts, a key twice in one part fails the job, as it would break the key. Without, the part's smallest row
    stays. One aggregate, combined before the exchange; a key that fills a third of the parts leaves each task as one row.
    """
    keys = as_list(key)
    columns = parts[0].columns
    tagged = [part.select(*columns, F.lit(i).alias("_part")) for i, part in enumerate(parts)]
    rest = [c for c in columns if c not in keys]
    met = reduce(DataFrame.unionByName, tagged).groupBy(*keys).agg(
        F.min(F.struct("_part", *rest)).alias("_first"), F.count(F.lit(1)).alias("_times"),
        F.array(*[F.count_if(F.col("_part") == i) for i in range(len(parts))]).alias("_by_part"),
    )
    if names is not None:
        where = F.element_at(F.array(*map(F.lit, names)), F.col("_first._part") + 1)
        shown = F.concat_ws(", ", *[F.col(k).cast("string") for k in keys])
        alarm = F.raise_error(F.concat(where, F.lit(f": repeated key {', '.join(keys)}: "), shown)).cast("long")
        twice = F.exists("_by_part", lambda n: n > 1)
        met = met.withColumn("_times", F.when(twice, alarm).otherwise(F.col("_times")))
    met = cut(met)
    held = met.select(*[F.col(c) if c in keys else F.col(f"_first.{c}").alias(c) for c in columns])
    turned = met.filter(F.col("_times") > 1).select(*keys, F.col("_first._part").alias("kept_part"), (F.col("_times") - 1).alias("rejected_rows"))
    return held, turned


def attach(
    left: DataFrame,
    frame: DataFrame,
    on: dict[str, str],
    cols: dict[str, str],
    how: str = "left",
    default: Column | None = None,
    spread_nulls_by: str | None = None,
    once: str | None = None,
) -> DataFrame:
    """Add columns of a keyed frame; ``on`` maps left key columns to the frame's.

    ``once`` names a frame whose key has to be unique: a repeated key then fails the job (see ``unique``). Without it the frame may have
    several rows per key, and a left row comes out once for each.

    ``spread_nulls_by`` names a well distributed left column. Rows without a key never match, yet a
    plain left join would send them all to one task; with it they are spread over many.
    """
    keys = [F.col(r).alias(f"_k_{r}") for r in on.values()]
    cond = [F.col(l) == F.col(f"_k_{r}") for l, r in on.items()]
    drop = [f"_k_{r}" for r in on.values()]
    if how == "left" and spread_nulls_by is not None:
        missing = F.lit(False)
        for name in on:
            missing = missing | F.col(name).isNull()
        part = F.pmod(F.xxhash64(spread_nulls_by), F.lit(NULL_SPREAD)).cast("int")
        left = left.withColumn("_spread", F.when(missing, part).otherwise(F.lit(0)))
        # Always 0, but not a literal: a literal would be folded into the condition and drop out of the join key.
        keys.append(F.pmod(F.hash(*on.values()), F.lit(1)).alias("_k_spread"))
        cond.append(F.col("_spread") == F.col("_k_spread"))
        drop += ["_spread", "_k_spread"]
    if once is not None:
        # Rows without a key never match, so they need no look.
        frame = _once(frame.select(*dict.fromkeys([*on.values(), *cols])), list(on.values()), once)
    right = frame.select(*keys, *[F.col(c).alias(a) for c, a in cols.items()])
    joined = left.join(right, cond, how).drop(*drop)
    if default is not None:
        joined = joined.withColumns({a: F.coalesce(F.col(a), default) for a in cols.values()})
    return joined


def keep_existing(df: DataFrame, ref: DataFrame, on: Names) -> DataFrame:
    """Rows whose key occurs in ``ref``. Keys are reduced on the map side before they are exchanged."""
    keys = as_list(on)
    return df.join(ref.select(*keys).distinct(), keys, "left_semi")


def keep_few_existing(df: DataFrame, ref: DataFrame, on: Names) -> DataFrame:
    """As ``keep_existing`` for few rows and a large ``ref``: its keys are cut down to those at hand in its scan, so what is moved grows with ``df``."""
    keys = as_list(on)
    return keep_existing(df, history_of(ref.select(*keys), df.dropna(subset=keys), keys), keys)


def drop_existing(df: DataFrame, ref: DataFrame, on: Names) -> DataFrame:
    """Rows whose key does not occur in ``ref``."""
    keys = as_list(on)
    return df.join(ref.select(*keys).distinct(), keys, "left_anti")


def update_from(df: DataFrame, ref: DataFrame, on: dict[str, str], cols: dict[str, str]) -> DataFrame:
    """Overwrite columns where a row of ``ref`` matches (its value, even NULL), keep them elsewhere."""
    right = ref.select(
        *[F.col(r).alias(f"_k_{r}") for r in on.values()],
        *[F.col(c).alias(f"_new_{a}") for c, a in cols.items()],
        F.lit(True).alias("_hit"),
    )
    joined = df.join(right, [F.col(l) == F.col(f"_k_{r}") for l, r in on.items()], "left")
    fresh = {a: F.when(F.col("_hit"), F.col(f"_new_{a}")).otherwise(F.col(a)) for a in cols.values()}
    return joined.withColumns(fresh).select(*df.columns)


def max_id_per_code(df: DataFrame, code: str, identifier: str) -> DataFrame:
    """The row with the largest id of every code."""
    return first_per(df, code, [F.col(identifier).desc_nulls_last()])


def config_value(cfg: DataFrame, name: str) -> Column:
    """One configuration value as a scalar subquery; NULL when the name is absent."""
    return cfg.filter(F.col("name") == name).agg(F.max("integer_value")).scalar()


def default_id(df: DataFrame, name_col: str, name: str, id_col: str) -> Column:
    """Id of the row with the given name as a scalar subquery; the largest one if the name repeats."""
    return df.filter(F.col(name_col) == name).agg(F.max(id_col)).scalar()


def opt_filter(df: DataFrame, col: str, value: Any = None) -> DataFrame:
    """Filter on equality only when a value is given."""
    return df if value is None else df.filter(F.col(col) == value)


def const_df(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """Relation of constants written in the code.

    It goes in as an Arrow table, which Spark keeps as a local relation: the planner knows its size.
    """
    fields = T.StructType.fromDDL(schema)
    columns = {f.name: pa.array([row[i] for row in rows]) for i, f in enumerate(fields)}
    return spark.createDataFrame(pa.table(columns), fields)
