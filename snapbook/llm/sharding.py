"""Sharding by jump consistent hashing (Lamping and Veach, 2014), in DataFrame expressions.

Rules: a null key counts as key 0. Rows with the same key always share a shard. A null text has size 8 and the checksum
of the empty text. Slots follow key order inside a shard; equal rows get different slots.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from snapbook.operators.numbering import number_rows

MULTIPLIER = "2862933555777941757"
WHOLE = "18446744073709551616"
USUAL_STEPS = 64


def key_number(key: Column, kind: T.DataType) -> Column:
    """A key as an unsigned 64-bit number: integers as they are, other keys by the first half of their MD5."""
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        number = key.cast("decimal(20,0)")
    else:
        number = F.conv(F.substring(F.md5(key.cast("string").cast("binary")), 1, 16), 16, 10).cast("decimal(20,0)")
    number = F.coalesce(number, F.lit(0).cast("decimal(20,0)"))
    return F.when(number < 0, (number + F.lit(WHOLE).cast("decimal(20,0)")).cast("decimal(20,0)")).otherwise(number)


def _step(state: Column, shards: int) -> Column:
    """One jump. 2**64 times the multiplier has 38 digits, so the product is exact in a decimal."""
    going = state["jump"] < F.lit(shards)
    mixed = (
        (state["key"] * F.lit(MULTIPLIER).cast("decimal(19,0)") + F.lit(1).cast("decimal(1,0)")) % F.lit(WHOLE).cast("decimal(20,0)")
    ).cast("decimal(20,0)")
    upper = F.floor(mixed / F.lit("8589934592").cast("decimal(10,0)")).cast("double")
    jump = F.floor((state["jump"] + 1).cast("double") * (F.lit(2147483648.0) / (upper + 1.0))).cast("long")
    return F.when(
        going,
        F.struct(mixed.alias("key"), state["jump"].alias("shard"), jump.alias("jump")),
    ).otherwise(state)


def jump_shard(number: Column, shards: int) -> Column:
    """The shard of an unsigned 64-bit number: the last jump that stays below ``shards``.

    About ln(shards) jumps are made. The first 64 steps suffice for nearly every key; a key that is not done then goes on
    for as many steps as there are shards, which is the most that can happen.
    """
    if shards < 1:
        raise ValueError("shards must be at least 1")
    start = F.struct(number.alias("key"), F.lit(0).cast("long").alias("shard"), F.lit(0).cast("long").alias("jump"))

    def walk(state: Column, steps: int) -> Column:
        return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), state, lambda s, _: _step(s, shards))

    first = walk(start, min(USUAL_STEPS, shards))
    if shards <= USUAL_STEPS:
        return first["shard"].cast("int")
    return F.when(first["jump"] < shards, walk(first, shards)["shard"]).otherwise(first["shard"]).cast("int")


def assign_shards(df: DataFrame, key: str, shards: int, name: str = "shard") -> DataFrame:
    """All columns of ``df`` and the shard of each row; a narrow projection without any exchange.

    Going from n to n + 1 shards changes the shard of about 1 / (n + 1) of the keys, all of them to the new shard.
    """
    number = key_number(F.col(f"`{key}`"), df.schema[key].dataType)
    return df.withColumn(name, jump_shard(number, shards))


def number_in_shards(df: DataFrame, shard: str, order: list[Column], name: str = "slot") -> DataFrame:
    """Gapless numbers from 0 inside each shard.

    Rows are numbered once over (shard, order) by range partitions, so one huge shard is spread over many tasks; the
    first number of a shard follows from the shards' counts (one row per shard).
    """
    counts = df.groupBy(shard).agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy(shard).rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select(
        F.col(shard).alias("_shard"), F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_first")
    )
    numbered = number_rows(df, [F.col(shard).asc(), *order], "_number")
    return numbered.join(F.broadcast(first), F.col(shard) == F.col("_shard")).select(
        *df.columns, (F.col("_number") - F.col("_first") - 1).alias(name)
    )
