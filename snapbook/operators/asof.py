"""Lookups along a history: last row on or before a date, first change after it, balances of a day.

Every reduction keeps one row per key (ties aside) and shrinks on the map side: a struct maximum through partial
aggregation, ``row_number() = 1`` or ``rank() = 1`` through the window group limit. A key that holds a third of
the history leaves each map task as one row.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from snapbook.functions import exprs
from snapbook.session import cut, keys_of, listed

Names = str | Sequence[str]

BALANCES = ("rest", "over_in", "over_out")


def as_list(names: Names) -> list[str]:
    return [names] if isinstance(names, str) else list(names)


def first_per(df: DataFrame, key: Names, order: Sequence[Column], with_ties: bool = False) -> DataFrame:
    """Best row per key under ``order``; ``with_ties`` keeps every row that shares the best rank."""
    window = Window.partitionBy(*as_list(key)).orderBy(*order)
    place = F.rank() if with_ties else F.row_number()
    return df.withColumn("_place", place.over(window)).filter(F.col("_place") == 1).drop("_place")


def latest(
    hist: DataFrame,
    key: Names,
    eff: str,
    asof: date | None,
    ties: Sequence[str] = (),
    strict: bool = False,
) -> DataFrame:
    """Last history row per key with ``eff <= asof`` (``<`` when strict; no bound when asof is None).

    ``ties`` are further columns, largest first, that make the choice total.
    """
    keys = as_list(key)
    rows = hist
    if asof is not None:
        day = F.lit(asof).cast("date")
        rows = rows.filter(F.col(eff) < day if strict else F.col(eff) <= day)
    # One struct maximum per key: date first, then the ties, then whatever else the row has. It combines on
    # the map side, so a hot key leaves each map task as one row; as a struct is no fixed-width buffer, Spark sorts for it.
    # ``latest_by_day`` does without sorts where (key, date) is unique.
    lead = [eff, *ties]
    rest = [c for c in hist.columns if c not in keys and c not in lead]
    best = rows.groupBy(*keys).agg(F.max(F.struct(*lead, *rest)).alias("_last"))
    return best.select(*[F.col(c) if c in keys else F.col(f"_last.{c}").alias(c) for c in hist.columns])


def latest_by_day(hist: DataFrame, key: Names, eff: str, asof: date) -> DataFrame:
    """As ``latest`` for a history with one row per key and date and columns of fixed width (numbers, dates).

    Each column follows the largest date on its own, which Spark keeps in a hash table: no sort on either side of the exchange.
    """
    keys = as_list(key)
    rows = hist.filter(F.col(eff) <= F.lit(asof).cast("date"))
    rest = [c for c in hist.columns if c not in keys and c != eff]
    return rows.groupBy(*keys).agg(F.max(eff).alias(eff), *[F.max_by(c, eff).alias(c) for c in rest]).select(*hist.columns)


def asof_latest(
    left: DataFrame,
    hist: DataFrame,
    on: Names,
    eff: str,
    asof: date | None,
    cols: dict[str, str],
    ties: Sequence[str] = (),
    strict: bool = False,
) -> DataFrame:
    """Attach columns of the last history row on or before the date; ``cols`` maps history to output names."""
    keys = as_list(on)
    needed = dict.fromkeys([*keys, eff, *ties, *cols])
    last = latest(hist.select(*needed), keys, eff, asof, ties, strict)
    picked = last.select(*keys, *[F.col(c).alias(a) for c, a in cols.items()])
    return left.join(picked, keys, "left")


def asof_next(hist: DataFrame, key: Names, eff: str, asof: date) -> DataFrame:
    """Every history row that carries the earliest change strictly after the date, ties kept."""
    later = hist.filter(F.col(eff) > F.lit(asof).cast("date"))
    return first_per(later, key, [F.col(eff).asc()], with_ties=True)


def history_of(hist: DataFrame, keys: DataFrame, on: Names) -> DataFrame:
    """History rows of the given keys only, for a key set that is a small part of the history.

    The keys are written out first. Spark then knows their size: a small set is broadcast and the history is
    filtered in its scan, without an exchange; a large one joins by shuffle, and a runtime filter leaves most other rows in the scan.
    """
    names = as_list(on)
    return hist.join(keys_of(cut(listed(keys.select(*names).distinct())), *names), names, "left_semi")


def _balance_columns(asof: date) -> list[Column]:
    """Opening rest and turnovers of the day, as a register's row has them if it is its last by then."""
    on_day = F.col("oper_day") == F.lit(asof).cast("date")
    return [
        exprs.opening_rest(F.col("oper_day"), asof, F.col("rest_in"), F.col("rest_out")).alias("rest"),
        F.when(on_day, F.coalesce("over_in", F.lit(0))).otherwise(F.lit(0)).cast(exprs.MONEY).alias("over_in"),
        F.when(on_day, F.coalesce("over_out", F.lit(0))).otherwise(F.lit(0)).cast(exprs.MONEY).alias("over_out"),
    ]


def last_balances(last: DataFrame, asof: date) -> DataFrame:
    """Opening rest and turnovers of the day from the last row of every register.

    The row of the day and the row before it are the same lookup: when the last row is dated on the
    day it supplies the opening rest and the turnovers, otherwise the turnovers are 0.
    """
    return last.select("register_id", *_balance_columns(asof))


def day_balances(rests: DataFrame, asof: date) -> DataFrame:
    """Opening rest and turnovers of the day for every register that has a row by then. A register has one row per day.

    What a row would supply is worked out in the scan: the turnovers of earlier days are 0 there, and one rest is moved for two.
    """
    rows = rests.select("register_id", "oper_day", *_balance_columns(asof))
    return latest_by_day(rows, "register_id", "oper_day", asof).drop("oper_day")


def opening_rows(registers: DataFrame, balances: DataFrame) -> DataFrame:
    """Registers with their balances; registers without history get zeros."""
    joined = registers.join(balances, "register_id", "left")
    return joined.withColumns({c: F.coalesce(c, F.lit(0)).cast(exprs.MONEY) for c in BALANCES})


def without_balance(registers: DataFrame) -> DataFrame:
    """Registers that are known to have no history, as ``opening_rows`` has them."""
    return registers.withColumns({c: F.lit(0).cast(exprs.MONEY) for c in BALANCES})


def opening_balance(registers: DataFrame, rests: DataFrame, asof: date) -> DataFrame:
    """Registers with their opening rest and day turnovers; registers without history get zeros."""
    return opening_rows(registers, day_balances(rests, asof))


def asof_each(left: DataFrame, hist: DataFrame, on: Names, day: str, eff: str, cols: dict[str, str]) -> DataFrame:
    """``left`` with columns of the last history row on or before each row's own ``day``; one reading of the history for any number of days.

    Both sides are sorted together by key and date over range partitions, and every row carries on the last history row before it. A key that fills several
    partitions is carried across their borders: each partition hands on the last history row of its last key, one row per
    partition in one task. So a hot key is spread like any other. A history row counts on its own day; ties go to the largest remaining columns.
    """
    keys = as_list(on)
    kept = F.struct(F.col(eff).alias("_eff"), *[F.col(c).alias(a) for c, a in cols.items()])
    mine = F.struct(*[F.col(c) for c in left.columns])
    facts = hist.filter(F.col(eff).isNotNull()).select(*keys, F.col(eff).alias("_at"), F.lit(0).alias("_side"), kept.alias("_last"), F.lit(None).cast(left.select(mine.alias("r")).schema["r"].dataType).alias("_row"))
    asked = left.select(*keys, F.col(day).alias("_at"), F.lit(1).alias("_side"), F.lit(None).cast(facts.schema["_last"].dataType).alias("_last"), mine.alias("_row"))
    order = [F.col(k).asc_nulls_first() for k in keys] + [F.col("_at").asc_nulls_first(), F.col("_side").asc(), F.col("_last").asc_nulls_first(), F.col("_spread").asc()]
    # Many left rows may share key and day; a number from the input spreads them.
    both = facts.unionByName(asked).withColumn("_spread", F.monotonically_increasing_id())
    sorted_rows = cut(both.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
    key = F.struct(*[F.col(k) for k in keys])
    place = F.struct(*[F.col(k) for k in keys], F.col("_at"), F.col("_side"), F.col("_last"))
    ends = sorted_rows.groupBy("_part").agg(F.min(key).alias("_head"), F.max(key).alias("_tail"), F.max(F.when(F.col("_side") == 0, place)).alias("_fact"))
    # The last fact of a partition is handed on; further on it counts only for its own key.
    handed = F.last(F.when(F.col("_fact").isNotNull(), F.col("_fact")), ignorenulls=True).over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    borders = ends.withColumn("_handed", handed).filter(F.struct(*[F.col(f"_handed.{k}") for k in keys]) == F.col("_head")).select("_part", "_head", F.col("_handed._last").alias("_carried"))
    within = Window.partitionBy("_part", *keys).orderBy(*order[len(keys):]).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen = sorted_rows.withColumn("_seen", F.last("_last", ignorenulls=True).over(within)).filter(F.col("_side") == 1)
    joined = seen.join(F.broadcast(borders), "_part", "left")
    found = F.coalesce("_seen", F.when(key == F.col("_head"), F.col("_carried")))
    # A row without a key or a day finds nothing.
    usable = F.col("_at").isNotNull()
    for k in keys:
        usable = usable & F.col(k).isNotNull()
    rows = joined.select("_row", F.when(usable, found).alias("_found"))
    return rows.select("_row.*", *[F.col(f"_found.{a}").alias(a) for a in cols.values()])


def opening_balances(registers: DataFrame, rests: DataFrame, days: Sequence[date]) -> DataFrame:
    """As ``opening_balance`` for many days at once, with the day as column ``day``; the history is read once.

    Of each register stays the last row for every stretch between two of the days, combined before the exchange. Such a row counts from the first day it
    is known until the next one takes over, and comes out once for each of these days after the join: what is moved and sorted
    does not depend on the number of days. Ties go to the largest remaining columns.
    """
    asked = sorted(days)
    on = [F.lit(d).cast("date") for d in asked]
    columns = ("oper_day", "rest_in", "rest_out", "over_in", "over_out")
    slot = reduce(lambda later, i: F.when(F.col("oper_day") <= on[i], F.lit(i)).otherwise(later), reversed(range(len(on))), F.lit(None).cast("int"))
    known = rests.filter(F.col("oper_day") <= on[-1]).groupBy(F.col("register_id"), slot.alias("_slot")).agg(F.max(F.struct(*columns)).alias("_last"))
    order = Window.partitionBy("register_id").orderBy("_slot")
    # The first row of a register also stands for the days before it, which find nothing.
    spans = known.select(
        "register_id", "_last", F.when(F.lag("_slot").over(order).isNull(), F.lit(0)).otherwise(F.col("_slot")).alias("_from"),
        F.coalesce(F.lead("_slot").over(order), F.lit(len(on))).alias("_until"),
    )
    begin, end = F.coalesce("_from", F.lit(0)), F.coalesce("_until", F.lit(len(on)))
    each = registers.join(spans, "register_id", "left").withColumn("day", F.explode(F.slice(F.array(*on), begin + 1, end - begin)))
    seen, on_day = F.col("_last.oper_day") <= F.col("day"), F.col("_last.oper_day") == F.col("day")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast(exprs.MONEY)
    return each.select(
        *registers.columns, "day", zero(F.when(on_day, F.col("_last.rest_in")).when(seen, F.col("_last.rest_out"))).alias("rest"),
        zero(F.when(on_day, F.col("_last.over_in"))).alias("over_in"), zero(F.when(on_day, F.col("_last.over_out"))).alias("over_out"),
    )
