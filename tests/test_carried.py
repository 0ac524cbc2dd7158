"""Balances carried from day to day, and many dates in one reading of the history."""

import glob
import os
import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F, types as T

from snapbook.operators import asof as ao
from snapbook.session import new_folder, remove_folder
from snapbook.sources.carried import CarriedBalances, History
from snapbook.sources.slices import SliceStore

SCHEMA = T.StructType([T.StructField("register_id", T.StringType()), T.StructField("oper_day", T.DateType())] + [
    T.StructField(n, T.DecimalType(21, 2)) for n in ("rest_in", "rest_out", "over_in", "over_out")])
START = date(2024, 1, 20)


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def write_days(spark, folder, rows, by):
    """Put rows (key, day, rest) into the history as further files."""
    df = spark.createDataFrame([(k, d, r - 1, r, r, r + 1) for k, d, r in rows], "register_id string, oper_day date, a long, b long, c long, e long")
    df = df.select("register_id", "oper_day", *[F.col(x).cast("decimal(21,2)").alias(n) for x, n in zip("abce", ("rest_in", "rest_out", "over_in", "over_out"))])
    if by == "month":
        df.withColumn("oper_month", F.date_format("oper_day", "yyyy-MM")).coalesce(1).write.mode("append").partitionBy("oper_month").parquet(folder)
    else:
        df.coalesce(1).write.mode("append").partitionBy("oper_day").parquet(folder)


@pytest.mark.parametrize("by", ["day", "month"])
def test_thirty_days_with_late_corrections(spark, by):
    rng = random.Random(4)
    folder, store = new_folder(spark, "history"), SliceStore(spark, new_folder(spark, "carried"))
    history = History(spark, folder, part="oper_day" if by == "day" else "oper_month", by=by, schema=SCHEMA)
    carried = CarriedBalances(store, history, "S")
    registers = spark.createDataFrame([(f"r{i}",) for i in range(45)], "register_id string")
    known = set()

    def add(day, keys):
        rows = [(k, day, rng.randint(0, 999)) for k in keys if (k, day) not in known]
        known.update((k, d) for k, d, _ in rows)
        if rows:
            write_days(spark, folder, rows, by)

    for back in range(25, 0, -8):
        add(START - timedelta(days=back), [f"r{i}" for i in rng.sample(range(40), 15)])
    for step in range(0, 30, 3 if by == "day" else 5):
        day = START + timedelta(days=step)
        add(day, [f"r{i}" for i in rng.sample(range(40), 8)])
        if step % 2:
            # Rows of a day long carried come late, newer and older than what was carried.
            add(START + timedelta(days=rng.randint(-20, step - 1)), [f"r{i}" for i in rng.sample(range(40), 6)])
        if step == 9:
            # A day is taken back altogether.
            gone = START - timedelta(days=9)
            if by == "day":
                remove_folder(spark, f"{folder}/oper_day={gone}")
                known -= {(k, d) for k, d in known if d == gone}
        carried.advance(day)
        full = spark.read.schema(SCHEMA).parquet(folder) if by == "day" else spark.read.parquet(folder)
        assert rows_of(carried.opening_balance(registers, day)) == rows_of(ao.opening_balance(registers, full, day)), day
    assert len(store.days("carried_balance", "S")) >= 6


def test_only_dates_after_the_carried_slice_are_read(spark):
    folder, store = new_folder(spark, "history"), SliceStore(spark, new_folder(spark, "carried"))
    history = History(spark, folder, part="oper_day", by="day", schema=SCHEMA)
    for i in range(6):
        write_days(spark, folder, [(f"r{j}", START + timedelta(days=i), i + j) for j in range(5)], "day")
    carried = CarriedBalances(store, history, "S")
    carried.advance(START + timedelta(days=3))
    # Files of older days are unreadable from here on, and nobody looks.
    for i in range(4):
        for f in glob.glob(f"{folder}/oper_day={START + timedelta(days=i)}/*.parquet"):
            os.truncate(f, 3)
    merged = carried.merged(START + timedelta(days=5), START + timedelta(days=3), set())
    assert sorted((r["register_id"], r["rest_out"]) for r in merged.collect()) == [(f"r{j}", 5 + j) for j in range(5)]
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "Window" not in plan and "Join" not in plan


def test_nothing_is_done_twice(spark):
    folder, store = new_folder(spark, "history"), SliceStore(spark, new_folder(spark, "carried"))
    write_days(spark, folder, [("a", START, 5), ("b", START - timedelta(days=40), 7)], "month")
    carried = CarriedBalances(store, History(spark, folder), "S")
    assert carried.advance(START) == 2
    version = store.version("carried_balance", "S", START)
    assert carried.advance(START) == 2 and store.version("carried_balance", "S", START) == version
    write_days(spark, folder, [("a", START - timedelta(days=1), 9), ("c", START - timedelta(days=39), 1)], "month")
    assert carried.advance(START) == 3 and store.version("carried_balance", "S", START) == version + 1
    assert sorted((r["register_id"], r["oper_day"]) for r in carried.last(START).collect())[0] == ("a", START)


# many dates

def plain_asof(left, hist, cols):
    out = []
    for key, day, name in left:
        best = max(((d, *c) for k, d, *c in hist if key is not None and day is not None and k == key and d is not None and d <= day), default=None)
        out.append((key, day, name, *(best[1:] if best else (None,) * cols)))
    return sorted(out, key=str)


@pytest.mark.parametrize("partitions", ["1", "7", "40"])
def test_each_row_has_its_own_date(spark, partitions):
    """One key holds a third of all rows and crosses many borders; others have no history or no date."""
    rng = random.Random(int(partitions))
    day = lambda: START + timedelta(days=rng.randint(0, 60))
    hist = [("hot" if rng.random() < 0.4 else f"k{rng.randint(0, 30)}", day(), rng.randint(0, 9)) for _ in range(400)] + [("k1", None, 3), (None, START, 4), ("early", START, 5)]
    left = [("hot" if rng.random() < 0.4 else f"k{rng.randint(0, 40)}", day(), f"n{i}") for i in range(300)]
    left += [(None, START, "x"), ("k1", None, "y"), ("early", date(2030, 1, 1), "z"), ("hot", date(2001, 1, 1), "w"), ("hot", START, "s"), ("hot", START, "s")]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        h = spark.createDataFrame(hist, "k string, d date, v int")
        found = ao.asof_each(spark.createDataFrame(left, "k string, day date, name string"), h, "k", "day", "d", {"v": "value"})
        assert found.columns == ["k", "day", "name", "value"]
        assert sorted((tuple(r) for r in found.collect()), key=str) == plain_asof(left, hist, 1)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_a_month_is_the_union_of_its_days(spark, sf_dir):
    from workload.standins import StandIns

    s = StandIns(spark, sf_dir)
    registers = s["register"].select("register_id").filter(F.crc32(F.col("register_id").cast("binary")) % 9 == 0)
    days = [date(1998, 6, 1) + timedelta(days=i) for i in (0, 9, 20, 29)]
    found = ao.opening_balances(registers, s["register_rest"], days)
    for d in days:
        assert rows_of(found.filter(F.col("day") == F.lit(d)).drop("day")) == rows_of(ao.opening_balance(registers, s["register_rest"], d))


def test_no_window_holds_a_whole_key(spark):
    h = spark.createDataFrame([("k", START, 1)], "k string, d date, v int")
    left = spark.createDataFrame([("k", START)], "k string, day date")
    plan = ao.asof_each(left, h, "k", "day", "d", {"v": "value"})._jdf.queryExecution().optimizedPlan().toString()
    assert all("_part" in line for line in plan.splitlines() if "windowspecdefinition(k" in line)


def test_the_days_of_a_month_are_not_moved(spark):
    """Rows per register and day appear after the last exchange, and none is written out."""
    rng = random.Random(3)
    day = lambda i: START + timedelta(days=i)
    hist = [(f"k{rng.randint(0, 12)}" if rng.random() < 0.7 else "hot", day(rng.randint(-40, 40)), *[rng.choice([None, rng.randint(0, 9)]) for _ in range(4)]) for _ in range(300)]
    hist += [("k1", None, 1, 2, 3, 4), (None, START, 1, 2, 3, 4), ("early", day(-400), 1, 2, 3, 4), ("late", day(9), 5, 6, 7, 8)]
    keys = [f"k{i}" for i in range(15)] + ["hot", "hot", "early", "late", None]
    days = [day(i) for i in (3, 0, 1, 2, 9, 20)]
    rests = spark.createDataFrame(hist, SCHEMA.simpleString()[7:-1].replace("decimal(21,2)", "long")).select(
        *[F.col(f.name).cast(f.dataType) for f in SCHEMA])
    registers = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "register_id string, n int")
    want = []
    for i, k in enumerate(keys):
        for d in days:
            low = lambda row: tuple((v is not None, v or 0) for v in row[2:])
            last = max((h for h in hist if k is not None and h[0] == k and h[1] is not None and h[1] <= d), key=lambda h: (h[1], low(h)), default=None)
            on = last is not None and last[1] == d
            rest = 0 if last is None else last[2] if on else last[3]
            want.append((k, i, d, rest or 0, (last[4] or 0) if on else 0, (last[5] or 0) if on else 0))
    written, cut = [], ao.cut
    ao.cut = lambda df: written.append(df) or cut(df)
    try:
        found = ao.opening_balances(registers, rests, days)
    finally:
        ao.cut = cut
    assert found.columns == ["register_id", "n", "day", "rest", "over_in", "over_out"]
    numbers = lambda rows: sorted(((*r[:3], *map(float, r[3:])) for r in rows), key=str)
    assert numbers(found.collect()) == numbers(want)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert not written and plan.index("Generate explode") < plan.index("Exchange")
