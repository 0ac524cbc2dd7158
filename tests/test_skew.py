"""Hot keys: a third or more of the rows on one key, against brute force, and the shape of the plans."""

import re
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from snapbook.operators import asof, lookups, matching, numbering
from snapbook.plans import account, register_types as rt

D = date(1998, 6, 30)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_latest_on_a_hot_key(spark):
    data = [("hot" if i % 3 == 0 else f"k{i % 50}", D - timedelta(days=(i * 7919) % 400), i) for i in range(6000)]
    hist = spark.createDataFrame(data, "k string, eff date, v int")
    want = {}
    for k, e, v in data:
        want[k] = max(want.get(k, (date.min, -1)), (e, v))
    got = {r.k: (r.eff, r.v) for r in asof.latest(hist, "k", "eff", D, ties=("v",)).collect()}
    assert got == want
    # The struct maximum is taken before the exchange.
    plan = plan_of(asof.latest(hist, "k", "eff", D, ties=("v",)))
    assert plan.index("partial_max") > plan.index("Exchange")


def test_first_per_is_limited_before_the_exchange(spark):
    hist = spark.range(1000).selectExpr("cast(id % 7 as string) as k", "id as v")
    assert "WindowGroupLimit" in plan_of(asof.first_per(hist, "k", [F.col("v").desc()]))


def test_numbers_over_identical_rows(spark):
    df = spark.range(0, 3000, 1, 6).select(F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("v"))
    out = numbering.number_rows(df, [F.col("v").asc()], "idx", partitions=8)
    got = sorted((r.idx, r.v) for r in out.collect())
    want = sorted([-1 if i % 3 == 0 else i for i in range(3000)])
    assert [i for i, _ in got] == list(range(1, 3001)) and [v for _, v in got] == want
    # The copies of one value do not end up in one task.
    held = out.filter("v = -1").select(F.expr("idx").alias("i")).withColumn("p", F.spark_partition_id()).select("p").distinct().count()
    assert held > 1


def test_missing_keys_are_spread(spark):
    left = spark.range(4000).select("id", F.when(F.col("id") % 3 == 0, F.col("id") % 10).alias("k"))
    right = spark.range(5).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = lookups.attach(left, right, {"k": "k"}, {"v": "v"}, spread_nulls_by="id")
        assert re.search(r"hashpartitioning\(k#\d+L, _spread#\d+", plan_of(out))
        got = {r.id: r.v for r in out.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert got == {i: (i % 10) * 2 if i % 3 == 0 and i % 10 < 5 else None for i in range(4000)}


def test_hot_lookup_key_is_split(spark):
    keep = {k: spark.conf.get(k) for k in (
        "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.skewJoin.skewedPartitionFactor")}
    for k, v in zip(keep, ("-1", "10KB", "10KB", "2")):
        spark.conf.set(k, v)
    try:
        left = spark.range(0, 60000, 1, 8).select("id", F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 20000).alias("k"),
                                                   F.sha2(F.col("id").cast("string"), 256).alias("pad"))
        right = spark.range(20000).select(F.col("id").alias("k"), F.col("id").alias("v"))
        out = lookups.attach(left, right, {"k": "k"}, {"v": "v"}).groupBy("k").agg(
            F.count("v").alias("n"), F.max("pad").alias("pad"))
        got = {r.k: r.n for r in out.collect()}
        assert got[7] == 20000 + sum(1 for i in range(60000) if i % 3 and i % 20000 == 7)
        assert "skew=true" in plan_of(out)
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)


def test_matching_a_hot_portfolio_builds_no_pairs(spark):
    """A portfolio with 2000 registers and 2000 accounts: the largest join output is one row per register."""
    n = 2000
    regs = [(f"r{i}", 300 + i % 3, "hot" if i % 3 else f"p{i}", None, None, None) for i in range(n)]
    accs = [(f"a{i:05d}", 1 + i % 4, 2, "hot" if i % 3 else f"p{i}", datetime(2000 + (i * 37) % 50, 1, 1)) for i in range(n)]
    links = [(300, 1, 0), (300, 2, 0), (301, 3, 10), (301, 1, 20), (302, 4, 0)]
    reg = spark.createDataFrame(regs, "register_id string, register_type_id int, portfolio_id string, contract_id string, issue_id string, contract_oid string")
    acc = spark.createDataFrame(accs, "account_id string, account_type_id int, entry_kind int, entry_id string, will_close timestamp_ntz")
    lnk = spark.createDataFrame(links, "register_type_id int, account_type_id int, priority int")
    tgt = spark.createDataFrame([(t, 2, 0, t) for t in (300, 301, 302)], rt.TARGET_SCHEMA)
    got = {r.register_id: r.account_id for r in account.register_accounts(reg, acc, lnk, tgt).collect()}
    by_owner = {}
    for a, t, _, o, w in accs:
        by_owner.setdefault(o, []).append((a, t, w))
    want = {}
    for r, rtype, p, *_ in regs:
        cand = [(-pr, w, a) for a, t, w in by_owner.get(p, []) for lt, at, pr in links if lt == rtype and at == t]
        if cand:
            want[r] = max(cand)[2]
    assert got == want
    best = matching.best_accounts(acc.withColumnsRenamed({"entry_kind": "owner_kind", "entry_id": "owner_id"}), lnk, rt.RESERVE_ACCOUNT_TYPE)
    assert best.groupBy("owner_kind", "owner_id", "register_type_id").count().filter("count > 1").isEmpty()


def test_partners_by_any_key_are_counted_without_pairs(spark):
    pick = lambda i, m, tag: None if i % m == 0 else (f"{tag}hot" if i % 3 else f"{tag}{i % 11}")
    left = [(f"l{i}", pick(i, 4, "p"), pick(i, 5, "c"), pick(i, 2, "i")) for i in range(400)]
    right = [(f"r{i:04d}", pick(i, 3, "p"), pick(i, 7, "c"), pick(i, 4, "i")) for i in range(400)]
    schema = "{} string, portfolio_id string, contract_id string, issue_id string"
    out = matching.match_any(spark.createDataFrame(left, schema.format("a")), spark.createDataFrame(right, schema.format("b")),
                             account.OWNERS, "a", "b")
    want = {}
    for l in left:
        hits = [r[0] for r in right if any(x is not None and x == y for x, y in zip(l[1:], r[1:]))]
        if hits:
            want[l[0]] = (len(hits), min(hits))
    assert {r.a: (r.partners, r.first_partner) for r in out.collect()} == want


BIG = ["Q3_Q4_loans", "Q5_guarantees", "Q9_register_list", "Q14_accounts", "Q15_disposal_accounts", "Q16_schedules", "Q18_pledges_waterfall",
       "J15_disjunctive_join", "Q21_corrections"]


@pytest.mark.parametrize("name", BIG)
def test_no_nested_loops_or_cross_products(spark, sf_dir, name):
    plan = plan_of(entry.queries()[name](spark, sf_dir))
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_history_scan_is_pruned_and_filtered(spark, sf_dir):
    plan = plan_of(entry.queries()["J10_E17_opening_balance"](spark, sf_dir))
    scan = next(line for line in plan.splitlines() if "FileScan" in line and "oper_day" in line)
    assert "LessThanOrEqual(oper_day" in scan


def test_balances_need_no_sort(spark, sf_dir):
    plan = plan_of(entry.queries()["J10_E17_opening_balance"](spark, sf_dir))
    assert "HashAggregate" in plan and "SortAggregate" not in plan and "ObjectHashAggregate" not in plan


@pytest.mark.parametrize("name", ["Q14_accounts", "Q9_register_list", "U8_register_rest", "Q15_disposal_accounts"])
def test_histories_are_cut_to_the_keys_at_hand(spark, sf_dir, name):
    """Below the aggregate of the balance history stands a semi-join with a written key set."""
    lines = plan_of(entry.queries()[name](spark, sf_dir)).splitlines()
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    scans = [i for i, line in enumerate(lines) if "FileScan" in line and "oper_day" in line and "rest_out" in line]
    assert scans
    for i in scans:
        above = []
        level = depth(lines[i])
        for line in reversed(lines[:i]):
            if depth(line) < level:
                level = depth(line)
                above.append(line)
        semi = next(n for n, line in enumerate(above) if "LeftSemi" in line)
        reduced = next(n for n, line in enumerate(above) if "Aggregate" in line)
        assert semi < reduced


def test_disposal_reads_transactions_of_the_day_only(spark, sf_dir):
    """The plan left after the written tables has no scan of all transactions or movements."""
    plan = plan_of(entry.queries()["Q15_disposal_accounts"](spark, sf_dir))
    assert "debit_account_id" not in plan
