"""Unique keys inside the job, accumulating inserts, cycles, logs by date, tables in buckets."""

import random
import subprocess
import sys
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from snapbook import RunContext
from snapbook.operators import asof as ao
from snapbook.operators.hierarchy import resolve_chains
from snapbook.operators.lookups import accumulate, attach, unique
from snapbook.plans import account, daily, loan
from snapbook.session import new_folder, sub_folders
from snapbook.sources import audit
from snapbook.sources.carried import CarriedBalances, History
from snapbook.sources.slices import SliceStore
from snapbook.sources.tables import Sources, write_buckets
from workload.queries import CTX, D, loan_frames
from workload.standins import StandIns


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


# unique keys

def test_a_repeated_key_fails_the_job_and_names_the_frame(spark):
    left = spark.createDataFrame([(i, f"k{i % 4}") for i in range(40)], "id int, k string")
    names = spark.createDataFrame([("k0", "a"), ("k1", "b"), ("k2", "c"), (None, "n"), (None, "m")], "code string, name string")
    once = attach(left, names, {"k": "code"}, {"name": "name"}, once="names")
    assert rows_of(once) == rows_of(attach(left, names, {"k": "code"}, {"name": "name"}))
    twice = names.union(spark.createDataFrame([("k1", "again")], names.schema))
    with pytest.raises(Exception, match="names: repeated key code: k1"):
        attach(left, twice, {"k": "code"}, {"name": "name"}, once="names").collect()
    # Without the promise a left row comes out once for each.
    assert attach(left, twice, {"k": "code"}, {"name": "name"}).count() == 50
    # A key nobody asks for counts too, as it would break the key of the table.
    unasked = names.union(spark.createDataFrame([("z", "1"), ("z", "2")], names.schema))
    with pytest.raises(Exception, match="repeated key code: z"):
        attach(left, unasked, {"k": "code"}, {"name": "name"}, once="names").collect()


def test_unique_keeps_rows_and_needs_one_exchange(spark):
    df = spark.createDataFrame([(i, i % 7, None if i % 5 else "x") for i in range(50)], "id int, n int, t string").withColumn("id", F.when(F.col("id") > 3, F.col("id")))
    assert rows_of(unique(df, "id", "rows")) == rows_of(df)
    with pytest.raises(Exception, match="rows: repeated key n, t"):
        unique(df.filter("t is not null"), ["n", "t"], "rows").collect()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = spark.range(100).select(F.col("id").cast("int").alias("k"))
        plan = attach(left, df.filter("id is not null"), {"k": "id"}, {"n": "n"}, once="rows")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 2


def test_steps_fail_on_repeated_dictionary_entry_and_register(spark, sf_dir):
    src = loan_frames(StandIns(spark, sf_dir))
    src["customer"] = src["customer"].unionByName(src["customer"].limit(1))
    with pytest.raises(Exception, match="customer: repeated key customer_id"):
        loan.loan_snapshot(src, CTX).collect()
    src = StandIns(spark, sf_dir)
    loans, guarantees = src["loan_slice"], src["guarantee_slice"]
    one = loans.filter(F.col("main_contract_oid").isNull()).limit(1)
    with pytest.raises(Exception, match="published contracts: repeated key entry_kind, entry_id"):
        account.account_entries(src, CTX, loans.unionByName(one), guarantees).collect()
    src["register"] = src["register"].unionByName(src["register"].filter("contract_id is not null"))
    with pytest.raises(Exception, match="register list: repeated key register_id"):
        account.account_snapshot(src, CTX, loans, guarantees).collect()


# accumulating inserts

def test_accumulate_keeps_the_first_part(spark):
    rng = random.Random(2)
    parts = [[(rng.randint(0, 60), f"{p}-{i}") for i in range(80)] for p in range(3)]
    parts[1] += [(7, f"hot{i}") for i in range(300)]
    frames = [spark.createDataFrame(p, "k int, v string") for p in parts]
    held, turned = accumulate(frames, "k")
    table, away = {}, {}
    for number, part in enumerate(parts):
        for k, v in sorted(part):
            if k in table:
                away[k] = away.get(k, 0) + 1
            else:
                table[k] = (number, v)
    assert rows_of(held) == sorted(((k, v) for k, (_, v) in table.items()), key=str)
    assert rows_of(turned) == sorted(((k, table[k][0], n) for k, n in away.items()), key=str)


def test_accumulate_with_names_refuses_a_key_twice_in_one_part(spark):
    a, b = (spark.createDataFrame(rows, "k int, v int") for rows in ([(1, 1), (2, 2)], [(1, 5), (3, 6)]))
    held, turned = accumulate([a, b], "k", ["first", "second"])
    assert rows_of(held) == [(1, 1), (2, 2), (3, 6)] and rows_of(turned) == [(1, 0, 1)]
    with pytest.raises(Exception, match="second: repeated key k: 3"):
        accumulate([a, b.unionByName(b.filter("k = 3"))], "k", ["first", "second"])


# cycles

def plain_chains(links):
    up, found, lost = dict(links), {}, {}
    for node in up:
        way, at = [node], node
        while up.get(at) is not None and up[at] not in way:
            at = up[at]
            way.append(at)
            if at not in up:
                break
        nxt = up.get(at)
        if nxt is None:
            found[node] = (at, len(way) - 1)
        else:
            ring = way[way.index(nxt):]
            lost[node] = (min(ring), len(ring), node in ring)
    return found, lost


@pytest.mark.parametrize("seed", range(3))
def test_chains_and_cycles(spark, seed):
    rng = random.Random(seed)
    links = [(f"n{i}", None if rng.random() < 0.15 else f"n{rng.randint(0, 75)}") for i in range(70)]
    links += [(f"c{i}", f"c{(i + 1) % 33}") for i in range(33)] + [(f"t{i}", f"t{i - 1}" if i else "c5") for i in range(50)] + [("self", "self")]
    links += [(f"x{i}", f"x{i - 1}" if i else None) for i in range(40)]
    roots, cycles = resolve_chains(spark.createDataFrame(links, "node string, prev string"), "node", "prev")
    found, lost = plain_chains(links)
    assert {r["node"]: (r["root"], r["level"]) for r in roots.collect()} == found
    assert {r["node"]: (r["base_id"], r["cycle_length"], r["on_cycle"]) for r in cycles.collect()} == lost


def test_pledges_without_a_base_are_reported_and_the_others_published(spark, sf_dir):
    src = StandIns(spark, sf_dir)
    src["config"] = src["config12"]
    names = {n: src[n] for n in ("loan_slice", "contract", "base_contract", "pledge", "pledge_link", "pledge_contract", "pledge_owner", "pledge_object", "surety",
                                 "pledge_link_history", "pledge_quality", "pledge_assessment", "pledge_conclusion", "activity", "external_system", "collateral_type", "branch", "config")}
    number = F.substring("pledge_id", 2, 20).cast("long")
    chain = src["pledge_chain"].withColumn("prev_pledge_id", F.when(number == 8, F.lit("p9")).otherwise(F.col("prev_pledge_id")))
    store = SliceStore(spark, new_folder(spark, "day"))
    store.replace(src["loan_slice"], "loan", "Test", D)
    steps = daily.publish_day(Sources(spark, new_folder(spark, "none"), pledge_chain=chain, **names), RunContext(D, source="Test"), store, only=("pledge",), today=D).collect()
    assert [(r.target, r.status) for r in steps] == [("pledge", 1)], steps
    rejected = {r["pledge_id"]: (r["base_id"], r["cycle_length"], r["on_cycle"]) for r in store.read("pledge_reject", "Test", D).collect()}
    assert rejected == {"p8": ("p8", 2, True), "p9": ("p8", 2, True), **{f"p{i}": ("p8", 2, False) for i in range(10, 16)}}
    assert store.read("pledge", "Test", D).count() > 0


# logs

def log_frames(spark, *days):
    runs = spark.createDataFrame([(f"run-{d}", 0, d, datetime(2024, 1, 1)) for d in days], audit.RUN_SCHEMA)
    steps = spark.createDataFrame([(f"s{i}-{d}", f"run-{d}", datetime(2024, 1, 1), i, "loan", None, 1, 5, None, None, None) for d in days for i in range(3)], audit.STEP_SCHEMA)
    return runs, steps


def test_a_batch_appended_twice_is_there_once(spark):
    log = audit.RunLog(spark, new_folder(spark, "log"))
    days = [date(2024, 1, 31), date(2024, 2, 1)]
    assert log.append("b1", *log_frames(spark, *days)) == 2
    before = rows_of(log.steps())
    assert log.append("b1", *log_frames(spark, *days)) == 0 and rows_of(log.steps()) == before
    assert log.append("b2", *log_frames(spark, date(2024, 3, 1))) == 1
    assert log.runs().count() == 3 and log.steps().count() == 9
    assert log.runs().columns == ["run_id", "event_type", "for_date", "start"]
    with pytest.raises(ValueError):
        log.append("a/b", *log_frames(spark, *days))


def test_a_stop_halfway_leaves_no_header_without_steps(spark, monkeypatch):
    log = audit.RunLog(spark, new_folder(spark, "log"))
    move = log._move_in

    def stop(df, table, batch):
        if table == "run":
            raise KeyboardInterrupt
        return move(df, table, batch)

    monkeypatch.setattr(log, "_move_in", stop)
    with pytest.raises(KeyboardInterrupt):
        log.append("b", *log_frames(spark, date(2024, 1, 31)))
    monkeypatch.undo()
    assert log.runs().count() == 0
    assert log.append("b", *log_frames(spark, date(2024, 1, 31))) == 1
    assert log.runs().count() == 1 and log.steps().count() == 3


@pytest.mark.parametrize("today, kept", [(date(2025, 1, 31), 2), (date(2025, 1, 30), 3), (date(2025, 2, 28), 1), (date(2026, 5, 1), 0)])
def test_expired_dates_go_without_a_job(spark, today, kept):
    log = audit.RunLog(spark, new_folder(spark, "log"))
    log.append("b", *log_frames(spark, date(2024, 1, 31), date(2024, 2, 28), date(2024, 2, 29)))
    spark.sparkContext.setJobGroup("retention", "retention")
    log.retain(12, today)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("retention")) == 0
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert log.runs().count() == kept and log.steps().count() == 3 * kept
    assert sub_folders(spark, f"{log.root}/_staging") == []


# tables in buckets

def test_colocated_tables_are_joined_without_an_exchange(spark, sf_dir):
    s, root = StandIns(spark, sf_dir), new_folder(spark, "buckets")
    for name in ("register", "register_rest"):
        write_buckets(s[name], root, name, "register_id", 6)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        src = Sources(spark, root)
        found = ao.opening_balance(src["register"].select("register_id"), src["register_rest"], D)
        assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
        assert rows_of(found) == rows_of(ao.opening_balance(s["register"].select("register_id"), s["register_rest"], D))
        assert src["register"].columns == s["register"].columns and "contract" not in src
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # A session that has not written them enters them in its catalog.
    for name in ("register", "register_rest"):
        spark.sql(f"drop table {Sources(spark, root)[name].inputFiles() and _table_of(spark, root, name)}")
    again = Sources(spark, root)
    assert again["register_rest"].count() == s["register_rest"].count()


def _table_of(spark, root, name):
    from snapbook.sources.tables import _table

    return _table(root, name)


# a day from carried balances

def test_a_day_from_carried_balances(spark, sf_dir):
    src = loan_frames(StandIns(spark, sf_dir))
    folder, ctx = new_folder(spark, "history"), RunContext(D, source="Test")
    src["register_rest"].withColumn("oper_month", F.date_format("oper_day", "yyyy-MM")).repartition("oper_month").write.partitionBy("oper_month").parquet(folder)
    whole, store = (SliceStore(spark, new_folder(spark, "day")) for _ in range(2))
    only = ("loan", "guarantee", "account")
    first = {r.target: (r.status, r.record_count) for r in daily.publish_day(src, ctx, whole, only=only, today=D).collect()}
    carried = CarriedBalances(store, History(spark, folder), "Test")
    second = {r.target: (r.status, r.record_count) for r in daily.publish_day(src, ctx, store, only=(*only, carried.name), today=D, carried=carried).collect()}
    assert second.pop(carried.name)[0] == 1 and second == first
    for name in only:
        assert rows_of(store.read(name, "Test", D)) == rows_of(whole.read(name, "Test", D))


# entry points

def test_entry_points_without_the_packages_of_the_document_operators():
    code = "import sys; sys.modules['tokenizers'] = None; import __spark_entry__ as e; q = e.queries(); assert len(q) > 100 and 'op2_quality' not in q and 'op2_quality' not in e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=__file__.rsplit("/tests/", 1)[0])


def test_today_asks_the_clock_once():
    days = iter([D, date(2000, 1, 1)])
    ctx = RunContext.today(clock=lambda: next(days), source="X", depth_days=2)
    assert (ctx.asof, ctx.source, ctx.depth_days) == (D, "X", 2) and RunContext.today().asof == date.today()
    with pytest.raises(ValueError):
        RunContext(None)


# histories cut down before they are reduced

def _below(plan, reducer):
    """Whether each node of that kind over a history has a semi-join below it, by the indentation of the plan's lines."""
    lines = plan.splitlines()
    depth = lambda line: len(line) - len(line.lstrip(" :+-|"))
    found = []
    for i, line in enumerate(lines):
        if reducer in line:
            inside = [x for x in lines[i + 1 :]][: next((n for n, x in enumerate(lines[i + 1 :]) if depth(x) <= depth(line)), len(lines))]
            found.append(any("LeftSemi" in x for x in inside))
    return found


def test_loan_histories_are_cut_down_in_their_scan(spark, sf_dir):
    src = StandIns(spark, sf_dir)
    header = loan.cut(src["contract"].select("contract_id").limit(50))
    facts = loan.routines.Facts({n: src[n] for n in ("risk_change", "risk_group")}, D)
    for frame in (loan.routines.contract_sum(loan.of_keys(src["contract_sum"], header, "contract_id"), D), loan.quality_of(facts, "contract", header)):
        below = _below(frame._jdf.queryExecution().optimizedPlan().toString(), "Aggregate [contract_id")
        assert below and all(below)
