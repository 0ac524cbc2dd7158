"""What queries over the whole book move: rows are summed, reduced or cut down before an exchange, not after it."""

import glob
import os
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from snapbook import RunContext, session
from snapbook.operators import asof, lookups, numbering
from snapbook.plans import account, corrections, guarantee, loan
from snapbook.sources import carried
from snapbook.sources.slices import SliceStore
from workload import queries, standins
from workload.queries import QUERIES
from workload.standins import StandIns

D = date(1998, 6, 30)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture(scope="module")
def few(spark, tmp_path_factory):
    """A file of line items for orders with many days, and what they belong to."""
    folder = str(tmp_path_factory.mktemp("few"))
    day = datetime(1998, 6, 1)
    lines = [(i % 9, i % 5, i % 4, i % 6, 1.0, 10.0 + i, 0.1, 0.01, "N", "O", day + timedelta(days=i % 50)) for i in range(600)]
    names = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    spark.createDataFrame(lines, names).coalesce(1).write.parquet(f"{folder}/lineitem.parquet")
    spark.createDataFrame([(i, f"n{i}", f"Brand#{i % 2}", "t", i, 1.0) for i in range(5)], "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double").coalesce(1).write.parquet(f"{folder}/part.parquet")
    spark.createDataFrame([(i, i, "F", 5.0, day, "1") for i in range(9)], "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string").write.parquet(f"{folder}/orders.parquet")
    return folder


def test_balances_dealt_out_by_register_stay_there(spark, few):
    """a register's history is not scattered again, so it shrinks to one row before it is moved."""
    rests = StandIns(spark, few)["register_rest"]
    placed = rests.select("register_id", F.input_file_name().alias("file"))
    spread = placed.groupBy("register_id").agg(F.count_distinct("file").alias("files"), F.count(F.lit(1)).alias("n"))
    assert spread.agg(F.max("n")).first()[0] > 4
    assert spread.agg(F.max("files")).first()[0] == 1


def test_sums_of_a_register_come_before_the_join(spark, few):
    """the history is summed below the join; a register listed twice counts twice, one without history does not come."""
    plan = optimized(QUERIES["G6_grouped_sums"](spark, few))
    assert "Aggregate [register_id" in plan[plan.index("Join Inner"):]
    s = StandIns(spark, few)
    joined = s["register_rest"].join(s["register"], "register_id").groupBy("register_type_id", "contract_id", "issue_id", "portfolio_id").agg(
        *[F.sum(c).cast("double").alias(c) for c in ("over_in", "over_out", "rest_out")])
    got = QUERIES["G6_grouped_sums"](spark, few)
    assert rows_of(got.select([F.round(c, 2) if t == "double" else c for c, t in got.dtypes])) == rows_of(joined.select([F.round(c, 2) if t == "double" else c for c, t in joined.dtypes]))


def test_few_rows_cut_the_reference_down(spark, tmp_path):
    """a semi join of few rows reads a large reference by their keys; repeats and nulls on both sides change nothing."""
    spark.range(5000).selectExpr("cast(id % 900 as string) as k", "id as v").unionAll(spark.sql("select cast(null as string), 0L")).write.parquet(str(tmp_path / "ref"))
    ref = spark.read.parquet(str(tmp_path / "ref"))
    df = spark.createDataFrame([("7", 1), ("7", 1), ("901", 2), (None, 3), ("8", 4)], "k string, n int")
    out = lookups.keep_few_existing(df, ref, "k")
    assert rows_of(out) == [("7", 1), ("7", 1), ("8", 4)] and out.columns == df.columns
    assert optimized(out).count("Join LeftSemi") == 2
    entries = spark.createDataFrame([("7", "", "P", D, 1.0, "1" * 20, "2" * 20, "x", "s", 1, "N"), ("7", "", "", D, 1.0, "1" * 20, "2" * 20, "x", "s", 1, "N"), ("c0", "", "P", D, 2.0, "1" * 20, "2" * 20, "x", "s", 1, "N")],
        "contract_oid string, tranche_oid string, portfolio_oid string, date1 date, sum_rub double, acc_number_debet string, acc_number_credit string, payment_purpose string, source string, branch_code int, operation_type string")
    found = corrections.corrections(entries, ref.withColumnRenamed("k", "contract_id"), spark.createDataFrame([("P",)], "portfolio_id string"), D, 1, "s")
    assert rows_of(found.select("contract_id", "portfolio_id", "idx")) == [("7", "P", 2), ("7", "P", 2), ("7", None, 1), ("c0", "P", 3)]
    assert optimized(found).count("Join LeftSemi") == 4


def test_revisions_of_other_contracts_are_not_moved(spark):
    """the last revision is looked up for the given contracts only, and is the same as without them."""
    day = datetime(1998, 6, 1)
    kinds = sorted(guarantee.CHANGE_TYPES)
    status = guarantee.STATUS_MAP[0][0]
    names = "history_id string, contract_id string, change_type int, number string"
    src = {
        "guarantee_event": spark.createDataFrame([(f"h{i}", day + timedelta(days=i % 6), status) for i in range(60)], "history_id string, create_date timestamp_ntz, guarant_status int"),
        "contract_revision": spark.createDataFrame([(f"h{i}", f"c{i % 7}" if i % 10 else None, kinds[i % len(kinds)], f"n{i}") for i in range(60)], names),
    }
    chosen = spark.createDataFrame([("c1",), ("c1",), ("c5",), (None,)], "contract_id string")
    every = guarantee.last_revisions(src, RunContext(D))
    some = guarantee.last_revisions(src, RunContext(D), chosen)
    assert rows_of(some) == rows_of(every.filter(F.col("contract_id").isin("c1", "c5"))) and some.count() == 2


def test_the_register_list_builds_no_account_tables(monkeypatch):
    """the register list reads no accounts, so their tables are not built for it."""
    asked = []

    class Names(dict):
        def __missing__(self, name):
            asked.append(name)
            return name

    monkeypatch.setattr(queries.rt, "target_types", lambda s: "targets")
    monkeypatch.setattr(account, "account_entries", lambda s, *a: "entries")
    monkeypatch.setattr(account, "register_list", lambda s, ctx, entries, targets: s["register"] and s["register_rest"] and (entries, targets))
    monkeypatch.setattr(account, "account_list", lambda s, *a: s["account"] and s["base_account"])
    monkeypatch.setattr(account, "register_rows", lambda *a: "rows")
    monkeypatch.setattr(queries, "configure", lambda spark: spark)
    monkeypatch.setattr(queries, "plain", lambda out: out)
    monkeypatch.setattr(queries, "StandIns", lambda spark, folder: Names())
    assert QUERIES["Q9_register_list"](None, "") == ("entries", "targets")
    assert "register_rest" in asked and not {"account", "base_account"} & set(asked)


def test_numbered_parts_follow_the_size(spark, tmp_path, monkeypatch):
    """a part holds a bounded share of the input, whatever the number of shuffle partitions."""
    spark.range(2000).selectExpr("id % 50 as v").coalesce(1).write.parquet(str(tmp_path / "rows"))
    df = spark.read.parquet(str(tmp_path / "rows"))
    monkeypatch.setattr(numbering, "NUMBERED_BYTES", 100)
    seen, cut = [], numbering.cut
    monkeypatch.setattr(numbering, "cut", lambda d: seen.append(d.rdd.getNumPartitions()) or cut(d))
    out = rows_of(numbering.number_rows(df, [F.col("v").asc()], "idx"))
    assert seen[0] > int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert sorted(i for _, i in out) == list(range(1, 2001)) and [v for v, _ in sorted(out, key=lambda r: r[1])] == sorted(i % 50 for i in range(2000))


def test_a_line_item_is_dealt_out_once(spark, few):
    """one exchange by order serves the contract, tranche and disposal registers of a line item; it becomes their rows above that."""
    frame = StandIns(spark, few).once("register_rest")
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(order_id") == 1 and plan.index("Generate explode") < plan.index("Exchange hashpartitioning(order_id")
    view = spark.sql(standins.VIEWS["register_rest"], **{n: spark.read.parquet(f"{few}/{n}.parquet") for n in ("lineitem", "part")})
    assert rows_of(frame) == rows_of(view)


def test_registers_of_unlinked_types_are_not_moved_to_their_owners(spark, monkeypatch):
    """only registers whose type has a linked account type are spread over their owners; the pairs are the same, also for one listed twice."""
    names = "register_id string, register_type_id int, portfolio_id string, contract_id string, issue_id string, contract_oid string"
    rows = [(f"r{i}", i % 4, None, f"c{i % 3}", f"i{i}" if i % 2 else None, f"c{i % 3}") for i in range(24)]
    registers = spark.createDataFrame([*rows, rows[1], ("x", None, None, "c1", None, "c1")], names)
    accounts = spark.createDataFrame([(f"a{i}", 10 + i % 2, 1, f"c{i % 3}", day) for i, day in enumerate([datetime(2000, 1, 1)] * 5)],
        "account_id string, account_type_id int, entry_kind int, entry_id string, will_close timestamp_ntz")
    accounts = accounts.withColumn("entry_kind", F.lit(account.rt.CONTRACT))
    links = spark.createDataFrame([(1, 10, 0), (2, 11, 0), (1, 11, 1), (7, 10, 0)], "register_type_id int, account_type_id int, priority int")
    targets = spark.createDataFrame([(t, 1, 5, 0) for t in range(4)], "register_type_id int, sub_type int, base_type_id int, level int")
    seen, assign = [], account.assign_accounts
    monkeypatch.setattr(account, "assign_accounts", lambda r, *a: seen.append(rows_of(r)) or assign(r, *a))
    found = account.register_accounts(registers, accounts, links, targets)
    assert {r[1] for r in seen[0]} == {1, 2} and len(seen[0]) == 13
    got = {(r["register_id"], r["account_id"]) for r in found.collect()}
    assert got == {(r[0], a) for r in rows for a in [{(1, "c0"): "a0", (1, "c1"): "a4", (1, "c2"): "a2", (2, "c0"): "a3", (2, "c1"): "a1"}.get((r[1], r[3]))] if a}


def test_unions_of_plain_columns_are_not_written(spark, few):
    """registers and accounts are read where they come from."""
    assert not {"register", "account", "base_account"} & set(standins.STAGED)
    assert any("orders.parquet" in f for f in StandIns(spark, few)["base_account"].inputFiles())


def test_slices_and_steps_are_written_small(spark, tmp_path):
    """what is written between steps and days is compressed with zstd, and reads back the same."""
    df = spark.range(50).selectExpr("id", "cast(id % 3 as string) as name")
    st = SliceStore(spark, str(tmp_path / "store"))
    st.replace(df, "loan", "A", D)
    step = session.cut(df)
    files = glob.glob(f"{tmp_path}/store/**/*.parquet", recursive=True) + step.inputFiles()
    assert len(files) > 1 and all(f.endswith(".zstd.parquet") for f in files)
    assert rows_of(st.read("loan", "A", D).select("id", "name")) == rows_of(step) == rows_of(df)


def test_late_files_are_merged_and_changed_ones_worked_out_again(spark, tmp_path, monkeypatch):
    """rows of files gained since are merged into the carried rows; the history is gone through again only where a file went or changed."""
    folder, names = str(tmp_path / "history"), ("rest_in", "rest_out", "over_in", "over_out")

    def add(*rows):
        df = spark.createDataFrame(rows, "register_id string, oper_day date, n long").select("register_id", "oper_day", *[F.col("n").cast("decimal(21,2)").alias(c) for c in names])
        df.withColumn("oper_month", F.date_format("oper_day", "yyyy-MM")).coalesce(1).write.mode("append").partitionBy("oper_month").parquet(folder)

    add(("a", date(1998, 1, 5), 1), ("b", date(1998, 2, 5), 2), ("c", date(1998, 3, 1), 3))
    balances = carried.CarriedBalances(SliceStore(spark, str(tmp_path / "store")), carried.History(spark, folder), "A")
    balances.advance(date(1998, 3, 10))
    again, history_of = [], carried.history_of
    monkeypatch.setattr(carried, "history_of", lambda *a: again.append(1) or history_of(*a))
    last = lambda day: {r["register_id"]: (r["oper_day"], int(r["rest_out"])) for r in balances.last(day).collect()}
    # Late rows older and newer than the carried one, of a new register, of the border month, and of a month that was not there.
    add(("a", date(1997, 5, 5), 4), ("a", date(1998, 2, 6), 5), ("c", date(1998, 2, 6), 6), ("d", date(1998, 3, 2), 7), ("b", date(1998, 3, 20), 8), (None, date(1998, 1, 1), 9))
    assert last(date(1998, 3, 10)) == {"a": (date(1998, 2, 6), 5), "b": (date(1998, 2, 5), 2), "c": (date(1998, 3, 1), 3), "d": (date(1998, 3, 2), 7), None: (date(1998, 1, 1), 9)}
    assert last(date(1998, 3, 31))["b"] == (date(1998, 3, 20), 8) and not again
    for f in glob.glob(f"{folder}/oper_month=1998-02/*.parquet"):
        os.remove(f)
    add(("a", date(1998, 2, 1), 10))
    assert last(date(1998, 3, 31)) == {"a": (date(1998, 2, 1), 10), "b": (date(1998, 3, 20), 8), "c": (date(1998, 3, 1), 3), "d": (date(1998, 3, 2), 7), None: (date(1998, 1, 1), 9)}
    assert again


def test_a_view_read_once_is_not_written(spark, few, monkeypatch):
    """neither the history nor the tranches behind the registers are written as tables for a query that goes through them once."""
    monkeypatch.setattr(StandIns, "_stage", lambda self, name, frame: pytest.fail(name))
    s = StandIns(spark, few)
    assert s.once("register").select("register_id").count() > 9 and s.once("register_rest").count() > 9


@pytest.fixture
def no_broadcast(spark):
    """Joins as on tables too large to be broadcast, with runtime filters from the first byte on."""
    scan = "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold"
    keep = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", scan)}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set(scan, "0")
    yield
    for k, v in keep.items():
        spark.conf.set(k, v)


def register_book(spark, folder):
    """Contracts (1 and 4 are lines, 6 has no type), their tranches, registers and balances; ids are missing, unknown or of another contract here and there."""
    days = [D - timedelta(days=n) for n in (3, 2, 0)] + [D + timedelta(days=1)]
    names = "register_id string, register_type_id int, contract_id string, issue_id string, portfolio_id string"
    registers = [(f"rc{i}", 1 + i % 3, f"c{i % 8}" if i % 7 else None, None, None) for i in range(24)]
    registers += [(f"ri{i}", 7 + i % 3, f"c{i % 8}" if i % 9 else f"c{(i + 1) % 8}", f"i{i}" if i % 11 else None, None) for i in range(40)]
    registers += [(f"rp{i}", 300, None, None, f"p{i % 4}") for i in range(6)] + [(None, 1, "c1", None, None), (None, 7, "c2", "i2", None), (None, 1, "c1", None, None)]
    rests = [(r[0], d, n + k) for n, r in enumerate(registers) if r[0] and n % 5 for k, d in enumerate(days) if (n + k) % 3]
    spark.createDataFrame(rests, "register_id string, oper_day date, n long").select(
        "register_id", "oper_day", *[(F.col("n") * m).cast("decimal(21,2)").alias(c) for m, c in enumerate(("rest_in", "rest_out", "over_in", "over_out"), 1)],
    ).write.parquet(f"{folder}/rests")
    src = {
        "register": spark.createDataFrame(registers, names),
        "issue": spark.createDataFrame([(f"i{i}", f"c{i % 8}") for i in range(36)], "issue_id string, contract_id string"),
        "contract": spark.createDataFrame([(f"c{i}", {1: 2, 4: 6, 6: None}.get(i, 1)) for i in range(8)], "contract_id string, contract_type int"),
        "register_rest": spark.read.parquet(f"{folder}/rests"),
    }
    entries = [(account.rt.CONTRACT, f"c{i}") for i in (0, 1, 2, 6)] + [(account.rt.TRANCHE, f"i{i}") for i in range(0, 36, 3)] + [(account.rt.PORTFOLIO, "p1"), (account.rt.CONTRACT, "i1"), (account.rt.TRANCHE, "c3")]
    targets = [(1, 0, 0, 1), (2, 0, 1, 2), (7, 1, 0, 7), (8, 1, 1, 8), (9, 1, 0, 9), (300, 2, 0, 300)]
    want = []
    for r, kind, c, i, p in registers:
        sub, level = {t: (s, v) for t, s, v, _ in targets}.get(kind, (None, None))
        of, kind_of = {f"i{n}": f"c{n % 8}" for n in range(36)}, {n: {1: 2, 4: 6, 6: None}.get(n, 1) for n in range(8)}
        if sub == 0 and i is None and c:
            key, row = (0, c), (r, kind, None, c, None, c)
        elif sub == 1 and level == 0 and i and of.get(i) == c and kind_of[int(c[1:])]:
            line = kind_of[int(c[1:])] in account.LINE_TYPES
            key, row = ((1, i) if line else (0, c)), (r, kind, None, c, i, i if line else c)
        elif sub == 2 and level == 0 and p:
            key, row = (2, p), (r, kind, p, None, None, p)
        else:
            continue
        if key in entries:
            last = max(((d, n) for k, d, n in rests if k == r and d <= D), default=None)
            want.append((*row, *([n * m if last else 0 for n in [last and last[1]] for m in ([1, 3, 4] if last and last[0] == D else [2, 0, 0])])))
    return src, spark.createDataFrame(entries, "entry_kind int, entry_id string"), spark.createDataFrame(targets, account.rt.TARGET_SCHEMA), sorted(want, key=str)


def listed_rows(df):
    return sorted((tuple(int(v) if n > 5 else v for n, v in enumerate(r)) for r in df.collect()), key=str)


def test_few_entries_cut_the_history_down(spark, tmp_path):
    src, entries, targets, want = register_book(spark, tmp_path)
    assert listed_rows(account.register_list(src, RunContext(D), entries, targets)) == want and {r[0][:2] for r in want if r[0]} == {"rc", "ri", "rp"}


def test_registers_of_many_entries_are_moved_once(spark, tmp_path, no_broadcast, monkeypatch):
    """with entries too many to be broadcast, a register's balances are reduced before they are moved, the registers are not written, and tranche registers meet their tranches once."""
    src, entries, targets, want = register_book(spark, tmp_path)
    monkeypatch.setattr(account, "cut", lambda df: pytest.fail("written"))
    found = account.register_list(src, RunContext(D), entries, targets)
    lines = found._jdf.queryExecution().executedPlan().toString().splitlines()
    scan = next(n for n, line in enumerate(lines) if "FileScan" in line and "oper_day" in line)
    above = [line for line in reversed(lines[:scan])]
    assert next(n for n, line in enumerate(above) if "partial_max_by" in line) < next(n for n, line in enumerate(above) if "Exchange" in line)
    assert listed_rows(found) == want
    twice = {**src, "register": src["register"].unionByName(src["register"].filter("register_id = 'rc1'"))}
    with pytest.raises(Exception, match="register list: repeated key register_id: rc1"):
        account.register_list(twice, RunContext(D), entries, targets).collect()


def test_only_the_columns_a_query_reads_are_written(spark, few, monkeypatch):
    """tranches are written without sums and schemes for a query that has no use for them; a table that is there whole is taken."""
    monkeypatch.setattr(StandIns, "_written", {})
    s = StandIns(spark, few)
    standins.narrow(s, "issue", "issue_id", "contract_id")
    assert s["issue"].columns == ["issue_id", "contract_id"]
    whole = StandIns(spark, few)["issue"]
    assert rows_of(s["issue"]) == rows_of(whole.select("issue_id", "contract_id"))
    again = StandIns(spark, few)
    standins.narrow(again, "issue", "issue_id")
    assert again["issue"].columns == whole.columns


def test_other_keys_stay_in_the_scan(spark, tmp_path, no_broadcast):
    """a history that meets a key set too large to be broadcast is filtered in its scan before the exact join; nulls and repeats change nothing."""
    spark.range(5000).selectExpr("cast(id % 900 as string) as k", "id as v").unionAll(spark.sql("select cast(null as string), 0L")).write.parquet(str(tmp_path / "hist"))
    hist = spark.read.parquet(str(tmp_path / "hist"))
    keys = spark.createDataFrame([("7",), ("7",), ("901",), (None,), ("8",)], "k string")
    found = asof.history_of(hist, keys, "k")
    assert "might_contain" in optimized(found) and found.columns == hist.columns
    assert rows_of(found) == rows_of(hist.filter("k in ('7', '8')"))


def test_a_scheme_rate_is_moved_by_its_ids(spark):
    """rates come per contract, by scheme; a contract that is there twice keeps the rate of each of its schemes."""
    header = spark.createDataFrame([("c1", "s1", 0), ("c1", "s2", 1), ("c1", "s1", 2), ("c2", None, 3), ("c3", "s9", 4), ("c4", "s3", 5), (None, "s1", 6)], "contract_id string, scheme_id string, n int")
    schemes = spark.createDataFrame([("s1", 1.0, 0.0), ("s2", 2.0, 0.0), ("s3", None, 0.0)], "scheme_id string, rate double, code double")
    rates = {r["contract_id"]: r["rates"] for r in loan._scheme_rates(header, schemes).collect()}
    assert rates == {"c1": {"s1": 1.0, "s2": 2.0}, "c4": {"s3": None}, None: {"s1": 1.0}}


def test_loans_write_no_table_they_read_for_some_contracts_only(spark, sf_dir, monkeypatch):
    """histories and tranches of which the loans take a part are cut out where they are built, and not written whole."""
    written, stage = [], StandIns._stage
    monkeypatch.setattr(StandIns, "_stage", lambda self, name, frame: written.append(name) or stage(self, name, frame))
    QUERIES["Q3_Q4_loans"](spark, sf_dir)
    assert not {n.split("-")[0] for n in written} & {"issue", "risk_change", "contract_sum", "portfolio_history"}
