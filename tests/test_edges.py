"""Edge rules on hand-made frames."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from snapbook import RunContext
from snapbook.functions import exprs
from snapbook.functions.intervals import account_window, closed_within, is_closed, opened, valid_on
from snapbook.operators import asof, hierarchy, lookups, matching, numbering
from snapbook.plans import account, cession, corrections, loan, register_types as rt, routines
from snapbook.sources import audit

D = date(1998, 6, 30)
CTX = RunContext(D)


def day(text):
    return None if text is None else date.fromisoformat("1998-" + text)


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


RESTS = "register_id string, oper_day date, rest_in decimal(21,2), rest_out decimal(21,2), over_in decimal(21,2), over_out decimal(21,2)"


def test_balance_of_the_day_before_and_after(spark):
    rests = spark.createDataFrame(
        [("a", day("06-29"), 0, 5, 5, 0), ("a", D, 5, 9, 6, 2), ("b", day("06-01"), 0, 7, 7, 0), ("c", day("07-01"), 0, 3, 3, 0)],
        "register_id string, oper_day date, rest_in int, rest_out int, over_in int, over_out int",
    ).selectExpr("register_id", "oper_day", *[f"cast({c} as decimal(21,2)) as {c}" for c in ("rest_in", "rest_out", "over_in", "over_out")])
    registers = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "register_id string")
    out = asof.opening_balance(registers, rests, D)
    assert [tuple(map(str, r)) for r in rows(out, "register_id", "rest", "over_in", "over_out")] == [
        ("a", "5.00", "6.00", "2.00"), ("b", "7.00", "0.00", "0.00"), ("c", "0.00", "0.00", "0.00"), ("d", "0.00", "0.00", "0.00")]


def test_same_day_status_takes_the_later_change(spark):
    hist = spark.createDataFrame([("c", D, 1, 10, 0), ("c", D, 2, 20, 0)], "contract_id string, oper_day date, date_change int, status int, seq int")
    out = asof.latest(hist, "contract_id", "oper_day", D, ties=("date_change", "seq"))
    assert out.first().status == 20


def test_strict_lookup_excludes_the_day(spark):
    hist = spark.createDataFrame([("c", day("06-29"), 1), ("c", D, 2)], "k string, eff date, v int")
    assert asof.latest(hist, "k", "eff", D, strict=True).first().v == 1
    assert asof.latest(hist, "k", "eff", None).first().v == 2


def test_next_change_keeps_ties(spark):
    hist = spark.createDataFrame([("c", day("07-02"), 1), ("c", day("07-02"), 2), ("c", day("07-03"), 3), ("c", D, 0)], "k string, eff date, v int")
    assert rows(asof.asof_next(hist, "k", "eff", D), "v") == [(1,), (2,)]


def test_closed_on_before_and_after_the_date(spark):
    df = spark.createDataFrame(
        [("on", day("01-01"), D), ("before", day("01-01"), day("06-29")), ("after", day("01-01"), day("07-01")), ("open", day("01-01"), None),
         ("nostart", None, None)], "id string, start date, closed date")
    out = {r.id: tuple(r)[1:] for r in df.select(
        "id", valid_on(F.col("start"), F.col("closed"), D).alias("v"), opened(F.col("start"), F.col("closed"), D).alias("o"),
        is_closed(F.col("closed"), D).alias("c"), closed_within(F.col("closed"), D, 3).alias("w"), closed_within(F.col("closed"), D, 0).alias("w0")).collect()}
    assert out["on"] == (True, False, True, False, False)
    assert out["before"] == (False, False, True, True, False)
    assert out["after"] == (True, True, False, False, False)
    assert out["open"] == (True, True, False, False, False)
    assert out["nostart"][1] is False


def test_account_window_with_time_of_day(spark):
    df = spark.createDataFrame(
        [(1, datetime(1998, 6, 30, 23, 59), None), (2, datetime(1998, 7, 1), None), (3, datetime(1998, 1, 1), datetime(1998, 6, 30, 0, 1)),
         (4, datetime(1998, 1, 1), datetime(1998, 6, 29, 23, 0))], "id int, o timestamp_ntz, c timestamp_ntz")
    now = df.filter(account_window(F.col("o"), F.col("c"), D, 0))
    lately = df.filter(account_window(F.col("o"), F.col("c"), D, 1))
    assert rows(now, "id") == [(1,), (3,)] and rows(lately, "id") == [(1,), (3,), (4,)]


def test_account_numbers(spark):
    df = spark.createDataFrame([(1, None), (2, "1" * 19), (3, "A" + "1" * 19), (4, "1" * 20), (5, " " + "1" * 20)], "id int, n string")
    assert rows(df.filter(exprs.valid_account_number(F.col("n"))), "id") == [(1,), (4,)]


def test_unknown_predicate_keeps_the_row_on_names(spark):
    df = spark.createDataFrame([("N", " x "), ("N", None), (None, "x")], "n string, c string")
    assert [r[0] for r in df.select(exprs.with_customer(F.col("n"), F.col("c"))).collect()] == ["N (x)", "N", None]


def test_update_overwrites_with_null_only_where_matched(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    ref = spark.createDataFrame([("a", None)], "k string, v int")
    assert rows(lookups.update_from(df, ref, {"k": "k"}, {"v": "v"}), "k", "v") == [("a", None), ("b", 2)]


def _match(spark, registers, accounts, links, targets):
    reg = spark.createDataFrame(registers, "register_id string, register_type_id int, portfolio_id string, contract_id string, issue_id string, contract_oid string")
    acc = spark.createDataFrame(accounts, "account_id string, account_type_id int, entry_kind int, entry_id string, will_close timestamp_ntz")
    lnk = spark.createDataFrame(links, "register_type_id int, account_type_id int, priority int")
    tgt = spark.createDataFrame(targets, rt.TARGET_SCHEMA)
    return account.register_accounts(reg, acc, lnk, tgt)


OPEN = datetime(3000, 1, 1)
SOON = datetime(1999, 1, 1)


def test_open_account_wins_at_equal_priority(spark):
    pairs = _match(spark, [("r", 7, None, "c", "i", "c")], [("a1", 1, 0, "c", SOON), ("a2", 1, 1, "i", OPEN), ("a3", 2, 0, "c", OPEN)],
                   [(7, 1, 0), (7, 2, 10)], [(7, 1, 0, 7)])
    assert rows(pairs, "register_id", "account_id", "level") == [("r", "a2", 0)]


def test_contract_register_yields_to_the_tranche_register(spark):
    pairs = _match(spark, [("rc", 5, None, "c", None, "c"), ("ri", 7, None, "c", "i", "i")], [("a", 1, 0, "c", OPEN)],
                   [(5, 1, 1), (7, 1, 0)], [(5, 0, 1, 7), (7, 1, 0, 7)])
    assert rows(account.published_pairs(pairs), "register_id", "account_id", "is_external") == [("ri", "a", 0)]


def test_direct_link_beats_the_override_and_adds_an_external_row(spark):
    pairs = _match(spark, [("r", 113, None, "c", None, "c")], [("own", 10060, 0, "c", OPEN), ("res", 10050, 0, "c", OPEN)],
                   [(113, 10060, 0), (113, 10050, 5)], [(113, 0, 0, 113)])
    assert rows(account.published_pairs(pairs), "register_id", "account_id", "is_external") == [("r", "own", 0), ("r", "res", 1)]


def test_override_and_two_rounds_of_parents(spark):
    links = spark.createDataFrame([(1, 9, 0)], "register_type_id int, account_type_id int, priority int")
    edges = spark.createDataFrame([(2, 1), (3, 2), (4, 3)], "parent_id int, child_id int")
    assert rows(hierarchy.expand_parents(links, edges), "register_type_id", "priority") == [(1, 0), (2, 10), (3, 20)]


def test_chain_roots_of_long_chains_and_cycles(spark):
    n = 100
    links = spark.createDataFrame([(f"p{i}", None if i == 0 else f"p{i - 1}") for i in range(n)] + [("q1", "gone")], "pledge_id string, prev string")
    out = {r.pledge_id: (r.root, r.level) for r in hierarchy.chain_roots(links, "pledge_id", "prev").collect()}
    assert out["p0"] == ("p0", 0) and out["p99"] == ("p0", 99) and out["p64"] == ("p0", 64) and out["q1"] == ("gone", 1)
    loop = spark.createDataFrame([("a", "b"), ("b", "a")], "pledge_id string, prev string")
    with pytest.raises(ValueError):
        hierarchy.chain_roots(loop, "pledge_id", "prev")


def test_correction_with_contract_and_portfolio_appears_twice(spark):
    entries = spark.createDataFrame(
        [("c1", "", "p1", "t", D, "1" * 13 + "70601" + "00", "2" * 20, "x", "s", 1), ("c9", "i", "", "t", D, None, None, "y", "s", 1),
         ("c1", None, None, "t", D, "1" * 20, "2" * 20, "z", "s", 2)],
        "contract_oid string, tranche_oid string, portfolio_oid string, operation_type string, date1 date, acc_number_debet string, "
        "acc_number_credit string, payment_purpose string, source string, branch_code int").withColumn("sum_rub", F.lit(1).cast("decimal(31,2)"))
    contracts = spark.createDataFrame([("c1",)], "contract_id string")
    portfolios = spark.createDataFrame([("p1",)], "portfolio_id string")
    out = corrections.corrections(entries, contracts, portfolios, D, 1, "s")
    assert rows(out, "idx", "contract_id", "portfolio_id", "issue_id", "symbol_debet") == [(1, "c1", "p1", None, "70601")] * 2
    assert corrections.rejected_ids(entries, "^[a-z][0-9]+$").count() == 1


def test_waterfall(spark):
    d = lambda v: None if v is None else F.lit(v).cast("decimal(21,2)")
    null = F.lit(None).cast("decimal(21,2)")
    df = spark.range(1)
    value = lambda fair, link, sub, ass, own, basic, base: float(df.select(exprs.collateral_value(
        d(fair) if fair is not None else null, d(link) if link is not None else null, F.lit(sub).cast("int"), d(ass) if ass is not None else null,
        d(own) if own is not None else null, F.lit(basic).cast("date"), d(base) if base is not None else null, D)).first()[0])
    assert value(5, 8, 0, 1, 2, None, None) == 8
    assert value(0, 8, 0, 1, 2, None, None) == 1
    assert value(None, 8, 0, None, 2, None, None) == 2
    assert value(0, 8, 1, 1, 2, "1998-07-01", 3) == 3
    assert value(0, 8, 1, 1, 2, "1998-06-30", 3) == 0
    assert value(0, 8, None, 1, 2, None, 3) == 0


def test_overdue_run_starts_after_the_last_zero(spark):
    data = [("c", "principal", day("06-01"), 5), ("c", "principal", day("06-10"), 0), ("c", "principal", day("06-20"), 3), ("c", "principal", day("06-25"), 4),
            ("c", "interest", day("06-02"), 1), ("d", "principal", day("06-20"), 2), ("d", "principal", D, 0)]
    bal = spark.createDataFrame(data, "contract_id string, part string, oper_day date, rest_out int")
    assert rows(routines.overdue_start(bal, D), "contract_id", "principal_from", "interest_from") == [("c", day("06-20"), day("06-02"))]


def test_disposal_sums_multiply_movements_by_transactions(spark):
    """Two transactions and two movements of one operation make four combinations."""
    sd = spark.createDataFrame
    src = {
        "operation": sd([("o", None, "c", "i", 88, D, 1, 1), ("k", "o", "c", "i", 2, D, 1, 1), ("z", "k", "c", "i", 2, D, 1, 0)],
                        "operation_id string, parent_id string, contract_id string, issue_id string, type_id int, oper_date date, oper_sum int, status int"),
        "transaction": sd([("o", "a"), ("o", "a"), ("k", "other")], "operation_id string, debit_account_id string"),
        "movement": sd([("m1", "o", "r1"), ("m2", "o", "r2"), ("m3", "k", "r1")], "movement_id string, operation_id string, register_id string"),
        "register": sd([("r1", 7), ("r2", 8), ("r3", 2)], "register_id string, register_type_id int"),
        "account": sd([("a", "b", 10019), ("other", "b", 1)], "account_id string, base_account_id string, account_type_id int"),
        "register_rest": sd([("r1", day("06-01"), 0, 10, 1, 2), ("r2", D, 4, 9, 5, 0)],
                            "register_id string, oper_day date, rest_in int, rest_out int, over_in int, over_out int"),
    }
    out = cession.disposal_sums(src, CTX)
    assert [tuple(map(str, r)) for r in rows(out, "account_id", "contract_id", "rest", "over_in", "over_out")] == [("a", "c", "28.00", "12.00", "4.00")]


def test_log_rules(spark):
    runs = spark.createDataFrame([("a", date(2024, 1, 9)), ("b", date(2024, 1, 10)), ("c", date(2024, 1, 11))], "run_id string, for_date date")
    assert rows(audit.retain(runs, "for_date", 12, date(2025, 1, 10)), "run_id") == [("c",)]
    heads = spark.createDataFrame([("a", D, 1), ("b", D, 2), ("c", D, 2)], "run_id string, for_date date, start int")
    cols = {c: F.lit(None).cast("string") for c in ("number", "target", "duration", "status", "record_count", "error_number", "error_proc", "error_message")}
    steps = spark.createDataFrame([("s1", "a", 5), ("s2", "b", 6), ("s3", "c", 7)], "step_id string, run_id string, start int").withColumns(cols)
    assert rows(audit.last_runs(heads, steps), "step_id", "run_id") == [("s2", "b"), ("s3", "c")]


def test_context_needs_a_date():
    with pytest.raises(ValueError):
        RunContext(None)


def test_chains_are_not_broadcast(spark, monkeypatch):
    plans, cut = [], hierarchy.cut
    monkeypatch.setattr(hierarchy, "cut", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or cut(df))
    rows = [("a", None), ("b", "a"), ("c", "b"), ("x", "y"), ("y", "z"), ("z", "x"), ("w", "x")]
    roots, cycles = hierarchy.resolve_chains(spark.createDataFrame(rows, "node string, prev string"), "node", "prev")
    assert {(r["node"], r["root"], r["level"]) for r in roots.collect()} == {("a", "a", 0), ("b", "a", 1), ("c", "a", 2)}
    assert {(r["node"], r["base_id"], r["cycle_length"], r["on_cycle"]) for r in cycles.collect()} == {
        ("x", "x", 3, True), ("y", "x", 3, True), ("z", "x", 3, True), ("w", "x", 3, False)}
    assert any("SortMergeJoin" in p for p in plans) and not any("BroadcastHashJoin" in p for p in plans)
