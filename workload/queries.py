"""Registered queries: every operator and dataset on the stand-in frames."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from snapbook import RunContext, configure
from snapbook.functions import exprs
from snapbook.functions.intervals import account_window, closed_within, is_closed, opened, valid_on
from snapbook.operators import asof as ao, hierarchy, lookups, matching, numbering, pivoting
from snapbook.plans import (
    account, cession, client, corrections, dictionaries, guarantee, loan, pledge, portfolio, register_types as rt, routines,
    schedule,
)
from snapbook.session import cut, folder_exists, new_folder
from snapbook.sources import audit
from snapbook.sources.carried import CarriedBalances, History
from snapbook.sources.slices import DATED, SliceStore, StaleWriter
from snapbook.sources.tables import Sources, bucket_count, read_source, write_buckets
from workload.standins import EVENT_DAY, ORDER_DAY, StandIns, narrow

D = date.fromisoformat(ORDER_DAY)
E = date.fromisoformat(EVENT_DAY)
CTX = RunContext(D)
EVENT_CTX = RunContext(E)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles and flags as numbers, so that two engines print them alike."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double").alias(f.name)
        elif isinstance(f.dataType, T.BooleanType):
            c = c.cast("int").alias(f.name)
        out.append(c)
    return df.select(*out)


def query(name: str):
    def register(build: Callable[[StandIns], DataFrame]) -> Callable[[StandIns], DataFrame]:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return plain(build(StandIns(spark, sf_dir)))

        QUERIES[name] = run
        return build

    return register


def store(s: StandIns, label: str) -> SliceStore:
    """An empty slice store below the shared folder."""
    return SliceStore(s.spark, new_folder(s.spark, label))


def loan_frames(s: StandIns) -> StandIns:
    """Add the frames that hold facts computed by the loan system."""
    s["overdue"] = routines.overdue_start(s["overdue_balance"], D)
    for key in ("contract", "issue"):
        s[f"{key}_quality"] = routines.quality(s["risk_change"], s["risk_group"], f"{key}_id", D)
    return s


# --- sources and slices ------------------------------------------------------------------------------


@query("S1_scan")
def _(s):
    df = read_source(s.spark, "orders", s.sf_dir)
    return df.filter(F.col("o_orderdate") <= F.lit(D).cast("timestamp_ntz")).select("o_orderkey", "o_custkey", "o_orderstatus")


def _loan_days(s, label):
    """The loan slice published for two dates: everything, and contracts only."""
    st = store(s, label)
    st.replace(s["loan_slice"], "loan", "007", D)
    st.replace(s["loan_slice"].filter(F.col("main_contract_oid").isNull()), "loan", "007", date(1998, 6, 29))
    return st


@query("S2_read_slice")
def _(s):
    return _loan_days(s, "s2").read("loan", "007", D).select("oid", "client_oid", "number", "date1")


@query("S3_const_relation")
def _(s):
    names = F.broadcast(guarantee.status_map(s.spark))
    return s["guarantee_event"].join(names, F.col("guarant_status") == F.col("guarantee_status")).groupBy(
        "status_name", "base_status").agg(F.count(F.lit(1)).alias("events"))


@query("S4_replace_slice")
def _(s):
    st = _loan_days(s, "s4")
    st.replace(s["loan_slice"].filter(F.col("main_contract_oid").isNotNull()), "loan", "007", D)
    st.replace(s["loan_slice"].limit(0), "loan", "B", D)
    return st.read("loan").select("oid", "number", "source", "date1")


@query("S4_S8_versions")
def _(s):
    """What a reader sees that began before a replacement, and what is there after a second writer, begun before it too, was refused."""
    st = _loan_days(s, "s4v")
    before, began = st.read("loan", "007", D), st.version("loan", "007", D)
    lines = s["loan_slice"].filter(F.col("main_contract_oid").isNotNull())
    st.append_to([lines, lines.withColumn("oid", F.concat("oid", F.lit("+")))], "loan", "007", D)
    refused = 0
    try:
        st.replace(s["loan_slice"].withColumn("late", F.lit(1)), "loan", "007", D, since=began)
    except StaleWriter:
        refused = 1
    now = st.read("loan", "007", D).withColumn("seen", F.lit("after"))
    return before.withColumn("seen", F.lit("before")).unionByName(now).select("oid", "seen").withColumn("refused", F.lit(refused))


@query("S5_replace_objects")
def _(s):
    st = _loan_days(s, "s5")
    ids = s["base_contract"].filter(F.col("status") == 2).select(F.col("contract_id").alias("oid"))
    fresh = s["loan_slice"].join(ids, "oid", "left_semi").withColumn("number", F.concat("number", F.lit("*")))
    st.replace_matching(fresh, "loan", "007", D, "oid", ids)
    return st.read("loan", "007").select("oid", "number", "date1")


@query("S6_replace_dictionary")
def _(s):
    st = store(s, "s6")
    src = {"collateral_type": s["collateral_source"]}
    for _ in range(2):
        st.replace(dictionaries.pledge_type(src, RunContext(D, "A")), "pledge_type", "A")
    return st.read("pledge_type", "A").select("id", "description", "source")


@query("S7_delete_where")
def _(s):
    st = store(s, "s7")
    st.replace(s["base_contract"], "contract", "A", D)
    st.delete_where("contract", "A", D, F.col("currency") == "810")
    return st.read("contract", "A", D).select("contract_id", "currency")


@query("S8_append_second_set")
def _(s):
    st = store(s, "s8")
    parts = [
        s["base_contract"].select(F.col("contract_id").alias("oid"), "number"),
        s["issue"].select(F.col("issue_id").alias("oid"), F.col("issue_number").cast("string").alias("number")),
    ]
    st.append_to(parts, "loan", "A", D)
    return st.read("loan", "A", D).select("oid", "number")


def _many_days(s, label):
    st = store(s, label)
    for name in ("loan", "pledge", "account_type"):
        for day in (27, 28, 29, 30):
            rows = s["loan_slice"] if name == "loan" else s["guarantee_slice"]
            st.replace(rows, name, "A", date(1998, 6, day))
    return st


@query("S9_clear_slice")
def _(s):
    st = _many_days(s, "s9")
    st.clear(DATED, "A", D)
    return st.read("loan").groupBy("date1").agg(F.count(F.lit(1)).alias("row_count"))


@query("S10_clear_range")
def _(s):
    st = _many_days(s, "s10")
    st.clear_range(DATED, "A", date(1998, 6, 28), date(1998, 6, 29))
    st.clear_range(DATED, "A", date(1998, 6, 30), date(1998, 6, 27))
    names = [st.read(n).groupBy("date1").agg(F.count(F.lit(1)).alias("row_count")).withColumn("dataset", F.lit(n))
             for n in ("loan", "pledge", "account_type")]
    return names[0].unionByName(names[1]).unionByName(names[2])


@query("F1_clear_every_date")
def _(s):
    st = _many_days(s, "f1")
    st.clear(["loan"], "A", None)
    st.clear_range(["pledge"], "A", None, date(1998, 6, 28))
    names = [st.read(n).groupBy("date1").agg(F.count(F.lit(1)).alias("row_count")).withColumn("dataset", F.lit(n))
             for n in ("loan", "pledge", "account_type")]
    return names[0].unionByName(names[1]).unionByName(names[2])


@query("S11_slice_counts")
def _(s):
    return _many_days(s, "s11").counts(["loan", "pledge", "account_type"], "A", D)


@query("S12_config_value")
def _(s):
    return s["client"].select("oid", lookups.config_value(s["config9"], "InternalBankCode").alias("bank_code"))


@query("S13_default_id")
def _(s):
    fallback = lookups.default_id(s["product"], "name", loan.CONSUMER_LOAN, "product_id")
    df = s["contract"].join(s["product_type"], "product_type_id").join(s["loan_program"], "program_id", "left")
    return df.select("contract_id", F.coalesce("product_id", fallback).alias("product_id"))


@query("S14_append_audit")
def _(s):
    path = new_folder(s.spark, "s14")
    ok = F.col("status") == 1
    audit.append_audit(s["step"].filter(ok), path)
    audit.append_audit(s["step"].filter(~ok), path)
    return s.spark.read.parquet(path).groupBy("run_id").agg(F.count(F.lit(1)).alias("steps"), F.max("number").alias("last_number"))


@query("S14_S16_run_log")
def _(s):
    """The runs by halves, each appended twice, then the dates a year back dropped."""
    log = audit.RunLog(s.spark, new_folder(s.spark, "log"))
    half = F.crc32(F.col("run_id").cast("binary")) % 2 == 0
    for _ in range(2):
        log.append("even", s["run"].filter(half), s["step"].filter(half))
        log.append("odd", s["run"].filter(~half), s["step"].filter(~half))
    log.retain(12, date(2025, 1, 10))
    steps = log.steps().groupBy("run_id").agg(F.count(F.lit(1)).alias("steps"), F.max("number").alias("last_number"))
    return log.runs().join(steps, "run_id", "left").select("run_id", "for_date", "start", "steps", "last_number")


@query("S15_error_counts")
def _(s):
    return audit.error_counts(s["run"], s["step"])


@query("S16_retention")
def _(s):
    runs = audit.retain(s["run"], "for_date", 12, date(2025, 1, 10))
    return audit.retain_steps(s["step"], runs).groupBy("run_id").agg(F.count(F.lit(1)).alias("steps"))


@query("S17_entries_scan")
def _(s):
    return corrections.day_entries(s["entry"], D, 1, "loan-book").select("contract_id", "issue_id", "portfolio_id", "transaction_sum")


@query("S18_presence")
def _(s):
    gone = audit.missing(s["expected"].select("name"), s["found"], "name").withColumn("missing", F.lit(1))
    return audit.presence_report(s["expected"], s["found"], "name").join(gone, "name", "left").select(
        "name", "synonym", "present", F.coalesce("missing", F.lit(0)).alias("missing"))


# --- filters and projections -------------------------------------------------------------------------


@query("F1_F2_optional_filter")
def _(s):
    every = lookups.opt_filter(s["status_history"], "oper_day", None).groupBy("status").agg(F.count(F.lit(1)).alias("rows_all"))
    day = lookups.opt_filter(s["status_history"], "oper_day", D).groupBy("status").agg(F.count(F.lit(1)).alias("rows_day"))
    return every.join(day, "status", "left")


@query("F3_valid_interval")
def _(s):
    return s["base_contract"].filter(valid_on(F.col("contract_date"), F.col("closed_date"), D)).select("contract_id", "closed_date")


@query("F4_half_open_interval")
def _(s):
    return s["base_contract"].select(
        "contract_id", exprs.flag(opened(F.col("start_date"), F.col("closed_date"), D)).alias("is_opened"),
        exprs.flag(is_closed(F.col("closed_date"), D)).alias("is_closed"))


@query("F5_account_window")
def _(s):
    return s["base_account"].select(
        "base_account_id", exprs.flag(account_window(F.col("date_open"), F.col("date_close"), D, 0)).alias("open_now"),
        exprs.flag(account_window(F.col("date_open"), F.col("date_close"), D, 30)).alias("open_lately"))


@query("F6_closed_within")
def _(s):
    return s["base_contract"].select("contract_id", exprs.flag(closed_within(F.col("closed_date"), D, 30)).alias("lately"),
                                     exprs.flag(closed_within(F.col("closed_date"), D, 0)).alias("never"))


@query("F7_account_number")
def _(s):
    return s["base_account"].filter(exprs.valid_account_number(F.col("number"))).select("base_account_id", "number")


@query("F8_in_lists")
def _(s):
    df = s["contract"].join(s["base_contract"], "contract_id")
    return df.filter(F.col("contract_type").isin(*loan.LINE_TYPES) & ~F.col("status").isin(0, 3)).select("contract_id", "contract_type", "status")


@query("F9_like")
def _(s):
    df = s["register"].join(s["register_type"], "register_type_id")
    return df.filter(F.col("brief").like(rt.REPORTING_BRIEF)).groupBy("brief").agg(F.count(F.lit(1)).alias("registers"))


@query("F10_J5_J6_exists")
def _(s):
    with_account = s["account"].filter(F.col("contract_id").isNotNull())
    kept = lookups.keep_existing(s["contract"], with_account, "contract_id").select("contract_id", F.lit("with").alias("side"))
    return kept.unionByName(lookups.drop_existing(s["contract"], with_account, "contract_id").select("contract_id", F.lit("without").alias("side")))


@query("F11_not_in")
def _(s):
    return lookups.drop_existing(s["contract"], s["issue"], "contract_id").select("contract_id", "contract_type")


@query("F12_registers_with_history")
def _(s):
    known = s["register_rest"].filter(F.col("oper_day") <= CTX.day)
    return lookups.keep_existing(s["register"], known, "register_id").select("register_id", "register_type_id")


@query("F13_portfolios_with_accounts")
def _(s):
    return lookups.keep_existing(s["portfolio"], portfolio.open_portfolio_accounts(s, CTX), "portfolio_id").select("portfolio_id")


@query("F14_drop_missing_keys")
def _(s):
    return s["schedule"].filter(F.col("date_payment").isNotNull()).groupBy("owner").agg(F.count(F.lit(1)).alias("payments"))


@query("F15_inner_by_filter")
def _(s):
    begun = s["portfolio_back_type"].filter(F.col("begin_date") <= CTX.day)
    return s["portfolio"].join(begun, "back_type_id").select("portfolio_id", "name")


@query("F16_final_exclusions")
def _(s):
    excluded = (rt.DROPPED_TARGET, account.UNPUBLISHED_REGISTER, cession.LIMIT_REGISTER)
    return s["register"].filter(~F.col("register_type_id").isin(*excluded)).groupBy("register_type_id").agg(F.count(F.lit(1)).alias("registers"))


@query("P1_expression_blocks")
def _(s):
    df = s["issue"].withColumns({"close_or_plan": F.coalesce("close_date", "plan_repayment_date")})
    return df.select("issue_id", "close_or_plan", exprs.flag(F.col("close_or_plan") < CTX.day).alias("is_end"),
                     exprs.flag(valid_on(F.col("issue_date"), F.col("close_date"), D)).alias("is_active"))


@query("P2_Q11_type_links")
def _(s):
    links = rt.type_links(s, rt.target_types(s))
    used = s["register"].groupBy("register_type_id").agg(F.count(F.lit(1)).alias("registers"))
    return links.join(used, "register_type_id", "left").select("register_type_id", "account_type_id", "priority", "registers")


# --- joins -------------------------------------------------------------------------------------------


@query("J1_inner_join")
def _(s):
    df = s["contract"].join(s["base_contract"], "contract_id").join(s["loan_contract"], "contract_id")
    return df.groupBy("portfolio_id", "contract_type").agg(F.count(F.lit(1)).alias("contracts"))


@query("J1_J10_colocated_tables")
def _(s):
    """Registers and their history in buckets by register, joined and reduced where they are."""
    root, names = new_folder(s.spark, "buckets"), ("register", "register_rest")
    buckets = bucket_count(*[s[name] for name in names])
    for name in names:
        write_buckets(s[name], root, name, "register_id", buckets)
    src = Sources(s.spark, root)
    return ao.opening_balance(src["register"].select("register_id"), src["register_rest"], D)


@query("J2_left_lookup")
def _(s):
    df = lookups.attach(s["contract"], s["loan_purpose"], {"purpose_id": "purpose_id"}, {"name": "purpose"}, spread_nulls_by="contract_id")
    return df.select("contract_id", "purpose")


@query("J3_left_join_filtered")
def _(s):
    active = s["pledge"].filter(F.col("pledge_status") == pledge.ACTIVE_PLEDGE)
    return s["pledge_link"].select("contract_id", "pledge_contract_id").distinct().join(
        active.select("pledge_contract_id", "pledge_id"), "pledge_contract_id", "left")


@query("J4_coalesced_key")
def _(s):
    df = s["loan_slice"].withColumn("contract_id", F.coalesce("main_contract_oid", "oid")).join(s["contract"], "contract_id")
    return df.groupBy("contract_id").agg(F.count(F.lit(1)).alias("slice_rows"))


@query("J7_asof_portfolio")
def _(s):
    df = ao.asof_latest(s["contract"].join(s["loan_contract"], "contract_id").withColumnRenamed("portfolio_id", "current_portfolio"),
                        s["portfolio_history"], "contract_id", "date_begin", D, {"portfolio_id": "history_portfolio"}, ties=("portfolio_id",))
    return df.select("contract_id", F.coalesce("history_portfolio", "current_portfolio").alias("portfolio_id"))


@query("J8_asof_two_orders")
def _(s):
    return ao.asof_latest(s["contract"].select("contract_id"), s["status_history"], "contract_id", "oper_day", D,
                          {"status": "status", "oper_day": "oper_day"}, ties=("date_change", "seq"))


@query("J9_Q2_replanned_dates")
def _(s):
    return loan.replanned_dates(s, CTX)


@query("J10_E17_opening_balance")
def _(s):
    return ao.opening_balance(s["register"].select("register_id"), s["register_rest"], D)


@query("J7_J10_carried_balances")
def _(s):
    """Carried from March to June over a history by month that gets late rows of earlier years in between."""
    folder, late = new_folder(s.spark, "history"), (F.col("oper_day") < F.lit(date(1997, 6, 1))) & (F.crc32(F.col("register_id").cast("binary")) % 40 == 0)
    # The balances are worked out once and written by month, the late ones apart until they are due.
    month = lambda df: df.withColumn("oper_month", F.date_format("oper_day", "yyyy-MM")).repartition("oper_month").write.option("compression", "zstd")
    month(s.once("register_rest").filter(late.isNotNull()).withColumn("side", F.when(late, "late").otherwise("known"))).partitionBy("side", "oper_month").parquet(folder)
    known, due = f"{folder}/side=known", f"{folder}/side=late"
    carried = CarriedBalances(store(s, "carried"), History(s.spark, known), "A")
    carried.advance(date(1998, 3, 31))
    if folder_exists(s.spark, due):
        month(s.spark.read.parquet(due).drop("oper_month")).mode("append").partitionBy("oper_month").parquet(known)
    return carried.opening_balance(s.once("register").select("register_id"), D)


@query("J7_S10_days_of_a_month")
def _(s):
    days = [date(1998, 6, d) for d in range(1, 31)]
    found = ao.opening_balances(s["register"].select("register_id", "register_type_id"), s["register_rest"].select(
        "register_id", "oper_day", "rest_in", "rest_out", "over_in", "over_out"), days)
    return found.groupBy("day", "register_type_id").agg(
        F.count(F.lit(1)).alias("registers"), *[F.sum(c).cast(exprs.WIDE_MONEY).alias(c) for c in ("rest", "over_in", "over_out")])


@query("J11_asof_through_join")
def _(s):
    return guarantee.last_revisions(s, CTX).select("contract_id", "history_id", "base_status", "change_type")


@query("J12_fanout_lookup")
def _(s):
    df = s["portfolio"].join(portfolio.back_office(s), "back_type_id", "left")
    return df.select("portfolio_id", "division_code", "branch_code")


@query("J13_U4_attach_overdue")
def _(s):
    overdue = routines.overdue_start(s["overdue_balance"], D)
    return lookups.attach(s["contract"].select("contract_id"), overdue, {"contract_id": "contract_id"},
                          {"principal_from": "principal_from", "interest_from": "interest_from"})


@query("J14_lateral_aggregate")
def _(s):
    facts = loan._issue_facts(s, s["contract"], routines.scheme_facts(s["scheme_value"], D))
    return s["contract"].select("contract_id").join(facts, "contract_id", "left").select(
        "contract_id", "date_issue", exprs.flag(F.col("code") > 0).alias("is_floating"))


@query("J15_disjunctive_join")
def _(s):
    found = matching.match_any(s["register"], s["account"], account.OWNERS, "register_id", "account_id")
    return found.withColumnsRenamed({"partners": "accounts", "first_partner": "first_account"})


def _entries(s):
    return rt.target_types(s), account.account_entries(s, CTX, s["loan_slice"], s["guarantee_slice"])


def _account_parts(s):
    targets, entries = _entries(s)
    return targets, entries, account.register_rows(s, CTX, entries, targets), account.account_list(s, CTX, entries)


def _pairs(s):
    targets, _, registers, accounts = _account_parts(s)
    return account.register_accounts(registers, accounts, rt.type_links(s, targets), targets)


@query("J16_Q12_forward_match")
def _(s):
    return _pairs(s).select("register_id", "account_id", "account_type_id", "sub_type", "base_type_id", "level")


@query("J17_prefer_row")
def _(s):
    rows = matching.owner_rows(s["account"], account.OWNERS, ["account_id"])
    return matching.prefer(rows, "account_id", [F.col("owner_kind").desc(), F.col("owner_id").desc()])


@query("J18_Q13_backward_pass")
def _(s):
    return account.published_pairs(_pairs(s)).select("register_id", "account_id", "is_external")


@query("J19_children")
def _(s):
    return cession.cession_operations(s, EVENT_CTX).select("operation_id", "parent_id", "contract_id", "level", "type_id", "oper_date")


@query("J20_parents")
def _(s):
    base = s["register"].groupBy("register_type_id").agg(F.count(F.lit(1)).alias("n")).join(
        s["account_register_link"], "register_type_id").select("register_type_id", "account_type_id", F.lit(0).alias("priority"))
    return hierarchy.expand_parents(base, s["register_type_link"])


@query("J21_chain_latest")
def _(s):
    return hierarchy.chain_latest(s["pledge_series"], D)


@query("J22_update_from")
def _(s):
    ref = s["customer"].join(s["division"], "division_id").select("customer_id", F.col("branch_id").cast("smallint").alias("branch"))
    return lookups.update_from(s["client"], ref, {"oid": "customer_id"}, {"branch": "branch_code"}).select("oid", "branch_code")


@query("J23_G3_max_id_per_code")
def _(s):
    return lookups.max_id_per_code(s["collateral_source"], "code", "collateral_type_id")


@query("J24_bounded_left_join")
def _(s):
    known = s["register_rest"].filter(F.col("oper_day") <= CTX.day).groupBy("register_id").agg(F.count(F.lit(1)).alias("days"))
    return s["register"].select("register_id").join(known, "register_id", "left").select("register_id", F.coalesce("days", F.lit(0)).alias("days"))


# --- aggregates, windows, sets -----------------------------------------------------------------------


@query("G1_G2_min_dates")
def _(s):
    first = s["issue"].groupBy("contract_id").agg(F.min("issue_date").alias("first_issue"))
    change = s["agreement_history"].filter((F.col("change_type") == 4) & (F.col("change_date") > CTX.day)).groupBy("contract_id").agg(
        F.min("change_date").alias("next_change"))
    return first.join(change, "contract_id", "left")


@query("G4_W3_Q22_last_runs")
def _(s):
    return audit.last_runs(s["run"], s["step"])


@query("G5_sum_of_products")
def _(s):
    return routines.floating_code(s["scheme_value"]).select("scheme_id", F.col("code").cast("decimal(20,4)").alias("code"))


@query("G6_grouped_sums")
def _(s):
    sums = ("over_in", "over_out", "rest_out")
    # Sums of each register first, so its history is not moved row by row to meet the register.
    each = s["register_rest"].groupBy("register_id").agg(*[F.sum(c).alias(c) for c in sums])
    return each.join(s["register"], "register_id").groupBy("register_type_id", "contract_id", "issue_id", "portfolio_id").agg(
        *[F.sum(c).cast(exprs.WIDE_MONEY).alias(c) for c in sums])


@query("G7_G8_counts_having")
def _(s):
    df = s["register_rest"].filter(F.col("oper_day") <= CTX.day).groupBy("register_id").agg(F.count("rest_out").alias("n"))
    return df.filter(F.col("n") > 1)


@query("G9_distinct")
def _(s):
    return s["pledge_link"].select("contract_id", "pledge_contract_id").distinct()


@query("G10_Q7_pivot")
def _(s):
    return portfolio.portfolio_account_columns(s, CTX)


@query("W1_O1_first_per_key")
def _(s):
    return ao.first_per(s["operation"], "contract_id", [F.col("oper_date").desc(), F.col("oper_sum").desc(), F.col("operation_id").desc()]).select(
        "contract_id", "operation_id", "oper_date")


@query("W2_O3_numbered_rows")
def _(s):
    rows = s["entry"].select("contract_oid", "tranche_oid", "sum_rub", "payment_purpose", "acc_number_credit", "date1")
    order = [F.col(c).asc_nulls_first() for c in rows.columns]
    return numbering.number_rows(rows, order, "idx").select("idx", "contract_oid", "sum_rub")


@query("O2_sorted_read")
def _(s):
    return s["schedule"].filter(F.col("date_payment").isNotNull()).select("date_payment", "owner_id", "debt_main").orderBy("date_payment", "owner_id")


@query("X1_union_all")
def _(s):
    rows = cut(corrections.day_entries(s["entry"], D, 1, "loan-book"))
    a = lookups.keep_few_existing(rows, s["contract"], "contract_id")
    b = lookups.keep_few_existing(rows, s["portfolio"], "portfolio_id")
    return a.unionByName(b).select("contract_id", "issue_id", "portfolio_id", "transaction_sum")


@query("X3_accumulating_inserts")
def _(s):
    """Contracts with a tranche, then with an agreement change, then all: what the table holds, from which part, and how many rows it turned away."""
    pick = lambda df, n: df.filter(F.col("contract_id").isNotNull()).select("contract_id").withColumn("origin", F.lit(n))
    parts = [pick(s["issue"], "issue"), pick(s["agreement_history"], "change"), pick(s["contract"], "contract")]
    held, turned = lookups.accumulate(parts, "contract_id")
    return held.join(turned, "contract_id", "left").select("contract_id", "origin", "kept_part", F.coalesce("rejected_rows", F.lit(0)).alias("rejected_rows"))


@query("J12_checked_and_fanned_out")
def _(s):
    """A lookup in a frame checked to have each key once, beside one in a frame that may have several rows per key."""
    df = lookups.attach(s["contract"].select("contract_id", "purpose_id"), s["loan_purpose"], {"purpose_id": "purpose_id"}, {"name": "purpose"}, once="loan_purpose")
    return lookups.attach(df, s["issue"], {"contract_id": "contract_id"}, {"issue_id": "issue_id"})


@query("X2_exclusive_union")
def _(s):
    df = pledge.security_list(s, CTX, s["loan_slice"])
    pledged = F.col("pledge_id").isNotNull()
    return df.select("contract_id", "security_id", F.when(pledged, F.lit("pledge")).otherwise(F.lit("surety")).alias("kind"),
                     F.when(pledged, F.col("object_quality")).otherwise(F.col("surety_quality")).alias("quality"))


# --- scalar expressions ------------------------------------------------------------------------------


@query("E1_E3_E4_E15_E23_contract_flags")
def _(s):
    df = s["contract"].join(s["base_contract"], "contract_id")
    return df.select(
        "contract_id", F.coalesce("schedule_type", F.lit(15)).alias("schedule_type"),
        exprs.flag(F.col("contract_type") == 6).alias("is_over"), exprs.line_kind(F.col("contract_type")).alias("cline_type"),
        exprs.currency(F.col("currency")).alias("curr"), exprs.currency(F.col("currency"), default=False).alias("curr_raw"),
        exprs.repayment_reason(F.col("status"), F.col("contract_type") == 3).alias("reason"),
        exprs.freeze_status(F.col("branch_id")).alias("letter"))


@query("E2_E5_E11_entry_fields")
def _(s):
    return s["entry"].select(
        "contract_oid", exprs.blank_to_null(F.col("tranche_oid")).alias("issue_id"),
        exprs.account_symbol(F.col("acc_number_debet")).alias("symbol"),
        F.col("sum_rub").cast("int").alias("whole"), F.expr("try_cast(tranche_oid as int)").alias("not_a_number"))


@query("E6_E7_E8_dates")
def _(s):
    return s["base_contract"].select(
        "contract_id", F.date_add("contract_date", 45).alias("plus_days"), F.add_months("contract_date", -12).alias("year_back"),
        F.datediff("end_date", "contract_date").alias("days"), F.coalesce("closed_date", CTX.day).alias("closed_or_today"))


@query("E8_default_date")
def _(s):
    """A run without a given date: the clock is asked once, whatever it says later."""
    days = iter([D, E])
    ctx = RunContext.today(clock=lambda: next(days), source="clock")
    return s["base_contract"].select("contract_id", ctx.day.alias("day"), F.datediff(ctx.day, "contract_date").alias("age"),
                                     exprs.flag(is_closed(F.col("closed_date"), ctx.asof)).alias("is_closed"))


@query("E10_E12_E13_names")
def _(s):
    df = s["base_contract"].join(s["customer"], F.col("client_id") == F.col("customer_id"), "left")
    return df.select(
        "contract_id", exprs.with_customer(F.concat(F.lit("Счет "), F.col("number")), F.col("name")).alias("title"),
        exprs.portfolio_name(F.col("currency"), F.lower("number")).alias("capital"),
        F.length(F.rtrim("name")).alias("name_length"))


@query("E16_E21_signed_balances")
def _(s):
    df = s["register_rest"].withColumn("active", F.dayofmonth("oper_day") <= 15)
    return df.select(
        "register_id", "oper_day", exprs.signed_rest(F.col("active"), F.col("rest_out")).alias("ik_val"),
        exprs.signed_debit(F.col("active"), F.col("over_in"), F.col("over_out")).alias("dk_val"),
        exprs.signed_credit(F.col("active"), F.col("over_in"), F.col("over_out")).alias("ck_val"))


@query("E18_Q1_eligible_contracts")
def _(s):
    return loan.eligible_contracts(s, CTX)


@query("E19_status_map")
def _(s):
    m = F.broadcast(guarantee.status_map(s.spark).select("guarantee_status", "base_status"))
    df = s["guarantee_event"].join(m, F.col("guarant_status") == F.col("guarantee_status"), "left")
    return df.groupBy("guarant_status", "base_status").agg(F.count(F.lit(1)).alias("events"))


@query("E20_collateral_value")
def _(s):
    df = s["pledge"].join(pledge.base_pledge_values(s, CTX), "pledge_id", "left")
    return df.select("pledge_id", exprs.collateral_value(
        F.col("fair_value"), F.lit(7).cast("decimal(21,2)"), F.col("subsequent"), F.lit(None).cast("decimal(21,2)"),
        F.col("collateral_value"), F.col("basic_state_date"), F.col("base_collateral"), D).cast("decimal(21,2)").alias("value"))


@query("E22_E24_keys_and_codes")
def _(s):
    df = s["register"].withColumn("external", F.col("register_type_id").isin(113, 114))
    return df.select(
        "register_id", exprs.stable_key(F.col("register_id"), F.col("register_type_id").cast("string")).alias("row_key"),
        exprs.register_code(F.col("register_type_id"), F.col("external")).alias("account_type"))


# --- facts of the loan system ------------------------------------------------------------------------


@query("U1_division_code")
def _(s):
    return s["base_contract"].join(routines.division_code(s["division"]), "division_id", "left").select("contract_id", "division_code")


@query("U2_fact_end")
def _(s):
    return routines.fact_end(s)


@query("U3_contract_sum")
def _(s):
    return routines.contract_sum(s["contract_sum"], D)


@query("U5_contract_quality")
def _(s):
    return routines.quality(s["risk_change"], s["risk_group"], "contract_id", D)


@query("U6_issue_quality")
def _(s):
    return routines.quality(s["risk_change"], s["risk_group"], "issue_id", D)


@query("U7_scheme_rate")
def _(s):
    return routines.scheme_rate(s["scheme_value"], D)


@query("U8_register_rest")
def _(s):
    return routines.register_rest(s["register"], s["register_rest"], guarantee.UNUSED_LIMIT_REGISTER, D)


@query("U9_schedules_by_owner")
def _(s):
    return s["schedule"].groupBy("owner", "owner_id").agg(F.count("date_payment").alias("payments"), F.sum("debt_main").cast(exprs.WIDE_MONEY).alias("debt_main"))


@query("U10_mirror_id")
def _(s):
    return s["register"].select("register_id", exprs.mirror_id(F.col("register_id")).alias("mirror"))


@query("U11_pledge_series")
def _(s):
    return routines.pledge_series(s["pledge_chain"])


@query("U11_J21_cycles")
def _(s):
    """Some chains of eight closed into a cycle of six, with two pledges that lead into it."""
    number = F.substring("pledge_id", 2, 20).cast("long")
    closed = F.concat(F.lit("p"), (number + 5).cast("string"))
    links = s["pledge_chain"].withColumn("prev_pledge_id", F.when(number % 40 == 0, closed).otherwise(F.col("prev_pledge_id")))
    series, cycles = routines.pledge_chains(links)
    none = F.lit(None)
    return series.select("pledge_id", "base_id", "level", none.cast("long").alias("cycle_length"), none.cast("boolean").alias("on_cycle")).unionByName(
        cycles.select("pledge_id", "base_id", none.cast("int").alias("level"), "cycle_length", "on_cycle"))


@query("U12_client_rows")
def _(s):
    return s["client"].select(*[F.col(c) for c in client.CLIENT_COLUMNS if c != "branch_code"])


# --- datasets ----------------------------------------------------------------------------------------


@query("Q3_Q4_loans")
def _(s):
    # Each of these is gone through for the contracts or tranches at hand only, which are cut out of it where it is built.
    for name in ("portfolio_history", "contract_sum", "risk_change", "issue", "account"):
        s[name] = s.once(name)
    return loan.loan_snapshot(loan_frames(s), CTX)


@query("Q5_guarantees")
def _(s):
    return guarantee.guarantee_snapshot(loan_frames(s), CTX)


@query("Q6_portfolios")
def _(s):
    return portfolio.portfolio_snapshot(s, CTX)


@query("Q8_account_entries")
def _(s):
    return account.account_entries(s, CTX, s["loan_slice"], s["guarantee_slice"])


@query("Q8_account_entries_lookback")
def _(s):
    return account.account_entries(s, RunContext(D, depth_days=30), s["loan_slice"], s["guarantee_slice"])


@query("Q9_register_list")
def _(s):
    narrow(s, "issue", "issue_id", "contract_id", "issue_number", "issue_date")
    targets, entries = _entries(s)
    return account.register_list(s, CTX, entries, targets)


@query("Q10_account_list")
def _(s):
    return _account_parts(s)[3]


@query("Q14_accounts")
def _(s):
    narrow(s, "issue", "issue_id", "contract_id", "issue_number", "issue_date", "close_date")
    return account.account_snapshot(s, CTX, s["loan_slice"], s["guarantee_slice"])


@query("Q15_disposal_accounts")
def _(s):
    return cession.disposal_rows(s, EVENT_CTX)


@query("Q16_schedules")
def _(s):
    return schedule.schedule_snapshot(s, CTX, s["loan_slice"])


@query("Q17_clients_by_division")
def _(s):
    return client.client_snapshot(s, CTX)


@query("Q17_clients_as_supplied")
def _(s):
    s["config"] = s["config12"]
    return client.client_snapshot(s, CTX)


@query("Q18_pledges")
def _(s):
    return pledge.pledge_snapshot(s, CTX, s["loan_slice"])


@query("Q18_pledges_waterfall")
def _(s):
    s["config"] = s["config12"]
    return pledge.pledge_snapshot(s, CTX, s["loan_slice"])


@query("Q19_table_dictionaries")
def _(s):
    s["collateral_type"] = s["collateral_source"]
    kinds = dictionaries.account_type(s, CTX).select(F.lit("account_type").alias("dataset"), F.col("oid").alias("id"), "name")
    loans = dictionaries.loan_type(s, CTX).select(F.lit("loan_type").alias("dataset"), "id", "name")
    products = dictionaries.loan_product(s, CTX).select(F.lit("loan_product").alias("dataset"), "id", "name")
    pledges = dictionaries.pledge_type(s, CTX).select(F.lit("pledge_type").alias("dataset"), "id", F.col("description").alias("name"))
    return kinds.unionByName(loans).unionByName(products).unionByName(pledges)


@query("Q20_constant_dictionaries")
def _(s):
    """How many contracts use each value of the fixed dictionaries."""
    schedule_use = s["contract"].select(F.lit("schedule_type").alias("dataset"), F.coalesce("schedule_type", F.lit(15)).alias("id"))
    guarantee_use = s["contract"].filter(F.col("kind") == 2).select(F.lit("guarantee_type").alias("dataset"), F.col("guarant_type").alias("id"))
    segment_use = s["legal_person"].select(F.lit("segment").alias("dataset"), F.col("criterion").alias("id"))
    yul_use = s["legal_person"].select(F.lit("yul_segment").alias("dataset"), F.col("criterion").alias("id"))
    used = schedule_use.unionByName(guarantee_use).unionByName(segment_use).unionByName(yul_use).groupBy("dataset", "id").agg(
        F.count(F.lit(1)).alias("uses"))
    sp = s.spark
    names = (
        dictionaries.schedule_type(sp, CTX).select(F.lit("schedule_type").alias("dataset"), F.col("oid").alias("id"), F.col("description").alias("name"))
        .unionByName(dictionaries.guarantee_type(sp, CTX).select(F.lit("guarantee_type").alias("dataset"), "id", F.col("description").alias("name")))
        .unionByName(dictionaries.segment(sp, CTX).select(F.lit("segment").alias("dataset"), "id", "name"))
        .unionByName(dictionaries.yul_segment(sp, CTX).select(F.lit("yul_segment").alias("dataset"), "id", "name"))
    )
    return names.join(used, ["dataset", "id"], "left").select("dataset", "id", "name", F.coalesce("uses", F.lit(0)).alias("uses"))


@query("Q21_corrections")
def _(s):
    return corrections.corrections(s["entry"], s["contract"], s["portfolio"], D, 1, "loan-book")


@query("Q21_rejected_entries")
def _(s):
    """Entries whose ids do not have the id format (letter, digits and dashes)."""
    return corrections.rejected_ids(s["entry"], "^[ci][0-9-]+$").select("contract_oid", "portfolio_oid", "date1")


@query("Q23_step_audit")
def _(s):
    counts = s["step"].groupBy("target").agg(F.count(F.lit(1)).alias("row_count"))
    return audit.step_audit(s["raw_step"], counts)


@query("Q24_presence_report")
def _(s):
    return audit.presence_report(s["expected"].filter(F.col("synonym").like("brand%")), s["found"], "name")


@query("Q25_clear_store")
def _(s):
    st = _many_days(s, "q25")
    st.clear(DATED, "A", date(1998, 6, 27))
    st.clear_range(DATED, "A", date(1998, 6, 29), date(1998, 7, 5))
    parts = [st.read(n).select(F.lit(n).alias("dataset"), "oid", "date1") for n in ("loan", "pledge", "account_type")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("dataset", "date1").agg(F.countDistinct("oid").alias("objects"))
