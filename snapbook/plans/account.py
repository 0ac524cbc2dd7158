"""Accounts of registers: entries, registers with balances, accounts, and the assignment between them."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from snapbook.context import RunContext
from snapbook.functions import exprs
from snapbook.functions.intervals import account_window, closed_within
from snapbook.operators.asof import history_of, latest, opening_balance, without_balance
from snapbook.operators.lookups import accumulate, attach, opt_filter, unique
from snapbook.operators.matching import (
    assign_accounts, best_accounts, class_representative, owner_rows, prefer,
)
from snapbook.plans import register_types as rt
from snapbook.plans.loan import LINE_TYPES, shape
from snapbook.plans.portfolio import back_office
from snapbook.session import broadcast_size, cut

Frames = Mapping[str, DataFrame]

# Registers that never make a closed contract reportable, by short name.
LIMIT_BRIEFS = (
    "Гарант", "Лим", "НеиспЛим", "Обесп", "ОбеспРез", "БГарант", "РезервБГарант", "ЛимБГарант", "НеисЛимБГарант",
)
# Account type allowed on plain loans only; plain loan contract type; register type left out.
PLAIN_LOAN_ACCOUNT = 10143
PLAIN_LOAN = 1
UNPUBLISHED_REGISTER = 38
NEVER_CLOSED = "3000-01-01"

OWNERS = {rt.CONTRACT: "contract_id", rt.TRANCHE: "issue_id", rt.PORTFOLIO: "portfolio_id"}

# The published columns.
ACCOUNT_COLUMNS = {
    "branch_code": "int",
    "oid": "string",
    "number": "string",
    "name": "string",
    "number_balance": "string",
    "contract_oid": "string",
    "client_oid": "string",
    "ik_val": "decimal(31,2)",
    "dk_val": "decimal(31,2)",
    "ck_val": "decimal(31,2)",
    "curr": "string",
    "account_type": "string",
    "is_registr": "int",
    "portfolio_oid": "string",
    "disposal_val": "decimal(31,2)",
}

# What a pair carries on; all but the account follow from the register.
PAIR_COLUMNS = ["register_id", "account_id", "register_type_id", "contract_oid", "portfolio_id"]

ENTRY_COLUMNS = ["entry_kind", "entry_id", "client_id", "branch_code", "entry_name", "contract_type"]


def _closed_entries(src: Frames, ctx: RunContext) -> list[DataFrame]:
    """Contracts and tranches closed within the look-back that still have a balance on a register."""
    contracts = (
        src["contract"].filter(F.col("kind") == 0).select("contract_id", "contract_type")
        .join(src["base_contract"].filter(~F.col("status").isin(0, 3)).select(
            "contract_id", "client_id", "branch_id", "number", "closed_date"), "contract_id")
    )
    contracts = attach(contracts, src["branch"], {"branch_id": "branch_id"}, {"inner_code": "inner_code"}, spread_nulls_by="contract_id", once="branch")
    contracts = contracts.withColumn("branch_code", exprs.code_or_zero(F.col("inner_code")))
    by_contract = contracts.filter(closed_within(F.col("closed_date"), ctx.asof, ctx.depth_days))
    by_issue = (
        src["issue"].filter(closed_within(F.col("close_date"), ctx.asof, ctx.depth_days))
        .select("issue_id", "contract_id", "issue_number").join(contracts, "contract_id")
    )
    by_contract, by_issue = cut(by_contract), cut(by_issue)
    registers = src["register"].select("register_id", "register_type_id", "contract_id", "issue_id")
    plain = (
        registers.filter(F.col("issue_id").isNull()).join(by_contract.select("contract_id"), "contract_id", "left_semi")
        .join(src["register_type"].filter(~F.col("brief").isin(*LIMIT_BRIEFS)).select("register_type_id"), "register_type_id")
    )
    issued = registers.join(by_issue.select("issue_id"), "issue_id", "left_semi")
    # Only the few registers of lately closed objects look up their balance.
    own = ["register_id", "contract_id", "issue_id"]
    candidates = cut(plain.select(*own).unionByName(issued.select(*own)))
    rests = history_of(src["register_rest"].select("register_id", "oper_day", "rest_out"), candidates, "register_id")
    funded = latest(rests, "register_id", "oper_day", ctx.asof, ties=("rest_out",)).filter(F.col("rest_out") > 0)
    kept = candidates.join(funded.select("register_id"), "register_id", "left_semi")
    by_contract = by_contract.join(kept.filter(F.col("issue_id").isNull()).select("contract_id").distinct(), "contract_id", "left_semi")
    by_issue = by_issue.join(kept.filter(F.col("issue_id").isNotNull()).select("issue_id").distinct(), "issue_id", "left_semi")
    return [
        by_contract.select(
            F.lit(rt.CONTRACT).alias("entry_kind"), F.col("contract_id").alias("entry_id"), "client_id", "branch_code",
            F.col("number").alias("entry_name"), "contract_type",
        ),
        by_issue.select(
            F.lit(rt.TRANCHE).alias("entry_kind"), F.col("issue_id").alias("entry_id"), "client_id", "branch_code",
            exprs.tranche_name(F.col("number"), F.col("issue_number")).alias("entry_name"), "contract_type",
        ),
    ]


def account_entries(src: Frames, ctx: RunContext, loans: DataFrame, guarantees: DataFrame) -> DataFrame:
    """What accounts are looked up for: contracts, tranches and portfolios of the day. An entry that one of these parts has twice fails the job.

    ``loans`` and ``guarantees`` are the slices published for the same date and source.
    """
    pick = ["oid", "client_oid", "branch_code", "number"]
    published = loans.select(*pick).unionByName(guarantees.select(*pick))
    contract = opt_filter(src["contract"].select("contract_id", "contract_type"), "contract_id", ctx.object_id)
    by_contract = published.join(contract, published.oid == contract.contract_id).select(
        F.lit(rt.CONTRACT).alias("entry_kind"), F.col("oid").alias("entry_id"), F.col("client_oid").alias("client_id"),
        "branch_code", F.col("number").alias("entry_name"), "contract_type",
    )
    issue = opt_filter(src["issue"].select("issue_id", "contract_id", "issue_number"), "contract_id", ctx.object_id)
    by_issue = (
        loans.select("oid", "client_oid", "branch_code").join(issue, F.col("oid") == issue.issue_id)
        .join(src["base_contract"].select("contract_id", F.col("number").alias("contract_number")), "contract_id")
        .join(src["contract"].select("contract_id", "contract_type"), "contract_id")
        .select(
            F.lit(rt.TRANCHE).alias("entry_kind"), F.col("oid").alias("entry_id"), F.col("client_oid").alias("client_id"),
            "branch_code", exprs.tranche_name(F.col("contract_number"), F.col("issue_number")).alias("entry_name"),
            "contract_type",
        )
    )
    begun = src["portfolio_back_type"].filter(F.col("begin_date") <= ctx.day).select("back_type_id", "name")
    offices = back_office(src).groupBy("back_type_id").agg(F.min("branch_code").alias("branch_code"))
    by_portfolio = (
        src["portfolio"].select("portfolio_id", "back_type_id").join(begun, "back_type_id").join(offices, "back_type_id", "left")
        .select(
            F.lit(rt.PORTFOLIO).alias("entry_kind"), F.col("portfolio_id").alias("entry_id"),
            F.lit(None).cast("string").alias("client_id"), F.coalesce("branch_code", F.lit(0)).alias("branch_code"),
            F.col("name").alias("entry_name"), F.lit(None).cast("int").alias("contract_type"),
        )
    )
    parts, names = [by_contract, by_issue, by_portfolio], ["published contracts", "published tranches", "portfolios"]
    if ctx.depth_days > 0:
        # A contract can be published and lately closed at once; it is listed as published.
        parts += _closed_entries(src, ctx)
        names += ["lately closed contracts", "lately closed tranches"]
    return accumulate(parts, ["entry_kind", "entry_id"], names)[0].select(*ENTRY_COLUMNS)


def listed_registers(src: Frames, ctx: RunContext, entries: DataFrame, targets: DataFrame) -> DataFrame:
    """Registers of the entries with their owner ids, not yet checked to be there once.

    A register belongs to exactly one entry: a contract register to its contract, a tranche register to
    its tranche when the contract is a line and to the contract otherwise, a portfolio register to its
    portfolio. The entry of a tranche register depends on its tranche alone, so tranches meet the entries first, by
    their contract and then by their own id, and registers are moved to what is left of them only once.
    """
    types = targets.groupBy("register_type_id", "sub_type").agg(F.min("level").alias("level"))
    registers = src["register"].join(types, "register_type_id").filter(
        ((F.col("sub_type") == rt.CONTRACT) & F.col("issue_id").isNull() & F.col("contract_id").isNotNull())
        | ((F.col("sub_type") == rt.TRANCHE) & (F.col("level") == 0) & F.col("issue_id").isNotNull())
        | ((F.col("sub_type") == rt.PORTFOLIO) & (F.col("level") == 0) & F.col("portfolio_id").isNotNull())
    )
    listed = lambda kind, name, mark: entries.filter(F.col("entry_kind") == kind).select(F.col("entry_id").alias(name)).distinct().withColumn(mark, F.lit(True))
    line = F.col("contract_type").isin(*LINE_TYPES)
    issues = (
        src["issue"].select("issue_id", "contract_id")
        .join(src["contract"].select("contract_id", "contract_type"), "contract_id")
        .select("issue_id", F.col("contract_id").alias("_issue_contract"), line.alias("is_line"))
        .filter(F.col("is_line").isNotNull())
        .join(listed(rt.CONTRACT, "_issue_contract", "_by_contract"), "_issue_contract", "left")
        .filter(F.col("is_line") | F.col("_by_contract"))
        .join(listed(rt.TRANCHE, "issue_id", "_by_issue"), "issue_id", "left")
        .filter(~F.col("is_line") | F.col("_by_issue"))
    )
    own = registers.filter(F.col("sub_type") != rt.TRANCHE).select(
        "register_id", "register_type_id",
        F.when(F.col("sub_type") == rt.PORTFOLIO, F.col("portfolio_id")).alias("portfolio_id"),
        F.when(F.col("sub_type") == rt.CONTRACT, F.col("contract_id")).alias("contract_id"),
        F.lit(None).cast("string").alias("issue_id"),
        F.col("sub_type").alias("entry_kind"),
        F.when(F.col("sub_type") == rt.PORTFOLIO, F.col("portfolio_id")).otherwise(F.col("contract_id")).alias("entry_id"),
    ).join(entries.select("entry_kind", "entry_id"), ["entry_kind", "entry_id"], "left_semi")
    tranche = (
        registers.filter(F.col("sub_type") == rt.TRANCHE).select("register_id", "register_type_id", "contract_id", "issue_id")
        .join(issues, "issue_id").filter(F.col("contract_id") == F.col("_issue_contract"))
        .select(
            "register_id", "register_type_id", F.lit(None).cast("string").alias("portfolio_id"), "contract_id", "issue_id",
            F.when(F.col("is_line"), F.col("issue_id")).otherwise(F.col("contract_id")).alias("contract_oid"),
        )
    )
    return own.withColumn("contract_oid", F.col("entry_id")).drop("entry_kind", "entry_id").unionByName(tranche)


def register_rows(src: Frames, ctx: RunContext, entries: DataFrame, targets: DataFrame) -> DataFrame:
    """Registers of the entries with their owner ids. A register listed twice fails the job."""
    return unique(listed_registers(src, ctx, entries, targets), "register_id", "register list")


def register_list(src: Frames, ctx: RunContext, entries: DataFrame, targets: DataFrame) -> DataFrame:
    """Registers of the entries with opening rest and day turnovers.

    Registers of few entries cut the history down in its scan. Where the entries are too many to be broadcast, that cut would move every
    balance and the keys beside it, so each register's balances are reduced in the scan and meet the register
    where it was checked to be there once.
    """
    if broadcast_size(entries):
        registers = cut(register_rows(src, ctx, entries, targets))
        return opening_balance(registers, history_of(src["register_rest"], registers, "register_id"), ctx.asof)
    rows, known = listed_registers(src, ctx, entries, targets), F.col("register_id").isNotNull()
    listed = opening_balance(unique(rows.filter(known), "register_id", "register list", keyless=False), src["register_rest"], ctx.asof)
    return listed.unionByName(without_balance(rows.filter(~known)))


def account_list(src: Frames, ctx: RunContext, entries: DataFrame) -> DataFrame:
    """Open accounts of the entries with a usable number, one row per account and entry."""
    depth = max(ctx.depth_days, 0)
    base = src["base_account"].filter(account_window(F.col("date_open"), F.col("date_close"), ctx.asof, depth)).select(
        "base_account_id", "number", "currency", "date_close"
    ).filter(exprs.valid_account_number(F.col("number")))
    kinds = src["account_type"].select("account_type_id", exprs.flag(F.col("kind") == 1).alias("is_active"))
    accounts = src["account"].join(base, "base_account_id").join(kinds, "account_type_id")
    # A portfolio account is one without contract and tranche.
    only_portfolio = F.col("contract_id").isNull() & F.col("issue_id").isNull()
    accounts = accounts.withColumn("portfolio_id", F.when(only_portfolio, F.col("portfolio_id")))
    owned = owner_rows(accounts, OWNERS, ["account_id", "account_type_id", "number", "currency", "date_close", "is_active"])
    rows = owned.withColumnsRenamed({"owner_kind": "entry_kind", "owner_id": "entry_id"}).join(
        entries.select(*ENTRY_COLUMNS), ["entry_kind", "entry_id"]
    )
    portfolio_open = F.col("date_close").isNull() | (F.col("date_close") >= ctx.day.cast("timestamp_ntz"))
    misplaced = (
        (F.col("account_type_id") == PLAIN_LOAN_ACCOUNT) & (F.col("entry_kind") == rt.CONTRACT)
        & ~F.col("contract_type").eqNullSafe(PLAIN_LOAN)
    )
    return rows.filter((F.col("entry_kind") != rt.PORTFOLIO) | portfolio_open).filter(
        ~F.coalesce(misplaced, F.lit(False))
    ).select(
        "account_id", "account_type_id", "number", "is_active", "entry_kind", "entry_id", "client_id", "branch_code",
        "entry_name", exprs.currency(F.col("currency")).alias("currency"),
        F.coalesce(F.col("date_close"), F.lit(NEVER_CLOSED).cast("timestamp_ntz")).alias("will_close"),
    )


def register_accounts(registers: DataFrame, accounts: DataFrame, links: DataFrame, targets: DataFrame) -> DataFrame:
    """Forward pass: the account of every register, and its reserve account as a further pair.

    Adds account_id, account_type_id, sub_type, base_type_id and level to the register columns.
    """
    choices = best_accounts(
        accounts.select(F.col("entry_kind").alias("owner_kind"), F.col("entry_id").alias("owner_id"),
                        "account_type_id", "will_close", "account_id"),
        links, rt.RESERVE_ACCOUNT_TYPE,
    )
    # A register whose type has no linked account type finds none: it goes before it is moved to its owners.
    linked = registers.join(links.select("register_type_id").distinct(), "register_type_id", "left_semi").select(*registers.columns)
    pairs = assign_accounts(linked, choices, OWNERS).join(targets, "register_type_id")
    own = [*registers.columns, "sub_type", "base_type_id"]
    direct = F.struct(F.col("direct_id").alias("account_id"), F.col("direct_type").alias("account_type_id"), "level")
    special = F.struct(
        F.col("special_id").alias("account_id"), F.lit(rt.RESERVE_ACCOUNT_TYPE).alias("account_type_id"),
        F.lit(1).alias("level"),
    )
    return pairs.select(*own, F.inline(F.array(direct, special))).filter(F.col("account_id").isNotNull())


def published_pairs(pairs: DataFrame) -> DataFrame:
    """Backward pass: one pair per equivalence class, plus the external reserve pairs."""
    members = class_representative(
        pairs, "sub_type", OWNERS, "base_type_id", "level", PAIR_COLUMNS
    ).withColumn("is_external", F.lit(0))
    external = (
        pairs.filter(F.col("base_type_id").isin(*rt.AWARDED_PENALTY_REGISTERS) & (F.col("account_type_id") == rt.RESERVE_ACCOUNT_TYPE))
        .select(*PAIR_COLUMNS).distinct().withColumn("is_external", F.lit(1))
    )
    return members.unionByName(external)


def account_rows(src: Frames, ctx: RunContext, pairs: DataFrame, accounts: DataFrame) -> DataFrame:
    """Published rows of the assigned registers; only these look up their balance."""
    details = prefer(accounts, "account_id", [F.col("entry_kind").desc(), F.col("entry_id").desc()])
    published = cut(pairs.filter(F.col("register_type_id") != UNPUBLISHED_REGISTER))
    # The history is cut down to these registers in its scan, before it is reduced.
    rests = history_of(src["register_rest"], published, "register_id")
    df = (
        opening_balance(published, rests, ctx.asof)
        .join(details.drop("account_type_id"), "account_id")
        .join(src["register_type"].select("register_type_id", F.col("name").alias("register_name")), "register_type_id")
    )
    df = attach(df, src["customer"], {"client_id": "customer_id"}, {"name": "customer_name"}, spread_nulls_by="register_id", once="customer")
    active = F.col("is_active") == 1
    external = F.col("is_external") == 1
    title = F.concat(F.col("register_name"), F.lit(" "), F.col("entry_name"))
    return shape(
        df.withColumns(
            {
                "oid": F.when(external, exprs.mirror_id(F.col("register_id"))).otherwise(F.col("register_id")),
                "name": exprs.with_customer(title, F.col("customer_name")),
                "number_balance": F.col("number"),
                "contract_oid": F.when(F.col("entry_kind") != rt.PORTFOLIO, F.col("contract_oid")),
                "client_oid": F.col("client_id"),
                "ik_val": exprs.signed_rest(active, F.col("rest")),
                "dk_val": exprs.signed_debit(active, F.col("over_in"), F.col("over_out")),
                "ck_val": exprs.signed_credit(active, F.col("over_in"), F.col("over_out")),
                "curr": F.col("currency"),
                "account_type": exprs.register_code(F.col("register_type_id"), external),
                "is_registr": F.lit(1),
                "portfolio_oid": F.col("portfolio_id"),
            }
        ),
        ctx,
        ACCOUNT_COLUMNS,
    )


def account_snapshot(src: Frames, ctx: RunContext, loans: DataFrame, guarantees: DataFrame) -> DataFrame:
    """Register accounts of the day. Disposal accounts are a second part of the same slice.

    Entries, accounts and pairs each feed two later steps with different columns, which rules out exchange
    reuse; they are narrow, so each is written to the shared folder once.
    """
    targets = rt.target_types(src)
    entries = account_entries(src, ctx, loans, guarantees)
    registers = register_rows(src, ctx, entries, targets)
    accounts = cut(account_list(src, ctx, entries))
    pairs = cut(register_accounts(registers, accounts, rt.type_links(src, targets), targets))
    return account_rows(src, ctx, published_pairs(pairs), accounts)
