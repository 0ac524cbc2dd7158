"""Disposal accounts of assigned loans."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from snapbook.context import RunContext
from snapbook.functions import exprs
from snapbook.operators.asof import history_of, latest_by_day
from snapbook.operators.hierarchy import expand_children
from snapbook.operators.lookups import attach
from snapbook.plans.account import ACCOUNT_COLUMNS
from snapbook.plans.loan import CESSION_OPERATION, shape
from snapbook.session import cut

Frames = Mapping[str, DataFrame]

# Disposal account type; register of the unused limit, which is left out.
DISPOSAL_ACCOUNT = 10019
LIMIT_REGISTER = 2


def disposal_accounts(src: Frames) -> DataFrame:
    """Accounts of the disposal type with number, currency and sign."""
    kinds = src["account_type"].filter(F.col("account_type_id") == DISPOSAL_ACCOUNT).select(
        "account_type_id", F.col("name").alias("type_name"), exprs.flag(F.col("kind") == 1).alias("is_active")
    )
    return (
        src["account"].filter(F.col("account_type_id") == DISPOSAL_ACCOUNT)
        .select("account_id", "base_account_id", "account_type_id")
        .join(kinds, "account_type_id")
        .join(src["base_account"].select("base_account_id", "number", "currency"), "base_account_id")
        .withColumn("currency", exprs.currency(F.col("currency")))
    )


def cession_operations(src: Frames, ctx: RunContext) -> DataFrame:
    """Cessions of the day and two levels of their successful child operations."""
    done = src["operation"].filter(F.col("status") == 1).select(
        "operation_id", "parent_id", "contract_id", "issue_id", "type_id", "oper_date", "oper_sum"
    )
    roots = done.filter((F.col("type_id") == CESSION_OPERATION) & (F.col("oper_date") == ctx.day))
    return expand_children(roots, done, depth=2)


def disposal_targets(src: Frames, operations: DataFrame) -> DataFrame:
    """Transactions of the given operations that debit a disposal account, counted per operation and account."""
    accounts = src["account"].filter(F.col("account_type_id") == DISPOSAL_ACCOUNT).select(F.col("account_id").alias("debit_account_id"))
    return history_of(src["transaction"], operations, "operation_id").join(accounts, "debit_account_id").groupBy(
        "operation_id", F.col("debit_account_id").alias("account_id")
    ).agg(F.count(F.lit(1)).alias("times"))


def register_movements(src: Frames, ctx: RunContext, operations: DataFrame) -> DataFrame:
    """Opening rest and turnovers of the moved registers, summed per operation.

    A register counts once per movement, as often as the operation moved it.
    """
    moved = (
        history_of(src["movement"], operations, "operation_id")
        .groupBy("operation_id", "register_id").agg(F.count(F.lit(1)).alias("moves"))
        .join(src["register"].filter(F.col("register_type_id") != LIMIT_REGISTER).select("register_id"), "register_id")
    )
    # A day's cessions move few registers, so the balance history is cut down to those before anything else.
    moved = cut(moved)
    rests = src["register_rest"].select("register_id", "oper_day", "rest_in", "rest_out", "over_in", "over_out")
    last = latest_by_day(history_of(rests, moved, "register_id"), "register_id", "oper_day", ctx.asof)
    rest = exprs.opening_rest(F.col("oper_day"), ctx.asof, F.col("rest_in"), F.col("rest_out"))
    joined = moved.join(last, "register_id", "left").select(
        "operation_id", "moves", rest.alias("rest"),
        F.coalesce("over_in", F.lit(0)).cast(exprs.MONEY).alias("over_in"),
        F.coalesce("over_out", F.lit(0)).cast(exprs.MONEY).alias("over_out"),
    )
    total = lambda c: F.sum((F.col("moves").cast("decimal(10,0)") * F.col(c)).cast(exprs.WIDE_MONEY)).cast(exprs.WIDE_MONEY).alias(c)
    return joined.groupBy("operation_id").agg(total("rest"), total("over_in"), total("over_out"))


def disposal_sums(src: Frames, ctx: RunContext) -> DataFrame:
    """Signed balances per disposal account, contract and operation date.

    Every (transaction, movement) combination of an operation counts. The combinations are not built:
    the register sums of the operation are multiplied by the number of its transactions on the account.
    """
    # From the day's operations outward: their transactions are counted once, then their movements.
    tree = cut(cession_operations(src, ctx))
    targets = cut(disposal_targets(src, tree))
    relevant = tree.join(targets.select("operation_id").distinct(), "operation_id", "left_semi")
    # An operation may be listed on two levels; each listing counts.
    listed = relevant.groupBy("operation_id", "contract_id", "oper_date").agg(F.count(F.lit(1)).alias("listings"))
    listed = cut(listed)
    movements = register_movements(src, ctx, listed)
    joined = (
        listed.join(targets, "operation_id").join(movements, "operation_id")
        .withColumn("weight", (F.col("listings") * F.col("times")).cast("decimal(10,0)"))
    )
    weighted = lambda c: F.sum((F.col("weight") * F.col(c)).cast(exprs.WIDE_MONEY)).cast(exprs.WIDE_MONEY).alias(c)
    return joined.groupBy("account_id", "contract_id", "oper_date").agg(
        weighted("rest"), weighted("over_in"), weighted("over_out")
    )


def disposal_rows(src: Frames, ctx: RunContext) -> DataFrame:
    """Published disposal account rows."""
    df = disposal_sums(src, ctx).join(disposal_accounts(src), "account_id")
    base = src["base_contract"].select("contract_id", F.col("number").alias("contract_number"), "client_id", "branch_id")
    df = df.join(base, "contract_id").join(src["loan_contract"].select("contract_id", "portfolio_id"), "contract_id")
    df = attach(df, src["branch"], {"branch_id": "branch_id"}, {"inner_code": "inner_code"}, spread_nulls_by="account_id", once="branch")
    df = attach(df, src["customer"], {"client_id": "customer_id"}, {"name": "customer_name"}, spread_nulls_by="account_id", once="customer")
    active = F.col("is_active") == 1
    money = exprs.WIDE_MONEY
    title = F.concat(F.col("type_name"), F.lit(" "), F.col("contract_number"))
    return shape(
        df.withColumns(
            {
                "branch_code": exprs.code_or_zero(F.col("inner_code")),
                "oid": F.col("account_id"),
                "name": exprs.with_customer(title, F.col("customer_name"), opening="("),
                "number_balance": F.col("number"),
                "contract_oid": F.col("contract_id"),
                "client_oid": F.col("client_id"),
                "ik_val": exprs.signed_rest(active, F.col("rest"), money),
                "dk_val": exprs.signed_debit(active, F.col("over_in"), F.col("over_out"), money),
                "ck_val": exprs.signed_credit(active, F.col("over_in"), F.col("over_out"), money),
                "curr": F.col("currency"),
                "account_type": F.col("account_type_id"),
                "is_registr": F.lit(0),
                "portfolio_oid": F.col("portfolio_id"),
            }
        ),
        ctx,
        ACCOUNT_COLUMNS,
    )
