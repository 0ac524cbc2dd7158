"""Loan portfolios and their account columns."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from snapbook.context import RunContext
from snapbook.functions import exprs
from snapbook.functions.intervals import valid_on
from snapbook.operators.asof import asof_latest
from snapbook.operators.lookups import attach, const_df, keep_existing, opt_filter
from snapbook.operators.pivoting import pivot_min
from snapbook.plans.loan import shape

PORTFOLIO_COLUMNS = {
    "branch_code": "int",
    "division_code": "int",
    "oid": "string",
    "name": "string",
    "coef_reserve": "decimal(18,6)",
    "category_quality": "int",
    "status": "string",
    "is_registr": "int",
    "short_name": "string",
}

# Published column -> account type that feeds it. Six types feed two columns.
ACCOUNT_COLUMNS = {
    "acc_corr_ac_act": 246,
    "acc_corr_ac_pas": 247,
    "acc_corr_reserve_principal_pas": 229,
    "acc_corr_reserve_principal_act": 228,
    "acc_corr_reserve_overdue_principal_pas": 239,
    "acc_corr_reserve_overdue_principal_act": 238,
    "acc_corr_reserve_interest_pas": 231,
    "acc_corr_reserve_interest_act": 230,
    "acc_corr_reserve_overdue_interest_pas": 241,
    "acc_corr_reserve_overdue_interest_act": 240,
    "acc_corr_reserve_nkl_pas": 235,
    "acc_corr_reserve_nkl_act": 234,
    "acc_reserve_principal": 10018,
    "acc_reserve_overdue_principal": 10133,
    "acc_reserve_interest": 10135,
    "acc_reserve_overdue_interest": 10078,
    "acc_reserve_nkl": 10029,
    "acc_reserve_komis": 10120,
    "acc_corr_reserve_komis_pas": 233,
    "acc_corr_reserve_komis_act": 232,
    "acc_reserve_penalty": 10079,
    "acc_corr_reserve_penalty_pas": 237,
    "acc_corr_reserve_penalty_act": 236,
    "acc_reserve_principal_cession": 10018,
    "acc_reserve_overdue_principal_cession": 10133,
    "acc_reserve_premium": 10134,
    "acc_reserve_overdue_premium": 10087,
    "acc_reserve_discount": 10142,
    "acc_reserve_overdue_discount": 10125,
    "acc_corr_reserve_principal_cession_pas": 243,
    "acc_corr_reserve_principal_cession_act": 242,
    "acc_corr_reserve_overdue_principal_cession_pas": 239,
    "acc_corr_reserve_overdue_principal_cession_act": 238,
    "acc_corr_reserve_premium_pas": 243,
    "acc_corr_reserve_premium_act": 242,
    "acc_corr_reserve_overdue_premium_pas": 10009,
    "acc_corr_reserve_overdue_premium_act": 10012,
    "acc_corr_reserve_discount_pas": 245,
    "acc_corr_reserve_discount_act": 244,
    "acc_corr_reserve_overdue_discount_pas": 10016,
    "acc_corr_reserve_overdue_discount_act": 10017,
    "acc_reserve_overdue_komis_perc": 10020,
    "acc_corr_reserve_overdue_komis_perc_pas": 10021,
    "acc_corr_reserve_overdue_komis_perc_act": 10025,
    "acc_reserve_overdue_komis_nonperc": 10037,
    "acc_corr_reserve_overdue_komis_nonperc_pas": 10058,
    "acc_corr_reserve_overdue_komis_nonperc_act": 10064,
}


def open_portfolio_accounts(src: Mapping[str, DataFrame], ctx: RunContext) -> DataFrame:
    """Accounts of portfolios open on the date, with the account type of the base account."""
    base = src["base_account"].filter(valid_on(F.col("date_open"), F.col("date_close"), ctx.asof)).select(
        "base_account_id", F.col("account_type_id").alias("base_type_id")
    )
    owned = src["account"].filter(F.col("portfolio_id").isNotNull())
    return owned.select("account_id", "portfolio_id", "base_account_id").join(base, "base_account_id")


def back_office(src: Mapping[str, DataFrame]) -> DataFrame:
    """Division and branch code per portfolio type; a type with several offices keeps several rows."""
    links = src["back_type_office"].filter(F.col("create_account") == 1)
    return (
        links.join(src["division"], links.division_id == src["division"].division_id)
        .join(src["branch"], "branch_id")
        .select("back_type_id", F.col("code").alias("division_code"),
                exprs.code_or_zero(F.col("inner_code")).alias("branch_code"))
    )


def portfolio_snapshot(src: Mapping[str, DataFrame], ctx: RunContext) -> DataFrame:
    """Portfolios with at least one open account, with risk as of the date or the default group's."""
    df = opt_filter(src["portfolio"], "portfolio_id", ctx.object_id)
    df = keep_existing(df, open_portfolio_accounts(src, ctx), "portfolio_id")
    risk = src["risk_change"].filter(F.col("portfolio_id").isNotNull()).join(src["risk_group"], "risk_group_id")
    df = asof_latest(df, risk, "portfolio_id", "action_date", ctx.asof, {"ratio": "ratio", "code": "quality"}, ties=("change_id",))
    df = attach(df, src["portfolio_back_type"], {"back_type_id": "back_type_id"},
                {"name": "type_name", "freeze_client_status": "freeze"}, once="portfolio_back_type")
    df = attach(df, src["portfolio_criteria"], {"criteria_id": "criteria_id"}, {"name": "criterion"}, once="portfolio_criteria")
    df = attach(df, src["risk_group"], {"risk_group_id": "risk_group_id"}, {"max_ratio": "default_ratio", "code": "default_code"}, once="risk_group")
    df = attach(df, back_office(src), {"back_type_id": "back_type_id"}, {"division_code": "division_code", "branch_code": "branch_code"})
    return shape(
        df.withColumns(
            {
                "branch_code": F.coalesce("branch_code", F.lit(0)),
                "oid": F.col("portfolio_id"),
                "name": exprs.portfolio_name(F.col("type_name"), F.col("criterion")),
                "coef_reserve": F.coalesce("ratio", "default_ratio"),
                "category_quality": F.coalesce("quality", "default_code"),
                "status": exprs.freeze_status(F.col("freeze")),
                "is_registr": F.lit(0),
            }
        ),
        ctx,
        PORTFOLIO_COLUMNS,
    ).distinct()


def portfolio_account_columns(src: Mapping[str, DataFrame], ctx: RunContext) -> DataFrame:
    """Smallest open account id per portfolio in each of the 47 account columns.

    Accounts are reduced to one per portfolio and type first, so the column map multiplies only those.
    """
    accounts = open_portfolio_accounts(src, ctx)
    per_type = accounts.groupBy("portfolio_id", "base_type_id").agg(F.min("account_id").alias("account_id"))
    columns = const_df(accounts.sparkSession, list(ACCOUNT_COLUMNS.items()), "column_name string, base_type_id int")
    named = per_type.join(columns, "base_type_id")
    wide = pivot_min(named, "portfolio_id", "column_name", "account_id", list(ACCOUNT_COLUMNS))
    known = opt_filter(src["portfolio"], "portfolio_id", ctx.object_id)
    return keep_existing(wide, known, "portfolio_id")
