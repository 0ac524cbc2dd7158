"""Pledges and sureties that secure the published loans."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from snapbook.context import RunContext
from snapbook.functions import exprs
from snapbook.functions.intervals import valid_on
from snapbook.operators.asof import asof_latest, history_of, latest
from snapbook.operators.hierarchy import chain_latest
from snapbook.operators.lookups import attach, opt_filter
from snapbook.plans.loan import of_keys, shape
from snapbook.plans.routines import bank_code
from snapbook.session import cut

Frames = Mapping[str, DataFrame]

# Bank with the collateral waterfall, active pledge status, approved activity status.
WATERFALL_BANK = 12
ACTIVE_PLEDGE = 1
APPROVED = 3

# The published columns.
PLEDGE_COLUMNS = {
    "branch_code": "int",
    "contract_oid": "string",
    "contract_type": "string",
    "pledge_source": "string",
    "pledge_oid": "string",
    "pledge_contract_number": "string",
    "id_pledge_type": "string",
    "name": "string",
    "category_rsbu": "int",
    "fair_summa_curr": "string",
    "fair_summa_val": "decimal(21,2)",
    "insure_curr": "string",
    "insure_summa_val": "decimal(21,2)",
    "date_last_measurement": "date",
    "summa_with_discount_curr": "string",
    "summa_with_discount_val": "int",
    "client_oid": "string",
}


def security_contracts(src: Frames, ctx: RunContext) -> DataFrame:
    """Pledge contracts valid on the date, with number, branch, currency and source system."""
    base = src["base_contract"].filter(valid_on(F.col("start_date"), F.col("closed_date"), ctx.asof)).filter(
        ~F.col("status").isin(0, 3)
    )
    return base.select(
        F.col("contract_id").alias("pledge_contract_id"), F.col("number").alias("security_number"), "branch_id", "currency",
        F.col("client_id").alias("security_client"),
    ).join(src["pledge_contract"].select(F.col("contract_id").alias("pledge_contract_id"), "source_system"), "pledge_contract_id")


def secured_links(src: Frames, ctx: RunContext, loans: DataFrame) -> DataFrame:
    """Distinct (loan contract, pledge contract) pairs linked on the date.

    Duplicates are removed here, on two columns, rather than on the finished rows.
    """
    contracts = opt_filter(
        loans.select(F.coalesce("main_contract_oid", "oid").alias("contract_id")).distinct(), "contract_id", ctx.object_id
    ).join(src["contract"].select("contract_id"), "contract_id", "left_semi")
    links = src["pledge_link"].filter(valid_on(F.col("link_date"), F.col("expiration_date"), ctx.asof))
    return links.join(contracts, "contract_id", "left_semi").select("contract_id", "pledge_contract_id").distinct()


def security_list(src: Frames, ctx: RunContext, loans: DataFrame) -> DataFrame:
    """Pledges (active) and sureties behind the links, with object, owner and collateral type."""
    df = secured_links(src, ctx, loans).join(security_contracts(src, ctx), "pledge_contract_id")
    pledges = src["pledge"].filter(F.col("pledge_status") == ACTIVE_PLEDGE).select(
        "pledge_contract_id", "pledge_id", "owner_id", "fair_value", "collateral_value", "confirmation_date", "subsequent",
        "basic_state_date", "consider_reserve",
    )
    df = df.join(pledges, "pledge_contract_id", "left")
    df = attach(df, src["pledge_owner"], {"owner_id": "owner_id"}, {"object_id": "object_id"}, spread_nulls_by="contract_id", once="pledge_owner")
    df = attach(df, src["pledge_object"], {"object_id": "object_id"}, {
        "collateral_type_id": "object_collateral", "pledge_kind": "pledge_kind", "name": "object_name",
        "quality_category": "object_quality"}, spread_nulls_by="contract_id", once="pledge_object")
    df = attach(df, src["surety"], {"pledge_contract_id": "contract_id"}, {
        "contract_id": "surety_id", "collateral_type_id": "surety_collateral", "quality_category": "surety_quality"}, once="surety")
    return df.withColumns(
        {
            "security_id": F.coalesce("pledge_id", "surety_id"),
            "collateral_type_id": F.coalesce("object_collateral", F.when(F.col("pledge_id").isNull(), F.col("surety_collateral"))),
        }
    ).filter(F.col("security_id").isNotNull())


def base_pledge_values(src: Frames, ctx: RunContext) -> DataFrame:
    """Collateral value of the chain member in force, for every pledge of a chain."""
    known = src["pledge_series"].join(src["pledge"].select("pledge_id"), "pledge_id", "left_semi")
    heads = chain_latest(known, ctx.asof)
    values = src["pledge"].select(F.col("pledge_id").alias("current_id"), F.col("collateral_value").alias("base_collateral"))
    return heads.join(values, "current_id").select("pledge_id", "base_collateral")


def approved_assessments(src: Frames, ctx: RunContext) -> DataFrame:
    """Last approved assessment per pledge object."""
    done = src["activity"].filter(F.col("status") == APPROVED).select("activity_id")
    conclusions = src["pledge_conclusion"].join(done, "activity_id").select("conclusion_id")
    rows = src["pledge_assessment"].join(conclusions, "conclusion_id")
    return latest(rows, "object_id", "assessment_date", ctx.asof, ties=("collateral_value",)).select(
        "object_id", F.col("collateral_value").alias("assessed")
    )


def pledge_snapshot(src: Frames, ctx: RunContext, loans: DataFrame) -> DataFrame:
    df = listed = cut(security_list(src, ctx, loans))
    # Only the history of the contracts at hand is reduced.
    history = history_of(src["pledge_link_history"], df.select("contract_id"), "contract_id")
    # Value agreed per loan and pledge, by distribution date.
    df = asof_latest(
        df, history.filter(F.col("pledge_id").isNotNull()), ["contract_id", "pledge_id"], "distribution_date", ctx.asof,
        {"fair_value": "link_value", "insurance_sum": "link_insurance"}, ties=("link_history_id",),
    )
    # Value per loan and pledge contract: last distribution among rests of the date, if distributed by then.
    by_contract = latest(
        history.filter(F.col("rest_oper_day") <= ctx.day), ["contract_id", "pledge_contract_id"], "distribution_date", None,
        ties=("link_history_id",),
    ).filter(F.col("distribution_date") <= ctx.day)
    df = df.join(
        by_contract.select("contract_id", "pledge_contract_id", F.col("fair_value").alias("surety_value"),
                           F.col("insurance_sum").alias("surety_insurance")),
        ["contract_id", "pledge_contract_id"], "left",
    )
    objects = listed.filter(F.col("object_id").isNotNull())
    quality = latest(of_keys(src["pledge_quality"], objects, "object_id"), "object_id", "setting_date", None, ties=("quality_category",))
    df = attach(df, quality, {"object_id": "object_id"}, {"quality_category": "set_quality"}, spread_nulls_by="contract_id")
    # The bank's code is one row of a small table; assessments and chains are for the bank that values by them.
    by_waterfall = bank_code(src) == WATERFALL_BANK
    if by_waterfall:
        df = attach(df, of_keys(approved_assessments(src, ctx), objects, "object_id"), {"object_id": "object_id"}, {"assessed": "assessed"}, spread_nulls_by="contract_id")
        df = attach(df, base_pledge_values(src, ctx), {"pledge_id": "pledge_id"}, {"base_collateral": "base_collateral"},
                    spread_nulls_by="contract_id")
    df = attach(df, src["external_system"], {"source_system": "code"}, {"name": "system_name"}, spread_nulls_by="contract_id", once="external_system")
    df = attach(df, src["collateral_type"], {"collateral_type_id": "collateral_type_id"}, {"code": "collateral_code", "name": "collateral_name"}, spread_nulls_by="contract_id", once="collateral_type")
    df = attach(df, src["branch"], {"branch_id": "branch_id"}, {"inner_code": "inner_code"}, spread_nulls_by="contract_id", once="branch")

    pledged = F.col("pledge_id").isNotNull()
    value = F.coalesce("link_value", F.lit(0))
    if by_waterfall:
        value = exprs.collateral_value(
            F.col("fair_value"), F.col("link_value"), F.col("subsequent"), F.col("assessed"), F.col("collateral_value"),
            F.col("basic_state_date"), F.col("base_collateral"), ctx.asof,
        )
    category = F.when(F.col("consider_reserve") == 1, F.coalesce("set_quality", "object_quality")).otherwise(F.lit(0))
    curr = exprs.currency(F.col("currency"), default=False)
    return shape(
        df.withColumns(
            {
                "branch_code": exprs.code_or_zero(F.col("inner_code")),
                "contract_oid": F.col("contract_id"),
                "contract_type": F.lit("к"),
                "pledge_source": F.coalesce("system_name", F.lit(ctx.source)),
                "pledge_oid": F.col("security_id"),
                "pledge_contract_number": F.col("security_number"),
                "id_pledge_type": F.when(pledged, F.col("pledge_kind").cast("string")).otherwise(F.col("collateral_code").cast("string")),
                "name": F.when(pledged, F.col("object_name")).otherwise(F.col("collateral_name")),
                "category_rsbu": F.when(pledged, category).otherwise(F.col("surety_quality")),
                "fair_summa_curr": curr,
                "fair_summa_val": F.when(pledged, value).otherwise(F.col("surety_value")),
                "insure_curr": curr,
                "insure_summa_val": F.when(pledged, F.col("link_insurance")).otherwise(F.col("surety_insurance")),
                "date_last_measurement": F.col("confirmation_date"),
                "summa_with_discount_curr": curr,
                "summa_with_discount_val": F.lit(0),
                "client_oid": F.col("security_client"),
            }
        ),
        ctx,
        PLEDGE_COLUMNS,
    )
