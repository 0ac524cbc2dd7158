"""Bank guarantees and guarantee lines."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import timedelta

from pyspark.sql import DataFrame, functions as F

from snapbook.context import RunContext
from snapbook.functions import exprs
from snapbook.functions.intervals import valid_on
from snapbook.operators.asof import asof_latest, first_per, history_of
from snapbook.operators.lookups import attach, const_df, opt_filter
from snapbook.plans import routines
from snapbook.plans.loan import of_keys, quality_of, shape
from snapbook.session import cut

# Guarantee status -> base contract status; guarantee status and contract status names.
STATUS_MAP = [
    (6, 1, "Действует", "Открыт"),
    (8, 2, "Закрыта", "Закрыт"),
    (9, 2, "Оплачена по требованию", "Закрыт"),
    (10, 0, "Проект", "Проект"),
    (11, 3, "Аннулирована до выдачи", "Удален"),
]
STATUS_SCHEMA = "guarantee_status int, base_status int, status_name string, base_status_name string"
# Change types that carry guarantee attributes; unused-limit register type.
CHANGE_TYPES = (37, 38, 39, 40)
UNUSED_LIMIT_REGISTER = 2

# The published columns.
GUARANTEE_COLUMNS = {
    "branch_code": "int",
    "division_code": "int",
    "oid": "string",
    "number": "string",
    "beneficiary_inn": "string",
    "beneficiary_name": "string",
    "curr": "string",
    "date_open": "date",
    "date_end": "date",
    "date_close": "date",
    "type_guarantee": "string",
    "comission_rate": "decimal(18,6)",
    "comission_sum": "decimal(18,2)",
    "comission_rate_year": "decimal(18,6)",
    "client_oid": "string",
    "is_line": "int",
    "main_contract_oid": "string",
    "summa_val": "decimal(18,2)",
    "coef_reserve": "decimal(18,6)",
    "category_quality": "int",
    "portfolio_oid": "string",
}

# Attributes that a revision may override, by their name in the current contract.
OVERRIDES = {
    "number": "number",
    "contract_date": "contract_date",
    "start_date": "start_date",
    "end_date": "end_date",
    "closed_date": "closed_date",
    "branch_id": "branch_id",
    "division_id": "division_id",
    "client_id": "customer_id",
    "currency": "currency",
}


def status_map(spark) -> DataFrame:
    return const_df(spark, STATUS_MAP, STATUS_SCHEMA)


def last_revisions(src: Mapping[str, DataFrame], ctx: RunContext, contracts: DataFrame | None = None) -> DataFrame:
    """Last revision per contract among the mapped statuses and the four change types, created by the date; of the given contracts only, if any are."""
    next_day = F.lit(ctx.asof + timedelta(days=1)).cast("timestamp_ntz")
    events = src["guarantee_event"].filter(F.col("create_date") < next_day)
    revisions = src["contract_revision"].filter(F.col("change_type").isin(*CHANGE_TYPES))
    if contracts is not None:
        # Revisions are wide and looked up by their own id, so those of other contracts go before they are moved.
        revisions = history_of(revisions, contracts, "contract_id")
    mapped = status_map(events.sparkSession).select(
        F.col("guarantee_status").alias("guarant_status"), "base_status"
    )
    joined = revisions.join(events, "history_id").join(mapped, "guarant_status")
    return first_per(joined, "contract_id", [F.col("create_date").desc(), F.col("history_id").desc()])


def guarantee_list(src: Mapping[str, DataFrame], ctx: RunContext) -> DataFrame:
    """Guarantees valid on the date, historic attributes before current ones."""
    contract = opt_filter(src["contract"].filter(F.col("kind") == 2), "contract_id", ctx.object_id)
    info = last_revisions(src, ctx, contract).select(
        "contract_id", "base_status",
        *[F.col(h).alias(f"_{c}") for c, h in OVERRIDES.items()],
    )
    # The validity test reads the revision's own dates, so a contract without one never passes.
    df = (
        contract.join(src["base_contract"], "contract_id")
        .join(src["loan_contract"].select("contract_id", F.col("portfolio_id").alias("current_portfolio")), "contract_id")
        .join(info, "contract_id")
        .filter(F.coalesce("base_status", "status").isin(1, 2))
        .filter(valid_on(F.col("_contract_date"), F.col("_closed_date"), ctx.asof))
    )
    df = df.withColumns({c: F.coalesce(F.col(f"_{c}"), F.col(c)) for c in OVERRIDES})
    df = cut(df)
    return asof_latest(
        df, of_keys(src["portfolio_history"], df, "contract_id"), "contract_id", "date_begin", ctx.asof, {"portfolio_id": "history_portfolio"},
        ties=("portfolio_id",),
    )


def guarantee_snapshot(src: Mapping[str, DataFrame], ctx: RunContext) -> DataFrame:
    df = cut(guarantee_list(src, ctx))
    own = {"contract_id": "contract_id"}
    df = attach(df, quality_of(src, "contract", df), own, {"reserve_ratio": "coef_reserve", "quality_code": "category_quality"}, once="contract_quality")
    registers = src["register"].join(df.select("contract_id").distinct(), "contract_id", "left_semi")
    limit = routines.register_rest(registers, src["register_rest"], UNUSED_LIMIT_REGISTER, ctx.asof)
    df = attach(df, limit, own, {"amount": "summa_val"})
    df = attach(df, src["currency"], {"currency": "code"}, {"international_code": "curr"}, once="currency")
    df = attach(df, src["division"], {"division_id": "division_id"}, {"code": "division_code"}, once="division")
    df = attach(df, src["customer"], {"beneficiary_id": "customer_id"},
                {"inn": "beneficiary_inn", "name": "beneficiary_name"}, spread_nulls_by="contract_id", once="customer")
    return shape(
        df.withColumns(
            {
                "branch_code": F.coalesce("branch_id", F.lit(0)),
                "oid": F.col("contract_id"),
                "curr": F.coalesce("curr", F.lit(exprs.RUBLE)),
                "date_open": F.col("contract_date"),
                "date_end": F.col("end_date"),
                "date_close": F.col("closed_date"),
                "type_guarantee": F.col("guarant_type"),
                "comission_sum": F.col("commission_sum"),
                "client_oid": F.col("client_id"),
                "is_line": exprs.flag(F.col("guarant_kind").isin(1, 2)),
                "main_contract_oid": F.when(F.col("guarant_kind") == 3, F.col("line_contract_id")),
                "portfolio_oid": F.coalesce("history_portfolio", "current_portfolio"),
            }
        ),
        ctx,
        GUARANTEE_COLUMNS,
    )
