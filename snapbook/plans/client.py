"""Clients."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from snapbook.context import RunContext
from snapbook.operators.lookups import opt_filter, update_from
from snapbook.plans.loan import shape
from snapbook.plans.routines import bank_code

# Fixed value: the bank whose clients get their branch from the division.
BRANCH_BY_DIVISION_BANK = 9

# The published columns.
CLIENT_COLUMNS = {
    "oid": "string", "name": "string", "full_name": "string", "status": "string", "client_type": "string",
    "is_resident": "int", "inn": "string", "kpp": "string", "okved": "string", "okato": "string", "date_reg": "date",
    "date_birth": "date", "gender": "string", "segment": "string", "rating_internal": "string",
    "rating_internal_score": "decimal(18,2)", "branch_code": "smallint", "fin_position": "string",
}


def client_snapshot(src: Mapping[str, DataFrame], ctx: RunContext) -> DataFrame:
    """Client rows; bank 9 takes the branch of the client's division, other banks the supplied one."""
    clients = opt_filter(src["client"], "oid", ctx.object_id)
    by_division = src["customer"].select("customer_id", "division_id").join(
        src["division"].select("division_id", F.col("branch_id").cast("smallint").alias("division_branch")), "division_id"
    )
    rows = update_from(
        clients.withColumn("division_branch", F.lit(None).cast("smallint")), by_division,
        {"oid": "customer_id"}, {"division_branch": "division_branch"},
    )
    own = F.col("division_branch" if bank_code(src) == BRANCH_BY_DIVISION_BANK else "branch_code")
    return shape(rows.withColumn("branch_code", own), ctx, CLIENT_COLUMNS)
