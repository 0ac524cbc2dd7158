"""Repayment schedules of the published loans."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from snapbook.context import RunContext
from snapbook.operators.lookups import opt_filter
from snapbook.plans.loan import shape

# Contract types whose schedule is kept per tranche only.
TRANCHE_SCHEDULE_TYPES = (2, 3, 6)

PAYMENTS = (
    "debt_main", "debt_interest", "commissions", "other_payments", "other_expenses", "overdue_main",
    "overdue_interest", "penalty",
)
SCHEDULE_COLUMNS = {"contract_oid": "string", "date_payment": "date", **{c: "decimal(21,2)" for c in PAYMENTS}}


def schedule_snapshot(src: Mapping[str, DataFrame], ctx: RunContext, loans: DataFrame) -> DataFrame:
    """Planned payments of tranches, and of contracts whose type is not scheduled by tranche.

    ``schedule`` holds owner ('issue' or 'contract'), owner_id, date_payment and the payment columns.
    Tranche rows and contract rows differ only in the owner, so payments are joined once.
    """
    oids = loans.select("oid").distinct()
    issue = opt_filter(src["issue"], "contract_id", ctx.object_id)
    contract = opt_filter(src["contract"], "contract_id", ctx.object_id).filter(
        ~F.col("contract_type").isin(*TRANCHE_SCHEDULE_TYPES)
    )
    owners = issue.select(F.lit("issue").alias("owner"), F.col("issue_id").alias("owner_id")).unionByName(
        contract.select(F.lit("contract").alias("owner"), F.col("contract_id").alias("owner_id"))
    )
    units = owners.join(oids, owners.owner_id == oids.oid, "left_semi")
    dated = src["schedule"].filter(F.col("date_payment").isNotNull())
    rows = dated.join(units, ["owner", "owner_id"]).withColumn("contract_oid", F.col("owner_id"))
    return shape(rows, ctx, SCHEDULE_COLUMNS)
