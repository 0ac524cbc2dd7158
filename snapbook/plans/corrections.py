"""Accounting entries that come back as corrections."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F

from snapbook.functions import exprs
from snapbook.operators.lookups import keep_few_existing
from snapbook.operators.numbering import number_rows

# Fixed value: label of entries made by the reporting side.
LABEL = "MSFO"

# The published columns.
CORRECTION_COLUMNS = (
    "idx", "source", "contract_id", "issue_id", "portfolio_id", "operation_type", "transaction_date", "transaction_sum",
    "acc_number_debet", "symbol_debet", "acc_number_credit", "symbol_credit", "description",
)


def day_entries(entries: DataFrame, asof: date, branch: int, source: str) -> DataFrame:
    """Entries of one date, source and branch with typed ids and account symbols."""
    rows = entries.filter(
        (F.col("date1") == F.lit(asof)) & (F.col("source") == source) & (F.col("branch_code") == branch)
    )
    return rows.select(
        F.lit(LABEL).alias("source"),
        F.col("contract_oid").alias("contract_id"),
        exprs.blank_to_null(F.col("tranche_oid")).alias("issue_id"),
        exprs.blank_to_null(F.col("portfolio_oid")).alias("portfolio_id"),
        "operation_type",
        F.col("date1").alias("transaction_date"),
        F.col("sum_rub").cast(exprs.WIDE_MONEY).alias("transaction_sum"),
        "acc_number_debet",
        exprs.account_symbol(F.col("acc_number_debet")).alias("symbol_debet"),
        "acc_number_credit",
        exprs.account_symbol(F.col("acc_number_credit")).alias("symbol_credit"),
        F.col("payment_purpose").alias("description"),
    )


def corrections(entries: DataFrame, contracts: DataFrame, portfolios: DataFrame, asof: date, branch: int,
                source: str) -> DataFrame:
    """Numbered entries whose contract or portfolio exists; one with both appears twice, under one number."""
    rows = day_entries(entries, asof, branch, source)
    leading = ["contract_id", "issue_id", "portfolio_id"]
    order = leading + [c for c in rows.columns if c not in (*leading, "source")]
    numbered = number_rows(rows, [F.col(c).asc_nulls_first() for c in order], "idx")
    by_contract = keep_few_existing(numbered, contracts, "contract_id")
    by_portfolio = keep_few_existing(numbered, portfolios, "portfolio_id")
    return by_contract.unionByName(by_portfolio).select(*CORRECTION_COLUMNS)


def rejected_ids(entries: DataFrame, pattern: str) -> DataFrame:
    """Entries with an id that does not have the id format, for a report instead of a failed run."""
    bad = F.lit(False)
    for name in ("contract_oid", "tranche_oid", "portfolio_oid"):
        value = exprs.blank_to_null(F.col(name))
        bad = bad | (value.isNotNull() & ~value.rlike(pattern))
    return entries.filter(bad)
