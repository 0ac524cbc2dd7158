"""Scalar rules shared by the datasets, as Column expressions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, functions as F

from snapbook.functions.intervals import is_closed, opened

# The ruble had code 810 before 1998 and 643 since.
OLD_RUBLE = "810"
RUBLE = "643"

MONEY = "decimal(21,2)"
WIDE_MONEY = "decimal(31,2)"


def flag(cond: Column) -> Column:
    """1 where the condition is true, else 0 (unknown counts as false)."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def currency(code: Column, default: bool = True) -> Column:
    """Replace the old ruble code; with ``default`` a missing code is the ruble too."""
    swapped = F.when(code == OLD_RUBLE, F.lit(RUBLE)).otherwise(code)
    return F.coalesce(swapped, F.lit(RUBLE)) if default else swapped


def code_or_zero(code: Column) -> Column:
    return F.coalesce(code.cast("int"), F.lit(0))


def signed_rest(active: Column, rest: Column, width: str = MONEY) -> Column:
    return F.when(active, rest).otherwise(-rest).cast(width)


def signed_debit(active: Column, over_in: Column, over_out: Column, width: str = MONEY) -> Column:
    return F.when(active, over_in).otherwise(-over_out).cast(width)


def signed_credit(active: Column, over_in: Column, over_out: Column, width: str = MONEY) -> Column:
    return F.when(active, -over_out).otherwise(over_in).cast(width)


def opening_rest(day: Column, asof: date, rest_in: Column, rest_out: Column) -> Column:
    """Incoming rest of the day's own row, else the outgoing rest of the last earlier row, else 0."""
    picked = F.when(day == F.lit(asof).cast("date"), rest_in).otherwise(rest_out)
    return F.coalesce(picked, F.lit(0)).cast(MONEY)


def actual_status(status: Column, start: Column, closed: Column, history: Column, asof: date) -> Column:
    """1 open, 2 closed for a valid contract; otherwise what the status history says, or 0."""
    valid = F.coalesce(status.isin(1, 2), F.lit(False))
    gone = is_closed(closed, asof)
    return (
        F.when(valid & opened(start, closed, asof) & ~gone, F.lit(1))
        .when(valid & gone, F.lit(2))
        .otherwise(F.coalesce(history.cast("int"), F.lit(0)))
    )


def line_kind(contract_type: Column) -> Column:
    return F.when(contract_type == 3, F.lit("ВКЛ")).when(contract_type == 2, F.lit("НКЛ"))


def freeze_status(code: Column) -> Column:
    return F.when(code == 0, F.lit("ф")).when(code == 1, F.lit("ю")).otherwise(F.lit("?"))


def repayment_reason(status: Column, ceded: Column) -> Column:
    return F.when(status == 2, F.when(ceded, F.lit("Цессия")).otherwise(F.lit("Погашен")))


def capitalise_first(text: Column) -> Column:
    """Upper-case the first letter and leave the rest."""
    return F.concat(F.upper(F.substring(text, 1, 1)), text.substr(F.lit(2), F.length(text)))


def portfolio_name(type_name: Column, criterion: Column) -> Column:
    prefix = F.coalesce(F.concat(type_name, F.lit(". ")), F.lit(""))
    return F.concat(prefix, F.coalesce(capitalise_first(criterion), F.lit("")))


def with_customer(base: Column, customer: Column, opening: str = " (") -> Column:
    """Append the trimmed customer name in brackets when there is one; NULL base stays NULL."""
    return F.concat(base, F.coalesce(F.concat(F.lit(opening), F.trim(customer), F.lit(")")), F.lit("")))


def tranche_name(number: Column, issue_number: Column) -> Column:
    return F.concat(number, F.lit(" - "), issue_number.cast("string"))


def account_symbol(number: Column) -> Column:
    """Five characters from position 14 of an account number."""
    return F.substring(number, 14, 5)


def valid_account_number(number: Column) -> Column:
    """Twenty digits. A missing number is kept: only a proven bad number is removed."""
    good = (F.length(F.trim(number)) == 20) & ~number.rlike("[^0-9]")
    return F.coalesce(good, F.lit(True))


def blank_to_null(text: Column) -> Column:
    return F.nullif(F.rtrim(text), F.lit(""))


def mirror_id(identifier: Column) -> Column:
    """Second, reversible id for the same register."""
    return F.reverse(identifier)


def register_code(register_type: Column, external: Column) -> Column:
    return F.concat(register_type.cast("string"), F.when(external, F.lit("r")).otherwise(F.lit("")))


def seconds_between(start: Column, finish: Column) -> Column:
    """Milliseconds between two instants as seconds, three decimals."""
    millis = F.unix_millis(finish.cast("timestamp")) - F.unix_millis(start.cast("timestamp"))
    return (millis / F.lit(1000).cast("decimal(4,0)")).cast("decimal(9,3)")


def stable_key(*parts: Column) -> Column:
    """Deterministic id of a log row, so that a re-run of a task writes the same key."""
    return F.sha2(F.concat_ws("|", *parts), 256)


def collateral_value(
    pledge_value: Column,
    link_value: Column,
    subsequent: Column,
    assessed: Column,
    pledge_collateral: Column,
    basic_state_date: Column,
    base_collateral: Column,
    asof: date,
) -> Column:
    """Fair value of a pledge under bank code 12.

    A pledge with its own positive value takes the value agreed with the loan. Otherwise a first
    pledge takes the approved assessment, then its own collateral value; a subsequent pledge takes
    the base pledge's value until the basic state date is reached. What is missing is 0.
    """
    day = F.lit(asof).cast("date")
    zero = F.lit(0)
    later = F.when(F.coalesce(basic_state_date, day) > day, F.coalesce(base_collateral, zero)).otherwise(zero)
    first = F.coalesce(assessed, pledge_collateral, zero)
    own = F.when(subsequent == 0, first).otherwise(later)
    return F.when(F.coalesce(pledge_value, zero) > 0, F.coalesce(link_value, zero)).otherwise(own)
