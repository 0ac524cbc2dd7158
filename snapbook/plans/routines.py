"""Facts that a loan system computes elsewhere, as frames keyed by contract, tranche or scheme.

Each function is a default definition. A bank with its own definition passes its own frame instead;
the dataset builders only see the frame.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from datetime import date
from typing import Any

from pyspark.sql import DataFrame, functions as F

from snapbook.operators.asof import history_of, latest, latest_by_day
from snapbook.operators.hierarchy import resolve_chains
from snapbook.session import cut


class Facts(Mapping[str, DataFrame]):
    """Input frames with the default definitions of facts that are not given: overdue dates, qualities and pledge chains."""

    def __init__(self, src: Mapping[str, DataFrame], asof: date) -> None:
        self._src, self._asof = src, asof
        self._made: dict[str, Any] = {}
        self._defaults: dict[str, Callable[[], DataFrame]] = {
            "overdue": lambda: overdue_start(src["overdue_balance"], asof),
            "contract_quality": lambda: quality(src["risk_change"], src["risk_group"], "contract_id", asof),
            "issue_quality": lambda: quality(src["risk_change"], src["risk_group"], "issue_id", asof),
            "pledge_series": lambda: self._pledges()[0],
            "pledge_reject": lambda: self._pledges()[1],
        }

    def _pledges(self) -> tuple[DataFrame, DataFrame]:
        if "_pledges" not in self._made:
            series, cycles = pledge_chains(self._src["pledge_chain"])
            self._made |= {"_pledges": (cut(series), cycles)}
        return self._made["_pledges"]

    def quality_of(self, level: str, keys: DataFrame) -> DataFrame:
        """Qualities of the contracts or tranches in ``keys``; where they are not given, only the risk changes of these are reduced."""
        key = f"{level}_id"
        if f"{level}_quality" in self._src:
            return self._src[f"{level}_quality"].join(keys.select(key), key, "left_semi")
        changes = self._src["risk_change"].join(keys.select(key), key, "left_semi")
        return quality(changes, self._src["risk_group"], key, self._asof)

    def __contains__(self, name: object) -> bool:
        return name in self._src or name in self._defaults

    def __getitem__(self, name: str) -> DataFrame:
        if name in self._defaults and name not in self._src:
            if name not in self._made:
                self._made[name] = self._defaults[name]()
            return self._made[name]
        return self._src[name]

    def __iter__(self) -> Iterator[str]:
        return iter({*self._src, *self._defaults})

    def __len__(self) -> int:
        return len({*self._src, *self._defaults})


def fact_end(src: Mapping[str, DataFrame]) -> DataFrame:
    """Actual end date of a contract: its closing date."""
    return src["base_contract"].select("contract_id", F.col("closed_date").alias("fact_end"))


def contract_sum(sums: DataFrame, asof: date) -> DataFrame:
    """Contract amount in force on the date: the last amount set by then."""
    return latest(sums, "contract_id", "eff", asof, ties=("amount",)).select("contract_id", "amount")


def overdue_start(balances: DataFrame, asof: date) -> DataFrame:
    """First day of the current overdue run per contract, for principal and for interest.

    ``balances``: contract_id, part ('principal' or 'interest'), oper_day, rest_out. The run begins on the
    first day with a balance after the last day without one. Two map-side reductions, no window.
    """
    known = balances.filter(F.col("oper_day") <= F.lit(asof).cast("date"))
    key = ["contract_id", "part"]
    daily = known.groupBy(*key, "oper_day").agg(F.sum("rest_out").alias("rest"))
    zero = daily.groupBy(*key).agg(F.max(F.when(F.col("rest") == 0, F.col("oper_day"))).alias("last_zero"))
    run = daily.join(zero, key).filter(
        (F.col("rest") > 0) & (F.col("last_zero").isNull() | (F.col("oper_day") > F.col("last_zero")))
    )
    first = lambda part: F.min(F.when(F.col("part") == part, F.col("oper_day")))
    return run.groupBy("contract_id").agg(
        first("principal").alias("principal_from"), first("interest").alias("interest_from")
    )


def quality(changes: DataFrame, groups: DataFrame, key: str, asof: date) -> DataFrame:
    """Reserve ratio and quality code of the last risk change per contract, tranche or portfolio."""
    known = changes.filter(F.col(key).isNotNull()).join(groups, "risk_group_id")
    last = latest(known, key, "action_date", asof, ties=("change_id",))
    return last.select(key, F.col("ratio").alias("reserve_ratio"), F.col("code").alias("quality_code"))


def scheme_rate(values: DataFrame, asof: date) -> DataFrame:
    """Rate of every percent scheme on the date."""
    return latest(values, "scheme_id", "value_date", asof, ties=("seq",)).select("scheme_id", "rate")


def floating_code(values: DataFrame) -> DataFrame:
    """Sum of base rate times rate per scheme; above zero means a floating rate."""
    return values.groupBy("scheme_id").agg(
        F.sum(F.coalesce("base_rate_id", F.lit(0)) * F.coalesce("rate", F.lit(0))).alias("code")
    )


def scheme_facts(values: DataFrame, asof: date) -> DataFrame:
    """Rate on the date and floating code of every percent scheme, in one reading of the values."""
    day = F.col("value_date") <= F.lit(asof).cast("date")
    last = F.max(F.when(day, F.struct("value_date", "seq", "rate")))
    code = F.sum(F.coalesce("base_rate_id", F.lit(0)) * F.coalesce("rate", F.lit(0)))
    return values.groupBy("scheme_id").agg(last["rate"].alias("rate"), code.alias("code"))


def register_rest(registers: DataFrame, rests: DataFrame, register_type: int, asof: date) -> DataFrame:
    """Closing balance of the contract registers of one type, summed per contract."""
    wanted = cut(
        registers.filter((F.col("register_type_id") == register_type) & F.col("contract_id").isNotNull()).select("register_id", "contract_id")
    )
    # Registers of one type are few: only their history is reduced.
    rests = history_of(rests.select("register_id", "oper_day", "rest_out"), wanted, "register_id")
    last = latest_by_day(rests, "register_id", "oper_day", asof)
    return (
        wanted.join(last, "register_id")
        .groupBy("contract_id")
        .agg(F.sum("rest_out").cast("decimal(18,2)").alias("amount"))
    )


def division_code(divisions: DataFrame) -> DataFrame:
    """Division dictionary with its code."""
    return divisions.select("division_id", F.col("code").alias("division_code"))


def pledge_chains(links: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Chains of subsequent pledges from ``pledge_id, prev_pledge_id, switch_date``: base and level, and the pledges whose chain is a cycle.

    A pledge that follows itself over others has no base; it is left out of the series and reported with the cycle it is on or leads into.
    """
    roots, cycles = resolve_chains(links.select("pledge_id", "prev_pledge_id"), "pledge_id", "prev_pledge_id")
    series = links.select("pledge_id", "switch_date").join(
        roots.select("pledge_id", F.col("root").alias("base_id"), F.col("level").cast("int").alias("level")), "pledge_id"
    )
    return series, cycles


def pledge_series(links: DataFrame) -> DataFrame:
    """The chains of ``pledge_chains``."""
    return pledge_chains(links)[0]


def bank_code(src: Mapping[str, DataFrame]) -> int | None:
    """The bank's own code, one value of the configuration."""
    return src["config"].filter(F.col("name") == "InternalBankCode").agg(F.max("integer_value")).first()[0]
