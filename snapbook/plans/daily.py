"""One day's publication: every dataset as a slice, later ones reading earlier ones, with an audit row per step."""

from __future__ import annotations

import uuid
from collections import ChainMap
from collections.abc import Callable, Mapping
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, functions as F

from snapbook.context import RunContext
from snapbook.operators.lookups import drop_existing
from snapbook.plans import account, cession, client, dictionaries, guarantee, loan, pledge, portfolio, routines, schedule
from snapbook.session import cut
from snapbook.sources import audit
from snapbook.sources.carried import CarriedBalances
from snapbook.sources.slices import SliceStore

# Dataset and whether its slice is dated, in the order of publication.
STEPS = (
    ("loan_type", False), ("account_type", True), ("loan_product", False), ("yul_segment", False), ("segment", False),
    ("schedule_type", False), ("pledge_type", False), ("guarantee_type", False), ("loan", True), ("guarantee", True),
    ("portfolio", True), ("account", True), ("schedule", True), ("client", True), ("pledge", True),
)

# Columns that tie a row to the object a narrowed run is about.
OBJECT_COLUMNS = {
    "loan": ("oid", "main_contract_oid"), "guarantee": ("oid",), "portfolio": ("oid",), "account": ("contract_oid",),
    "schedule": ("contract_oid",), "client": ("oid",), "pledge": ("contract_oid",),
}

# What identifies a row of a slice.
IDENTITY = {
    "loan": ["oid"], "guarantee": ["oid"], "portfolio": ["oid"], "account": ["oid", "account_type"], "schedule": ["contract_oid"],
    "client": ["oid"], "pledge": ["contract_oid", "pledge_oid"],
}


# Keys that a slice holds once; a step that makes one twice fails and leaves the old slice.
UNIQUE = {"account": ["oid", "account_type"], "client": ["oid"]}

# How long log rows are kept, in months before the reporting date.
LOG_MONTHS = 12


def checked(df: DataFrame, name: str) -> DataFrame:
    """The rows of a dataset, written once, after a look for repeated keys: one aggregate with map-side counts."""
    keys = UNIQUE.get(name)
    if keys is None:
        return df
    fresh = cut(df)
    twice = fresh.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n").limit(3).collect()
    if twice:
        raise ValueError(f"{name}: repeated key {', '.join(keys)}: {[tuple(r) for r in twice]}")
    return fresh


def builders(src: Mapping[str, DataFrame], ctx: RunContext, store: SliceStore) -> dict[str, Callable[[], DataFrame]]:
    """How to make each dataset; dependent ones read the slice published before them.

    Facts that are not given come from their default definitions.
    """
    spark, src = store.spark, routines.Facts(src, ctx.asof)
    published = lambda name: store.read(name, ctx.source, ctx.asof)
    return {
        "loan_type": lambda: dictionaries.loan_type(src, ctx),
        "account_type": lambda: dictionaries.account_type(src, ctx),
        "loan_product": lambda: dictionaries.loan_product(src, ctx),
        "yul_segment": lambda: dictionaries.yul_segment(spark, ctx),
        "segment": lambda: dictionaries.segment(spark, ctx),
        "schedule_type": lambda: dictionaries.schedule_type(spark, ctx),
        "pledge_type": lambda: dictionaries.pledge_type(src, ctx),
        "guarantee_type": lambda: dictionaries.guarantee_type(spark, ctx),
        "loan": lambda: loan.loan_snapshot(src, ctx),
        "guarantee": lambda: guarantee.guarantee_snapshot(src, ctx),
        "portfolio": lambda: portfolio.portfolio_snapshot(src, ctx),
        "account": lambda: account.account_snapshot(src, ctx, published("loan"), published("guarantee")).unionByName(
            cession.disposal_rows(src, ctx)),
        "schedule": lambda: schedule.schedule_snapshot(src, ctx, published("loan")),
        "client": lambda: client.client_snapshot(src, ctx),
        "pledge": lambda: pledge.pledge_snapshot(src, ctx, published("loan")),
        "pledge_reject": lambda: src["pledge_reject"],
    }


def _publish(df: DataFrame, name: str, dated: bool, ctx: RunContext, store: SliceStore) -> int:
    if not dated:
        return store.replace(df, name, ctx.source)
    if ctx.object_id is None or name not in OBJECT_COLUMNS or not store.exists(name):
        return store.replace(df, name, ctx.source, ctx.asof)
    # A run about one object keeps the other rows of the slice. Rows it makes besides the object's own (its
    # tranches, portfolio registers) take the place of their former selves.
    fresh = cut(df)
    mine = F.lit(False)
    for col in OBJECT_COLUMNS[name]:
        mine = mine | (F.col(col) == ctx.object_id)
    kept = store.read(name, ctx.source, ctx.asof).filter(~F.coalesce(mine, F.lit(False)))
    kept = drop_existing(kept, fresh, IDENTITY[name]).select(*kept.columns)
    return store.append_to([kept, fresh.select(*kept.columns)], name, ctx.source, ctx.asof)


def _rejected(make: Mapping[str, Callable[[], DataFrame]], src: Mapping[str, DataFrame], ctx: RunContext, store: SliceStore) -> None:
    """Publish the pledges without a base beside the pledges. A bank that gives its own series has none."""
    if "pledge_series" not in src and "pledge_chain" in src:
        cycles = make["pledge_reject"]()
        if store.exists("pledge_reject") or not cycles.isEmpty():
            store.replace(cycles, "pledge_reject", ctx.source, ctx.asof)


def publish_day(src: Mapping[str, DataFrame], ctx: RunContext, store: SliceStore,
                only: tuple[str, ...] | None = None, today: date | None = None, carried: CarriedBalances | None = None) -> DataFrame:
    """Publish the datasets of one day and return the step log; a failed step leaves its old slice.

    With ``carried`` balances the day's lookups read the last row per register, brought up to the day first, and not the history; that is a step of its own.
    Rows are counted by the writing job. The log is appended below the store's folder; runs for dates ``LOG_MONTHS`` or
    more before ``today`` (the current date unless given) leave it.
    """
    now = lambda: datetime.now(timezone.utc).replace(tzinfo=None)
    run_id, begun = str(uuid.uuid4()), now()
    log, counts = [], []
    instead: dict[str, DataFrame] = {}
    make = builders(ChainMap(instead, src), ctx, store)

    def do(name: str, dated: bool) -> int:
        if carried is not None and name == carried.name:
            rows = carried.advance(ctx.asof)
            instead["register_rest"] = carried.rows(ctx.asof)
            return rows
        rows = _publish(checked(make[name](), name), name, dated, ctx, store)
        if name == "pledge":
            _rejected(make, src, ctx, store)
        return rows

    for number, (name, dated) in enumerate(STEPS if carried is None else ((carried.name, True), *STEPS), start=1):
        if only is not None and name not in only:
            continue
        start, status, error = now(), 1, (None, None)
        try:
            counts.append((name, do(name, dated)))
        except Exception as problem:  # the step is reported as failed and the run goes on
            status, error = 0, (audit.error_class(problem), str(problem)[:1024])
        log.append((run_id, number, name, start, now(), status, None, *error))
    raw = store.spark.createDataFrame(log, audit.RAW_STEP_SCHEMA)
    steps = cut(audit.step_audit(raw, store.spark.createDataFrame(counts, "target string, row_count bigint")))
    runs = store.spark.createDataFrame([(run_id, 0, ctx.asof, begun)], audit.RUN_SCHEMA)
    kept = audit.RunLog(store.spark, store.root)
    kept.append(run_id, runs, steps)
    kept.retain(LOG_MONTHS, today or now().date())
    return steps


def last_run_log(store: SliceStore) -> DataFrame:
    """Steps of the last run of every reporting date."""
    kept = audit.RunLog(store.spark, store.root)
    return audit.last_runs(kept.runs(), kept.steps())
