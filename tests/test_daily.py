"""A whole day published, published again, narrowed to one contract, and with a failing source."""

from datetime import date

from pyspark.sql import functions as F

from snapbook import RunContext
from snapbook.plans import daily, loan, routines
from snapbook.session import new_folder
from snapbook.sources.slices import SliceStore
from snapbook.sources.tables import Sources
from workload.queries import D, loan_frames
from workload.standins import StandIns

CTX = RunContext(D, source="Test")


def counts(steps):
    return {r.target: (r.status, r.record_count, r.error_message) for r in steps.collect()}


def test_publish_day(spark, sf_dir):
    src = loan_frames(StandIns(spark, sf_dir))
    store = SliceStore(spark, new_folder(spark, "day"))
    first = counts(daily.publish_day(src, CTX, store, today=D))
    assert len(first) == 15 and all(status == 1 for status, _, _ in first.values()), first
    assert first["loan"][1] == store.read("loan", "Test", D).count() > 0
    assert store.read("account", "Test", D).groupBy("oid", "account_type").count().filter("count > 1").isEmpty()

    again = counts(daily.publish_day(src, CTX, store, only=("loan", "portfolio", "schedule"), today=D))
    assert {n: again[n] for n in again} == {n: first[n] for n in again}

    some = store.read("loan", "Test", D).filter(F.col("main_contract_oid").isNull()).orderBy("oid").first().oid
    narrowed = counts(daily.publish_day(src, RunContext(D, source="Test", object_id=some), store, only=("loan", "account"), today=D))
    assert narrowed == {n: first[n] for n in ("loan", "account")}

    broken = StandIns(spark, sf_dir, **{k: v for k, v in src.items() if k != "schedule"})
    broken["schedule"] = src["contract"]
    failed = counts(daily.publish_day(broken, CTX, store, only=("schedule", "client"), today=D))
    assert failed["schedule"][0] == 0 and failed["schedule"][2] and failed["client"][0] == 1
    assert store.read("schedule", "Test", D).count() == first["schedule"][1]
    assert daily.last_run_log(store).select("target").distinct().count() == 2


# Tables of the loan system that a day needs; overdue dates, qualities and pledge chains come from their definitions.
def stored(spark, sf_dir, folder):
    src = StandIns(spark, sf_dir)
    for name in SOURCE_TABLES:
        src[name].write.parquet(f"{folder}/{name}.parquet")
    return Sources(spark, folder)


SOURCE_TABLES = (
    "account account_register_link account_type activity agreement_history back_type_office base_account base_contract branch client collateral_type config "
    "contract contract_revision contract_sum currency customer division external_system guarantee_event issue legal_person loan_contract loan_program "
    "loan_purpose movement operation overdue_balance pledge pledge_assessment pledge_chain pledge_conclusion pledge_contract pledge_link pledge_link_history "
    "pledge_object pledge_owner pledge_quality portfolio portfolio_back_type portfolio_criteria portfolio_history product product_type register register_rest "
    "register_type register_type_link risk_change risk_group schedule scheme_value status_history surety transaction"
).split()


def test_a_day_from_stored_tables(spark, sf_dir):
    folder = new_folder(spark, "tables")
    src = stored(spark, sf_dir, folder)
    assert "contract" in src and "contract_fact_end" not in src and "overdue" not in src
    store = SliceStore(spark, new_folder(spark, "day"))
    steps = counts(daily.publish_day(src, CTX, store, today=D))
    assert len(steps) == 15 and all(status == 1 for status, _, _ in steps.values()), steps
    given = SliceStore(spark, new_folder(spark, "day"))
    expected = counts(daily.publish_day(loan_frames(StandIns(spark, sf_dir)), CTX, given, only=("loan", "guarantee")))
    assert {n: steps[n] for n in expected} == expected


def test_fact_end_frame_given_or_default(spark, sf_dir):
    src = loan_frames(StandIns(spark, sf_dir))
    plain = loan.eligible_contracts(src, CTX)
    src["contract_fact_end"] = routines.fact_end(src)
    assert sorted(map(str, loan.eligible_contracts(src, CTX).collect())) == sorted(map(str, plain.collect()))
    src["contract_fact_end"] = routines.fact_end(src).withColumn("fact_end", F.date_add(F.lit(D), 1000))
    assert loan.eligible_contracts(src, CTX).filter("actual_status = 2 and fact_close_date <> date'1998-06-30'").isEmpty()


def test_repeated_keys_fail_the_step(spark, sf_dir):
    src = loan_frames(StandIns(spark, sf_dir))
    store = SliceStore(spark, new_folder(spark, "day"))
    first = counts(daily.publish_day(src, CTX, store, only=("client",)))
    src["client"] = src["client"].unionByName(src["client"].limit(3))
    failed = counts(daily.publish_day(src, CTX, store, only=("client",)))
    assert failed["client"][0] == 0 and "repeated key oid" in failed["client"][2]
    assert store.read("client", "Test", D).count() == first["client"][1]


def test_log_rows_and_retention(spark, sf_dir):
    src = loan_frames(StandIns(spark, sf_dir))
    store = SliceStore(spark, new_folder(spark, "day"))
    broken = StandIns(spark, sf_dir, client=src["contract"])
    steps = daily.publish_day(broken, CTX, store, only=("segment", "client")).collect()
    failed = next(r for r in steps if r.target == "client")
    assert failed.status == 0 and failed.error_proc.startswith("UNRESOLVED_COLUMN")
    assert len({r.step_id for r in steps}) == 2 and all(len(r.step_id) == 64 for r in steps)
    # The reporting date lies more than a year back, so the run is not kept.
    assert spark.read.parquet(f"{store.root}/_run_log").count() == 0
    recent = RunContext(date.today(), source="Test")
    daily.publish_day(src, recent, store, only=("segment",))
    daily.publish_day(src, CTX, store, only=("segment",))
    assert [r.for_date for r in spark.read.parquet(f"{store.root}/_run_log").collect()] == [recent.asof]
    assert spark.read.parquet(f"{store.root}/_step_log").count() == 1
