"""Building the source tables: nothing is moved for nothing, and no task's share grows with the tables."""

from datetime import datetime, timedelta

import pytest

import workload.standins as standins
from snapbook import configure, session
from snapbook.sources import tables
from workload.standins import STAGED, VIEWS, StandIns


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    """Line items and parts with repeated rows, null keys, amounts and dates, and one order with many lines."""
    folder = str(tmp_path_factory.mktemp("odd"))
    day = datetime(1998, 6, 1)
    lines = [(i % 7 if i % 3 else 1, i % 5, i % 4, None if i % 11 == 0 else i % 6, float(i), i * 1.37 if i % 13 else None, (i % 10) / 100, 0.01, "N", "O",
              None if i % 17 == 0 else day + timedelta(days=i % 9)) for i in range(200)]
    lines += lines[:20] + [(None, None, 1, 1, 1.0, 2.5, 0.1, 0.0, "N", "O", day)]
    names = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    spark.createDataFrame(lines, names).repartition(6).write.parquet(f"{folder}/lineitem.parquet")
    parts = [(i, f"n{i}", f"Brand#{i % 2}" if i else None, "t", i, 1.0) for i in range(5)]
    spark.createDataFrame(parts + parts[:1], "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double").coalesce(1).write.parquet(f"{folder}/part.parquet")
    return folder


def test_balances_dealt_out_by_register_are_the_view(spark, odd):
    s = StandIns(spark, odd)
    view = spark.sql(VIEWS["register_rest"], lineitem=s.raw("lineitem"), part=s.raw("part"))
    assert s["register_rest"].schema == view.schema
    assert rows_of(s["register_rest"]) == rows_of(view)


def test_the_history_is_moved_once(spark, odd, monkeypatch):
    frames = {}
    monkeypatch.setattr(StandIns, "_stage", lambda self, name, frame: frames.setdefault(name, frame))
    monkeypatch.setattr(standins, "PLACED_BYTES", 1000)
    plan = StandIns(spark, odd)["register_rest"]._jdf.queryExecution().executedPlan().toString()
    # The sums of portfolio registers have an exchange of few rows below the one by register; above it there is none.
    assert plan.count("Exchange hashpartitioning(register_id") == 1
    assert "REPARTITION_BY_NUM" in plan and "REPARTITION_BY_NUM" in plan[plan.index("Exchange hashpartitioning(register_id"):].splitlines()[0]
    files = [f for n in ("lineitem", "part") for f in StandIns(spark, odd).raw(n).inputFiles()]
    assert f", {-(-session.bytes_of(spark, files) // 1000)})" in plan


def test_plain_columns_are_read_where_they_are(spark, odd):
    assert not {"entry", "contract", "guarantee_event", "pledge_link_history"} & set(STAGED)
    assert {"register_rest", "issue", "risk_change", "loan_slice"} <= set(STAGED)
    assert all("lineitem.parquet" in f for f in StandIns(spark, odd)["entry"].inputFiles())


def test_only_small_input_is_dealt_out(spark, odd, monkeypatch):
    """Few files are spread over the cores while they are small; larger ones are split by the scan and not moved."""
    seen = []
    frame = spark.read.parquet(f"{odd}/part.parquet")
    monkeypatch.setattr(type(frame), "repartition", lambda self, *a: seen.append(a) or self)
    for limit, moved in ((1 << 20, 1), (1, 0)):
        seen.clear()
        monkeypatch.setattr(standins, "SPREAD_BYTES", limit)
        StandIns(spark, odd)._stage(f"try{limit}", frame)
        assert len(seen) == moved


def test_buckets_follow_the_size(spark, odd, monkeypatch):
    frame = spark.read.parquet(f"{odd}/lineitem.parquet")
    assert tables.bucket_count(frame) == spark.sparkContext.defaultParallelism
    size = session.bytes_of(spark, frame.inputFiles())
    monkeypatch.setattr(tables, "BUCKET_BYTES", size // 50)
    assert tables.bucket_count(spark.read.parquet(f"{odd}/part.parquet"), frame) >= 50


def test_scans_are_cut_small(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for given, kept in (("128m", session.SCAN_BYTES), ("1m", 1 << 20)):
            spark.conf.set("spark.sql.files.maxPartitionBytes", given)
            configure(spark)
            assert spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes() == kept
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
