"""Slice replacement: idempotent, local to its slice, and right for empty results."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from snapbook.session import new_folder, sub_folders
from snapbook.sources import slices
from snapbook.sources.slices import DATED, SliceStore, StaleWriter

D1, D2 = date(1998, 6, 29), date(1998, 6, 30)


@pytest.fixture
def store(spark):
    return SliceStore(spark, new_folder(spark, "store"))


def frame(spark, *ids):
    return spark.createDataFrame([(i, f"n{i}") for i in ids], "oid string, number string")


def content(store, name="loan"):
    return sorted((r.source, r.date1, r.oid) for r in store.read(name).collect())


def test_replace_twice_gives_the_same_rows_and_leaves_others(spark, store):
    assert store.replace(frame(spark, "a", "b"), "loan", "S", D1) == 2
    store.replace(frame(spark, "x"), "loan", "S", D2)
    store.replace(frame(spark, "y"), "loan", "T", D1)
    for _ in range(2):
        assert store.replace(frame(spark, "c"), "loan", "S", D1) == 1
    assert content(store) == [("S", D1, "c"), ("S", D2, "x"), ("T", D1, "y")]


def test_empty_result_empties_the_slice(spark, store):
    store.replace(frame(spark, "a"), "loan", "S", D1)
    store.replace(frame(spark, "b"), "loan", "S", D2)
    assert store.replace(frame(spark, "z").filter("false"), "loan", "S", D1) == 0
    assert content(store) == [("S", D2, "b")]


def test_failed_job_leaves_the_old_slice(spark, store):
    store.replace(frame(spark, "a"), "loan", "S", D1)
    bad = frame(spark, "b").withColumn("number", F.raise_error(F.lit("boom")))
    with pytest.raises(Exception):
        store.replace(bad, "loan", "S", D1)
    assert content(store) == [("S", D1, "a")]


def test_objects_predicates_and_ranges(spark, store):
    store.replace(frame(spark, "a", "b", "c"), "loan", "S", D1)
    store.replace_objects(frame(spark, "a").withColumn("number", F.lit("new")), "loan", "S", D1, "oid", ["a", "b"])
    assert sorted((r.oid, r.number) for r in store.read("loan").collect()) == [("a", "new"), ("c", "nc")]
    store.replace(frame(spark, "d").withColumn("number", F.lit(None).cast("string")).unionByName(frame(spark, "e")), "loan", "S", D2)
    store.delete_where("loan", "S", D2, F.col("number") == "ne")
    assert content(store) == [("S", D1, "a"), ("S", D1, "c"), ("S", D2, "d")]
    assert store.clear_range(DATED, "S", D2, D1) == []
    assert store.clear_range(DATED, "S", D1, D1) == [("loan", D1)]
    assert content(store) == [("S", D2, "d")]
    counts = {r.dataset: r.row_count for r in store.counts(["loan"], "S", D1).collect()}
    assert counts == {"loan": 0}


def test_reading_one_slice_prunes_partitions(spark, store):
    store.replace(frame(spark, "a"), "loan", "S", D1)
    store.replace(frame(spark, "b"), "loan", "S", D2)
    plan = store.read("loan", "S", D2)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(source" in plan and "date1" in plan.split("PartitionFilters")[1].split("]")[0]


def test_source_tag_must_fit_a_folder(spark, store):
    with pytest.raises(ValueError):
        store.replace(frame(spark, "a"), "loan", "a/b", D1)


@pytest.mark.parametrize("tags", [["007"], ["1e3"], ["2024-01-01"], ["007", "A", "1e3"], ["7", "007"]])
def test_tags_keep_their_spelling(spark, store, tags):
    for tag in tags:
        store.replace(frame(spark, "a", "b"), "loan", tag, D1)
    for tag in tags:
        assert [r.source for r in store.read("loan", tag).collect()] == [tag, tag]
        store.replace_objects(frame(spark, "a").withColumn("number", F.lit("new")), "loan", tag, D1, "oid", ["a"])
        assert sorted((r.oid, r.number) for r in store.read("loan", tag, D1).collect()) == [("a", "new"), ("b", "nb")]
        store.replace_matching(frame(spark, "b"), "loan", tag, D1, "oid", frame(spark, "b"))
        store.delete_where("loan", tag, D1, F.col("oid") == "a")
        assert [r.oid for r in store.read("loan", tag, D1).collect()] == ["b"]


def test_the_wrong_form_is_refused_before_anything_is_written(spark, store):
    store.replace(frame(spark, "a"), "loan", "S", D1)
    store.replace(frame(spark, "b"), "loan", "S", D2)
    store.replace(frame(spark, "x"), "segment", "S")
    for call in (
        lambda: store.replace(frame(spark, "c"), "loan", "S"), lambda: store.append_to([frame(spark, "c")], "loan", "S"),
        lambda: store.replace(frame(spark, "y"), "segment", "S", D1), lambda: store.delete_where("loan", "S", None, F.lit(True)),
        lambda: store.replace(frame(spark, "c").withColumn("number", F.lit(1)), "loan", "S", D1),
    ):
        with pytest.raises(ValueError):
            call()
    assert content(store) == [("S", D1, "a"), ("S", D2, "b")]
    assert [r.oid for r in store.read("segment").collect()] == ["x"]


def test_a_later_column_is_read_and_kept(spark, store):
    store.replace(frame(spark, "a", "b"), "loan", "S", D1)
    store.replace(frame(spark, "c").withColumn("n2", F.lit(5)), "loan", "S", D2)
    assert sorted((r.oid, r.n2) for r in store.read("loan").collect()) == [("a", None), ("b", None), ("c", 5)]
    store.replace_objects(frame(spark, "a"), "loan", "S", D2, "oid", ["a"])
    store.delete_where("loan", "S", D1, F.col("oid") == "a")
    assert sorted((r.oid, r.n2) for r in store.read("loan").collect()) == [("a", None), ("b", None), ("c", 5)]


def test_a_store_without_declaration_is_read_whole(spark, store):
    for day, ids in ((D1, ["a"]), (D2, ["b"])):
        frame(spark, *ids).withColumn(f"n{day.day}", F.lit(1)).write.parquet(f"{store.root}/loan/source=007/date1={day}")
    assert sorted((r.oid, r.source, r.date1, r.n29, r.n30) for r in store.read("loan").collect()) == [("a", "007", D1, 1, None), ("b", "007", D2, None, 1)]


def test_cleared_slices_leave_no_folder_and_run_no_job(spark, store):
    for day in (D1, D2):
        store.replace(frame(spark, "a"), "loan", "S", day)
    store.replace(frame(spark, "a"), "segment", "S")
    spark.sparkContext.setJobGroup("clearing", "clearing")
    assert store.clear_range([*DATED, "segment"], "S", D1, D2) == [("loan", D1), ("loan", D2)]
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("clearing")) == 0
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert sub_folders(spark, f"{store.root}/loan/source=S") == []
    assert store.read("loan").columns[:2] == ["oid", "number"] and content(store) == []


# publication: all or nothing

def test_a_reader_keeps_the_version_it_began_with(spark, store):
    store.replace(frame(spark, "a", "b"), "loan", "S", D1)
    reader = store.read("loan", "S", D1)
    store.replace(frame(spark, "c"), "loan", "S", D1)
    assert sorted(r.oid for r in reader.collect()) == ["a", "b"]
    assert content(store) == [("S", D1, "c")]


def test_versions_before_the_last_two_go(spark, store):
    for i in range(4):
        store.replace(frame(spark, f"r{i}"), "loan", "S", D1)
    assert len(sub_folders(spark, f"{store.root}/loan/source=S/date1={D1}")) == 2
    assert content(store) == [("S", D1, "r3")] and sub_folders(spark, f"{store.root}/_staging") == []


def test_a_writer_that_began_from_an_older_version_is_refused(spark, store):
    store.replace(frame(spark, "a"), "loan", "S", D1)
    began = store.version("loan", "S", D1)
    store.replace(frame(spark, "b"), "loan", "S", D1)
    with pytest.raises(StaleWriter):
        store.replace(frame(spark, "c"), "loan", "S", D1, since=began)
    with pytest.raises(StaleWriter):
        store.replace(frame(spark, "c").filter("false"), "loan", "S", D1, since=began)
    store.clear(["loan"], "S", D1)
    with pytest.raises(StaleWriter):
        store.replace(frame(spark, "c"), "loan", "S", D1, since=began)
    assert content(store) == [] and store.version("loan", "S", D1) is None
    assert store.replace(frame(spark, "d"), "loan", "S", D1) == 1 and store.version("loan", "S", D1) > began


def test_two_writers_that_look_at_the_same_time_do_not_mix(spark, store, monkeypatch):
    """Both find the slice unchanged; the rename lets one through."""
    store.replace(frame(spark, "a"), "loan", "S", D1)
    began = store.version("loan", "S", D1)
    store.replace(frame(spark, "b"), "loan", "S", D1)
    monkeypatch.setattr(store, "_unchanged", lambda *_: None)
    with pytest.raises(StaleWriter):
        store.replace(frame(spark, "c").withColumn("extra", F.lit(1)), "loan", "S", D1, since=began)
    # Cleared and published anew in between: the older number does not come back either.
    store.clear(["loan"], "S", D1)
    store.replace(frame(spark, "d"), "loan", "S", D1)
    with pytest.raises(StaleWriter):
        store.replace(frame(spark, "e"), "loan", "S", D1, since=began)
    assert content(store) == [("S", D1, "d")] and store.read("loan").columns == ["oid", "number", "source", "date1"]


def test_a_failed_job_with_a_new_column_leaves_rows_and_declaration(spark, store):
    store.replace(frame(spark, "a"), "loan", "S", D1)
    bad = frame(spark, "b").withColumns({"extra": F.lit(1), "number": F.raise_error(F.lit("boom")).cast("string")})
    with pytest.raises(Exception, match="boom"):
        store.replace(bad, "loan", "S", D1)
    assert store.read("loan").columns == ["oid", "number", "source", "date1"] and content(store) == [("S", D1, "a")]
    assert store.replace(frame(spark, "b").withColumn("extra", F.lit("text")), "loan", "S", D1) == 1
    assert [(r.oid, r.extra) for r in store.read("loan").collect()] == [("b", "text")]


def test_a_stop_between_declaration_and_publication_changes_nothing(spark, store, monkeypatch):
    store.replace(frame(spark, "a"), "loan", "S", D1)
    move = slices.move_new

    def stop(spark, source, target):
        if "/v=" in target:
            raise KeyboardInterrupt
        return move(spark, source, target)

    monkeypatch.setattr(slices, "move_new", stop)
    with pytest.raises(KeyboardInterrupt):
        store.replace(frame(spark, "b").withColumn("extra", F.lit(1)), "loan", "S", D1)
    monkeypatch.undo()
    assert store.read("loan").columns == ["oid", "number", "source", "date1"] and content(store) == [("S", D1, "a")]
    # The next one may bring the column with another type.
    store.replace(frame(spark, "c").withColumn("extra", F.lit("x")), "loan", "S", D2)
    assert sorted((r.oid, r.extra) for r in store.read("loan").collect()) == [("a", None), ("c", "x")]


def test_declarers_of_two_slices_both_count(spark, store, monkeypatch):
    """A second declaration takes the number in between; the first looks again and adds its own."""
    store.replace(frame(spark, "a"), "loan", "S", D1)
    put, other = store._put_declaration, SliceStore(spark, store.root)

    def late(name, number, known):
        monkeypatch.setattr(store, "_put_declaration", put)
        other.replace(frame(spark, "b").withColumn("theirs", F.lit(1)), "loan", "S", D2)
        return put(name, number, known)

    monkeypatch.setattr(store, "_put_declaration", late)
    store.replace(frame(spark, "c").withColumn("mine", F.lit(2)), "loan", "T", D1)
    assert sorted((r.oid, r.theirs, r.mine) for r in store.read("loan").collect()) == [("a", None, None), ("b", 1, None), ("c", None, 2)]


def test_a_plain_slice_folder_gives_way_to_a_publication(spark, store):
    frame(spark, "old").write.parquet(f"{store.root}/loan/source=S/date1={D1}")
    frame(spark, "left").write.parquet(f"{store.root}/loan/source=S/date1={D2}")
    store.replace(frame(spark, "new"), "loan", "S", D1)
    assert content(store) == [("S", D1, "new"), ("S", D2, "left")]


def test_notes_travel_with_the_publication(spark, store):
    store.replace(frame(spark, "a", "b"), "loan", "S", D1, note={"from": "x"})
    assert {k: store.note("loan", "S", D1)[k] for k in ("rows", "from")} == {"rows": 2, "from": "x"}
    store.replace(frame(spark, "c"), "loan", "S", D1)
    assert store.note("loan", "S", D1)["rows"] == 1 and "from" not in store.note("loan", "S", D1) and store.note("loan", "S", D2) == {}


def test_all_dates_are_cleared_on_purpose(spark, store):
    for day in (D1, D2):
        store.replace(frame(spark, "a"), "loan", "S", day)
        store.replace(frame(spark, "a"), "loan", "T", day)
    assert store.clear(["loan"], "S", None) == [("loan", D1), ("loan", D2)]
    assert content(store) == [("T", D1, "a"), ("T", D2, "a")]
    assert store.clear_range(["loan"], "T", None, D1) == [("loan", D1)]
