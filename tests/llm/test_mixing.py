"""Mixing sources to target weights."""

import collections
import hashlib
from fractions import Fraction

import pytest
from plain import WORD
from pyspark.sql import functions as F

from snapbook.llm import mixing
from snapbook.llm.queries import QUERIES


def plain_targets(sizes, budget, weights=(1, 2, 3), passes=3):
    """Share, stop what is above, share the rest again, until none is above. ``sizes`` is in source order."""
    share = [weights[i % len(weights)] for i in range(len(sizes))]
    stopped = set()
    while True:
        left = budget - sum(passes * sizes[i] for i in stopped)
        open_weight = sum(w for i, w in enumerate(share) if i not in stopped)
        found = [Fraction(passes * n) if i in stopped else Fraction(left * share[i], open_weight) for i, n in enumerate(sizes)]
        above = {i for i, n in enumerate(sizes) if found[i] > passes * n}
        if not above:
            return found
        stopped |= above


def plain_mix(rows, passes=3):
    """Bag of (id, size, source size, target, taken) of rows (id, text, source)."""
    sized = [(i, len(WORD.findall(t or "")), s) for i, t, s in rows]
    names = sorted({s for _, _, s in sized if s is not None}) + [None] * any(s is None for _, _, s in sized)
    totals = [sum(n for _, n, s in sized if s == name) for name in names]
    budget = sum(totals)
    targets = [float(t) for t in plain_targets(totals, budget)]
    mixed = lambda i: hashlib.md5(("mix" if i is None else f"mix:{i}").encode()).hexdigest()
    copies = []
    for number, name in enumerate(names):
        own = sorted((k for k, r in enumerate(sized) if r[2] == name), key=lambda k: (mixed(sized[k][0]), sized[k][0] is not None, sized[k][0] or 0, sized[k][1]))
        handed = 0
        for turn in range(passes):
            for k in own:
                handed += sized[k][1]
                if sized[k][1] and targets[number]:
                    copies.append((handed / targets[number], number, handed, k))
    taken, position = collections.Counter(), 0
    for *_, k in sorted(copies):
        position += sized[k][1]
        if 2 * position - sized[k][1] <= 2 * budget:
            taken[k] += 1
    at = dict(zip(names, zip(totals, targets)))
    return collections.Counter((i, n, *at[s], n * taken[k]) for k, (i, n, s) in enumerate(sized))


def bag(df):
    return collections.Counter(tuple(r[c] for c in ("doc_id", "size", "source_size", "target", "taken")) for r in df.collect())


def test_mix_against_plain(spark, edge_docs, edge_rows):
    docs = edge_docs.withColumn("source", F.when(F.col("doc_id") % 3 == 0, "b").when(F.col("doc_id") % 3 == 1, "é").when(F.col("doc_id") > 4, "B"))
    source = lambda i: None if i is None else {0: "b", 1: "é"}.get(i % 3 if i >= 0 else -(-i % 3), "B" if i > 4 else None)
    assert bag(mixing.Mix(docs).documents()) == plain_mix([(i, t, source(i)) for i, t in edge_rows])


def test_whole_table_against_plain(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text", "source").collect()]
    assert bag(QUERIES["op11_mixing"](spark, sf_dir)) == plain_mix(rows)


@pytest.mark.parametrize("sizes", [[5], [1, 1, 100], [100, 1, 1], [0, 7, 3], [3, 0], [10, 20, 30, 1, 2, 3, 0, 500]])
def test_targets_stop_and_share_again(spark, sizes):
    frame = spark.createDataFrame([(chr(97 + i), n) for i, n in enumerate(sizes)], "source string, source_size long")
    got = {r["source"]: r["target"] for r in mixing.source_targets(frame, sum(sizes)).collect()}
    assert [got[chr(97 + i)] for i in range(len(sizes))] == pytest.approx([float(t) for t in plain_targets(sizes, sum(sizes))])


def test_hot_source_and_targets(spark):
    rows = [(i, "w " * (1 + i % 9), "hot" if i % 3 else f"s{i % 7}") for i in range(3000)]
    found = mixing.Mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).documents()
    by = found.groupBy("source").agg(F.sum("taken").alias("taken"), F.max("target").alias("target"), F.max("size").alias("largest")).collect()
    assert len(by) == 8 and all(abs(r["taken"] - r["target"]) <= r["largest"] for r in by)
    assert found.filter("taken > 3 * size or taken % size <> 0").count() == 0


def test_schedule_is_the_mix_in_order(spark, sf_dir):
    mix = mixing.Mix(spark.read.parquet(f"{sf_dir}/documents.parquet"), budget=5000)
    rows = sorted(mix.schedule().collect(), key=lambda r: r["position"])
    at = 0
    for r in rows:
        assert r["position"] == at
        at += r["size"]
    assert [r["finish"] for r in rows] == sorted(r["finish"] for r in rows)
    assert 4000 < at <= 5000 + max(r["size"] for r in rows) / 2
    taken = collections.Counter()
    for r in rows:
        taken[r["doc_id"]] += r["size"]
    assert {r["doc_id"]: r["taken"] for r in mix.documents().collect() if r["taken"]} == taken


def test_nothing_to_mix(spark, no_docs):
    empty = mixing.Mix(no_docs)
    assert empty.documents().count() == empty.schedule().count() == 0
    blank = mixing.Mix(spark.createDataFrame([(1, " ", "a"), (2, None, None)], "doc_id long, text string, source string"))
    assert bag(blank.documents()) == {(1, 0, 0, 0.0, 0): 1, (2, 0, 0, 0.0, 0): 1} and blank.schedule().count() == 0


def test_word_counts(spark):
    texts = [None, "", " \n", "w", "ww w", "\x0ba\x0cb ", "a b c d", "x" * 100_000 + " y"]
    got = [r["n"] for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i").select(mixing.count_words(F.col("t")).alias("n")).collect()]
    assert got == [len(WORD.findall(t or "")) for t in texts]


def test_no_python_in_the_plan(spark, sf_dir):
    plan = QUERIES["op11_mixing"](spark, sf_dir)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))
