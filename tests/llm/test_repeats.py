"""Repeated words, repeated bytes and similar documents against plain versions."""

import inspect

import pytest
from plain import prose, repeated_bytes, repeated_words, similar
from pyspark.sql import functions as F

from snapbook.llm import debruijn, jaccard, suffixes


def rows_of(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.select(*columns).collect()), key=repr)


def check(df, expected, *columns):
    assert rows_of(df, *columns) == sorted(expected, key=repr)


WORD_COLUMNS = ("doc_id", "n_words", "n_removed", "kept_sha256")
BYTE_COLUMNS = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
SET_COLUMNS = ("doc_id", "n_shingles", "component_id")


def test_repeated_words_edges(edge_docs, edge_rows):
    check(debruijn.RepeatedWords(edge_docs).summary(), repeated_words(edge_rows), *WORD_COLUMNS)


def test_repeated_words_small(spark, sf_dir, small_docs):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").repartition(7)
    check(debruijn.RepeatedWords(docs).summary(), repeated_words(small_docs), *WORD_COLUMNS)


def test_passage_repeated_inside_a_later_document(spark):
    """A passage of an earlier text stands twice or more in one later text, with the same words around it each time."""
    passage = prose(300, 80)
    part = f"{prose(301, 60)} {passage} {prose(302, 60)} "
    own = f"{prose(303, 70)} {passage} {prose(304, 70)} "
    rows = [(1, f"{prose(305, 60)} {passage} {prose(306, 60)}"), (2, part * 2), (3, part * 3 + prose(307, 40)), (4, own * 2), (4, own + prose(308, 60)), (None, own * 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    check(debruijn.RepeatedWords(docs).summary(), repeated_words(rows), *WORD_COLUMNS)


def test_spans_point_at_equal_words(edge_docs, edge_rows):
    run = debruijn.RepeatedWords(edge_docs)
    texts = {r["content"]: r["text"].split() for r in run.texts.collect()}
    spans = run.spans.collect()
    assert spans
    for s in spans:
        size = s["end"] - s["begin"]
        assert size >= debruijn.WINDOW
        assert texts[s["content"]][s["begin"] : s["end"]] == texts[s["source"]][s["source_begin"] : s["source_begin"] + size]


def test_remaining_text(edge_docs, edge_rows):
    run = debruijn.RepeatedWords(edge_docs)
    left = run.remaining(edge_docs, length="n_chars")
    assert left.columns == edge_docs.columns
    got = sorted((repr(r["doc_id"]), " ".join((r["text"] or "").split()), r["n_chars"]) for r in left.collect())
    lost = {(i, n): gone for (i, n, gone, _) in repeated_words(edge_rows)}
    texts = [r[1] for r in got]
    assert len(got) == sum(1 for (i, n, gone, _) in repeated_words(edge_rows) if not gone or gone < n)
    assert all(n is None or n >= len(t) for _, t, n in got)
    assert any(gone for gone in lost.values()) and all(t is not None for t in texts)


def test_repeated_bytes_edges(edge_docs, edge_rows):
    check(suffixes.RepeatedBytes(edge_docs).summary(), repeated_bytes(edge_rows), *BYTE_COLUMNS)


def test_repeated_bytes_split_anchors(edge_docs, edge_rows, spark, sf_dir, small_docs, monkeypatch):
    """Anchors dealt out to several shards and merged again."""
    monkeypatch.setattr(suffixes, "HOT", 1)
    check(suffixes.RepeatedBytes(edge_docs).summary(), repeated_bytes(edge_rows), *BYTE_COLUMNS)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").repartition(6)
    check(suffixes.RepeatedBytes(docs).summary(), repeated_bytes(small_docs), *BYTE_COLUMNS)


def test_similar_edges(edge_docs, edge_rows):
    check(jaccard.similar_components(edge_docs), similar(edge_rows), *SET_COLUMNS)


def test_similar_in_small_blocks(spark, sf_dir, small_docs, monkeypatch):
    """No star rounds to speak of and blocks of two nodes: the tiles do the work."""
    monkeypatch.setattr(jaccard, "BLOCK", 2)
    monkeypatch.setattr(jaccard, "star_pairs", lambda groups, turn: groups.selectExpr("node as a", "node as b").limit(0))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").repartition(6)
    check(jaccard.similar_components(docs), similar(small_docs), *SET_COLUMNS)


def test_keep_one(edge_docs, edge_rows):
    left = jaccard.keep_one(edge_docs)
    assert left.columns == edge_docs.columns
    rows = left.collect()
    component = {}
    for (i, t), (_, size, c) in zip(edge_rows, similar(edge_rows), strict=True):
        component.setdefault((i, t), (size, c))
    kept = [component[r["doc_id"], r["text"]][1] for r in rows if component[r["doc_id"], r["text"]][0]]
    # one row for each component; two components share the id 12 and one the missing id
    assert len(kept) == len({(i, t) for (i, t), (size, c) in component.items() if size and c == i})
    assert sum(component[r["doc_id"], r["text"]][0] == 0 for r in rows) == 3


@pytest.mark.parametrize("make", [
    lambda d: debruijn.RepeatedWords(d).summary(), lambda d: suffixes.RepeatedBytes(d).summary(), jaccard.similar_components, jaccard.keep_one,
    lambda d: debruijn.RepeatedWords(d).remaining(d, length="n_chars"),
])
def test_empty_tables(no_docs, make):
    assert make(no_docs).collect() == []


def test_merge_of_one_anchor_is_spread(spark):
    """Windows kept by the parts of one anchor meet in many tasks, not in one for each anchor."""
    text = prose(320, 90).encode()
    data = [text[10 * k % 300 : 10 * k % 300 + 130] for k in range(60)]
    rows = [(0, 5, k // 2, k // 2 + 1000, 40 * (k % 2), 40 * (k % 2) + 30, d) for k, d in enumerate(data)]
    kept = spark.createDataFrame(rows, "shard int, anchor long, owner long, content long, first long, last long, data binary").repartition(3)
    least, begin, expected = {}, {}, set()
    windows = [(d[i : i + 100], o, c, a + i) for _, _, o, c, a, _, d in rows for i in range(31)]
    for w, o, c, at in windows:
        least[w], begin[w, c] = min(least.get(w, o), o), min(begin.get((w, c), at), at)
    expected = {(c, at) for w, o, c, at in windows if o > least[w] or at > begin[w, c]}
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        args = (kept, 4) if "shards" in inspect.signature(suffixes.merged_runs).parameters else (kept,)
        got = suffixes.merged_runs(*args).withColumn("task", F.spark_partition_id()).collect()
    finally:
        spark.conf.set(key, before)
    assert expected and {(r["content"], r["first"]) for r in got} == expected
    assert len({r["task"] for r in got}) > 1
