"""The corpus pipeline and the registered queries."""

import re

import numpy as np
import pytest
from plain import repeated_words, similar

import __spark_entry__ as entry
import corpus_pipeline
from snapbook.llm import queries, quality, segments
from snapbook.llm.oracle import ORACLE
from snapbook.llm.shared import cut
from tools.compare import compare, connect


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    docs, kept = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for _, stage in corpus_pipeline.STAGES:
        docs = cut(stage(spark, docs, sf_dir))
        kept.append(docs)
    return kept


def ids(df):
    return sorted(r["doc_id"] for r in df.select("doc_id").collect())


def test_stages_against_plain_versions(spark, sf_dir, stages, small_docs):
    kept = quality.NAMES.index("kept")
    rows = [(i, t) for i, t in small_docs if quality.measure(t)[kept]]
    assert ids(stages[0]) == sorted(i for i, _ in rows)
    rows = [r for r, (i, size, c) in zip(rows, similar(rows), strict=True) if c == i or not size]
    assert ids(stages[1]) == sorted(i for i, _ in rows)
    left = {i: n - gone for i, n, gone, _ in repeated_words(rows) if n > gone}
    assert {r["doc_id"]: len(r["text"].split()) for r in stages[2].collect()} == left
    word = re.compile(r"[^\W_]+")
    quotes = [" " + " ".join(word.findall(r["text"].lower())) + " " for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    clean = [r["doc_id"] for r in stages[2].collect() if not any(q in " " + " ".join(word.findall(r["text"].lower())) + " " for q in quotes)]
    assert ids(stages[3]) == sorted(clean)
    model = segments.pieces(queries.tokenizer_path("piece_bpe_32k.model"))
    texts = {r["doc_id"]: r["text"] for r in stages[3].collect()}
    encoded = stages[4].collect()
    assert {r["doc_id"] for r in encoded} == set(texts)
    assert all(model.decode(np.frombuffer(r["pieces"], "<u2")) == texts[r["doc_id"]] for r in encoded)


def test_columns_stay(spark, sf_dir, stages):
    columns = spark.read.parquet(f"{sf_dir}/documents.parquet").columns
    assert all(s.columns == columns for s in stages[:-1])
    assert all(r["n_chars"] == len(r["text"]) for r in stages[3].collect())


def test_edges_run_through(spark, sf_dir, edge_docs, no_docs):
    for docs in (edge_docs, no_docs):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = cut(stage(spark, docs, sf_dir))
            assert docs.columns == edge_docs.columns


def test_registered():
    names = entry.queries()
    assert {f"op{n}" for n in range(1, 11)} <= {name.split("_")[0] for name in names} and "pipeline" in names


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, sf_dir, name):
    assert compare(spark, connect(sf_dir), sf_dir, name) is None
