"""Components of near copies: what the first links join is not gone through again."""

import random

from snapbook.llm import graph, jaccard


def test_known_components_stand_for_their_links(spark, monkeypatch):
    rng, base = random.Random(5), [f"w{i}" for i in range(200)]
    docs = []
    for i in range(300):
        words = list(base)
        for _ in range(2):
            words[rng.randrange(200)] = f"x{i}-{rng.randrange(10 ** 9)}"
        docs.append((1000 + i, " ".join(words)))
    docs.append((1, " ".join(f"y{i}" for i in range(50))))
    asked, components = [], jaccard.components
    monkeypatch.setattr(jaccard, "components", lambda links: asked.append(links.count()) or components(links))
    found = jaccard.similar_components(spark.createDataFrame(docs, "doc_id long, text string").repartition(4))
    assert {r["doc_id"]: r["component_id"] for r in found.collect()} == {i: 1000 if i >= 1000 else 1 for i, _ in docs}
    # Several pivots give a node several links; afterwards there is one for each node but the smallest.
    assert asked[0] > 299 and asked[-1] == 299


def test_a_node_meets_few_pivots_first(spark):
    # A group for each pair of nodes next to each other and for all: most nodes are in three groups with pivots of their own.
    rows = [(g, n) for g in range(40) for n in (g, g + 1)] + [(100 + k, n) for k in range(5) for n in range(k, 41)]
    groups = spark.createDataFrame(rows, "gram long, node long")
    pairs = [(r["a"], r["b"]) for r in jaccard.star_pairs(groups, 0).collect()]
    assert 40 <= len(pairs) <= jaccard.FIRST_PIVOTS * 41
    shared = {(a, b) for g in {g for g, _ in rows} for a in (m for h, m in rows if h == g) for b in (m for h, m in rows if h == g)}
    assert set(pairs) <= shared and {n for pair in pairs for n in pair} == set(range(41))


def test_stars_take_one_round(spark, monkeypatch):
    tables, cut = [], graph.cut
    monkeypatch.setattr(graph, "cut", lambda df: tables.append(1) or cut(df))
    links = spark.createDataFrame([(c, c + n) for c in (0, 100) for n in range(1, 20)], "a long, b long")
    found = {r["node"]: r["component"] for r in graph.components(links).collect()}
    assert found == {c + n: c for c in (0, 100) for n in range(1, 20)}
    # The links themselves and the two halves of one round.
    assert len(tables) == 3
