"""Main text of pages and benchmark leaks."""

import random

import numpy as np
import pytest
from plain import prose

from snapbook.llm import hostpaths, latent

ARTICLE = "".join(f"<p>{prose(50 + i, 40)}</p>" for i in range(3))
LINES = [" ".join(prose(50 + i, 40).split()) for i in range(3)]


def page(body: str) -> str:
    return f"<html><head><title>t</title><style>p{{}}</style></head><body>{body}</body></html>"


CASES = {
    "plain article": (f"<nav><ul><li><a href=x>menu</a></ul></nav><article><h1>Head</h1>{ARTICLE}</article><footer>foot</footer>", ["Head", *LINES]),
    "classes": (
        f'<div id="header"><a href=x>Site</a></div><div class="content c12">{ARTICLE}<div class="ad-box">buy</div><form><p>mail</p></form></div>'
        f'<div class="sidebar">{"<p>side</p>" * 3}</div><div class="comments"><p>{prose(70, 200)}</p></div>', LINES),
    "comments inside": (f'<article>{ARTICLE}<section id="comments"><p>{prose(71, 90)}</p></section></article>', LINES),
    "scripts and references": (f'<script>var a = "</p><p>no</p>";</script><main><p>A &amp; B&nbsp;&lt;c&gt; &#233;</p>{ARTICLE}<!-- <p>no</p> --></main>', ["A & B <c> é", *LINES]),
    "open tags": (f"<article><p><b>one<br>two<p>three <i>four{ARTICLE}", ["one two", "three four", *LINES]),
    "list and table": (f"<article>{ARTICLE}<ul><li>a<li>b</ul><table><tr><td>c<td>d</table></article>", [*LINES, "a", "b", "c", "d"]),
    "notice": (f'<article><div class="cookie-notice"><p>cookies</p></div>{ARTICLE}</article>', LINES),
    "no container": (ARTICLE, LINES),
    "hidden": (f'<article>{ARTICLE}<p hidden>secret</p><p style="display: none">secret</p></article>', LINES),
}


@pytest.mark.parametrize("name", CASES)
def test_one_page(name):
    body, lines = CASES[name]
    made = hostpaths.Page(page(body))
    assert made.text(made.best()[0]).split("\n") == lines


def links(n: int) -> str:
    return "".join(f"<li><a href=x>{prose(90 + i, 6)}</a>" for i in range(n))


# Names in an article: those of parts of the text, and those of furniture.
NAMED = {
    "heading ids": (f'<h1>Head</h1><h2 id="discussion">Discussion</h2>{ARTICLE}<h2 id="comments">Comments</h2><p>end</p>', ["Head", "Discussion", *LINES, "Comments", "end"]),
    "section ids": (f'{ARTICLE}<section id="related-work"><h2>Related work</h2><p>more</p></section><section id="legal"><p>law</p></section>', [*LINES, "Related work", "more", "law"]),
    "id from a heading": (f'{ARTICLE}<section id="cookies"><h2>Cookies</h2><p>recipe</p></section><section id="cookies"><p>accept</p></section>', [*LINES, "Cookies", "recipe"]),
    "comments with a heading": (f'{ARTICLE}<section id="comments"><h2>Comments</h2><p>first</p></section>', LINES),
    "compound classes": (f'<p class="share-price">up</p><div class="banner-year">good</div>{ARTICLE}<div class="legal">terms</div>', ["up", "good", *LINES, "terms"]),
    "furniture classes": (f'{ARTICLE}<div class="adBox">a</div><div class="cookie-banner">b</div><ul class="related-posts2"><li>c</ul><p class="advert">d</p><div class="social_share">e</div>', LINES),
    "evidence": (f'{ARTICLE}<div class="newsletter-teaser">mail <input name=m></div><ul class="promo-summer">{links(4)}</ul><div class="promo-winter">snow</div>', [*LINES, "snow"]),
    "formulas and drawings": (f"{ARTICLE}<p>so <math><mi>x</mi></math></p><svg><text>no</text></svg><noscript><p>no</p></noscript><aside>no</aside>", [*LINES, "so x"]),
}


@pytest.mark.parametrize("name", NAMED)
def test_names_in_an_article(name):
    body, lines = NAMED[name]
    for around in ("article", 'div class="post"'):
        made = hostpaths.Page(page(f"<{around}>{body}</{around.split()[0]}>"))
        assert made.text(made.best()[0]).split("\n") == lines


def test_header_of_a_named_article():
    made = hostpaths.Page(page(f'<header><p>Site</p></header><div class="post"><header><h1>Head</h1></header><div class="postHeader">By</div>{ARTICLE}</div>'))
    assert made.text(made.best()[0]).split("\n") == ["Head", "By", *LINES]


MEGABYTE = 1 << 20
BROKEN = {
    "unclosed quotes": '<a "x', "unclosed quotes with ends": '<a ">" ', "comments": "<!--", "declarations": "<!x", "cdata": "<![CDATA[", "end tags": "</b", "scripts": "</script ",
    "nested": "<div>", "nested inline": "<span>", "nested quotes": "<blockquote>x", "articles": "<article>", "spans and paragraphs": "<span><p>x", "stray ends": "<div></b>",
}


@pytest.mark.parametrize("name", BROKEN)
def test_long_broken_pages(name):
    """A page of a megabyte takes time in proportion to its length."""
    import time

    for head, tail in (("", ""), ("<b><i>", "y>"), ("<script>", "y>")):
        start = time.process_time()
        made = hostpaths.Page(head + BROKEN[name] * (MEGABYTE // len(BROKEN[name])) + tail)
        path = made.best()[0]
        assert made.has(path) or not path
        made.text(path)
        assert time.process_time() - start < 12


LEAD = " ".join(prose(60, 12).split())
AFTER = " ".join(prose(61, 20).split())
WRAPPED = {
    "wrapper in an article": (f'<article><h1>Head</h1><p>{LEAD}</p><div class="entry-content">{ARTICLE}</div><p>{AFTER}</p></article>', ["Head", LEAD, *LINES, AFTER]),
    "unnamed wrapper": (f"<main><h1>Head</h1><p>{LEAD}</p><div><div>{ARTICLE}</div></div></main>", ["Head", LEAD, *LINES]),
    "sections": (f'<article><h1>Head</h1><section class="a"><p>{LEAD}</p></section><section class="b">{ARTICLE}</section></article>', ["Head", LEAD, *LINES]),
    "wrapper in a named element": (
        f'<div class="post"><h1>Head</h1><p>{LEAD}</p><div class="in"><div class="text">{ARTICLE}</div></div></div><div class="list"><p>x</p></div>', ["Head", LEAD, *LINES]),
    "sections in an unnamed element": (f'<div><section class="a">{ARTICLE}</section><section class="b"><p>{LEAD}</p></section></div>', [*LINES, LEAD]),
    "left out beside the wrapper": (
        f'<article><nav>menu</nav><h1>Head</h1><div class="entry-content">{ARTICLE}</div><div class="share"><p>share</p></div></article>', ["Head", *LINES]),
}


@pytest.mark.parametrize("name", WRAPPED)
def test_wrapped_text(name):
    """Headings, leads and sections beside the container with most text."""
    body, lines = WRAPPED[name]
    made = hostpaths.Page(page(body))
    assert made.text(made.best()[0]).split("\n") == lines


def test_links_beside_a_container_stay_out():
    links = "".join(f"<p><a href=x>{prose(90 + i, 9)}</a></p>" for i in range(6))
    made = hostpaths.Page(page(f'<div class="content"><div class="post">{ARTICLE}</div><div class="list">{links}</div></div>'))
    assert made.text(made.best()[0]).split("\n") == LINES


def test_host_consensus(spark):
    """A page with a long list outside the article follows its host's other pages."""
    usual = page(f'<div class="post p7"><h1>T</h1>{ARTICLE}</div><div class="list"><p>x</p></div>')
    odd = page(f'<div class="post p9"><p>short text</p></div><div class="list">{"".join(f"<p>{prose(80 + i, 60)}</p>" for i in range(9))}</div>')
    rows = [(i, "https://User@Host.example:80/a", usual, 1, 2) for i in range(5)] + [(9, "http://host.example/b?x", odd, 1, 2), (10, "http://other.example/", odd, 1, 2)]
    got = {r["page_id"]: r for r in hostpaths.main_text(spark.createDataFrame(rows, "page_id long, url string, html string, host int, text int")).collect()}
    assert got[0]["text"].split("\n") == ["T", *LINES] and got[9]["text"] == "short text"
    assert got[10]["text"].startswith(prose(80, 60)[:10]) and got[9]["n_chars"] == 10


def test_page_edges(spark):
    rows = [(1, None, None), (2, "http://a/", ""), (None, "http://a/", "<p>text alone"), (3, "http://a/", "no markup at all"), (3, "http://a/", "no markup at all"), (4, "http://a/", "<div"), (5, None, "<p>" * 5000 + "deep")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = sorted(((r["page_id"], r["url"], r["text"], r["n_chars"]) for r in hostpaths.main_text(df).collect()), key=repr)
    assert got == sorted(((i, u, t, len(t)) for i, u, t in [
        (1, None, ""), (2, "http://a/", ""), (None, "http://a/", "text alone"), (3, "http://a/", "no markup at all"), (3, "http://a/", "no markup at all"),
        (4, "http://a/", "<div"), (5, None, "deep")]), key=repr)
    assert hostpaths.main_text(df.limit(0)).count() == 0


def test_small_pages(spark, sf_dir):
    """The generator's pages have one article each."""
    import html
    import re

    rows = {r["page_id"]: r for r in hostpaths.main_text(spark.read.parquet(f"{sf_dir}/pages.parquet")).collect()}
    for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect():
        body = re.search(r"<article>(.*)</article>", r["html"], re.S)[1]
        lines = (" ".join(html.unescape(re.sub(r"<[^>]*>", " ", x)).split()) for x in re.split(r"</h1>|</p>|<p>", body))
        assert rows[r["page_id"]]["text"] == "\n".join(x for x in lines if x)


# benchmark leaks

ITEMS = [(i, prose(500 + i, 25 + i)) for i in range(12)] + [(50, None), (51, ""), (52, prose(500, 25)), (53, prose(600, 200))]
ITEM_TABLE = "item_id long, text string, doc_id long, part long"


def items(spark):
    return spark.createDataFrame([(i, t, 1, 2) for i, t in ITEMS], ITEM_TABLE)


def paraphrase(text: str, seed: int, share: float = 0.15) -> str:
    rng = random.Random(seed)
    return " ".join("other" if rng.random() < share and k < len(text.split()) - 8 else w.upper() for k, w in enumerate(text.split()))


def planted(seed: int, inside: str) -> str:
    return prose(seed, 150) + " " + inside + " " + prose(seed + 1, 90)


def test_quotes_and_paraphrases(spark, edge_docs, edge_rows):
    rows = [(100 + i, planted(900 + 2 * i, t)) for i, t in ITEMS[:12]] + [(200 + i, planted(1200 + 2 * i, paraphrase(t, i))) for i, t in ITEMS[:12]]
    rows += [(300, planted(1500, ITEMS[15][1])), (301, ITEMS[3][1]), (302, None), (303, ""), (None, planted(1600, ITEMS[4][1]))]
    rows += [(400 + i, prose(2000 + i, 200)) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {(r["doc_id"], r["item_id"]) for r in latent.leaks(docs, items(spark)).collect()}
    expected = {(base + i, i) for i in range(12) for base in (100, 200)} | {(300, 53), (301, 3), (None, 4)}
    expected |= {(d, 52) for d, i in expected if i == 0}
    assert got == expected


def test_common_leak(spark):
    """An item that is in every second document is still found."""
    docs = spark.createDataFrame([(i, planted(3000 + 2 * i, ITEMS[2][1]) if i % 2 else prose(3000 + 2 * i, 200)) for i in range(60)], "doc_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in latent.leaks(docs, items(spark)).collect()}
    assert got == {(i, 2) for i in range(1, 60, 2)}


def test_leaks_in_blocks_and_empty_tables(spark, edge_docs, no_docs, monkeypatch):
    bench = items(spark)
    assert latent.leaks(no_docs, bench).collect() == [] and latent.leaks(edge_docs, bench.limit(0)).collect() == []
    assert latent.leaks(edge_docs, bench).collect() == []
    docs = spark.createDataFrame([(i, planted(4000 + 2 * i, ITEMS[i][1])) for i in range(12)], "doc_id long, text string")
    whole = {(r["doc_id"], r["item_id"]) for r in latent.leaks(docs, bench).collect()}
    monkeypatch.setattr(latent, "SHELF_BYTES", 500)
    monkeypatch.setattr(latent, "BLOCK_PARTS", 2)
    assert {(r["doc_id"], r["item_id"]) for r in latent.leaks(docs, bench).collect()} == whole == {(i, i) for i in range(12)} | {(0, 52)}


def test_many_items_in_one_block(spark):
    """Quotes and paraphrases of 1,500 items that share their words, between other words of the benchmark."""
    rng = random.Random(11)
    words = prose(700, 3000).split()
    bench = [(i, " ".join(rng.choices(words, k=rng.randint(20, 58)))) for i in range(1500)]

    def changed(text: str, share: float) -> str:
        own = text.split()
        gone = set(rng.sample(range(len(own) - 8), int(share * len(own))))
        return " ".join(rng.choice(words) if k in gone else w for k, w in enumerate(own))

    def around(text: str) -> str:
        return " ".join(rng.choices(words, k=60)) + " " + text + " " + " ".join(rng.choices(words, k=60))

    rows = [(i, around(t if i % 2 else changed(t, 0.3))) for i, t in bench]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    bench_rows = spark.createDataFrame(bench, "item_id long, text string")
    got = latent.leaks(docs, bench_rows).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == {(i, i) for i in range(1500)}
    # The latent search finds nearly all of them alone, and without it most are missing.
    alone = {(r["doc_id"], r["item_id"]) for r in latent.leaks(docs, bench_rows, exact=False).collect()}
    without = {(r["doc_id"], r["item_id"]) for r in latent.leaks(docs, bench_rows, latent=False).collect()}
    print("recall of the latent search", len(alone) / 1500, "without it", len(without) / 1500, "by latent", sum(r["found_by"] == "latent" for r in got))
    assert len(alone) >= 0.9 * 1500 and len(without) < 0.5 * 1500


def test_long_items_are_judged_whole(spark):
    """Words out of the middle of an item of several parts are no leak; three quarters of it, or the larger part with its end, are."""
    own = prose(600, 200).split()
    bench = spark.createDataFrame([(1, " ".join(own))], "item_id long, text string")
    # Its parts have 50 words each.
    cuts = {1: own, 2: own[50:100], 3: own[:150], 4: own[:100], 5: own[50:200], 6: own[:100] + own[150:200], 7: own[100:200], 8: own[:60]}
    docs = spark.createDataFrame([(i, planted(5000 + 2 * i, " ".join(w))) for i, w in cuts.items()], "doc_id long, text string")
    got = {r["doc_id"]: round(r["lcs_share"], 2) for r in latent.leaks(docs, bench).collect()}
    assert got == {1: 1.0, 3: 0.75, 5: 0.75, 6: 0.75}


def test_rare_words_in_slices(monkeypatch):
    """Every window that holds enough of a part is a candidate, however the pairs are sliced."""
    rng = random.Random(12)
    parts = [np.array(rng.choices(range(80), k=rng.randint(1, 30))) for _ in range(20)]
    texts = [np.array(rng.choices(range(81), k=n)) for n in (1, 40, 300, 31, 32, 97)] + [np.concatenate([parts[3], parts[7], parts[9]])]
    own = latent.Passages(texts, np.append(np.ones(80), 0.0))
    rare = latent.RareWords(parts, np.bincount(np.concatenate(texts), minlength=81), np.arange(len(parts)))
    must = set()
    for w, (start, text) in enumerate(zip(own.starts, own.text, strict=True)):
        words = own.ids[start : min(start + latent.PASSAGE * latent.WINDOW_PASSAGES, own.ends[text])].tolist()
        for q, part in enumerate(parts):
            mask = latent.bit_masks(part)
            if latent.common_length(mask, len(part), words) / len(part) >= latent.LCS_WITH_ANSWER:
                must.add((w, q))
    whole = None
    for pairs in (1, 50, 1_000_000):
        monkeypatch.setattr(latent, "RARE_PAIRS", pairs)
        got = [(int(w), int(q)) for a, b in rare.candidates(own) for w, q in zip(a, b, strict=True)]
        assert got == sorted(set(got)) and must <= set(got)
        assert whole is None or got == whole
        whole = got
    assert must


def test_every_quoted_item_is_found(spark, sf_dir, small_docs):
    """Against a plain search for whole items, letter case and marks aside."""
    import re

    word = re.compile(r"[^\W_]+")
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    quotes = {r["item_id"]: " " + " ".join(word.findall(r["text"].lower())) + " " for r in bench.collect()}
    plain = {(i, q) for i, t in small_docs for q, w in quotes.items() if w in " " + " ".join(word.findall(t.lower())) + " "}
    got = {(r["doc_id"], r["item_id"]) for r in latent.leaks(spark.read.parquet(f"{sf_dir}/documents.parquet"), bench).collect()}
    assert plain and plain == got
