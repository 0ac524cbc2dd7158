"""Quality rules, sharding, token counts, language and segmentations."""

import collections
import math
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from plain import base_quality, gram_share, prose
from pyspark.sql import functions as F

from snapbook.llm import langcode, quality, segments, sharding, tokens
from snapbook.llm.blocks import mix
from snapbook.llm.queries import QUERIES

BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


# quality rules

def test_quality_against_plain(edge_docs, edge_rows):
    got = collections.Counter(
        (r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"])
        for r in quality.repetition(edge_docs).collect()
    )
    assert got == collections.Counter((i, *base_quality(t)) for i, t in edge_rows)


def test_gram_shares(small_docs):
    for _, text in small_docs[:60]:
        found = dict(zip(quality.NAMES, quality.measure(text), strict=True))
        for n in quality.GRAM_LIMITS:
            assert found[f"gram{n}_share"] == pytest.approx(gram_share(text, n))


def test_verdict_follows_limits_and_base():
    junk = " ".join(["six words that come again here"] * 3 + [f"w{i}" for i in range(34)])
    fine = " ".join(f"w{i}" for i in range(80))
    kept = quality.NAMES.index("kept")
    assert quality.measure(fine)[kept]
    assert not quality.measure("short text")[kept]
    found = dict(zip(quality.NAMES, quality.measure(junk), strict=True))
    assert not found["base_failed"] and found["gram5_share"] > quality.GRAM_LIMITS[5] and not found["kept"]


def test_keep_passing_keeps_columns(edge_docs, edge_rows, no_docs):
    left = quality.keep_passing(edge_docs)
    kept = quality.NAMES.index("kept")
    assert left.schema == edge_docs.schema
    assert left.count() == sum(quality.measure(t or "")[kept] for _, t in edge_rows)
    assert quality.keep_passing(no_docs).count() == quality.repetition(no_docs).count() == 0


def test_clean_documents_stay(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    good = spark.read.parquet(f"{sf_dir}/labels.parquet").filter("quality = 1")
    rows = quality.repetition(docs).join(good, "doc_id").filter("not base_failed").collect()
    assert len(rows) > 30 and sum(r["kept"] for r in rows) == len(rows)


# sharding

def jump(key, shards):
    key, b, j = key % 2**64, -1, 0
    while j < shards:
        b, key = j, (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


@pytest.mark.parametrize("shards", [1, 2, 24, 25, 1000])
def test_jump_shards(spark, shards):
    keys = [*range(60), -1, -(2**63), 2**63 - 1, 10**12]
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    got = {r["k"]: r["shard"] for r in sharding.assign_shards(df, "k", shards).collect()}
    assert got == {k: jump(k, shards) for k in keys}


def test_walks_longer_than_usual_finish(spark, monkeypatch):
    monkeypatch.setattr(sharding, "USUAL_STEPS", 2)
    df = spark.range(200).withColumnRenamed("id", "k")
    assert {r["k"]: r["shard"] for r in sharding.assign_shards(df, "k", 50).collect()} == {k: jump(k, 50) for k in range(200)}


def test_growth_moves_only_to_the_new_shard(spark):
    df = spark.range(20_000).withColumnRenamed("id", "k")
    both = sharding.assign_shards(sharding.assign_shards(df, "k", 24, "a"), "k", 25, "b")
    moved = both.filter("a != b")
    assert moved.filter("b != 24").count() == 0
    assert 0.03 < moved.count() / 20_000 < 0.05


def test_text_keys_and_null(spark):
    df = spark.createDataFrame([("x",), ("x",), ("y",), (None,)], "k string")
    rows = sharding.assign_shards(df, "k", 10).collect()
    assert len({r["shard"] for r in rows if r["k"] == "x"}) == 1 and all(0 <= r["shard"] < 10 for r in rows)


def test_slots_are_gapless(edge_docs):
    docs = edge_docs.select("doc_id", F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("c"))
    placed = sharding.number_in_shards(sharding.assign_shards(docs, "doc_id", 4), "shard", [F.col("doc_id").asc_nulls_first(), F.col("c").asc()])
    slots = collections.defaultdict(list)
    for r in placed.collect():
        slots[r["shard"]].append(r["slot"])
    assert sum(map(len, slots.values())) == docs.count()
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_sharding_query(spark, sf_dir, small_docs):
    rows = {r["doc_id"]: r for r in QUERIES["op6_sharding"](spark, sf_dir).collect()}
    for i, t in small_docs:
        assert (rows[i]["size"], rows[i]["text_crc32"]) == (len(t.encode()) + 8, zlib.crc32(t.encode()))
        assert (rows[i]["shard"], rows[i]["grown_shard"]) == (jump(i, 24), jump(i, 25))


# token counts

def plain_counts(texts):
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(BPE)
    return [len(e.ids) for e in made.encode_batch(texts, add_special_tokens=False)]


def test_token_counts(edge_docs, edge_rows, no_docs, monkeypatch):
    texts = [t or "" for _, t in edge_rows]
    expected = collections.Counter(zip((i for i, _ in edge_rows), (len(t.encode()) for t in texts), plain_counts(texts), strict=True))
    for frequent in (tokens.FREQUENT, 3):
        got = tokens.count_tokens(edge_docs, BPE, frequent=frequent)
        assert collections.Counter((r["doc_id"], r["n_bytes"], r["n_tokens"]) for r in got.collect()) == expected
    assert tokens.count_tokens(no_docs, BPE).count() == 0


def test_token_counts_small(spark, sf_dir, small_docs):
    rows = {r["doc_id"]: r["n_tokens"] for r in QUERIES["op7_tokens"](spark, sf_dir).collect()}
    assert [rows[i] for i, _ in small_docs] == plain_counts([t for _, t in small_docs])


def test_pretokens_in_pieces(monkeypatch):
    """Pieces of any length give the pre-tokens of the whole text."""
    cut = tokens.Splitter(BPE)
    rng = random.Random(5)
    signs = [" ", "  ", "\n", "\t", "\r\n", "a", "it's", "é", "日本", "12", "!", "--", "\u00a0", "\u2003", "\u200b", "\x1f", "😀", "ﬁ", "\u0301"]
    texts = ["".join(rng.choices(signs, k=400)) for _ in range(60)] + ["x" * 500, " " * 500, "日本" * 200, ""]
    whole = [cut.split(t) for t in texts]
    for size in (1, 7, 50):
        monkeypatch.setattr(tokens, "PIECE", size)
        for text, expected in zip(texts, whole, strict=True):
            assert [t for piece in cut.pieces(text) for t in piece] == expected


def test_long_text_counts(spark):
    text = " ".join(prose(40 + i, 4000) for i in range(20)) + "<|endoftext|>" + "日本語 " * 90_000
    assert len(text) > tokens.PIECE
    got = tokens.count_tokens(spark.createDataFrame([(1, text)], "doc_id long, text string"), BPE).collect()
    assert [r["n_tokens"] for r in got] == plain_counts([text])


def test_pretokens_for_every_kind_of_character():
    cut = tokens.Splitter(BPE)
    for code in range(0, 0x30000, 7):
        if 0xD800 <= code < 0xE000:
            continue
        c = chr(code)
        text = f"a{c}b {c} 1{c}{c}\n{c}'s"
        assert cut.split(text) == [text[a:b] for _, (a, b) in cut.tokenizer.pre_tokenizer.pre_tokenize_str(text)]


# language

def test_held_out_accuracy(spark):
    rows = QUERIES["op8_language"](spark, "/root/testdata/sf0.01")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    held = rows.join(docs, "doc_id").filter("held_out").collect()
    assert len(held) > 300 and sum(r["lang"] == r["lang_pred"] for r in held) / len(held) > 0.97
    assert all(0 <= r["score"] <= 1 for r in held)


def test_held_out_split(spark):
    rows = spark.range(50).select(F.col("id"), langcode.held_out(F.col("id")).alias("h")).collect()
    assert {r["id"] for r in rows if r["h"]} == {i for i in range(50) if zlib.crc32(str(i).encode()) % 3 == 1}


def test_language_edges(spark, edge_docs, no_docs):
    assert langcode.fit(no_docs.select("doc_id", "text", "lang")) is None
    rows = langcode.predict(edge_docs, None).collect()
    assert {r["lang_pred"] for r in rows} == {"und"}
    one = langcode.fit(spark.createDataFrame([(1, "some text", "en"), (2, None, "de"), (3, "..", "fr"), (4, "text", None)], "doc_id long, text string, lang string"))
    assert one.languages == ["en"]
    found = langcode.predict(edge_docs, one).collect()
    assert {(r["text"] is None) for r in edge_docs.collect()} == {True, False}
    blank = {1, 2, 3, 19}
    assert all((r["lang_pred"] == "und") == (r["doc_id"] in blank) for r in found)


def test_signs_and_numerals_are_no_letters(spark):
    one = langcode.fit(spark.createDataFrame([(1, "some text", "en")], "doc_id long, text string, lang string"))
    texts = ["½ ² ①", "Ⅷ", "_ 12", "٣", "ª", "½ x", "日", "é"]
    found = langcode.predict(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), one).collect()
    assert [r["lang_pred"] for r in sorted(found, key=lambda r: r["doc_id"])] == ["und"] * 4 + ["en"] * 4


@pytest.mark.parametrize("languages", [2, 3, 4, 7, 9, 20])
def test_codewords_differ(languages):
    code = langcode.codewords(languages).astype(int)
    bits = code.shape[1]
    apart = (bits - code @ code.T)[~np.eye(languages, dtype=bool)] // 2
    assert apart.min() >= (1 if languages == 2 else 2)
    assert (np.abs(code.sum(axis=0)) < languages).all()


# segmentations

def all_paths(model, text):
    """Every segmentation of a short text with its probability."""
    whole = segments.SPACE + text.replace(" ", segments.SPACE)
    known = {t: i for i, t in enumerate(model.texts)}
    rank = {}
    for i, t in enumerate(model.texts):
        if i >= 259:
            rank[t] = i - 259
    out = []

    def go(at, ids, weight):
        if at == len(whole):
            out.append((tuple(ids), weight))
        for to in range(at + 1, len(whole) + 1):
            piece = whole[at:to]
            if piece in rank and segments.SPACE not in piece[1:].rstrip(segments.SPACE) and (segments.SPACE not in piece[1:] or set(piece) == {segments.SPACE}):
                go(to, [*ids, known[piece]], weight - math.log(2 + rank[piece]))

    go(0, [], 0.0)
    total = math.log(sum(math.exp(w) for _, w in out))
    return {p: math.exp(w - total) for p, w in out}


def test_sampling_follows_the_lattice():
    model = segments.pieces(PIECES)
    expected = all_paths(model, "the then")
    n, first, both = 12_000, collections.Counter(), collections.Counter()
    for lo in range(0, n, 3000):
        for rows in segments.sample_group(model, ["the then"] * 3000, mix(np.arange(lo, lo + 3000, dtype=np.uint64) + np.uint64(9)), 2):
            first[tuple(rows[0][0].tolist())] += 1
            both.update(tuple(r[0].tolist()) for r in rows)
            for ids, logp, inclusion in rows:
                assert math.exp(logp) == pytest.approx(expected[tuple(ids.tolist())]) and 0 < inclusion <= 1
    for path, p in sorted(expected.items(), key=lambda x: -x[1])[:6]:
        pair = p + sum(q * p / (1 - q) for other, q in expected.items() if other != path)
        assert first[path] / n == pytest.approx(p, abs=0.015)
        assert both[path] / n == pytest.approx(pair, abs=0.02)


def test_all_segmentations_of_a_short_text():
    model = segments.pieces(PIECES)
    expected = all_paths(model, "that")
    rows = segments.sample_group(model, ["that"], np.array([3], np.uint64), 1000)[0]
    assert {tuple(r[0].tolist()) for r in rows} == set(expected) and len(rows) == len(expected)
    assert sum(math.exp(r[1]) for r in rows) == pytest.approx(1.0) and all(r[2] == 1.0 for r in rows)


def test_round_trip_and_distinct(edge_docs, edge_rows):
    made = segments.sampled_segmentations(edge_docs, PIECES, k=3)
    rows = segments.decoded(made, PIECES).collect()
    texts = collections.defaultdict(set)
    for i, t in edge_rows:
        texts[i].add(t or "")
    assert {r["doc_id"] for r in rows} == set(texts)
    assert all(r["text"] in texts[r["doc_id"]] and r["n_pieces"] * 2 == len(r["pieces"]) for r in rows)
    single = [r for r in rows if len(texts[r["doc_id"]]) == 1 and r["doc_id"] != 7]
    assert len({(r["doc_id"], bytes(r["pieces"])) for r in single}) == len(single)
    assert sum(r["doc_id"] in (1, 2) for r in rows) == 2


def test_same_samples_again(edge_docs, no_docs):
    one = segments.sampled_segmentations(edge_docs, PIECES).orderBy("doc_id", "sample", "pieces").collect()
    two = segments.sampled_segmentations(edge_docs.repartition(3), PIECES).orderBy("doc_id", "sample", "pieces").collect()
    assert one == two
    assert segments.sampled_segmentations(no_docs, PIECES).count() == 0


def test_long_and_rare_characters():
    model = segments.pieces(PIECES)
    for text in ("汉字" * 200, "\U0001F600" * 50, "a" * 3000, "\x00\x01", " " * 40):
        for ids, _, _ in segments.sample_group(model, [text], np.array([1], np.uint64), 2)[0]:
            assert model.decode(model.written(ids)) == text
