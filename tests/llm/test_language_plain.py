"""The language classifier against a plain version of its fit and its decoding."""

import math

import numpy as np
from plain import prose
from pyspark.sql import functions as F

from snapbook.llm import langcode

TEXTS = {
    "en": ["the house is near the river and the street", "we saw that these things were there with them", "this is what they thought of the other one"],
    "de": ["das Haus ist nahe am Fluss und an der Straße", "wir sahen dass diese Dinge dort bei ihnen waren", "das ist was sie über den anderen dachten", "nicht schön"],
    "fr": ["la maison est près de la rivière et de la rue", "nous avons vu que ces choses étaient là avec eux"],
    "es": ["la casa está cerca del río y de la calle", "vimos que estas cosas estaban allí con ellos ñ"],
}
UNSEEN = ["the river is there", "die Straße ist dort", "où est la maison", "¿dónde está el río?", "ΑΒΓ", "x", "River!!! 12  near\n\nthe\tHOUSE", "日本語", prose(3, 50)]


def plain_features(text: str) -> dict[int, float]:
    folded: list[int] = []
    for b in text.encode():
        b = b + 32 if 65 <= b <= 90 else b
        b = b if 97 <= b <= 122 or b >= 128 else 32
        if b != 32 or not folded or folded[-1] != 32:
            folded.append(b)
    counts: dict[int, int] = {}
    for n in langcode.GRAMS:
        for at in range(len(folded) - n + 1):
            key = 0
            for b in folded[at : at + n]:
                key = (key * 257 + b) % 2**32
            key = key * 2654435761 % 2**32 * langcode.FEATURES // 2**32
            counts[key] = counts.get(key, 0) + 1
    length = math.sqrt(sum(counts.values())) or 1.0
    return {k: math.sqrt(n) / length for k, n in counts.items()}


def plain_model(samples: list[tuple[str, str]]) -> tuple[list[str], list[list[int]], dict[int, int], np.ndarray, list[float]]:
    """Weighted ridge regression in its primal form over the features in use, a bit at a time, and the weights of the bits."""
    languages = sorted({lang for lang, _ in samples})
    code = langcode.codewords(len(languages)).astype(int).tolist()
    rows = [plain_features(t) for _, t in samples]
    column = {k: i for i, k in enumerate(sorted({k for r in rows for k in r}))}
    matrix = np.zeros((len(rows), len(column) + 1))
    for i, r in enumerate(rows):
        matrix[i, -1] = 0.3
        for k, v in r.items():
            matrix[i, column[k]] = v
    own = [lang for lang, _ in samples]
    weight = np.array([len(own) / (len(languages) * own.count(lang)) for lang in own])
    ridge = langcode.RIDGE * sum(w * float(r @ r) for w, r in zip(weight, matrix, strict=True)) / len(own)
    left = matrix.T @ (matrix * weight[:, None]) + ridge * np.eye(matrix.shape[1])
    weights, bits = [], []
    for b in range(len(code[0])):
        target = np.array([code[languages.index(lang)][b] for lang in own])
        solved = np.linalg.solve(left, matrix.T @ (weight * target))
        right = sum((m > 0) == (t > 0) for m, t in zip(matrix @ solved, target, strict=True)) / len(own)
        right = min(max(right, 0.5), 0.999)
        weights.append(solved)
        bits.append(math.log(right / (1 - right)))
    return languages, code, column, np.array(weights), [b / sum(bits) for b in bits]


def plain_prediction(model, text: str) -> tuple[str, float, float]:
    languages, code, column, weights, bits = model
    found = plain_features(text)
    margins = [sum(w[column[k]] * v for k, v in found.items() if k in column) + 0.3 * w[-1] for w in weights]
    losses = [sum(b * math.exp(-c * m * langcode.MARGIN_SCALE) for b, c, m in zip(bits, row, margins, strict=True)) for row in code]
    near = [math.exp(min(losses) - x) for x in losses]
    scores = sorted(((x / sum(near), lang) for x, lang in zip(near, languages, strict=True)), reverse=True)
    return scores[0][1], scores[0][0], scores[0][0] - scores[1][0]


def test_features_against_plain():
    for text in [*UNSEEN, "", " ", "a", "é", *(t for own in TEXTS.values() for t in own)]:
        expected = plain_features(text)
        assert np.allclose(langcode.features(text), [expected.get(k, 0.0) for k in range(langcode.FEATURES)], atol=1e-6)


def test_fit_and_decoding_against_plain(spark):
    samples = [(lang, t) for lang, own in TEXTS.items() for t in own]
    model = plain_model(samples)
    labelled = spark.createDataFrame([(i, t, lang) for i, (lang, t) in enumerate(samples)], "doc_id long, text string, lang string").repartition(3)
    texts = [t for _, t in samples] + UNSEEN
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r for r in langcode.predict(docs, langcode.fit(labelled)).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        lang, score, apart = plain_prediction(model, text)
        assert abs(got[i]["score"] - score) < 1e-3
        assert got[i]["lang_pred"] == lang or apart < 1e-3
        assert got[i]["ambiguous"] == (apart < langcode.AMBIGUOUS) or abs(apart - langcode.AMBIGUOUS) < 2e-3


def test_held_out_accuracy(spark, sf_dir):
    """Accuracy on the held-out documents with the whole bound and with a quarter of it."""
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang").withColumn("held_out", langcode.held_out(F.col("doc_id")))
    known = rows.filter("lang is not null and text is not null")
    for limit in (langcode.SAMPLE_ROWS // 4, langcode.SAMPLE_ROWS):
        found = langcode.training_rows(known.filter("not held_out"), limit)
        languages = sorted({r["lang"] for r in found})
        labels = np.array([languages.index(r["lang"]) for r in found])
        model = langcode.Classifier(languages, np.stack([np.frombuffer(r["vector"], "<f4") for r in found]), labels)
        tested = langcode.predict(known.filter("held_out"), model).join(known.select("doc_id", "lang"), "doc_id")
        right = [r["lang"] == r["lang_pred"] for r in tested.collect()]
        assert right and sum(right) / len(right) > 0.95
