"""Language identification by error-correcting output codes (Dietterich and Bakiri, 1995; Allwein, Schapire and Singer, 2000).

Each language has a codeword. For each bit a binary classifier over hashed character n-grams tells the languages with 1
from those with 0; decoding picks the codeword with the least loss, each bit weighted by how well its classifier did in
training. A text whose two best codewords are close is flagged.

Training: the classifiers are fit on a bounded sample, ``SAMPLE_ROWS`` labelled documents in all, in equal parts for each
language, chosen by a hash of the document id. Class counts for that choice cover all labelled documents.
Prediction: every whole text; its n-gram counts are summed up in pieces of bounded size.

Rules: null text, or text without a letter, is ``und`` with score 0 and not ambiguous. With no labelled text at all every text is ``und``;
with one language, that is the answer, with score 1. Ties go to the alphabetically first language. Repeated rows repeat their
prediction. Only text decides a prediction.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window, functions as F

from snapbook.llm.blocks import row_groups, texts_of
from snapbook.llm.shared import map_arrow

SAMPLE_ROWS = 1_200
GRAMS = (1, 2, 3)
FEATURES = 1 << 13
RIDGE = 0.05
MARGIN_SCALE = 4.0
AMBIGUOUS = 0.15
UNKNOWN = "und"
PIECE = 1 << 20

LETTER = regex.compile(r"\p{L}")

# ASCII letters stay (in lower case), all other ASCII bytes become a space; bytes of other letters stay.
_FOLD = np.full(256, 32, np.uint8)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


def codewords(languages: int) -> np.ndarray:
    """One row of +1 and -1 for each language.

    Up to seven languages: all different splits of the languages in two parts. More: random splits, twelve for each doubling of
    the languages, from the best of many draws by least distance between rows.
    """
    if languages < 2:
        return np.ones((languages, 0), np.int8)
    if languages <= 7:
        splits = [(1, *s) for s in itertools.product((1, -1), repeat=languages - 1) if -1 in s]
        return np.array(splits, np.int8).T
    bits = 12 * int(np.ceil(np.log2(languages)))
    rng = np.random.default_rng(11)
    best, distance = None, -1
    for _ in range(200):
        code = rng.choice(np.array([-1, 1], np.int8), (languages, bits))
        apart = code.astype(int) @ code.T.astype(int)
        least = int((bits - apart[~np.eye(languages, dtype=bool)]).min())
        if least > distance and (np.abs(code.sum(axis=0, dtype=int)) < languages).all():
            best, distance = code, least
    return best


def gram_counts(text: bytes) -> np.ndarray:
    """Counts of hashed n-grams of a whole text, taken in pieces that overlap by the longest n-gram."""
    counts = np.zeros(FEATURES, np.int64)
    longest = max(GRAMS)
    for at in range(0, len(text), PIECE):
        part = _FOLD[np.frombuffer(text[at : at + PIECE + longest - 1], np.uint8)]
        # One space stands for a run of them.
        space = part == 32
        part = part[np.concatenate([[True], ~(space[1:] & space[:-1])])]
        code = part.astype(np.uint32)
        for n in GRAMS:
            if len(code) < n:
                break
            key = code[: len(code) - n + 1].copy()
            for i in range(1, n):
                key = key * np.uint32(257) + code[i : len(code) - n + 1 + i]
            key = (key * np.uint32(2654435761)) >> np.uint32(32 - FEATURES.bit_length() + 1)
            counts += np.bincount(key, minlength=FEATURES)
    return counts


def features(text: str) -> np.ndarray:
    """Unit vector of the square roots of the n-gram counts."""
    vector = np.sqrt(gram_counts(text.encode("utf-8", "surrogatepass"))).astype(np.float32)
    return vector / max(float(np.linalg.norm(vector)), 1e-12)


class Classifier:
    """Codewords, the weights of each bit's classifier and the weight of each bit in decoding."""

    def __init__(self, languages: list[str], vectors: np.ndarray, labels: np.ndarray):
        self.languages = languages
        self.code = codewords(len(languages)).astype(np.float32)
        targets = self.code[labels]
        # Ridge regression in its dual form: one system for all bits. Languages weigh alike whatever their number of samples.
        count = np.bincount(labels, minlength=len(languages))
        weight = len(labels) / (len(languages) * np.maximum(count[labels], 1))
        scale = np.sqrt(weight)[:, None].astype(np.float32)
        scaled = np.hstack([vectors, np.full((len(vectors), 1), 0.3, np.float32)]) * scale
        kernel = scaled @ scaled.T
        kernel[np.diag_indices(len(kernel))] += RIDGE * float(np.trace(kernel)) / max(len(kernel), 1)
        self.weights = scaled.T @ np.linalg.solve(kernel, targets * scale) if len(vectors) and self.code.shape[1] else np.zeros((vectors.shape[1] + 1, self.code.shape[1]))
        self.weights = self.weights.astype(np.float32)
        right = (np.sign(self.margins(vectors)) == targets).mean(axis=0) if len(vectors) and self.code.shape[1] else np.zeros(self.code.shape[1])
        # Bits that are often wrong count less.
        share = np.clip(right, 0.5, 0.999)
        self.bit = np.log(share / (1 - share))
        self.bit = self.bit / max(float(self.bit.sum()), 1e-12)

    def margins(self, vectors: np.ndarray) -> np.ndarray:
        return vectors @ self.weights[:-1] + 0.3 * self.weights[-1]

    def decode(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Best language, its score and whether the runner-up is close. The loss of a bit is exp(-margin)."""
        if len(self.languages) == 1:
            return np.zeros(len(vectors), np.int64), np.ones(len(vectors)), np.zeros(len(vectors), bool)
        margin = np.clip(self.margins(vectors) * MARGIN_SCALE, -20, 20)
        loss = (np.exp(-margin) * self.bit) @ (self.code.T > 0) + (np.exp(margin) * self.bit) @ (self.code.T < 0)
        near = np.exp(loss.min(axis=1, keepdims=True) - loss)
        score = near / near.sum(axis=1, keepdims=True)
        order = np.sort(score, axis=1)
        return score.argmax(axis=1), order[:, -1], order[:, -1] - order[:, -2] < AMBIGUOUS


def training_rows(labelled: DataFrame, limit: int = SAMPLE_ROWS) -> list:
    """Features and language of at most ``limit`` documents, equal shares for each language, by hash order of the key.

    The counts of all labelled documents set the share that is looked at, so the exact choice sorts few rows; the driver gets
    ``limit`` vectors of fixed size at most. Of more than ``limit`` languages the first ``limit`` by code point are learned.
    """
    counts = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().orderBy("lang").limit(limit).collect()}
    if not counts:
        return []
    each = max(limit // len(counts), 1)
    order = F.xxhash64(F.col("doc_id").cast("string"), F.lit("train"))
    share = F.create_map(*itertools.chain(*((F.lit(k), F.lit(min(1.0, 2.0 * (each + 50) / n))) for k, n in counts.items())))
    place = F.pmod(order, F.lit(1 << 40)) / F.lit(float(1 << 40))
    some = labelled.withColumn("place", place).filter(F.col("place") < share[F.col("lang")])

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        vectors = [features(t).astype("<f4").tobytes() for t in texts_of(batch, "text")]
        yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("doc_id", "lang", "place")] + [pa.array(vectors, pa.binary())], names=["doc_id", "lang", "place", "vector"])

    kind = labelled.schema["doc_id"].dataType.simpleString()
    made = map_arrow(some.select("doc_id", "lang", "text", "place"), run, f"doc_id {kind}, lang string, place double, vector binary")
    first = F.row_number().over(Window.partitionBy("lang").orderBy("place", "doc_id", "vector"))
    return made.withColumn("n", first).filter(F.col("n") <= each).orderBy("lang", "n").select("lang", "vector").collect()


def fit(labelled: DataFrame) -> Classifier | None:
    """A classifier from ``labelled(doc_id, text, lang)``; rows without a language or a letter do not count."""
    known = labelled.filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    rows = training_rows(known)
    if not rows:
        return None
    languages = sorted({r["lang"] for r in rows})
    labels = np.array([languages.index(r["lang"]) for r in rows])
    return Classifier(languages, np.stack([np.frombuffer(r["vector"], "<f4") for r in rows]), labels)


def predict(docs: DataFrame, classifier: Classifier | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, ``lang_pred``, ``score`` (0 to 1) and ``ambiguous``."""
    rows = docs.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(classifier)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        model, texts = shared.value, texts_of(batch, "text")
        names, scores, close = [UNKNOWN] * len(texts), [0.0] * len(texts), [False] * len(texts)
        if model is not None:
            for lo, hi in row_groups([len(t) for t in texts]):
                own = [i for i in range(lo, hi) if LETTER.search(texts[i])]
                for at in range(0, len(own), 256):
                    part = own[at : at + 256]
                    best, score, near = model.decode(np.stack([features(texts[i]) for i in part]))
                    for i, b, s, c in zip(part, best, score, near, strict=True):
                        names[i], scores[i], close[i] = model.languages[b], float(s), bool(c)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(names), pa.array(scores), pa.array(close)], names=["doc_id", "lang_pred", "score", "ambiguous"])

    return map_arrow(rows, run, f"doc_id {kind}, lang_pred string, score double, ambiguous boolean")


def held_out(key: Column) -> Column:
    """Whether a document is kept out of training: crc32 of its id as text leaves 1 modulo 3."""
    return F.coalesce(F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))
