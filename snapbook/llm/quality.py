"""Repetition rules: how many characters lie inside repeated word n-grams and repeated lines.

Rules: a null or empty text has no words and fails the base rule. Equal rows get equal results. A text of any length is
handled in memory of a few times its size; nothing is cut off.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from snapbook.llm.blocks import gram_hashes, mix, texts_of
from snapbook.llm.shared import map_arrow

SYMBOLS = "#*$%&|<>"

# The largest share of a text's word characters inside repeated n-grams, by n, and inside repeated lines.
# A clean text that quotes one passage twice stays below them.
GRAM_LIMITS = {5: 0.40, 6: 0.38, 7: 0.36, 8: 0.34, 9: 0.32, 10: 0.30}
LINE_LIMIT = 0.30

MIN_WORDS = 50
REPEAT_PERCENT = 50

MEASURES = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, "
    "line_share double, " + ", ".join(f"gram{n}_share double" for n in GRAM_LIMITS)
)

NAMES = [part.split()[0] for part in MEASURES.split(", ")]
KEPT = NAMES.index("kept")


def repeated(keys: np.ndarray) -> np.ndarray:
    """Which keys occur more than once."""
    if len(keys) < 2:
        return np.zeros(len(keys), bool)
    order = np.argsort(keys)
    same = keys[order[1:]] == keys[order[:-1]]
    twice = np.zeros(len(keys), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    return twice


def cover_windows(marks: np.ndarray, n: int, total: int) -> np.ndarray:
    """Which of ``total`` words lie in a marked window of ``n`` words (``marks`` has one entry per window start)."""
    change = np.zeros(total + 1, np.int32)
    change[: len(marks)] += marks
    change[n : n + len(marks)] -= marks
    return np.cumsum(change)[:total] > 0


def measure(text: str) -> tuple:
    """All measures of one text, in the order of ``MEASURES``."""
    words = text.encode("utf-8", "surrogatepass").split()
    n = len(words)
    symbols = sum(text.count(c) for c in SYMBOLS)
    numbers: dict[bytes, int] = {}
    ids = np.array([numbers.setdefault(w, len(numbers)) for w in words], np.uint64)
    sizes = np.array([len(w.decode("utf-8", "surrogatepass")) for w in numbers], np.int64)
    chars = sizes[ids.astype(np.int64)] if n else np.zeros(0, np.int64)
    total = int(chars.sum())
    seen: set[str] = set()
    dup_lines = dup_chars = 0
    for line in text.split("\n"):
        if line in seen:
            dup_lines += 1
            dup_chars += sum(len(w.decode("utf-8", "surrogatepass")) for w in line.encode("utf-8", "surrogatepass").split())
        elif line.strip(" \t\n\v\f\r"):
            seen.add(line)
    keys = mix(ids + np.uint64(1))
    triple = int(cover_windows(repeated(gram_hashes(keys, 3)), 3, n).sum()) if n >= 3 else 0
    failed = n < MIN_WORDS or 100 * triple > REPEAT_PERCENT * n
    line_share = dup_chars / total if total else 0.0
    shares = []
    # A word window that repeats contains repeated shorter ones: without a repeated 5-gram the longer ones need no look.
    none = False
    for size in GRAM_LIMITS:
        if none or n < size:
            shares.append(0.0)
            continue
        marks = repeated(gram_hashes(keys, size))
        none = not marks.any()
        shares.append(0.0 if none else float(chars[cover_windows(marks, size, n)].sum()) / total)
    kept = not failed and line_share <= LINE_LIMIT and all(s <= m for s, m in zip(shares, GRAM_LIMITS.values(), strict=True))
    return (n, total, symbols, dup_lines, triple, failed, kept, line_share, *shares)


def repetition(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: the key and the measures of its whole text; a map without any exchange."""
    rows = docs.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        columns = list(zip(*map(measure, texts_of(batch, "text")), strict=True))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *map(pa.array, columns)], names=["doc_id", *NAMES])

    return map_arrow(rows, run, f"doc_id {kind}, {MEASURES}")


def keep_passing(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents whose whole text passes, with all their columns; a map without any exchange."""
    at = docs.columns.index(text)

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        kept = pa.array([measure("" if t is None else t)[KEPT] for t in batch.column(at).to_pylist()], pa.bool_())
        yield batch.filter(kept)

    return map_arrow(docs, run, docs.schema)
