"""Token counts of a byte-level BPE by a two-tier table of pre-token lengths.

Tier one is a table of the most frequent pre-tokens with their token counts, broadcast once. Tier two encodes the
others in each Python worker and remembers them in a cache of bounded size. No pre-token is shuffled: every task sums
up its own most frequent ones, and only these summaries meet. Neither tier changes a count, only the time it takes.

Rules: a null or empty text has 0 tokens. A special token's string inside a text is that one token, as the tokenizer
library takes it by default. Equal rows get equal counts. A text longer than ``PIECE`` characters is counted in pieces of about that length that end
before white space after a letter, digit or ASCII sign, where a pre-token always ends; a longer stretch without such a place is one piece.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from snapbook.llm.blocks import texts_of
from snapbook.llm.shared import map_arrow, tidy

# Pre-token rule of the byte-level vocabulary (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Character classes of two regular-expression libraries can differ for rare letters; texts with characters beyond
# these blocks are split by the tokenizer's own rule.
UNUSUAL = r"[^\x00-\x1B\x20-\x84\x86-ɏ]"

FREQUENT = 16_384
PER_TASK = 2_048
SUMMARY = 200_000
CACHE = 500_000
PIECE = 1 << 18

_state: dict[str, object] = {}


class Splitter:
    """Pre-tokens of texts, exactly as the tokenizer cuts them."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.usual = regex.compile(PATTERN).findall
        self.unusual = regex.compile(UNUSUAL).search
        self.border = regex.compile(r"(?<=[!-~\p{L}\p{N}])[ \n\t\r]").search
        specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.specials = regex.compile("|".join(regex.escape(s) for s in sorted(specials, key=len, reverse=True))) if specials else None

    def parts(self, text: str) -> tuple[int, list[str]]:
        """The number of special tokens in a text, and the ordinary texts between them."""
        if self.specials is None or not self.specials.search(text):
            return 0, [text]
        pieces = self.specials.split(text)
        return len(pieces) - 1, [p for p in pieces if p]

    def pieces(self, text: str) -> Iterator[list[str]]:
        """The pre-tokens of an ordinary text, a piece at a time."""
        at = 0
        while len(text) - at > PIECE:
            border = self.border(text, at + PIECE)
            if border is None:
                break
            yield self.split(text[at : border.start()])
            at = border.start()
        yield self.split(text[at:] if at else text)

    def split(self, text: str) -> list[str]:
        if self.unusual(text) is None:
            return self.usual(text)
        return [text[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)]

    def lengths(self, pretokens: list[str]) -> list[int]:
        """Token counts of single pre-tokens."""
        return [len(e.ids) for e in self.tokenizer.encode_batch_fast(pretokens, add_special_tokens=False)]


def splitter(path: str) -> Splitter:
    """One splitter for each Python worker and file."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if _state.get("path") != path:
        _state.update(path=path, splitter=Splitter(path))
    return _state["splitter"]


def frequent_pretokens(docs: DataFrame, text: str, path: str, size: int = FREQUENT) -> list[str]:
    """The ``size`` pre-tokens with the largest sums of the tasks' own counts, most frequent first.

    Every text is counted. A task drops its rare pre-tokens when it holds ``SUMMARY`` of them and reports its
    ``PER_TASK`` largest, so memory and result stay bounded; the table only has to be good, not exact.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut, counts = splitter(path), Counter()
        for batch in batches:
            for value in texts_of(batch, "text"):
                for part in cut.parts(value)[1]:
                    for pretokens in cut.pieces(part):
                        counts.update(pretokens)
                        if len(counts) > SUMMARY:
                            counts = Counter(dict(counts.most_common(SUMMARY // 4)))
        top = counts.most_common(PER_TASK)
        if top:
            yield pa.RecordBatch.from_pydict({"pretoken": [t for t, _ in top], "n": pa.array([n for _, n in top], pa.int64())})

    summaries = docs.select(F.col(f"`{text}`").alias("text")).mapInArrow(tidy(count), "pretoken string, n long")
    best = summaries.groupBy("pretoken").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "pretoken").limit(size)
    return [row["pretoken"] for row in best.collect()]


def compact_table(pretokens: list[str], path: str) -> tuple[bytes, bytes]:
    """Pre-tokens and their token counts as two byte strings: the texts with a zero-terminated layout, the counts as 16 bits."""
    known = [(t, n) for t, n in zip(pretokens, splitter(path).lengths(pretokens), strict=True) if "\0" not in t and n < 65_536]
    return "\0".join(t for t, _ in known).encode(), np.array([n for _, n in known], "<u2").tobytes()


def open_table(table: tuple[bytes, bytes]) -> dict[str, int]:
    texts, counts = table
    return dict(zip(texts.decode().split("\0"), np.frombuffer(counts, "<u2").tolist(), strict=True)) if counts else {}


def count_tokens(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", frequent: int = FREQUENT) -> DataFrame:
    """One row per document: the key, ``n_bytes`` and ``n_tokens`` of the whole text."""
    rows = docs.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    table = compact_table(frequent_pretokens(rows, "text", path, frequent), path)
    shared = docs.sparkSession.sparkContext.broadcast(table)
    # A worker lives on from query to query; its tables belong to one tokenizer and one broadcast table.
    name = (path, hashlib.blake2b(b"".join(table), digest_size=16).digest())
    kind = rows.schema["doc_id"].dataType.simpleString()

    def lookup() -> tuple[Splitter, dict[str, int], dict[str, int]]:
        if _state.get("table") != name:
            _state.update(table=name, known=open_table(shared.value), cache={})
        return splitter(path), _state["known"], _state["cache"]

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        sizes, totals = [], []
        for value in texts_of(batch, "text"):
            cut, known, cache = lookup()
            total, parts = cut.parts(value)
            for pretokens in (pretokens for part in parts for pretokens in cut.pieces(part)):
                if len(cache) > CACHE:
                    cache.clear()
                lengths = list(map(known.get, pretokens))
                if None in lengths:
                    rest = [t for t, n in zip(pretokens, lengths, strict=True) if n is None]
                    new = list({t for t in rest if t not in cache})
                    cache.update(zip(new, cut.lengths(new), strict=True))
                    total += sum(n for n in lengths if n is not None) + sum(map(cache.__getitem__, rest))
                else:
                    total += sum(lengths)
            sizes.append(len(value.encode("utf-8", "surrogatepass")))
            totals.append(total)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(totals, pa.int64())],
            names=["doc_id", "n_bytes", "n_tokens"],
        )

    return map_arrow(rows, run, f"doc_id {kind}, n_bytes long, n_tokens long")
