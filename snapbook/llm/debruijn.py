"""Repeated word spans across documents by compaction of a De Bruijn graph.

The edges of the graph are word k-mers: all windows of 50 consecutive words. Neighbouring windows of a document that
share one anchor (the 15-gram with the smallest hash inside the window) form a nonbranching path; it is one row with
the hash of all its words, about one for eighteen windows. Equal windows have equal anchors, so only anchors found in two or
more different texts matter, and joins on them do the compaction:

* texts with the same words are one node set, owned by the smallest document id;
* equal paths of an anchor collapse to their first owner; every later owner's windows are repeated as a whole;
* where an anchor has several paths (the path branches: a passage begins or ends there), all windows of the first
  owner of each path are compared one by one, again by a join on their hashes.

Every found span has a source (text and place). Spans are put together along source coordinates and verified:
the words of both places are read again and compared by digest.

Rules: null and empty texts have no words. A text with fewer words than a window never loses any. Rows with the same words: those with
the smallest document id are judged, the others repeat them and lose all words. Document ids are whole numbers (others must be numbered first); a null id is larger than every
other, so such rows never are a source for rows with an id. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from snapbook.llm.blocks import chosen_places, gram_hashes, mix, powers, row_groups, runs_of, signed, texts_of, union, words_of_group
from snapbook.llm.shared import cut, map_arrow, tidy

WORD = re.compile(r"[^\x20\x09-\x0D]+")
WINDOW = 50
ANCHOR = 15
LAST_ID = (1 << 63) - 1
NO_WORDS = hashlib.sha256(b"").hexdigest()


def content_of(words: np.ndarray) -> int:
    """Hash of a word sequence and its length."""
    whole = gram_hashes(words, len(words)) if len(words) else np.zeros(1, np.uint64)
    return int(signed(mix(whole + np.uint64(len(words))))[0])


def paths_of(words: np.ndarray) -> tuple[np.ndarray, ...]:
    """Anchor hash, path hash, first and last window of each path of a text."""
    if len(words) < WINDOW:
        none = np.zeros(0, np.int64)
        return none, none, none, none
    grams = gram_hashes(words, ANCHOR)
    places = chosen_places(grams, WINDOW - ANCHOR + 1)
    first, last = runs_of(places)
    up, down = powers(len(words))
    sums = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * up[: len(words)], out=sums[1:])
    path = mix((sums[last + WINDOW] - sums[first]) * down[first] + (last - first).astype(np.uint64))
    return signed(grams[places[first]]), signed(path), first, last


def text_table(docs: DataFrame, key: str, text: str) -> DataFrame:
    """One row per document with its word count, content hash, digest and paths; written once.

    A task that meets a content again does not repeat its paths.
    """
    rows = docs.select(
        F.col(f"`{key}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"), F.xxhash64(F.col(f"`{text}`")).alias("text_key")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            texts = texts_of(batch, "text")
            counts, contents, digests, paths = [], [], [], []
            for lo, hi in row_groups([len(t) for t in texts]):
                words, borders = words_of_group(texts[lo:hi])
                for i in range(hi - lo):
                    own = words[borders[i] : borders[i + 1]]
                    content = content_of(own)
                    counts.append(len(own))
                    contents.append(content)
                    digests.append(hashlib.sha256(b" ".join(texts[lo + i].encode("utf-8", "surrogatepass").split())).hexdigest())
                    if content in seen or len(own) < WINDOW:
                        paths.append(None)
                        continue
                    if len(seen) > 500_000:
                        seen.clear()
                    seen.add(content)
                    paths.append(np.stack(paths_of(own), 1).astype("<i8").tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), pa.array(counts, pa.int64()), pa.array(contents, pa.int64()), pa.array(digests), pa.array(paths, pa.binary())],
                names=["doc_id", "text_key", "n_words", "content", "digest", "paths"],
            )

    return cut(rows.mapInArrow(tidy(run), "doc_id long, text_key long, n_words long, content long, digest string, paths binary"))


def path_rows(owned: DataFrame) -> DataFrame:
    """The packed paths as rows (anchor, path, first, last) with content and owner."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        parts = [np.frombuffer(raw, "<i8").reshape(-1, 4) for raw in batch.column("paths").to_pylist()]
        sizes = [len(p) for p in parts]
        flat = np.concatenate(parts)
        repeat = [pa.array(np.repeat(batch.column(c).to_numpy(zero_copy_only=False), sizes)) for c in ("content", "owner")]
        yield pa.RecordBatch.from_arrays([*(pa.array(np.ascontiguousarray(flat[:, i])) for i in range(4)), *repeat], names=names)

    names = ["anchor", "path", "first", "last", "content", "owner"]
    rows = owned.filter("paths is not null").select("content", "owner", "paths")
    return map_arrow(rows, run, ", ".join(f"{n} long" for n in names))


def wanted_texts(docs: DataFrame, key: str, text: str, contents: DataFrame) -> DataFrame:
    """Content hash, owner and text of the given contents; the one join that moves texts."""
    rows = docs.select(F.coalesce(F.col(f"`{key}`").cast("long"), F.lit(LAST_ID)).alias("owner"), F.col(f"`{text}`").alias("text"))

    def check(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        texts, contents = texts_of(batch, "text"), batch.column("content").to_pylist()
        good = []
        for lo, hi in row_groups([len(t) for t in texts]):
            words, borders = words_of_group(texts[lo:hi])
            good += [content_of(words[borders[i] : borders[i + 1]]) == contents[lo + i] for i in range(hi - lo)]
        yield batch.filter(pa.array(good, pa.bool_()))

    joined = rows.join(contents, "owner").select("content", "owner", "text")
    # An id can stand on several rows; the row whose words give the content is the one, and one such row is enough.
    return cut(map_arrow(joined, check, joined.schema).dropDuplicates(["content", "owner"]))


def branching_windows(texts: DataFrame, requests: DataFrame) -> DataFrame:
    """Hash, owner, content and place of every window of the requested paths; written once."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        value, runs = texts_of(batch, "text"), batch.column("runs").to_pylist()
        owner, content = batch.column("owner").to_pylist(), batch.column("content").to_pylist()
        for lo, hi in row_groups([len(t) for t in value]):
            words, borders = words_of_group(value[lo:hi])
            out: list[tuple[np.ndarray, ...]] = []
            for i in range(lo, hi):
                hashes = signed(gram_hashes(words[borders[i - lo] : borders[i - lo + 1]], WINDOW))
                at = np.unique(np.concatenate([np.arange(r["first"], r["last"] + 1) for r in runs[i]]))
                out.append((hashes[at], np.full(len(at), owner[i]), np.full(len(at), content[i]), at))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out, strict=True)], names=["window", "owner", "content", "place"])

    ready = texts.join(requests, "content").select("content", "owner", "text", "runs")
    return cut(map_arrow(ready, run, "window long, owner long, content long, place long"))


def found_spans(owned: DataFrame, docs: DataFrame, key: str, text: str) -> tuple[DataFrame, DataFrame]:
    """Repeated windows as rows (content, first, last, source, source_first), and the texts they refer to."""
    paths = path_rows(owned)
    shared = (
        paths.groupBy("anchor").agg(F.min("content").alias("low"), F.max("content").alias("high")).filter("low != high").select("anchor")
    )
    # The anchors are written first: the join then is a plain one, whose hot keys can be split.
    paths = cut(paths.join(cut(shared), "anchor"))
    texts = wanted_texts(docs, key, text, paths.select("content", "owner").distinct())
    holder = F.struct("owner", "content", "first", "last")
    heads = cut(paths.groupBy("anchor", "path").agg(F.min(holder).alias("head")))
    # Equal paths: all windows of a later owner repeat the head's.
    whole = paths.join(heads, ["anchor", "path"]).filter(F.col("owner") > F.col("head.owner")).select(
        "content", "first", "last", F.col("head.content").alias("source"), F.col("head.first").alias("source_first")
    )
    # Anchors with several paths: the windows of each path's first owner are compared one by one, wherever the path lies in its texts.
    branching = heads.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("anchor")
    asked = heads.join(branching, "anchor").select("anchor", "path", F.col("head.owner").alias("owner"))
    requests = paths.join(asked, ["anchor", "path", "owner"]).groupBy("content").agg(
        F.collect_set(F.struct("first", "last")).alias("runs")
    )
    windows = branching_windows(texts, requests)
    firsts = windows.groupBy("window").agg(
        F.min(F.struct("owner", "content", "place")).alias("head"), F.max("owner").alias("most")
    ).filter(F.col("most") > F.col("head.owner"))
    single = windows.join(firsts, "window").filter(F.col("owner") > F.col("head.owner")).select(
        "content", F.col("place").alias("first"), F.col("place").alias("last"), F.col("head.content").alias("source"), F.col("head.place").alias("source_first")
    )
    return whole.unionByName(single), texts


def compact(spans: DataFrame) -> DataFrame:
    """Spans of a text put together where they touch and their source coordinates run in parallel.

    The group of a text is bounded by the text's own length.
    """

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        out = []
        for content, spans in zip(batch.column("content").to_pylist(), batch.column("spans"), strict=True):
            flat = spans.values
            first, last, source, at = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("first", "last", "source", "source_first"))
            shift = at - first
            order = np.lexsort((first, shift, source))
            first, last, source, shift = first[order], last[order], source[order], shift[order]
            lines = np.concatenate([[0], np.cumsum((source[1:] != source[:-1]) | (shift[1:] != shift[:-1]))])
            stride = int(last.max()) + 3
            a, b = union(first + lines * stride, last + 1 + lines * stride)
            line = a // stride
            head = np.searchsorted(lines, line)
            out.append((np.full(len(a), content), a - line * stride, b - line * stride + WINDOW - 1, source[head], a - line * stride + shift[head]))
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out, strict=True)], names=names)

    names = ["content", "begin", "end", "source", "source_begin"]
    grouped = spans.groupBy("content").agg(F.collect_list(F.struct("first", "last", "source", "source_first")).alias("spans"))
    return cut(map_arrow(grouped, run, ", ".join(f"{n} long" for n in names)))


def verified(spans: DataFrame, texts: DataFrame) -> DataFrame:
    """The spans whose words equal those at the source coordinates."""

    def digests(asked: DataFrame, name: str) -> DataFrame:
        def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            value, asks, content = texts_of(batch, "text"), batch.column("asks").to_pylist(), batch.column("content").to_pylist()
            rows = []
            for t, own, c in zip(value, asks, content, strict=True):
                words = t.encode("utf-8", "surrogatepass").split()
                rows += [(c, r["begin"], r["end"], hashlib.blake2b(b" ".join(words[r["begin"] : r["end"]]), digest_size=16).digest()) for r in own]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows, strict=True)], names=["content", "begin", "end", name])

        grouped = asked.groupBy("content").agg(F.collect_set(F.struct("begin", "end")).alias("asks"))
        return map_arrow(texts.join(grouped, "content").select("content", "text", "asks"), run, f"content long, begin long, end long, {name} binary")

    own = digests(spans.select("content", "begin", "end"), "own_words")
    there = digests(
        spans.select(F.col("source").alias("content"), F.col("source_begin").alias("begin"), (F.col("source_begin") + F.col("end") - F.col("begin")).alias("end")),
        "source_words",
    ).select(F.col("content").alias("source"), F.col("begin").alias("source_begin"), F.col("end").alias("source_end"), "source_words")
    placed = spans.withColumn("source_end", F.expr("source_begin + end - begin"))
    return placed.join(own, ["content", "begin", "end"]).join(there, ["source", "source_begin", "source_end"]).filter(
        "own_words = source_words"
    ).select(*spans.columns)


class RepeatedWords:
    """Tables of one run over ``docs``: ``documents`` (doc_id, text_key, n_words, content, owner, digest), ``spans`` (content, begin, end in
    words, source, source_begin; verified) and ``texts`` of the contents involved."""

    def __init__(self, docs: DataFrame, key: str = "doc_id", text: str = "text"):
        table = text_table(docs, key, text)
        owners = table.groupBy("content").agg(F.coalesce(F.min("doc_id"), F.lit(LAST_ID)).alias("owner"))
        owned = cut(table.join(owners, "content"))
        found, self.texts = found_spans(owned, docs, key, text)
        self.spans = cut(verified(compact(found), self.texts))
        self.documents = owned.drop("paths")

    def removed(self) -> DataFrame:
        """Per content that loses words: their union as ``cuts`` (begin, end)."""
        return self.spans.groupBy("content").agg(F.collect_list(F.struct("begin", "end")).alias("cuts"))

    def remaining(self, docs: DataFrame, key: str = "doc_id", text: str = "text", length: str | None = None) -> DataFrame:
        """``docs``, the frame of this run, without the repeated words and without rows that have nothing left; all columns.

        A removed span goes with the space behind it, the rest of the text stays as it is. ``length`` names a column that
        holds the text's length in characters.
        """
        judged = F.coalesce("doc_id", F.lit(LAST_ID)) == F.col("owner")
        copies = self.documents.filter(~judged & (F.col("n_words") >= WINDOW))
        cuts = self.documents.filter(judged).join(self.removed(), "content").select("doc_id", "text_key", "cuts")
        whole = F.array(F.struct(F.lit(0).cast("long").alias("begin"), F.col("n_words").alias("end")))
        edits = cuts.unionByName(copies.select("doc_id", "text_key", whole.alias("cuts"))).dropDuplicates(["doc_id", "text_key"])
        edits = edits.select(F.col("doc_id").alias("_edit_id"), F.col("text_key").alias("_edit_key"), F.col("cuts").alias("_cuts"))
        same = F.col(f"`{key}`").cast("long").eqNullSafe(F.col("_edit_id")) & (F.xxhash64(F.col(f"`{text}`")) == F.col("_edit_key"))
        joined = docs.join(edits, same, "left").select(*(F.col(f"`{c}`") for c in docs.columns), "_cuts")
        at, at_length = docs.columns.index(text), docs.columns.index(length) if length else None

        def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            columns = [batch.column(i) for i in range(len(docs_columns))]
            cuts, texts = batch.column(batch.num_columns - 1), columns[at].to_pylist()
            changed = [i for i in range(batch.num_rows) if cuts[i].is_valid]
            for i in changed:
                texts[i] = without_words(texts[i], *cut_lists(cuts[i]))
            if changed:
                columns[at] = pa.array(texts, columns[at].type)
                if at_length is not None:
                    sizes = columns[at_length].to_pylist()
                    for i in changed:
                        sizes[i] = len(texts[i])
                    columns[at_length] = pa.array(sizes, columns[at_length].type)
            out = pa.RecordBatch.from_arrays(columns, names=docs_columns)
            gone = {i for i in changed if not texts[i]}
            yield out.filter(pa.array([i not in gone for i in range(batch.num_rows)], pa.bool_())) if gone else out

        docs_columns = docs.columns
        return map_arrow(joined, run, docs.schema)

    def summary(self) -> DataFrame:
        """One row per document: ``doc_id``, ``n_words``, ``n_removed`` and the digest of the kept words."""

        def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            counts, digests = [], []
            for t, cuts in zip(texts_of(batch, "text"), batch.column("cuts"), strict=True):
                words = t.encode("utf-8", "surrogatepass").split()
                a, b = cut_lists(cuts)
                kept = [w for lo, hi in zip(np.concatenate([[0], b]), np.concatenate([a, [len(words)]]), strict=True) for w in words[lo:hi]]
                counts.append(len(words) - len(kept))
                digests.append(hashlib.sha256(b" ".join(kept)).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column("content"), pa.array(counts, pa.int64()), pa.array(digests)], names=["content", "lost", "left"])

        changed = map_arrow(self.texts.join(self.removed(), "content").select("content", "text", "cuts"), run, "content long, lost long, left string")
        judged = F.coalesce("doc_id", F.lit(LAST_ID)) == F.col("owner")
        short = F.col("n_words") < WINDOW
        return self.documents.join(changed, "content", "left").select(
            "doc_id", "n_words",
            F.when(judged, F.coalesce("lost", F.lit(0))).when(short, F.lit(0)).otherwise(F.col("n_words")).cast("long").alias("n_removed"),
            F.when(judged, F.coalesce("left", "digest")).when(short, F.col("digest")).otherwise(F.lit(NO_WORDS)).alias("kept_sha256"),
        )


def cut_lists(cuts: pa.Scalar) -> tuple[np.ndarray, np.ndarray]:
    flat = cuts.values
    return union(flat.field("begin").to_numpy(zero_copy_only=False), flat.field("end").to_numpy(zero_copy_only=False))


def without_words(text: str, begins: np.ndarray, ends: np.ndarray) -> str:
    """A text without the words in the given runs; each run goes with the space behind it."""
    words = [m.start() for m in WORD.finditer(text)]
    starts = [*words, len(text)]
    kept, at = [], 0
    for a, b in zip(begins.tolist(), ends.tolist(), strict=True):
        kept.append(text[at : starts[a]])
        at = starts[b]
    kept.append(text[at:])
    left = "".join(kept)
    return left if WORD.search(left) else ""
