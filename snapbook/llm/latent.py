"""Benchmark decontamination by latent semantic retrieval with a longest-common-subsequence check.

The benchmark is the query set. It is read in shelves of items, so what is broadcast has a fixed bound; every shelf
meets every passage of every document. Texts become numbers of a shelf's words once, as a table in the shared folder that is dropped
when the shelf is done; other words keep their places and count as one unknown word. On that table, for each block of item parts:

1. document frequencies give TF-IDF weights;
2. a distributed randomised singular value decomposition of the TF-IDF passages (one pass over the rows, Nyström form:
   Halko, Martinsson and Tropp, 2011) gives the latent space; tasks send sums of fixed size only. Its rank grows with the block's parts,
   so a part keeps nearly its whole length in the space;
3. every window of three passages is compared with every part by the cosine in the latent space. Only for parts that keep less than
   ``KEPT`` of their length there, an exact rule adds candidates: of any n - need + k words of a part, a window that holds ``need`` of its n words
   has k; the rarest ones are counted in every window;
4. candidates are checked by their longest common subsequence of words and by the item's closing words, which carry
   its answer. A paraphrase that keeps most words in order is found as well as a quotation.

Rules: words are runs of letters and digits in lower case. Null and empty texts and items without a word match nothing.
Items with equal texts each get their rows; repeated documents repeat theirs. Items longer than a window's reach are searched in
equal parts and judged whole: a part that is found by ``LCS_WITH_ANSWER`` counts with its common words, another one with none, their sum over the
item's words is its share, and the closing words are the item's. Empty tables give an empty result. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, functions as F

from snapbook.llm.blocks import BYTE_CODES, row_groups, runs_of, texts_of, words_of_group
from snapbook.llm.shared import BUCKET_SCHEMA, bucket_sums, cut, emit_buckets, Stored, tidy

PASSAGE = 32
WINDOW_PASSAGES = 3
REACH = PASSAGE * (WINDOW_PASSAGES - 1)
RANK = 64
OVERSAMPLING = 8
COMMON = 0.10
ITEM_WEIGHT = 30.0
COSINE = 0.15
LCS_ALONE = 0.75
LCS_WITH_ANSWER = 0.55
ANSWER_WORDS = 8
ANSWER_SHARE = 0.75
# Bounds of what is broadcast: text of a shelf of items, and parts of a block that has a latent space of its own.
SHELF_BYTES = 1 << 18
BLOCK_PARTS = 256
# Share of its length that a part must keep in the space to be searched there alone.
KEPT = 0.9
NEAR_ROWS = 1_024
RARE_SHARE = 4
RARE_PAIRS = 1_000_000
CHUNK_WORDS = 60_000

# A word is a run of ASCII letters and digits and of bytes of other letters.
SEPARATORS = np.ones(256, bool)
SEPARATORS[48:58] = SEPARATORS[65:91] = SEPARATORS[97:123] = SEPARATORS[128:] = False


class Items:
    """A shelf of benchmark items as word numbers; parts of at most ``REACH`` words are what is searched."""

    def __init__(self, rows: list[Row]):
        words, borders = words_of_group([(r["text"] or "").lower() for r in rows], BYTE_CODES, SEPARATORS)
        self.vocabulary = np.unique(words)
        ids = np.searchsorted(self.vocabulary, words)
        self.item: list[object] = []
        self.parts: list[np.ndarray] = []
        self.number: list[int] = []  # of the item in the shelf, as items can share an id
        self.last: list[bool] = []
        self.sizes: list[int] = []
        for i, row in enumerate(rows):
            own = ids[borders[i] : borders[i + 1]]
            if len(own):
                pieces = np.array_split(own, -(-len(own) // REACH))
                self.parts += pieces
                self.item += [row["item_id"]] * len(pieces)
                self.number += [i] * len(pieces)
                self.last += [False] * (len(pieces) - 1) + [True]
                self.sizes += [len(own)] * len(pieces)

    def lookup(self, words: np.ndarray) -> np.ndarray:
        """Word numbers; words outside the vocabulary get the number after the last."""
        at = np.searchsorted(self.vocabulary, words)
        at[at == len(self.vocabulary)] = 0
        return np.where(self.vocabulary[at] == words, at, len(self.vocabulary)).astype(np.int32)

    def blocks(self, counts: np.ndarray, weights: np.ndarray) -> Iterator[Block]:
        for at in range(0, len(self.parts), BLOCK_PARTS):
            yield Block(self, at, counts, weights)


class Block:
    """Some parts of a shelf in numbers of their own words, with the counts and weights of these."""

    def __init__(self, items: Items, first: int, counts: np.ndarray, weights: np.ndarray):
        parts = items.parts[first : first + BLOCK_PARTS]
        words = np.unique(np.concatenate(parts))
        self.first, self.size, self.shelf_size = first, len(words), len(items.vocabulary)
        self.local = np.full(self.shelf_size + 1, self.size, np.int32)
        self.local[words] = np.arange(self.size)
        self.parts = [self.local[p].astype(np.int64) for p in parts]
        self.whole = [items.sizes[first + i] == len(p) for i, p in enumerate(parts)]
        self.last = items.last[first : first + BLOCK_PARTS]
        self.counts = np.append(counts[words], counts[-1])
        self.weights = np.append(weights[words], 0.0)

    def texts(self, batch: pa.RecordBatch) -> Iterator[tuple[int, list[np.ndarray]]]:
        """Texts in runs of about ``CHUNK_WORDS`` words, with the first one's row."""
        for lo, texts in chunks(batch, self.shelf_size):
            yield lo, [self.local[t] for t in texts]


def item_shelves(bench: DataFrame) -> Iterator[Items]:
    """The benchmark in shelves of about ``SHELF_BYTES``, streamed to the driver."""
    shelf, size = [], 0
    for row in bench.select("item_id", "text").orderBy("item_id", "text").toLocalIterator():
        shelf.append(row)
        size += len(row["text"] or "")
        if size >= SHELF_BYTES:
            yield Items(shelf)
            shelf, size = [], 0
    if shelf:
        yield Items(shelf)


def numbered_texts(rows: DataFrame, items: Items) -> Stored:
    """Per document the word numbers of its text, and per task the document counts of each word; written once for a shelf."""
    shared = rows.sparkSession.sparkContext.broadcast(items)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, id_type = shared.value, pa.int64()
        size = len(own.vocabulary)
        counts = np.zeros(size + 1, np.int64)
        for batch in batches:
            texts, packed, id_type = texts_of(batch, "text"), [], batch.column("doc_id").type
            for lo, hi in row_groups([len(t) for t in texts]):
                words, borders = words_of_group([t.lower() for t in texts[lo:hi]], BYTE_CODES, SEPARATORS)
                ids = own.lookup(words)
                for i in range(hi - lo):
                    part = ids[borders[i] : borders[i + 1]]
                    packed.append(part.astype("<i4").tobytes() if size > 65_000 else part.astype("<u2").tobytes())
                    known = np.zeros(size + 1, bool)
                    known[part] = True
                    known[size] = True
                    counts += known
            none = [None] * len(texts)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(packed, pa.binary()), pa.array(none, pa.int32()), pa.array(none, pa.binary())], names=names
            )
        segments = list(emit_buckets(counts))
        none = [None] * len(segments)
        if segments:
            yield pa.RecordBatch.from_arrays(
                [pa.array(none, id_type), pa.array(none, pa.binary()), pa.array([s for s, _ in segments], pa.int32()), pa.array([c for _, c in segments], pa.binary())],
                names=names,
            )

    names = ["doc_id", "ids", "segment", "counts"]
    return Stored(rows.mapInArrow(tidy(run), f"doc_id {kind}, ids binary, {BUCKET_SCHEMA}"), "numbered")


def unpacked(raw: bytes, size: int) -> np.ndarray:
    return np.frombuffer(raw, "<i4" if size > 65_000 else "<u2").astype(np.int32)


def passage_starts(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First word of every passage over texts laid end to end, and each passage's text."""
    counts = -(-lengths // PASSAGE)
    text = np.repeat(np.arange(len(lengths)), counts)
    inner = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    return (np.cumsum(lengths) - lengths)[text] + inner * PASSAGE, text


def chunks(batch: pa.RecordBatch, size: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    """Runs of non-empty texts of about ``CHUNK_WORDS`` words, with the first one's row; longer texts come alone."""
    texts = [unpacked(raw, size) for raw in batch.column("ids").to_pylist()]
    for lo, hi in row_groups([len(t) for t in texts], CHUNK_WORDS):
        if any(map(len, texts[lo:hi])):
            yield lo, texts[lo:hi]


def informative(items: Items, counts: np.ndarray) -> np.ndarray:
    """TF-IDF weight of every word; 0 for words of no use.

    Words of more than ``COMMON`` of the documents weigh nothing, unless they are among the rarer half of an item's
    words: so an item that is quoted in a large part of the corpus keeps words of its own.
    """
    size = len(items.vocabulary)
    kept = counts[:size] <= COMMON * counts[size]
    for part in items.parts:
        own = np.unique(part)
        kept[own[np.argsort(counts[own], kind="stable")[: -(-len(own) // 2)]]] = True
    weights = np.log((counts[size] + 1.0) / (counts + 1.0)) + 0.05
    return np.where(np.append(kept, False), weights, 0.0)


class Passages:
    """Passages of texts laid end to end, with the places of their informative words."""

    def __init__(self, texts: list[np.ndarray], weights: np.ndarray):
        lengths = np.array([len(t) for t in texts])
        self.ids = np.concatenate(texts)
        self.ends = np.cumsum(lengths)
        self.begins = self.ends - lengths
        self.starts, self.text = passage_starts(lengths)
        places = np.flatnonzero(weights[self.ids] > 0)
        self.words = self.ids[places]
        passage = np.searchsorted(self.starts, places, side="right") - 1
        self.first, _ = runs_of(passage)
        # Passages that have informative words; the others have a zero vector.
        self.used = passage[self.first]
        self.row = np.repeat(np.arange(len(self.first)), np.diff(np.append(self.first, len(places))))

    def sums(self, rows: np.ndarray) -> np.ndarray:
        """Sum of word rows for each passage in use, in slices of bounded size."""
        out = np.empty((len(self.first), *rows.shape[1:]), rows.dtype)
        at = 0
        while at < len(self.first):
            to = max(at + 1, int(np.searchsorted(self.first, self.first[at] + CHUNK_WORDS)))
            end = self.first[to] if to < len(self.first) else len(self.words)
            out[at:to] = np.add.reduceat(rows[self.words[self.first[at] : end]], self.first[at:to] - self.first[at], axis=0)
            at = to
        return out


class ItemRows:
    """Unit TF-IDF rows of the item parts, by their words only."""

    def __init__(self, block: Block):
        weights = block.weights
        pairs = [np.unique(part, return_counts=True) for part in block.parts]
        self.words = np.concatenate([w for w, _ in pairs])
        values = np.concatenate([n for _, n in pairs]) * weights[self.words]
        sizes = np.array([len(w) for w, _ in pairs])
        self.first = np.cumsum(sizes) - sizes
        length = np.sqrt(np.add.reduceat(values**2, self.first))
        self.part = np.repeat(np.arange(len(pairs)), sizes)
        self.values = (values / np.maximum(length, 1e-12)[self.part])[:, None]

    def times(self, matrix: np.ndarray) -> np.ndarray:
        """The rows times a matrix with a row for each word."""
        return np.add.reduceat(self.values * matrix[self.words], self.first, axis=0)

    def transposed_times(self, matrix: np.ndarray, words: int) -> np.ndarray:
        """The transposed rows times a matrix with a row for each part."""
        out = np.zeros((words, matrix.shape[1]))
        np.add.at(out, self.words, self.values * matrix[self.part])
        return out


def latent_space(table: DataFrame, block: Block) -> np.ndarray:
    """Right singular vectors (words x rank) of the unit TF-IDF passages together with the block's parts.

    One pass gives the sketch A'(A omega) of all passages; the parts' rows are added on the driver with a weight that
    keeps directions seen in few passages in the space. ``RANK`` directions and one for each part make up the space.
    """
    size, weights = block.size, block.weights
    rank = min(RANK + len(block.parts), size)
    width = min(rank + OVERSAMPLING, size)
    omega = np.random.default_rng(7).standard_normal((size + 1, width))
    squares = (weights**2).astype(np.float32)
    shared = table.sparkSession.sparkContext.broadcast(((omega * weights[:, None]).astype(np.float32), squares, block))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, squares, block = shared.value
        sums = np.zeros((size + 2, width), np.float64)
        for batch in batches:
            for _, texts in block.texts(batch):
                own = Passages(texts, block.weights)
                if not len(own.first):
                    continue
                sketch = own.sums(rows) / own.sums(squares)[:, None]
                sums[size + 1, 0] += len(own.first)
                order = np.argsort(own.words, kind="stable")
                for at in range(0, len(order), CHUNK_WORDS):
                    part = order[at : at + CHUNK_WORDS]
                    word = own.words[part]
                    first, _ = runs_of(word)
                    sums[word[first]] += np.add.reduceat(sketch[own.row[part]], first, axis=0)
        segments = list(emit_buckets(sums.ravel(), "<f8"))
        if segments:
            yield pa.RecordBatch.from_pydict({"segment": pa.array([s for s, _ in segments], pa.int32()), "counts": [c for _, c in segments]})

    parts = table.filter("segment is null").select("ids").mapInArrow(tidy(run), BUCKET_SCHEMA)
    sums = bucket_sums(parts, (size + 2) * width, "<f8").reshape(size + 2, width)
    rows, omega = ItemRows(block), omega[:size]
    corpus = sums[:size] * weights[:size, None] * (len(block.parts) / max(sums[size + 1, 0], 1.0))
    gram = corpus + ITEM_WEIGHT * rows.transposed_times(rows.times(omega), size)
    values, vectors = np.linalg.eigh((omega.T @ gram + gram.T @ omega) / 2)
    good = values > 1e-10 * max(values.max(initial=0.0), 1e-12)
    left, _, _ = np.linalg.svd(gram @ (vectors[:, good] / np.sqrt(values[good])), full_matrices=False)
    return left[:, :rank]


def common_length(masks: dict[int, int], size: int, words: list[int]) -> int:
    """Longest common subsequence with an item given as bit masks (Hyyrö, 2004)."""
    full = (1 << size) - 1
    state = full
    for w in words:
        hit = masks.get(w)
        if hit:
            same = state & hit
            state = ((state + same) | (state - same)) & full
    return size - state.bit_count()


def bit_masks(words: np.ndarray) -> dict[int, int]:
    masks: dict[int, int] = {}
    for i, w in enumerate(words.tolist()):
        masks[w] = masks.get(w, 0) | 1 << i
    return masks


class RareWords:
    """Exact candidates: windows that have enough of an item part's rarest words to hold the least share of the part.

    A word that stands in several passages of a window counts for each of them, so counts are never too small. ``asked`` names the parts
    that are searched so.
    """

    def __init__(self, parts: list[np.ndarray], counts: np.ndarray, asked: np.ndarray):
        words, times, sizes, self.least = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [], np.zeros(len(parts), np.int64)
        for i in asked.tolist():
            part = parts[i]
            need = max(1, int(np.ceil(LCS_WITH_ANSWER * len(part) - 1e-9)))
            self.least[i] = -(-need // RARE_SHARE)
            rare = part[np.lexsort((part, counts[part]))[: len(part) - need + self.least[i]]]
            word, n = np.unique(rare, return_counts=True)
            words.append(word)
            times.append(n)
            sizes.append(len(word))
        word, part = np.concatenate(words), np.repeat(asked, sizes)
        order = np.argsort(word, kind="stable")
        self.part, self.times = part[order], np.concatenate(times)[order]
        self.first = np.searchsorted(word[order], np.arange(len(counts) + 1))

    def candidates(self, own: Passages) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Windows and item parts, in slices of bounded size."""
        if not len(self.part):
            return
        sizes = np.diff(self.first)
        places = np.flatnonzero(sizes[own.ids])
        passage = np.searchsorted(own.starts, places, side="right") - 1
        passage, word = np.divmod(np.unique(passage * len(sizes) + own.ids[places]), len(sizes))
        pairs = np.cumsum(sizes[word])
        at, total = 0, len(own.starts)
        begins = np.searchsorted(passage, np.arange(total + WINDOW_PASSAGES))
        ahead = np.append(0, pairs)[begins]
        while at < total:
            # Windows from ``at`` to ``to`` read passages up to the last window's end.
            to = max(at + 1, int(np.searchsorted(ahead, ahead[at] + RARE_PAIRS, side="right")) - WINDOW_PASSAGES)
            to = min(to, total)
            rows = slice(begins[at], begins[min(to + WINDOW_PASSAGES - 1, total)])
            n = sizes[word[rows]]
            inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            entry = np.repeat(self.first[word[rows]], n) + inner
            home = np.repeat(passage[rows], n)
            keys, times = [], []
            for shift in range(WINDOW_PASSAGES):
                window = home - shift
                good = (window >= at) & (window < to)
                good &= own.text[np.maximum(window, 0)] == own.text[home]
                keys.append(window[good] * len(self.least) + self.part[entry[good]])
                times.append(self.times[entry[good]])
            key, where = np.unique(np.concatenate(keys), return_inverse=True)
            if len(key):
                have = np.bincount(where, weights=np.concatenate(times))
                window, part = np.divmod(key, len(self.least))
                enough = have >= self.least[part]
                yield window[enough], part[enough]
            at = to


def search(table: DataFrame, block: Block, space: np.ndarray, latent: bool = True, exact: bool = True) -> DataFrame:
    """Rows (doc_id, part, first_word, cosine, matched, answer_share) for every window that an item part is found in.

    The cosine is the latent inner product of window and part over the window's full TF-IDF length and the part's
    latent length, so a window with little in the space cannot come near by chance. For parts that keep less than ``KEPT`` of their length in the space,
    windows with enough of their rare words are checked whatever the cosine. ``latent`` and ``exact`` leave out one of the ways, to measure the other.
    """
    size, weights = block.size, block.weights
    rows = np.zeros((size + 1, space.shape[1] + 1), np.float32)
    rows[:size, :-1] = space * weights[:size, None]
    rows[:, -1] = weights**2
    queries = ItemRows(block).times(space)
    kept = np.linalg.norm(queries, axis=1)
    queries = (queries / np.maximum(kept[:, None], 1e-12)).astype(np.float32)
    low = np.flatnonzero(kept < KEPT) if exact else np.zeros(0, np.int64)
    shared = table.sparkSession.sparkContext.broadcast((rows, queries, block, RareWords(block.parts, block.counts, low)))
    kind = table.schema["doc_id"].dataType.simpleString()
    least = COSINE if latent else np.inf

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, queries, block, rare = shared.value
        parts = block.parts
        masks = [bit_masks(p) for p in parts]
        tails = [(bit_masks(p[-ANSWER_WORDS:]), len(p[-ANSWER_WORDS:])) for p in parts]
        for batch in batches:
            found: list[tuple] = []
            ids_of = batch.column("doc_id")
            for lo, texts in block.texts(batch):
                own = Passages(texts, block.weights)
                sums = np.zeros((len(own.starts), rows.shape[1]), np.float32)
                sums[own.used] = own.sums(rows)
                window = sums.copy()
                for shift in range(1, WINDOW_PASSAGES):
                    same = own.text[shift:] == own.text[:-shift]
                    window[:-shift][same] += sums[shift:][same]
                length = np.sqrt(np.maximum(window[:, -1], 1e-12))
                rarely = [np.concatenate(x) for x in zip((np.zeros(0, np.int64), np.zeros(0, np.int64)), *rare.candidates(own), strict=True)]
                for at in range(0, len(window), NEAR_ROWS):
                    near = (window[at : at + NEAR_ROWS, :-1] @ queries.T) / length[at : at + NEAR_ROWS, None]
                    asked = near >= least
                    mine = slice(*np.searchsorted(rarely[0], [at, at + NEAR_ROWS]))
                    asked[rarely[0][mine] - at, rarely[1][mine]] = True
                    for w, q in zip(*np.nonzero(asked), strict=True):
                        first, text = own.starts[at + w], own.text[at + w]
                        words = own.ids[first : min(first + PASSAGE * WINDOW_PASSAGES, own.ends[text])].tolist()
                        n, mask = len(parts[q]), masks[q]
                        words = [x for x in words if x in mask]
                        if len(words) < LCS_WITH_ANSWER * n:
                            continue
                        matched = common_length(mask, n, words)
                        if matched < LCS_WITH_ANSWER * n:
                            continue
                        tail, m = tails[q]
                        answer = common_length(tail, m, words) / m if block.last[q] else 0.0
                        # A part of a longer item is judged with the others.
                        if not block.whole[q] or matched >= LCS_ALONE * n or answer >= ANSWER_SHARE:
                            found.append((lo + int(text), block.first + int(q), int(first - own.begins[text]), float(near[w, q]), matched, answer))
            if found:
                row, *rest = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays([ids_of.take(pa.array(row, pa.int64())), *map(pa.array, rest)], names=names)

    names = ["doc_id", "part", "first_word", "cosine", "matched", "answer_share"]
    found = table.filter("segment is null").select("doc_id", "ids")
    return found.mapInArrow(tidy(run), f"doc_id {kind}, part long, first_word long, cosine double, matched long, answer_share double")


def judged(found: DataFrame, items: Items, item_type: str) -> DataFrame:
    """Found windows of parts as documents and whole items."""
    rows = list(zip(range(len(items.item)), items.item, items.number, items.sizes, strict=True))
    named = found.sparkSession.createDataFrame(rows, f"part long, item_id {item_type}, number long, size long")
    best = F.max(F.struct("matched", "answer_share", "cosine", (-F.col("first_word")).alias("back")))
    parts = found.groupBy("doc_id", "part").agg(best.alias("best"), F.max("answer_share").alias("answer"))
    top = F.max(F.struct("best.matched", "best.cosine", "best.back"))
    whole = (
        parts.join(F.broadcast(named), "part").groupBy("doc_id", "number", "item_id", "size")
        .agg(F.sum("best.matched").alias("matched"), F.max("answer").alias("answer_share"), top.alias("best"))
        .withColumn("lcs_share", F.col("matched") / F.col("size"))
        .filter((F.col("lcs_share") >= LCS_ALONE) | (F.col("lcs_share") >= LCS_WITH_ANSWER) & (F.col("answer_share") >= ANSWER_SHARE))
    )
    first = F.max(F.struct("lcs_share", "answer_share", "best.cosine", "best.back"))
    return (
        whole.groupBy("doc_id", "item_id").agg(first.alias("best"))
        .select("doc_id", "item_id", (-F.col("best.back")).alias("first_word"), "best.cosine", "best.lcs_share", "best.answer_share")
    )


def leaks(docs: DataFrame, bench: DataFrame, key: str = "doc_id", text: str = "text", latent: bool = True, exact: bool = True) -> DataFrame:
    """One row for each document and benchmark item found in it: the best window's place, cosine and shares.

    ``found_by`` is ``latent`` where the cosine made the best window a candidate, else ``rare words``.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    item_type = bench.schema["item_id"].dataType.simpleString()
    kind = rows.schema["doc_id"].dataType.simpleString()
    found = None
    for items in item_shelves(bench):
        if not items.parts:
            continue
        stored = numbered_texts(rows, items)
        table = stored.frame
        counts = bucket_sums(table.filter("segment is not null"), len(items.vocabulary) + 1)
        windows = None
        for block in items.blocks(counts, informative(items, counts)):
            part = search(table, block, latent_space(table, block), latent, exact)
            windows = part if windows is None else windows.unionByName(part)
        shelf = cut(judged(windows, items, item_type))
        stored.drop()
        found = shelf if found is None else found.unionByName(shelf)
    schema = f"doc_id {kind}, item_id {item_type}, first_word long, cosine double, lcs_share double, answer_share double"
    found = spark.createDataFrame([], schema) if found is None else found
    return found.withColumn("found_by", F.when(F.col("cosine") >= COSINE, "latent").otherwise("rare words"))
