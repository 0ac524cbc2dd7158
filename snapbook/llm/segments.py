"""SentencePiece encoding with sampled segmentations: Gumbel top-k without replacement over the lattice of pieces.

A text's lattice has a path for every way to write it in pieces. Pieces never cross a word border, so the lattice is a
chain of word lattices; these are built once for each distinct word of a group of texts, in numpy. A path's weight is
the product of its pieces' weights, a power of 1 / (2 + rank) where the model ranks pieces by merge order.

The search perturbs path probabilities by Gumbel noise and emits the k best paths in order (Kool, van Hoof and
Welling, 2019; Maddison, Tarlow and Minka, 2014). It is an A* search: the sums of all completions (one backward pass) are an
exact bound, so an opened set of paths is followed straight to its best member. A set is all paths that share a prefix
and leave it at its end; when its best path is emitted, the set falls apart into one set for each step of that path. Only
these sets' perturbed sums are kept, never their paths. Paths are distinct by construction. The noise is a hash of the row's
key, so a rerun of a lost task gives the same samples.

The inclusion score is the probability that a path is among the k, given the (k + 1)-th perturbed value, as used in
weighted estimates without replacement. Pieces are packed as 16-bit numbers.

Rules: a null or empty text has one segmentation, the empty one. A text with fewer than k segmentations gives
all of them, each with inclusion 1. Repeated rows (same key and text) give the same samples. Characters that are no piece become bytes.
A word of any length is handled in time proportional to its length.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from snapbook.llm.blocks import mix, row_groups, texts_of
from snapbook.llm.shared import map_arrow

GROUP = 1 << 20
SAMPLES = 2
POWER = 1.0
LINEAR = 15
CHAR_WEIGHT = 3.0
SPACE = "▁"
WORDS = re.compile(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n")
TOKEN_STEP, PIECE_STEP, PATH_STEP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)

_models: dict[tuple[str, float], Pieces] = {}


def times(number: int, step: np.uint64) -> np.uint64:
    """A product modulo 2**64."""
    return np.uint64(number * int(step) & 0xFFFFFFFFFFFFFFFF)


def uniform(keys: np.ndarray) -> np.ndarray:
    """Numbers inside (0, 1) from hashed keys."""
    return ((mix(keys) >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


class Pieces:
    """Pieces of a model as a trie with transitions in one sorted array."""

    def __init__(self, path: str, power: float):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.texts = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        usual = [i for i in range(len(self.texts)) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        self.byte = {int(t[3:5], 16): i for i, t in enumerate(self.texts) if model.is_byte(i)}
        # Characters that are no piece get numbers after the last piece and are written out as bytes.
        self.extra = len(self.texts)
        self.byte_weight = -power * math.log(2 + len(usual))
        states: dict[tuple[int, int], int] = {}
        ends: dict[int, tuple[int, float]] = {}
        for rank, i in enumerate(usual):
            state = 0
            for c in self.texts[i]:
                state = states.setdefault((state, ord(c)), len(states) + 1)
            ends[state] = (i, -power * math.log(2 + rank))
        keys = np.array([(s << 21) | c for s, c in states], np.int64)
        order = np.argsort(keys)
        self.keys, self.next = keys[order], np.array(list(states.values()), np.int64)[order]
        # The first step, from the root, is a plain table over characters.
        self.root = np.zeros(0x110000, np.int32)
        for (s, c), state in states.items():
            if s == 0:
                self.root[c] = state
        self.piece, self.weight = np.full(len(states) + 1, -1, np.int64), np.zeros(len(states) + 1)
        for state, (i, w) in ends.items():
            self.piece[state], self.weight[state] = i, w

    def step(self, states: np.ndarray, chars: np.ndarray) -> np.ndarray:
        """States after a character; 0 where no piece goes on."""
        key = (states << 21) | chars
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.next[at], 0)

    def written(self, ids: np.ndarray) -> np.ndarray:
        """Piece numbers with the extra characters as their bytes."""
        extra = ids >= self.extra
        if not extra.any():
            return ids.astype("<u2")
        out: list[int] = []
        for i in ids.tolist():
            out += [i] if i < self.extra else [self.byte[b] for b in chr(i - self.extra).encode("utf-8", "surrogatepass")]
        return np.array(out, "<u2")

    def decode(self, ids: np.ndarray) -> str:
        """The text of a sequence of pieces: byte pieces joined, space marks as spaces, the leading mark dropped."""
        values = {i: bytes([b]) for b, i in self.byte.items()}
        raw = b"".join(values[i] if i in values else self.texts[i].encode() for i in ids.tolist())
        return raw.decode("utf-8", "surrogatepass").replace(SPACE, " ")[1:]


def pieces(path: str, power: float = POWER) -> Pieces:
    if (path, power) not in _models:
        _models[path, power] = Pieces(path, power)
    return _models[path, power]


class Lattice:
    """The lattices of distinct words laid end to end; nodes are characters, edges are pieces with probabilities."""

    def __init__(self, model: Pieces, words: list[str]):
        chars = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        sizes = np.array([len(w) for w in words], np.int64)
        self.end = np.cumsum(sizes)
        self.start = self.end - sizes
        limit = np.repeat(self.end, sizes)
        total = len(chars)
        alive, states = np.arange(total), np.zeros(total, np.int64)
        begins, spans, ids, weights = [], [], [], []
        length = 0
        while len(alive):
            length += 1
            states = model.root[chars].astype(np.int64) if length == 1 else model.step(states, chars[alive + length - 1])
            if length == 1:
                missing = np.flatnonzero((states == 0) | (model.piece[states] < 0))
                code = chars[missing]
                count = np.where(code < 0x80, 1, np.where(code < 0x800, 2, np.where(code < 0x10000, 3, 4)))
                single = np.array([model.byte[c] if c < 0x80 else model.extra + c for c in code.tolist()], np.int64)
                begins.append(missing), spans.append(np.ones(len(missing), np.int64)), ids.append(single), weights.append(count * model.byte_weight)
            whole = np.flatnonzero((states > 0) & (model.piece[states] >= 0))
            begins.append(alive[whole]), spans.append(np.full(len(whole), length)), ids.append(model.piece[states[whole]]), weights.append(model.weight[states[whole]])
            on = (states > 0) & (alive + length < limit[alive])
            alive, states = alive[on], states[on]
        # Edges of a node stand together, long pieces first: they are likely, so few edges are looked at when one is drawn.
        begin, span, ids, weight = (np.concatenate(x[::-1]) for x in (begins, spans, ids, weights))
        order = np.argsort(begin, kind="stable")
        self.begin, span, self.ids, weight = begin[order], span[order], ids[order], weight[order]
        self.to = self.begin + span
        self.last = self.to == limit[self.begin]
        self.first = np.searchsorted(self.begin, np.arange(total + 1))
        self.prob = np.empty(len(self.ids))
        long = np.repeat(sizes > LINEAR, sizes)
        for linear in (True, False):
            self._fill(np.flatnonzero(long != linear), weight, span, limit - np.arange(total), linear)
        self.prob = np.clip(self.prob, 1e-300, 1.0)
        # Running sums node by node, so that a draw does not depend on the other words of the group.
        self.upto = self.prob.copy()
        count = np.diff(self.first)
        for k in range(1, int(count.max(initial=0))):
            at = self.first[:-1][count > k] + k
            self.upto[at] += self.upto[at - 1]
        self.upto[self.first[1:] - 1] = 2.0

    def _fill(self, nodes: np.ndarray, weight: np.ndarray, span: np.ndarray, left: np.ndarray, linear: bool) -> None:
        """Edge probabilities of the given nodes from backward sums, all nodes with the same number of characters left at once.

        Every completion of a node spells the same characters, so a factor for each character cancels; with it plain sums stay in range
        for words of ``LINEAR`` characters, even where each is written in bytes. Longer words are summed as logarithms.
        """
        total = len(left)
        value = np.exp(weight + CHAR_WEIGHT * span) if linear else weight.copy()
        sums = np.ones(total + 1) if linear else np.zeros(total + 1)
        nodes = nodes[np.argsort(left[nodes], kind="stable")]
        cuts = np.searchsorted(left[nodes], np.arange(1, int(left[nodes].max(initial=0)) + 2))
        to = np.where(self.last, total, self.to)
        sizes = np.diff(self.first)
        add = np.add if linear else np.logaddexp
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            own = nodes[a:b]
            if len(own):
                size = sizes[own]
                border = np.cumsum(size) - size
                edges = np.arange(int(size.sum())) + np.repeat(self.first[own] - border, size)
                value[edges] = value[edges] * sums[to[edges]] if linear else value[edges] + sums[to[edges]]
                sums[own] = add.reduceat(value[edges], border)
                rest = np.repeat(sums[own], size)
                self.prob[edges] = value[edges] / rest if linear else np.exp(value[edges] - rest)

    def walk(self, nodes: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sampled paths from the nodes to their words' ends: edges one after another, and the number of edges of each."""
        counts = np.zeros(len(nodes), np.int64)
        active, node, steps = np.arange(len(nodes)), nodes, []
        turn = 0
        while len(active):
            drawn = uniform(keys[active] + times(turn, PIECE_STEP))
            edge = self.first[node]
            wait = np.flatnonzero(drawn > self.upto[edge])
            while len(wait):
                edge[wait] += 1
                wait = wait[drawn[wait] > self.upto[edge[wait]]]
            steps.append((active, edge))
            counts[active] += 1
            on = ~self.last[edge]
            active, node = active[on], self.to[edge[on]]
            turn += 1
        out = np.empty(int(counts.sum()), np.int64)
        offset = np.cumsum(counts) - counts
        for i, (who, edge) in enumerate(steps):
            out[offset[who] + i] = edge
        return out, counts


class Numbers(dict):
    """Numbers of words in order of their first use."""

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        return number


class Search:
    """The search over one text: emitted paths and the open sets around them."""

    def __init__(self, lattice: Lattice, key: np.uint64, words: np.ndarray):
        self.lattice, self.key, self.words = lattice, key, words
        self.paths: list[np.ndarray] = []
        self.logps: list[float] = []
        self.values: list[np.ndarray] = []
        self.taken: dict[tuple[int, int], list[int]] = {}
        # log of the arrival time, the negative of the Gumbel value
        self.time = float(np.log(-np.log(uniform(np.array([key ^ PATH_STEP], np.uint64))))[0])

    def emit(self, path: np.ndarray, own: int) -> None:
        """Adds a path whose steps from ``own`` on are new, and opens the sets that leave it there."""
        prob = self.lattice.prob[path]
        logp = np.log(prob)
        upto = np.cumsum(logp) - logp
        rest = 1.0 - prob
        rest[rest < 1e-12] = 0.0
        with np.errstate(divide="ignore"):
            log_rest = np.log(rest)
        places = np.arange(len(path), dtype=np.uint64) * PIECE_STEP
        noise = uniform(places + (self.key ^ times(2 * len(self.paths) + 3, PATH_STEP)))
        value = np.logaddexp(self.time, np.log(-np.log(noise)) - upto - log_rest)
        value[:own] = np.inf
        self.paths.append(path)
        self.logps.append(float(logp.sum()))
        self.values.append(value)

    def best(self) -> tuple[int, int, float]:
        i = min(range(len(self.values)), key=lambda j: self.values[j].min(initial=np.inf))
        value = self.values[i]
        step = int(value.argmin()) if len(value) else 0
        return i, step, float(value[step]) if len(value) else math.inf

    def branch(self) -> tuple[np.ndarray, int, int] | None:
        """Opens the best set: the prefix with its new last edge, the word that edge lies in, and the node it ends at (-1 at a word's end)."""
        i, step, time = self.best()
        if math.isinf(time):
            return None
        lat, path = self.lattice, self.paths[i]
        node = int(lat.begin[path[step]])
        taken = self.taken.setdefault((i, step), [int(path[step])])
        edges = np.array([e for e in range(lat.first[node], lat.first[node + 1]) if e not in taken])
        prob = lat.prob[edges]
        number = 2 * len(self.paths) + 2
        u = float(uniform(np.array([self.key ^ times(number, TOKEN_STEP)]))[0])
        pick = int(min(np.searchsorted(np.cumsum(prob), u * prob.sum(), side="right"), len(edges) - 1))
        edge = int(edges[pick])
        taken.append(edge)
        self.time = time
        rest = prob.sum() - prob[pick]
        upto = float(np.log(lat.prob[path[:step]]).sum())
        if len(edges) > 1 and rest > 0:
            noise = float(uniform(np.array([self.key ^ times(number + 1, TOKEN_STEP)]))[0])
            self.values[i][step] = np.logaddexp(time, math.log(-math.log(noise)) - upto - math.log(rest))
        else:
            self.values[i][step] = np.inf
        word = int(np.count_nonzero(lat.last[path[:step]]))
        return np.append(path[:step], edge), word, -1 if lat.last[edge] else int(lat.to[edge])


def sample_group(model: Pieces, texts: list[str], keys: np.ndarray, k: int) -> list[list[tuple[np.ndarray, float, float]]]:
    """For each text up to k distinct segmentations: piece numbers, log probability, inclusion score; best perturbed value first."""
    numbers = Numbers()
    words = []
    for text in texts:
        found = WORDS.findall(SPACE + text.replace(" ", SPACE)) if text else []
        words.append(np.array(list(map(numbers.__getitem__, found)), np.int64))
    lattice = Lattice(model, list(numbers))
    searches = [Search(lattice, key, own) for key, own in zip(keys, words, strict=True)]

    def finish(starts: list[tuple[Search, np.ndarray, int, int]]) -> None:
        """Samples the rest of each path, all texts at once, and emits the paths."""
        nodes, seeds, sizes = [], [], []
        for search, prefix, word, node in starts:
            own = lattice.start[search.words[word:]]
            if len(prefix):
                own = np.concatenate([[node], own[1:]]) if node >= 0 else own[1:]
            nodes.append(own)
            places = np.arange(len(own), dtype=np.uint64) * TOKEN_STEP
            seeds.append(places + (search.key ^ times(2 * len(search.paths) + 2, PATH_STEP)))
            sizes.append(len(own))
        edges, counts = lattice.walk(np.concatenate(nodes), np.concatenate(seeds))
        borders = np.concatenate([[0], np.cumsum(counts)])[np.cumsum([0, *sizes])]
        for i, (search, prefix, _, _) in enumerate(starts):
            search.emit(np.concatenate([prefix, edges[borders[i] : borders[i + 1]]]).astype(np.int64), len(prefix))

    finish([(s, np.zeros(0, np.int64), 0, -1) for s in searches])
    for _ in range(k - 1):
        opened = [(s, b) for s in searches if (b := s.branch()) is not None]
        if opened:
            finish([(s, *b) for s, b in opened])
    out = []
    for search in searches:
        limit = search.best()[2]
        rows = []
        for path, logp in zip(search.paths, search.logps, strict=True):
            rows.append((lattice.ids[path], logp, 1.0 if math.isinf(limit) else -math.expm1(-math.exp(min(logp + limit, 700.0)))))
        out.append(rows)
    return out


def sampled_segmentations(docs: DataFrame, path: str, k: int = SAMPLES, power: float = POWER, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Up to k rows per document: the key, ``sample`` (from 1), ``n_pieces``, ``log_prob``, ``inclusion`` and ``pieces`` (16-bit numbers)."""
    rows = docs.select(
        F.col(f"`{key}`").alias("doc_id"), F.col(f"`{text}`").alias("text"), F.xxhash64(F.col(f"`{key}`").cast("string")).alias("seed")
    )
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        model, texts = pieces(path, power), texts_of(batch, "text")
        seeds = mix(batch.column("seed").to_numpy(zero_copy_only=False).view(np.uint64))
        for lo, hi in row_groups([len(t) for t in texts], GROUP):
            row, columns = [], []
            for i, samples in enumerate(sample_group(model, texts[lo:hi], seeds[lo:hi], k)):
                for n, (ids, logp, inclusion) in enumerate(samples):
                    written = model.written(ids)
                    row.append(lo + i)
                    columns.append((n + 1, len(written), logp, inclusion, written.tobytes()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(row, pa.int64())), *(pa.array(x, t) for x, t in zip(zip(*columns, strict=True), types, strict=True))],
                names=["doc_id", "sample", "n_pieces", "log_prob", "inclusion", "pieces"],
            )

    types = [pa.int32(), pa.int64(), pa.float64(), pa.float64(), pa.binary()]
    return map_arrow(rows, run, f"doc_id {kind}, sample int, n_pieces long, log_prob double, inclusion double, pieces binary")


def decoded(encoded: DataFrame, path: str, pieces_column: str = "pieces") -> DataFrame:
    """All columns of ``encoded`` and the ``text`` its pieces stand for."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema) + ", text string"

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        model = pieces(path)
        texts = [None if raw is None else model.decode(np.frombuffer(raw, "<u2")) for raw in batch.column(pieces_column).to_pylist()]
        yield batch.append_column("text", pa.array(texts, pa.string()))

    return map_arrow(encoded, run, schema)
