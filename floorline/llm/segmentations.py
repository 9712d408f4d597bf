"""Distinct sampled SentencePiece segmentations of whole texts, and their decoding.

A text's lattice has an edge for every vocabulary piece at every place.  Backward
sums give each edge its exact share of all segmentations that pass its node, so
they are an exact heuristic: the search over perturbed log-probabilities (Gumbel
noise, drawn top down) always goes straight to the best segmentation that is
left.  A path of maximal perturbed score is followed by sampling edges; whatever
branches off it is held in a queue as one entry per node, with the conditional
maximum of the branches' Gumbels.  Popping the queue ``k`` times gives ``k``
samples without replacement; the next entry is the threshold of their inclusion
scores.

No piece crosses the beginning of a word, so the lattice is a chain of small ones;
equal words share one.  Noise depends on the row's key and the place in the text.
"""

from __future__ import annotations

import heapq
import math
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from floorline.llm.common import Numbers, mix, slices

MODEL = "piece_bpe_32k.model"
TOP = 3
# A piece's weight is (1 + its merge rank) to the power of minus this; a byte is as heavy as the last piece.
SHARPNESS = 1.0
# Lattices of distinct words that a task keeps before it starts anew.
KEPT_WORDS = 100_000
TEXT_BYTES, DECODE_ROWS = 1 << 17, 500
SPACE = "▁"


class Vocabulary:
    """Pieces, their log weights and spelling, and hashes of all their beginnings by length."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.model, self.size = model, model.get_piece_size()
        self.bytes, self.weight = [0] * 256, np.zeros(self.size)
        self.byte_weight = -SHARPNESS * math.log(1 + self.size)
        parts: list[bytes] = []
        pieces = {}
        for i in range(self.size):
            piece, spelled = model.id_to_piece(i), b""
            if model.is_byte(i):
                value = int(piece[3:5], 16)
                self.bytes[value], spelled = i, bytes([value])
                self.weight[i] = self.byte_weight
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                pieces[piece] = i
                self.weight[i] = -SHARPNESS * math.log(1 + min(max(0.0, -model.get_score(i)), self.size))
                spelled = piece.replace(SPACE, " ").encode()
            parts.append(spelled)
        # How each id is spelled, one after another.
        self.spelled_bytes = np.frombuffer(b"".join(parts), np.uint8)
        self.spelled_size = np.array([len(p) for p in parts])
        self.spelled_start = np.cumsum(self.spelled_size) - self.spelled_size
        if any((SPACE in p[1:] and p.strip(SPACE)) or "\n" in p for p in pieces):
            raise ValueError("a piece of this model crosses a word's beginning or a line's end")
        # Words with the spaces before them; a line's end stands alone.
        self.unit = re.compile(f"\n|{SPACE}*[^{SPACE}\n]+|{SPACE}+")
        # Per length: the hashes of all beginnings of pieces, and the piece that ends there (-1: none).
        self.beginnings = []
        for n in range(1, max(map(len, pieces)) + 1):
            parts = sorted({p[:n] for p in pieces if len(p) >= n})
            codes = np.frombuffer("".join(parts).encode("utf-32-le"), np.uint32).reshape(-1, n)
            hashes = np.zeros(len(parts), np.uint64)
            for k in range(n):
                hashes = longer(hashes, codes[:, k])
            self.beginnings.append(Beginnings(hashes, np.array([pieces.get(p, -1) for p in parts], np.int32)))

    def decoded(self, ids: np.ndarray, ends: np.ndarray) -> list[str]:
        """The texts of lists of ids, one list after another, without the space that encoding puts first."""
        size = self.spelled_size[ids]
        total = np.r_[0, np.cumsum(size)]
        data = self.spelled_bytes[np.repeat(self.spelled_start[ids] - total[:-1], size) + np.arange(total[-1])].tobytes()
        cuts = total[np.r_[0, ends]].tolist()
        return [data[a + 1:b].decode("utf-8", "replace") for a, b in zip(cuts[:-1], cuts[1:])]

    def units(self, text: str) -> list[str]:
        return self.unit.findall(self.model.normalize(text)) if text else []


def longer(hashes: np.ndarray, codes: np.ndarray) -> np.ndarray:
    return (hashes ^ (codes.astype(np.uint64) + np.uint64(1))) * np.uint64(0x9FB21C651E98DF25) + np.uint64(0x2545F491)


class Beginnings:
    """A table from hashes to pieces with four places an entry; one that finds its place taken has the next free one."""

    NOWHERE = -2

    def __init__(self, hashes: np.ndarray, pieces: np.ndarray):
        bits = max(4, int(4 * len(hashes) - 1).bit_length())
        self.shift, self.last = np.uint64(64 - bits), (1 << bits) - 1
        self.hashes, self.pieces = np.zeros(1 << bits, np.uint64), np.full(1 << bits, self.NOWHERE, np.int32)
        left, place = np.arange(len(hashes)), self.home(hashes)
        while len(left):
            free = self.pieces[place] == self.NOWHERE
            first = np.zeros(len(left), bool)
            first[np.unique(place, return_index=True)[1]] = True
            put = free & first
            self.hashes[place[put]], self.pieces[place[put]] = hashes[left[put]], pieces[left[put]]
            left, place = left[~put], np.where(free, place, place + 1 & self.last)[~put]

    def home(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes >> self.shift).astype(np.int64)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The piece of each hash, -1 where none ends, ``NOWHERE`` if no piece begins so."""
        place = self.home(hashes)
        found = self.pieces[place]
        left = np.flatnonzero((self.hashes[place] != hashes) & (found != self.NOWHERE))
        place = place[left]
        while len(left):
            place = place + 1 & self.last
            found[left] = self.pieces[place]
            on = (self.hashes[place] != hashes[left]) & (found[left] != self.NOWHERE)
            left, place = left[on], place[on]
        return found


class Lattices:
    """The lattices of distinct words as arrays: a node per character, the edges of a node together, longest first."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.clear()

    def clear(self) -> None:
        self.number = Numbers()
        self.room: dict[str, np.ndarray] = {}
        self.spelt: list[list[int]] = []
        self.spelt_number: dict[int, int] = {}
        self.begin = np.zeros(0, np.int32)    # a word's first node
        self.place = np.zeros(0, np.int32)    # a node's place in its word
        self.low = np.zeros(1, np.int32)      # a node's first edge, and the end of the last one's
        self.target = np.zeros(0, np.int32)   # the node after an edge, -1 at the word's end
        self.piece = np.zeros(0, np.int32)    # its piece, or beyond the vocabulary a sequence of bytes
        self.share = np.zeros(0, np.float32)  # its share at its node
        self.upto = np.zeros(0, np.float32)   # the shares up to it
        self.others = np.zeros(0, np.float32)  # the shares of its node's other edges

    def extend(self, name: str, values: np.ndarray) -> None:
        """Append to an array that has room to grow, so that what is there is copied seldom."""
        own = getattr(self, name)
        size = len(own) + len(values)
        if len(self.room.get(name, ())) < size:
            self.room[name] = np.empty(size + size // 2, own.dtype)
            self.room[name][:len(own)] = own
        self.room[name][len(own):size] = values
        setattr(self, name, self.room[name][:size])

    def spell(self, code: int) -> int:
        if code not in self.spelt_number:
            self.spelt_number[code] = self.vocabulary.size + len(self.spelt)
            self.spelt.append([self.vocabulary.bytes[b] for b in chr(code).encode("utf-8", "surrogatepass")])
        return self.spelt_number[code]

    def edges_of(self, codes: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Node, length, piece and weight of every edge; ``left`` are the characters from a node to its word's end."""
        at, hashes = np.arange(len(codes), dtype=np.int32), np.zeros(len(codes), np.uint64)
        nodes, pieces = [], []
        alone = np.zeros(0, np.int32)
        for n, beginnings in enumerate(self.vocabulary.beginnings, 1):
            if n > 1:
                inside = np.flatnonzero(left[at] >= n)
                at, hashes = at[inside], hashes[inside]
            hashes = longer(hashes, codes[at + (n - 1)])
            found = beginnings.find(hashes)
            ok = np.flatnonzero(found >= 0)
            nodes.append(at[ok])
            pieces.append(found[ok])
            if n == 1:
                alone = np.flatnonzero(found < 0).astype(np.int32)
            alive = np.flatnonzero(found != Beginnings.NOWHERE)
            at, hashes = at[alive], hashes[alive]
        values, which = np.unique(codes[alone], return_inverse=True)
        spelt = np.array([self.spell(int(c)) for c in values], np.int32)
        # Placed by node and falling length without a sort: longer ones first, each after those its node has already.
        # A character alone as bytes is the last edge of its node, as it has no other of its length.
        filled = np.zeros(len(codes) + 1, np.int32)
        np.cumsum(np.bincount(np.concatenate([*nodes, alone]), minlength=len(codes)), out=filled[1:])
        total = int(filled[-1])
        node, length, piece = np.empty(total, np.int32), np.empty(total, np.int32), np.empty(total, np.int32)
        for n, some, found in [*reversed(list(zip(range(1, len(nodes) + 1), nodes, pieces))), (1, alone, spelt[which])]:
            places = filled[some]
            filled[some] += 1
            node[places], length[places], piece[places] = some, n, found
        weight = self.vocabulary.weight[np.minimum(piece, self.vocabulary.size - 1)]
        if len(alone):
            of_bytes = np.array([len(self.spelt[k - self.vocabulary.size]) for k in spelt.tolist()]) * self.vocabulary.byte_weight
            weight[filled[alone] - 1] = of_bytes[which]
        return node, length, piece, weight

    def add(self, words: list[str]) -> None:
        sizes = np.array([len(w) for w in words])
        codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        n, last = len(codes), np.cumsum(sizes)
        # Characters to the word's end; in few bytes, as short numbers are sorted by their digits.
        most = int(sizes.max())
        apart = (np.repeat(last, sizes) - np.arange(n)).astype(np.uint16 if most < 65_536 else np.int64)
        node, length, piece, weight = self.edges_of(codes, apart)
        width = np.bincount(node, minlength=n).astype(np.int32)
        low = np.zeros(n + 1, np.int32)
        np.cumsum(width, out=low[1:])
        target = node + length
        target[apart[node] == length] = n
        # Sums over all ways to the word's end, as logarithms, from the last character backwards.
        ways, share = np.zeros(n + 1), np.empty(len(node))
        by_node = np.argsort(apart, kind="stable")
        cut = np.r_[0, np.cumsum(np.bincount(apart, minlength=most + 1)[1:])].tolist()
        wide = width[by_node]
        first = np.zeros(n + 1, np.int64)
        np.cumsum(wide, out=first[1:])
        by_edge = np.repeat(low[:-1][by_node] - first[:-1], wide) + np.arange(len(node))
        for a, b in zip(cut[:-1], cut[1:]):
            if a < b:
                edges, many = by_edge[first[a]:first[b]], wide[a:b]
                begins = first[a:b] - first[a]
                terms = weight[edges] + ways[target[edges]]
                top = np.maximum.reduceat(terms, begins)
                terms = np.exp(terms - np.repeat(top, many))
                sums = np.add.reduceat(terms, begins)
                ways[by_node[a:b]] = top + np.log(sums)
                share[edges] = terms / np.repeat(sums, many)
        sums = np.cumsum(share)
        upto = sums - np.repeat(np.r_[0.0, sums[low[1:-1] - 1]], width)
        upto[low[1:] - 1] = 2.0  # the last edge takes what rounding leaves
        # A large one's are summed without it, as 1 - share would lose what is tiny beside it.
        others = 1 - share
        large = np.flatnonzero(share > 0.5)
        small = share.copy()
        small[large] = 0.0
        others[large] = np.add.reduceat(small, low[:-1])[node[large]]
        nodes, edges = len(self.place), len(self.target)
        self.extend("begin", nodes + last - sizes)
        self.extend("place", np.repeat(sizes, sizes) - apart)
        self.extend("low", edges + low[1:])
        target += nodes
        target[target == nodes + n] = -1
        self.extend("target", target)
        self.extend("piece", piece)
        self.extend("share", share)
        self.extend("upto", upto)
        self.extend("others", others)

    def numbers(self, units: list[str]) -> np.ndarray:
        found = np.fromiter(map(self.number.__getitem__, units), np.int64, len(units))
        if len(self.number) > self.number.settled:
            self.add(self.number.fresh())
            self.number.settle()
        return found

    def choose(self, node: np.ndarray, u: np.ndarray) -> np.ndarray:
        """The edge at each node that its uniform number falls on."""
        edge = self.low[node]
        wrong = np.flatnonzero(u > self.upto[edge])
        while len(wrong):
            edge[wrong] += 1
            wrong = wrong[u[wrong] > self.upto[edge[wrong]]]
        return edge


GOLDEN = 0x9E3779B97F4A7C15
MASK = (1 << 64) - 1


@lru_cache(maxsize=1)
def vocabulary_of(path: str) -> Vocabulary:
    """One per worker process; later tasks find it."""
    return Vocabulary(path)


def uniform(keys: np.ndarray, layer: int, counters: np.ndarray) -> np.ndarray:
    """Numbers between 0 and 1 by key, use and place (splitmix64 with the key as its seed)."""
    bits = mix((keys ^ np.uint64((layer + 1) * 0xD1342543DE82EF95 & MASK)) + counters.astype(np.uint64) * np.uint64(GOLDEN))
    return ((bits >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0 ** -53


def uniform_one(key: int, layer: int, counter: int) -> float:
    x = ((key ^ (layer + 1) * 0xD1342543DE82EF95 & MASK) + counter * GOLDEN) & MASK
    x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & MASK
    x = (x ^ x >> 27) * 0x94D049BB133111EB & MASK
    return (((x ^ x >> 31) >> 11) + 0.5) * 2.0 ** -53


def exponential(u: float) -> float:
    return -math.log(u)


def below(bound: float, mass: float, e: float) -> float:
    """A Gumbel of location ``mass`` that is at most ``bound``, from exponential noise."""
    return -np.logaddexp(-bound, math.log(e) - mass) if mass > -math.inf else -math.inf


class Sampler:
    """Samples of the texts of a slice."""

    # Noise of 53 bits makes a Gumbel of at most 38; entries below by more cannot win.
    MOST_NOISE = 38.0
    # Steps of a path that are looked at first.
    NEAR = 384

    def __init__(self, lattices: Lattices, words: np.ndarray, counts: np.ndarray, keys: np.ndarray, top: int):
        self.a, self.words, self.counts, self.keys, self.top = lattices, words, counts, keys, top
        self.owner = np.repeat(np.arange(len(counts)), counts)
        self.first = np.r_[0, np.cumsum(counts)]
        self.layers = [self.layer(k) for k in range(top)]
        self.run()

    def layer(self, which: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """An independently sampled edge sequence of every word, its log shares, and where each word's begins."""
        a = self.a
        at = np.arange(len(self.words))
        node = a.begin[self.words]
        keys = self.keys[self.owner]
        inside = (at - self.first[self.owner]) * 65_536
        steps, count = [], np.zeros(len(self.words) + 1, np.int64)
        while len(at):
            edge = a.choose(node, uniform(keys[at], 16 * which, inside[at] + a.place[node]))
            steps.append((at, edge))
            count[at + 1] += 1
            node = a.target[edge]
            on = node >= 0
            at, node = at[on], node[on]
        starts = np.cumsum(count)
        out = np.zeros(starts[-1], np.int64)
        for k, (at, edge) in enumerate(steps):
            out[starts[at] + k] = edge
        return out, np.log(a.share[out].astype(np.float64)), starts

    def branches(self, edges: np.ndarray, log: np.ndarray, begin: int, before: float, bound: float, key: int, which: int):
        """The best entries that branch off a path from step ``begin`` on: (score, step)."""
        log = log[begin:]
        total = before + np.cumsum(log) - log
        score = self.scores(total, edges[begin:], bound, key, 16 * which + 1, np.arange(begin, begin + len(log)))
        best = np.argpartition(score, -self.top)[-self.top:] if len(score) > self.top else np.arange(len(score))
        return [(float(score[i]), begin + int(i)) for i in best if score[i] > -math.inf]

    def scores(self, total: np.ndarray, edges: np.ndarray, bound, key, layer: int, steps: np.ndarray) -> np.ndarray:
        """Conditional maxima of the Gumbels of what branches off at each step."""
        with np.errstate(divide="ignore", over="ignore", invalid="ignore"):
            mass = total + np.log(self.a.others[edges].astype(np.float64))
            noise = -np.log(uniform(np.asarray(key, np.uint64), layer, steps))
            return -np.logaddexp(-bound, np.log(noise) - mass)

    def push(self, which: int, fresh: list[tuple[int, int, float]]) -> None:
        """Put what branches off the texts' latest paths (text, first step, log-probability before it) into their queues.

        The first ``NEAR`` steps of all texts are looked at together.  If an entry
        beyond them could be among a text's best, all its steps are.
        """
        fresh = [(t, b, before) for t, b, before in fresh if b < len(self.paths[t][-1][0])]
        if not fresh:
            return
        latest = [self.paths[t][-1] for t, _, _ in fresh]
        begin = np.array([b for _, b, _ in fresh])
        size = np.array([len(path[0]) for path in latest]) - begin
        wide = int(min(self.NEAR, size.max()))
        many = np.minimum(size, wide)
        inside = np.arange(wide + 1) < np.minimum(size, wide + 1)[:, None]
        edges, log = np.zeros(inside.shape, np.int64), np.zeros(inside.shape)
        edges[inside] = np.concatenate([path[0][b:b + wide + 1] for path, b in zip(latest, begin.tolist())])
        log[inside] = np.concatenate([path[1][b:b + wide + 1] for path, b in zip(latest, begin.tolist())])
        total = np.array([before for _, _, before in fresh])[:, None] + np.cumsum(log, axis=1) - log
        bounds = np.array([self.found[t][-1][2] for t, _, _ in fresh])
        keys = self.keys[[t for t, _, _ in fresh]]
        score = self.scores(total[:, :wide], edges[:, :wide], bounds[:, None], keys[:, None], 16 * which + 1, begin[:, None] + np.arange(wide))
        score[~inside[:, :wide]] = -math.inf
        best = np.argpartition(score, -self.top, axis=1)[:, -self.top:] if wide > self.top else np.tile(np.arange(wide), (len(fresh), 1))
        value = np.take_along_axis(score, best, 1)
        # Noise is bounded, so nothing after step ``wide`` exceeds the sum there by more.
        short = (size > many) & ~((value.min(axis=1) > total[:, wide] + self.MOST_NOISE) & (best.shape[1] == self.top))
        for i, (t, b, before) in enumerate(fresh):
            entries = zip(value[i].tolist(), (best[i] + b).tolist())
            if short[i]:
                entries = self.branches(*latest[i][:2], b, before, float(bounds[i]), int(keys[i]), which)
            path, edges_on = len(self.paths[t]) - 1, latest[i][0]
            for score_, step in entries:
                if score_ > -math.inf:
                    heapq.heappush(self.queues[t], (-score_, path, step, (int(edges_on[step]),)))

    def run(self) -> None:
        """Samples of all texts, the first of each, then the second of each, and so on."""
        edges, log, starts = self.layers[0]
        # Per text: paths (edges, log shares, where words begin), samples, and entries (score, path, step, edges at that node that are taken).
        self.paths, self.found, self.queues, fresh = [], [], [], []
        for number, key in enumerate(self.keys.tolist()):
            lo, hi = int(self.first[number]), int(self.first[number + 1])
            own, own_log = edges[starts[lo]:starts[hi]], log[starts[lo]:starts[hi]]
            self.paths.append([(own, own_log, starts[lo:hi + 1] - starts[lo])])
            self.found.append([(own, float(own_log.sum()), -math.log(exponential(uniform_one(key, 2, 0))) if lo < hi else 0.0)])
            self.queues.append([])
            if lo < hi:
                fresh.append((number, 0, 0.0))
        self.push(0, fresh)
        for which in range(1, self.top):
            self.push(which, [(t, *self.next(t, which)) for t, queue in enumerate(self.queues) if queue])

    def next(self, number: int, which: int) -> tuple[int, float]:
        """Take the best entry of a text's queue for its next sample; the step after the branch and the log-probability before that."""
        a, key, paths, queue = self.a, int(self.keys[number]), self.paths[number], self.queues[number]
        lo, hi = int(self.first[number]), int(self.first[number + 1])
        score, path, step, taken = heapq.heappop(queue)
        score = -score
        edges, log, cuts = paths[path]
        word = int(np.searchsorted(cuts, step, side="right")) - 1
        node = int(np.searchsorted(a.low, a.low.dtype.type(edges[step]), side="right")) - 1
        free = [e for e in range(int(a.low[node]), int(a.low[node + 1])) if e not in taken]
        pick = uniform_one(key, 16 * which + 3, step) * sum(float(a.share[e]) for e in free)
        for edge in free:
            pick -= float(a.share[edge])
            if pick <= 0:
                break
        tail, after = [edge], int(a.target[edge])
        while after >= 0:
            u, edge_on = uniform_one(key, 16 * which + 4, (step << 20) + len(tail)), int(a.low[after])
            while u > a.upto[edge_on]:
                edge_on += 1
            tail.append(edge_on)
            after = int(a.target[edge_on])
        fresh, fresh_log, starts = self.layers[which]
        rest = slice(starts[lo + word + 1], starts[hi])
        new = np.concatenate([edges[:step], tail, fresh[rest]])
        new_log = np.concatenate([log[:step], np.log(a.share[tail].astype(np.float64)), fresh_log[rest]])
        new_cuts = np.concatenate([cuts[:word + 1], starts[lo + word + 1:hi + 1] + (step + len(tail) - starts[lo + word + 1])])
        before = float(log[:step].sum())
        left = sum(float(a.share[e]) for e in free if e != edge)
        if left > 0:
            e = exponential(uniform_one(key, 16 * which + 5, step))
            heapq.heappush(queue, (-below(score, before + math.log(left), e), path, step, (*taken, edge)))
        paths.append((new, new_log, new_cuts))
        self.found[number].append((new, float(new_log.sum()), score))
        return step + 1, before + float(new_log[step])

    def text(self, number: int) -> list[tuple[np.ndarray, float, float, float]]:
        """Edge sequence, log-probability, perturbed score and log inclusion score of each sample, best first."""
        threshold = -self.queues[number][0][0] if self.queues[number] else -math.inf
        return [(edges, p, s, inclusion(p - threshold)) for edges, p, s in self.found[number]]


def inclusion(x: float) -> float:
    """log(1 - exp(-exp(x))): the chance that a segmentation's Gumbel exceeds the threshold."""
    if x > 30:
        return 0.0
    return x if x < -30 else math.log(-math.expm1(-math.exp(x)))


def sample_segmentations(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", top: int = TOP,
                         seed: int = 0, model_path: str | None = None, decode: bool = False) -> DataFrame:
    """Per row and sample: id, ``sample`` (from 1), ``ids``, ``log_prob``, ``score`` (perturbed) and ``log_inclusion``.

    The ``top`` segmentations of a text are distinct and in falling order of
    score; a text with fewer has as many as there are, with ``log_inclusion`` 0
    as all are included.  A null or empty text has one, of no pieces.  Rows that
    repeat an id draw the same noise.  Other columns are not read.  With
    ``decode`` each sample also has ``decoded``, the text of its ids.
    """
    path = model_path or public_tokenizers.path(MODEL)
    plain = docs.select(F.col(id_column).alias("id"), F.xxhash64(F.lit(seed), F.col(id_column)).alias("key"),
                        F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"))
    kind = docs.schema[id_column].dataType.simpleString()

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = vocabulary_of(path)
        # Not kept after the task: Spark hands tasks to its idle workers in turn, and each would hold a set.
        lattices = Lattices(vocabulary)
        for batch in batches:
            for a, b in slices(batch["text"], TEXT_BYTES):
                if len(lattices.number) > KEPT_WORDS:
                    lattices.clear()
                units = [vocabulary.units(t) for t in batch["text"][a:b].to_pylist()]
                words = lattices.numbers([u for own in units for u in own])
                keys = np.asarray(batch["key"][a:b]).view(np.uint64)
                sampler = Sampler(lattices, words, np.array([len(u) for u in units]), keys, top)
                of, number, pieces, logs, scores, chances = [], [], [], [], [], []
                for i in range(b - a):
                    for k, (edges, log, score, chance) in enumerate(sampler.text(i)):
                        of.append(a + i)
                        number.append(k + 1)
                        pieces.append(edges)
                        logs.append(log)
                        scores.append(score)
                        chances.append(chance)
                ids, ends = spelled_out(lattices.piece[np.concatenate(pieces)], np.cumsum([0, *map(len, pieces)]), lattices)
                columns = [
                    batch["id"].take(pa.array(of)), pa.array(number, pa.int32()),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32())),
                    pa.array(logs, pa.float64()), pa.array(scores, pa.float64()), pa.array(chances, pa.float64()),
                ]
                if decode:
                    columns.append(pa.array(vocabulary.decoded(ids, ends[1:]), pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names=names)
        # An idle worker keeps what it does not give back.
        pa.default_memory_pool().release_unused()

    schema = f"id {kind}, sample int, ids array<int>, log_prob double, score double, log_inclusion double" + ", decoded string" * decode
    names = ["id", "sample", "ids", "log_prob", "score", "log_inclusion", *["decoded"] * decode]
    return plain.mapInArrow(sample, schema).withColumnRenamed("id", id_column)


def spelled_out(pieces: np.ndarray, cuts: np.ndarray, lattices: Lattices) -> tuple[np.ndarray, np.ndarray]:
    """Pieces as ids, with sequences of bytes in full, and where the cuts between samples lie among the ids."""
    size = lattices.vocabulary.size
    far = np.flatnonzero(pieces >= size)
    if not len(far):
        return pieces, cuts
    spelt = [lattices.spelt[k] for k in (pieces[far] - size).tolist()]
    wide = np.ones(len(pieces), np.int64)
    wide[far] = [len(s) for s in spelt]
    starts = np.r_[0, np.cumsum(wide)]
    ids = np.repeat(pieces, wide)
    ids[np.repeat(starts[far] - np.r_[0, np.cumsum(wide[far])[:-1]], wide[far]) + np.arange(wide[far].sum())] = np.concatenate(spelt)
    return ids, starts[cuts]


def decode_pieces(rows: DataFrame, ids_column: str = "ids", into: str = "decoded", model_path: str | None = None) -> DataFrame:
    """``rows`` with the text of their ids; a null list gives null.  The space that encoding puts first is taken off."""
    path = model_path or public_tokenizers.path(MODEL)
    plain = rows.withColumn(into, F.lit(None).cast("string"))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = vocabulary_of(path)
        for whole in batches:
            for begin in range(0, whole.num_rows, DECODE_ROWS):
                batch = whole.slice(begin, DECODE_ROWS)
                lists = batch[ids_column]
                texts = vocabulary.decoded(np.asarray(lists.flatten()), np.cumsum(np.asarray(lists.value_lengths().fill_null(0))))
                texts = [text if known else None for text, known in zip(texts, lists.is_valid().to_pylist())]
                yield batch.set_column(batch.schema.get_field_index(into), into, pa.array(texts, pa.string()))

    return plain.mapInArrow(decode, plain.schema)

