"""Language-model scoring by online logistic context mixing.

A text is the sequence of its words, A-Z lower-cased, and one end.  It is coded bit by bit:

1. Code.  The FREQUENT most frequent words, the end and an escape are the leaves of one Huffman tree; a word is
   the path of bits to its leaf.  The probability of an escape is what absolute discounting takes from the
   counted words, and what the other words make up.
2. Predictors.  Every bit is predicted in several contexts: the place in the tree alone; the place and
   the class of text (the language that is likeliest from the words read so far, by counts of each class);
   the place with a hash of the word before, and of the two words before; and the path of the
   word that followed when these two (or this one) last stood in this text.
3. Mixing.  The predictors' logits are added up with weights that a gate chooses: how well the
   last repeats were kept, the longest context with evidence, and whether the class is clear.  Weights are learned
   online, by gradient steps on the coding cost: the gates' on all training texts (from counts that leave the coded bit
   itself out); every text then adds weights of its own, which it adapts as it is read.
4. Refinement.  A second adaptive stage holds the mixed probability against the rate of ones
   that was seen at (gate, quantised probability).
5. Escapes.  An escaped word is priced by its discounted count among the escaped words, which falls back to the
   speller (speller.py): bits again, mixed in the same way from contexts of bytes.

Words' counts are exact and live in a table that grows with the corpus; the tree and the counts of hashed
contexts are handed to every task and have a fixed bound: the tree takes the words above a count, and hashed contexts
are kept for places that are visited often (PLACES) after frequent words (HEADS), so that few share a slot.  A text's
frequent words are summed where the text lies; only its escaped words are joined with the table.
"""

from __future__ import annotations

import heapq
import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, SpanHash, U64, Words, byte_values, chunks, crc_mod, cut, lean, opened, share, table, text_buffer
from .speller import train as train_speller

#: Words in the tree, at most.
FREQUENT = 1 << 17
#: A word of the tree occurs so often at least: one that was seen once says nothing of its rate.
LEAST_COUNT = 2
#: Most classes; rarer ones are pooled in the last.
CLASSES = 8
#: log2 of the slots of each table of hashed contexts.
BITS = 20
SLOTS = 1 << BITS
#: For contexts of one and of two words: the places of the tree (by falling frequency) and the words before (likewise) that are told apart.
PLACES = (1024, 128)
HEADS = (1 << 13, 1 << 10)
INPUTS = 5
#: (state of the repeats, longest context, class is clear); the first two have neither repeat nor context.
GATES = 4 * 3 * 2
BUCKETS = 33
#: Bits of a text that are coded with the same weights, at first and at most; the rates of learning in a text and before.
STEP, LONG_STEP = 256, 4096
RATE, START_RATE = 0.0015, 0.02
#: Bytes of text handled at once.
CHUNK = 1 << 16
PIECES = 64
#: Class evidence is added up in units of 1 / SCALE, as whole numbers: sums depend on no order.
SCALE = 1024
#: A class is clear from this lead on.
CLEAR = 6 * SCALE

_C1, _C2, _C3 = np.uint32(0x9E3779B1), np.uint32(0x85EBCA6B), np.uint32(0xC2B2AE35)


@dataclass
class Codebook:
    """The tree, with what each leaf and place knows. Leaves: words by ascending hash (the end among them), then the escape."""

    hashes: np.ndarray
    count: np.ndarray  # training tokens of each leaf
    rank: np.ndarray  # by falling count
    first: np.ndarray  # leaf -> its first step in place and bit
    place: np.ndarray
    bit: np.ndarray
    near: np.ndarray  # leaf -> its steps at places that may have a context
    plain: np.ndarray  # place -> logit
    chance: np.ndarray  # place -> probability of a one
    kinds: np.ndarray  # (class, place) -> logit
    told: np.ndarray  # (class, leaf) -> scaled log of its share
    prior: np.ndarray  # scaled log of each class's share
    tokens: int
    types: int

    @property
    def escape(self) -> int:
        return len(self.first) - 2

    @classmethod
    def build(cls, words: list[bytes], count: np.ndarray, by_class: np.ndarray, tokens: np.ndarray, types: int) -> Codebook:
        """words, count, by_class (class, word): of the tree; tokens: of each class, in all; types: of all classes together."""
        if b"" not in words:
            words, count, by_class = [*words, b""], np.append(count, 0), np.concatenate((by_class, np.zeros((len(by_class), 1))), axis=1)
        data, at = text_buffer(pa.array(words, type=pa.binary()))
        hashes = SpanHash(byte_values(data))(at[:-1], at[1:])
        order = np.argsort(hashes, kind="stable")
        hashes, count, by_class = hashes[order], count[order].astype(np.float64), by_class[:, order].astype(np.float64)
        # half an occurrence of every word goes to the escape, with the words that have no leaf
        kept = np.where(count > 0, 1 - 0.5 / np.maximum(count, 1), 0.0)
        escaped = np.maximum(0.0, tokens - (by_class * kept).sum(axis=1))
        weight = np.append(count * kept, escaped.sum()) + 0.5
        by_class = np.concatenate((by_class * kept, escaped[:, None]), axis=1)
        parent, side = _tree(weight)
        first, place, bit = _paths(parent, side, len(weight))
        n_places = max(1, len(weight) - 1)
        at = place.astype(np.int64) * 2 + bit
        leaf = np.repeat(np.arange(len(weight)), np.diff(first))

        def ones_of(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            both = np.bincount(at, weights=x[leaf], minlength=2 * n_places)
            return both[0::2], both[1::2]

        zero, one = ones_of(weight)
        p = one / np.maximum(zero + one, 1e-9)
        kinds = []
        for x in by_class:
            # two bits' worth of the rate over all classes
            a, b = ones_of(x)
            kinds.append(np.log((b + 2 * p + 1e-9) / (a + 2 * (1 - p) + 1e-9)))
        share_ = weight / weight.sum()
        total = by_class.sum(axis=1, keepdims=True)
        told = np.log((by_class + 2 * share_) / (total + 2))
        # places grow along a path: those with a context are its beginning
        near = np.bincount(leaf[place < PLACES[0]], minlength=len(weight))
        falling = np.empty(len(weight), dtype=np.int64)
        falling[np.argsort(-weight, kind="stable")] = np.arange(len(weight))
        grand = max(1.0, float(total.sum()))
        return cls(
            hashes, np.append(count, 0.0), falling, first, place, bit, near, np.log((one + 1e-9) / (zero + 1e-9)).astype(np.float32), p.astype(np.float32), np.array(kinds, dtype=np.float32).reshape(len(by_class), n_places),
            np.round(told * SCALE).astype(np.int32), np.round(np.log((total[:, 0] + 1) / (grand + len(total))) * SCALE).astype(np.int64), int(tokens.sum()), types,
        )


def _tree(weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Parent and side (0 or 1) of every leaf and inner place of the Huffman tree; leaves come first, places in order of their making."""
    n = len(weight)
    parent, side = np.full(2 * n - 1, -1, dtype=np.int64), np.zeros(2 * n - 1, dtype=np.uint8)
    heap = [(w, i) for i, w in enumerate(weight.tolist())]
    heapq.heapify(heap)
    for new in range(n, 2 * n - 1):
        (a, i), (b, j) = heapq.heappop(heap), heapq.heappop(heap)
        parent[i] = parent[j] = new
        side[j] = 1
        heapq.heappush(heap, (a + b, new))
    return parent, side


def _paths(parent: np.ndarray, side: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """first, place, bit: steps first[i] to first[i + 1] lead to leaf i. Places are numbered by falling weight, the root is 0."""
    depth = np.zeros(len(parent), dtype=np.int64)
    for node in range(len(parent) - 2, -1, -1):
        depth[node] = depth[parent[node]] + 1
    first = np.concatenate(([0], np.cumsum(depth[:n])))
    place, bit = np.zeros(first[-1], dtype=np.int32), np.zeros(first[-1], dtype=np.uint8)
    node, at = np.arange(n), first[1:] - 1
    live = np.flatnonzero(parent[:n] >= 0)
    node, at = node[live], at[live]
    while len(node):
        # the last place made, the heaviest, is the root
        place[at], bit[at] = len(parent) - 1 - parent[node], side[node]
        node = parent[node]
        on = parent[node] >= 0
        node, at = node[on], at[on] - 1
    return first, place, bit


class Tokens:
    """Leaves, contexts and classes of the tokens of a chunk of texts."""

    def __init__(self, book: Codebook, known: np.ndarray, data: np.ndarray, offsets: np.ndarray):
        w = self.words = Words(data, offsets)
        n = self.n = len(offsets) - 1
        self.first = w.first + np.arange(n + 1)  # the end is a token of every text
        total = int(self.first[-1])
        self.doc = np.repeat(np.arange(n), np.diff(self.first))
        ends = self.first[1:] - 1
        is_word = np.ones(total, dtype=bool)
        is_word[ends] = False
        self.hash = np.zeros(total, dtype=np.uint64)
        self.hash[is_word] = SpanHash(byte_values(data, lower=True))(w.start, w.end)
        self.hash[ends] = SpanHash(np.zeros(0, dtype=np.uint64))(np.zeros(1, dtype=np.int64), np.zeros(1, dtype=np.int64))
        self.word = np.cumsum(is_word) - 1  # which word a token is
        self.leaf = np.full(total, book.escape)
        maybe = np.flatnonzero(known[(self.hash >> U64(42)).astype(np.int64)])
        if len(book.hashes):
            found = np.minimum(np.searchsorted(book.hashes, self.hash[maybe]), len(book.hashes) - 1)
            same = book.hashes[found] == self.hash[maybe]
            self.leaf[maybe[same]] = found[same]
        start = self.first[:-1]
        place = np.arange(total) - start[self.doc]
        one, two = place >= 1, place >= 2
        back = lambda x, k, on: np.where(on, np.concatenate((np.zeros(k, dtype=x.dtype), x[: max(0, total - k)]))[:total], x.dtype.type(0))
        rank = np.where(self.leaf == book.escape, max(HEADS), book.rank[self.leaf])
        h = (self.hash >> U64(32)).astype(np.uint32)
        p1, p2 = back(h, 1, one), back(h, 2, two)
        r1, r2 = back(rank, 1, one), back(rank, 2, two)
        self.context = (p1 * _C1 ^ (p1 >> np.uint32(15)), (p1 * _C1 + p2) * _C3 ^ (p2 >> np.uint32(13)))
        self.heads = (r1 < HEADS[0], (r1 < HEADS[1]) & (r2 < HEADS[1]))
        self.repeats(p1.astype(np.uint64), p2.astype(np.uint64), one, two)
        # class: the likeliest from the tokens read before
        k = len(book.told)
        told = book.told[:, self.leaf].astype(np.int64)
        so_far = np.cumsum(told, axis=1) - told
        so_far -= so_far[:, start][:, self.doc] if total else so_far
        so_far += book.prior[:, None]
        self.kind = so_far.argmax(axis=0)
        if k > 1:
            ranked = np.partition(so_far, k - 2, axis=0)
            self.clear = ranked[k - 1] - ranked[k - 2] >= CLEAR
        else:
            self.clear = np.ones(total, dtype=bool)

    def repeats(self, p1: np.ndarray, p2: np.ndarray, one: np.ndarray, two: np.ndarray) -> None:
        """expected: the token that followed the last time these two words, or else this word, stood before in the text, or -1; state: 0 none, 1 to 3 by how many came true in a row."""
        total = len(self.hash)
        self.expected = np.full(total, -1)
        doc = self.doc.astype(np.uint64) << U64(32)
        with np.errstate(over="ignore"):
            for key, on in ((p1 ^ doc, one), ((p1 * U64(0x9E3779B97F4A7C15) + p2) * U64(0xD6E8FEB86659FD93) ^ (doc * U64(0x2545F4914F6CDD1D)), two)):
                at = np.flatnonzero(on)
                order = at[np.argsort(key[at], kind="stable")]
                same = key[order][1:] == key[order][:-1]
                self.expected[order[1:][same]] = order[:-1][same]
        has = self.expected >= 0
        kept = has & (self.hash[self.expected] == self.hash)
        # length of the run of kept repeats up to each token, within its text
        index = np.arange(total)
        broken = np.where(kept, -1, index)
        last = np.maximum.accumulate(broken) if total else broken
        last = np.maximum(last, self.first[:-1][self.doc] - 1)
        run = index - last
        before = np.concatenate(([0], run[:-1]))[:total]
        before[self.first[:-1]] = 0
        self.state = np.where(has, 1 + np.minimum(2, before // 2), 0)
        self.kept = kept


@dataclass
class Stream:
    """The bits of a chunk: their token, place in the tree and value; how many each token has, and which is its first."""

    place: np.ndarray
    y: np.ndarray
    size: np.ndarray
    begin: np.ndarray
    first: np.ndarray  # text -> its first bit

    @classmethod
    def of(cls, book: Codebook, t: Tokens, size: np.ndarray | None = None) -> Stream:
        """All bits of each token, or its first ones, `size` of them."""
        size = book.first[t.leaf + 1] - book.first[t.leaf] if size is None else size
        end = np.cumsum(size)
        begin = end - size
        step = np.arange(int(end[-1]) if len(end) else 0) + np.repeat(book.first[t.leaf] - begin, size)
        return cls(np.take(book.place, step), np.take(book.bit, step), size, begin, np.concatenate(([0], end))[t.first])

    def slots(self, t: Tokens, order: int) -> tuple[np.ndarray, np.ndarray]:
        """The bits that have a context of order + 1 words, and its slot."""
        at = np.flatnonzero((self.place < PLACES[order]) & np.repeat(t.heads[order], self.size))
        h = (np.take(np.repeat(t.context[order], self.size), at) + np.take(self.place, at).astype(np.uint32) * _C1) * _C2
        h ^= h >> np.uint32(16)
        return at, ((h * _C3) >> np.uint32(32 - BITS)).astype(np.int64)


def with_context(book: Codebook, t: Tokens) -> np.ndarray:
    """How many bits of each token, from the first, may have a context of words."""
    return np.where(t.heads[0], book.near[t.leaf], 0)


def to_be_mixed(book: Codebook, t: Tokens) -> np.ndarray:
    """How many bits of each token, from the first, may have a context or a repeat.

    All of them if a repeat is still followed after the places that have contexts; those places if the word before or a repeat
    speaks; else none.  What follows depends on the place and the class alone (`remainder`).
    """
    near, whole = book.near[t.leaf], book.first[t.leaf + 1] - book.first[t.leaf]
    expected = t.leaf[t.expected]
    step, own = book.first[expected] + near, book.first[t.leaf] + near
    followed = (t.state > 0) & (near < whole) & (step < book.first[expected + 1])
    at = np.flatnonzero(followed)
    followed[at] = book.place[step[at]] == book.place[own[at]]
    return np.where(followed, whole, np.where(t.heads[0] | (t.state > 0), near, 0))


def remainder(book: Codebook, mixer: Mixer) -> np.ndarray:
    """log10 of the probability of a leaf's bits where nothing but place and class speaks, as (from its first bit or beyond the places with contexts, class is clear, class, leaf)."""
    n = len(book.first) - 1
    kinds = book.kinds if len(book.kinds) else np.zeros((1, len(book.plain)), dtype=np.float32)
    out = np.zeros((2, 2, len(kinds), n), dtype=np.float32)
    step = book.place.astype(np.int64) * 2 + book.bit
    for clear in (0, 1):
        gate = np.full(len(book.plain), clear)
        for k, kind in enumerate(kinds):
            x = np.clip(np.stack((book.plain, kind), axis=1), -12, 12)
            p = mixer.coded(np.einsum("ij,j->i", x, mixer.weights[clear, :2].astype(np.float32)), gate)[2]
            both = np.log10(np.stack((1 - p, p), axis=1)).ravel()
            total = np.concatenate(([0.0], np.cumsum(np.take(both, step), dtype=np.float64)))
            end = total[book.first[1:]]
            out[0, clear, k], out[1, clear, k] = end - total[book.first[:-1]], end - total[book.first[:-1] + book.near]
    return out


def _known(book: Codebook) -> np.ndarray:
    flags = np.zeros(1 << 22, dtype=bool)
    flags[(book.hashes >> U64(42)).astype(np.int64)] = True
    return flags


@dataclass
class Mixer:
    """counts: (order, slot, bit); weights: (gate, input); refine: (gate, bucket) rates of ones; repeated: how often an escaped repeat came true, by state."""

    counts: np.ndarray
    weights: np.ndarray
    refine: np.ndarray
    repeated: np.ndarray

    def inputs(self, book: Codebook, t: Tokens, s: Stream, leave: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """(logits, gate) of every bit; `leave` takes the coded bit out of the hashed counts."""
        x = np.zeros((len(s.y), INPUTS), dtype=np.float32)
        x[:, 0] = np.take(book.plain, s.place)
        if len(book.kinds):
            x[:, 1] = np.take(book.kinds.ravel(), np.repeat(t.kind * book.kinds.shape[1], s.size) + s.place)
        seen = np.zeros(len(s.y), dtype=np.int8)
        for order in (0, 1):
            at, slot = s.slots(t, order)
            zero, one = np.take(self.counts[order], slot, axis=0).astype(np.float32).T
            if leave:
                zero, one = np.maximum(0, zero - (s.y[at] == 0)), np.maximum(0, one - (s.y[at] == 1))
            # held against the rate over all contexts, as two bits' worth of evidence
            p = np.take(book.chance, s.place[at])
            x[at, 2 + order] = np.log((one + 2 * p + np.float32(1e-4)) / (zero + 2 * (1 - p) + np.float32(1e-4)))
            seen[at[zero + one > 0]] = order + 1
        # the path of the expected token, as long as it has been followed
        state = np.repeat(t.state.astype(np.int8), s.size)
        expected = t.leaf[t.expected]
        step = np.arange(len(s.y)) + np.repeat(book.first[expected] - s.begin, s.size)
        inside = (state > 0) & (step < np.repeat(book.first[expected + 1], s.size))
        at = np.flatnonzero(inside)
        at = at[np.take(book.place, step[at]) == s.place[at]]
        x[at, 4] = 2.0 * np.take(book.bit, step[at]) - 1
        gate = np.zeros(len(s.y), dtype=np.int8)
        gate[at] = state[at]
        gate = (gate * 3 + seen) * 2 + np.repeat(t.clear, s.size)
        return np.clip(x, -12, 12, out=x), gate.astype(np.int64)

    def coded(self, z: np.ndarray, gate: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(mixed probability of a one, place in the flat table of refinements, refined probability) of mixed logits."""
        z = np.clip(z, -14, 14)
        p = 1 / (1 + np.exp(-z))
        bucket = np.clip(np.rint((z + 12) * np.float32((BUCKETS - 1) / 24)), 0, BUCKETS - 1).astype(np.int64)
        at = gate * BUCKETS + bucket
        return p, at, np.clip(0.5 * (p + np.take(self.refine.astype(np.float32).ravel(), at)), 1e-6, 1 - 1e-6)


def fresh() -> Mixer:
    centre = 1 / (1 + np.exp(-(np.arange(BUCKETS) / (BUCKETS - 1) * 24 - 12)))
    weights = np.zeros((GATES, INPUTS))
    weights[:, 0], weights[:, 1] = 0.1, 0.9
    weights[6:, 4] = np.repeat([0.5, 1.5, 3.0], 6)
    return Mixer(np.zeros((2, SLOTS, 2), dtype=np.int32), weights, np.tile(centre, (GATES, 1)), np.full(4, 0.5))


def spans_of(bits: int) -> list[tuple[int, int]]:
    """(first bit, number) of the stretches that a text is coded in: STEP at first, then twice as many each time, LONG_STEP at most."""
    out, begin, size = [], 0, STEP
    while begin < bits:
        out.append((begin, size))
        begin += size
        size = min(LONG_STEP, 2 * size)
    return out


def cost(mixer: Mixer, s: Stream, x: np.ndarray, gate: np.ndarray) -> np.ndarray:
    """log10 of the probability of each text's bits.

    Every text adapts the weights as it is read, after each stretch: to those of the gate it adds its own, one for each input.
    Bits without a context or a repeat, where only the place speaks, are left to the gate's weights; stretches count the others.
    All texts of a chunk advance together, longest first, so those that still have bits are a prefix.
    """
    n = len(s.first) - 1
    shared = np.einsum("ij,ij->i", x, np.take(mixer.weights.astype(np.float32), gate, axis=0))
    mixed = np.flatnonzero(gate >= 2)
    alone = np.flatnonzero(gate < 2)
    refined = mixer.coded(np.take(shared, alone), np.take(gate, alone))[2]
    text = np.repeat(np.arange(n), np.diff(s.first))
    out = np.bincount(np.take(text, alone), weights=np.log(np.where(np.take(s.y, alone) == 1, refined, 1 - refined)), minlength=n).astype(np.float64)
    bounds = np.searchsorted(mixed, s.first)
    size = np.diff(bounds)
    order = np.argsort(-size, kind="stable")
    order = order[size[order] > 0]
    if not len(order):
        return out / math.log(10)
    first, size = bounds[:-1][order], size[order]
    x, shared, gate, ys = np.take(x, mixed, axis=0), np.take(shared, mixed), np.take(gate, mixed), np.take(s.y, mixed)
    own = np.zeros((len(order), INPUTS), dtype=np.float32)
    total = np.zeros(len(order))
    for begin, length in spans_of(int(size[0])):
        k = int(np.searchsorted(-size, -begin, side="left"))
        left = np.minimum(length, size[:k] - begin)
        start = np.cumsum(left) - left
        at = np.arange(int(start[-1] + left[-1])) + np.repeat(first[:k] + begin - start, left)
        xs, y = np.take(x, at, axis=0), np.take(ys, at)
        p, _, refined = mixer.coded(np.take(shared, at) + np.einsum("ij,ij->i", xs, np.repeat(own[:k], left, axis=0)), np.take(gate, at))
        total[:k] += np.add.reduceat(np.log(np.where(y == 1, refined, 1 - refined)), start, dtype=np.float64)
        xs *= ((y - p) * np.float32(RATE * math.sqrt(STEP / length)))[:, None]
        own[:k] += np.add.reduceat(xs, start, axis=0)
    out[order] += total
    return out / math.log(10)


def learn(mixer: Mixer, s: Stream, x: np.ndarray, gate: np.ndarray) -> None:
    """One online pass over the bits of a chunk, in their order."""
    for begin in range(0, len(s.y), 4096):
        part = slice(begin, begin + 4096)
        xs, g, y = x[part], gate[part], s.y[part].astype(np.float64)
        p, at, _ = mixer.coded(np.einsum("ij,ij->i", xs, mixer.weights[g]), g)
        error = y - p
        size = np.bincount(g, minlength=GATES)
        power = np.bincount(g, weights=(xs**2).mean(axis=1), minlength=GATES)
        for i in range(INPUTS):
            mixer.weights[:, i] += START_RATE * np.bincount(g, weights=error * xs[:, i], minlength=GATES) / np.sqrt(np.maximum(1.0, size * power / np.maximum(size, 1)))
        mass, ones = np.bincount(at, minlength=GATES * BUCKETS), np.bincount(at, weights=y, minlength=GATES * BUCKETS)
        flat = mixer.refine.ravel()
        flat[:] = (flat * 500 + ones) / (500 + mass)


def beyond(book: Codebook, t: Tokens, sizes: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """log10 of the probability of each text's bits that are not mixed."""
    left = sizes < book.first[t.leaf + 1] - book.first[t.leaf]
    at = np.flatnonzero(left)
    value = rest[(sizes[at] > 0).astype(np.int64), t.clear[at].astype(np.int64), t.kind[at], t.leaf[at]]
    return np.bincount(t.doc[at], weights=value, minlength=t.n)


def _context_counts(shared):
    """(piece, counts) of the hashed contexts of a whole partition of texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book = opened(shared)
        known = _known(book)
        total, seen = np.zeros((2, SLOTS * 2), dtype=np.int32), False
        for batch in batches:
            for _, _, data, offsets in chunks(batch, size=CHUNK):
                t = Tokens(book, known, data, offsets)
                s = Stream.of(book, t, with_context(book, t))
                for order in (0, 1):
                    at, slot = s.slots(t, order)
                    np.add.at(total[order], slot * 2 + s.y[at], np.int32(1))
                seen = True
        if seen:
            pieces = total.reshape(2 * PIECES, -1)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(pieces), dtype=np.int32)), pa.array([zlib.compress(x, 1) for x in pieces], type=pa.binary())], ["piece", "counts"])

    return run


def _start(book_, counts_):
    """The state of a mixer that learned online from a partition of texts, times their number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book, own = opened(book_), fresh()
        own.counts = opened(counts_)
        known, mass, hits = _known(book), 0.0, np.zeros((2, 4))
        for batch in batches:
            for row, stop, data, offsets in chunks(batch, size=CHUNK):
                t = Tokens(book, known, data, offsets)
                s = Stream.of(book, t)
                learn(own, s, *own.inputs(book, t, s, leave=True))
                rare = np.flatnonzero((t.leaf == book.escape) & (t.expected >= 0))
                rare = rare[t.leaf[t.expected[rare]] == book.escape]
                hits += np.stack((np.bincount(t.state[rare], minlength=4), np.bincount(t.state[rare], weights=t.kept[rare], minlength=4)))
                mass += stop - row
        if mass:
            state = np.concatenate((own.weights.ravel() * mass, own.refine.ravel() * mass, hits.ravel(), [mass]))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(state))), pa.array(state)], ["i", "x"])

    return run


def train(texts: DataFrame, book_, n_texts: int) -> tuple[Mixer, Broadcast]:
    """Mixer, and its counts as they are shared, from the n_texts rows of texts(text, key); book_: the shared codebook."""
    mixer, spark = fresh(), texts.sparkSession
    if not n_texts:
        return mixer, share(spark, mixer.counts)
    summed = texts.select("text").mapInArrow(lean(_context_counts(book_)), "piece int, counts binary").repartition("piece").sortWithinPartitions("piece").mapInArrow(_sum_pieces, "piece int, counts binary")
    rows = sorted(summed.collect(), key=lambda r: r["piece"])  # the tables, whose size is fixed
    if rows:
        mixer.counts = np.concatenate([np.frombuffer(zlib.decompress(r["counts"]), dtype=np.int32) for r in rows]).reshape(2, SLOTS, 2)
    counts_ = share(spark, mixer.counts)
    # every task learns online from its own texts; the states are averaged by the texts they saw
    mean = texts.select("text").mapInArrow(lean(_start(book_, counts_)), "i long, x double").groupBy("i").agg(F.sum("x").alias("x")).toArrow()
    if mean.num_rows:
        state = np.zeros(mean.num_rows)
        state[mean["i"].to_numpy()] = mean["x"].to_numpy()
        state, hits, mass = state[:-9], state[-9:-1].reshape(2, 4), state[-1]
        mixer.weights, mixer.refine = (state[: GATES * INPUTS] / mass).reshape(GATES, INPUTS), (state[GATES * INPUTS :] / mass).reshape(GATES, BUCKETS)
        mixer.repeated = (hits[1] + 0.5) / (hits[0] + 1)
    return mixer, counts_


def _sum_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by piece."""
    piece, total, out = None, None, []
    pack = lambda x: zlib.compress(np.minimum(x, 2**31 - 1).astype(np.int32), 1)
    for batch in batches:
        for p, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            counts = np.frombuffer(zlib.decompress(raw), dtype=np.int32)
            if p != piece:
                if piece is not None:
                    out.append((piece, pack(total)))
                piece, total = p, np.zeros(len(counts), dtype=np.int64)
            total += counts
    if piece is not None:
        out.append((piece, pack(total)))
    yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in out], type=pa.int32()), pa.array([c for _, c in out], type=pa.binary())], ["piece", "counts"])


def _word_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, class, occurrences) summed over a batch of texts; a text of class -1 only makes its words known."""
    for batch in batches:
        kind = batch.column(1).to_pylist()
        data, at = text_buffer(batch.column(0))
        raw = data.tobytes()
        found: dict[int, Counter] = {}
        for i in range(len(at) - 1):
            tally = found.setdefault(kind[i], Counter())
            # A-Z lower-cased, split at white space: bytes know ASCII only; the end is the empty word
            tally.update(raw[at[i] : at[i + 1]].lower().split())
            tally[b""] += 1
        for k, tally in found.items():
            words, counts = list(tally), np.fromiter(tally.values(), dtype=np.int64, count=len(tally))
            if k < 0:
                counts[:] = 0
            for begin in range(0, len(words), 100_000):
                part = words[begin : begin + 100_000]
                yield pa.RecordBatch.from_arrays([pa.array(part, type=pa.binary()), pa.array(np.full(len(part), k, dtype=np.int32)), pa.array(counts[begin : begin + 100_000])], ["word", "kind", "c"])


@dataclass
class Totals:
    """Tokens, types and discount of the escaped words."""

    tokens: int
    types: int
    discount: float

    def interpolated(self, c: np.ndarray, lower: np.ndarray) -> np.ndarray:
        """log10 of the discounted share of c, and of `lower` for what the discounts free."""
        if not self.tokens:
            return lower
        below = lower + math.log10(self.discount * self.types / self.tokens)
        own = np.maximum(c - self.discount, 0) / self.tokens
        # where the sum would leave what a double holds, the larger part is all of it
        return np.where(own > 0, np.log10(np.maximum(own, 1e-300) + np.power(10.0, np.maximum(below, -290.0))), below)


def _spell(shared):
    """log10 of the probability of each escaped word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        speller, totals = opened(shared)
        for batch in batches:
            data, at = text_buffer(batch.column(0))
            n = len(at) - 1
            spelled = np.concatenate([speller.log10_words(data[at[a] : at[min(n, a + 5_000)]], at[a : min(n, a + 5_000) + 1] - at[a]) for a in range(0, n, 5_000)]) if n else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(totals.interpolated(batch.column(1).to_numpy(), spelled))], ["word", "c", "lp"])

    return run


SCORE_ROWS = "doc_id long, row_a long, row_b long, word binary, times long, priced long, tokens long, size long, known long, base double, coded double"


def _score_rows(book_, counts_, rest_, mixer: Mixer):
    """Per text one row of what the tree's words say, and a row for each escaped word: its occurrences, and those that no repeat paid for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book = opened(book_)
        mixer.counts = opened(counts_)
        rest = opened(rest_)
        known = _known(book)
        base_of = np.log10(book.count + 1.0) - math.log10(book.tokens + book.types + 1)
        true, false = np.log10(mixer.repeated), np.log10(1 - mixer.repeated)
        for batch in batches:
            rows = [batch.column(i).to_numpy(zero_copy_only=False) for i in (2, 3)]
            for begin, stop, data, offsets in chunks(batch, size=CHUNK):
                n = stop - begin
                t = Tokens(book, known, data, offsets)
                sizes = to_be_mixed(book, t)
                s = Stream.of(book, t, sizes)
                coded = cost(mixer, s, *mixer.inputs(book, t, s)) + beyond(book, t, sizes, rest)
                rare = t.leaf == book.escape
                often = np.flatnonzero(~rare)
                base = np.bincount(t.doc[often], weights=base_of[t.leaf[often]], minlength=n)
                in_training = np.bincount(t.doc[often], weights=book.count[t.leaf[often]] > 0, minlength=n).astype(np.int64)
                rare = np.flatnonzero(rare)
                # an expected escaped word is paid for by how often such repeats come true
                hoped = (t.expected[rare] >= 0) & (t.leaf[t.expected[rare]] == book.escape)
                paid = hoped & t.kept[rare]
                coded += np.bincount(t.doc[rare], weights=np.where(paid, true[t.state[rare]], np.where(hoped, false[t.state[rare]], 0.0)), minlength=n)
                tokens = np.diff(t.first)
                size = np.bincount(t.words.doc(), weights=t.words.end - t.words.start + 1, minlength=n).astype(np.int64) + 1
                order = rare[np.lexsort((t.hash[rare], t.doc[rare]))]
                new = np.ones(len(order), dtype=bool)
                new[1:] = (t.doc[order][1:] != t.doc[order][:-1]) | (t.hash[order][1:] != t.hash[order][:-1])
                first = np.flatnonzero(new)
                times = np.diff(np.append(first, len(order)))
                free = np.zeros(len(t.leaf), dtype=np.int64)
                free[rare] = ~paid
                priced = np.add.reduceat(free[order], first) if len(first) else times
                at = order[first]
                lowered = LOWER[data].tobytes()
                place = t.word[at]
                words = [lowered[a:b] for a, b in zip(t.words.start[place].tolist(), t.words.end[place].tolist(), strict=True)]
                every = np.concatenate((np.arange(n), t.doc[at]))
                blank = np.zeros(len(at))
                keys = [r[begin:stop] for r in rows]
                # the key of a text's own row holds a space, which no word does
                own = [b" %d" % x for x in keys[0].tolist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(1).slice(begin, n).take(pa.array(every)),
                        *[pa.array(k[every]) for k in keys],
                        pa.array(own + words, type=pa.binary()),
                        *[pa.array(np.concatenate((np.zeros(n, dtype=np.int64), x))) for x in (times, priced)],
                        *[pa.array(np.concatenate((x, blank.astype(np.int64)))) for x in (tokens, size, in_training)],
                        *[pa.array(np.concatenate((x, blank))) for x in (base, coded)],
                    ],
                    ["doc_id", "row_a", "row_b", "word", "times", "priced", "tokens", "size", "known", "base", "coded"],
                )

    return run


def _least_count(counted: DataFrame) -> int:
    """The least count that at most FREQUENT words reach, and LEAST_COUNT at least.

    Words are put on a logarithmic scale of counts of a few thousand steps, so the histogram is small and no task ever orders words.
    """
    step = F.floor(F.log2(F.col("c")) * 64)
    least, above = 2**62, 0
    for r in sorted(counted.filter(F.col("c") >= LEAST_COUNT).groupBy(step.alias("step")).agg(F.count("*").alias("n"), F.min("c").alias("c")).collect(), key=lambda r: -r["step"]):
        above += r["n"]
        if above > FREQUENT:
            break
        least = r["c"]
    return least


def score(docs: DataFrame, held_out: Column, class_column: str | None = None) -> DataFrame:
    """One row for every row of docs(doc_id, text), learning from rows where held_out is false.

    doc_id, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte.  A null text is empty: its only
    token is the end.  Repeated rows are scored alike, and teach as often as they occur.  class_column splits the
    training rows into classes (null is one); it is not read for the rows that are scored.
    """
    spark = docs.sparkSession
    label = F.coalesce(F.col(class_column).cast("string"), F.lit("")) if class_column else F.lit("")
    plain = docs.select(F.coalesce("text", F.lit("")).alias("text"), F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held_out"), label.alias("label"))
    sizes = plain.filter(~F.col("held_out")).groupBy("label").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "label")
    n_docs = sizes.agg(F.sum("n").alias("n")).first()["n"] or 0
    names = [r["label"] for r in sizes.limit(CLASSES).collect()] or [""]
    kind = F.lit(len(names) - 1)
    for i, name in enumerate(names):
        kind = F.when(F.col("label") == name, F.lit(i)).otherwise(kind)
    words = plain.select("text", F.when(F.col("held_out"), F.lit(-1)).otherwise(kind).cast("int").alias("kind")).mapInArrow(lean(_word_rows), "word binary, kind int, c long")
    own = [f"c{k}" for k in range(len(names))]
    counted = cut(words.groupBy("word").agg(F.sum("c").alias("c"), *[F.sum(F.when(F.col("kind") == k, F.col("c")).otherwise(0)).alias(x) for k, x in enumerate(own)]))
    least = _least_count(counted)
    rare = (F.col("c") < least) & (F.col("word") != b"")
    number = lambda x: F.sum(x.cast("long"))
    facts = counted.agg(
        number(F.col("c") > 0).alias("types"), *[F.sum(x).alias(x) for x in own],
        F.sum(F.when(rare, F.col("c"))).alias("rare_tokens"), number(rare & (F.col("c") > 0)).alias("rare_types"), number(rare & (F.col("c") == 1)).alias("once"), number(rare & (F.col("c") == 2)).alias("twice"),
    ).first()
    n_types, n_train = int(facts["types"] or 0), sum(int(facts[x] or 0) for x in own)
    top = counted.filter(~rare & (F.col("c") > 0)).toArrow()  # at most FREQUENT rows and the end
    book = Codebook.build(top["word"].to_pylist(), top["c"].to_numpy(), np.stack([top[x].to_numpy() for x in own]), np.array([float(facts[x] or 0) for x in own]), n_types)
    # absolute discounting: the share of a count that the words seen once and twice say is luck
    totals = Totals(int(facts["rare_tokens"] or 0), int(facts["rare_types"] or 0), min(0.95, max(0.05, (facts["once"] or 0) / max(1, (facts["once"] or 0) + 2 * (facts["twice"] or 0)))))
    speller = share(spark, (train_speller(counted.filter((F.col("c") > 0) & (F.col("word") != b"")).select("word")).ready(), totals))
    spelled = counted.filter(rare).select("word", "c").mapInArrow(lean(_spell(speller)), "word binary, c long, lp double")
    numbered = plain.withColumn("row_a", F.xxhash64("doc_id", "text")).withColumn("row_b", F.xxhash64(F.lit("b"), "text", "doc_id"))
    book_ = share(spark, book)
    mixer, counts_ = train(numbered.filter(~F.col("held_out")).select("text", F.col("row_a").alias("key")), book_, n_docs)
    mixer.counts = mixer.counts[:0]  # shared apart
    rest_ = share(spark, remainder(book, mixer))
    rows = numbered.select("text", "doc_id", "row_a", "row_b").mapInArrow(lean(_score_rows(book_, counts_, rest_, mixer)), SCORE_ROWS)
    joined = rows.join(spelled, "word", "left")
    c = F.coalesce("c", F.lit(0))
    priced = F.when(F.col("priced") > 0, F.col("priced") * F.col("lp")).otherwise(0.0)
    parts = joined.groupBy("row_a", "row_b").agg(
        F.min("doc_id").alias("doc_id"),
        F.sum((F.col("times") == 0).cast("long")).alias("copies"),
        F.sum("tokens").alias("tokens"),
        F.sum("size").alias("size"),
        F.sum(F.col("known") + F.when(c > 0, F.col("times")).otherwise(0)).alias("known"),
        F.sum(F.col("base") + F.col("times") * (F.log10(c + 1.0) - math.log10(n_train + n_types + 1))).alias("base"),
        F.sum(F.col("coded") + priced).alias("coded"),
    )
    # repeated rows were summed together: each gets its share
    each = lambda x: F.col(x) / F.col("copies")
    again = parts.withColumn("copy_", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return again.select(
        "doc_id", each("tokens").cast("long").alias("n_tokens"), each("known").cast("long").alias("n_known"), F.lit(n_train).cast("long").alias("train_tokens"), each("base").alias("base_score"),
        each("coded").alias("score"), (-F.col("coded") * math.log2(10) / F.col("size")).alias("bits_per_byte"),
    )


def op4_lm_score(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = score(docs, crc_mod("doc_id", 7) == 2, "lang")
    return scored.withColumn("held_out", crc_mod("doc_id", 7) == 2).select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte")
