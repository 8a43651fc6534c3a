"""Bit-wise speller of words: hashed byte contexts, mixed by gated logistic weights.

A word is its bytes and a closing byte, eight bits each, high bit first.  For every bit, ORDERS
hashed contexts (the last 0 to ORDERS - 1 bytes of the word, each with the bits of the current byte
already read) keep counts of zeros and ones.  Each pair of counts becomes a logit; the logits are mixed
by a weight vector that a gate chooses (the longest context with evidence) and that is learned online,
by gradient steps on the coding cost, from counts that leave the coded word itself out.  The mix is
refined by a second adaptive stage: a table of (gate, quantised probability) that learns the actual
rate of ones.

Bit counts are taken over all distinct words, and the weights and the refinement, a few hundred numbers, are learned
from all of them.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U64, lean, mix64, opened, share, text_buffer

#: Contexts of 0 to ORDERS - 1 bytes.
ORDERS = 6
#: log2 of the slots of each order's table.
BITS = 19
SLOTS = 1 << BITS
GATES = ORDERS + 1
BUCKETS = 33
RATE = 0.02
BATCH = 8192
#: Bytes of words that a pass over the vocabulary takes at once.
GATHERED = 1 << 20
#: Words that are counted at once.
COUNTED = 8192
#: Each order's table travels in so many pieces.
PIECES = 64
#: Longer words are spelled in pieces of this many bytes; contexts start anew with each.
PIECE = 64


def _symbols(words: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all words with a closing byte (0x20) each: bytes, place within the word, word of each byte."""
    length = np.diff(offsets)
    total = length + 1
    end = np.cumsum(total)
    out = np.full(int(end[-1]) if len(end) else 0, 0x20, dtype=np.uint8)
    word = np.repeat(np.arange(len(length)), total)
    place = np.arange(len(out)) - np.repeat(end - total, total)
    inside = place < np.repeat(length, total)
    out[inside] = words
    return out, place, word


def bit_slots(data: np.ndarray, place: np.ndarray) -> Iterator[tuple[np.ndarray, list[np.ndarray]]]:
    """For each of the eight bits of every byte: the bit, and its slot in the table of each order."""
    for bit, slots_of in slots_by_part(data, place):
        yield bit, slots_of(slice(None))


def slots_by_part(data: np.ndarray, place: np.ndarray) -> Iterator[tuple[np.ndarray, Callable[[slice], list[np.ndarray]]]]:
    """The same with the slots of a part of the bytes on demand: those of all take 48 bytes for each byte."""
    value = data.astype(np.uint64) + U64(1)
    keys = []
    with np.errstate(over="ignore"):
        key = np.zeros(len(data), dtype=np.uint64)
        for order in range(ORDERS):
            if order:
                before = np.zeros(len(data), dtype=np.uint64)
                before[order:] = value[:-order] if len(data) > order else value[:0]
                before[place % PIECE < order] = 0
                key = mix64(key * U64(0x100000001B3) + before + U64(order))
            keys.append(key)
        del value, key
        if ORDERS > 1:
            del before
        node = np.ones(len(data), dtype=np.uint64)
        for b in range(7, -1, -1):
            bit = (data >> b) & 1

            def slots_of(part: slice, node=node) -> list[np.ndarray]:
                with np.errstate(over="ignore"):
                    own = node[part] * U64(0x9E3779B97F4A7C15)
                    # the keys are mixed already: one multiplication spreads the place in the byte over them
                    return [(((k[part] ^ own) * U64(0xD6E8FEB86659FD93 + 2 * i)) >> U64(64 - BITS)).astype(np.int64) for i, k in enumerate(keys)]

            yield bit, slots_of
            node = node * U64(2) + bit.astype(np.uint64)


@dataclass
class Mixer:
    """counts: (order, slot, bit); weights: (gate, order); refine: (gate, bucket) log-odds corrections as probabilities."""

    counts: np.ndarray
    weights: np.ndarray
    refine: np.ndarray
    table: np.ndarray | None = None

    def inputs(self, slots: list[np.ndarray], leave: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(logits, gate) of each bit; `leave`, the coded bits, takes the coded word out of the counts."""
        gate = np.zeros(len(slots[0]), dtype=np.int64)
        if leave is None:
            x = np.zeros((len(slots[0]), ORDERS), dtype=np.float32)
            logits = self.logits()
            for i, s in enumerate(slots):
                found = np.take(logits[i], s)
                known = found == found  # not a number where nothing was counted
                x[:, i] = np.where(known, found, np.float32(0))
                gate[known] = i + 1
            return x, gate
        x = np.zeros((len(slots[0]), ORDERS), dtype=np.float64)
        for i, s in enumerate(slots):
            zero, one = self.counts[i, s, 0].astype(np.float64), self.counts[i, s, 1].astype(np.float64)
            zero, one = np.maximum(0, zero - (leave == 0)), np.maximum(0, one - (leave == 1))
            n = zero + one
            x[:, i] = np.log((one + 0.02) / (zero + 0.02)) * (n > 0)
            gate[n > 0] = i + 1
        return np.clip(x, -12, 12), gate

    def logits(self) -> np.ndarray:
        """Logit of every slot, as (order, slot); not a number where nothing was counted."""
        if self.table is None:
            zero, one = self.counts[..., 0].astype(np.float32), self.counts[..., 1].astype(np.float32)
            self.table = np.clip(np.log((one + np.float32(0.02)) / (zero + np.float32(0.02))), -12, 12)
            self.table[zero + one == 0] = np.nan
        return self.table

    def ready(self) -> Mixer:
        """For spelling alone: the logits stand for the counts."""
        return Mixer(self.counts[:0], self.weights, self.refine, self.logits())

    def stages(self, x: np.ndarray, gate: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(mixed probability of a one, bucket, refined probability)."""
        z = np.clip(np.einsum("ij,ij->i", x, np.take(self.weights, gate, axis=0)), -14, 14)
        p = 1 / (1 + np.exp(-z))
        bucket = np.clip(np.rint((z + 12) / 24 * (BUCKETS - 1)), 0, BUCKETS - 1).astype(np.int64)
        refined = 0.5 * (p + self.refine[gate, bucket])
        return p, bucket, np.clip(refined, 1e-6, 1 - 1e-6)

    def log10_words(self, words: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """log10 P(w) of every word."""
        data, place, word = _symbols(words, offsets)
        total = np.zeros(len(data))
        for bit, slots in bit_slots(data, place):
            p = self.stages(*self.inputs(slots))[2]
            total += np.log(np.where(bit == 1, p, 1 - p))
        return np.bincount(word, weights=total, minlength=len(offsets) - 1) / math.log(10)


def learn(mixer: Mixer, words: np.ndarray, offsets: np.ndarray) -> None:
    """One online pass over a part of the vocabulary; every word is coded as if it were new."""
    data, place = _symbols(words, offsets)[:2]
    for bit, slots_of in slots_by_part(data, place):
        for begin in range(0, len(data), BATCH):
            part = slice(begin, begin + BATCH)
            b = bit[part].astype(np.float64)
            x, gate = mixer.inputs(slots_of(part), bit[part])
            p, bucket, _ = mixer.stages(x, gate)
            error = b - p
            for g in range(GATES):
                on = gate == g
                if on.any():
                    mixer.weights[g] += RATE * (error[on, None] * x[on]).sum(axis=0) / max(1.0, np.sqrt(on.sum() * (x[on] ** 2).mean()))
            at = gate * BUCKETS + bucket
            mass = np.bincount(at, minlength=GATES * BUCKETS)
            ones = np.bincount(at, weights=b, minlength=GATES * BUCKETS)
            flat = mixer.refine.ravel()
            flat[:] = (flat * 500 + ones) / (500 + mass)


def fresh() -> Mixer:
    centre = 1 / (1 + np.exp(-(np.arange(BUCKETS) / (BUCKETS - 1) * 24 - 12)))
    weights = np.zeros((GATES, ORDERS))
    for g in range(1, GATES):
        weights[g, g - 1] = 0.5
        weights[g, max(0, g - 2)] += 0.3
    return Mixer(np.zeros((ORDERS, SLOTS, 2), dtype=np.int32), weights, np.tile(centre, (GATES, 1)))


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Bytes and offsets of the first column, about GATHERED bytes at a time."""
    parts, size = [], 0
    for batch in batches:
        parts.append(batch.column(0))
        size += len(text_buffer(batch.column(0))[0])
        if size >= GATHERED:
            yield text_buffer(pa.concat_arrays(parts))
            parts, size = [], 0
    if parts:
        yield text_buffer(pa.concat_arrays(parts))


def _bit_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(piece, counts) of the tables of a whole partition."""
    total = np.zeros((ORDERS, SLOTS * 2), dtype=np.int32)
    seen = False
    for data, at in _gathered(batches):
        seen = True
        # counts need no order: a few words at once, whose keys and slots take little room
        for begin in range(0, len(at) - 1, COUNTED):
            some = at[begin : begin + COUNTED + 1]
            symbols, place = _symbols(data[some[0] : some[-1]], some - some[0])[:2]
            for bit, slots in bit_slots(symbols, place):
                for i, s in enumerate(slots):
                    np.add.at(total[i], s * 2 + bit, np.int32(1))
    if seen:
        pieces = total.reshape(ORDERS * PIECES, -1)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(pieces), dtype=np.int32)), pa.array([zlib.compress(x, 1) for x in pieces], type=pa.binary())], ["piece", "counts"])


def _sum_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by piece."""
    piece, total, out = None, None, []
    for batch in batches:
        for p, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            counts = np.frombuffer(zlib.decompress(raw), dtype=np.int32)
            if p != piece:
                if piece is not None:
                    out.append((piece, total))
                piece, total = p, np.zeros(len(counts), dtype=np.int64)
            total += counts
    if piece is not None:
        out.append((piece, total))
    yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in out], type=pa.int32()), pa.array([zlib.compress(np.minimum(t, 2**31 - 1).astype(np.int32), 1) for _, t in out], type=pa.binary())], ["piece", "counts"])


def train(seen: DataFrame) -> Mixer:
    """Speller from the distinct words of seen(word)."""
    mixer = fresh()
    summed = seen.mapInArrow(lean(_bit_counts), "piece int, counts binary").repartition("piece").sortWithinPartitions("piece").mapInArrow(_sum_pieces, "piece int, counts binary")
    rows = summed.collect()  # the tables, whose size is fixed
    if not rows:
        return mixer
    mixer.counts = np.concatenate([np.frombuffer(zlib.decompress(r["counts"]), dtype=np.int32) for r in sorted(rows, key=lambda r: r["piece"])]).reshape(ORDERS, SLOTS, 2)
    shared = share(seen.sparkSession, mixer)

    def online(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start = opened(shared)
        own = Mixer(start.counts, start.weights.copy(), start.refine.copy())
        mass = 0.0
        for data, at in _gathered(batches):
            learn(own, data, at)
            mass += float(len(at) - 1)
        if mass:
            state = np.concatenate((own.weights.ravel(), own.refine.ravel())) * mass
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(state) + 1)), pa.array(np.append(state, mass))], ["i", "x"])

    # every task learns online from its own words; the states are averaged by the words they saw
    mean = seen.mapInArrow(lean(online), "i long, x double").groupBy("i").agg(F.sum("x").alias("x")).toArrow()
    shared.destroy()
    if not mean.num_rows:
        return mixer
    state = np.zeros(mean.num_rows)
    state[mean["i"].to_numpy()] = mean["x"].to_numpy()
    state = state[:-1] / state[-1]
    mixer.weights, mixer.refine = state[: GATES * ORDERS].reshape(GATES, ORDERS), state[GATES * ORDERS :].reshape(GATES, BUCKETS)
    return mixer
