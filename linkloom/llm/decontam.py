"""Benchmark decontamination by CGK embedding and bit-sampling LSH.

A text is a string over words (letters and digits, lower-cased; everything else
separates).  A document is contaminated by an item if some window of it lies
within `max_edits` (a share of the item's words) word edits of the item.

1. Windows.  A part of a text within e edits of an item with n words shares at least
   n - 2 - 3e word triples with it, so only windows of n words with so many triples
   known from items of n words (less what a length change may push out) are looked at
   further.  This filter loses nothing.
2. Embedding.  The CGK random walk reads a string of n words with a pointer that
   advances, or stays, by a random bit of (step, word); strings within e edits then
   differ, with constant probability, in O(e^2) places of the walk.
3. Repeated bit sampling.  Every repetition walks anew and hashes a few sampled
   places of the walk; windows are looked up in the table of the items of their length.
   REPETITIONS reaches TARGET_RECALL for random edits at the limit up to PIECE_WORDS (see
   the tests); longer items are cut into pieces of at most so many words.  If a part of a
   text is within the limit of the whole item, it is within the limit of a piece at least,
   so the steps above are done for every piece as for an item.
4. Verification.  Candidates are checked by exact edit distance between words, of whole items.

Items reach the workers in blocks of bounded size; each block is held against all
documents, so a benchmark of any size is covered.  Documents are never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SpanHash, U64, Words, byte_values, chunks, lean, mix64, opened, share, table

#: Edits allowed, as a share of an item's words.
MAX_EDITS = 0.15
#: Items with fewer words are too common to tell anything and must occur literally.
LITERAL_WORDS = 8
#: Walks, and their sampled places for items below and from LONG_WORDS; the chance that all sampled places agree falls
#: with the square of the edits, so long items get fewer.
REPETITIONS = 48
SAMPLES = (4, 2)
LONG_WORDS = 32
TARGET_RECALL = 0.99
#: Longer items are looked for by their pieces.
PIECE_WORDS = 100
#: Most bytes of one block of items: every piece has REPETITIONS keys and places, every word a hash and a triple.
BLOCK_BYTES = 64_000_000
PIECE_BYTES, WORD_BYTES = 16 * REPETITIONS, 32

_BYTE = np.zeros(256, dtype=bool)
_BYTE[48:58] = _BYTE[65:91] = _BYTE[97:123] = _BYTE[128:] = True


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, Words]:
    w = Words(data, offsets, _BYTE)
    return SpanHash(byte_values(data, lower=True))(w.start, w.end), w


def edits_allowed(n: int) -> int:
    return 0 if n < LITERAL_WORDS else int(n * MAX_EDITS)


def places(n: int) -> np.ndarray:
    """Sampled places (repetition, sample): spread over the part of the walk in which the pointer still reads words, about 2n steps."""
    rng = np.random.default_rng(n)
    size = SAMPLES[n >= LONG_WORDS]
    return np.sort(np.stack([rng.choice(max(size, 2 * n), size=size, replace=False) for _ in range(REPETITIONS)]), axis=1)


def cgk_walks(strings: np.ndarray, steps: int) -> np.ndarray:
    """Symbols read by all repetitions' random walks over each row, as (step, repetition, row); past the end of a row a walk reads 0."""
    rows, n = strings.shape
    padded = np.concatenate((strings, np.zeros((rows, 1), dtype=np.uint64)), axis=1)
    walks = REPETITIONS
    pointer = np.zeros((walks, rows), dtype=np.int64)
    read = np.empty((steps, walks, rows), dtype=np.uint64)
    every, seed = np.arange(rows)[None, :], (np.arange(walks, dtype=np.uint64) << U64(20))[:, None]
    with np.errstate(over="ignore"):
        for step in range(steps):
            symbol = padded[every, pointer]
            read[step] = symbol
            advance = mix64(symbol + (seed + U64(step)) * U64(0x9E3779B97F4A7C15)) & U64(1)
            pointer = np.minimum(pointer + advance.astype(np.int64), n)
    return read


def buckets(strings: np.ndarray, rows_at_once: int = 256) -> np.ndarray:
    """Key of each row in each repetition, as (repetition, row): a hash of the sampled places of its walk."""
    at = places(strings.shape[1])
    keys = np.empty((len(at), len(strings)), dtype=np.uint64)
    for begin in range(0, len(strings), rows_at_once):
        read = cgk_walks(strings[begin : begin + rows_at_once], int(at.max()) + 1)
        key = np.broadcast_to(np.arange(1, len(at) + 1, dtype=np.uint64)[:, None], read.shape[1:]).copy()
        with np.errstate(over="ignore"):
            for k in range(at.shape[1]):
                key = mix64(key * U64(0x100000001B3) + read[at[:, k], np.arange(len(at))])
        keys[:, begin : begin + rows_at_once] = key
    return keys


def edit_rows(item: np.ndarray, text: np.ndarray, free_start: bool) -> np.ndarray:
    """Edits between the whole item and the part of text that ends before each position; the part starts at 0, or anywhere."""
    column = np.arange(len(text) + 1)
    row = np.zeros_like(column) if free_start else column.copy()
    for i, x in enumerate(item):
        step = np.minimum(row[1:] + 1, row[:-1] + (text != x))
        step = np.concatenate(([i + 1], step))
        row = np.minimum.accumulate(step - column) + column
    return row


def nearest(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """(edits, first, last + 1) of the part of text that is nearest to the item; the first such end, and its longest part."""
    row = edit_rows(item, text, True)
    end = int(row.argmin())
    back = edit_rows(item[::-1], text[:end][::-1], False)
    return int(row[end]), end - int(np.flatnonzero(back == row[end])[-1]), end


def pieces(n: int) -> list[tuple[int, int]]:
    """(first word, end) of the fewest even pieces of an item of n words; the edits allowed in them sum up to those of the item or less."""
    ends = np.linspace(0, n, -(-n // PIECE_WORDS) + 1).astype(int).tolist()
    return list(zip(ends[:-1], ends[1:], strict=True))


@dataclass
class Items:
    """A block of benchmark items, in pieces by number of words."""

    ids: list
    words: list[np.ndarray]
    tables: dict[int, list[tuple[np.ndarray, np.ndarray]]]  # length -> per repetition (sorted keys, piece of each)
    piece: np.ndarray  # item and first word of each piece
    triples: np.ndarray  # sorted hashes of the pieces' word triples
    classes: np.ndarray  # for each triple, a bit for each class of lengths that has it

    @classmethod
    def build(cls, ids: list, words: list[np.ndarray]) -> Items:
        cuts = [(i, a, b) for i, w in enumerate(words) for a, b in pieces(len(w))]
        parts = [words[i][a:b] for i, a, b in cuts]
        by_length: dict[int, list[int]] = {}
        for k, w in enumerate(parts):
            by_length.setdefault(len(w), []).append(k)
        tables = {}
        for n, members in by_length.items():
            keys = buckets(np.stack([parts[k] for k in members]))
            order = np.argsort(keys, axis=1, kind="stable")
            tables[n] = [(key[o], np.array(members)[o]) for key, o in zip(keys, order, strict=True)]
        found = [triple_hashes(w) for w in parts]
        bits = [np.full(len(t), 1 << (len(w) % 64), dtype=np.uint64) for t, w in zip(found, parts, strict=True)]
        every, bit = (np.concatenate(x) if x else np.zeros(0, dtype=np.uint64) for x in (found, bits))
        order = np.argsort(every, kind="stable")
        triples, first = np.unique(every[order], return_index=True)
        classes = np.bitwise_or.reduceat(bit[order], first) if len(first) else bit
        return cls(ids, words, tables, np.array([c[:2] for c in cuts], dtype=np.int64).reshape(-1, 2), triples, classes)


def triple_hashes(words: np.ndarray) -> np.ndarray:
    if len(words) < 3:
        return words[:0]
    with np.errstate(over="ignore"):
        return mix64(mix64(words[:-2] * U64(0x9E3779B97F4A7C15) + words[1:-1]) * U64(0xD6E8FEB86659FD93) + words[2:])


def search(items: Items, known: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, int, int, int]]:
    """(text, item, edits, first word, words) of the nearest part of each contaminated (text, item)."""
    hashes, w = tokens(data, offsets)
    if not len(hashes) or not items.tables:
        return []
    limit, doc = w.limit(), w.doc()
    triple = triple_hashes(hashes)
    hit = np.flatnonzero(known[(triple >> U64(40)).astype(np.int64)])
    if len(items.triples):
        hit = hit[limit[hit] >= hit + 3]  # none across two texts
        at = np.minimum(np.searchsorted(items.triples, triple[hit]), len(items.triples) - 1)
        same = items.triples[at] == triple[hit]
        hit, classes = hit[same], items.classes[at[same]]
    else:
        hit, classes = hit[:0], items.classes[:0]
    best: dict[tuple[int, int], tuple[int, int, int]] = {}
    reached: dict[tuple[int, int], tuple[int, int]] = {}  # first and last place where the item may begin
    for n, tables in items.tables.items():
        e = edits_allowed(n)
        if n >= 3:
            own = hit[classes & U64(1 << (n % 64)) != 0]
            # the window has the item's size; e words of an edited copy may lie beyond its end
            need = max(1, n - 2 - 4 * e)
            if len(own) < need:
                continue
            flag = np.zeros(len(hashes) + 1, dtype=np.int32)
            flag[own + 1] = 1
            total = np.cumsum(flag)
            # only starts within reach of a hit can have enough
            reach = np.zeros(len(hashes) + 1, dtype=np.int32)
            np.add.at(reach, np.maximum(0, own - n + 3), 1)
            np.add.at(reach, np.minimum(own + 1, len(hashes)), -1)
            starts = np.flatnonzero(np.cumsum(reach)[:-1] > 0)
            ends = np.minimum(starts + n, limit[starts])
            starts = starts[(ends - starts >= n - e) & (total[np.maximum(ends - 2, starts)] - total[starts] >= need)]
        else:
            starts = np.flatnonzero(limit - np.arange(len(hashes)) >= n)
        if not len(starts):
            continue
        strings = np.zeros((len(starts), n), dtype=np.uint64)
        place = starts[:, None] + np.arange(n)
        inside = place < limit[starts][:, None]
        strings[inside] = hashes[np.minimum(place, len(hashes) - 1)][inside]
        own = buckets(strings)
        for r, (keys, members) in enumerate(tables):
            low, high = np.searchsorted(keys, own[r], side="left"), np.searchsorted(keys, own[r], side="right")
            for i in np.flatnonzero(high > low):
                text = int(doc[starts[i]])
                for item, first in items.piece[members[low[i] : high[i]]].tolist():
                    at = int(starts[i]) - first
                    a, b = reached.get((text, item), (at, at))
                    reached[text, item] = (min(a, at), max(b, at))
    for (text, item), (a, b) in reached.items():
        # exact: the nearest part of all that the colliding windows cover, with room for the edits allowed, before the piece and in it
        n = len(items.words[item])
        e = edits_allowed(n)
        room = e if n <= PIECE_WORDS else 2 * e
        a, b = max(int(w.first[text]), a - room), min(int(w.first[text + 1]), b + n + room)
        d, first, last = nearest(items.words[item], hashes[a:b])
        if d <= e:
            best[text, item] = (d, a + first, last - first)
    return [(text, item, d, int(start - w.first[text]), length) for (text, item), (d, start, length) in best.items()]


def _known(items: Items) -> np.ndarray:
    flags = np.zeros(1 << 24, dtype=bool)
    flags[(items.triples >> U64(40)).astype(np.int64)] = True
    return flags


def item_blocks(benchmark: DataFrame) -> Iterator[Items]:
    """Blocks of items with at most BLOCK_BYTES (or one item); a text without words is no item."""
    ids, words, size = [], [], 0
    for row in benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").filter(F.col("text").isNotNull()).toLocalIterator():
        raw = np.frombuffer(row["text"].encode(), dtype=np.uint8)
        own, _ = tokens(raw, np.array([0, len(raw)]))
        if not len(own):
            continue
        cost = PIECE_BYTES * len(pieces(len(own))) + WORD_BYTES * len(own)
        if ids and size + cost > BLOCK_BYTES:
            yield Items.build(ids, words)
            ids, words, size = [], [], 0
        ids.append(row["item_id"])
        words.append(own)
        size += cost
    if ids:
        yield Items.build(ids, words)


MATCHES = "doc_id long, item_id long, edits int, item_words int, first_word int, words int"


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per contaminated (document, item): the nearest window and its word edits.

    Null, empty and short texts match nothing.  Repeated rows of either table
    give repeated results; equal distances go to the first window.
    """
    spark = docs.sparkSession
    plain = docs.select("text", F.col("doc_id").cast("long").alias("doc_id"))
    found = None
    for block in item_blocks(benchmark):
        shared = share(spark, block)  # at most BLOCK_BYTES

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            items = opened(shared)
            known = _known(items)
            for batch in batches:
                rows = []
                for row, _, data, offsets in chunks(batch):
                    rows += [(row + t, *rest) for t, *rest in search(items, known, data, offsets)]
                at = pa.array([r[0] for r in rows], type=pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column(1).take(at), pa.array([items.ids[r[1]] for r in rows], type=pa.int64()), pa.array([r[2] for r in rows], type=pa.int32()), pa.array([len(items.words[r[1]]) for r in rows], type=pa.int32()), pa.array([r[3] for r in rows], type=pa.int32()), pa.array([r[4] for r in rows], type=pa.int32())], ["doc_id", "item_id", "edits", "item_words", "first_word", "words"])

        part = plain.mapInArrow(lean(run), MATCHES)
        found = part if found is None else found.unionByName(part)
    return found if found is not None else spark.createDataFrame([], MATCHES)


def op3_decontaminate(spark, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def stage_decontaminate(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows of docs that hold no benchmark item; all columns stay. Each row is judged where it lies, block after block."""
    text_at = docs.columns.index("text")
    for block in item_blocks(table(spark, sf_dir, "benchmark")):
        shared = share(spark, block)

        def keep(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            items = opened(shared)
            known = _known(items)
            for batch in batches:
                clean = np.ones(batch.num_rows, dtype=bool)
                for row, _, data, offsets in chunks(batch, batch.schema.names[text_at]):
                    for text, *_ in search(items, known, data, offsets):
                        clean[row + text] = False
                yield batch.filter(pa.array(clean))

        docs = docs.mapInArrow(lean(keep), docs.schema)
    return docs
