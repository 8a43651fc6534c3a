"""Substring dedup with repeated-phrase automata.

A window is WINDOW consecutive words.  Every word covered by a window whose word
sequence also starts in a document with a smaller id is removed; windows are
judged on the input.

Confirming recurring passages without shuffling every window:

1. The anchor of a window is the least hash among its ANCHOR-word grams, so equal
   windows have equal anchors.  Consecutive windows with the same anchor form a
   span; about one row in (WINDOW - ANCHOR + 2) / 2 words leaves the documents.
2. An anchor that occurs in one document only rules its windows out.  If all spans of
   an anchor hold the same words, its windows recur exactly where the span does, and the
   least document id of the anchor is theirs.
3. Only the windows of the remaining, ambiguous anchors are grouped one by one, by a
   128-bit hash.

Each document then gets the list of its recurring anchors and windows with the
least id of each.  The passages they confirm are cut from its own text into tiles of
WINDOW words; the tiles of a chunk of documents are compiled into one Aho-Corasick
automaton (a shard), and the chunk's documents are streamed through it to find
every occurrence, tile ends meeting in the next tile's start.  No group of documents ever meets
in one task: all keys are hashes of short word runs, aggregated before the shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SpanHash, U64, Words, byte_values, chunks, free_names, lean, mix64, signed, sliding_min, table

WINDOW = 50
ANCHOR = 12
#: Stands for a missing id: nothing comes before it, and it is never searched for.
NO_ID = -(2**63)


class Passages:
    """Windows of a chunk of documents with their anchors."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, window: int = WINDOW, anchor: int = ANCHOR):
        w = self.words = Words(data, offsets)
        self.window = window
        self.first_hash = SpanHash(byte_values(data, 0), 0)(w.start, w.end)
        self.data = data
        n = len(w.start)
        self.grams = SpanHash(self.first_hash, 1)
        at = np.arange(max(0, n - anchor + 1))
        gram = self.grams(at, at + anchor)
        least = sliding_min(gram, window - anchor + 1)
        start = np.arange(len(least))
        self.start = start[w.limit()[: len(least)] >= start + window]
        self.anchor = least[self.start]
        self.doc = w.doc()[self.start]

    def spans(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, anchor, hash of all words) of each run of windows with one anchor."""
        if not len(self.start):
            return self.doc, self.anchor, self.anchor
        new = np.ones(len(self.start), dtype=bool)
        new[1:] = (self.anchor[1:] != self.anchor[:-1]) | (self.start[1:] != self.start[:-1] + 1)
        begin = np.flatnonzero(new)
        last = np.append(begin[1:], len(new)) - 1
        return self.doc[begin], self.anchor[begin], self.grams(self.start[begin], self.start[last] + self.window)

    def hashes(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Two independent hashes of the windows at these indexes."""
        at = self.start[which]
        if not hasattr(self, "second"):
            w = self.words
            self.second = SpanHash(SpanHash(byte_values(self.data, 1), 1)(w.start, w.end), 0)
        return self.grams(at, at + self.window), self.second(at, at + self.window)


def _span_rows(window: int, anchor: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(1).to_numpy(zero_copy_only=False)
            for row, _, data, offsets in chunks(batch):
                doc, key, span = Passages(data, offsets, window, anchor).spans()
                yield pa.RecordBatch.from_arrays([pa.array(signed(key)), pa.array(signed(span)), pa.array(ids[row + doc])], ["anchor", "span", "doc_id"])

    return run


def _lists(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Flat values and offsets of a list<struct<key, home>> column; a null is an empty list."""
    return column.flatten(), np.concatenate(([0], np.cumsum(column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)))).astype(np.int64)


def _pick(flat: pa.Array, offsets: np.ndarray, row: int, stop: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text within the chunk, key, home) of the entries of rows [row, stop)."""
    part = flat.slice(offsets[row], offsets[stop] - offsets[row])
    key = part.field(0).to_numpy(zero_copy_only=False).view(np.uint64) if len(part) else np.zeros(0, dtype=np.uint64)
    home = part.field(1).to_numpy(zero_copy_only=False) if len(part) else np.zeros(0, dtype=np.int64)
    return np.repeat(np.arange(stop - row), np.diff(offsets[row : stop + 1])), key, home


def _match(doc: np.ndarray, key: np.ndarray, own_doc: np.ndarray, own_key: np.ndarray) -> np.ndarray:
    """For each (own_doc, own_key) its place among the (doc, key), or -1."""
    if not len(key):
        return np.full(len(own_key), -1)
    with np.errstate(over="ignore"):
        order = np.argsort(mix64(key + doc.astype(np.uint64) * U64(0x9E3779B97F4A7C15)), kind="stable")
        both = mix64(key + doc.astype(np.uint64) * U64(0x9E3779B97F4A7C15))[order]
        own = mix64(own_key + own_doc.astype(np.uint64) * U64(0x9E3779B97F4A7C15))
    at = np.minimum(np.searchsorted(both, own), len(both) - 1)
    return np.where(both[at] == own, order[at], -1)


def _window_rows(window: int, anchor: int):
    """Windows of ambiguous anchors, from (text, doc_id, ambiguous)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(1).to_numpy(zero_copy_only=False)
            flat, at = _lists(batch.column(2))
            for row, stop, data, offsets in chunks(batch):
                doc, key, _ = _pick(flat, at, row, stop)
                if not len(key):
                    continue
                p = Passages(data, offsets, window, anchor)
                which = np.flatnonzero(_match(doc, key, p.doc, p.anchor) >= 0)
                a, b = p.hashes(which)
                yield pa.RecordBatch.from_arrays([pa.array(signed(a)), pa.array(signed(b)), pa.array(ids[row + p.doc[which]])], ["a", "b", "doc_id"])

    return run


def _locate(window: int, anchor: int, build, carry: int | None = None):
    """Apply `build(words, removed, raw)` to each document once its removed words are known; column `carry` goes along."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(1).to_numpy(zero_copy_only=False)
            plain, plain_at = _lists(batch.column(2))
            single, single_at = _lists(batch.column(3))
            for row, stop, data, offsets in chunks(batch):
                out = []
                tiles: dict[str, int] = {}
                doc, key, home = _pick(plain, plain_at, row, stop)
                doc2, key2, home2 = _pick(single, single_at, row, stop)
                if len(key) or len(key2):
                    p = Passages(data, offsets, window, anchor)
                    least = np.full(len(p.start), np.iinfo(np.int64).max)
                    found = _match(doc, key, p.doc, p.anchor)
                    least[found >= 0] = home[found[found >= 0]]
                    if len(key2):
                        found = _match(doc2, key2, p.doc, p.hashes(np.arange(len(p.start)))[0])
                        least[found >= 0] = np.minimum(least[found >= 0], home2[found[found >= 0]])
                    _tile(p, least, tiles)
                raw = data.tobytes()
                texts = [raw[offsets[i] : offsets[i + 1]].split() for i in range(stop - row)]
                automaton = _compile(tiles) if tiles else None
                for i, words in enumerate(texts):
                    removed = _occurrences(automaton, words, ids[row + i], window) if automaton is not None and len(words) >= window else None
                    out.append(build(words, removed, raw[offsets[i] : offsets[i + 1]]))
                yield _columns(batch.slice(row, stop - row), out, carry)

    return run


def _tile(p: Passages, least: np.ndarray, tiles: dict[str, int]) -> None:
    """Cut every run of confirmed windows into tiles of one window each that cover the run's words."""
    on = np.flatnonzero(least < np.iinfo(np.int64).max)
    if not len(on):
        return
    cut = np.flatnonzero((np.diff(p.start[on]) != 1) | (np.diff(p.doc[on]) != 0)) + 1
    raw = p.data.tobytes()
    w = p.words
    for run in np.split(on, cut):
        picks = [*run[:: p.window], run[-1]]
        for i in picks:
            s = p.start[i]
            text = b" ".join(raw[w.start[s] : w.end[s + p.window - 1]].split()).decode("utf-8", errors="surrogateescape")
            tiles[text] = min(int(least[i]), tiles.get(text, int(least[i])))


def _compile(tiles: dict[str, int]):
    automaton = ahocorasick.Automaton()
    for text, home in tiles.items():
        automaton.add_word(f" {text} ", home)
    automaton.make_automaton()
    return automaton


def _occurrences(automaton, words: list[bytes], doc_id, window: int) -> np.ndarray | None:
    """Flags of the words covered by tiles that start in a document with a smaller id."""
    line = " " + b" ".join(words).decode("utf-8", errors="surrogateescape") + " "
    removed = None
    ends = None
    for end, home in automaton.iter(line):
        if home < doc_id:
            if removed is None:
                removed = np.zeros(len(words), dtype=bool)
                ends = np.cumsum(np.fromiter(map(len, line[1:-1].split(" ")), dtype=np.int64, count=len(words)) + 1)  # place of the space after each word
            last = int(np.searchsorted(ends, end))
            removed[last - window + 1 : last + 1] = True
    return removed


def _columns(batch: pa.RecordBatch, out: list[tuple], carry: int | None) -> pa.RecordBatch:
    n_words, n_removed, kept = zip(*out, strict=True) if out else ((), (), ())
    arrays = [batch.column(1), pa.array(n_words, type=pa.int64()), pa.array(n_removed, type=pa.int64()), pa.array(kept, type=pa.binary())]
    names = ["doc_id", "n_words", "n_removed", "kept"]
    if carry is not None:
        arrays, names = [*arrays, batch.column(carry)], [*names, batch.schema.names[carry]]
    return pa.RecordBatch.from_arrays(arrays, names)


def _kept_text(words: list[bytes], removed: np.ndarray | None, raw: bytes) -> tuple[int, int, bytes]:
    """Text after removal: unchanged if nothing was removed, else the kept words joined by one space."""
    if removed is None:
        return len(words), 0, raw
    return len(words), int(removed.sum()), b" ".join(x for x, gone in zip(words, removed.tolist(), strict=True) if not gone)


def _kept_digest(words: list[bytes], removed: np.ndarray | None, raw: bytes) -> tuple[int, int, bytes]:
    kept = words if removed is None else [x for x, gone in zip(words, removed.tolist(), strict=True) if not gone]
    return len(words), 0 if removed is None else int(removed.sum()), hashlib.sha256(b" ".join(kept)).hexdigest().encode()


def _identified(docs: DataFrame, *rest) -> DataFrame:
    return docs.select("text", F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"), *rest)


def _recurring(docs: DataFrame, window: int, anchor: int) -> DataFrame:
    """docs(text, doc_id, ...) with `plain` (unambiguous recurring anchors) and `single` (recurring windows of the others), each with its least id.

    Ids are never null here and the windows are made from all columns, so both reads of the texts by id are one shuffle.
    """
    spans = docs.filter(F.col("doc_id") != NO_ID).select("text", "doc_id").mapInArrow(lean(_span_rows(window, anchor)), "anchor long, span long, doc_id long")
    anchors = spans.groupBy("anchor").agg(F.min("doc_id").alias("home"), F.max("doc_id").alias("last"), F.min("span").alias("least"), F.max("span").alias("most"))
    anchors = anchors.filter(F.col("home") < F.col("last")).select("anchor", "home", (F.col("least") != F.col("most")).alias("mixed"))
    own = spans.select("anchor", "doc_id").join(anchors, "anchor").filter(F.col("mixed") | (F.col("doc_id") > F.col("home")))
    entry = F.struct(F.col("anchor").alias("key"), F.col("home"))
    per_doc = own.groupBy("doc_id").agg(F.collect_set(F.when(~F.col("mixed"), entry)).alias("plain"), F.collect_set(F.when(F.col("mixed"), entry)).alias("mixed"))
    listed = docs.join(per_doc, "doc_id", "left").select("text", "doc_id", "mixed", "plain", *[c for c in docs.columns if c not in ("text", "doc_id")])
    windows = listed.filter(F.size("mixed") > 0).mapInArrow(lean(_window_rows(window, anchor)), "a long, b long, doc_id long")
    homes = windows.groupBy("a", "b").agg(F.min("doc_id").alias("home"), F.max("doc_id").alias("last")).filter(F.col("home") < F.col("last")).select(F.col("a").alias("a_"), F.col("b").alias("b_"), "home")
    # joined by one half of the hash alone: both sides are shuffled for the join then, and a hot window can be split
    same = (F.col("a") == F.col("a_")) & (F.col("b").bitwiseXOR(F.col("b_")) == 0) & (F.col("doc_id") > F.col("home"))
    matched = windows.join(homes, same)
    single = matched.groupBy("doc_id").agg(F.collect_set(F.struct(F.col("a").alias("key"), F.col("home"))).alias("single"))
    return listed.drop("mixed").join(single, "doc_id", "left")


def dedup(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, digest: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, kept for every row of docs(doc_id, text).

    kept is the text (or, with `digest`, the SHA-256 of the kept words joined by one
    space, in hex): unchanged if nothing is removed.  A null text has no words.  Rows without an id are
    neither searched nor searched for.  Rows that share an id never count against each other.
    """
    listed = _recurring(_identified(docs), window, anchor).select("text", "doc_id", "plain", "single")
    found = listed.mapInArrow(lean(_locate(window, anchor, _kept_digest if digest else _kept_text)), "doc_id long, n_words long, n_removed long, kept binary")
    return found.withColumn("doc_id", F.when(F.col("doc_id") != NO_ID, F.col("doc_id"))).withColumn("kept", F.col("kept").cast("string"))


def op1_substring_dedup(spark, sf_dir: str) -> DataFrame:
    return dedup(table(spark, sf_dir, "documents"), digest=True).withColumnRenamed("kept", "kept_sha256")


def stage_substring_dedup(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """docs with repeated passages cut from their texts; n_chars follows the text.  A text that loses all its words is dropped.

    The other columns travel with the text, so repeated and missing ids do no harm.
    """
    rest = [c for c in docs.columns if c not in ("text", "doc_id")]
    own_id, no_text = free_names(rest, "id_", "no_text_")
    carried = F.struct(*[F.col(c).alias(c) for c in rest], F.col("doc_id").alias(own_id), F.col("text").isNull().alias(no_text)).alias("rest_")
    listed = _recurring(_identified(docs, carried), WINDOW, ANCHOR).select("text", "doc_id", "plain", "single", "rest_")
    kind = docs.select(carried).schema["rest_"].dataType.simpleString()
    done = listed.mapInArrow(lean(_locate(WINDOW, ANCHOR, _kept_text, carry=4)), f"doc_id long, n_words long, n_removed long, kept binary, rest_ {kind}")
    done = done.filter((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_words")))
    text = F.when(~F.col(f"rest_.{no_text}"), F.col("kept").cast("string"))
    made = {"text": text, "doc_id": F.col(f"rest_.{own_id}"), "n_chars": F.when(F.col("n_removed") > 0, F.length(text).cast(docs.schema["n_chars"].dataType)).otherwise(F.col("rest_.n_chars")) if "n_chars" in rest else None}
    return done.select(*[(made[c] if made.get(c) is not None else F.col(f"rest_.`{c}`")).alias(c) for c in docs.columns])
