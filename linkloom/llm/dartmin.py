"""Near-duplicate detection with DartMinHash.

A document is a weighted set: its shingles of SHINGLE consecutive words, weighted
by how often they occur.  Darts are thrown, by hashing alone, into the region of
every element: the first one of each unit of weight at an exponential rank, further ones at
growing ranks, as long as the rank stays below a limit that gives a document about
COORDINATES * (ln COORDINATES + 3) darts whatever its length.  Every dart belongs to one
coordinate, and each coordinate keeps its earliest dart: two documents agree in a coordinate
with a probability equal to their weighted Jaccard similarity.

Signatures are cut into BANDS of BAND_ROWS coordinates for a banded join:

1. Documents with equal words are one text; its least id stands for it.
2. In every band bucket all texts are held against the bucket's least text (a star, so
   n - 1 pairs, never n^2).  Pairs are verified exactly by their shingles.
3. Connected components of the verified pairs are classes.
4. Buckets that still hold several classes are the ones where a star may have missed a link: there, block
   by block, every text is held against those of other classes.  Pairs are compared in memory (signatures
   first, then exactly, each pair in the first band it shares only) and never become rows; a task gives out
   a link only if it joins what the links it found before did not.

A document's class id is the least document id of its class.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import SpanHash, U64, Words, byte_values, chunks, cut, free_names, lean, mix64, signed, table

SHINGLE = 5
SIMILARITY = 0.8
BANDS = 24
BAND_ROWS = 5
COORDINATES = BANDS * BAND_ROWS
#: Share of agreeing coordinates below which a pair is not looked at further; four standard deviations under SIMILARITY.
SKETCH_LEAST = 0.65
#: Up to so many pairs their ids are sent to the texts, not the texts to the ids.
BROADCAST_PAIRS = 100_000
#: Likewise for rows with a signature.
BROADCAST_SIGNATURES = 10_000
#: A leader's bucket is dealt to so many tasks.
SALTS = 16


def shingles(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, Words]:
    """(text, shingle hash) of all shingles, repeats included; a text of fewer than SHINGLE words is one shingle."""
    w = Words(data, offsets)
    words = SpanHash(byte_values(data))(w.start, w.end)
    spans = SpanHash(words, 1)
    limit = w.limit()
    start = np.arange(len(words))
    whole = limit - w.first[:-1].repeat(np.diff(w.first)) < SHINGLE
    first = start == w.first[:-1].repeat(np.diff(w.first))
    keep = np.where(whole, first, start + SHINGLE <= limit)
    start = start[keep]
    return w.doc()[keep], spans(start, np.minimum(start + SHINGLE, limit[keep])), w


def cells(doc: np.ndarray, shingle: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text, shingle) with the number of occurrences."""
    order = np.lexsort((shingle, doc))
    doc, shingle = doc[order], shingle[order]
    new = np.ones(len(doc), dtype=bool)
    new[1:] = (doc[1:] != doc[:-1]) | (shingle[1:] != shingle[:-1])
    at = np.flatnonzero(new)
    return doc[at], shingle[at], np.diff(np.append(at, len(doc)))


def _uniform(h: np.ndarray) -> np.ndarray:
    return ((h >> U64(11)).astype(np.float64) + 0.5) * 2.0**-53


def signatures(n_texts: int, doc: np.ndarray, shingle: np.ndarray) -> np.ndarray:
    """Signature of each text as (text, coordinate); texts without shingles keep zeros."""
    out = np.zeros((n_texts, COORDINATES), dtype=np.uint64)
    best = np.full((n_texts, COORDINATES), np.inf)
    if not len(doc):
        return out
    d, s, count = cells(doc, shingle)
    # unit m of an element is a region of its own; an element of weight n owns units 0 .. n - 1
    unit_doc = np.repeat(d, count)
    unit = np.arange(len(unit_doc)) - np.repeat(np.cumsum(count) - count, count)
    with np.errstate(over="ignore"):
        region = mix64(np.repeat(s, count) + unit.astype(np.uint64) * U64(0x9E3779B97F4A7C15))
    weight = np.bincount(unit_doc, minlength=n_texts)
    factor = math.log(COORDINATES) + 3
    pending = weight > 0
    while pending.any():
        limit = np.where(pending, COORDINATES * factor / np.maximum(weight, 1), 0.0)
        at, key, rank, number = unit_doc, region, np.zeros(len(unit_doc)), 0
        live = limit[at] > 0
        at, key, rank = at[live], key[live], rank[live]
        while len(at):
            with np.errstate(over="ignore"):
                dart = mix64(key + U64(number + 1) * U64(0xD6E8FEB86659FD93))
            rank = rank - np.log(_uniform(mix64(dart ^ U64(0x5851F42D4C957F2D))))
            live = rank <= limit[at]
            at, key, rank, dart = at[live], key[live], rank[live], dart[live]
            where = at * COORDINATES + (dart % U64(COORDINATES)).astype(np.int64)
            # latest first, so that the earliest dart of each place is written last
            order = np.argsort(-rank, kind="stable")
            where, r, v = where[order], rank[order], dart[order]
            earlier = r < best.ravel()[where]
            where, r, v = where[earlier], r[earlier], v[earlier]
            best.ravel()[where] = r
            out.ravel()[where] = v
            number += 1
        pending = pending & np.isinf(best).any(axis=1)
        factor *= 2
    return out


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row, stop, data, offsets in chunks(batch):
            n = stop - row
            doc, shingle, w = shingles(data, offsets)
            sig = signatures(n, doc, shingle)
            whole = [SpanHash(SpanHash(byte_values(data, i), i)(w.start, w.end), 1 - i)(w.first[:-1], w.first[1:]) for i in (0, 1)]
            key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), (n, BANDS)).copy()
            cube = sig.reshape(n, BANDS, BAND_ROWS)
            with np.errstate(over="ignore"):
                for r in range(BAND_ROWS):
                    key = mix64(key * U64(0x100000001B3) + cube[:, :, r])
            keys = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * BANDS), pa.array(signed(key.ravel())))
            brief = [x.tobytes() for x in (sig >> U64(48)).astype(np.uint16)]
            ids = batch.column(1).slice(row, n)
            yield pa.RecordBatch.from_arrays([ids, pa.array(np.diff(w.first)), pa.array(signed(whole[0])), pa.array(signed(whole[1])), keys, pa.array(brief, type=pa.binary())], ["doc_id", "words", "t1", "t2", "bands", "brief"])


SKETCH = "doc_id long, words long, t1 long, t2 long, bands array<long>, brief binary"


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by (leader, salt): the leader's own text first (kind 0), then the texts held against it."""
    leader, known, size = None, None, 0
    for batch in batches:
        out = []
        lead, kind, ids = batch.column(1).to_numpy(), batch.column(2).to_numpy(), batch.column(3).to_numpy()
        for row, stop, data, offsets in chunks(batch):
            d, s, c = cells(*shingles(data, offsets)[:2])
            at = np.searchsorted(d, np.arange(stop - row + 1))
            for i in range(stop - row):
                own, count = s[at[i] : at[i + 1]], c[at[i] : at[i + 1]]
                if kind[row + i] == 0:
                    leader, known, size = lead[row + i], (own, count), int(count.sum())
                elif leader == lead[row + i] and len(own) and _similar((*known, size), (own, count, int(count.sum()))):
                    out.append((lead[row + i], ids[row + i]))
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], type=pa.int64()), pa.array([x[1] for x in out], type=pa.int64())], ["a", "b"])


def verified(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """Pairs (a, b) of document ids whose texts are similar, by exact weighted Jaccard.

    Every text travels once for each leader it is held against, and a leader's own once for each of its salts.
    """
    salted = pairs.withColumn("salt", F.pmod(F.xxhash64("b"), F.lit(SALTS)))
    members = salted.select(F.col("b").alias("doc_id"), F.col("a").alias("leader"), "salt", F.lit(1).alias("kind"))
    leaders = salted.select(F.col("a").alias("doc_id"), F.col("a").alias("leader"), "salt", F.lit(0).alias("kind")).distinct()
    wanted = members.unionByName(leaders)
    if pairs.count() <= BROADCAST_PAIRS:
        wanted = F.broadcast(wanted)  # at most two rows of 28 bytes a pair; beyond, the texts are shuffled by id
    rows = docs.select("doc_id", "text").join(wanted, "doc_id")
    dealt = rows.repartition("leader", "salt").sortWithinPartitions("leader", "salt", "kind")
    return dealt.select("text", "leader", "kind", "doc_id").mapInArrow(lean(_verify), "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(id, label): the least id of each connected component, for all ends of edges(a, b).

    Labels are lowered to the least of the neighbours' and then to the label's own label, so chains halve with every round.
    """
    both = cut(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = cut(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("label")).withColumnRenamed("a", "id"))
    while True:
        near = both.join(labels, both.b == labels.id).groupBy("a").agg(F.min("label").alias("near"))
        hooked = labels.join(near, labels.id == near.a, "left").select("id", F.least("label", F.coalesce("near", "label")).alias("label"), F.col("label").alias("old"))
        up = hooked.select(F.col("id").alias("up"), F.col("label").alias("over"))
        jumped = cut(hooked.join(up, hooked.label == up.up, "left").select("id", F.least("label", F.coalesce("over", "label")).alias("label"), "old"))
        labels = jumped.select("id", "label")
        if not jumped.filter(F.col("label") != F.col("old")).limit(1).count():
            return labels


def _similar(a: tuple[np.ndarray, np.ndarray, int], b: tuple[np.ndarray, np.ndarray, int]) -> bool:
    """Weighted Jaccard of two (sorted shingles, counts, total) against SIMILARITY."""
    if min(a[2], b[2]) < SIMILARITY * max(a[2], b[2]) - 1e-9:
        return False
    place = np.minimum(np.searchsorted(a[0], b[0]), len(a[0]) - 1)
    shared = int(np.minimum(np.where(a[0][place] == b[0], a[1][place], 0), b[1]).sum())
    return shared >= SIMILARITY * (a[2] + b[2] - shared) - 1e-9


class _Heads:
    """The texts of a block so far, in arrays that grow by doubling."""

    def __init__(self):
        self.n, self.own = 0, []
        self.ids, self.labels = np.zeros(64, dtype=np.int64), np.zeros(64, dtype=np.int64)
        self.sketches, self.keys = np.zeros((64, COORDINATES), dtype=np.uint16), np.zeros((64, BANDS), dtype=np.int64)

    def add(self, doc: int, label: int, sketch: np.ndarray, keys: np.ndarray, own: tuple[np.ndarray, np.ndarray, int]) -> None:
        if self.n == len(self.ids):
            self.ids, self.labels, self.sketches, self.keys = (np.concatenate((x, np.zeros_like(x))) for x in (self.ids, self.labels, self.sketches, self.keys))
        self.ids[self.n], self.labels[self.n], self.sketches[self.n], self.keys[self.n] = doc, label, sketch, keys
        self.own.append(own)
        self.n += 1

    def alike(self, label: int, sketch: np.ndarray, keys: np.ndarray, band: int) -> np.ndarray:
        """Places of texts of other classes that may be similar and share no band before this one."""
        other = np.flatnonzero(self.labels[: self.n] != label)
        other = other[(self.sketches[other] == sketch).sum(axis=1) >= SKETCH_LEAST * COORDINATES]
        return other[~(self.keys[other, :band] == keys[:band]).any(axis=1)] if band else other


def _cross(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links between classes of a bucket. Rows come by (key, block, slice, kind) as `meetings` deals them."""
    block: tuple | None = None
    heads = _Heads()
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for batch in batches:
        out = []
        key, part, piece, kind, band, doc, label = (batch.column(i).to_numpy() for i in range(1, 8))
        bands = batch.column(8).flatten().to_numpy().reshape(-1, BANDS)
        brief = batch.column(9)
        for row, stop, data, offsets in chunks(batch):
            d, s, c = cells(*shingles(data, offsets)[:2])
            at = np.searchsorted(d, np.arange(stop - row + 1))
            for i in range(row, stop):
                if block != (key[i], part[i], piece[i]):
                    block, heads = (key[i], part[i], piece[i]), _Heads()
                x = slice(at[i - row], at[i - row + 1])
                own = (s[x], c[x], int(c[x].sum()))
                sketch = np.frombuffer(brief[i].as_buffer(), dtype=np.uint16)
                if kind[i] == 1 or part[i] == piece[i]:
                    for h in heads.alike(label[i], sketch, bands[i], band[i]):
                        u, v = root(int(heads.labels[h])), root(int(label[i]))
                        if u != v and _similar(heads.own[h], own):
                            parent[max(u, v)] = min(u, v)
                            out.append((min(int(heads.ids[h]), int(doc[i])), max(int(heads.ids[h]), int(doc[i]))))
                if kind[i] == 0:
                    heads.add(doc[i], label[i], sketch, bands[i], own)
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], type=pa.int64()), pa.array([x[1] for x in out], type=pa.int64())], ["a", "b"])


#: Expected words, and texts, in a block of a bucket: a task holds the shingles and signatures of one block.
BLOCK_WORDS = 1_000_000
BLOCK_TEXTS = 8192


def meetings(left: DataFrame) -> DataFrame:
    """(key, band, block, slice, kind, rep): where the texts of left(key, band, rep, n, words_) are held against each other.

    The texts of a block meet among themselves, one row each (slice = block, kind 0); blocks of a bucket that has several
    meet in pairs, the texts of the one (kind 0) before those of the other (kind 1). A text has as many rows as its bucket has blocks.
    """
    blocks = F.ceil(F.greatest(F.col("words_") / F.lit(BLOCK_WORDS), F.col("n") / F.lit(BLOCK_TEXTS))).cast("long")
    zero = F.lit(0).cast("long")
    split = left.withColumn("own", F.pmod(F.xxhash64("rep"), blocks)).withColumn("last", blocks - 1)
    heads = split.select("key", "band", F.col("own").alias("block"), F.explode(F.sequence("own", "last")).alias("slice"), F.lit(0).alias("kind"), "rep")
    passers = split.filter("own > 0").select("key", "band", F.explode(F.sequence(zero, F.col("own") - 1)).alias("block"), F.col("own").alias("slice"), F.lit(1).alias("kind"), "rep")
    return heads.unionByName(passers)


def classes(docs: DataFrame) -> DataFrame:
    """(doc_id, class_id, n_class): one row for every row of docs(doc_id, text).

    Texts with equal words are always together.  Texts without a word, and rows without an id, are classes of
    their own.  Rows that share an id share a class only if their texts do; the id of a
    class is its least document id.
    """
    plain = docs.select("text", F.col("doc_id").cast("long").alias("doc_id"))
    sketches = cut(plain.mapInArrow(lean(_sketch), SKETCH))
    known = sketches.filter((F.col("words") > 0) & F.col("doc_id").isNotNull())
    texts = cut(known.groupBy("t1", "t2").agg(F.min("doc_id").alias("rep"), F.count("*").alias("rows_"), F.max("words").alias("words"), F.min(F.struct("doc_id", "bands", "brief")).alias("s")).select("rep", "rows_", "t1", "t2", "words", "s.bands", "s.brief"))
    # a document id may stand for several texts if ids repeat; its pairs are then judged by every text of that id
    banded = texts.select("rep", "words", F.posexplode("bands").alias("band", "key"))
    buckets = banded.groupBy("key").agg(F.min("rep").alias("leader"), F.count("*").alias("n"), F.sum("words").alias("words_")).filter(F.col("n") > 1)
    crowded = cut(banded.join(buckets, "key").select("key", "band", "rep", "leader", "n", "words_"))
    star = cut(crowded.filter(F.col("rep") != F.col("leader")).select(F.col("leader").alias("a"), F.col("rep").alias("b")).distinct())
    source = plain.filter(F.col("doc_id").isNotNull())
    edges = cut(verified(star, source))
    labels = components(edges)
    # buckets with several classes left
    of = labels.withColumnRenamed("id", "rep")
    placed = crowded.join(of, "rep", "left").withColumn("label", F.coalesce("label", "rep"))
    open_keys = placed.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter(F.col("low") < F.col("high")).select("key")
    left = cut(placed.join(open_keys, "key").filter(F.col("n") > 2).select("key", "band", "rep", "label", "n", "words_"))
    if left.limit(1).count():
        wanted = left.select("rep", "label").distinct().join(texts.select("rep", "bands", "brief"), "rep")
        if left.count() <= BROADCAST_SIGNATURES:
            wanted = F.broadcast(wanted)  # rows of half a kilobyte
        held = source.join(wanted, F.col("doc_id") == F.col("rep")).select("rep", "label", "bands", "brief", "text")
        dealt = meetings(left).join(held, "rep").repartition("key", "block", "slice").sortWithinPartitions("key", "block", "slice", "kind")
        links = cut(dealt.select("text", "key", "block", "slice", "kind", "band", "rep", "label", "bands", "brief").mapInArrow(lean(_cross), "a long, b long"))
        if links.limit(1).count():
            labels = components(edges.unionByName(links))
    final = texts.select("t1", "t2", "rep", "rows_").join(labels.withColumnRenamed("id", "rep"), "rep", "left").withColumn("class_id", F.coalesce("label", "rep"))
    # joined by the complement of the class: both sides are shuffled for this join then, and a large class can be split
    key = F.bitwise_not("class_id")
    size = final.groupBy("class_id").agg(F.sum("rows_").alias("n")).select(key.alias("key"), "n")
    final = final.withColumn("key", key).join(size, "key").select("t1", "t2", "class_id", "n")
    joined = sketches.select("doc_id", "words", "t1", "t2").join(final, ["t1", "t2"], "left")
    placed = (F.col("words") > 0) & F.col("doc_id").isNotNull()
    return joined.select("doc_id", F.when(placed, F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id"), F.when(placed, F.col("n")).otherwise(F.lit(1)).cast("long").alias("n_class"))


def op9_minhash_dedup(spark, sf_dir: str) -> DataFrame:
    return classes(table(spark, sf_dir, "documents"))


def stage_near_dedup(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows of docs whose id is the least of their class; of rows that share id and words, one stays.

    Rows without an id stay.  Different texts that share an id are all kept, even if they are alike.
    """
    row, words = free_names(docs.columns, "row_", "words_")
    keep = classes(docs).filter(F.col("doc_id") == F.col("class_id")).select("doc_id").distinct()
    kept = docs.join(keep, "doc_id", "left_semi").withColumn(words, F.md5(F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+", " ")).cast("binary")))
    first = Window.partitionBy("doc_id", words).orderBy(F.xxhash64("text"))
    one = kept.withColumn(row, F.row_number().over(first)).filter(F.col(row) == 1).drop(row, words)
    return one.unionByName(docs.filter(F.col("doc_id").isNull())).select(*docs.columns)
