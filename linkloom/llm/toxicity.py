"""Toxicity by a factorization machine over hashed terms.

A text is a vector x over its terms (lower-cased words, and the beginnings of long
ones), each known by a 64-bit hash; x[i] = log2(1 + occurrences).  The score is a
logistic function of

    bias + sum_i w[i] x[i] + 1/2 * sum_f ((sum_i v[i,f] x[i])^2 - sum_i (v[i,f] x[i])^2),

so a pair of terms, such as an insult and a group it is aimed at, can weigh more
than the two alone.  Linear weights follow a proximal online rule whose L1 part
leaves all uninformative terms at exactly 0: a long clean text gathers no noise.
Factors are learned only for terms whose linear weight is in use.

The machine is fitted on a bounded sample of labelled rows (SAMPLE_PER_CLASS, the rows
with the least hash of their id); every text is scored whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SpanHash, U64, Words, byte_values, chunks, crc_mod, cut, lean, opened, share, table

#: Labelled rows of each class that the machine is fitted on, at most.
SAMPLE_PER_CLASS = 1500
FACTORS = 8
EPOCHS = 16
BATCH = 256
#: A longer word counts also by its beginnings of these lengths.
PREFIX_BYTES = (4, 5, 6, 7)
#: A term must occur in so many of the fitted texts.
LEAST_TEXTS = 5
L2, RATE, FACTOR_RATE = 0.1, 0.3, 0.03
#: Strengths of L1 that are tried, the folds of the fitted rows they are tried on, and the epochs of a trial.
L1 = (3.0, 6.0, 12.0, 24.0, 40.0)
FOLDS, TRIAL_EPOCHS = 3, 5
#: Terms that are known, at most: those in most of the fitted texts.
MOST_TERMS = 1 << 18
FILTER_BITS = 22

_TERM_BYTE = np.zeros(256, dtype=bool)
_TERM_BYTE[48:58] = _TERM_BYTE[65:91] = _TERM_BYTE[97:123] = _TERM_BYTE[128:] = True
_TERM_BYTE[39] = True


def terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text index, term hash) of all terms, repeats included."""
    w = Words(data, offsets, _TERM_BYTE)
    spans = SpanHash(byte_values(data, lower=True))
    doc = w.doc()
    docs, found = [doc], [spans(w.start, w.end)]
    for size in PREFIX_BYTES:
        long = np.flatnonzero(w.end - w.start > size)
        with np.errstate(over="ignore"):
            found.append(spans(w.start[long], w.start[long] + size) * U64(0x9E3779B97F4A7C15) + U64(1))
        docs.append(doc[long])
    return np.concatenate(docs), np.concatenate(found)


def weighted(doc: np.ndarray, term: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text, term) with the value of the term in the text."""
    order = np.lexsort((term, doc))
    doc, term = doc[order], term[order]
    keep = np.ones(len(doc), dtype=bool)
    keep[1:] = (doc[1:] != doc[:-1]) | (term[1:] != term[:-1])
    at = np.flatnonzero(keep)
    return doc[at], term[at], np.log2(1.0 + np.diff(np.append(at, len(doc)))).astype(np.float32)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


@dataclass
class FactorizationMachine:
    hashes: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.uint64))  # sorted
    w: np.ndarray = field(default_factory=lambda: np.zeros(0))
    v: np.ndarray = field(default_factory=lambda: np.zeros((0, FACTORS)))
    bias: float = -10.0

    def logits(self, n_texts: int, doc: np.ndarray, at: np.ndarray, value: np.ndarray) -> np.ndarray:
        """doc, at, value: distinct (text, index of a known term) and the term's value."""
        out = np.bincount(doc, weights=self.w[at] * value, minlength=n_texts) + self.bias
        for f in range(self.v.shape[1]):
            x = self.v[at, f] * value
            out += 0.5 * (np.bincount(doc, weights=x, minlength=n_texts) ** 2 - np.bincount(doc, weights=x * x, minlength=n_texts))
        return out

    def prepared(self) -> tuple[FactorizationMachine, np.ndarray]:
        known = np.zeros(1 << FILTER_BITS, dtype=bool)
        known[(self.hashes >> U64(64 - FILTER_BITS)).astype(np.int64)] = True
        return self, known

    def score(self, data: np.ndarray, offsets: np.ndarray, known: np.ndarray) -> np.ndarray:
        n = len(offsets) - 1
        if not len(self.hashes):
            return np.full(n, _sigmoid(np.array(self.bias)))
        doc, term = terms(data, offsets)
        hit = known[(term >> U64(64 - FILTER_BITS)).astype(np.int64)]
        doc, term = doc[hit], term[hit]
        at = np.minimum(np.searchsorted(self.hashes, term), len(self.hashes) - 1)
        same = self.hashes[at] == term
        return _sigmoid(self.logits(n, *weighted(doc[same], at[same])))


def fit(texts: list[np.ndarray], values: list[np.ndarray], label: np.ndarray, prior: float, seed: int = 7) -> FactorizationMachine:
    """texts, values: the distinct term hashes of each text and their values.  prior: share of label 1 among all labelled rows.

    The strength of L1 is the one with the least logistic loss on folds of these rows (both classes weigh alike); the strongest of equals.
    """
    fold = np.random.default_rng(seed).permutation(len(texts)) % FOLDS
    loss = dict.fromkeys(L1, 0.0)
    for k in range(FOLDS):
        inside, outside = np.flatnonzero(fold != k), np.flatnonzero(fold == k)
        if len(set(label[inside])) < 2 or len(set(label[outside])) < 2:
            continue
        weight = 0.5 / np.where(label[outside] == 1, label[outside].sum(), (1 - label[outside]).sum())
        sizes = [len(texts[i]) for i in outside]
        doc, term, value = np.repeat(np.arange(len(outside)), sizes), np.concatenate([texts[i] for i in outside]), np.concatenate([values[i] for i in outside])
        for l1 in L1:
            m = _fitted([texts[i] for i in inside], [values[i] for i in inside], label[inside], float(label[inside].mean()), l1, TRIAL_EPOCHS, seed)
            if len(m.hashes):
                at = np.minimum(np.searchsorted(m.hashes, term), len(m.hashes) - 1)
                same = m.hashes[at] == term
                z = m.logits(len(outside), doc[same], at[same], value[same])
            else:
                z = np.full(len(outside), m.bias)
            loss[l1] += float((weight * np.logaddexp(0, np.where(label[outside] == 1, -z, z))).sum())
    best = min(L1, key=lambda x: (round(loss[x], 9), -x))
    return _fitted(texts, values, label, prior, best, EPOCHS, seed)


def _fitted(texts: list[np.ndarray], values: list[np.ndarray], label: np.ndarray, prior: float, l1: float, epochs: int, seed: int) -> FactorizationMachine:
    if not label.any() or label.all():
        return FactorizationMachine(bias=10.0 if len(label) and label.all() else -10.0)
    every, count = np.unique(np.concatenate(texts), return_counts=True)
    vocabulary = every[count >= LEAST_TEXTS]
    if not len(vocabulary):
        return FactorizationMachine(bias=float(np.log(prior / (1 - prior))))
    rows, weights = [], []
    for t, x in zip(texts, values, strict=True):
        at = np.minimum(np.searchsorted(vocabulary, t), len(vocabulary) - 1)
        known = vocabulary[at] == t
        rows.append(at[known])
        weights.append(x[known])
    rng = np.random.default_rng(seed)
    n_terms = len(vocabulary)
    z, n, w = np.zeros(n_terms), np.zeros(n_terms), np.zeros(n_terms)
    v = rng.normal(0, 0.01, (n_terms, FACTORS))
    g2, bias, bias_n = np.full((n_terms, FACTORS), 1e-4), 0.0, 1.0
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for begin in range(0, len(order), BATCH):
            part = order[begin : begin + BATCH]
            sizes = np.array([len(rows[i]) for i in part])
            at = np.concatenate([rows[i] for i in part])
            value = np.concatenate([weights[i] for i in part])
            doc = np.repeat(np.arange(len(part)), sizes)
            live = w[at] != 0
            vx = np.where(live[:, None], v[at] * value[:, None], 0.0)
            total = np.zeros((len(part), FACTORS))
            for f in range(FACTORS):
                total[:, f] = np.bincount(doc, weights=vx[:, f], minlength=len(part))
            square = np.bincount(doc, weights=(vx * vx).sum(axis=1), minlength=len(part))
            logit = bias + np.bincount(doc, weights=w[at] * value, minlength=len(part)) + 0.5 * ((total * total).sum(axis=1) - square)
            error = _sigmoid(logit) - label[part]
            step = error.sum() / len(part)
            bias_n += step * step
            bias -= RATE * step / np.sqrt(bias_n)
            # linear weights: follow the regularised leader with L1
            used, place = np.unique(at, return_inverse=True)
            g = np.bincount(place, weights=error[doc] * value, minlength=len(used))
            sigma = (np.sqrt(n[used] + g * g) - np.sqrt(n[used])) / RATE
            z[used] += g - sigma * w[used]
            n[used] += g * g
            w[used] = np.where(np.abs(z[used]) <= l1, 0.0, -(z[used] - np.sign(z[used]) * l1) / ((1 + np.sqrt(n[used])) / RATE + L2))
            # factors of the terms in use
            on = np.flatnonzero(live)
            if len(on):
                grad = (error[doc[on]] * value[on])[:, None] * (total[doc[on]] - vx[on]) + 1e-3 * v[at[on]]
                mine, where = np.unique(at[on], return_inverse=True)
                summed = np.zeros((len(mine), FACTORS))
                for f in range(FACTORS):
                    summed[:, f] = np.bincount(where, weights=grad[:, f], minlength=len(mine))
                g2[mine] += summed * summed
                v[mine] -= FACTOR_RATE * summed / np.sqrt(g2[mine])
    keep = w != 0
    positive = label.mean()
    shift = np.log(prior / (1 - prior)) - np.log(positive / (1 - positive)) if 0 < prior < 1 else 0.0
    return FactorizationMachine(vocabulary[keep], w[keep], v[keep], float(bias + shift))


def _term_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct terms of each text."""
    for batch in batches:
        for row, stop, data, offsets in chunks(batch):
            doc, term, _ = weighted(*terms(data, offsets))
            ends = np.searchsorted(doc, np.arange(stop - row + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array(ends), pa.array(term.view(np.int64)))], ["terms"])


def _known_terms(shared):
    """Of each text its terms in the vocabulary, and their values."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = opened(shared)
        for batch in batches:
            for row, stop, data, offsets in chunks(batch):
                doc, term, value = weighted(*terms(data, offsets))
                if len(vocabulary):
                    known = vocabulary[np.minimum(np.searchsorted(vocabulary, term), len(vocabulary) - 1)] == term
                    doc, term, value = doc[known], term[known], value[known]
                else:
                    doc, term, value = doc[:0], term[:0], value[:0]
                ends = np.searchsorted(doc, np.arange(stop - row + 1))
                part = lambda x, ends=ends: pa.array([x[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)], type=pa.binary())
                yield pa.RecordBatch.from_arrays([*[batch.column(c).slice(row, stop - row) for c in (1, 2)], part(term), part(value)], ["doc_id", "label", "terms", "value"])

    return run


def train(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> FactorizationMachine:
    """docs(doc_id, text), labels(doc_id, label): rows without an id or a label teach nothing; an id with
    several labels counts once, as 1 if any of them is; of the texts of a repeated id the one with the least hash teaches.

    What reaches the driver is bounded: at most 2 * per_class rows, of each its terms among MOST_TERMS.
    """
    spark = docs.sparkSession
    known = labels.filter(F.col("doc_id").isNotNull() & F.col("label").isNotNull()).groupBy("doc_id").agg(F.max("label").cast("int").alias("label"))
    facts = known.agg(F.avg("label").alias("p"), F.count("*").alias("n")).first()
    if not facts["n"]:
        return FactorizationMachine()
    # the least hashes of each class: every task sends its own least ones only
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    sample = known.filter("label = 1").orderBy(*order).limit(per_class).unionByName(known.filter("label <> 1").orderBy(*order).limit(per_class))
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(sample), "doc_id")  # at most 2 * per_class rows are sent
    chosen = cut(found.groupBy("doc_id", "label").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text")))
    counts = chosen.select("text").mapInArrow(lean(_term_lists), "terms array<long>").select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("n")).filter(F.col("n") >= LEAST_TEXTS)
    vocabulary = np.sort(counts.orderBy(F.desc("n"), "term").limit(MOST_TERMS).select("term").toArrow()["term"].to_numpy().view(np.uint64))
    rows = chosen.select("text", "doc_id", "label").mapInArrow(lean(_known_terms(share(spark, vocabulary))), "doc_id long, label int, terms binary, value binary").toArrow()
    if not rows.num_rows:
        return FactorizationMachine()
    ids = np.argsort(rows["doc_id"].to_numpy(), kind="stable")
    texts, values = [np.frombuffer(rows["terms"][i].as_buffer(), dtype=np.uint64) for i in ids], [np.frombuffer(rows["value"][i].as_buffer(), dtype=np.float32) for i in ids]
    return fit(texts, values, rows["label"].to_numpy()[ids].astype(np.float64), min(max(float(facts["p"]), 1e-4), 1 - 1e-4))


SCORED = "doc_id long, held_out boolean, score double, predicted int"


def _score(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, known = opened(shared).prepared()
        for batch in batches:
            score = [model.score(data, offsets, known) for _, _, data, offsets in chunks(batch)]
            s = np.concatenate(score) if score else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), pa.array(s), pa.array((s >= 0.5).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    return run


def score(docs: DataFrame, model: FactorizationMachine, held_out=None) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of docs(doc_id, text); a null or empty text gets the score of the bias alone.

    Repeated rows get equal scores; other columns of docs play no part.
    """
    shared = share(docs.sparkSession, model)  # bounded by the terms of the sample
    plain = docs.select("text", F.col("doc_id").cast("long").alias("doc_id"), (F.lit(False) if held_out is None else held_out).alias("held_out"))
    return plain.mapInArrow(lean(_score(shared)), SCORED)


def toxic_labels(spark, sf_dir: str) -> DataFrame:
    """Labels that may be learned from."""
    return table(spark, sf_dir, "labels").filter(crc_mod("doc_id", 5) != 0).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").alias("label"))


def op6_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, train(docs, toxic_labels(spark, sf_dir)), crc_mod("doc_id", 5) == 0)


def stage_toxicity(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows of docs whose text is not found toxic; all columns stay as they are.

    The text is scored where the row lies, so nothing is joined back and repeated or null ids do no harm.
    """
    shared = share(spark, train(table(spark, sf_dir, "documents"), toxic_labels(spark, sf_dir)))
    text_at = docs.columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, known = opened(shared).prepared()
        for batch in batches:
            s = [model.score(data, offsets, known) for _, _, data, offsets in chunks(batch, batch.schema.names[text_at])]
            yield batch.filter(pa.array(np.concatenate(s) < 0.5 if s else np.zeros(0, dtype=bool)))

    return docs.mapInArrow(lean(keep), docs.schema)
