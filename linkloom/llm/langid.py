"""Language identification of mixed-language text.

The script of a word (from its code-point ranges) narrows the languages to those
that were seen to use it.  Each word gets a log score per candidate from three
hashed counts: the word itself, its first and its last bytes.  A Viterbi pass
over the words of a text, with a fixed penalty for switching, labels spans; all
texts of a chunk advance together, one word per step, so the pass is vectorised
over texts.  A text's language is the one with the most labelled bytes.

Counts are gathered over every labelled text.  The tables are of fixed size for
a given set of languages, whatever the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SpanHash, U64, Words, byte_values, chunks, crc_mod, lean, opened, share, table

#: log2 of the number of slots for whole words, beginnings and endings.
BITS = (17, 14, 14)
AFFIX_BYTES = 4
SMOOTHING = 0.5
SWITCH_PENALTY = 8.0
#: A script belongs to a language if at least this share of the language's words is in it.
SCRIPT_SHARE = 0.01
SCRIPTS = 12
#: Bytes of text that are labelled at once: texts advance together, so more of them share a step.
LABELLED = 1 << 20


#: (first code point, last, script): ranges of the Unicode code charts; 0 is Latin and anything common, higher ones win in a word.
RANGES = [
    (0x370, 0x3FF, 1), (0x400, 0x52F, 2), (0x530, 0x58F, 3), (0x590, 0x5FF, 4), (0x600, 0x6FF, 5), (0x750, 0x77F, 5), (0x8A0, 0x8FF, 5), (0x900, 0x97F, 6), (0x980, 0xDFF, 7), (0xE00, 0xEFF, 8), (0x1100, 0x11FF, 11),
    (0x1F00, 0x1FFF, 1), (0x2DE0, 0x2DFF, 2), (0x3040, 0x30FF, 9), (0x3130, 0x318F, 11), (0x31F0, 0x31FF, 9), (0x3400, 0x4DBF, 10), (0x4E00, 0x9FFF, 10), (0xA640, 0xA69F, 2), (0xA960, 0xA97F, 11), (0xAC00, 0xD7FF, 11),
    (0xF900, 0xFAFF, 10), (0xFB1D, 0xFB4F, 4), (0xFB50, 0xFDFF, 5), (0xFE70, 0xFEFF, 5), (0xFF66, 0xFF9D, 9), (0x1B000, 0x1B16F, 9), (0x20000, 0x323AF, 10),
]
_FIRST, _LAST, _OF = (np.array(x) for x in zip(*RANGES, strict=True))


def script_bytes(data: np.ndarray) -> np.ndarray:
    """The script of each character, at its first byte; 0 at all other bytes."""
    out = np.zeros(len(data), dtype=np.uint8)
    lead = np.flatnonzero(data >= 0xC0)
    if len(lead):
        padded = np.concatenate((data, np.zeros(3, dtype=np.uint8))).astype(np.int64)
        b = [padded[lead + k] for k in range(4)]
        low = [x & 0x3F for x in b]
        two, three, four = (b[0] & 0x1F) << 6 | low[1], (b[0] & 0x0F) << 12 | low[1] << 6 | low[2], (b[0] & 0x07) << 18 | low[1] << 12 | low[2] << 6 | low[3]
        point = np.where(b[0] < 0xE0, two, np.where(b[0] < 0xF0, three, four))
        at = np.searchsorted(_FIRST, point, side="right") - 1
        out[lead] = np.where((at >= 0) & (point <= _LAST[at]), _OF[at], 0)
    return out


_LETTER = np.zeros(256, dtype=bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True


class Features:
    """Per word of a chunk: three slots, the script, and whether it has a letter."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        w = self.words = Words(data, offsets)
        spans = SpanHash(byte_values(data, lower=True))
        whole = spans(w.start, w.end)
        head = spans(w.start, np.minimum(w.end, w.start + AFFIX_BYTES))
        tail = spans(np.maximum(w.start, w.end - AFFIX_BYTES), w.end)
        self.slots = [(h >> U64(64 - b)).astype(np.int64) for h, b in zip((whole, head, tail), BITS, strict=True)]
        if len(w.start):
            # words hold no white space, so a reduction from one start to the next sees the word's bytes and spaces only
            self.script = np.maximum.reduceat(script_bytes(data), w.start)
            self.letters = np.logical_or.reduceat(_LETTER[data], w.start)
        else:
            self.script, self.letters = np.zeros(0, dtype=np.uint8), np.zeros(0, dtype=bool)


@dataclass
class LanguageModel:
    languages: list[str]
    scores: list[np.ndarray]  # per kind of feature: slot, language
    allowed: np.ndarray  # script, language

    def word_scores(self, f: Features) -> np.ndarray:
        s = self.scores[0][f.slots[0]] + self.scores[1][f.slots[1]] + self.scores[2][f.slots[2]]
        s = np.where(self.allowed[f.script], s, s.min(axis=1, keepdims=True, initial=0) - 20.0)
        s[~f.letters] = 0.0
        return s


def constant(scores: np.ndarray, first: np.ndarray, penalty: float) -> np.ndarray:
    """The label of each text whose best path is known to keep one label, else -1; no text is empty.

    Against the label with the largest sum, every stretch of another label must gain less than the penalty, and a beginning and an end
    together as well: then each stretch of a path that leaves the label costs more than it gains, also where a path never takes it.
    """
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    at = first[:-1]
    label = np.add.reduceat(scores, at, axis=0, dtype=np.float64).argmax(axis=1)
    gain = np.zeros((len(scores) + 1, scores.shape[1]))
    np.cumsum(scores - scores[np.arange(len(scores)), label[doc]][:, None], axis=0, dtype=np.float64, out=gain[1:])
    before, after = gain[:-1], gain[1:]
    # every text lies below all earlier ones, so the least value so far is its own
    shift = (doc * (gain.max() - gain.min() + 1))[:, None]
    stretch = np.maximum.reduceat((after - (np.minimum.accumulate(before - shift, axis=0) + shift)).max(axis=1), at)
    begin = np.maximum.reduceat((after - before[at][doc]).max(axis=1), at)
    end = np.maximum.reduceat((gain[first[1:]][doc] - before).max(axis=1), at)
    sure = (stretch < penalty - 1e-3) & (np.maximum(begin, 0) + np.maximum(end, 0) < penalty - 1e-3)
    return np.where(sure, label, -1)


def viterbi(scores: np.ndarray, first: np.ndarray, penalty: float = SWITCH_PENALTY) -> np.ndarray:
    """Best label of each word; texts are scores[first[i]:first[i+1]]. Only texts that may switch are walked word by word."""
    labels = np.zeros(len(scores), dtype=np.int16)
    length = np.diff(first)
    order = np.argsort(-length, kind="stable")
    order = order[length[order] > 0]
    if len(order):
        full = np.flatnonzero(length > 0)
        one = np.full(len(length), -1)
        one[full] = constant(scores, np.append(first[:-1][full], len(scores)), penalty)
        labels[:] = np.repeat(one, length)
        order = order[one[order] < 0]
    if not len(order):
        return labels
    at, n = first[:-1][order], length[order]
    steps = int(n[0])
    # texts that still have a word at each step: lengths fall, so they are a prefix
    active = np.searchsorted(-n, -np.arange(1, steps + 1), side="right")
    value = scores[at].copy()
    back = np.zeros((len(scores), scores.shape[1]), dtype=np.int8 if scores.shape[1] < 128 else np.int16)
    own = np.arange(scores.shape[1], dtype=back.dtype)
    for t in range(1, steps):
        k = active[t]
        v = value[:k]
        best = v.argmax(axis=1)
        switched = (v[np.arange(k), best] - penalty)[:, None]
        where = at[:k] + t
        change = switched > v
        back[where] = np.where(change, best[:, None], own)
        value[:k] = np.where(change, switched, v) + scores[where]
    last = np.zeros(len(order), dtype=np.int64)
    for t in range(steps - 1, -1, -1):
        k = active[t]
        ends = n[:k] - 1 == t
        if ends.any():
            last[:k][ends] = value[:k][ends].argmax(axis=1)
        where = at[:k] + t
        labels[where] = last[:k]
        if t:
            last[:k] = back[where, last[:k]]
    return labels


def _counter(languages: list[str]):
    place = {lang: i for i, lang in enumerate(languages)}
    n_lang, base = len(languages), np.cumsum([0, *(1 << b for b in BITS), SCRIPTS])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((int(base[-1]), n_lang), dtype=np.int64)
        for batch in batches:
            lang = np.array([place[x] for x in batch.column(1).to_pylist()], dtype=np.int64)
            for row, stop, data, offsets in chunks(batch):
                f = Features(data, offsets)
                of = np.repeat(lang[row:stop], np.diff(f.words.first))[f.letters]
                for kind, slots in enumerate([*f.slots, f.script.astype(np.int64)]):
                    total += np.bincount((slots[f.letters] + base[kind]) * n_lang + of, minlength=total.size).reshape(total.shape)
        key = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(total.ravel()[key])], ["key", "n"])

    return count


def train(labelled: DataFrame) -> LanguageModel:
    """Model from labelled(text, lang), neither null."""
    languages = sorted(r[0] for r in labelled.select("lang").distinct().collect())  # as many as there are languages
    sizes = [1 << b for b in BITS]
    if not languages:
        return LanguageModel([], [np.zeros((s, 0), dtype=np.float32) for s in sizes], np.ones((SCRIPTS, 0), dtype=bool))
    rows = labelled.select("text", "lang").mapInArrow(_counter(languages), "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).toPandas()
    flat = np.zeros((sum(sizes) + SCRIPTS) * len(languages))
    flat[rows["key"].to_numpy(dtype=np.int64)] = rows["n"].to_numpy()
    counts = flat.reshape(-1, len(languages))
    scores, at = [], 0
    for size in sizes:
        c = counts[at : at + size]
        scores.append((np.log(c + SMOOTHING) - np.log(c.sum(axis=0) + SMOOTHING * size)).astype(np.float32))
        at += size
    script = counts[at:]
    allowed = script >= SCRIPT_SHARE * np.maximum(1, script.sum(axis=0))
    allowed[~allowed.any(axis=1)] = True
    return LanguageModel(languages, scores, allowed)


IDENTIFIED = "doc_id long, held_out boolean, lang_pred string, score double, spans string"


def _identify(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: LanguageModel = opened(shared)
        for batch in batches:
            pred, score, spans = [], [], []
            for row, stop, data, offsets in chunks(batch, size=LABELLED):
                n = stop - row
                if not model.languages:
                    pred, score, spans = pred + ["und"] * n, score + [0.0] * n, spans + [""] * n
                    continue
                f = Features(data, offsets)
                first = f.words.first
                s = model.word_scores(f)
                labels = viterbi(s, first)
                size = np.where(f.letters, f.words.end - f.words.start, 0)
                doc = f.words.doc()
                mass = np.bincount(doc * len(model.languages) + labels, weights=size, minlength=n * len(model.languages)).reshape(n, -1)
                whole = mass.sum(axis=1)
                best = mass.argmax(axis=1)
                turn = np.ones(len(labels), dtype=bool)
                turn[1:] = (labels[1:] != labels[:-1]) | (doc[1:] != doc[:-1])
                begins = np.flatnonzero(turn)
                ends = np.append(begins[1:], len(labels)) - 1
                cut = np.searchsorted(begins, first)
                for i in range(n):
                    if whole[i] <= 0 or not _has_letter(data[offsets[i] : offsets[i + 1]], f.letters[first[i] : first[i + 1]]):
                        pred.append("und"), score.append(0.0), spans.append("")
                        continue
                    pred.append(model.languages[best[i]])
                    score.append(float(mass[i, best[i]] / whole[i]))
                    b, e = begins[cut[i] : cut[i + 1]], ends[cut[i] : cut[i + 1]]
                    begin, end = (f.words.start[b] - offsets[i]).tolist(), (f.words.end[e] - offsets[i]).tolist()
                    spans.append(" ".join(f"{x}-{y}:{model.languages[k]}" for x, y, k in zip(begin, end, labels[b].tolist(), strict=True)))
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), pa.array(pred, type=pa.string()), pa.array(score, type=pa.float64()), pa.array(spans, type=pa.string())], ["doc_id", "held_out", "lang_pred", "score", "spans"])

    return run


def _has_letter(raw: np.ndarray, flags: np.ndarray) -> bool:
    """ASCII letters settle it; else the code points decide, since bytes from 128 on may be other signs."""
    if ((raw >= 65) & (raw <= 90) | (raw >= 97) & (raw <= 122)).any():
        return True
    return bool(flags.any()) and any(c.isalpha() for c in raw.tobytes().decode("utf-8", errors="ignore"))


def identify(docs: DataFrame, model: LanguageModel, held_out=None) -> DataFrame:
    """doc_id, held_out, lang_pred, score, spans for every row of docs(doc_id, text).

    Null texts and texts without a letter are 'und' with score 0.  score is the
    share of the text's letter-bearing bytes that carry the predicted label; spans are byte
    ranges with their labels, as "start-stop:lang" with a space between.  Ties go to the language that sorts first; repeated rows get equal results.
    """
    shared = share(docs.sparkSession, model)  # fixed size for a given set of languages
    plain = docs.select("text", F.col("doc_id").cast("long").alias("doc_id"), (F.lit(False) if held_out is None else held_out).alias("held_out"))
    return plain.mapInArrow(lean(_identify(shared)), IDENTIFIED)


def op10_language_id(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    fold = crc_mod("doc_id", 4)
    model = train(docs.filter((fold != 2) & F.col("text").isNotNull() & F.col("lang").isNotNull()).select("text", "lang"))
    return identify(docs, model, fold == 2)
