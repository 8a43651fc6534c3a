import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from linkloom.llm import ctxmix as M
from linkloom.llm import speller as S
from linkloom.llm.common import text_buffer


def tokens(text):
    return [*(text or "").encode().lower().split(), b""]


def test_documents(spark, data, docs):
    texts = {r.doc_id: r.text for r in docs.collect()}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in texts}
    c = Counter(w for i, t in texts.items() if not held[i] for w in tokens(t))
    n, v = sum(c.values()), len(c)
    got = M.op4_lm_score(spark, data).collect()
    assert len(got) == len(texts)
    for r in got:
        w = tokens(texts[r.doc_id])
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[r.doc_id], len(w), sum(c[x] > 0 for x in w), n)
        assert r.base_score == pytest.approx(sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w))
        assert r.score < 0 and r.bits_per_byte > 0


def test_held_out_documents(spark):
    """Better than the base on a thousand documents (the base is no distribution: it prices all unseen words alike), on held-out texts that copy no training text."""
    path = "/root/testdata/sf0.01"
    texts = spark.read.parquet(f"{path}/documents.parquet").select("doc_id", F.md5("text").alias("key"))
    got = M.op4_lm_score(spark, path).join(texts, "doc_id").collect()
    known = {r.key for r in got if not r.held_out}
    new = [r for r in got if r.held_out and r.key not in known]
    assert len(new) > 100 and sum(r.score for r in new) > sum(r.base_score for r in new)
    # a score of the text, not of where it stands
    assert len({round(r.score, 6) for r in got}) > 0.9 * len({r.key for r in got})


def small_book(words, counts, classes=1):
    by = np.array(counts, dtype=np.float64)[None, :].repeat(classes, axis=0)
    return M.Codebook.build(words, np.array(counts, dtype=np.float64) * classes, by, by.sum(axis=1) + 3, len(words) + 3)


def coded(book, mixer, text):
    data, at = text_buffer(pa.array([text]))
    t = M.Tokens(book, M._known(book), data, at)
    s = M.Stream.of(book, t)
    return M.cost(mixer, s, *mixer.inputs(book, t, s))[0]


def test_paths_are_a_prefix_code():
    book = small_book([b"a", b"bb", b"c", b"d"], [50, 20, 3, 2])
    codes = ["".join(map(str, book.bit[a:b])) for a, b in zip(book.first[:-1], book.first[1:], strict=True)]
    assert sum(2.0 ** -len(c) for c in codes) == 1 and len(set(codes)) == len(codes) == 6
    assert all(book.place[a] == 0 for a in book.first[:-1]) and book.place.max() == len(codes) - 2


def test_next_token_is_a_distribution():
    """After any beginning, all next words, the end and the escape share a probability of one."""
    words = [b"a", b"bb", b"c", b"d"]
    book, mixer = small_book(words, [50, 20, 3, 2], 2), M.fresh()
    mixer.counts[:] = np.random.default_rng(3).integers(0, 5, mixer.counts.shape)
    mixer.refine = 0.8 * mixer.refine + 0.05
    for before in ("", "a", "a bb a bb a", "zz bb zz"):
        # the probability of a token is that of the text with it over that without; the end is the last token of both
        def steps(text):
            data, at = text_buffer(pa.array([text]))
            t = M.Tokens(book, M._known(book), data, at)
            s = M.Stream.of(book, t)
            x, gate = mixer.inputs(book, t, s)
            refined = mixer.coded(np.einsum("ij,ij->i", x, mixer.weights.astype(np.float32)[gate]), gate)[2]
            return np.bincount(np.repeat(np.arange(len(s.size)), s.size), weights=np.log10(np.where(s.y == 1, refined, 1 - refined)), minlength=len(t.leaf))

        n = len(before.split())
        p = [10 ** steps(f"{before} {w}")[n] for w in ("a", "bb", "c", "d", "other")] + [10 ** steps(before)[n]]
        assert sum(p) == pytest.approx(1.0, abs=1e-5)


def test_cost_against_one_bit_after_the_other(monkeypatch):
    """The vectorised coder against a plain loop over bits, with weights that follow each text."""
    monkeypatch.setattr(M, "STEP", 7)
    monkeypatch.setattr(M, "LONG_STEP", 20)
    book, mixer = small_book([b"a", b"bb", b"c", b"d"], [50, 20, 3, 2], 2), M.fresh()
    texts = ["a bb c a bb c a bb d zz a", "", "d d d", "c bb a " * 20]
    data, at = text_buffer(pa.array(texts))
    t = M.Tokens(book, M._known(book), data, at)
    s = M.Stream.of(book, t)
    x, gate = mixer.inputs(book, t, s)
    got = M.cost(mixer, s, x, gate)
    for i in range(len(texts)):
        own, total = np.zeros(M.INPUTS), 0.0
        every = np.arange(s.first[i], s.first[i + 1])
        mixed = every[gate[every] >= 2]
        stretches = [every[gate[every] < 2], *[mixed[a : a + n] for a, n in zip([0, 7, 21, *range(41, 2000, 20)], [7, 14, *[20] * 200], strict=False)]]
        for which, (stretch, length) in enumerate(zip(stretches, [1, 7, 14, *[20] * 200], strict=False)):
            change = np.zeros(M.INPUTS)
            for b in stretch:
                z = min(14.0, max(-14.0, float((mixer.weights[gate[b]] + (own if which else 0)) @ x[b])))
                p = 1 / (1 + math.exp(-z))
                refined = 0.5 * (p + mixer.refine[gate[b], min(M.BUCKETS - 1, max(0, round((z + 12) / 24 * (M.BUCKETS - 1))))])
                total += math.log10(refined if s.y[b] else 1 - refined)
                change += (s.y[b] - p) * M.RATE * x[b]
            if which:
                own += change * math.sqrt(7 / length)
        assert got[i] == pytest.approx(total, rel=1e-4)


@pytest.mark.parametrize("places", [(3, 2), (1024, 128)])
def test_bits_that_need_no_mixing_are_summed_before(monkeypatch, places):
    """Mixing the beginnings of words and adding what is known of the rest gives what mixing all bits gives."""
    monkeypatch.setattr(M, "PLACES", places)
    monkeypatch.setattr(M, "HEADS", (4, 2))
    rng = np.random.default_rng(8)
    words = [b"w%d" % i for i in range(60)]
    counts = np.maximum(2, (300 / np.arange(1, 61)).astype(int))
    by = np.stack((counts, counts[::-1])).astype(np.float64)
    book = M.Codebook.build(words, by.sum(axis=0), by, by.sum(axis=1) + 20, 70)
    mixer = M.fresh()
    mixer.counts[:] = rng.integers(0, 4, mixer.counts.shape)
    mixer.refine = 0.9 * mixer.refine + 0.03
    mixer.weights += rng.normal(0, 0.1, mixer.weights.shape)
    texts = [" ".join(f"w{min(70, int(x))}" for x in rng.zipf(1.3, n)) for n in (0, 1, 5, 40, 300)] + [" ".join(["w1 w50 w3 other w59 w2"] * 30)]
    data, at = text_buffer(pa.array(texts))
    t = M.Tokens(book, M._known(book), data, at)
    whole = M.Stream.of(book, t)
    want = M.cost(mixer, whole, *mixer.inputs(book, t, whole))
    sizes = M.to_be_mixed(book, t)
    part = M.Stream.of(book, t, sizes)
    got = M.cost(mixer, part, *mixer.inputs(book, t, part)) + M.beyond(book, t, sizes, M.remainder(book, mixer))
    assert len(part.y) < len(whole.y) and got.tolist() == pytest.approx(want.tolist(), rel=1e-4, abs=1e-4)
    # the counted contexts are the same ones, too
    few = M.Stream.of(book, t, M.with_context(book, t))
    for order in (0, 1):
        (a, x), (b, y) = whole.slots(t, order), few.slots(t, order)
        assert x.tolist() == y.tolist() and whole.y[a].tolist() == few.y[b].tolist()


def test_order_of_words_and_repeats_matter(spark):
    rows = [(i, " ".join(f"w{(i * 7 + k * k) % 40}" for k in range(120))) for i in range(60)]
    line = " ".join(f"w{k}" for k in range(40))
    rows += [(100, " ".join([line] * 6)), (101, " ".join(sorted((line + " ") .split() * 6)))]
    got = {r.doc_id: r for r in M.score(spark.createDataFrame(rows, "doc_id long, text string"), F.col("doc_id") >= 100).collect()}
    assert got[100].base_score == pytest.approx(got[101].base_score)
    assert got[100].score > got[100].base_score and abs(got[100].score - got[101].score) > 1


def test_cost_depends_on_the_text_alone():
    """What lies beside a text in its chunk changes nothing."""
    book, mixer = small_book([b"a", b"bb", b"c", b"d"], [50, 20, 3, 2], 2), M.fresh()
    mixer.counts[:] = np.random.default_rng(5).integers(0, 5, mixer.counts.shape)
    texts = ["a bb c a bb c a bb d zz a", "", "d d d " * 300, "c bb a " * 200, "zz a zz a"]
    data, at = text_buffer(pa.array(texts))
    t = M.Tokens(book, M._known(book), data, at)
    s = M.Stream.of(book, t)
    together = M.cost(mixer, s, *mixer.inputs(book, t, s))
    assert together.tolist() == pytest.approx([coded(book, mixer, x) for x in texts], rel=1e-5)


def test_speller_is_a_distribution():
    """All words of up to two of three letters, and everything else, share a probability of one."""
    words = [b"ab", b"ba", b"aab", b"abab", b"bb"] * 3
    mixer = S.fresh()
    data, at = text_buffer(pa.array(words, type=pa.binary()))
    symbols, place, _ = S._symbols(data, at)
    for bit, slots in S.bit_slots(symbols, place):
        for i, s in enumerate(slots):
            np.add.at(mixer.counts, (i, s, bit), 1)
    S.learn(mixer, data, at)
    # the next symbol after a prefix: all 256 closing or going on
    for prefix in (b"", b"a", b"ab"):
        total = 0.0
        for x in range(256):
            raw = np.frombuffer(prefix + bytes([x]), dtype=np.uint8)
            sym, pl = raw, np.arange(len(raw))
            lp = np.zeros(len(raw))
            for bit, slots in S.bit_slots(sym, pl):
                p = mixer.stages(*mixer.inputs(slots))[2]
                lp += np.log10(np.where(bit == 1, p, 1 - p))
            total += 10 ** lp[-1]
        assert total == pytest.approx(1.0, abs=1e-6)


def test_awkward(awkward, empty):
    got = M.score(awkward, F.coalesce(F.col("doc_id") == 9, F.lit(False)), "lang").collect()
    assert len(got) == awkward.count()
    by = {r.doc_id: r for r in got}
    assert by[3].n_tokens == by[4].n_tokens == by[5].n_tokens == 1 and by[9].n_known == 1
    assert all(math.isfinite(r.score) and math.isfinite(r.base_score) for r in got)
    assert M.score(empty, F.lit(False)).count() == 0
    assert M.score(awkward, F.lit(True)).count() == awkward.count()  # nothing to learn from


def test_first_weights_come_from_every_training_text(spark):
    """However many texts there are: a few of a billion would have been left out of a sample of 2,048."""
    from linkloom.llm.common import share

    words, count = [b"a", b"b", b"c"], np.array([400, 300, 200])
    book = M.Codebook.build(words, count, count[None, :].astype(float), np.array([1000.0]), 4)
    texts = spark.createDataFrame([("a b a c b a " * 5, (i + 1) * 1000) for i in range(40)], "text string, key long")
    mixer, _ = M.train(texts, share(spark, book), 10**9)
    assert not np.array_equal(mixer.weights, M.fresh().weights)
