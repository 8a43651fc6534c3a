import random
from collections import Counter

import numpy as np
import pytest

from linkloom.llm import dartmin as M


def shingles(text):
    w = (text or "").encode().split()
    return Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else Counter([tuple(w)] if w else [])


def jaccard(a, b):
    shared = sum(min(n, b[g]) for g, n in a.items())
    return shared / max(1, sum(a.values()) + sum(b.values()) - shared)


def brute(rows):
    parent = {i: i for i, _ in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sets = [(i, shingles(t)) for i, t in rows]
    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and jaccard(a, b) >= 0.8 - 1e-12:
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    return {i: root(i) for i, _ in rows}


def test_documents(docs):
    got = {r.doc_id: r.class_id for r in M.classes(docs).collect()}
    assert got == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_chain_beyond_the_leader(spark):
    """Neighbours are similar, the ends are not: all are one class."""
    base = [f"w{i}" for i in range(300)]
    rows = [(i, " ".join(base[12 * i :] + [f"y{k}" for k in range(12 * i)])) for i in range(12)]
    got = {r.doc_id: r.class_id for r in M.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute(rows) and set(got.values()) == {0}


@pytest.mark.parametrize("block", [500, 50_000])
def test_families_around_the_limit(spark, monkeypatch, block):
    """Copies of copies at similarities around 0.8: stars leave several classes in a bucket, blocks of any size find the rest."""
    monkeypatch.setattr(M, "BLOCK_WORDS", block)
    rng = random.Random(11)
    rows, i = [], 0
    for f in range(3):
        family = [[f"f{f}w{k}" for k in range(160)]]
        for _ in range(35):
            w = list(rng.choice(family))
            for _ in range(rng.randrange(2, 7)):
                w[rng.randrange(len(w))] = f"e{rng.randrange(10**9)}"
            family.append(w)
        for w in family:
            rows.append((i, " ".join(w)))
            i += 1
    rng.shuffle(rows)
    got = {r.doc_id: r.class_id for r in M.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = brute(sorted(rows))
    assert len(set(want.values())) > 3
    assert got == want


def test_a_crowded_bucket_costs_a_row_a_text(spark):
    """2,000 texts of 150 words in one bucket: a row each; in small blocks, every two texts still meet once."""
    left = spark.range(2000).selectExpr("7L as key", "0 as band", "id as rep", "2000L as n", "300000L as words_")
    assert M.meetings(left).count() == 2000


def test_blocks_meet_once(spark, monkeypatch):
    monkeypatch.setattr(M, "BLOCK_TEXTS", 9)
    cells = {}
    for r in M.meetings(spark.range(40).selectExpr("7L as key", "0 as band", "id as rep", "40L as n", "400L as words_")).collect():
        cells.setdefault((r.block, r.slice), []).append((r.kind, r.rep))
    met = Counter()
    for (block, piece), rows in cells.items():
        for i, (kind, a) in enumerate(rows):
            met.update(frozenset((a, b)) for other, b in (rows[:i] if block == piece else rows) if block == piece or (kind, other) == (0, 1))
    assert len(met) == 40 * 39 // 2 and set(met.values()) == {1}


def test_agreement_is_weighted_jaccard():
    rng = np.random.default_rng(3)
    a = rng.integers(1, 2**60, 200).astype(np.uint64)
    b = a.copy()
    b[:60] = rng.integers(1, 2**60, 60).astype(np.uint64)
    agree = []
    for shift in range(40):
        x, y = a + np.uint64(shift), b + np.uint64(shift)
        s = M.signatures(2, np.repeat([0, 1], 200), np.concatenate((x, y)))
        agree.append((s[0] == s[1]).mean())
    assert abs(np.mean(agree) - 140 / 260) < 0.03


def test_awkward(awkward, empty):
    got = M.classes(awkward).collect()
    assert len(got) == awkward.count()
    by = {}
    for r in got:
        by.setdefault(r.doc_id, set()).add((r.class_id, r.n_class))
    assert by[1] == by[2] == {(1, 2)} and by[8] == {(8, 2)} and by[4] == {(4, 1)} and by[None] == {(None, 1)}
    assert M.classes(empty).count() == 0


def test_stage(spark, awkward):
    out = M.stage_near_dedup(spark, awkward, "")
    assert out.columns == awkward.columns
    ids = sorted(r.doc_id for r in out.select("doc_id").collect() if r.doc_id is not None)
    assert ids == [1, 3, 4, 5, 6, 7, 7, 8, 9, 10, 11]  # two texts that share an id, and one of two equal rows


def test_stage_with_clashing_columns(spark):
    df = spark.createDataFrame([(1, "a b c d e f", "r", "w"), (2, "a  b c d e f", "s", "v"), (3, None, "t", "u")], "doc_id long, text string, row_ string, words_ string")
    assert sorted(map(tuple, M.stage_near_dedup(spark, df, "").collect())) == [(1, "a b c d e f", "r", "w"), (3, None, "t", "u")]
