import random

import numpy as np
import pytest

from linkloom.llm import decontam as D


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


@pytest.mark.parametrize("n", [8, 14, 20, 31, 32, 40, 60, 100])
def test_lsh_recall(n):
    rng, found, tries = np.random.default_rng(n), 0, 150
    for _ in range(tries):
        a = rng.integers(1, 2**62, n).astype(np.uint64)
        b = list(a)
        for _ in range(D.edits_allowed(n)):
            kind, i = rng.integers(3), rng.integers(len(b))
            if kind == 0:
                b[i] = np.uint64(rng.integers(1, 2**62))
            elif kind == 1:
                b.insert(i, np.uint64(rng.integers(1, 2**62)))
            else:
                b.pop(i)
        b = np.array((b + [np.uint64(0)] * n)[:n], dtype=np.uint64)
        x, y = D.buckets(np.stack([a, b])).T
        found += bool((x == y).any())
    assert found / tries >= D.TARGET_RECALL - 0.01


def test_planted(spark):
    """Every planted passage within the limit is found with its distance, and nothing else is."""
    rng = random.Random(5)
    words = [f"word{i}" for i in range(3000)]
    items = {i: [rng.choice(words) for _ in range(rng.choice([2, 5, 9, 20, 45, 70]))] for i in range(40)}
    docs, want = [], set()
    for d in range(120):
        body = [rng.choice(words) for _ in range(rng.randrange(0, 200))]
        if d % 2:
            i = rng.randrange(40)
            p = list(items[i])
            for _ in range(rng.randrange(0, D.edits_allowed(len(p)) + 1)):
                k = rng.randrange(len(p))
                rng.choice([lambda: p.__setitem__(k, "edited"), lambda: p.insert(k, "added"), lambda: p.pop(k)])()
            at = rng.randrange(len(body) + 1)
            body[at:at] = p
            want.add((d, i))
        docs.append((d, " ".join(w.capitalize() + rng.choice(["", ",", "."]) for w in body)))
    got = D.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(i, " ".join(w)) for i, w in items.items()], "item_id long, text string")).collect()
    found = {(r.doc_id, r.item_id) for r in got}
    long = {(d, i) for d, i in want if len(items[i]) >= D.LITERAL_WORDS}
    assert long <= found
    clean = lambda t: "".join(c.lower() if c.isalnum() else " " for c in t).split()
    text = dict(docs)
    for r in got:
        part = clean(text[r.doc_id])[r.first_word : r.first_word + r.words]
        assert edits(items[r.item_id], part) == r.edits <= D.edits_allowed(len(items[r.item_id]))
    assert {(d, i) for d, i in found - want if len(items[i]) >= D.LITERAL_WORDS} == set()


def test_awkward(spark, awkward, empty):
    bench = spark.createDataFrame([(1, None), (2, ""), (3, "w1 w2 w3 w4 w5 w6 w7 w8 w9"), (None, "x")], "item_id long, text string")
    assert D.find_leaks(awkward, bench).count() == 0
    assert D.find_leaks(awkward, bench.limit(0)).count() == 0
    assert D.find_leaks(empty, bench).count() == 0


def test_stage(spark, docs, data):
    leaks = {r.doc_id for r in D.op3_decontaminate(spark, data).collect()}
    kept = {r.doc_id for r in D.stage_decontaminate(spark, docs, data).collect()}
    assert leaks and kept == {r.doc_id for r in docs.select("doc_id").collect()} - leaks


@pytest.mark.parametrize("n", [150, 400, 800, 1200, 2000])
def test_recall_of_long_items(n):
    """Edited copies at the limit, with text around them, are found whatever the item's length."""
    rng, tries, found = random.Random(n), 50, 0
    for _ in range(tries):
        item = [f"w{rng.randrange(10**9)}" for _ in range(n)]
        copy = list(item)
        for _ in range(D.edits_allowed(n)):
            k = rng.randrange(len(copy))
            rng.choice([lambda: copy.__setitem__(k, f"e{rng.random()}"[:9].replace(".", "")), lambda: copy.insert(k, "added"), lambda: copy.pop(k)])()
        body = [f"b{rng.randrange(10**9)}" for _ in range(200)]
        raw = " ".join(body[:100] + copy + body[100:]).encode()
        words = lambda x: D.tokens(np.frombuffer(x, dtype=np.uint8), np.array([0, len(x)]))[0]
        items = D.Items.build([7], [words(" ".join(item).encode())])
        got = D.search(items, D._known(items), np.frombuffer(raw, dtype=np.uint8), np.array([0, len(raw)]))
        assert all(d <= D.edits_allowed(n) for _, _, d, _, _ in got)
        found += len(got) == 1
    assert found / tries >= D.TARGET_RECALL - 0.01
