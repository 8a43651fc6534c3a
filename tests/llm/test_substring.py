import hashlib

import pytest

from linkloom.llm import substring as S


def brute(rows, window=50):
    first = {}
    split = [(i, (t or "").encode().split()) for i, t in rows]
    for i, w in split:
        if i is not None:
            for k in range(len(w) - window + 1):
                key = tuple(w[k : k + window])
                first[key] = min(first.get(key, i), i)
    out = []
    for i, w in split:
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if i is not None and first[tuple(w[k : k + window])] < i:
                gone[k : k + window] = [True] * window
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((i if i is not None else -1, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def result(df):
    return sorted((r.doc_id if r.doc_id is not None else -1, r.n_words, r.n_removed, r.kept) for r in df.collect())


def test_documents(docs):
    assert result(S.dedup(docs, digest=True)) == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_awkward(awkward, empty):
    assert result(S.dedup(awkward, digest=True)) == brute([(r.doc_id, r.text) for r in awkward.collect()])
    assert S.dedup(empty).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_shared_passages(spark, seed):
    """Passages around the window length, at edges, overlapping, in chains."""
    import random

    rng = random.Random(seed)
    pool = [[f"p{rng.randrange(400)}" for _ in range(rng.choice([49, 50, 51, 80, 130]))] for _ in range(8)]
    rows = []
    for i in range(60):
        w = []
        for _ in range(rng.randrange(1, 5)):
            p = rng.choice(pool)
            a = rng.randrange(0, max(1, len(p) - 40))
            w += [f"u{rng.randrange(10**6)}" for _ in range(rng.randrange(0, 30))] + p[a : a + rng.randrange(40, 140)]
        rows.append((rng.randrange(100), " ".join(w)))
    got = S.dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), digest=True)
    assert result(got) == brute(rows)


def test_stage_keeps_columns(spark, awkward, empty):
    out = S.stage_substring_dedup(spark, awkward, "")
    assert out.columns == awkward.columns and out.dtypes == awkward.dtypes
    assert out.filter("text is null").count() == 1
    assert out.filter("doc_id = 2").count() == 0  # lost all its words
    assert S.stage_substring_dedup(spark, empty, "").count() == 0


def test_stage_with_clashing_columns(spark):
    df = spark.createDataFrame([(1, "a b c", "x", "y", 5), (None, None, "z", "w", None)], "doc_id long, text string, id_ string, no_text_ string, n_chars long")
    assert sorted(map(tuple, S.stage_substring_dedup(spark, df, "").collect()), key=str) == [(1, "a b c", "x", "y", 5), (None, None, "z", "w", None)]
