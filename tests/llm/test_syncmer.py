import hashlib

from pyspark.sql import functions as F

from linkloom.llm import syncmer as S


def test_edited_texts(docs):
    rows = sorted((r.doc_id, r.text or "") for r in docs.collect())
    got = sorted(S.compare_edited(docs).collect(), key=lambda r: r.doc_id)
    prints = {r.doc_id: r.fingerprint for r in got}
    for i, (r, (doc, text)) in enumerate(zip(got, rows, strict=True)):
        after = rows[(i + 1) % len(rows)]
        q = len(text) // 4
        edited = text[: len(text) - q] + after[1][:q]
        assert (r.doc_id, r.n_chars, r.edited_sha256) == (doc, len(text), hashlib.sha256(edited.encode()).hexdigest())
        a, b = ({p[k : k + 8] for k in range(0, len(p), 8)} for p in (r.fingerprint, prints[after[0]]))
        want = 1.0 if a == b else len(a & b) / len(a | b)
        assert abs(r.near_next - want) < 1e-9
    assert sum(r.near_edited for r in got) / len(got) > 0.4


def test_closed_syncmers(spark):
    """A k-mer is chosen exactly if its least word hash is at an edge, wherever it stands."""
    text = " ".join(f"w{i * 37 % 101}" for i in range(80))
    df = spark.createDataFrame([(text,), ("zz " + text,)], "text string")
    a, b = S.anchors(df).collect()
    hashes = [r[0] for r in spark.createDataFrame([(w,) for w in text.split()], "w string").select(F.xxhash64("w")).collect()]
    want = [i for i in range(len(hashes) - 2) if min(hashes[i : i + 3]) in (hashes[i], hashes[i + 2])]
    assert [x.place for x in a.anchors] == want
    assert {(x.place + 1, x.hash) for x in a.anchors} <= {(x.place, x.hash) for x in b.anchors}


def test_awkward(spark, awkward, empty):
    got = S.compare_edited(awkward).collect()
    assert len(got) == awkward.count()
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    prints = {}
    for r in got:
        prints.setdefault(r.doc_id, set()).add(r.fingerprint)
    assert prints[3] == prints[4] == prints[5] == {""} and prints[1] == prints[2] == prints[None]
    assert S.compare_edited(empty).count() == 0
    one = S.compare_edited(spark.createDataFrame([(1, "a b c d e f g h")], "doc_id long, text string")).first()
    assert one.near_next == 1.0


def test_long_texts_keep_all_anchors_and_places(spark):
    """Of two long texts that share one passage, the likeness and the common shift are exact."""
    own, other, shared = [f"a{i}" for i in range(900)], [f"b{i}" for i in range(1300)], [f"s{i}" for i in range(300)]
    rows = [(1, " ".join(own + shared)), (2, " ".join(other[:200] + shared + other[200:]))]
    got = {r.doc_id: r for r in S.compare_edited(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = {r.doc_id: {x.place: x.hash for x in r.anchors} for r in S.anchors(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, r in got.items():
        digits = lambda t: [int(t[k : k + 8], 16) for k in range(0, len(t), 8)]
        assert dict(zip(digits(r.places), digits(r.fingerprint), strict=True)) == {p: h % 2**64 >> 32 for p, h in want[i].items()}
        both, every = set(want[1].values()) & set(want[2].values()), set(want[1].values()) | set(want[2].values())
        assert len(both) > 100 and abs(r.near_next - len(both) / len(every)) < 1e-9 and abs(r.placed_next - r.near_next) < 1e-9


def test_moved_words_are_not_matched_by_place(spark):
    blocks = [[f"w{b}x{i}" for i in range(50)] for b in range(4)]
    text = lambda order: " ".join(w for b in order for w in blocks[b])
    r = S.compare_edited(spark.createDataFrame([(1, text([0, 1, 2, 3])), (2, text([3, 2, 1, 0]))], "doc_id long, text string")).first()
    assert r.near_next > 0.8 and r.placed_next < 0.4


def test_slices_change_nothing(docs, monkeypatch):
    """Many small slices, with repeated rows and ids, against one: every row finds the same next document."""
    twice = docs.unionByName(docs.filter("doc_id % 3 = 0")).unionByName(docs.selectExpr("7 as doc_id", "upper(text) as text", "lang", "source", "n_chars"))
    rows = lambda: sorted(map(tuple, S.compare_edited(twice).collect()), key=str)
    whole = rows()
    monkeypatch.setattr(S, "SLICE_ROWS", 5)
    assert len(S.slice_bounds(twice.select("doc_id"), twice.count())) > 20
    assert rows() == whole


def test_slice_of(spark):
    bounds = [-5, 0, 3, 10]
    got = spark.range(-10, 20).select("id", S.slice_of(F.col("id"), bounds).alias("s")).collect()
    assert [r.s for r in got] == [sum(b <= r.id for b in bounds) for r in got]
