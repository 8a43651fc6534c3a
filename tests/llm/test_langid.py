import numpy as np

from linkloom.llm import langid as L


def test_held_out(spark):
    data = "/root/testdata/sf0.01"
    lang = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "lang")
    got = L.op10_language_id(spark, data).filter("held_out").join(lang, "doc_id").collect()
    assert sum(r.lang == r.lang_pred for r in got) / len(got) > 0.97


def brute(scores, penalty):
    value, back = scores[0].copy(), []
    for s in scores[1:]:
        step = np.maximum(value, value.max() - penalty)
        back.append(np.where(value >= value.max() - penalty, np.arange(len(value)), value.argmax()))
        value = step + s
    path = [int(value.argmax())]
    for b in reversed(back):
        path.append(int(b[path[-1]]))
    return path[::-1]


def test_viterbi():
    rng = np.random.default_rng(2)
    sizes = [0, 1, 7, 30, 0, 12]
    first = np.concatenate(([0], np.cumsum(sizes)))
    scores = rng.normal(0, 3, (first[-1], 3))
    got = L.viterbi(scores, first, 4.0)
    for i, n in enumerate(sizes):
        if n:
            assert got[first[i] : first[i + 1]].tolist() == brute(scores[first[i] : first[i + 1]], 4.0)


def test_constant_paths():
    """Texts that are settled without a walk have that path, ties and texts that never take the likeliest label included; plain ones are settled."""
    rng = np.random.default_rng(5)
    settled = 0
    for trial in range(300):
        sizes = rng.integers(1, 12, 6)
        first = np.concatenate(([0], np.cumsum(sizes)))
        scores = np.round(rng.normal(0, 1.5, (first[-1], 3)) + rng.normal(0, 1, 3)).astype(np.float32)
        one = L.constant(scores, first, 4.0)
        for i, n in enumerate(sizes):
            if one[i] >= 0:
                settled += 1
                assert brute(scores[first[i] : first[i + 1]], 4.0) == [one[i]] * n
    assert 300 < settled < 1800
    plain = np.tile(np.array([[0.0, -1.0]], dtype=np.float32), (50, 1))
    assert L.constant(plain, np.array([0, 20, 50]), 8.0).tolist() == [0, 0]


def test_spans_and_scripts(spark):
    en, ru, de = "the cat sat on the mat and the dog ran", "кот сидел на полу и смотрел в окно", "der hund lief schnell durch den grossen wald"
    df = spark.createDataFrame([(i, t, g) for i, (t, g) in enumerate([(en, "en"), (ru, "ru"), (de, "de")] * 20)], "doc_id long, text string, lang string")
    model = L.train(df.select("text", "lang"))
    mixed = f"{en} {en} {ru} {ru}"
    r = L.identify(spark.createDataFrame([(1, mixed), (2, "слово"), (3, None), (4, "12 … 3"), (5, "")], "doc_id long, text string"), model).collect()
    by = {x.doc_id: x for x in r}
    assert by[1].spans == f"0-{len(f'{en} {en}')}:en {len(f'{en} {en}') + 1}-{len(mixed.encode())}:ru"
    assert by[2].lang_pred == "ru" and {by[i].lang_pred for i in (3, 4, 5)} == {"und"}


def test_awkward(awkward, empty):
    known = awkward.filter("text is not null and lang is not null").select("text", "lang")
    got = L.identify(awkward, L.train(known)).collect()
    assert len(got) == awkward.count() and all(0 <= r.score <= 1 for r in got)
    assert {r.lang_pred for r in got if r.doc_id in (3, 4, 5, 10)} == {"und"}
    none = L.train(known.limit(0))
    assert {r.lang_pred for r in L.identify(awkward, none).collect()} == {"und"}
    assert L.identify(empty, none).count() == 0


def test_scripts_by_code_point():
    """Every script's first and last letters, whatever bytes they have; marks and Latin letters are common."""
    for first, last, script in L.RANGES:
        text = chr(first) + "a" + chr(last)
        data = np.frombuffer(text.encode(), dtype=np.uint8)
        got = L.script_bytes(data)
        assert [got[i] for i in np.flatnonzero((data < 128) | (data >= 192))] == [script, 0, script]
    for words, script in (("한국 나라 마음 서울 사람 말이", 11), ("日本 中文", 10), ("ひらがな カタカナ", 9), ("e\u0301 \u036f é ß œ", 0), ("ελληνικά", 1), ("नमस्ते", 6)):
        data = np.frombuffer(words.encode(), dtype=np.uint8)
        assert set(L.Features(data, np.array([0, len(data)])).script.tolist()) == {script}


def test_word_scores_against_sums():
    """A word's score is the sum of the logs of its three smoothed shares."""
    rng = np.random.default_rng(1)
    scores = [rng.normal(size=(1 << b, 2)).astype(np.float32) for b in L.BITS]
    model = L.LanguageModel(["a", "b"], scores, np.array([[True, True]] * L.SCRIPTS))
    data = np.frombuffer("Some words, 12 and more".encode(), dtype=np.uint8)
    f = L.Features(data, np.array([0, len(data)]))
    got = model.word_scores(f)
    for i, word in enumerate("Some words, 12 and more".split()):
        want = sum(scores[k][f.slots[k][i]] for k in range(3)) if any(c.isalpha() for c in word) else 0
        assert np.allclose(got[i], want)
