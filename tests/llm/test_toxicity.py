import numpy as np
from pyspark.sql import functions as F

from linkloom.llm import toxicity as T


def test_learns_a_pair_that_words_alone_do_not_show():
    """Both words are common among clean texts; only together they are toxic."""
    rng = np.random.default_rng(1)
    texts, label = [], []
    for _ in range(4000):
        insult, group = rng.random() < 0.4, rng.random() < 0.4
        t = set(rng.integers(100, 400, 20).tolist()) | ({1} if insult else set()) | ({2} if group else set())
        texts.append(np.array(sorted(t), dtype=np.uint64))
        label.append(float(insult and group))
    values = [np.ones(len(t), dtype=np.float32) for t in texts]
    m = T.fit(texts[:3000], values[:3000], np.array(label[:3000]), float(np.mean(label)))
    right = 0
    for t, y in zip(texts[3000:], label[3000:], strict=True):
        at = np.minimum(np.searchsorted(m.hashes, t), len(m.hashes) - 1)
        at = at[m.hashes[at] == t]
        right += (m.logits(1, np.zeros(len(at), dtype=int), at, np.ones(len(at)))[0] > 0) == bool(y)
    assert right / 1000 > 0.97


def test_held_out(spark):
    data = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{data}/labels.parquet").select("doc_id", "toxic")
    got = T.op6_toxicity(spark, data).filter("held_out").join(labels, "doc_id").groupBy("toxic", "predicted").count().collect()
    n = {(r.toxic, r.predicted): r["count"] for r in got}
    assert n[1, 1] / (n[1, 1] + n.get((1, 0), 0)) > 0.8
    assert n.get((0, 1), 0) / n[0, 0] < 0.01


def test_awkward(spark, awkward, empty):
    labels = spark.createDataFrame([(1, 1), (3, 0), (3, 1), (6, 0), (None, 1), (8, None), (99, 1)], "doc_id long, label int")
    got = T.score(awkward, T.train(awkward, labels)).collect()
    assert len(got) == awkward.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    assert T.score(empty, T.train(empty, labels)).count() == 0
    assert {r.predicted for r in T.score(awkward, T.train(awkward, labels.limit(0))).collect()} == {0}


def test_stage(spark, docs, data):
    out = T.stage_toxicity(spark, docs, data)
    flagged = {r.doc_id for r in T.op6_toxicity(spark, data).filter("predicted = 1").collect()}
    assert out.columns == docs.columns
    assert {r.doc_id for r in out.select("doc_id").collect()} == {r.doc_id for r in docs.select("doc_id").collect()} - flagged
    assert T.stage_toxicity(spark, docs.withColumn("score", F.lit(1)).limit(0), data).count() == 0


def test_score_against_a_sum_over_pairs():
    """The machine's logit by its definition: bias, terms, and every pair of terms once."""
    rng = np.random.default_rng(4)
    text = "You bad people, bad bad idea; good-bye everyone"
    data = np.frombuffer(text.encode(), dtype=np.uint8)
    _, term, value = T.weighted(*T.terms(data, np.array([0, len(data)])))
    known = np.sort(rng.choice(term, len(term) - 3, replace=False))
    m = T.FactorizationMachine(known, rng.normal(size=len(known)), rng.normal(size=(len(known), 3)), -0.4)
    x = {int(t): float(v) for t, v in zip(term, value, strict=True)}
    want = m.bias + sum(m.w[i] * x[int(t)] for i, t in enumerate(known))
    want += sum(float(m.v[i] @ m.v[j]) * x[int(known[i])] * x[int(known[j])] for i in range(len(known)) for j in range(i))
    got = m.score(data, np.array([0, len(data)]), m.prepared()[1])[0]
    assert abs(got - 1 / (1 + np.exp(-want))) < 1e-5


def test_repeated_ids_teach_once(spark):
    rows = [(i % 40, f"word{i % 40} bad thing" if i % 2 else f"word{i % 40} nice thing") for i in range(4000)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, label int")
    a = T.train(spark.createDataFrame(rows, "doc_id long, text string"), labels)
    b = T.train(spark.createDataFrame(rows[:40], "doc_id long, text string"), labels)
    assert (a.hashes == b.hashes).all() and np.allclose(a.w, b.w) and a.bias == b.bias
