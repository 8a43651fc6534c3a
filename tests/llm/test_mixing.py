import math

import pytest
from pyspark.sql import functions as F

from linkloom.llm import mixing as M


def targets(sizes, weights, cap=3.0):
    """Reshare by hand until no source is above its cap."""
    total, fixed = sum(sizes.values()), {}
    while True:
        open_ = [k for k in sizes if k not in fixed]
        left = total - sum(fixed.values())
        share = {k: left * weights[k] / sum(weights[x] for x in open_) for k in open_}
        over = [k for k in open_ if share[k] > cap * sizes[k]]
        if not over:
            return fixed | share
        fixed |= {k: cap * sizes[k] for k in over}


def test_documents(spark, docs):
    got = M.mix(docs).join(docs.select("doc_id", "source"), "doc_id")
    per = {r.source: r for r in got.groupBy("source").agg(F.sum("size").alias("size"), F.first("target").alias("target"), F.sum("taken").alias("taken"), F.max("copies").alias("copies")).collect()}
    names = sorted(per)
    want = targets({k: per[k].size for k in names}, {k: i % 3 + 1 for i, k in enumerate(names)})
    for k in names:
        assert per[k].target == pytest.approx(want[k])
        assert abs(per[k].taken - want[k]) <= max(60, 0.03 * want[k])
        assert per[k].copies <= 3
    again = M.mix(docs.repartition(5))
    assert sorted((r.doc_id, r.taken) for r in again.collect()) == sorted((r.doc_id, r.taken) for r in got.collect())


def test_caps(spark):
    rows = [(i, "a b c d", "big") for i in range(50)] + [(100, "a b", "small"), (101, "x", "tiny")]
    got = M.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    target = {r.doc_id: r.target for r in got}
    assert target[100] == 6 and target[101] == 3 and target[0] == pytest.approx(203 - 9)
    assert {r.doc_id: r.taken for r in got if r.doc_id >= 100} == {100: 6, 101: 3}


def test_newton_solves_the_dual(spark):
    g = spark.createDataFrame([(10.0, 25.0), (10.0, 1e-3), (10.0, 0.0), (0.0, 0.0)], "source_size double, target double")
    assert {(r.source_size, r.target): r.rate for r in M.newton_rates(g).collect()} == pytest.approx({(10.0, 25.0): 2.5, (10.0, 1e-3): 1e-4, (10.0, 0.0): 0.0, (0.0, 0.0): 0.0})


def test_overlapping_groups(spark):
    """Two languages across two sources: all four sums are met, and the rates are products of multipliers (the least entropy)."""
    sizes = {(0, 10): 40.0, (0, 11): 60.0, (1, 10): 80.0, (1, 11): 20.0}
    targets = {0: 150.0, 1: 50.0, 10: 90.0, 11: 110.0}
    lam = M.balance(spark.createDataFrame([(list(k), v) for k, v in sizes.items()], "groups array<int>, size double"), targets)
    rate = {k: math.exp(sum(lam[g] for g in k)) for k in sizes}
    for g, want in targets.items():
        assert sum(v * rate[k] for k, v in sizes.items() if g in k) == pytest.approx(want, rel=1e-6)
    assert rate[0, 10] * rate[1, 11] == pytest.approx(rate[0, 11] * rate[1, 10])


def test_awkward(spark, awkward, empty):
    got = M.mix(awkward).collect()
    assert len(got) == awkward.count() and all(r.taken <= 3 * r.size for r in got)
    assert M.mix(empty).count() == 0
    out = M.stage_mix(spark, awkward, "")
    assert out.columns == ["doc_id", "source", "text", "size", "copies", "taken"] and out.filter("copies < 1 or taken <> size * copies").count() == 0


def test_stage_gives_repeated_rows_what_the_mix_gives_them(spark):
    rows = [(i % 3, f"w{i % 3} x y", "a", "c") for i in range(30)] + [(100 + i, "u v", "b", "d") for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, copies string")
    per = lambda x: {r.source: r.n for r in x.groupBy("source").agg(F.sum("taken").alias("n")).collect()}
    out = M.stage_mix(spark, df, "")
    assert per(out) == {k: n for k, n in per(M.mix(df).join(df.select("doc_id", "source").distinct(), "doc_id")).items() if n}
    target = {r.source: r.target for r in M.mix(df).join(df.select("doc_id", "source").distinct(), "doc_id").select("source", "target").distinct().collect()}
    assert all(abs(n - target[k]) <= 3 for k, n in per(out).items())
