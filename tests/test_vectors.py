"""Vectors of coded features: the candidates and cosines of the joins by feature, with less to shuffle."""

from pyspark.sql import functions as F

import __spark_entry__ as entry
from linkloom.operators import blocking as B
from linkloom.plans import records


def test_vectors_find_what_joins_find(spark):
    """Ties at the k-th place, alike candidates, a capped feature and a record of another country."""
    s1 = {"S1-3": "a b c", "S1-6": "q r", "S1-9": "zz"}
    pool = {"S2-10": "a b", "S2-7": "a b", "S3-5": "c", "S2-4": "b c d", "S3-8": "q", "S2-1": "r", "S3-11": "q"}
    of = lambda recs: spark.createDataFrame([("x", i, "name", f) for i, t in recs.items() for f in t.split()], "country string, id string, grp string, feat string")
    a, b = of(s1), of(pool).unionByName(of({"S2-13": "a b"}).withColumn("country", F.lit("y")))
    sizes = spark.createDataFrame([("x", 7), ("y", 1)], "country string, n long")
    table = B.idf(b, sizes)
    number = lambda df: df.withColumn("id", F.substr("id", F.lit(4)).cast("long"))
    first = {"S2-7": "S2-10", "S3-8": "S3-11"}
    twins = spark.createDataFrame([("x", i, int(first.get(i, i)[3:])) for i in pool] + [("y", "S2-13", 13)], "country string, cand_id string, key long")
    va = B.vectors(number(a), table, ["name"])
    vb = B.vectors(number(b.filter(~F.col("id").isin(list(first)))), table, ["name"])
    codes = [c for r in va.unionByName(vb).collect() for c in r["name"]]
    assert len({(c >> 32, c) for c in codes}) == len(set(codes)) and all(c >> 32 for c in codes)
    for k, cap in ((1, 9), (2, 9), (3, 2), (9, 9)):
        want = {(int(r.s1_id[3:]), r.cand_id, r.score, r["rank"]) for r in B.topk_join(a, b, table, k, cap).collect()}
        assert {(r.s1_key, r.cand_id, r.score, r["rank"]) for r in B.topk_vectors(va, vb, twins, "name", k, cap).collect()} == want
    pairs = twins.filter("country = 'x'").crossJoin(spark.createDataFrame([(i,) for i in s1], "s1_id string")).withColumn("s1_key", F.substr("s1_id", F.lit(4)).cast("long"))
    got = {(r.s1_id, r.cand_id): round(r.cos_name, 9) for r in B.rescore_vectors(pairs, va, vb, ["name"]).collect()}
    assert got == {(r.s1_id, r.cand_id): round(r.cos_name, 9) for r in B.rescore(pairs.select("s1_id", "cand_id"), a, b, table, ["name"]).collect()} and len(got) == 21


def test_ranked_candidates_read_stored_vectors(spark):
    """Words are counted and coded once; what joins and moves with pairs is codes, not words."""
    plan = entry.queries()["block_rescore_priority"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "feat#" not in plan and "Generate explode" not in plan


def test_alike_records_are_counted_and_coded_once(spark):
    """Codes hold the counts of all records that the firsts stand for, S1s count for none, and words move twice: by bucket and by record."""
    rows = [("x", 3, -2, "a b z"), ("x", 4, 3, "a b"), ("x", 7, 1, "b c"), ("y", 10, 1, "a")]
    feats = spark.createDataFrame([(c, i, m, "name", f) for c, i, m, t in rows for f in t.split()], "country string, id long, m long, grp string, feat string")
    sizes = spark.createDataFrame([("x", 4), ("y", 1)], "country string, n long")
    got = B.counted_vectors(feats, sizes, ["name"])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2 and "SortMergeJoin" not in plan
    assert {(r.country, r.id, r.m, r.n, tuple(c >> 32 for c in r["name"])) for r in got.collect()} == {("x", 3, 2, 4, (3, 4)), ("x", 4, 3, 4, (3, 4)), ("x", 7, 1, 4, (1, 4)), ("y", 10, 1, 1, (1,))}


def test_crowded_keys_count_alike_records(spark):
    a = spark.createDataFrame([("x", 3, "k"), ("x", 6, "l"), ("y", 9, "k")], "country string, s1_key long, same string")
    b = spark.createDataFrame([("x", 4, "k", 2), ("x", 7, "k", 1), ("x", 10, "l", 4)], "country string, key long, same string, m long")
    assert {tuple(r) for r in B.same_key_firsts(a, b, 3).collect()} == {(3, 4), (3, 7)}


def test_feedback_by_codes_is_that_by_words(spark, data):
    """Seeds' words come from stored vectors, the documents are not read anew, and the rows are those of the join by words."""
    got = entry.queries()["expand_feedback"](spark, data)
    assert "parquet" not in got._jdf.queryExecution().optimizedPlan().toString()
    s1, pool, table = records._features(spark, data)
    a, b = (B.weighted(x.filter("grp = 'name'"), table, "id", "grp") for x in (s1, pool))
    seeds = records._rescored(spark, data, "rank < 3 and priority >= 1.5").select("country", "s1_id", "cand_id")
    want = {(r.id, r.feat): r.w for r in B.expand(a, seeds, b).collect()}
    rows = got.collect()
    assert len(rows) == len(want) > 0 and all(abs(r.w - want[r.id, r.feat]) < 1e-6 for r in rows)
