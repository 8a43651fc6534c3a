"""Crowded keys keep all their pairs."""

from collections import Counter

from linkloom.operators import pairs as Q

SCHEMA = "entity_id string, source long, country string, name string, text string, name_tokens array<string>, address_tokens array<string>"


def _records(spark):
    rows = []
    for i in range(2500):
        name = ["acme", f"w{i % 7}", "ltd"] if i % 3 else ["acme", "ltd"]
        rows.append((f"S{1 + (i % 50 != 0)}-{i}", 1 + (i % 50 != 0), "x" if i % 10 else "y", "acme", "t", name, ["1", "high", "street"]))
    return rows, spark.createDataFrame(rows, SCHEMA)


def test_crowded_name(spark):
    rows, rec = _records(spark)
    want = {(a[0], b[0]) for a in rows for b in rows if a[1] == 1 < b[1] and a[2] == b[2]}
    got = Q.same_key(rec, "name").select("s1_id", "cand_id").collect()
    assert len(got) == len(want) and {tuple(r) for r in got} == want
    asked = spark.createDataFrame([*sorted(want)[:20], ("S1-0", "S2-1"), ("S1-0", "none")], "s1_id string, cand_id string")
    assert {tuple(r) for r in Q.not_same_key(asked, rec, "name").collect()} == {("S1-0", "none"), ("S1-0", "S2-1")} - want


def test_crowded_address(spark):
    rows, rec = _records(spark)
    want = Counter()
    for a in rows:
        for b in rows:
            if a[1] == 1 < b[1] and a[2] == b[2]:
                left, right = set(a[5]) - set(b[5]), set(b[5]) - set(a[5])
                if len(left) == len(right) == 1:
                    want[left.pop(), right.pop()] += 1
    assert want and {(r.x, r.y): r.n for r in Q.address_substitutions(rec).collect()} == want


def test_counters_of_a_crowded_address(spark):
    """20,000 records of each side at one address: 400 million pairs, counted from 40,000 rows."""
    from pyspark.sql import functions as F

    from linkloom.operators import audit as A

    n = 20_000
    rec = spark.range(2 * n).selectExpr("id % 2 + 1 as source", "'x' as country", "if(id < 2, array('acme', 'gmbh'), array('acme', 'acme')) as name_tokens", "'1 high street' as key")
    got = {r.token: (r.present, r.dropped) for r in A.counters_by_key(rec, F.col("key"), "name_tokens").collect()}
    assert got == {"acme": (n * n, 0), "gmbh": (2 * n - 1, 2 * n - 2)}


def test_counters_by_key_are_those_of_the_pairs(spark):
    from pyspark.sql import functions as F

    from linkloom.operators import audit as A

    rows = [(f"e{i}", 1 + i % 3, "xy"[i % 5 == 0], f"k{i % 4}", [f"w{i % 7}", f"w{i % 3}", "a"][: i % 4]) for i in range(60)]
    rec = spark.createDataFrame(rows, "entity_id string, source long, country string, key string, t array<string>")
    a, b = rec.filter("source = 1").selectExpr("country", "key", "t as a"), rec.filter("source > 1").selectExpr("country", "key", "t as b")
    want = A.mining_counters(a.join(b, ["country", "key"])).collect()
    assert sorted(A.counters_by_key(rec, F.col("key"), "t").collect()) == sorted(want)


def test_pairs_are_not_shuffled(spark, data):
    """The join that makes the pairs is the last one: nothing is joined to pairs afterwards."""
    from linkloom.plans import evidence, records  # noqa: F401
    from linkloom.plans.registry import QUERIES

    for name in ("pair_evidence", "pair_loop_features", "pair_signals", "name_frequency_features", "idf_overlap"):
        plan = QUERIES[name](spark, data)._jdf.queryExecution().executedPlan().toString().split("\n")
        assert "slice" in next(line for line in plan if "Join" in line), name


def test_first_candidates_of_a_crowded_address(spark):
    from pyspark.sql import functions as F

    from linkloom.operators import evidence as W

    _, rec = _records(spark)
    parsed = W.parsed(rec.withColumn("address", F.lit("1 high street")))
    pairs = W.attached(parsed, F.col("address_key")).select("s1_id", "cand_id").collect()
    by = {}
    for r in pairs:
        by.setdefault(r.s1_id, []).append(r.cand_id)
    got = W.first_attached(parsed, F.col("address_key"), 30).select("s1_id", "cand_id", "r", "n").collect()
    assert {tuple(x) for x in got} == {(s, c, k + 1, len(cs)) for s, cs in by.items() for k, c in enumerate(sorted(cs)[:30])}
