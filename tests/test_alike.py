"""Records alike share their candidates, and pairs of the same texts are compared once."""

import math

import pytest

from linkloom.operators import blocking as B
from linkloom.operators import evidence as W


def test_candidates_are_given_to_all_alike(spark):
    rec = spark.createDataFrame([("x", "s1", "a b"), ("x", "s2", "a b"), ("y", "s3", "a b"), ("x", "s4", "b a"), (None, "s5", "a b")], "country string, id string, name string")
    alike = B.first_alike(rec, "s1_id", "name")
    assert {tuple(r) for r in alike.collect()} == {("s1", "s1"), ("s2", "s1"), ("s3", "s3"), ("s4", "s4")}
    ranked = spark.createDataFrame([("x", "s1", "c1", 0), ("x", "s1", "c2", 1)], "country string, s1_id string, cand_id string, rank int")
    assert {(r.s1_id, r.cand_id, r["rank"]) for r in B.for_all(ranked, alike).collect()} == {("s1", "c1", 0), ("s1", "c2", 1), ("s2", "c1", 0), ("s2", "c2", 1)}
    pairs = spark.createDataFrame([("s2", "c2"), ("s3", "c2"), ("s5", "c2")], "s1_id string, cand_id string")
    assert [(r.s1_id, r.cand_id, r["rank"]) for r in B.looked_up(pairs, ranked, alike).collect()] == [("s2", "c2", 1)]


def test_cosines_of_alike_candidates(spark):
    """Rare and common words, two groups, and a candidate whose cosines are its twin's."""
    feats = lambda rows: spark.createDataFrame([("x", i, g, f) for i, g, fs in rows for f in fs.split()], "country string, id string, grp string, feat string")
    s1 = feats([("s", "name", "a b"), ("s", "addr", "q")])
    pool = feats([("c1", "name", "a"), ("c1", "addr", "q"), ("c3", "name", "z")])
    counts = [("x", "name", "a", 1), ("x", "name", "b", 9), ("x", "name", "z", 3), ("x", "addr", "q", 2)]
    table = spark.createDataFrame([(*c, 9, math.log(10 / (c[3] + 1)) + 1) for c in counts], "country string, grp string, feat string, df long, n long, idf double")
    pairs = spark.createDataFrame([("s", "c1"), ("s", "c2"), ("s", "c3")], "s1_id string, cand_id string")
    twins = spark.createDataFrame([("c1", "c1", 1), ("c2", "c1", 2), ("c3", "c3", 3)], "cand_id string, first string, more int")
    got = {r.cand_id: (r.cos_name, r.cos_addr, r.more) for r in B.rescore(pairs, s1, pool, table, ["name", "addr"], twins).collect()}
    rare = math.log(5) + 1
    like = pytest.approx(rare / (rare**2 + 1) ** 0.5)
    assert got == {"c1": (like, pytest.approx(1.0), 1), "c2": (like, pytest.approx(1.0), 2), "c3": (0.0, 0.0, 3)}


def test_same_texts_are_compared_once(spark):
    """Nine pairs of three and three equal texts: one comparison."""
    from linkloom.functions.text import fold, tokens

    ids = ["S1-1", "S1-4", "S1-7", "S2-1", "S2-4", "S2-7"]
    df = spark.createDataFrame([(i, int(i[1]), "x", "red fox", "1 high street", f"{i[:2]} red fox\n1 high street") for i in ids], "entity_id string, source long, country string, name string, address string, text string")
    rec = W.parsed(df.withColumn("name_tokens", tokens(fold(df.name))).withColumn("address_tokens", tokens(fold(df.address))))
    pairs = spark.createDataFrame([(a, b, f"{a}{b}") for a in ids[:3] for b in ids[3:]], "s1_id string, cand_id string, tag string")
    seen = []

    def f(both):
        seen.append(both.count())
        return W.signals(both)

    got = W.compared(pairs, rec, f).collect()
    assert seen == [1] and len(got) == 9 and all(r.sorted_key_eq and r.same_address and r.tag == r.s1_id + r.cand_id for r in got)


def test_two_addresses_are_compared_once(spark, monkeypatch):
    """Three S1s and four candidates of one name: two pairs of addresses, twelve of records; long lists are cut."""
    from linkloom.operators import pairs as Q

    rows = [(f"S1-{i}", 1, ["x"]) for i in range(3)] + [(f"S2-{i}", 2, ["x"] if i else ["y"]) for i in range(4)] + [("S2-9", 2, ["x"])]
    rec = spark.createDataFrame([(i, s, None if i == "S2-9" else "c", "n", "t", ["n"], a) for i, s, a in rows], "entity_id string, source long, country string, name string, text string, name_tokens array<string>, address_tokens array<string>")
    got = Q.same_key_alike(rec, "name", "address_tokens").collect()
    assert {(r.a, r.b, len(r.s1_ids), len(r.cand_ids)) for r in got} == {("x", "x", 3, 3), ("x", "y", 3, 1)}
    monkeypatch.setattr(Q, "SLICE", 2)
    got = Q.same_key_alike(rec, "name", "address_tokens").collect()
    pairs = [(s, c) for r in got for s in r.s1_ids for c in r.cand_ids]
    assert max(len(x) for r in got for x in (r.s1_ids, r.cand_ids)) == 2 and len(pairs) == len(set(pairs)) == 12


def test_best_window_is_that_of_all_windows():
    """A few steps for long strings, and the same result as trying every window."""
    import random

    from linkloom.functions import similarity as S

    rng = random.Random(5)
    for _ in range(300):
        a, b = ("".join(rng.choice("abc ") for _ in range(rng.randint(1, 14))) for _ in range(2))
        x, y = sorted((a, b), key=len)
        assert S.best_window(a, b) == max(S.indel(x, y[max(0, i) : i + len(x)]) for i in range(1 - len(x), len(y)) if i + len(x) > 0)
    assert S.best_window("ab" * 50000, "ab" * 50000 + "c") == 1.0


def test_errors_parse_their_own_records(spark, data, monkeypatch):
    from linkloom.plans import audits, registry

    seen, parsed = [], audits.W.parsed
    monkeypatch.setattr(audits.W, "parsed", lambda rec: (seen.append(rec.count()), parsed(rec))[1])
    n = sum(r.n for r in registry.QUERIES["error_categories"](spark, data).collect())
    assert len(seen) == 1 and 0 < seen[0] <= 2 * n and seen[0] < spark.read.parquet(f"{data}/documents.parquet").count()
