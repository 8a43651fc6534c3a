"""Shards, reports, side tables and the command line."""

import gzip
import json

import pytest

from linkloom import __main__ as cli
from linkloom.operators import audit as A
from linkloom.operators import ranker as K
from linkloom.operators import rules as U
from linkloom.sources import shards as H
from linkloom.sources import tables as S


def test_shards_resume(spark, tmp_path):
    root, made = str(tmp_path / "s"), []

    def make(name):
        made.append(name)
        return spark.range(name + 1)

    assert H.list_shards(spark, root) == []
    assert len(H.run_shards(spark, root, [0, 1], make)) == 2 and len(H.run_shards(spark, root, [0, 1, 2], make)) == 1
    assert made == [0, 1, 2] and [p[-5:] for p in H.list_shards(spark, root)] == ["00000", "00001", "00002"]
    (tmp_path / "s" / "00001" / "_SUCCESS").unlink()
    assert not H.shard_done(spark, H.shard_path(root, 1)) and len(H.run_shards(spark, root, [0, 1, 2], make)) == 1
    H.reset_from(spark, root, ["00000", "00001", "00002"], "00001")
    assert [p[-5:] for p in H.list_shards(spark, root)] == ["00000"]


def test_summary_and_side_table(spark, tmp_path):
    c = spark.createDataFrame([("a", "x", 0, 3), ("a", "y", 1, 1), ("b", "z", 0, 2)], "s1_id string, cand_id string, rank long, passes long")
    t = spark.createDataFrame([("a", "y"), ("a", "q"), ("c", "z")], "s1_id string, matched_id string")
    counts, found = H.shard_summary(c, t)
    assert {r.s1_id: r.n for r in counts.collect()} == {"a": 2, "b": 1}
    assert sorted((r.s1_id, r.cand_id, r.rank, r.passes) for r in found.collect()) == [("a", "q", -1, 0), ("a", "y", 1, 1)]
    (tmp_path / "t.tsv").write_text("s1_id\tn\textra\nNA\t3\tx\n\t4\ty\n")
    assert sorted((r.s1_id, r.n) for r in H.side_table(spark, str(tmp_path / "t.tsv"), {"s1_id": "string", "n": "int"}).collect()) == [("", 4), ("NA", 3)]
    with pytest.raises(ValueError, match="lacks"):
        H.side_table(spark, str(tmp_path / "t.tsv"), {"nope": "string"})


def test_report(spark, tmp_path):
    H.write_report(spark, {"ids": spark.range(60)}, str(tmp_path / "r"))
    assert json.loads((tmp_path / "r" / "report.json").read_text())["ids"]["rows"] == 60
    assert "(50 of 60 rows)" in (tmp_path / "r" / "report.md").read_text()


@pytest.mark.parametrize(("step", "options"), [("split", []), ("profile", []), ("clean", []), ("audit", []), ("represent", []), ("validate", []), ("regamma", ["--gammas", "1", "1.3"])])
def test_command_line(spark, data, tmp_path, step, options):
    assert cli.main([step, data, str(tmp_path), *options], spark) in (0, 1)
    out = tmp_path / step
    if step in ("profile", "audit", "validate"):
        assert (out / "report.md").read_text().startswith("## ")
    else:
        assert spark.read.parquet(str(out)).count() > 0


def test_prepare(spark, tmp_path):
    for k in (1, 2):
        (tmp_path / f"{k}.tsv").write_text(f"entity_id\tbusiness_name\tbusiness_address\tcountry\nS{k}-1\tA\tb\tUS\n")
    assert cli.main(["prepare", str(tmp_path / "out"), f"train:1={tmp_path}/1.tsv", f"train:2={tmp_path}/2.tsv"], spark) == 0
    assert sorted((r.entity_id, r.split, r.source) for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [("S1-1", "train", 1), ("S2-1", "train", 2)]


def test_rules(spark):
    rows = [("a", "x", 0.9, 1, 0), ("b", "x", 0.6, 0, 0), ("c", "y", 0.55, 1, 1)]
    df = spark.createDataFrame(rows, "s1_id string, cand_id string, p double, label int, grp int")
    kept = lambda r: {x.s1_id for x in U.apply_rule(df, r).filter("pred").collect()}
    assert kept(U.Rule()) == {"a", "b", "c"} and kept(U.Rule(one_to_one="hard")) == {"a", "c"} and kept(U.Rule(t0=0.7, t1=0.5)) == {"a", "c"}
    assert kept(U.Rule("expected_f")) == {"a", "b", "c"}
    with pytest.raises(ValueError, match="no such rule"):
        U.apply_rule(df, U.Rule("other"))
    counts = spark.createDataFrame([("a", 1), ("b", 0), ("c", 1)], "s1_id string, n_true long")
    t0, t1, f05 = U.tune_grouped(df, counts)
    assert (t0, t1, f05) == (0.625, 0.05, 1.0)


def test_gates(spark):
    bad = A.config_gates(spark, {"w": ["ok", "no way", "ok"]}, {"m": {"a": "b", "b": "b"}})
    assert {r.gate: (r.violations, r.level) for r in bad.collect()} == {"unreachable_words": (1, "FAIL"), "repeated_words": (1, "FAIL"), "chained_entries": (2, "WARN"), "entries_to_themselves": (1, "FAIL")}
    assert A.gate_verdict(bad).first().verdict == "NOT READY"
    assert A.gate_verdict(bad.filter("level = 'WARN'")).first().verdict == "READY"


def test_cache_is_made_anew_if_rows_differ(spark, tmp_path):
    path, made = str(tmp_path / "c"), []

    def make(n):
        made.append(n)
        return spark.range(n)

    assert H.cached(spark, path, lambda: make(5), 5).count() == H.cached(spark, path, lambda: make(5), 5).count() == 5 and made == [5]
    assert H.cached(spark, path, lambda: make(7), 7).count() == 7 and made == [5, 7]


def test_gzip_lists(spark, tmp_path):
    S.write_lists(spark.createDataFrame([("a", "x,y"), ("b", "")], "s1_id string, matches string").coalesce(1), str(tmp_path / "l"), "gzip")
    (part,) = (tmp_path / "l").glob("*.gz")
    assert gzip.decompress(part.read_bytes()).decode().splitlines() == ["s1_id\tmatches", "a\tx,y", "b\t"]


def test_early_stopping_and_missing_features(spark, tmp_path):
    rows = [(i, float(i % 7), float((i * 37) % 11), int((i % 7 > 3) != ((i * 7919) % 10 < 3))) for i in range(400)]  # noise: more rounds gain nothing
    df = spark.createDataFrame(rows, "s1_id long, a double, b double, label int")
    short = K.fit(df, ["a", "b"], rounds=20, holdout=20)
    assert short.stages[-1].getNumTrees < 20
    K.save(short, str(tmp_path / "m"))
    again = K.load(str(tmp_path / "m"))
    assert K.score(again, df).filter("score between 0 and 1").count() == 400
    with pytest.raises(ValueError, match="'b'"):
        K.score(again, df.drop("b"))
