"""TSV parsing, table sinks and the streaming extension."""

import pytest

from linkloom.sources import tables as S
from linkloom.streaming import incremental


def test_tsv(spark, tmp_path):
    p = tmp_path / "a.tsv"
    p.write_text('entity_id\tbusiness_name\tbusiness_address\tcountry\textra\nS1-1\t"Acme\tx\tUS\t\nS1-2\tN/A\t\tUS\t1\n\nS1-3\tB "q" C\ty\tFR\t\n')
    df, info = S.read_tsv(spark, str(p))
    assert (info["rows"], info["lines"], info["extra"], info["unquoted"], info["warning"]) == (3, 3, ["extra"], True, False)
    got = {r.entity_id: r.business_name for r in df.collect()}
    assert got == {"S1-1": '"Acme', "S1-2": "N/A", "S1-3": 'B "q" C'}
    with pytest.raises(S.ParseError):
        S.read_tsv(spark, str(p), ["entity_id", "nope"])


def test_tables(spark, tmp_path):
    df = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], "id string, v int, part string")
    S.write_table(df, str(tmp_path / "t"), "part")
    S.write_table(df.filter("part = 'x'").withColumn("v", df.v + 10), str(tmp_path / "t"), "part")
    assert sorted((r.id, r.v) for r in S.read_table(spark, str(tmp_path / "t"), ["id", "v"]).collect()) == [("a", 11), ("b", 2)]
    assert S.keyed(df, "id").count() == 2
    with pytest.raises(Exception, match="repeated key"):
        S.keyed(df.union(df), "id").collect()


def test_truth(spark):
    wide = spark.createDataFrame([("S1-1", "S2-5, S3-7"), ("S1-2", ""), ("S1-3", None)], "source1_entity_id string, matched_entity_ids string")
    assert sorted(tuple(r) for r in S.truth_long(wide).collect()) == [("S1-1", "S2-5", "2"), ("S1-1", "S3-7", "3")]


def test_incremental(spark, tmp_path):
    schema = "country string, id string, sorted_key string, concat string"
    pool = spark.createDataFrame([("x", "p", "a b", "ab"), ("x", "q", "c", "c")], schema)
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    for key in ("a b", "c"):
        spark.createDataFrame([("x", f"s-{key}", key, key.replace(" ", ""))], schema).write.mode("append").parquet(src)
        incremental.start(spark.readStream.schema(schema).parquet(src), pool, out, str(tmp_path / "cp")).awaitTermination()
    got = spark.read.parquet(out)
    assert sorted((r.s1_id, r.cand_id, r.passes) for r in got.collect()) == [("s-a b", "p", 3), ("s-c", "q", 3)]
    assert got.select("batch").distinct().count() == 2
