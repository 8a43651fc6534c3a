"""Rounding of products that lie at a half of the last decimal, held against the SQL's."""

import duckdb
from pyspark.sql import functions as F

from linkloom.functions.numbers import rounded
from linkloom.operators import blocking as B


def test_halves(spark):
    values = [k * 1e-6 + 5e-7 for k in range(250_000, 254_000)] + [0.3 * (k * 1e-6 + 5e-6) for k in range(0, 40_000, 10)]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in values], "x double").select(rounded(F.col("x"))).collect()]
    con = duckdb.connect()
    want = [con.execute("select list_transform(?::double[], lambda x: round(x, 6))", [values]).fetchone()[0]][0]
    assert got == want


def test_priority_is_summed_as_the_sql_does(spark):
    """A candidate without an address: 0.7 * info * cos, from the left."""
    rows = [(0.3 + i * 1e-4, 0.000005 + i * 1e-5) for i in range(4000)]
    df = spark.createDataFrame(rows, "info double, cos_name double").withColumn("passes", F.lit(0)).withColumns({f"cos_{c}": F.lit(0.0) for c in ("addr", "phon", "cphon", "cross", "caddr", "cname")})
    got = [r[0] for r in df.select(rounded(B.priority(F.lit(True), F.col("info"), {**B.WEIGHTS, "cross": 0.0, "caddr": 0.0}))).collect()]
    con = duckdb.connect()
    assert got == [con.execute("select round(?::double * ?::double + 0.7 * ?::double * ?::double + 0, 6)", [i, c, i, c]).fetchone()[0] for i, c in rows]
