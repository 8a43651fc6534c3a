"""Bindings of the linkage schema to the analytics tables.

Records: one per document; the source number comes from the id, the country from the
language, the name is the first line and the address the last one (missing for a single line).
Scored pairs: one per distinct (order, part) of the line items.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.functions.text import fold, tokens


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """entity_id, source, country, name, address, with folded token arrays."""
    d = read(spark, sf_dir, "documents")
    source = (1 + F.col("doc_id") % 3).cast("long")
    rows = d.select(
        "doc_id",
        F.concat(F.lit("S"), source.cast("string"), F.lit("-"), F.col("doc_id").cast("string")).alias("entity_id"),
        source.alias("source"),
        F.col("lang").alias("country"),
        F.substring_index("text", "\n", 1).alias("name"),
        F.when(F.col("text").contains("\n"), F.substring_index("text", "\n", -1)).alias("address"),
        "text",
    )
    return rows.withColumn("name_tokens", tokens(fold(F.col("name")))).withColumn("address_tokens", tokens(fold(F.col("address"))))


def truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """s1_id, matched_id, matched_source: records of source 1 and of the others with equal text."""
    d = read(spark, sf_dir, "documents").select("doc_id", "text").withColumn("source", (1 + F.col("doc_id") % 3).cast("long")).withColumn("key", F.sha2("text", 256))
    d = d.withColumn("id", F.concat(F.lit("S"), F.col("source").cast("string"), F.lit("-"), F.col("doc_id").cast("string"))).select("id", "source", "key")
    one = d.filter("source = 1").select(F.col("id").alias("s1_id"), "key")
    rest = d.filter("source > 1").select(F.col("id").alias("matched_id"), F.col("source").alias("matched_source"), "key")
    return one.join(rest, "key").drop("key")


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """s1_id, cand_id, p in (0, 1), label, grp: one row per distinct pair."""
    li = read(spark, sf_dir, "lineitem")
    p = 0.02 + 0.9 * (F.col("l_discount") * 4 + F.col("l_tax") * 3 + F.col("l_quantity") / 100)
    rows = li.select(F.col("l_orderkey").alias("s1_id"), F.col("l_partkey").alias("cand_id"), F.round(F.least(p, F.lit(0.98)), 4).alias("p"), (F.col("l_returnflag") == "R").cast("int").alias("label"), (F.col("l_linestatus") == "O").cast("int").alias("grp"))
    return rows.groupBy("s1_id", "cand_id").agg(F.max("p").alias("p"), F.max("label").alias("label"), F.max("grp").alias("grp"))


def true_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """s1_id, n_true for every order, with or without line items."""
    found = pairs(spark, sf_dir).groupBy("s1_id").agg(F.sum("label").cast("long").alias("n_true"))
    return read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("s1_id")).join(found, "s1_id", "left").na.fill(0, ["n_true"])


#: The same bindings in the SQL of the checks.
RECORDS_SQL = r"""
ent as (select doc_id, 'S' || (1 + doc_id % 3) || '-' || doc_id as entity_id, cast(1 + doc_id % 3 as bigint) as source, lang as country,
  split_part(text, chr(10), 1) as name, case when contains(text, chr(10)) then string_split(text, chr(10))[-1] end as address, text from documents),
rec as (select *, list_filter(string_split(regexp_replace(lower(replace(coalesce(name, ''), '&', ' and ')), '[^\p{L}\p{M}\p{N}]+', ' ', 'g'), ' '), lambda x: x <> '') as nt,
  list_filter(string_split(regexp_replace(lower(replace(coalesce(address, ''), '&', ' and ')), '[^\p{L}\p{M}\p{N}]+', ' ', 'g'), ' '), lambda x: x <> '') as ad from ent)
"""
TRUTH_SQL = """
truth as (select a.entity_id as s1_id, b.entity_id as matched_id, b.source as matched_source from ent a join ent b on a.text = b.text where a.source = 1 and b.source > 1)
"""
PAIRS_SQL = """
pairs as (select l_orderkey as s1_id, l_partkey as cand_id, max(round(least(0.02 + 0.9 * (l_discount * 4 + l_tax * 3 + l_quantity / 100), 0.98), 4)) as p,
  max(case when l_returnflag = 'R' then 1 else 0 end) as label, max(case when l_linestatus = 'O' then 1 else 0 end) as grp from lineitem group by 1, 2)
"""
COUNTS_SQL = """
counts as (select o_orderkey as s1_id, cast(coalesce(n, 0) as bigint) as n_true from orders left join (select s1_id, sum(label) as n from pairs group by 1) t on t.s1_id = o_orderkey)
"""
