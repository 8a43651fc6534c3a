"""Audits of cleaning and mining, split tables, precision by flag and the categories of errors."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.functions import text as T
from linkloom.operators.profile import top

APOSTROPHE_SIGNS = "['’‘ʼ`´]"


def split_crosstab(ids: DataFrame, *by: str) -> DataFrame:
    """Rows of ids(..., split) in each cell of `by`, with a column for each side of the split."""
    side = lambda name: F.count_if(F.col("split") == name).alias(name)
    return ids.groupBy(*by).agg(side("train"), side("val"))


def _missing(rec: DataFrame, field: str) -> DataFrame:
    """How many values are blank, and how many say in words or signs that there is none."""
    raw, folded = F.col(field), F.array_join(f"{field}_tokens", " ")
    blank = F.trim(F.coalesce(raw, F.lit(""))) == ""
    kinds = rec.select(F.when(blank, "blank").when(T.missing_folded(folded), "placeholder").alias("value")).filter("value is not null")
    return kinds.groupBy("value").agg(F.count("*").alias("n")).select(F.lit("missing").alias("section"), F.lit(field).alias("field"), "value", "n")


def _frequent(values: DataFrame, section: str, field: str, k: int) -> DataFrame:
    counts = values.groupBy("value").agg(F.count("*").alias("n"))
    # the k most frequent of all: every task sends its own first ones
    return counts.orderBy(F.desc("n"), "value").limit(k).select(F.lit(section).alias("section"), F.lit(field).alias("field"), "value", "n")


def _touched(rec: DataFrame, field: str) -> DataFrame:
    """How many values each cleaning rule has something to do in."""
    raw = F.coalesce(field, F.lit(""))
    rules = {"ampersand": raw.contains("&"), "apostrophe": raw.rlike(APOSTROPHE_SIGNS), "non_ascii": ~raw.rlike(r"^[\x00-\x7F]*$"), "upper_case": F.lower(raw) != raw, "digit": raw.rlike("[0-9]")}
    facts = rec.agg(*[F.count_if(c).alias(name) for name, c in rules.items()])
    pairs = ", ".join(f"'{name}', {name}" for name in rules)
    return facts.select(F.expr(f"stack({len(rules)}, {pairs}) as (value, n)")).select(F.lit("touched").alias("section"), F.lit(field).alias("field"), "value", "n")


def cleaning_audit(rec: DataFrame, fields: tuple[str, ...] = ("name", "address"), values: int = 30, signs: int = 40, compounds: int = 15) -> DataFrame:
    """(section, field, value, n): missing values by kind, the most frequent folded values, signs that cleaning removes, values that each rule touches, and the numeric compounds of each country."""
    parts = []
    for field in fields:
        folded = F.array_join(f"{field}_tokens", " ")
        parts += [
            _missing(rec, field),
            _frequent(rec.select(folded.alias("value")).filter(~T.missing_folded(F.col("value"))), "value", field, values),
            _frequent(rec.select(F.explode(F.regexp_extract_all(F.coalesce(field, F.lit("")), F.lit(r"([\p{P}\p{S}])"), 1)).alias("value")), "sign", field, signs),
            _touched(rec, field),
        ]
    found = rec.select("country", F.explode(T.numeric_compounds(F.col(fields[-1]))).alias("value")).groupBy("country", "value").agg(F.count("*").alias("n"))
    parts.append(top(found, compounds, "n", "value", "country").select(F.concat(F.lit("compound:"), "country").alias("section"), F.lit(fields[-1]).alias("field"), "value", "n"))
    return reduce(DataFrame.unionByName, parts)


def mining_counters(pairs: DataFrame) -> DataFrame:
    """(country, token, present, dropped): true pairs with the token on any side, and on one side only; from pairs(country, a, b) of token arrays."""
    token = lambda a, name: pairs.select("country", F.explode(a).alias("token"), F.lit(int(name == "present")).alias("present"), F.lit(int(name == "dropped")).alias("dropped"))
    either = token(F.array_union("a", "b"), "present")
    one = token(F.concat(F.array_except("a", "b"), F.array_except("b", "a")), "dropped")
    return either.unionByName(one).groupBy("country", "token").agg(F.sum("present").alias("present"), F.sum("dropped").alias("dropped"))


def counters_by_key(rec: DataFrame, key: Column, column: str) -> DataFrame:
    """mining_counters over all pairs of one country with an equal key, from counts for each key and token: no pair is made.

    Of the na * nb pairs of a key, a and b of whose records have the token, it is on no side of (na - a) * (nb - b) and on both of a * b.
    """
    first, other = F.col("source") == 1, F.col("source") > 1
    # keys are whole addresses: their digests travel with the tokens, and only of keys that have pairs
    keyed = rec.select("country", F.unhex(F.md5(key.cast("binary"))).alias("key"), "source", F.array_distinct(column).alias("tokens"))
    sizes = keyed.groupBy("country", "key").agg(F.count_if(first).alias("na"), F.count_if(other).alias("nb")).filter("na > 0 and nb > 0")
    held = keyed.join(sizes, ["country", "key"], "left_semi").select("country", "key", "source", F.explode("tokens").alias("token")).groupBy("country", "key", "token").agg(F.count_if(first).alias("a"), F.count_if(other).alias("b"))
    each = held.join(sizes, ["country", "key"])
    return each.groupBy("country", "token").agg(F.sum(F.expr("na * nb - (na - a) * (nb - b)")).alias("present"), F.sum(F.expr("a * (nb - b) + (na - a) * b")).alias("dropped"))


def precision_by_flag(df: DataFrame, flags: dict[str, Column]) -> DataFrame:
    """(flag, n_pred, precision, n_true, recall) over the pairs(label, pred) that have each flag."""
    listed = F.explode(F.array(*[F.struct(F.lit(name).alias("flag"), c.alias("on")) for name, c in flags.items()])).alias("x")
    each = df.select("label", "pred", listed).filter("x.on")
    hit = F.count_if(F.col("pred") & (F.col("label") == 1))
    predicted, true = F.count_if("pred"), F.count_if(F.col("label") == 1)
    share = lambda n: F.when(n > 0, F.round(hit / n, 6))
    return each.groupBy("x.flag").agg(predicted.alias("n_pred"), share(predicted).alias("precision"), true.alias("n_true"), share(true).alias("recall"))


def error_category(name_link: Column, name_ratio: Column, address_ratio: Column, address_overlap: Column, number_conflict: Column, no_address: Column, cross_script: Column) -> Column:
    """What a wrong pair looks like; the first that holds. name_ratio of 0.8 or more also links names."""
    linked = name_link | (name_ratio >= 0.8)
    return (
        F.when(no_address & linked, "addr_missing_name_similar").when(no_address, "addr_missing_name_different").when(cross_script, "cross_script")
        .when(~linked & (address_overlap > 0), "name_replaced_address_links").when((name_ratio >= 0.9) & (address_ratio < 0.5), "same_name_other_address")
        .when(number_conflict, "number_conflict").otherwise("similar_name_and_address")
    )


def error_report(df: DataFrame) -> DataFrame:
    """(kind, category, n, on_singleton, mean_rank) of the errors in df(label, pred, category, n_true, rank): fn and fp."""
    kind = F.when((F.col("label") == 1) & ~F.col("pred"), "fn").when((F.col("label") == 0) & F.col("pred"), "fp")
    errors = df.withColumn("kind", kind).filter("kind is not null")
    return errors.groupBy("kind", "category").agg(F.count("*").alias("n"), F.count_if(F.col("n_true") == 0).alias("on_singleton"), F.round(F.avg("rank"), 6).alias("mean_rank"))


def gate_verdict(gates: DataFrame) -> DataFrame:
    """One row: how many gates passed, warned and failed, and READY if none failed."""
    n = lambda level: F.count_if(F.col("level") == level)
    return gates.agg(n("PASS").alias("passed"), n("WARN").alias("warned"), n("FAIL").alias("failed")).withColumn("verdict", F.when(F.col("failed") == 0, "READY").otherwise("NOT READY"))


def config_gates(spark, words: dict[str, list[str]], maps: dict[str, dict[str, str]], known: Callable[[str], bool] = str.isalnum) -> DataFrame:
    """(gate, violations, level) of the word lists: words that no token can be, words listed twice, map targets that are keys again, and entries that map to themselves."""
    checks = {
        "unreachable_words": sum(not known(w) or w != w.lower() for ws in words.values() for w in ws),
        "repeated_words": sum(len(ws) - len(set(ws)) for ws in words.values()),
        "chained_entries": sum(v in m for m in maps.values() for v in m.values()),
        "entries_to_themselves": sum(k == v for m in maps.values() for k, v in m.items()),
    }
    rows = [(name, n, "PASS" if not n else "WARN" if name == "chained_entries" else "FAIL") for name, n in checks.items()]
    return spark.createDataFrame(rows, "gate string, violations long, level string")
