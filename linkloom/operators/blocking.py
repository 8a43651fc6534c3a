"""Candidate generation: frequency-capped equi-joins and IDF-cosine top-K joins, their union, re-scoring and ranking.

All joins have the country among their keys, since no true pair crosses countries. Features that are too
common in the pool are left out before any join, so a posting list has a bounded length; exact
cosines are computed afterwards for the union only.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

PASSES = ["exact_sorted", "exact_concat", "exact_alias", "sparse_comb", "sparse_name", "sparse_addr", "char_name", "char_addr", "sparse_phon", "noaddr_name", "nonlatin_phon", "expand_prf", "sparse_cross"]
BIT = {name: 1 << i for i, name in enumerate(PASSES)}
EXACT = BIT["exact_sorted"] | BIT["exact_concat"] | BIT["exact_alias"]
#: Defaults of the priority.
WEIGHTS = {"name": 1.0, "addr": 1.0, "cross": 0.5, "caddr": 0.5, "cname": 0.5, "exact": 0.25, "missing_addr_factor": 0.7}


def exact_pass(s1: DataFrame, pool: DataFrame, key: str, max_block: int = 5000, pool_key: str | None = None) -> DataFrame:
    """(country, s1_id, cand_id) with equal non-empty keys; keys with more than max_block pool records are dropped first."""
    b = pool.select("country", F.col("id").alias("cand_id"), F.col(pool_key or key).alias("key")).filter(F.coalesce(F.col("key"), F.lit("")) != "")
    sizes = b.groupBy("country", "key").agg(F.count("*").alias("n")).filter(F.col("n") <= max_block).drop("n")
    a = s1.select("country", F.col("id").alias("s1_id"), F.col(key).alias("key")).filter(F.coalesce(F.col("key"), F.lit("")) != "")
    return a.join(sizes, ["country", "key"]).join(b, ["country", "key"]).select("country", "s1_id", "cand_id")


def idf(pool: DataFrame, pool_sizes: DataFrame) -> DataFrame:
    """(country, grp, feat, df, n, idf) of pool(country, id, grp, feat): idf = ln((n + 1) / (df + 1)) + 1, n records in the country."""
    df = pool.groupBy("country", "grp", "feat").agg(F.count("*").alias("df"))
    return df.join(F.broadcast(pool_sizes), "country").withColumn("idf", F.log((F.col("n") + 1) / (F.col("df") + 1)) + 1)  # a row per country


def weighted(feats: DataFrame, table: DataFrame, *norm_by: str) -> DataFrame:
    """Features with their IDF as weight, of length 1 per norm_by (features the pool lacks count for nothing)."""
    w = feats.join(table.select("country", "grp", "feat", "idf"), ["country", "grp", "feat"])
    norm = Window.partitionBy(*norm_by)
    return w.withColumn("w", F.col("idf") / F.sqrt(F.sum(F.col("idf") * F.col("idf")).over(norm))).drop("idf")


def topk_join(s1: DataFrame, pool: DataFrame, table: DataFrame, k: int, max_df: int, groups: dict[str, float] | None = None) -> DataFrame:
    """(country, s1_id, cand_id, score, rank): the k candidates with the largest cosine over features of at most max_df pool records.

    With several groups the score is the sum of their cosines by the given weights.
    """
    capped = table.filter(F.col("df") <= max_df)
    if groups is not None:
        capped = capped.filter(F.col("grp").isin(list(groups)))
    a = weighted(s1, capped, "id", "grp").select("country", "grp", "feat", F.col("id").alias("s1_id"), F.col("w").alias("wa"))
    b = weighted(pool, capped, "id", "grp").select("country", "grp", "feat", F.col("id").alias("cand_id"), F.col("w").alias("wb"))
    for grp, weight in (groups or {}).items():
        if weight != 1.0:
            a = a.withColumn("wa", F.when(F.col("grp") == grp, F.col("wa") * weight).otherwise(F.col("wa")))
    shared = a.join(b, ["country", "grp", "feat"]).select("country", "s1_id", "cand_id", (F.col("wa") * F.col("wb")).alias("w"))
    # dealt by S1, so that sums and ranks need no further shuffle
    scored = shared.repartition("s1_id").groupBy("country", "s1_id", "cand_id").agg(F.round(F.sum("w"), 6).alias("score"))
    order = Window.partitionBy("s1_id").orderBy(F.desc("score"), "cand_id")
    return scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def expand(a: DataFrame, seeds: DataFrame, pool: DataFrame, alpha: float = 0.5) -> DataFrame:
    """Relevance feedback: each S1's features plus alpha times the mean of its seeds' (weights w), as (country, id, grp, feat, w)."""
    per = seeds.groupBy("s1_id").agg(F.count("*").alias("n"))
    added = seeds.join(pool.withColumnRenamed("id", "cand_id"), ["country", "cand_id"]).join(per, "s1_id")
    added = added.groupBy("country", F.col("s1_id").alias("id"), "grp", "feat").agg((alpha * F.sum(F.col("w") / F.col("n"))).alias("w"))
    own = a.join(seeds.select(F.col("s1_id").alias("id")).distinct(), "id", "left_semi").select("country", "id", "grp", "feat", "w")
    return own.unionByName(added).groupBy("country", "id", "grp", "feat").agg(F.sum("w").alias("w"))


def first_alike(rec: DataFrame, id_name: str, *same: str) -> DataFrame:
    """(id_name, first): the least id of the records(country, id) that agree in country and the strings `same`.

    S1s alike have the same candidates, equally ranked: these are found for the first and given to the others by `for_all`.
    Records without a country are left out; they have no candidates and are none.
    """
    key = F.sha2(F.concat_ws("\n", *[F.concat(F.lit(f"{c}:"), F.coalesce(F.col(c), F.lit(""))) for c in same]), 256)
    x = rec.select("country", F.col("id").alias(id_name), key.alias("key"))
    return x.join(x.groupBy("country", "key").agg(F.min(id_name).alias("first")), ["country", "key"]).select(id_name, "first")


def for_all(pairs: DataFrame, alike: DataFrame) -> DataFrame:
    """pairs of the first records, for every record like them."""
    return pairs.withColumnRenamed("s1_id", "first").join(alike, "first").drop("first").select(pairs.columns)


def looked_up(pairs: DataFrame, ranked: DataFrame, alike: DataFrame) -> DataFrame:
    """Those of pairs(s1_id, cand_id) that are candidates, with the columns of `ranked`, which holds the first records only."""
    return pairs.join(alike, "s1_id").join(ranked.drop("country").withColumnRenamed("s1_id", "first"), ["first", "cand_id"]).drop("first")


def union_passes(parts: dict[str, DataFrame]) -> DataFrame:
    """(country, s1_id, cand_id, passes): distinct pairs with a bit for each pass that found them."""
    tagged = [df.select("country", "s1_id", "cand_id", F.lit(BIT[name]).alias("bit")) for name, df in parts.items()]
    return reduce(DataFrame.unionByName, tagged).groupBy("country", "s1_id", "cand_id").agg(F.bit_or("bit").cast("long").alias("passes"))


def coded(feats: DataFrame, table: DataFrame, groups: list[str], id_name: str, prefix: str) -> DataFrame:
    """A row of each record: its features of each group as "df feature" strings, the length of the vector of their IDFs, and n."""
    x = feats.join(table.select("country", "grp", "feat", "df", "n", "idf"), ["country", "grp", "feat"]).withColumn("t", F.concat_ws(" ", F.col("df").cast("string"), "feat"))
    of = lambda g, c: F.when(F.col("grp") == g, c)
    lists = [F.sort_array(F.collect_list(of(g, F.col("t")))).alias(f"{prefix}_{g}") for g in groups]
    norms = [F.sqrt(F.sum(of(g, F.col("idf") * F.col("idf")))).alias(f"{prefix}_norm_{g}") for g in groups]
    return x.filter(F.col("grp").isin(groups)).groupBy(F.col("id").alias(id_name)).agg(F.max("n").alias(f"{prefix}_n"), *lists, *norms)


def rescore(pairs: DataFrame, s1: DataFrame, pool: DataFrame, table: DataFrame, groups: list[str], alike: DataFrame | None = None) -> DataFrame:
    """Add cos_<group>: cosines over all features with an IDF in the table for each pair; 0 where nothing is shared.

    A pair moves one list of features, not a row of each. With alike(cand_id, first, ...) an S1 is compared with the first of
    alike candidates only; further columns of it are added to the pairs.
    """
    known = pairs.withColumn("first", F.col("cand_id")) if alike is None else pairs.join(alike, "cand_id")
    each = known.select("s1_id", "first") if alike is None else known.select("s1_id", "first").distinct()
    both = each.join(coded(s1, table, groups, "s1_id", "a").drop("a_n"), "s1_id").join(coded(pool, table, groups, "first", "b"), "first")
    idf2 = lambda t: F.pow(F.log((F.col("b_n") + 1) / (F.substring_index(t, " ", 1).cast("long") + 1)) + 1, F.lit(2.0))
    dot = lambda g: F.aggregate(F.array_intersect(f"a_{g}", f"b_{g}"), F.lit(0.0), lambda s, t: s + idf2(t))
    cos = both.select("s1_id", "first", *[F.coalesce(dot(g) / (F.col(f"a_norm_{g}") * F.col(f"b_norm_{g}")), F.lit(0.0)).alias(f"cos_{g}") for g in groups])
    return known.join(cos, ["s1_id", "first"], "left").drop("first").na.fill(0.0, [f"cos_{g}" for g in groups])


#: Buckets in which features are numbered apart.
BUCKETS = 1 << 12


def numbered(table: DataFrame) -> DataFrame:
    """Add code, a long that is the feature's own among those of its country and group, with its df in the upper half.

    Features are numbered within buckets of their hash, so no task orders all of them.
    """
    x = table.withColumn("bucket", F.pmod(F.xxhash64("feat"), F.lit(BUCKETS)))
    place = F.row_number().over(Window.partitionBy("country", "grp", "bucket").orderBy("feat")).cast("long")
    return x.withColumn("code", F.shiftleft(F.col("df").cast("long"), 32) + place * BUCKETS + F.col("bucket")).drop("bucket")


def vectors(feats: DataFrame, table: DataFrame, groups: list[str]) -> DataFrame:
    """(country, id, n, <group>...): the codes of each record's features that the pool has, sorted, of feats(country, id, grp, feat)."""
    x = feats.join(numbered(table).select("country", "grp", "feat", "n", "code"), ["country", "grp", "feat"])
    lists = [F.sort_array(F.collect_list(F.when(F.col("grp") == g, F.col("code")))).alias(g) for g in groups]
    return x.groupBy("country", "id").agg(F.max("n").alias("n"), *lists)


def counted_vectors(feats: DataFrame, sizes: DataFrame, groups: list[str]) -> DataFrame:
    """`vectors`, with m, of feats(country, id, m, grp, feat): a record stands for |m| alike; m is below 0 outside the pool, where none counts.

    Words move once to be counted and numbered in their buckets, and their codes once to be gathered by record.
    """
    bucket = F.pmod(F.xxhash64("feat"), F.lit(BUCKETS))
    x = feats.repartition("country", "grp", bucket).withColumn("bucket", bucket)
    df = F.sum(F.greatest(F.col("m"), F.lit(0))).over(Window.partitionBy("country", "grp", "bucket", "feat"))
    place = F.dense_rank().over(Window.partitionBy("country", "grp", "bucket").orderBy("feat")).cast("long")
    x = x.withColumn("df", df).withColumn("place", place).filter("df > 0").withColumn("code", F.shiftleft("df", 32) + F.col("place") * BUCKETS + F.col("bucket"))
    lists = [F.sort_array(F.collect_list(F.when(F.col("grp") == g, F.col("code")))).alias(g) for g in groups]
    return x.groupBy("country", "id").agg(F.abs(F.max("m")).alias("m"), *lists).join(F.broadcast(sizes), "country")  # a row per country


def code_idf(code: Column, n: Column) -> Column:
    return F.log((n + 1) / (F.shiftright(code, 32) + 1)) + 1


def norm(codes: Column, n: Column) -> Column:
    return F.sqrt(F.aggregate(F.transform(codes, lambda c: code_idf(c, n)), F.lit(0.0), lambda s, x: s + x * x))


def code_number(code: Column) -> Column:
    """What `numbered` gives a feature without a count, among the same features."""
    return code.bitwiseAND(F.lit((1 << 32) - 1))


def weighted_codes(x: DataFrame, grp: str) -> DataFrame:
    """`weighted` of one group of vectors: (country, id, grp, feat, w), whose features are codes."""
    w = lambda c: F.struct(c.alias("feat"), (code_idf(c, F.col("n")) / F.col("norm")).alias("w"))
    x = x.select("country", "id", F.lit(grp).alias("grp"), "n", F.col(grp).alias("codes"), norm(F.col(grp), F.col("n")).alias("norm"))
    return x.select("country", "id", "grp", F.inline(F.transform("codes", w)).alias("feat", "w"))


def near_vectors(a: DataFrame, b: DataFrame, grp: str, k: int, max_df: int) -> DataFrame:
    """(s1_key, key, score): for each vector of an S1 the k of the pool with the largest cosine over features of at most max_df pool records, and all as good as the k-th."""
    rare = F.filter(F.col(grp), lambda c: F.shiftright(c, 32) <= max_df)

    def rows(x, id_name, w):
        x = x.select("country", F.col("id").alias(id_name), "n", rare.alias("codes")).withColumn("norm", norm(F.col("codes"), F.col("n")))
        return x.select("country", id_name, "n", "norm", F.explode("codes").alias("code")).select("country", id_name, "code", (code_idf(F.col("code"), F.col("n")) / F.col("norm")).alias(w))

    shared = rows(a, "s1_key", "wa").join(rows(b, "key", "wb"), ["country", "code"]).select("s1_key", "key", (F.col("wa") * F.col("wb")).alias("w"))
    scored = shared.repartition("s1_key").groupBy("s1_key", "key").agg(F.round(F.sum("w"), 6).alias("score"))
    return scored.withColumn("r", F.rank().over(Window.partitionBy("s1_key").orderBy(F.desc("score")))).filter(F.col("r") <= k).drop("r")


def topk_vectors(a: DataFrame, b: DataFrame, twins: DataFrame, grp: str, k: int, max_df: int) -> DataFrame:
    """topk_join over one group of the vectors of S1s and of the firsts of alike candidates(country, cand_id, first, ...): (country, s1_id, cand_id, score, rank).

    Ids of the vectors are any short keys; twins maps them to cand_id. The best k of all candidates are among those alike the best k
    firsts and those as good as the k-th.
    """
    return ranked_keys(near_vectors(a, b, grp, k, max_df).join(twins, "key"), k)


def ranked_keys(pairs: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("s1_key").orderBy(F.desc("score"), "cand_id")
    return pairs.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def same_key_firsts(a: DataFrame, b: DataFrame, max_block: int) -> DataFrame:
    """exact_pass of a(country, s1_key, same) and the firsts of alike candidates b(country, key, same, m), each of which counts for m: (s1_key, key)."""
    sizes = b.groupBy("country", "same").agg(F.sum("m").alias("n")).filter(F.col("n") <= max_block).drop("n")
    return a.join(sizes, ["country", "same"]).join(b, ["country", "same"]).select("s1_key", "key")


def cosines(pairs: DataFrame, a: DataFrame, b: DataFrame, groups: list[str]) -> DataFrame:
    """Add cos_<group> to pairs(s1_key, key, ...) of which both have a vector: cosines over all features; 0 where nothing is shared."""
    side = lambda x, key, p: x.select(F.col("id").alias(key), *[F.col(g).alias(f"{p}_{g}") for g in groups], *[norm(F.col(g), F.col("n")).alias(f"{p}_norm_{g}") for g in groups], *([F.col("n").alias("n_")] if p == "b" else []))
    both = pairs.join(side(a, "s1_key", "a"), "s1_key").join(side(b, "key", "b"), "key")
    dot = lambda g: F.aggregate(F.transform(F.array_intersect(f"a_{g}", f"b_{g}"), lambda c: code_idf(c, F.col("n_"))), F.lit(0.0), lambda s, x: s + x * x)
    return both.select(*pairs.columns, *[F.coalesce(dot(g) / F.nullif(F.col(f"a_norm_{g}") * F.col(f"b_norm_{g}"), F.lit(0.0)), F.lit(0.0)).alias(f"cos_{g}") for g in groups])


def rescore_vectors(pairs: DataFrame, a: DataFrame, b: DataFrame, groups: list[str]) -> DataFrame:
    """`cosines` for pairs(s1_key, key, ...) that may repeat or lack a vector: each two keys are compared once."""
    cos = cosines(pairs.select("s1_key", "key").distinct(), a, b, groups)
    return pairs.join(cos, ["s1_key", "key"], "left").na.fill(0.0, [f"cos_{g}" for g in groups])


def informativeness(a_norm: Column, median: Column, floor: float = 0.3) -> Column:
    return F.when(median > 0, F.greatest(F.lit(floor), F.least(F.lit(1.0), a_norm / median))).otherwise(1.0)


def priority(missing: Column, info: Column, w: dict[str, float] = WEIGHTS) -> Column:
    """Name evidence, address terms (imputed from it where the candidate has no address), glued names and exact keys."""
    cos = lambda g: F.col(f"cos_{g}")
    best = F.greatest(cos("name"), cos("phon"), cos("cphon"))
    evidence = best * info
    address = w["addr"] * cos("addr") + w["cross"] * cos("cross") + w["caddr"] * cos("caddr")
    imputed = w["missing_addr_factor"] * (w["addr"] + w["cross"] + w["caddr"]) * info * best
    exact = F.when(F.col("passes").bitwiseAND(EXACT) > 0, w["exact"] * info).otherwise(0.0)
    return w["name"] * evidence + F.when(missing, imputed).otherwise(address) + w["cname"] * cos("cname") * info + exact


def ranked(pairs: DataFrame, by: str, budget: int | None = None) -> DataFrame:
    """Add rank, from 0, by falling `by`, then candidate id; keep ranks below the budget."""
    order = Window.partitionBy("s1_id").orderBy(F.desc(by), "cand_id")
    out = pairs.withColumn("rank", (F.row_number().over(order) - 1).cast("long"))
    return out if budget is None else out.filter(F.col("rank") < budget)
