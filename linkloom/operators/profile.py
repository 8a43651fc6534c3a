"""Audits, profiles and reports over records (entity_id, source, country, name, address, name_tokens, address_tokens)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from linkloom.functions.text import missing_raw


def content_key() -> Column:
    return F.md5(F.concat_ws("|", F.col("name"), F.coalesce("address", F.lit("\u0001")), F.col("country")).cast("binary"))


def audit(rec: DataFrame, by: str) -> DataFrame:
    return rec.groupBy(by).agg(F.count("*").alias("n"), (F.count("*") - F.count_distinct("entity_id")).alias("dup_ids"), (F.count("*") - F.count_distinct(content_key())).alias("dup_content"), F.count_if(missing_raw(F.col("name"))).alias("missing_name"), F.count_if(missing_raw(F.col("address"))).alias("missing_address"), F.count_distinct("country").alias("countries"))


def truth_checks(truth: DataFrame, ids: DataFrame) -> DataFrame:
    per = truth.groupBy("matched_id").agg(F.count_distinct("s1_id").alias("n")).agg(F.count_if(F.col("n") > 1).alias("shared_ids"))
    unknown = truth.join(ids, truth.matched_id == ids.entity_id, "left_anti").agg(F.count("*").alias("unknown"))
    wrong = ~F.col("matched_id").startswith(F.concat(F.lit("S"), F.col("matched_source").cast("string"), F.lit("-")))
    facts = truth.agg(F.count("*").alias("pairs"), F.count_distinct("s1_id").alias("s1"), F.count_if(wrong).alias("wrong_prefix"))
    return facts.crossJoin(per).crossJoin(unknown)  # one row each


def match_bucket(n: Column) -> Column:
    return F.when(n == 0, "0").when(n == 1, "1").when(n <= 3, "2-3").otherwise("4+")


def country_mismatch(truth: DataFrame, rec: DataFrame) -> DataFrame:
    a = rec.select(F.col("entity_id").alias("s1_id"), "country")
    b = rec.select(F.col("entity_id").alias("matched_id"), F.col("country").alias("other"), "source")
    return truth.join(a, "s1_id").join(b, "matched_id").groupBy("country", "source").agg(F.count("*").alias("n"), F.count_if(F.col("country") != F.col("other")).alias("differ"))


def length_profile(rec: DataFrame, by: str) -> DataFrame:
    n = F.length("name")
    quantiles = [F.round(F.percentile(n, q), 6).alias(f"p{int(q * 100):02d}") for q in (0.05, 0.5, 0.95)]
    return rec.groupBy(by).agg(F.count("*").alias("n"), F.round(F.avg(n), 6).alias("mean_len"), *quantiles, F.round(F.avg(F.size("name_tokens")), 6).alias("mean_tokens"), F.round(F.avg(F.col("address").isNull().cast("double")), 6).alias("no_address"))


def missing_vs_matched(rec: DataFrame, truth: DataFrame) -> DataFrame:
    hit = truth.select(F.col("matched_id").alias("entity_id")).distinct().withColumn("matched", F.lit(1))
    return rec.join(hit, "entity_id", "left").na.fill(0, ["matched"]).groupBy("source", "country", "matched").agg(F.count("*").alias("n"), F.round(F.avg(F.col("address").isNull().cast("double")), 6).alias("no_address"))


def match_composition(s1: DataFrame, truth: DataFrame) -> DataFrame:
    n = truth.groupBy("s1_id").agg(F.count_if(F.col("matched_source") == 2).alias("a"), F.count_if(F.col("matched_source") == 3).alias("b"))
    kind = F.when((F.col("a") > 0) & (F.col("b") > 0), "both").when(F.col("a") > 0, "only_2").when(F.col("b") > 0, "only_3").otherwise("none")
    return s1.join(n, "s1_id", "left").na.fill(0, ["a", "b"]).groupBy(kind.alias("kind")).agg(F.count("*").alias("n"), F.sum(F.least(F.col("a") + F.col("b"), F.lit(5))).alias("capped_matches"))


def duplicate_groups(rec: DataFrame, truth: DataFrame) -> DataFrame:
    owner = truth.groupBy(F.col("matched_id").alias("entity_id")).agg(F.min("s1_id").alias("owner"))
    groups = rec.join(owner, "entity_id", "left").groupBy(content_key().alias("k")).agg(F.count("*").alias("n"), F.count_distinct("owner").alias("owners"), F.count_if(F.col("owner").isNull()).alias("free"), F.count_distinct("source").alias("sources")).filter("n > 1")
    kind = F.when(F.col("owners") == 0, "all_unmatched").when((F.col("owners") == 1) & (F.col("free") == 0), "same_s1").when(F.col("owners") == 1, "same_s1_plus_unmatched").otherwise("different_s1s")
    return groups.groupBy(kind.alias("kind"), "sources").agg(F.count("*").alias("groups"), F.sum("n").alias("records"))


def document_frequency(rec: DataFrame, tokens: str) -> DataFrame:
    return rec.select("country", F.explode(F.array_distinct(tokens)).alias("token")).groupBy("country", "token").agg(F.count("*").alias("df"))


def top(df: DataFrame, k: int, by: str, tie: str, *within: str) -> DataFrame:
    order = Window.partitionBy(*within).orderBy(F.desc(by), tie)
    return df.withColumn("r_", F.row_number().over(order)).filter(F.col("r_") <= k).drop("r_")


def coverage(truth: DataFrame, rec: DataFrame, df: DataFrame, caps: list[int]) -> DataFrame:
    """Share of true pairs whose rarest shared token has a document frequency within each cap."""
    a = rec.select(F.col("entity_id").alias("s1_id"), "country", F.col("name_tokens").alias("an"))
    b = rec.select(F.col("entity_id").alias("matched_id"), F.col("name_tokens").alias("bn"))
    shared = truth.select("s1_id", "matched_id").join(a, "s1_id").join(b, "matched_id").select("s1_id", "matched_id", "country", F.explode_outer(F.array_intersect("an", "bn")).alias("token"))
    rarest = shared.join(df, ["country", "token"], "left").groupBy("s1_id", "matched_id").agg(F.min("df").alias("rarest"))
    steps = F.explode(F.array(*map(F.lit, caps))).alias("cap")
    return rarest.select("rarest", steps).groupBy("cap").agg(F.round(F.avg(F.coalesce(F.col("rarest") <= F.col("cap"), F.lit(False)).cast("double")), 6).alias("covered"))


def edge_tokens(rec: DataFrame, k: int) -> DataFrame:
    edges = F.explode(F.array(F.struct(F.lit("first").alias("edge"), F.element_at("name_tokens", 1).alias("token")), F.struct(F.lit("last").alias("edge"), F.element_at("name_tokens", -1).alias("token")))).alias("x")
    counts = rec.filter(F.size("name_tokens") >= 2).select("country", edges).groupBy("country", "x.edge", "x.token").agg(F.count("*").alias("n"))
    return top(counts, k, "n", "token", "country", "edge")


def tail_positions(rec: DataFrame) -> DataFrame:
    """(token, present, tail): records with the token, and those of two tokens or more with it in one of the last two places."""
    present = rec.select(F.explode(F.array_distinct("name_tokens")).alias("token"), F.lit(1).alias("present"), F.lit(0).alias("tail"))
    tail = rec.filter(F.size("name_tokens") >= 2).select(F.explode(F.array_distinct(F.slice("name_tokens", -2, 2))).alias("token"), F.lit(0).alias("present"), F.lit(1).alias("tail"))
    return present.unionByName(tail).groupBy("token").agg(F.sum("present").alias("present"), F.sum("tail").alias("tail"))


def decide_suffixes(stats: DataFrame, like: Column, n_names: int, least_share: float = 0.003, least_tail: float = 0.85) -> DataFrame:
    """Tokens that behave like legal suffixes: alphabetic, alike one, frequent enough and mostly at the end."""
    return stats.filter(F.col("token").rlike("^[a-z]+$") & like & (F.col("present") >= least_share * n_names) & (F.col("tail") >= least_tail * F.col("present")))


def merge_maps(hand: dict[str, str], mined: dict[str, str]) -> dict[str, str]:
    """Hand-made entries win; entries that would reverse another go, chains lead to their end, cycles are dropped."""
    joint = {k: v for k, v in mined.items() if hand.get(v) != k} | hand
    out = {}
    for k in joint:
        seen, v = {k}, joint[k]
        while v in joint and v not in seen:
            seen.add(v)
            v = joint[v]
        if v not in seen:
            out[k] = v
    return out


def block_sizes(s1: DataFrame, pool: DataFrame, key: str) -> DataFrame:
    b = pool.groupBy("country", key).agg(F.count("*").alias("n"))
    n = F.coalesce("n", F.lit(0))
    return s1.join(b, ["country", key], "left").groupBy("country").agg(F.round(F.avg(F.col("n").isNotNull().cast("double")), 6).alias("hit_rate"), F.round(F.percentile(n, 0.99), 6).alias("p99"), F.max(n).alias("largest"))


def recall_by_budget(ranked: DataFrame, truth: DataFrame, budgets: list[int]) -> DataFrame:
    probe = truth.select("s1_id", F.col("matched_id").alias("cand_id")).join(ranked, ["s1_id", "cand_id"], "left")
    each = probe.select("s1_id", "rank", F.explode(F.array(*map(F.lit, budgets))).alias("budget")).groupBy("budget", "s1_id").agg(F.count_if(F.coalesce(F.col("rank") < F.col("budget"), F.lit(False))).alias("found"), F.count("*").alias("n"))
    return each.groupBy("budget").agg(F.round(F.sum("found") / F.sum("n"), 6).alias("pair_recall"), F.round(F.avg(F.col("found") / F.col("n")), 6).alias("s1_recall"), F.round(F.avg((F.col("found") == F.col("n")).cast("double")), 6).alias("all_found"))


def reduction(ranked: DataFrame, rec: DataFrame, budgets: list[int]) -> DataFrame:
    sizes = rec.groupBy("country").agg(F.count_if(F.col("source") == 1).alias("a"), F.count_if(F.col("source") > 1).alias("b")).agg(F.sum(F.col("a") * F.col("b")).alias("all_pairs"))
    kept = ranked.select("rank", F.explode(F.array(*map(F.lit, budgets))).alias("budget")).groupBy("budget").agg(F.count_if(F.col("rank") < F.col("budget")).alias("n"))
    return kept.crossJoin(sizes).select("budget", F.round(1 - F.col("n") / F.col("all_pairs"), 6).alias("reduction"))  # one row of sizes


def pass_recall(union: DataFrame, truth: DataFrame, bits: list[int]) -> DataFrame:
    t = truth.select("s1_id", F.col("matched_id").alias("cand_id")).join(union.select("s1_id", "cand_id", "passes"), ["s1_id", "cand_id"], "left").na.fill(0, ["passes"])
    each = t.select("passes", F.explode(F.array(*[F.lit(b).cast("long") for b in bits])).alias("bit"))
    return each.groupBy("bit").agg(F.round(F.avg((F.col("passes").bitwiseAND(F.col("bit")) > 0).cast("double")), 6).alias("alone"), F.round(F.avg((F.col("passes") == F.col("bit")).cast("double")), 6).alias("only"))


def gates(rec: DataFrame) -> DataFrame:
    wrong = ~F.col("entity_id").startswith(F.concat(F.lit("S"), F.col("source").cast("string"), F.lit("-")))
    facts = rec.agg((F.count("*") - F.count_distinct("entity_id")).alias("a"), F.count_if(wrong).alias("b"), F.count_if(F.size("name_tokens") == 0).alias("c"))
    rows = facts.select(F.expr("stack(3, 'unique_ids', a, 'prefix', b, 'empty_name', c) as (gate, violations)"))
    return rows.withColumn("level", F.when(F.col("violations") == 0, "PASS").when(F.col("gate") == "empty_name", "WARN").otherwise("FAIL"))


def segment_coverage(truth: DataFrame, rec: DataFrame) -> DataFrame:
    """Share of true pairs with a common name token: in all, by country, and by country and source, in one pass."""
    a = rec.select(F.col("entity_id").alias("s1_id"), "country", F.col("name_tokens").alias("an"))
    b = rec.select(F.col("entity_id").alias("matched_id"), "source", F.col("name_tokens").alias("bn"))
    hit = (F.size(F.array_intersect("an", "bn")) > 0).cast("double")
    m = truth.select("s1_id", "matched_id").join(a, "s1_id").join(b, "matched_id").withColumn("hit", hit)
    return m.groupingSets([[], ["country"], ["country", "source"]], "country", "source").agg(F.count("*").alias("n"), F.round(F.avg("hit"), 6).alias("covered"))


def numbered(df: DataFrame, by: str, digest: Column) -> DataFrame:
    """Add i, from 0, in the order of a hex digest within each `by`; rows are numbered in slices of the digest's first two digits, to which the slices before are added."""
    sliced = df.withColumn("digest_", digest).withColumn("slice_", F.substring("digest_", 1, 2))
    sizes = sliced.groupBy(by, "slice_").agg(F.count("*").alias("n_"))
    before = Window.partitionBy(by).orderBy("slice_").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(by, "slice_", F.coalesce(F.sum("n_").over(before), F.lit(0)).alias("offset_"))  # at most 256 rows for each `by`
    own = F.row_number().over(Window.partitionBy(by, "slice_").orderBy("digest_")) - 1
    return sliced.withColumn("own_", own).join(offsets, [by, "slice_"]).withColumn("i", (F.col("own_") + F.col("offset_")).cast("long")).drop("digest_", "slice_", "own_", "offset_")


def random_negatives(rec: DataFrame, truth: DataFrame) -> DataFrame:
    """For each S1 one pool record of its country, picked by hash from a numbered pool; true pairs are left out."""
    pool = numbered(rec.filter("source > 1").select("country", F.col("entity_id").alias("cand_id")), "country", F.md5(F.col("cand_id").cast("binary")))
    sizes = pool.groupBy("country").agg(F.count("*").alias("n"))
    number = F.conv(F.substring(F.md5(F.concat("entity_id", F.lit(":neg")).cast("binary")), 1, 8), 16, 10).cast("long")
    s1 = rec.filter("source = 1").join(sizes, "country").select("country", F.col("entity_id").alias("s1_id"), (number % F.col("n")).alias("i"))
    return s1.join(pool, ["country", "i"]).select("s1_id", "cand_id").join(truth.select("s1_id", F.col("matched_id").alias("cand_id")), ["s1_id", "cand_id"], "left_anti")


def sample(df: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """Exactly n rows (or all), by hash: the same ones on every run."""
    return df.orderBy(F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")).cast("binary")), key).limit(n)
