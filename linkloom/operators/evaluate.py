"""Evaluation, reports, group context and sampling over scored pairs (s1_id, cand_id, p, label)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from linkloom.functions.numbers import rounded


def loss_parts(scored: DataFrame) -> DataFrame:
    """(part, n_s1, loss): what each kind of S1 takes from a perfect macro F0.5; the losses add up to 1 - F."""
    part = F.when((F.col("n_true") == 0) & (F.col("npred") > 0), "singleton_predicted").when((F.col("n_true") > 0) & (F.col("npred") == 0), "all_missed").when((F.col("tp") == 0) & (F.col("npred") > 0), "all_wrong").when(F.col("f") < 1, "partial").otherwise("perfect")
    sums = scored.groupBy(part.alias("part")).agg(F.count("*").alias("n_s1"), F.sum(1 - F.col("f")).alias("lost"))
    return sums.select("part", "n_s1", F.round(F.col("lost") / F.sum("n_s1").over(Window.partitionBy()), 6).alias("loss"))  # a row per part


def fp_ownership(fp: DataFrame, owner: DataFrame, is_val: Column, is_scored: Column) -> DataFrame:
    kind = F.when(F.col("owner").isNull(), "no_owner").when(is_val, "owner_is_val").when(is_scored, "owner_is_scored_train").otherwise("owner_is_unscored_train")
    return _shares(fp.join(owner, "cand_id", "left").groupBy(kind.alias("kind")).agg(F.count("*").alias("n")))


def _shares(counts: DataFrame, *within: str) -> DataFrame:
    return counts.withColumn("share", F.round(F.col("n") / F.sum("n").over(Window.partitionBy(*within)), 6))


def error_categories(errors: DataFrame) -> DataFrame:
    return _shares(errors.groupBy("kind", "category").agg(F.count("*").alias("n")), "kind")


def one_to_one_removals(df: DataFrame, by: str, t: float = 0.5) -> DataFrame:
    """Share of confident claims that lose their record to a better claim."""
    best = Window.partitionBy("cand_id").orderBy(F.desc("p"), "s1_id")
    placed = df.withColumn("r", F.row_number().over(best)).filter(F.col("p") >= t)
    return placed.groupBy(by).agg(F.round(F.avg((F.col("r") > 1).cast("double")), 6).alias("removed"), F.count("*").alias("n"))


def ks(a: DataFrame, b: DataFrame, value: str, slices: int = 1024) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov statistic, exact.

    Equal values are summed up, values are dealt to slices of their range, and only the slices' sums go through one
    ordered pass; inside a slice the running sums start from what lies below it.
    """
    both = a.select(F.col(value).alias("v"), F.lit(1).alias("a"), F.lit(0).alias("b")).unionByName(b.select(F.col(value).alias("v"), F.lit(0).alias("a"), F.lit(1).alias("b")))
    steps = both.filter(F.col("v").isNotNull()).groupBy("v").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    span = steps.agg(F.min("v").alias("low"), F.max("v").alias("high"))
    place = F.when(F.col("high") > F.col("low"), F.floor((F.col("v") - F.col("low")) / (F.col("high") - F.col("low")) * slices)).otherwise(0)
    steps = steps.crossJoin(F.broadcast(span)).withColumn("slice", place).drop("low", "high")  # one row
    below, whole = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    sums = steps.groupBy("slice").agg(F.sum("a").alias("sa"), F.sum("b").alias("sb"))
    sums = sums.select("slice", F.coalesce(F.sum("sa").over(below), F.lit(0)).alias("a0"), F.coalesce(F.sum("sb").over(below), F.lit(0)).alias("b0"), F.sum("sa").over(whole).alias("na"), F.sum("sb").over(whole).alias("nb"))
    run = Window.partitionBy("slice").orderBy("v")
    joined = steps.join(F.broadcast(sums), "slice")  # at most slices + 1 rows
    gap = F.abs((F.col("a0") + F.sum("a").over(run)) / F.col("na") - (F.col("b0") + F.sum("b").over(run)) / F.col("nb"))
    return joined.withColumn("gap", gap).agg(F.round(F.max("gap"), 6).alias("ks"))


def lists(ids: DataFrame, pred: DataFrame, by: str) -> DataFrame:
    """(s1_id, matches): comma lists by falling score, empty where nothing is predicted."""
    items = F.sort_array(F.collect_list(F.struct((-F.col(by)).alias("o"), F.col("cand_id"))))
    got = pred.groupBy("s1_id").agg(F.array_join(F.transform(items, lambda x: x["cand_id"].cast("string")), ",").alias("matches"))
    return ids.join(got, "s1_id", "left").withColumn("matches", F.coalesce("matches", F.lit("")))


def submission_checks(pred: DataFrame, ids: DataFrame, known: DataFrame) -> DataFrame:
    """Counts of repeated pairs, unknown candidates, S1s that should not be there, and S1s without a match."""
    repeated = pred.groupBy("s1_id", "cand_id").count().filter("count > 1").agg(F.count("*").alias("repeated"))
    unknown = pred.join(known, "cand_id", "left_anti").agg(F.count("*").alias("unknown"))
    extra = pred.join(ids, "s1_id", "left_anti").agg(F.count_distinct("s1_id").alias("extra_s1"))
    empty = ids.join(pred, "s1_id", "left_anti").agg(F.count("*").alias("empty_s1"))
    return repeated.crossJoin(unknown).crossJoin(extra).crossJoin(empty)  # one row each


def group_context(df: DataFrame, p: str) -> DataFrame:
    s, o = Window.partitionBy("s1_id"), Window.partitionBy("s1_id").orderBy(F.desc(p), "cand_id")
    x = df.withColumn("best_", F.max(p).over(s)).withColumn("ratio_", F.col(p) / (F.col("best_") + 1e-6))
    return x.select("s1_id", "cand_id", F.count("*").over(s).alias("n_cands"), (F.row_number().over(o) - 1).cast("long").alias("rank"), F.round(F.col("best_") - F.col(p), 6).alias("gap_to_best"), rounded(F.col("ratio_")).alias("ratio"), F.sum((F.col("ratio_") > 0.8).cast("long")).over(s).alias("n_strong"))


def relative(df: DataFrame, p: str) -> DataFrame:
    s = Window.partitionBy("s1_id")
    return df.withColumn("z", (F.col(p) - F.avg(p).over(s)) / (F.coalesce(F.stddev_samp(p).over(s), F.lit(0.0)) + 1e-6)).withColumn("ratio", F.col(p) / (F.max(p).over(s) + 1e-9))


def rivals(df: DataFrame, p: str) -> DataFrame:
    """Best, summed and confident other candidates of the same S1."""
    s, o = Window.partitionBy("s1_id"), Window.partitionBy("s1_id").orderBy(F.desc(p), "cand_id")
    whole = o.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    second = F.nth_value(p, 2).over(whole)
    sure = (F.col(p) > 0.5).cast("long")
    return df.select("s1_id", "cand_id", F.round(F.coalesce(F.when(F.row_number().over(o) == 1, second).otherwise(F.max(p).over(s)), F.lit(0.0)), 6).alias("max_other"), F.round(F.sum(p).over(s) - F.col(p), 6).alias("sum_other"), (F.sum(sure).over(s) - sure).alias("n_conf_other"))


def sampled_negatives(df: DataFrame, hard: int, random: int) -> DataFrame:
    """All positives and hard negatives with weight 1, and a hash sample of the rest, weighted so that the weights add up to all of them."""
    o = Window.partitionBy("s1_id").orderBy(F.desc("p"), "cand_id")
    r = df.withColumn("rank", F.row_number().over(o) - 1)
    rest = r.filter((F.col("label") == 0) & (F.col("rank") >= hard))
    pick = Window.partitionBy("s1_id").orderBy(F.md5(F.concat_ws(":", F.col("s1_id").cast("string"), F.col("cand_id").cast("string")).cast("binary")))
    drawn = rest.withColumn("pick", F.row_number().over(pick)).withColumn("n_rest", F.count("*").over(Window.partitionBy("s1_id"))).filter(F.col("pick") <= random)
    kept = r.filter((F.col("label") == 1) | (F.col("rank") < hard)).select("s1_id", "cand_id", "label", F.lit(1.0).alias("weight"))
    return kept.unionByName(drawn.select("s1_id", "cand_id", "label", (F.col("n_rest") / F.least(F.col("n_rest"), F.lit(random))).alias("weight")))


def crc_bucket(c: Column, n: int = 100) -> Column:
    return F.crc32(c.cast("string").cast("binary")) % n


def hash_buckets(ids: DataFrame, folds: int = 3) -> DataFrame:
    """bucket (of 100), half (by another hash) and fold (bucket modulo the folds) of each id."""
    half = crc_bucket(F.concat(F.lit("half:"), F.col("s1_id").cast("string")), 2)
    return ids.select("s1_id", crc_bucket(F.col("s1_id")).alias("bucket"), half.alias("half"), (crc_bucket(F.col("s1_id")) % folds).alias("fold"))


def stratified_split(df: DataFrame, stratum: str, share: float) -> DataFrame:
    """Add split: the share of each stratum (half to even) with the least id hashes is 'val'."""
    o = Window.partitionBy(stratum).orderBy(F.md5(F.col("s1_id").cast("string").cast("binary")), "s1_id")
    n = F.count("*").over(Window.partitionBy(stratum))
    return df.withColumn("split", F.when(F.row_number().over(o) <= F.bround(n * F.lit(share), 0), "val").otherwise("train"))


def oracle_by_budget(df: DataFrame, truth: DataFrame, p: str, budgets: list[int]) -> DataFrame:
    """(budget, recall, oracle_f05): what a perfect matcher could reach with so many candidates of each S1."""
    steps = F.broadcast(df.sparkSession.createDataFrame([(b,) for b in budgets], "budget int"))
    ranked = df.withColumn("k", F.row_number().over(Window.partitionBy("s1_id").orderBy(F.desc(p), "cand_id")))
    found = ranked.join(steps, F.col("k") <= F.col("budget")).groupBy("s1_id", "budget").agg(F.sum("label").alias("found"))
    each = truth.crossJoin(steps).join(found, ["s1_id", "budget"], "left").na.fill(0, ["found"])
    each = each.withColumn("r", F.when(F.col("n_true") == 0, 1.0).otherwise(F.col("found") / F.col("n_true")))
    f = F.when(F.col("n_true") == 0, 1.0).otherwise(1.25 * F.col("r") / (0.25 + F.col("r")))
    return each.groupBy("budget").agg(F.round(F.avg("r"), 6).alias("recall"), F.round(F.avg(f), 6).alias("oracle_f05"))


def blend(kinds: list[list[DataFrame]]) -> DataFrame:
    """Mean over the seeds of a kind, then over the kinds."""
    tagged = [df.select("s1_id", "cand_id", "p", F.lit(i).alias("kind")) for i, seeds in enumerate(kinds) for df in seeds]
    by_kind = reduce(DataFrame.unionByName, tagged).groupBy("s1_id", "cand_id", "kind").agg(F.avg("p").alias("p"))
    return by_kind.groupBy("s1_id", "cand_id").agg(F.avg("p").alias("p"))
