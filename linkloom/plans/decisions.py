"""Queries of the decision layer: scored pairs to matches, their evaluation and reports."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from linkloom.operators import decide as D
from linkloom.operators import evaluate as E
from linkloom.plans.registry import query
from linkloom.sources.entities import COUNTS_SQL, PAIRS_SQL, pairs, read, true_counts

P = f"with {PAIRS_SQL}"
PC = f"with {PAIRS_SQL}, {COUNTS_SQL}"
F05 = "case when n_true = 0 then case when npred = 0 then 1.0 else 0.0 end when npred = 0 then 0.0 else 1.25 * tp / (0.25 * n_true + npred) end"
#: Pairs predicted at 0.5 and their per-S1 figures.
PRED = f"""{PC}, hits as (select s1_id, cast(sum(label) as bigint) as tp, count(*) as npred from pairs where p >= 0.5 group by 1),
per as (select c.s1_id, n_true, cast(coalesce(tp, 0) as bigint) as tp, coalesce(npred, 0) as npred from counts c left join hits h on h.s1_id = c.s1_id),
sc as (select *, {F05} as f from per)"""


def _predicted(spark, d, t: float = 0.5):
    return pairs(spark, d).withColumn("pred", F.col("p") >= t)


@query("one_to_one_hard", f"{P} select s1_id, cand_id, case when row_number() over (partition by cand_id order by p desc, s1_id) = 1 then p else 0.0 end as p from pairs")
def _(spark, d):
    return D.one_to_one(pairs(spark, d)).select("s1_id", "cand_id", "p")


@query("one_to_one_soft", f"{P} , o as (select *, greatest(1e-6, least(p, 1 - 1e-6)) as c from pairs) select s1_id, cand_id, round((c / (1 - c)) / (1 + sum(c / (1 - c)) over (partition by cand_id)), 6) as p from o")
def _(spark, d):
    return D.soft_one_to_one(pairs(spark, d)).select("s1_id", "cand_id", F.round("p", 6).alias("p"))


@query("decide_threshold_grouped", f"{P} select s1_id, cand_id, p, grp from pairs where case when grp = 1 then p >= 0.6 else p >= 0.45 end")
def _(spark, d):
    return pairs(spark, d).filter(D.threshold(F.col("p"), 0.45, F.col("grp"), 0.6)).select("s1_id", "cand_id", "p", F.col("grp").cast("int").alias("grp"))


EXPECTED = f"""{P}, a as (select *, least(p, 1 - 1e-6) as c, row_number() over (partition by s1_id order by p desc, cand_id) as k from pairs),
b as (select *, sum(c) over (partition by s1_id order by k rows unbounded preceding) as cum, sum(c) over (partition by s1_id) as tot, exp(sum(ln(1 - c)) over (partition by s1_id) - 0.1) as none from a),
s as (select *, round(1.25 * cum / (0.25 * (tot + 0.1) + k), 9) as score from b), m as (select *, max(score) over (partition by s1_id) as best from s),
n as (select *, min(case when score >= best - 1e-12 then k end) over (partition by s1_id) as kb from m)
select s1_id, cand_id, p, best > round(none, 9) and k <= kb as pred from n"""


@query("decide_expected_f", EXPECTED)
def _(spark, d):
    return D.expected_f(pairs(spark, d), mu=0.1).select("s1_id", "cand_id", "p", "pred")


@query("decide_exact_f")
def _(spark, d):
    return D.decide_exact_f(pairs(spark, d), mu=0.1)


@query("gamma_sharpen", f"{P} select s1_id, cand_id, round(pow(p, case when grp = 1 then 1.35 else 1.15 end), 6) as q from pairs")
def _(spark, d):
    return pairs(spark, d).select("s1_id", "cand_id", F.round(F.pow("p", F.when(F.col("grp") == 1, 1.35).otherwise(1.15)), 6).alias("q"))


@query("gamma_alignment")
def _(spark, d):
    df = pairs(spark, d)
    other = df.filter("grp = 0")
    target = other.filter("p >= 0.5").count() / max(1, other.select("s1_id").distinct().count())
    g = D.gamma_for_target(df.filter("grp = 1"), target, 0.5)
    return spark.range(1).select(F.round(F.lit(g), 6).alias("gamma"), F.round(F.lit(target), 6).alias("target"))


@query("calibration_bins", f"{P}, q as (select quantile_cont(p, [0.05,0.1,0.15,0.2,0.25,0.3,0.35,0.4,0.45,0.5,0.55,0.6,0.65,0.7,0.75,0.8,0.85,0.9,0.95]) as e from pairs), e as (select list_sort(list_distinct(e)) as e from q) select cast(len(list_filter(e.e, lambda x: x < p)) as bigint) as bin, count(*) as n, round(avg(p), 6) as mean_p, round(avg(label), 6) as mean_y from pairs, e group by 1")
def _(spark, d):
    return D.calibration_bins(pairs(spark, d)).select("bin", "n", F.round("mean_p", 6).alias("mean_p"), F.round("mean_y", 6).alias("mean_y"))


@query("calibrate_apply")
def _(spark, d):
    df = pairs(spark, d)
    return df.select("s1_id", "cand_id", F.round(D.calibrated(F.col("p"), D.fit_calibration(df, 40)), 6).alias("q"))


GRID = [round(0.2 + 0.05 * i, 2) for i in range(16)]
CURVE = f"""{PC}, g as (select unnest({GRID}) as t), h as (select s1_id, t, cast(sum(label) as bigint) as tp, count(*) as npred from pairs, g where p >= t group by 1, 2),
per as (select c.s1_id, g.t, n_true, coalesce(tp, 0) as tp, coalesce(npred, 0) as npred from counts c cross join g left join h on h.s1_id = c.s1_id and h.t = g.t)
select cast(t as double) as t, round(avg({F05}), 6) as f05 from per group by 1"""


@query("threshold_curve", CURVE)
def _(spark, d):
    return D.threshold_curve(pairs(spark, d), true_counts(spark, d), GRID)


@query("threshold_grid_best", f"select t, f05 from ({CURVE}) order by f05 desc, t limit 1")
def _(spark, d):
    return D.threshold_curve(pairs(spark, d), true_counts(spark, d), GRID).orderBy(F.desc("f05"), "t").limit(1)


@query("macro_f05", f"{PRED} select round(avg(f), 6) as f05, round(avg(case when npred = 0 then case when n_true = 0 then 1.0 else 0.0 end else tp / npred end), 6) as precision, round(avg(case when n_true = 0 then 1.0 else tp / n_true end), 6) as recall, count(*) as n_s1 from sc")
def _(spark, d):
    return D.macro(D.per_s1(_predicted(spark, d), true_counts(spark, d)))


@query("loss_decomposition", f"""{PRED}, l as (select *, case when n_true = 0 and npred > 0 then 'singleton_predicted' when n_true > 0 and npred = 0 then 'all_missed' when tp = 0 and npred > 0 then 'all_wrong' when f < 1 then 'partial' else 'perfect' end as part from sc)
select part, count(*) as n_s1, round(sum(1 - f) / (select count(*) from sc), 6) as loss from l group by 1""")
def _(spark, d):
    return E.loss_parts(D.per_s1(_predicted(spark, d), true_counts(spark, d)))


@query("fp_ownership", f"""{P}, own as (select cand_id, min(s1_id) as owner from pairs where label = 1 group by 1), fp as (select * from pairs where p >= 0.5 and label = 0),
c as (select case when owner is null then 'no_owner' when owner % 5 = 0 then 'owner_is_val' when owner % 5 in (1, 2) then 'owner_is_scored_train' else 'owner_is_unscored_train' end as kind from fp left join own using (cand_id))
select kind, count(*) as n, round(count(*) / (select count(*) from c), 6) as share from c group by 1""")
def _(spark, d):
    df = pairs(spark, d)
    owner = df.filter("label = 1").groupBy("cand_id").agg(F.min("s1_id").alias("owner"))
    return E.fp_ownership(df.filter("p >= 0.5 and label = 0"), owner, F.col("owner") % 5 == 0, (F.col("owner") % 5).isin(1, 2))


@query("one_to_one_removals", f"{P}, b as (select grp, p, row_number() over (partition by cand_id order by p desc, s1_id) as r from pairs) select grp, round(avg(case when r > 1 then 1.0 else 0.0 end), 6) as removed, count(*) as n from b where p >= 0.5 group by 1")
def _(spark, d):
    return E.one_to_one_removals(pairs(spark, d), "grp")


@query("ks_statistic", f"""{P}, v as (select p, count(*) filter (grp = 0) as a, count(*) filter (grp = 1) as b from pairs group by 1),
w as (select sum(a) over (order by p) / sum(a) over () as fa, sum(b) over (order by p) / sum(b) over () as fb from v) select round(max(abs(fa - fb)), 6) as ks from w""")
def _(spark, d):
    df = pairs(spark, d)
    return E.ks(df.filter("grp = 0"), df.filter("grp = 1"), "p")


@query("submission_lists", f"{PC} select c.s1_id, coalesce(l.matches, '') as matches from counts c left join (select s1_id, string_agg(cast(cand_id as varchar), ',' order by p desc, cand_id) as matches from pairs where p >= 0.5 group by 1) l on l.s1_id = c.s1_id")
def _(spark, d):
    return E.lists(true_counts(spark, d).select("s1_id"), _predicted(spark, d).filter("pred"), "p")


@query("submission_checks", f"""{PC}, pred as (select * from pairs where p >= 0.5)
select (select count(*) from (select s1_id, cand_id from pred group by 1, 2 having count(*) > 1)) as repeated, (select count(*) from pred where cand_id not in (select p_partkey from part)) as unknown,
(select count(distinct s1_id) from pred where s1_id not in (select s1_id from counts)) as extra_s1, (select count(*) from counts where s1_id not in (select s1_id from pred)) as empty_s1""")
def _(spark, d):
    return E.submission_checks(_predicted(spark, d).filter("pred"), true_counts(spark, d), read(spark, d, "part").select(F.col("p_partkey").alias("cand_id")))


@query("prediction_stats", f"""{PRED}, u as (select s1_id, avg(case when p > 0.2 and p < 0.8 then 1.0 else 0.0 end) as uncertain from pairs group by 1)
select o_orderpriority as segment, round(avg(npred), 6) as matches_per_s1, round(avg(case when npred = 0 then 1.0 else 0.0 end), 6) as share_empty, round(avg(uncertain), 6) as uncertain from sc join orders on o_orderkey = sc.s1_id left join u on u.s1_id = sc.s1_id group by 1""")
def _(spark, d):
    df = _predicted(spark, d)
    scored = D.per_s1(df, true_counts(spark, d)).join(read(spark, d, "orders").select(F.col("o_orderkey").alias("s1_id"), F.col("o_orderpriority").alias("segment")), "s1_id")
    unsure = df.groupBy("s1_id").agg(F.avg(((F.col("p") > 0.2) & (F.col("p") < 0.8)).cast("double")).alias("uncertain"))
    return scored.join(unsure, "s1_id", "left").groupBy("segment").agg(F.round(F.avg("npred"), 6).alias("matches_per_s1"), F.round(F.avg((F.col("npred") == 0).cast("double")), 6).alias("share_empty"), F.round(F.avg("uncertain"), 6).alias("uncertain"))


@query("error_examples", f"{P}, e as (select s1_id, cand_id, p, label, row_number() over (partition by label, grp order by abs(p - label) desc, s1_id, cand_id) as r, grp from pairs) select label, grp, s1_id, cand_id, p from e where r <= 15")
def _(spark, d):
    order = Window.partitionBy("label", "grp").orderBy(F.desc(F.abs(F.col("p") - F.col("label"))), "s1_id", "cand_id")
    return pairs(spark, d).withColumn("r", F.row_number().over(order)).filter("r <= 15").select("label", "grp", "s1_id", "cand_id", "p")


CONTEXT = f"""{P}, w as (select *, count(*) over s as n_cands, max(p) over s as best, row_number() over (partition by s1_id order by p desc, cand_id) - 1 as rank from pairs window s as (partition by s1_id))
select s1_id, cand_id, n_cands, rank, round(best - p, 6) as gap_to_best, round(p / (best + 1e-6), 6) as ratio, sum(case when p / (best + 1e-6) > 0.8 then 1 else 0 end) over (partition by s1_id) as n_strong from w"""


@query("group_context_features", f"select s1_id, cand_id, n_cands, cast(rank as bigint) as rank, gap_to_best, ratio, cast(n_strong as bigint) as n_strong from ({CONTEXT})")
def _(spark, d):
    return E.group_context(pairs(spark, d), "p")


@query("relative_zscore", f"{P} select s1_id, cand_id, round((p - avg(p) over s) / (coalesce(stddev_samp(p) over s, 0) + 1e-6), 4) as z, round(p / (max(p) over s + 1e-9), 6) as ratio from pairs window s as (partition by s1_id)")
def _(spark, d):
    return E.relative(pairs(spark, d), "p").select("s1_id", "cand_id", F.round("z", 4).alias("z"), F.round("ratio", 6).alias("ratio"))


@query("rival_features", f"""{P} select s1_id, cand_id, round(coalesce(case when row_number() over o = 1 then nth_value(p, 2) over f else max(p) over s end, 0), 6) as max_other, round(sum(p) over s - p, 6) as sum_other,
cast(sum(case when p > 0.5 then 1 else 0 end) over s - case when p > 0.5 then 1 else 0 end as bigint) as n_conf_other from pairs
window s as (partition by s1_id), o as (partition by s1_id order by p desc, cand_id), f as (partition by s1_id order by p desc, cand_id rows between unbounded preceding and unbounded following)""")
def _(spark, d):
    return E.rivals(pairs(spark, d), "p")


#: CRC-32 of a decimal or ASCII text, byte by byte and bit by bit.
BUCKET = """xor(list_reduce(list_prepend(cast(4294967295 as bigint), list_transform(string_split(cast({0} as varchar), ''), lambda ch: cast(ascii(ch) as bigint))), lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)), lambda x, i: case when x & 1 = 1 then xor(x >> 1, cast(3988292384 as bigint)) else x >> 1 end)), cast(4294967295 as bigint))"""


@query("negative_sampling_weights", f"""{P}, r as (select *, row_number() over (partition by s1_id order by p desc, cand_id) - 1 as rank from pairs),
n as (select *, row_number() over (partition by s1_id order by md5(s1_id || ':' || cand_id)) as pick, count(*) over (partition by s1_id) as n_rest from r where label = 0 and rank >= 2),
s as (select s1_id, cand_id, label, 1.0 as weight from r where label = 1 or rank < 2 union all select s1_id, cand_id, label, n_rest / least(n_rest, 2) as weight from n where pick <= 2)
select s1_id, cand_id, label, round(weight, 6) as weight from s""")
def _(spark, d):
    return E.sampled_negatives(pairs(spark, d), hard=2, random=2).select("s1_id", "cand_id", "label", F.round("weight", 6).alias("weight"))


@query("hash_halves_folds", f"select o_orderkey as s1_id, {BUCKET.format('o_orderkey')} % 100 as bucket, {BUCKET.format(chr(39) + 'half:' + chr(39) + ' || o_orderkey')} % 2 as half, {BUCKET.format('o_orderkey')} % 100 % 3 as fold from orders")
def _(spark, d):
    return E.hash_buckets(read(spark, d, "orders").select(F.col("o_orderkey").alias("s1_id")))


@query("stratified_split", f"""with r as (select o_orderkey as s1_id, o_orderpriority as stratum, row_number() over (partition by o_orderpriority order by md5(cast(o_orderkey as varchar)), o_orderkey) as i, count(*) over (partition by o_orderpriority) as n from orders)
select stratum, case when i <= round_even(n * 0.2, 0) then 'val' else 'train' end as split, count(*) as n from r group by 1, 2""")
def _(spark, d):
    o = read(spark, d, "orders").select(F.col("o_orderkey").alias("s1_id"), F.col("o_orderpriority").alias("stratum"))
    return E.stratified_split(o, "stratum", 0.2).groupBy("stratum", "split").agg(F.count("*").alias("n"))


@query("label_attach", f"{P} select l.l_orderkey as s1_id, l.l_partkey as cand_id, l.l_linenumber as line, coalesce(t.label, 0) as label from lineitem l left join (select * from pairs where label = 1) t on t.s1_id = l.l_orderkey and t.cand_id = l.l_partkey")
def _(spark, d):
    li = read(spark, d, "lineitem").select(F.col("l_orderkey").alias("s1_id"), F.col("l_partkey").alias("cand_id"), F.col("l_linenumber").alias("line"))
    return li.join(pairs(spark, d).filter("label = 1").select("s1_id", "cand_id", "label"), ["s1_id", "cand_id"], "left").withColumn("label", F.coalesce("label", F.lit(0)))


@query("oracle_f_by_budget", f"""{PC}, r as (select *, row_number() over (partition by s1_id order by p desc, cand_id) as k from pairs), g as (select unnest([1, 2, 3, 5, 10]) as budget),
h as (select s1_id, budget, sum(label) as found from r, g where k <= budget group by 1, 2), per as (select c.s1_id, g.budget, n_true, coalesce(found, 0) as found from counts c cross join g left join h on h.s1_id = c.s1_id and h.budget = g.budget),
x as (select budget, n_true, case when n_true = 0 then 1.0 else found / n_true end as recall from per) select budget, round(avg(recall), 6) as recall, round(avg(case when n_true = 0 then 1.0 else 1.25 * recall / (0.25 + recall) end), 6) as oracle_f05 from x group by 1""")
def _(spark, d):
    return E.oracle_by_budget(pairs(spark, d), true_counts(spark, d), "p", [1, 2, 3, 5, 10])


@query("budget_for_target", "select coalesce(min(case when recall >= 0.6 then budget end), max(budget)) as budget from (select * from (" + f"""{PC}, r as (select *, row_number() over (partition by s1_id order by p desc, cand_id) as k from pairs), g as (select unnest([1, 2, 3, 5, 10]) as budget),
h as (select s1_id, budget, sum(label) as found from r, g where k <= budget group by 1, 2), per as (select c.s1_id, g.budget, n_true, coalesce(found, 0) as found from counts c cross join g left join h on h.s1_id = c.s1_id and h.budget = g.budget)
select budget, round(avg(case when n_true = 0 then 1.0 else found / n_true end), 6) as recall from per group by 1""" + "))")
def _(spark, d):
    t = E.oracle_by_budget(pairs(spark, d), true_counts(spark, d), "p", [1, 2, 3, 5, 10])
    return t.agg(F.coalesce(F.min(F.when(F.col("recall") >= 0.6, F.col("budget"))), F.max("budget")).alias("budget"))


@query("lost_matches_rate", f"{PC} select round((select sum(n_true) from counts) / count(*) - (select sum(label) from pairs where p >= 0.1) / count(*), 6) as mu from counts")
def _(spark, d):
    truth, found = true_counts(spark, d), pairs(spark, d).filter("p >= 0.1").agg(F.sum("label").alias("found"))
    return truth.agg(F.sum("n_true").alias("t"), F.count("*").alias("n")).crossJoin(found).select(F.round(F.col("t") / F.col("n") - F.col("found") / F.col("n"), 6).alias("mu"))  # one row each


@query("blend_scores", f"{P} select s1_id, cand_id, round(((p + pow(p, 1.1)) / 2 + p * p) / 2, 6) as p from pairs")
def _(spark, d):
    df = pairs(spark, d)
    seeds = [df.select("s1_id", "cand_id", "p"), df.select("s1_id", "cand_id", F.pow("p", 1.1).alias("p"))]
    return E.blend([seeds, [df.select("s1_id", "cand_id", (F.col("p") * F.col("p")).alias("p"))]]).select("s1_id", "cand_id", F.round("p", 6).alias("p"))


@query("hard_negative_weights", f"{P} select s1_id, cand_id, case when label = 0 and p > 0.3 then 3.0 else 1.0 end as weight from pairs")
def _(spark, d):
    return pairs(spark, d).select("s1_id", "cand_id", F.when((F.col("label") == 0) & (F.col("p") > 0.3), 3.0).otherwise(1.0).alias("weight"))


@query("left_semi_truth", f"{PC} select distinct s1_id from pairs where s1_id in (select s1_id from counts where n_true > 0)")
def _(spark, d):
    return pairs(spark, d).select("s1_id").distinct().join(true_counts(spark, d).filter("n_true > 0"), "s1_id", "left_semi")


@query("left_anti_unmatched", f"{PC} select s1_id from counts where s1_id not in (select s1_id from pairs where label = 1)")
def _(spark, d):
    return true_counts(spark, d).select("s1_id").join(pairs(spark, d).filter("label = 1").select("s1_id"), "s1_id", "left_anti")


@query("gbt_match")
def _(spark, d):
    from linkloom.operators.ranker import cross_fitted

    return cross_fitted(E.relative(E.group_context(pairs(spark, d), "p").join(pairs(spark, d), ["s1_id", "cand_id"]), "p"), ["p", "rank", "n_cands", "gap_to_best", "ratio", "z"])
