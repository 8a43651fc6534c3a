"""From scores to decisions: one-to-one assignment, thresholds, expected-F0.5 selection, calibration and tuning."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

EPS = 1e-6


def one_to_one(df: DataFrame, p: str = "p") -> DataFrame:
    """p stays with the record's best claimant (ties: the least s1_id) and is 0 for the others."""
    best = Window.partitionBy("cand_id").orderBy(F.desc(p), "s1_id")
    return df.withColumn(p, F.when(F.row_number().over(best) == 1, F.col(p)).otherwise(0.0))


def soft_one_to_one(df: DataFrame, p: str = "p") -> DataFrame:
    """Odds of a claim over one plus the odds of all claims to the record."""
    c = F.greatest(F.lit(EPS), F.least(F.col(p), F.lit(1 - EPS)))
    odds = df.withColumn("odds_", c / (1 - c))
    return odds.withColumn(p, F.col("odds_") / (1 + F.sum("odds_").over(Window.partitionBy("cand_id")))).drop("odds_")


def threshold(p: Column, t: float, grp: Column | None = None, t_grp: float | None = None) -> Column:
    return p >= t if grp is None else F.when(grp == 1, p >= t_grp).otherwise(p >= t)


def expected_f(df: DataFrame, mu: float = 0.0, p: str = "p") -> DataFrame:
    """Add pred: the first k candidates by falling p that maximise the approximate expected F0.5, if that beats predicting none."""
    c = F.least(F.col(p), F.lit(1 - EPS))
    group, order = Window.partitionBy("s1_id"), Window.partitionBy("s1_id").orderBy(F.desc(p), "cand_id")
    run = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    x = df.withColumn("c_", c).withColumn("k_", F.row_number().over(order)).withColumn("cum_", F.sum("c_").over(run)).withColumn("tot_", F.sum("c_").over(group))
    x = x.withColumn("none_", F.exp(F.sum(F.log1p(-F.col("c_"))).over(group) - mu)).withColumn("score_", F.round(1.25 * F.col("cum_") / (0.25 * (F.col("tot_") + mu) + F.col("k_")), 9))
    x = x.withColumn("best_", F.max("score_").over(group))
    x = x.withColumn("kbest_", F.min(F.when(F.col("score_") >= F.col("best_") - 1e-12, F.col("k_"))).over(group))
    return x.withColumn("pred", (F.col("best_") > F.round("none_", 9)) & (F.col("k_") <= F.col("kbest_"))).drop("c_", "k_", "cum_", "tot_", "none_", "score_", "best_", "kbest_")


def exact_expected_f(p: np.ndarray, mu: float = 0.0, top: int = 10, tail: int = 12) -> np.ndarray:
    """Expected F0.5 of predicting the first 0..n of p (falling), against Bernoulli truths and Poisson(rest + mu) further ones.

    The number of hits among the first k and among the rest are independent: both come from the same convolution.
    """
    p = np.minimum(p, 1.0)
    head, rate = p[:top], float(p[top:].sum() + mu)
    poisson = np.array([math.exp(-rate + j * math.log(rate) - math.lgamma(j + 1)) if rate > 0 else float(j == 0) for j in range(tail + 1)])
    poisson[-1] += max(0.0, 1 - poisson.sum())
    value = np.zeros(len(head) + 1)
    for k in range(len(head) + 1):
        inside, outside = np.ones(1), poisson
        for x in head[:k]:
            inside = np.convolve(inside, (1 - x, x))
        for x in head[k:]:
            outside = np.convolve(outside, (1 - x, x))
        if k == 0:
            value[0] = outside[0]
            continue
        hits = np.arange(k + 1)[:, None]
        true = hits + np.arange(len(outside))[None, :]
        value[k] = float((inside[:, None] * outside[None, :] * 1.25 * hits / (0.25 * true + k)).sum())
    return value


def decide_exact_f(df: DataFrame, mu: float = 0.0, top: int = 10) -> DataFrame:
    """(s1_id, cand_id, p, pred) with the exact rule: the lists of many S1s are decided in one Arrow batch."""

    @F.pandas_udf("int")
    def size(lists: pd.Series) -> pd.Series:
        return lists.map(lambda p: int(exact_expected_f(np.asarray(p, dtype=float), mu, top).argmax()))

    falling = F.sort_array(F.collect_list(F.struct((-F.col("p")).alias("q"), "cand_id")))
    listed = df.groupBy("s1_id").agg(falling.alias("list"))
    decided = listed.withColumn("k", size(F.transform("list", lambda x: -x["q"])))
    each = decided.select("s1_id", "k", F.posexplode("list").alias("i", "x"))
    return each.select("s1_id", "x.cand_id", (-F.col("x.q")).alias("p"), (F.col("i") < F.col("k")).alias("pred"))


def pav(y: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Weighted isotonic means: neighbours that fall are pooled until none does."""
    blocks: list[list[float]] = []
    for value, weight in zip(y, w, strict=True):
        blocks.append([value, weight, 1])
        while len(blocks) > 1 and blocks[-2][0] > blocks[-1][0]:
            v, m, n = blocks.pop()
            u = blocks[-1]
            blocks[-1] = [(u[0] * u[1] + v * m) / (u[1] + m), u[1] + m, u[2] + n]
    return np.concatenate([np.full(int(n), v) for v, _, n in blocks]) if blocks else np.zeros(0)


def calibration_bins(df: DataFrame, bins: int = 20, p: str = "p", label: str = "label", accuracy: int | None = None) -> DataFrame:
    """(bin, n, mean_p, mean_y): bins between the distinct quantiles of p, closed on the right.

    Exact quantiles keep every distinct p; with `accuracy` a sketch of bounded size finds the edges instead (the bins' counts and
    means stay exact), which is what billions of unrounded scores need.
    """
    grid = F.array(*[F.lit(i / bins) for i in range(1, bins)])
    quantiles = F.percentile(p, grid) if accuracy is None else F.percentile_approx(p, grid, accuracy)
    edges = df.agg(quantiles.alias("q")).select(F.array_sort(F.array_distinct("q")).alias("edges"))
    placed = df.crossJoin(F.broadcast(edges)).withColumn("bin", F.size(F.filter("edges", lambda e: e < F.col(p))).cast("long"))  # one row
    return placed.groupBy("bin").agg(F.count("*").alias("n"), F.avg(p).alias("mean_p"), F.avg(F.col(label).cast("double")).alias("mean_y"))


def fit_calibration(df: DataFrame, bins: int = 200, accuracy: int | None = 10_000) -> list[tuple[float, float]]:
    """Knots (p, calibrated) of a monotone map; at most `bins` rows reach the driver."""
    rows = calibration_bins(df, bins, accuracy=accuracy).orderBy("bin").collect()
    y = pav(np.array([r["mean_y"] for r in rows]), np.array([float(r["n"]) for r in rows]))
    return [(float(r["mean_p"]), float(min(1 - EPS, max(EPS, v)))) for r, v in zip(rows, y, strict=True)]


def calibrated(p: Column, knots: list[tuple[float, float]]) -> Column:
    """Linear between the knots, flat beyond them."""
    out = F.lit(knots[-1][1])
    for (x0, y0), (x1, y1) in reversed(list(zip(knots, knots[1:], strict=False))):
        out = F.when(p < x1, F.lit(y0) + (p - x0) * ((y1 - y0) / (x1 - x0) if x1 > x0 else 0.0)).otherwise(out)
    return F.when(p <= knots[0][0], F.lit(knots[0][1])).otherwise(out)


def f05(tp: Column, npred: Column, n_true: Column) -> Column:
    return F.when(n_true == 0, (npred == 0).cast("double")).when(npred == 0, 0.0).otherwise(1.25 * tp / (0.25 * n_true + npred))


def per_s1(pred: DataFrame, truth: DataFrame, *by: str) -> DataFrame:
    """tp, npred, n_true, f of every S1 in the truth (and of every value of `by`, which the truth then has too)."""
    got = pred.filter("pred").groupBy("s1_id", *by).agg(F.sum(F.col("label").cast("long")).alias("tp"), F.count("*").alias("npred"))
    all_s1 = truth.join(got, ["s1_id", *by], "left").na.fill(0, ["tp", "npred"])
    return all_s1.withColumn("f", f05(F.col("tp"), F.col("npred"), F.col("n_true")))


def macro(scored: DataFrame, *by: str) -> DataFrame:
    p = F.when(F.col("npred") == 0, (F.col("n_true") == 0).cast("double")).otherwise(F.col("tp") / F.col("npred"))
    r = F.when(F.col("n_true") == 0, 1.0).otherwise(F.col("tp") / F.col("n_true"))
    values = [F.round(F.avg("f"), 6).alias("f05"), F.round(F.avg(p), 6).alias("precision"), F.round(F.avg(r), 6).alias("recall"), F.count("*").alias("n_s1")]
    return scored.groupBy(*by).agg(*values) if by else scored.agg(*values)


def threshold_curve(df: DataFrame, truth: DataFrame, grid: list[float], *, one: bool = False) -> DataFrame:
    """(t, f05) for each threshold. The truth is crossed with the grid, so S1s without predictions count at every t."""
    spark = df.sparkSession
    steps = F.broadcast(spark.createDataFrame([(float(t),) for t in grid], "t double"))
    base = one_to_one(df) if one else df
    hits = base.join(steps, F.col("p") >= F.col("t")).groupBy("s1_id", "t").agg(F.sum(F.col("label").cast("long")).alias("tp"), F.count("*").alias("npred"))
    full = truth.crossJoin(steps).join(hits, ["s1_id", "t"], "left").na.fill(0, ["tp", "npred"])
    return full.groupBy("t").agg(F.round(F.avg(f05(F.col("tp"), F.col("npred"), F.col("n_true"))), 6).alias("f05"))


def gamma_for_target(df: DataFrame, target: float, t: float, low: float = 0.3, high: float = 4.0, steps: int = 14) -> float:
    """Exponent that brings the predictions per S1 down or up to the target, by bisection.

    p ** g reaches t as long as g is at most ln t / ln p, so one histogram of these limits, with a cell for each of the
    bisection's 2 ** steps places, answers all of its questions.
    """
    cells = 1 << steps
    limit = F.when(F.col("p") >= 1, F.lit(float("inf"))).when(F.col("p") <= 0, F.lit(0.0)).otherwise(F.log(F.lit(t)) / F.log("p"))
    cell = F.floor(F.greatest(F.lit(-1.0), F.least(F.lit(float(cells)), (limit - low) / (high - low) * cells)))
    found = {r["cell"]: r["n"] for r in df.groupBy(cell.alias("cell")).agg(F.count("*").alias("n")).collect()}  # at most 2 ** steps + 2 rows
    n = df.select("s1_id").distinct().count()
    least, most = 0, cells
    for _ in range(steps):
        mid = (least + most) // 2
        rate = sum(k for c, k in found.items() if c >= mid) / max(1, n)
        least, most = (mid, most) if rate > target else (least, mid)
    return low + (high - low) * (least + most) / 2 / cells
