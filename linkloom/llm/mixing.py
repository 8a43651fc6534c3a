"""Mixing sources to target weights by entropy balancing.

Among all document rates r(d) >= 0 that give every constraint group its target
number of words, the mix takes those with the least size-weighted relative
entropy to "every document once".  The convex dual has one multiplier per group,

    D(lambda) = sum_d size(d) * exp(lambda[g(d)]) - lambda . target,

and r(d) = exp(lambda[g(d)]) at its minimum.  Groups may overlap (`balance`): the exponent is then the sum over a
document's groups.  One distributed aggregation reads the documents; gradient and Hessian are sums over the distinct
sets of groups, made anew for each damped Newton step.  The sources of `mix` are the simplest case, with a diagonal Hessian.

Rates become whole copies by error diffusion: a document gets floor(r) or
ceil(r) copies, whichever keeps the running word count of its block nearest to
the wanted one.  Blocks are hash slices of a group with a bounded expected number of
documents, so a group with a third of all rows is dealt to many tasks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import WORD_RE, cut, lean, table

#: Expected documents in a rounding block.
BLOCK_ROWS = 1_000
#: A document is taken at most so many times.
MAX_RATE = 3.0


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_RE)), F.lit(0)).cast("long")


def capped_targets(groups: DataFrame, key: str, weight: str, size: str, max_rate: float = MAX_RATE) -> DataFrame:
    """Add `target`: all words shared by weight, none above max_rate times its size, the excess reshared by weight.

    Filling by the ratio cap/weight from the lowest gives the fixed point of the
    resharing in one pass: a group is capped exactly if the level that would be
    left for it and all groups after it exceeds its own ratio.
    """
    g = groups.withColumn("cap_", F.col(size) * F.lit(max_rate)).withColumn("level_", F.col("cap_") / F.col(weight))
    w = Window.orderBy("level_", F.col(key).asc_nulls_last())
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    after = w.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy()
    g = g.withColumn("rest_", F.sum(size).over(whole) - F.coalesce(F.sum("cap_").over(before), F.lit(0.0))).withColumn("share_", F.col("rest_") / F.sum(weight).over(after)).withColumn("full_", F.col("level_") <= F.col("share_"))
    # every group after the first one that is not full shares what the full ones leave
    g = g.withColumn("open_share_", F.min(F.when(~F.col("full_"), F.struct("level_", F.col("share_")))).over(whole)["share_"])
    return g.withColumn("target", F.when(F.col("full_"), F.col("cap_")).otherwise(F.col("open_share_") * F.col(weight))).drop("cap_", "level_", "rest_", "share_", "full_", "open_share_")


def balance(patterns: DataFrame, targets: dict[int, float], tolerance: float = 1e-9, steps: int = 60) -> dict[int, float]:
    """Multipliers of the dual for patterns(groups array<int>, size): groups may overlap.

    The rate of a document in the groups S is exp(sum of lambda[g], g in S).  Documents enter through the size of each distinct set of
    groups only.  Every step sums the gradient and the Hessian's entries over the patterns where they lie, and solves for the
    few multipliers on the driver; a step is held to 1 in size and halved as long as the dual does not fall.
    A target of 0 has no finite multiplier: it is left out, and its documents get the rate 0.
    """
    dead = sorted(g for g, t in targets.items() if t <= 0)
    live = sorted(g for g, t in targets.items() if t > 0)
    known = patterns.filter((F.col("size") > 0) & ~F.arrays_overlap("groups", F.array(*map(F.lit, dead)).cast("array<int>"))) if dead else patterns.filter("size > 0")
    # the documents are read once: every step starts from the stored sums
    known = cut(known.groupBy("groups").agg(F.sum("size").alias("size")))
    lam = dict.fromkeys(live, 0.0)

    def weighed(at: dict[int, float]) -> DataFrame:
        table = F.create_map(*[F.lit(x) for g, v in at.items() for x in (g, v)]) if at else F.create_map()
        total = F.aggregate("groups", F.lit(0.0), lambda s, g: s + F.coalesce(table[g], F.lit(0.0)))
        return known.select("groups", (F.col("size") * F.exp(total)).alias("mass"))

    def dual(at: dict[int, float]) -> float:
        return float(weighed(at).agg(F.sum("mass").alias("m")).first()["m"] or 0.0) - sum(v * targets[g] for g, v in at.items())

    value = dual(lam) if live else 0.0
    for _ in range(steps if live else 0):
        each = weighed(lam).select("mass", "groups", F.explode("groups").alias("i")).select("mass", "i", F.explode("groups").alias("j"))
        hessian = {(r["i"], r["j"]): r["h"] for r in each.groupBy("i", "j").agg(F.sum("mass").alias("h")).collect()}  # pairs of groups that share a document
        reached = [g for g in live if hessian.get((g, g), 0) > 0]
        gradient = np.array([hessian[g, g] - targets[g] for g in reached])
        if not reached or np.all(np.abs(gradient) <= tolerance * np.array([targets[g] for g in reached])):
            break
        if all(i == j for i, j in hessian):
            step = -gradient / np.array([hessian[g, g] for g in reached])
        else:
            full = np.array([[hessian.get((a, b), 0.0) for b in reached] for a in reached])
            step = -np.linalg.lstsq(full + 1e-12 * np.trace(full) * np.eye(len(full)), gradient, rcond=None)[0]
        step /= max(1.0, float(np.abs(step).max()))
        scale = 1.0
        while True:
            tried = lam | {g: lam[g] + scale * float(x) for g, x in zip(reached, step, strict=True)}
            now = dual(tried)
            if now <= value + 1e-12 * abs(value) or scale < 1e-6:
                break
            scale /= 2
        lam, value = tried, now
    return lam | dict.fromkeys(dead, -math.inf)


def newton_rates(groups: DataFrame) -> DataFrame:
    """groups(source_size, target, ...), one row for each group and none overlapping, with `rate`: the solved balance, at most MAX_RATE."""
    numbered = groups.withColumn("group_", F.row_number().over(Window.orderBy("source_size", "target")))
    rows = numbered.select("group_", "target").collect()  # a few rows per source
    lam = balance(numbered.select(F.array("group_").alias("groups"), F.col("source_size").cast("double").alias("size")), {r["group_"]: float(r["target"] or 0) for r in rows})
    table = F.create_map(*[F.lit(x) for g, v in lam.items() for x in (g, math.exp(v))]) if lam else F.create_map().cast("map<int,double>")
    rate = F.when(F.col("source_size") > 0, F.least(table[F.col("group_")], F.lit(MAX_RATE)))
    return numbered.withColumn("rate", F.coalesce(rate, F.lit(0.0))).drop("group_")


def _round_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by block, then by falling size; the carried error starts anew with each block. Columns `block` and `rate` become `copies`."""
    block, carry = None, 0.0
    for batch in batches:
        names = batch.schema.names
        blocks, sizes, rates = (batch.column(names.index(c)).to_pylist() for c in ("block", "size", "rate"))
        copies = np.zeros(batch.num_rows, dtype=np.int64)
        for i, (b, size, rate) in enumerate(zip(blocks, sizes, rates, strict=True)):
            if b != block:
                block, carry = b, 0.0
            if size <= 0:
                continue
            want = rate * size + carry
            low, high = math.floor(rate + 1e-9), min(int(MAX_RATE), math.ceil(rate - 1e-9))
            copies[i] = min(high, max(low, round(want / size)))
            carry = want - copies[i] * size
        kept = [c for c in names if c not in ("block", "rate")]
        yield pa.RecordBatch.from_arrays([*[batch.column(names.index(c)) for c in kept], pa.array(copies)], [*kept, "copies"])


def mix(docs: DataFrame, with_text: bool = False) -> DataFrame:
    """doc_id, size, source_size, target, copies, taken for every row of docs(doc_id, text, source); source and text too if wanted.

    Null or white-space texts have size 0 and are taken 0 times over.  A null
    source is a source of its own, last in order.  Repeated rows count as often
    as they occur and may get different copies.  Sources weigh 1, 2, 3, repeating, in code-point
    order.  An empty table gives an empty result.  Equal input gives equal output: blocks and the
    order within them depend on sizes and ids alone.
    """
    sized = docs.select("doc_id", "source", *["text"] * with_text, word_count(F.col("text")).alias("size"))
    groups = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows_"))
    # a few rows per source: ordering them is a small job
    groups = groups.withColumn("weight", ((F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % 3 + 1).cast("double"))
    groups = newton_rates(cut(capped_targets(groups, "source", "weight", "source_size")))
    groups = groups.withColumn("blocks_", F.ceil(F.col("rows_") / F.lit(BLOCK_ROWS)))
    joined = sized.join(groups.withColumnRenamed("source", "source_"), F.col("source").eqNullSafe(F.col("source_")), "left")
    block = F.xxhash64(F.coalesce(F.col("source"), F.lit("\u0000null")), F.pmod(F.xxhash64("doc_id", "size"), F.col("blocks_")))
    columns = [*["source", "text"] * with_text, "doc_id", "size", "source_size", F.col("target").cast("double").alias("target")]
    dealt = joined.select(*columns, "rate", block.alias("block")).repartition("block").sortWithinPartitions("block", F.desc("size"), "doc_id", *["text"] * with_text)
    schema = T.StructType([*dealt.drop("rate", "block").schema.fields, T.StructField("copies", T.LongType())])
    return dealt.mapInArrow(lean(_round_blocks), schema).withColumn("taken", F.col("size") * F.col("copies"))


def op2_mix_sources(spark, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "copies")


def stage_mix(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, text, size, copies, taken of the documents that the mix takes at least once.

    The copies are kept as a count, not written out: a reader repeats a row `copies` times.  Texts travel with their
    rows, so repeated rows and ids get what the mix gives each of them.  Other columns of docs are left out.
    """
    return mix(docs.select("doc_id", "source", "text"), with_text=True).filter("copies > 0").select("doc_id", "source", "text", "size", "copies", "taken")
