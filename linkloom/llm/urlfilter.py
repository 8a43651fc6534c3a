"""URL filtering by host rules and a character language-model ratio.

Two character models, one of accepted and one of rejected URLs, give the log
likelihood of host and path under each.  Both are variable-order Markov models: the
estimate of an order is smoothed with a fixed weight of the next lower one, so a
context that was never seen falls back to its longest known suffix.  The
difference, divided by the length, is compared with a threshold calibrated on
URLs that were held out of the counts.

The labelled URLs are those that a rule decides.  What a rule can look at is taken out of every URL before it is
counted or judged (the last two labels of the host and the first segment of the path, for all URLs alike),
so the models learn from the rest of the URL and not the rules themselves.  Counts are gathered over all
of them: partitions add up in tables of hashed contexts whose size is fixed, so
what reaches the driver and what is broadcast never grows with the input.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import U64, mix64, opened, share, table, text_buffer

#: (host, path prefix, verdict): fixed values of the contract.
RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]
#: What rules are written about: the last labels of a host and the first segments of a path. The models do not see them.
RULE_LABELS, RULE_SEGMENTS = 2, 1
ORDER = 5
BITS = 16
SLOTS = 1 << BITS
#: Weight of the lower order's estimate, in characters.
LOWER_WEIGHT = 2.0
CLASSES = ("allow", "block")


def host_path(url: Column) -> tuple[Column, Column]:
    """Host after the first '://' up to '/', '?', '#' or the end, A-Z lower-cased; path from there up to '?', '#' or the end."""
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    known = url.isNotNull() & url.contains("://")
    host = F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.when(known, host).otherwise(""), F.when(known, path).otherwise("")


def match_rules(pages: DataFrame, rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    """Add rule and rule_verdict: the longest rule whose host is the page's or a parent domain, and whose path starts the page's."""
    ordered = sorted(rules, key=lambda r: (-len(r[0] + r[1]), r[0]))
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for host, path, say in reversed(ordered):
        fits = ((F.col("host") == host) | F.col("host").endswith(f".{host}")) & F.col("path").startswith(path)
        rule, verdict = F.when(fits, F.lit(host + path)).otherwise(rule), F.when(fits, F.lit(say)).otherwise(verdict)
    return pages.withColumn("rule", rule).withColumn("rule_verdict", verdict)


def beyond_rules(host: Column, path: Column, labels: int = RULE_LABELS, segments: int = RULE_SEGMENTS) -> Column:
    """What stands before the last labels of a host, and the path after its first segments: alike for all URLs, whether a rule fits them or not."""
    front = F.regexp_extract(host, rf"(?s)^(.*?)[^.]*(?:\.[^.]*){{0,{labels - 1}}}$", 1)
    return F.concat(front, F.regexp_replace(path, rf"^(/[^/]+(?=/)){{0,{segments}}}", ""))


def _context_keys(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Next symbols, and for each order the hash of the context before it; contexts stop at the start of a URL."""
    doc_start = np.repeat(offsets[:-1], np.diff(offsets))
    position = np.arange(len(data)) - doc_start
    keys = [np.zeros(len(data), dtype=np.uint64)]
    value = data.astype(np.uint64) + U64(1)
    with np.errstate(over="ignore"):
        for order in range(1, ORDER + 1):
            shifted = np.zeros(len(data), dtype=np.uint64)
            shifted[order:] = value[: len(data) - order] if len(data) > order else value[:0]
            shifted[position < order] = 0
            keys.append(mix64(keys[-1] * U64(0x100000001B3) + shifted + U64(order)))
    return data, keys


def _slots(symbols: np.ndarray, keys: list[np.ndarray]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    with np.errstate(over="ignore"):
        for order, key in enumerate(keys):
            yield order, (mix64(key + U64(order * 7919)) & U64(SLOTS - 1)).astype(np.int64), (mix64(key * U64(31) + symbols.astype(np.uint64) + U64(order * 104729 + 1)) & U64(SLOTS - 1)).astype(np.int64)


@dataclass
class UrlModel:
    """For each class and order: how often a context and a (context, symbol) were seen."""

    context: np.ndarray  # class, order, slot
    pair: np.ndarray
    threshold: float

    def log_likelihood(self, data: np.ndarray, offsets: np.ndarray, which: int) -> np.ndarray:
        """Natural log of the probability of each text's bytes."""
        if not len(data):
            return np.zeros(len(offsets) - 1)
        symbols, keys = _context_keys(data, offsets)
        p = np.full(len(data), 1 / 256)
        for order, context, pair in _slots(symbols, keys):
            n, c = self.context[which, order, context], self.pair[which, order, pair]
            p = (np.minimum(c, n) + LOWER_WEIGHT * p) / (n + LOWER_WEIGHT)
        total = np.concatenate(([0.0], np.cumsum(np.log(p))))
        return total[offsets[1:]] - total[offsets[:-1]]

    def difference(self, texts) -> np.ndarray:
        """Length-normalised log-likelihood of 'allow' over 'block'; an empty text gives 0."""
        data, offsets = text_buffer(pa.array(list(texts), type=pa.string()))
        length = np.maximum(1, np.diff(offsets))
        return (self.log_likelihood(data, offsets, 0) - self.log_likelihood(data, offsets, 1)) / length


def _count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Adds of a whole partition, as (kind, class, order, slot, n); at most as many rows as the tables have slots."""
    tables = np.zeros((2, 2, ORDER + 1, SLOTS), dtype=np.int32)
    seen = False
    for f in frames:
        for c, say in enumerate(CLASSES):
            texts = f["address"][f["rule_verdict"] == say]
            if not len(texts):
                continue
            seen = True
            data, offsets = text_buffer(pa.array(list(texts), type=pa.string()))
            symbols, keys = _context_keys(data, offsets)
            for order, context, pair in _slots(symbols, keys):
                np.add.at(tables[0, c, order], context, 1)
                np.add.at(tables[1, c, order], pair, 1)
    if seen:
        kind, c, order, slot = np.nonzero(tables)
        yield pd.DataFrame({"key": ((kind * 2 + c) * (ORDER + 1) + order) * SLOTS + slot, "n": tables[kind, c, order, slot].astype(np.int64)})


def train(labelled: DataFrame) -> UrlModel:
    """Model from (page_id, address, rule_verdict); a fifth by crc32 of the address is held out for the threshold.

    If a class has no URL the model can't tell them apart: the threshold lets everything pass.
    """
    fold = F.crc32(F.col("address").cast("binary")) % 5
    counted = labelled.filter(fold != 0).select("address", "rule_verdict").mapInPandas(_count, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    size = (ORDER + 1) * SLOTS
    flat = np.zeros(4 * size, dtype=np.float32)
    rows = counted.toPandas()  # at most 4 * size rows, however much is counted
    flat[rows["key"].to_numpy(dtype=np.int64)] = rows["n"].to_numpy()
    context, pair = flat[: 2 * size].reshape(2, ORDER + 1, SLOTS), flat[2 * size :].reshape(2, ORDER + 1, SLOTS)
    model = UrlModel(context, pair, 0.0)
    if not context[0].any() or not context[1].any():
        model.threshold = -np.inf
        return model
    held = labelled.filter(fold == 0)
    bins = np.round(np.linspace(-3, 3, 1201), 6)

    def histogram(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            at = np.clip(np.searchsorted(bins, model.difference(f["address"])), 0, len(bins) - 1)
            yield pd.DataFrame({"bin": at, "allow": (f["rule_verdict"] == "allow").astype(np.int64), "block": (f["rule_verdict"] == "block").astype(np.int64)})

    rows = held.select("address", "rule_verdict").mapInPandas(histogram, "bin long, allow long, block long").groupBy("bin").agg(F.sum("allow").alias("allow"), F.sum("block").alias("block")).toPandas()
    good, bad = np.zeros(len(bins)), np.zeros(len(bins))
    good[rows["bin"].to_numpy(dtype=np.int64)] = rows["allow"]
    bad[rows["bin"].to_numpy(dtype=np.int64)] = rows["block"]
    if good.sum() and bad.sum():
        # errors of either class weigh alike: blocked among accepted below the threshold, passed among rejected above it
        error = np.cumsum(good) / good.sum() + 1 - np.cumsum(bad) / bad.sum()
        least = np.flatnonzero(error <= error.min() + 1e-12)
        model.threshold = float(bins[least[len(least) // 2]])
    return model


JUDGED = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("host", T.StringType()), T.StructField("path", T.StringType()), T.StructField("rule", T.StringType()), T.StructField("verdict", T.StringType()), T.StructField("ratio", T.DoubleType())])


def judge(pages: DataFrame, rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, ratio for every row of pages(page_id, url).

    A null url or one without '://' has an empty host and path, fits no rule and
    has the ratio 0.  Repeated rows are judged alike, each on its own.  An empty table gives an empty result.
    """
    host, path = host_path(F.col("url"))
    parts = match_rules(pages.select(F.col("page_id").cast("long").alias("page_id"), host.alias("host"), path.alias("path")), rules).withColumn("address", beyond_rules(F.col("host"), F.col("path")))
    model = train(parts.filter(F.col("rule_verdict").isNotNull()).select("page_id", "address", "rule_verdict"))
    shared = share(parts.sparkSession, model)  # fixed size: classes x orders x slots

    def apply(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = opened(shared)
        for f in frames:
            ratio = own.difference(f["address"]).astype(np.float64)
            said = np.where(ratio > own.threshold, "allow", "block")
            verdict = [r if isinstance(r, str) else s for r, s in zip(f["rule_verdict"], said, strict=True)]
            yield pd.DataFrame({"page_id": f["page_id"], "host": f["host"], "path": f["path"], "rule": f["rule"], "verdict": verdict, "ratio": ratio})

    return parts.select("page_id", "host", "path", "rule", "rule_verdict", "address").mapInPandas(apply, JUDGED)


def op8_url_filter(spark, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"))
