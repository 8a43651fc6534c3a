"""Document fingerprints from closed syncmers, with DataFrame functions only.

Symbols are words, hashed to 64 bits.  A k-mer of WORDS words is an anchor (a closed
syncmer) if the least of its inner hashes (of single words) stands at its first or last
place.  Whether a k-mer is chosen depends on nothing around it, so two texts choose the
same anchors wherever they share words, and most neighbouring anchors overlap.  The
fingerprint keeps the 32-bit hash of every anchor, in order of place, and the places beside it.
The likeness of two fingerprints is the Jaccard similarity of the texts' anchor sets; matched by
place, only those shared anchors count that stand at one common shift.

A text of fewer than WORDS words has one anchor, made of all its words; a text without words
has an empty fingerprint, which is like another empty one only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import table

WORDS = 3
SPACE = r"[\x20\x09-\x0D]+"
#: Neighbouring documents lie together in slices of about so many rows; there are so many slices at most.
SLICE_ROWS = 1000
MOST_SLICES = 1 << 16


def word_hashes(text: Column) -> Column:
    return F.transform(F.array_remove(F.split(text, SPACE), ""), lambda w: F.xxhash64(w))


def anchor_hashes(hashes: Column) -> Column:
    """Hash of each chosen k-mer, in order of place; null where a k-mer is not chosen."""

    def choose(i: Column) -> Column:
        inner = [F.get(hashes, i + j) for j in range(WORDS)]
        least = F.least(*inner)
        return F.when((least == inner[0]) | (least == inner[-1]), F.xxhash64(*inner))

    short = F.when(F.size(hashes) > 0, F.array(F.xxhash64(F.array_join(F.transform(hashes, lambda h: h.cast("string")), " ")))).otherwise(F.array().cast("array<bigint>"))
    return F.when(F.size(hashes) >= WORDS, F.transform(F.sequence(F.lit(0), F.size(hashes) - WORDS), choose)).otherwise(short)


def anchors(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add `anchors`: array of (place, hash) of the chosen k-mers, for positional matching."""
    hashed = docs.withColumn("hashes_", word_hashes(F.coalesce(F.col(text), F.lit(""))))
    chosen = hashed.withColumn("chosen_", anchor_hashes(F.col("hashes_")))
    placed = F.filter(F.transform("chosen_", lambda h, i: F.struct(i.alias("place"), h.alias("hash"))), lambda x: x["hash"].isNotNull())
    return chosen.withColumn("anchors", placed).drop("hashes_", "chosen_")


def _hash(anchor: Column) -> Column:
    return F.shiftrightunsigned(anchor, 32)


def _place(anchor: Column) -> Column:
    return anchor.bitwiseAND(F.lit(2**31 - 1))


def with_anchors(df: DataFrame, text: str, out: str) -> DataFrame:
    """Add column `out`, the anchors of `text` by place: each a long of the upper half of its hash and its place."""
    hashed = df.withColumn("hashes_", word_hashes(F.col(text)))
    chosen = hashed.withColumn("chosen_", anchor_hashes(F.col("hashes_"))).drop("hashes_")
    packed = F.transform("chosen_", lambda h, i: F.shiftleft(F.shiftrightunsigned(h, 32), 32).bitwiseOR(i.cast("long")))
    return chosen.withColumn(out, F.array_compact(packed)).drop("chosen_")


def _digits(part: Column) -> Column:
    return F.array_join(F.transform(part, lambda x: F.lpad(F.lower(F.hex(x)), 8, "0")), "")


def fingerprint(anchors: str) -> Column:
    """The hashes of all anchors by place, eight hex digits each."""
    return _digits(F.transform(anchors, _hash))


def places(anchors: str) -> Column:
    """The places of the fingerprint's values, eight hex digits each."""
    return _digits(F.transform(anchors, _place))


def _firsts(anchors: str) -> Column:
    """Of sorted anchors, the first place of each hash."""
    return F.filter(anchors, lambda v, i: (i == 0) | (_hash(v) != _hash(F.get(F.col(anchors), i - 1))))


def with_likeness(df: DataFrame, a: str, b: str, near: str, placed: str) -> DataFrame:
    """Add `near`: of the distinct hashes of both, the share that is in both; and `placed`: the share that stands at one shift in both.

    A hash stands where it stands first.  The shift is the one that most shared hashes have.  Two empty ones have 1.
    """
    x = df.withColumn("a_", F.sort_array(a)).withColumn("b_", F.sort_array(b))
    x = x.withColumn("first_a_", _firsts("a_")).withColumn("first_b_", _firsts("b_"))
    other = F.transform("first_b_", lambda v: v.bitwiseOR(F.lit(2**31)))  # tells the sides apart, and sorts the second after the first
    x = x.withColumn("n_", F.size("first_a_") + F.size("first_b_")).withColumn("s_", F.sort_array(F.concat("first_a_", other))).drop("first_a_", "first_b_", "a_", "b_")
    after = lambda i: F.get(F.col("s_"), i + 1)
    x = x.withColumn("d_", F.sort_array(F.array_compact(F.transform("s_", lambda v, i: F.when(_hash(v) == _hash(after(i)), _place(after(i)) - _place(v)))))).drop("s_")
    x = x.withColumn("t_", F.array_compact(F.transform("d_", lambda v, i: F.when((i == 0) | (v != F.get(F.col("d_"), i - 1)), i))))
    run = F.array_max(F.transform("t_", lambda v, i: F.coalesce(F.get(F.col("t_"), i + 1), F.size("d_")) - v))
    whole = F.col("n_") - F.size("d_")
    share = lambda k: F.when(whole == 0, 1.0).otherwise(k / whole)
    return x.withColumn(near, share(F.size("d_"))).withColumn(placed, share(F.coalesce(run, F.lit(0)))).drop("n_", "d_", "t_")


def slice_bounds(ids: DataFrame, rows: int) -> list[int]:
    """Ascending ids that cut ids(doc_id) into slices of about SLICE_ROWS rows, from percentiles of a hash sample of bounded size.

    Which slice a row falls into changes no result, only how evenly the rows are dealt.
    """
    n = min(MOST_SLICES, rows // SLICE_ROWS)
    if n < 2:
        return []
    sampled = ids.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < math.ceil((1 << 30) * min(1.0, 32 * n / rows)))
    found = sampled.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)], 10 * n).alias("cuts")).first()["cuts"]
    return sorted(set(found or []))


def slice_of(doc_id: Column, bounds: list[int]) -> Column:
    """How many bounds are at or below the id, by bisection."""
    if not bounds:
        return F.lit(0)
    known = F.split(F.lit(",".join(map(str, bounds))), ",").cast("array<bigint>")
    steps = F.array(*[F.lit(1 << k) for k in range(len(bounds).bit_length() - 1, -1, -1)])
    return F.aggregate(steps, F.lit(0), lambda low, step: F.when((low + step <= len(bounds)) & (F.get(known, low + step - 1) <= doc_id), low + step).otherwise(low))


def with_next(base: DataFrame) -> DataFrame:
    """Distinct rows of base(doc_id, tie, text) in ascending order, with `rows_`, how often each occurs, and `next_text`; after the last comes the first.

    Rows are dealt in slices of neighbouring ids, so a row finds its next one where it lies.  The last row of a slice
    finds it in a copy of the next slice's first row, which is sent there: one row a slice.
    """
    bounds = slice_bounds(base.select("doc_id"), base.count())
    sliced = base.withColumn("slice_", slice_of(F.col("doc_id"), bounds))
    # a row a slice, at most MOST_SLICES: the slice before each one's first row, in a circle
    heads = sorted((r["slice_"], *r["key"]) for r in sliced.groupBy("slice_").agg(F.min(F.struct("doc_id", "tie")).alias("key")).collect())
    ends = base.sparkSession.createDataFrame([(*key, heads[i - 1][0]) for i, (_, *key) in enumerate(heads)], "doc_id long, tie long, slice_ int")
    sent = base.join(F.broadcast(ends), ["doc_id", "tie"]).select("slice_", F.lit(1).alias("end_"), "doc_id", "tie", "text")
    dealt = sliced.select("slice_", F.lit(0).alias("end_"), "doc_id", "tie", "text").unionByName(sent).repartition("slice_")
    once = dealt.groupBy("slice_", "end_", "doc_id", "tie").agg(F.min("text").alias("text"), F.count("*").alias("rows_"))
    order = Window.partitionBy("slice_").orderBy("end_", "doc_id", "tie")
    return once.withColumn("next_text", F.lead("text").over(order)).filter("end_ = 0").drop("slice_", "end_")


def compare_edited(docs: DataFrame) -> DataFrame:
    """One row for every row of docs(doc_id, text): fingerprints of the text, of its edited text and how like the next document's it is.

    A null text is empty.  Rows that share an id follow each other by a hash of their
    text; a null id comes first.  Repeated rows get equal results.  A single document is followed by itself.
    """
    first_id = -(2**63)  # stands for a null id
    base = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(first_id)).alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).withColumn("tie", F.xxhash64("text"))
    x = with_next(base).withColumn("n_chars", F.length("text").cast("long"))
    x = x.withColumn("edited", F.expr("concat(substring(text, 1, cast(n_chars - floor(n_chars / 4) as int)), substring(next_text, 1, cast(floor(n_chars / 4) as int)))"))
    x = with_anchors(with_anchors(x.withColumn("edited_sha256", F.sha2("edited", 256)), "text", "anchors"), "edited", "edited_anchors")
    x = with_anchors(x.drop("text", "edited"), "next_text", "next_anchors").drop("next_text")
    liked = with_likeness(with_likeness(x, "anchors", "edited_anchors", "near_edited", "placed_edited"), "anchors", "next_anchors", "near_next", "placed_next")
    every = liked.withColumn("row_", F.explode(F.sequence(F.lit(1), F.col("rows_").cast("int"))))
    return every.select(
        F.when(F.col("doc_id") != first_id, F.col("doc_id")).alias("doc_id"), "n_chars", "edited_sha256", fingerprint("anchors").alias("fingerprint"), places("anchors").alias("places"),
        fingerprint("edited_anchors").alias("edited_fingerprint"), places("edited_anchors").alias("edited_places"), "near_edited", "near_next", "placed_edited", "placed_next",
    )


def op7_syncmer_fingerprint(spark, sf_dir: str) -> DataFrame:
    return compare_edited(table(spark, sf_dir, "documents"))
