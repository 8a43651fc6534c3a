"""Linking new S1 records as they arrive (an extension: the batch operators, run per micro-batch against a static pool)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.operators.blocking import exact_pass, ranked, union_passes


def link_batch(s1: DataFrame, pool: DataFrame, max_block: int = 5000, budget: int = 10) -> DataFrame:
    """Exact-key candidates of one micro-batch (country, id, sorted_key, concat) within the budget."""
    found = union_passes({"exact_sorted": exact_pass(s1, pool, "sorted_key", max_block), "exact_concat": exact_pass(s1, pool, "concat", max_block)})
    return ranked(found.withColumn("priority", F.bit_count("passes")), "priority", budget)


def start(stream: DataFrame, pool: DataFrame, out: str, checkpoint: str, link: Callable[[DataFrame, DataFrame], DataFrame] = link_batch):
    """Run over what is there and stop (availableNow); a rerun takes up only new records.

    A batch that is repeated after a failure overwrites its own partition, so results are exactly once.
    """

    def write(batch: DataFrame, number: int) -> None:
        link(batch, pool).withColumn("batch", F.lit(number)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(out)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
