"""Shards of a long job, what they hold, and reports.

A shard is a partition directory of one table; it counts as done once Spark's committer has marked it, so a rerun takes
up only what is missing.
"""

from __future__ import annotations

import json
import logging
import time
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

log = logging.getLogger("linkloom")


@contextmanager
def timed(what: str) -> Iterator[None]:
    """Log how long a step took."""
    began = time.monotonic()
    yield
    log.info("%s: %.1f s", what, time.monotonic() - began)


def _files(spark: SparkSession, path: str):
    """Hadoop's view of a path: any store that Spark reads."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def shard_path(root: str, *parts: object) -> str:
    return "/".join([root.rstrip("/"), *[f"{i:05d}" if isinstance(i, int) else str(i) for i in parts]])


def shard_done(spark: SparkSession, path: str) -> bool:
    fs, p = _files(spark, f"{path}/_SUCCESS")
    return fs.exists(p)


def list_shards(spark: SparkSession, root: str) -> list[str]:
    """Finished shards below root, in order."""
    fs, p = _files(spark, root)
    if not fs.exists(p):
        return []
    names = sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory())
    return [f"{root.rstrip('/')}/{n}" for n in names if shard_done(spark, f"{root.rstrip('/')}/{n}")]


def run_shards(spark: SparkSession, root: str, names: list[object], make: Callable[[object], DataFrame], again: bool = False) -> list[str]:
    """Make and write the shards that are not done (all of them with `again`); returns those that were written."""
    made = []
    for name in names:
        path = shard_path(root, name)
        if again or not shard_done(spark, path):
            with timed(f"shard {path}"):
                make(name).write.mode("overwrite").parquet(path)
            made.append(path)
    return made


def cached(spark: SparkSession, path: str, make: Callable[[], DataFrame], rows: int) -> DataFrame:
    """The table at path if it is whole and has so many rows, else what `make` gives, written there: features, document frequencies, IDF."""
    if not shard_done(spark, path) or spark.read.parquet(path).count() != rows:
        with timed(f"cache {path}"):
            make().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def reset_from(spark: SparkSession, root: str, stages: list[str], first: str) -> None:
    """Forget what stages from `first` on have written."""
    for stage in stages[stages.index(first) :]:
        fs, p = _files(spark, shard_path(root, stage))
        fs.delete(p, True)


def shard_summary(candidates: DataFrame, truth: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What a stored shard of candidates says: candidates of each S1, and rank and passes of its true pairs (-1 and 0 where they are not among them)."""
    counts = candidates.groupBy("s1_id").agg(F.count("*").alias("n"))
    probe = truth.select("s1_id", F.col("matched_id").alias("cand_id")).join(candidates.select("s1_id").distinct(), "s1_id", "left_semi")
    found = probe.join(candidates.select("s1_id", "cand_id", "rank", "passes"), ["s1_id", "cand_id"], "left").na.fill({"rank": -1, "passes": 0})
    return counts, found


def side_table(spark: SparkSession, path: str, columns: dict[str, str]) -> DataFrame:
    """A TSV with known columns (name to type); a value that does not fit its type is an error, an empty one stays empty text."""
    df = spark.read.option("sep", "\t").option("header", True).option("quote", "").option("emptyValue", "").option("nullValue", "\u0000").csv(path)
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{path} lacks {missing}")
    return df.select(*[F.coalesce(c, F.lit("")).cast(kind).alias(c) for c, kind in columns.items()])


def render(sections: dict[str, DataFrame], most: int = 50) -> tuple[dict, str]:
    """Small result tables as one JSON object and as Markdown; of a longer table the first `most` rows are shown, and it is said how many there are."""
    data, lines = {}, []
    for title, df in sections.items():
        n = df.count()
        rows = [r.asDict(recursive=True) for r in df.limit(most).collect()]
        data[title] = {"rows": n, "shown": rows}
        lines += [f"## {title}", "", "| " + " | ".join(df.columns) + " |", "|" + " --- |" * len(df.columns)]
        lines += ["| " + " | ".join("" if r[c] is None else str(r[c]) for c in df.columns) + " |" for r in rows]
        lines += [f"({len(rows)} of {n} rows)" if n > len(rows) else "", ""]
    return data, "\n".join(lines)


def write_report(spark: SparkSession, sections: dict[str, DataFrame], path: str) -> None:
    """The sections as <path>/report.json and <path>/report.md, on any store that Spark writes to."""
    data, text = render(sections)
    for name, content in (("report.json", json.dumps(data, default=str, indent=1, ensure_ascii=False)), ("report.md", text)):
        fs, p = _files(spark, f"{path.rstrip('/')}/{name}")
        out = fs.create(p, True)
        out.write(content.encode())
        out.close()
