"""Command line: the steps from records to matches, each reading and writing tables.

    python -m linkloom prepare OUT train:1=a.tsv train:2=b.tsv ...
    python -m linkloom split|profile|clean|represent|validate|block|link|regamma TABLES OUT [options]

TABLES is a folder of Parquet tables as sources/entities.py binds them. Every step but prepare writes <OUT>/<step>; profile,
clean and validate also write a report, and validate ends with status 1 if a gate fails.
"""

from __future__ import annotations

import argparse
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.functions.represent import represent
from linkloom.functions.unicode import clean
from linkloom.operators import audit as A
from linkloom.operators import decide as D
from linkloom.operators import evaluate as V
from linkloom.operators import evidence as W
from linkloom.operators import profile as R
from linkloom.operators.linker import Settings, candidates, link
from linkloom.sources import entities as N
from linkloom.sources import shards as H
from linkloom.sources import tables as S

STEPS: dict[str, Callable] = {}


def step(f: Callable) -> Callable:
    STEPS[f.__name__.rstrip("_")] = f
    return f


@step
def split(spark: SparkSession, tables: str, args: argparse.Namespace) -> DataFrame:
    """Records of source 1 with their match bucket and side of the split."""
    rec, truth = N.records(spark, tables), N.truth(spark, tables)
    n = truth.groupBy("s1_id").agg(F.count("*").alias("n"))
    s1 = rec.filter("source = 1").select(F.col("entity_id").alias("s1_id"), "country").join(n, "s1_id", "left").na.fill(0, ["n"])
    strata = s1.withColumn("bucket", R.match_bucket(F.col("n"))).withColumn("stratum", F.concat_ws("|", "country", "bucket"))
    return V.stratified_split(strata, "stratum", args.val_share).drop("stratum")


@step
def profile(spark: SparkSession, tables: str, args: argparse.Namespace) -> dict[str, DataFrame]:
    rec, truth = N.records(spark, tables), N.truth(spark, tables)
    pool = rec.filter("source > 1")
    df = R.document_frequency(pool, "name_tokens")
    return {
        "sources": R.audit(rec, "source"), "truth": R.truth_checks(truth, rec.select("entity_id")), "lengths": R.length_profile(rec, "country"), "missing": R.missing_vs_matched(pool, truth),
        "duplicates": R.duplicate_groups(pool, truth), "frequent": R.top(df, 25, "df", "token", "country"), "coverage": R.coverage(truth, rec, df, [10, 100, 1000, 10_000]), "edges": R.edge_tokens(rec, 20),
    }


def _cleaned(rec: DataFrame) -> DataFrame:
    return rec.select("entity_id", "source", "country", clean("name").alias("n"), clean("address").alias("a"))


@step
def clean_(spark: SparkSession, tables: str, args: argparse.Namespace) -> DataFrame:
    return _cleaned(N.records(spark, tables)).select("entity_id", "source", "country", *[F.col(f"{x}.{c}").alias(f"{name}_{c}") for x, name in (("n", "name"), ("a", "address")) for c in ("orig", "fold", "compounds", "missing")])


@step
def audit(spark: SparkSession, tables: str, args: argparse.Namespace) -> dict[str, DataFrame]:
    return {"cleaning": A.cleaning_audit(N.records(spark, tables))}


@step
def represent_(spark: SparkSession, tables: str, args: argparse.Namespace) -> DataFrame:
    folded = _cleaned(N.records(spark, tables)).select("entity_id", "source", "country", F.col("n.fold").alias("name_fold"), F.col("a.fold").alias("address_fold"))
    return represent(folded)


@step
def validate(spark: SparkSession, tables: str, args: argparse.Namespace) -> dict[str, DataFrame]:
    gates = R.gates(N.records(spark, tables))
    return {"verdict": A.gate_verdict(gates), "gates": gates}


def _settings(args: argparse.Namespace) -> Settings:
    return Settings(budget=args.budget, keep=args.keep, folds=args.folds, mu=args.mu)


@step
def block(spark: SparkSession, tables: str, args: argparse.Namespace) -> DataFrame:
    return candidates(W.parsed(N.records(spark, tables)).drop("text"), _settings(args))


@step
def link_(spark: SparkSession, tables: str, args: argparse.Namespace) -> DataFrame:
    return link(N.records(spark, tables), N.truth(spark, tables), _settings(args))


@step
def regamma(spark: SparkSession, tables: str, args: argparse.Namespace) -> DataFrame:
    """Lists decided anew from scored pairs, once for every exponent of the scores."""
    scored, ids = N.pairs(spark, tables), N.true_counts(spark, tables).select("s1_id")
    out = None
    for gamma in args.gammas:
        one = D.expected_f(scored.withColumn("p", F.pow("p", F.lit(gamma))), args.mu).filter("pred")
        lists = V.lists(ids, one, "p").withColumn("gamma", F.lit(gamma))
        out = lists if out is None else out.unionByName(lists)
    return out


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    parser = argparse.ArgumentParser(prog="linkloom", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    parser.add_argument("step", choices=["prepare", *STEPS])
    parser.add_argument("tables", help="folder of the tables; for prepare: where to write")
    parser.add_argument("rest", nargs="+", help="where to write; for prepare: split:source=path.tsv ...")
    parser.add_argument("--again", action="store_true", help="make the step anew even if its output is there")
    parser.add_argument("--val-share", type=float, default=0.2)
    parser.add_argument("--budget", type=int, default=Settings.budget)
    parser.add_argument("--keep", type=int, default=Settings.keep)
    parser.add_argument("--folds", type=int, default=Settings.folds)
    parser.add_argument("--mu", type=float, default=0.0)
    parser.add_argument("--gammas", type=float, nargs="+", default=[1.0, 1.15, 1.35])
    args = parser.parse_args(argv)
    spark = spark or SparkSession.builder.appName("linkloom").getOrCreate()
    if args.step == "prepare":
        named = dict(x.split("=", 1) for x in args.rest)
        S.prepare(spark, {(k.split(":")[0], int(k.split(":")[1])): path for k, path in named.items()}, args.tables)
        return 0
    out = H.shard_path(args.rest[0], args.step)
    made = STEPS[args.step](spark, args.tables, args)
    if isinstance(made, DataFrame):
        H.run_shards(spark, args.rest[0], [args.step], lambda _: made, args.again)
        return 0
    H.write_report(spark, made, out)
    return int(args.step == "validate" and made["verdict"].first()["failed"] > 0)


if __name__ == "__main__":
    sys.exit(main())
