"""Raw-string TSV sources, columnar tables and list sinks.

Everything is read as text with a fixed schema; nothing is inferred and no string means NULL by itself.
"""

from __future__ import annotations

import tempfile
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

RECORD = ["entity_id", "business_name", "business_address", "country"]


class ParseError(ValueError):
    """The rows read are not the lines of the file."""


def data_lines(spark: SparkSession, path: str) -> int:
    """Lines after the header that are not blank."""
    return max(0, spark.read.text(path).filter(F.trim("value") != "").count() - 1)


def _rows(spark: SparkSession, path: str, header: list[str], quoted: bool) -> DataFrame:
    schema = T.StructType([T.StructField(c, T.StringType()) for c in header])
    reader = spark.read.schema(schema).option("sep", "\t").option("header", True).option("nullValue", "\u0000").option("emptyValue", "").option("enforceSchema", True)
    return reader.option("quote", '"' if quoted else "").option("multiLine", quoted).csv(path)


def read_tsv(spark: SparkSession, path: str, columns: list[str] = RECORD) -> tuple[DataFrame, dict]:
    """The expected columns as strings, and what was found: rows, lines, extra columns, whether quoting was given up.

    Quoted first; if that yields another number of rows than there are lines, a stray quote has eaten some,
    and the file is read without quoting.
    """
    first = spark.read.text(path).limit(1).collect()
    header = [c.strip() for c in first[0][0].split("\t")] if first else []
    missing = [c for c in columns if c not in header]
    if missing:
        raise ParseError(f"{path} lacks {missing}")
    lines = data_lines(spark, path)
    info = {"lines": lines, "extra": [c for c in header if c not in columns], "unquoted": False}
    df = _rows(spark, path, header, True)
    info["rows"] = df.count()
    if info["rows"] != lines:
        df = _rows(spark, path, header, False)
        info |= {"rows": df.count(), "unquoted": True}
    info["warning"] = info["rows"] != lines
    return df.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in columns]), info


def load_source(spark: SparkSession, path: str, columns: list[str] = RECORD) -> DataFrame:
    """A prepared Parquet table or a TSV; a TSV that does not parse whole is an error. Ids lose surrounding space."""
    if path.endswith(".tsv"):
        df, info = read_tsv(spark, path, columns)
        if info["warning"]:
            raise ParseError(f"{path}: {info['rows']} rows from {info['lines']} lines")
    else:
        df = spark.read.parquet(path).select(*columns)
    return df.withColumn(columns[0], F.trim(columns[0]))


def prepare(spark: SparkSession, sources: dict[tuple[str, int], str], out: str) -> None:
    """One Parquet table of all TSV sources, partitioned by split and source."""
    parts = [load_source(spark, path).withColumns({"split": F.lit(split), "source": F.lit(k)}) for (split, k), path in sources.items()]
    reduce(DataFrame.unionByName, parts).write.mode("overwrite").partitionBy("split", "source").parquet(out)


def write_table(df: DataFrame, path: str, *partitions: str) -> None:
    """Overwrites only the partitions that df has, so a rerun of some of them leaves the others alone."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    (writer.partitionBy(*partitions) if partitions else writer).parquet(path)


def read_table(spark: SparkSession, path: str, columns: list[str] | None = None, where: Column | None = None) -> DataFrame:
    """Columns and rows asked for; both reach the scan."""
    df = spark.read.parquet(path)
    df = df if where is None else df.filter(where)
    return df.select(*columns) if columns else df


def truth_long(wide: DataFrame, id_column: str = "source1_entity_id", list_column: str = "matched_entity_ids") -> DataFrame:
    """(s1_id, matched_id, matched_source) of a comma-list truth; the source is the digit of the id's prefix."""
    items = F.filter(F.transform(F.split(F.coalesce(list_column, F.lit("")), ","), lambda x: F.trim(x)), lambda x: x != "")
    each = wide.select(F.trim(id_column).alias("s1_id"), F.explode(items).alias("matched_id"))
    return each.withColumn("matched_source", F.regexp_extract("matched_id", r"^S(\d+)-", 1))


def block_inputs(represented: DataFrame, splits: DataFrame, columns: list[str]) -> DataFrame:
    """The columns that blocking needs, with each record's split; a record without one is an error raised by the scan."""
    joined = represented.select(*columns).join(splits.select("entity_id", "split"), "entity_id", "left")
    return joined.withColumn("split", F.coalesce("split", F.raise_error(F.concat(F.lit("no split for "), F.col("entity_id"))).cast("string")))


def write_lists(df: DataFrame, path: str, compression: str = "none") -> None:
    """Rows (such as s1_id, matches) as TSV without quoting; with compression 'gzip' as .gz files."""
    df.write.mode("overwrite").option("compression", compression).option("sep", "\t").option("header", True).option("quote", "").option("emptyValue", "").csv(path)


def keyed(df: DataFrame, key: str) -> DataFrame:
    """df, checked to have each key once: a repeated one is an error raised when it is read."""
    n = F.count("*").over(Window.partitionBy(key))
    return df.withColumn("n_", n).withColumn(key, F.when(F.col("n_") == 1, F.col(key)).otherwise(F.raise_error(F.concat(F.lit("repeated key "), F.col(key).cast("string"))))).drop("n_")


def materialized(df: DataFrame) -> DataFrame:
    """df, computed once and written to the cluster's checkpoint folder (a local one only where it names none): later steps start
    from the files, whatever executors are lost meanwhile, and carry none of the plan that led there."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(df.sparkSession.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="checkpoint-"))
    return df.checkpoint(eager=True)
