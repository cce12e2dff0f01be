"""Versioned snapshots: build all or nothing, publish a pointer, find the last good one, retain the rest by rule.

A snapshot is a folder `<root>/<name>` of Parquet; names are a prefix and a version. The pointer is a table of one row in a
folder that is added, never written over; the newest one counts. All paths go through Spark, so any store will do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException


def version_key(name: Column) -> Column:
    """A version's numbers, comparable as arrays: 0.8.14 comes after 0.8.9."""
    return F.transform(F.regexp_extract_all(name, F.lit(r"(\d+)"), F.lit(1)), lambda x: x.cast("int"))


def latest(names: DataFrame, column: str, prefix: str, numeric: bool = True) -> DataFrame:
    """(latest): the newest name with the prefix, by its numbers, or by its characters as older readers did."""
    of = F.col(column)
    mine = names.where(F.startswith(of, F.lit(prefix)))
    return mine.agg((F.max_by(of, version_key(of)) if numeric else F.max(of)).alias("latest"))


def latest_holding(entries: DataFrame, name: str, file: str, wanted: str, prefix: str) -> DataFrame:
    """(latest): the newest of the names with the prefix that hold the wanted file; entries: a row for each name and file."""
    return latest(entries.where(F.col(file) == wanted), name, prefix)


def outdated(names: DataFrame, column: str, prefix: str, current: str) -> DataFrame:
    """The names to delete: those with our prefix but for the current one; foreign names are left alone."""
    return names.where(F.startswith(F.col(column), F.lit(prefix)) & (F.col(column) != current))


def first_available(*columns: Column) -> Column:
    """The first value that isn't null, in order of priority."""
    return F.coalesce(*columns)


def build(rows: DataFrame, root: str, name: str, form: str = "parquet") -> None:
    """Writes a snapshot, as Parquet or as one JSON object a line; it isn't seen until it is published."""
    rows.write.mode("error").format(form).save(f"{root}/{name}")


def publish(spark: SparkSession, root: str, name: str, at: int) -> None:
    spark.createDataFrame([(name, at)], "name string, at long").coalesce(1).write.mode("append").parquet(f"{root}/published")


def published(spark: SparkSession, root: str) -> str | None:
    try:
        row = spark.read.parquet(f"{root}/published").agg(F.max_by("name", "at")).first()
    except AnalysisException:
        return None
    return row[0]


def read_last_good(spark: SparkSession, root: str) -> DataFrame | None:
    """The published snapshot; null before the first."""
    name = published(spark, root)
    return None if name is None else spark.read.parquet(f"{root}/{name}")


def guarded_publish(rows: DataFrame, root: str, name: str, at: int, ok: bool) -> bool:
    """Builds and publishes rows if they passed; else the last good snapshot stays."""
    if ok:
        build(rows, root, name)
        publish(rows.sparkSession, root, name, at)
    return ok
