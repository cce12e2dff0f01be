"""What may be adopted: checks of a source against its last good state, and the fallback to it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def valid_payload(json: Column, key: str) -> Column:
    """Whether the text is a JSON object whose `key` holds an array that isn't empty; false for what doesn't parse."""
    parsed = F.from_json(json, f"struct<`{key}`: array<string>>")
    return F.coalesce(F.size(parsed[key]) > 0, F.lit(False))


def report(previous: DataFrame, current: DataFrame, source: str, date: str | None = None, earliest=None, latest=None) -> DataFrame:
    """(source, n_previous, n_current, accepted, reason): one row for each source of either side.

    A source is rejected when it has shrunk, is missing, or has a date outside the limits; a new one is accepted. Null is a
    source like any other."""
    bad = F.lit(0)
    if date is not None:
        out = F.lit(False)
        for limit, beyond in ((earliest, lambda: F.col(date) < earliest), (latest, lambda: F.col(date) > latest)):
            out = out | beyond() if limit is not None else out
        bad = F.sum(F.coalesce(out, F.lit(False)).cast("int"))
    was = previous.groupBy(F.col(source).alias("__was")).agg(F.count(F.lit(1)).alias("n_previous"))
    now = current.groupBy(F.col(source).alias("__now")).agg(F.count(F.lit(1)).alias("n_current"), bad.alias("n_bad") if date else F.lit(0).alias("n_bad"))
    both = was.join(now, F.col("__was").eqNullSafe(F.col("__now")), "full").fillna(0, ["n_previous", "n_current", "n_bad"])
    both = both.withColumn(source, F.coalesce("__was", "__now"))
    reason = F.when(F.col("n_current") == 0, "missing").when(F.col("n_current") < F.col("n_previous"), "fewer rows").when(F.col("n_bad") > 0, "bad dates")
    return both.select(source, "n_previous", "n_current", reason.isNull().alias("accepted"), F.coalesce(reason, F.lit("")).alias("reason"))


def same_columns(previous: DataFrame, current: DataFrame) -> bool:
    """Whether the columns are the same, by name and type, whatever their order."""
    return sorted(previous.dtypes) == sorted(current.dtypes)


def last_good(previous: DataFrame, current: DataFrame, source: str, verdict: DataFrame | None = None) -> DataFrame:
    """The current rows of accepted sources and the previous ones of the others, marked served_from_previous."""
    if not same_columns(previous, current):
        return previous.withColumn("served_from_previous", F.lit(True))
    verdict = report(previous, current, source) if verdict is None else verdict
    accepted, rejected = (verdict.where(F.col("accepted") == x).select(F.col(source).alias("__source")) for x in (True, False))
    same = F.col(source).eqNullSafe(F.col("__source"))
    fresh = current.join(accepted, same, "left_semi").withColumn("served_from_previous", F.lit(False))
    return fresh.unionByName(previous.join(rejected, same, "left_semi").withColumn("served_from_previous", F.lit(True)))


def lost_rows(previous: DataFrame, following: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Rows of previous that following lacks, as a multiset, on all columns or some."""
    columns = columns or previous.columns
    return previous.select(*columns).exceptAll(following.select(*columns))
