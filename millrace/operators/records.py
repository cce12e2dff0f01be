"""Selecting, enriching and merging records without guessing: what is unknown stays null, contradictions are marked."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def excluded(rows: DataFrame, exclusions: DataFrame, on: str | list[str]) -> DataFrame:
    return rows.join(exclusions, on, "left_anti")


def first_of_each(rows: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """One row of each key, the first in the order."""
    return capped(rows, key, order, 1)


def capped(rows: DataFrame, key: list[str], order: list[Column], most: int) -> DataFrame:
    """At most `most` rows of each key; Spark cuts groups before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    return rows.withColumn("__rank", rank).where(F.col("__rank") <= most).drop("__rank")


def merged(*parts: DataFrame) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def one_of_each(rows: DataFrame, on: list[str], columns: list[str]) -> DataFrame:
    """One row of each key: of each column the only value that isn't null, or null where there are several.

    `several` tells of the keys where that happened."""
    least = rows.groupBy(*on).agg(*(F.struct(F.min(c).alias("low"), F.max(c).alias("high")).alias(c) for c in columns))
    several = F.lit(False)
    for c in columns:
        several = several | F.coalesce(F.col(c)["low"] != F.col(c)["high"], F.lit(False))
    return least.select(*on, several.alias("several"), *(F.when(F.col(c)["low"] == F.col(c)["high"], F.col(c)["low"]).alias(c) for c in columns))


def enriched(rows: DataFrame, details: DataFrame, on: list[str], columns: list[str], previous: DataFrame | None = None) -> DataFrame:
    """rows with columns of details, matched by keys that name the event; what rows know already wins.

    `conflict` marks a known value that details contradict, or details that contradict one another, which give none; `matched` a
    found partner. Without one, the previous value stays. Rows are never doubled; where rows have a column of a mark's name, they keep
    it and the mark is `enriched_conflict` or `enriched_matched`."""
    marks = {m: f"enriched_{m}" if m in rows.columns else m for m in ("matched", "conflict")}
    found = one_of_each(details, on, columns)
    out = rows.join(found.select(*on, *(F.col(c).alias(f"__new_{c}") for c in columns), F.col("several").alias("__several"), F.lit(True).alias("__matched")), on, "left")
    if previous is not None:
        out = out.join(one_of_each(previous, on, columns).select(*on, *(F.col(c).alias(f"__old_{c}") for c in columns)), on, "left")
    conflict = F.coalesce("__several", F.lit(False))
    for c in columns:
        mine = F.col(c) if c in rows.columns else F.lit(None)
        conflict = conflict | F.coalesce(mine != F.col(f"__new_{c}"), F.lit(False))
    out = out.withColumns({marks["conflict"]: conflict, marks["matched"]: F.coalesce("__matched", F.lit(False))})
    for c in columns:
        sources = ([F.col(c)] if c in rows.columns else []) + [F.col(f"__new_{c}")] + ([F.col(f"__old_{c}")] if previous is not None else [])
        out = out.withColumn(c, F.coalesce(*sources))
    return out.drop("__several", "__matched", *(f"__{k}_{c}" for k in ("new", "old") for c in columns))


def counts(rows: DataFrame, by: str) -> DataFrame:
    """Rows of each value of `by`, and of all under null."""
    return rows.rollup(by).agg(F.count(F.lit(1)).alias("n"))


def located(rows: DataFrame, areas: DataFrame, on: str | list[str]) -> DataFrame:
    """rows with the area of their key; an unknown key has none, nor has one that several areas claim."""
    keys = [on] if isinstance(on, str) else on
    return rows.join(one_of_each(areas, keys, [c for c in areas.columns if c not in keys]).drop("several"), keys, "left")


def divisions(text: Column) -> Column:
    """All divisions of a category field, side by side, each once."""
    return F.array_distinct(F.filter(F.transform(F.split(text, "[/・、,]"), lambda x: F.trim(x)), lambda x: x != ""))


def eligibility(text: Column) -> Column:
    """(min_age, flags) as far as the text says so."""
    age = F.regexp_extract(text, r"(\d+)歳以上", 1)
    flags = F.array(F.when(text.rlike("学生不可"), "no students"), F.when(text.rlike("A級.*オープン|B級.*登録"), "other conditions apply"))
    return F.struct(F.when(age != "", age.cast("int")).alias("min_age"), F.filter(flags, lambda x: x.isNotNull()).alias("flags"))


def searched(rows: DataFrame, **wanted) -> DataFrame:
    """The rows whose columns have the wanted values; a list names several."""
    for column, value in wanted.items():
        rows = rows.where(F.col(column).isin(value) if isinstance(value, list) else F.col(column) == value)
    return rows
