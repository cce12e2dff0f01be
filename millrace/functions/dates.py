"""Column functions on dates of a fiscal year that begins in April, and on what texts say about them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fiscal_year(day: Column) -> Column:
    """The year in which the day's fiscal year begins: January to March belong to the year before."""
    return F.year(day) - F.when(F.month(day) <= 3, 1).otherwise(0)


def day_in(fiscal: Column, month: Column, day: Column) -> Column:
    """The date of a month and day in a fiscal year; null where there is no such day."""
    text = F.format_string("%04d-%02d-%02d", fiscal + F.when(month <= 3, 1).otherwise(0), month, day)
    return F.when(fiscal.isNotNull() & month.isNotNull() & day.isNotNull(), F.try_to_date(text))


def days_in(text: Column, fiscal: Column) -> Column:
    """All dates of a list like "11/8,15": a month holds until the next one is named."""
    parts = F.filter(F.transform(F.split(text, "[,、・]"), lambda x: F.trim(x)), lambda x: x.rlike(r"^(\d{1,2}/)?\d{1,2}$"))

    def month_at(i: Column) -> Column:
        named = F.filter(F.slice(parts, 1, i + 1), lambda x: F.contains(x, F.lit("/")))
        return F.split_part(F.element_at(named, -1), F.lit("/"), F.lit(1)).cast("int")

    def date_at(x: Column, i: Column) -> Column:
        return F.when(F.contains(F.array_join(F.slice(parts, 1, i + 1), ","), F.lit("/")), day_in(fiscal, month_at(i), F.split_part(x, F.lit("/"), F.lit(-1)).cast("int")))

    return F.when(F.size(parts) > 0, F.transform(parts, date_at)).otherwise(F.array().cast("array<date>"))


def explicit_year_fits(day: Column, fiscal: Column) -> Column:
    """Whether a date with its year lies in the stated fiscal year."""
    return fiscal_year(day) == fiscal


def checked_deadline(day: Column, stated_weekday: Column) -> Column:
    """The deadline, null where the stated weekday (0: Monday) contradicts the date."""
    return F.when(stated_weekday.isNull() | (F.weekday(day) == stated_weekday), day)


def noted_deadline(day: Column, stated_weekday: Column, raw: Column, notes: Column) -> Column:
    """The checked deadline, the raw text as it is, and the notes, with one more where the stated weekday contradicts the date."""
    wrong = F.coalesce(F.weekday(day) != stated_weekday, F.lit(False))
    notes = F.coalesce(notes, F.array().cast("array<string>"))
    noted = F.when(wrong, F.array_append(notes, F.lit("stated weekday contradicts the date"))).otherwise(notes)
    return F.struct(checked_deadline(day, stated_weekday).alias("deadline"), raw.alias("raw"), noted.alias("notes"))


def typed_entry(label: Column, at: Column) -> Column:
    """A time by its label: entry_start for an opening, deadline for a close; nothing is guessed."""
    opening, closing = F.contains(label, F.lit("開始")), F.contains(label, F.lit("締切"))
    return F.struct(F.when(opening & ~closing, at).alias("entry_start"), F.when(closing & ~opening, F.to_date(at)).alias("deadline"))


def finished(days: Column, as_of: Column) -> Column:
    """Whether the last of the days is before as_of; unknown without days."""
    return F.array_max(days) < as_of
