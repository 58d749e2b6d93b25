"""Date parsing and date arithmetic on text columns (NULL instead of errors)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gavelframe.functions import codebook as cb
from gavelframe.functions import text as tx

_NUMERIC = tx.at_word(r"\d", cb.NUMERIC_DATE_PATTERN)
_TEXTUAL = tx.at_word(r"\d", cb.TEXT_DATE_PATTERN, tx.UNICODE_NOCASE)


def _build(year: Column, month: Column, day: Column) -> Column:
    """ISO text from number columns, then a cast that gives NULL for 30 February."""

    def built(d: Column) -> Column:
        text = F.concat_ws(
            "-",
            F.lpad(d["year"].cast("string"), 4, "0"),
            F.lpad(d["month"].cast("string"), 2, "0"),
            F.lpad(d["day"].cast("string"), 2, "0"),
        )
        complete = d["year"].isNotNull() & d["month"].isNotNull() & d["day"].isNotNull()
        return F.when(complete, text).try_cast("date")

    return tx.bound(F.struct(year.alias("year"), month.alias("month"), day.alias("day")), built)


def numeric_date(found: Column) -> Column:
    """``d.m.y`` or ``d/m/y``; two-digit years pivot at 50."""

    def dated(parts: Column) -> Column:
        full_year = tx.bound(
            F.get(parts, 2).try_cast("int"),
            lambda year: year + F.when(year < 50, 2000).when(year < 100, 1900).otherwise(0),
        )
        return _build(full_year, F.get(parts, 1).try_cast("int"), F.get(parts, 0).try_cast("int"))

    return tx.bound(F.split(found, "[./]"), dated)


def textual_date(found: Column) -> Column:
    """``15. März 2007``, ``1er avril 2008``, ``13 settembre 2006``."""
    month = tx.lookup(tx.casefold(F.regexp_extract(found, _TEXTUAL, 2)), cb.MONTHS)
    return _build(
        F.regexp_extract(found, _TEXTUAL, 3).try_cast("int"),
        month,
        F.regexp_extract(found, _TEXTUAL, 1).try_cast("int"),
    )


def parse_date_text(c: Column) -> Column:
    """First date in a text. A numeric hit decides alone, even when invalid."""

    def first(text: Column) -> Column:
        written = tx.bound(F.regexp_extract(text, _TEXTUAL, 0), textual_date)
        return tx.bound(
            F.regexp_extract(text, _NUMERIC, 0), lambda numeric: F.when(numeric != "", numeric_date(numeric)).otherwise(written)
        )

    return tx.bound(c, first)


def find_dates(c: Column) -> Column:
    """All valid dates: the numeric ones in order, then the textual ones."""

    def found(text: Column) -> Column:
        numeric = F.transform(tx.capture_all(text, _NUMERIC, 0), numeric_date)
        return F.concat(numeric, F.transform(tx.capture_all(text, _TEXTUAL, 0), textual_date))

    return F.filter(tx.bound(c, found), lambda d: d.isNotNull())


def latest_date(c: Column) -> Column:
    return F.array_max(find_dates(c))


def iso(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd")


def iso_date_or_null(c: Column) -> Column:
    """Cast full ISO text only; Spark alone would also accept ``2007-2``."""
    full = c.rlike(r"\A\d{4}-\d{2}-\d{2}\z")
    compact = c.rlike(r"\A\d{8}\z")
    return (
        F.when(full, c.try_cast("date"))
        .when(compact, F.regexp_replace(c, r"\A(\d{4})(\d{2})(\d{2})\z", "$1-$2-$3").try_cast("date"))
    )


def days_between(end: Column, start: Column) -> Column:
    return F.date_diff(iso_date_or_null(end), iso_date_or_null(start))


def year_of(c: Column) -> Column:
    return F.when(c != "", F.substring(c, 1, 4).try_cast("int"))


def parse_day_argument(c: Column) -> Column:
    """``YYYY-MM-DD`` or ``DD.MM.YYYY`` (one-digit day/month allowed), else NULL."""
    iso_parts = F.regexp_extract_all(c, F.lit(r"\d+"), F.lit(0))
    return (
        F.when(
            c.rlike(r"\A\d{4}-\d{1,2}-\d{1,2}\z"),
            _build(*[F.get(iso_parts, i).try_cast("int") for i in (0, 1, 2)]),
        )
        .when(
            c.rlike(r"\A\d{1,2}\.\d{1,2}\.\d{4}\z"),
            _build(*[F.get(iso_parts, i).try_cast("int") for i in (2, 1, 0)]),
        )
    )


def format_day(c: Column) -> Column:
    return F.date_format(c, "dd.MM.yyyy")
