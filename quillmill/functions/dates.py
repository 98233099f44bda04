"""Date columns, kept as calendar dates until they are written."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from quillmill.functions.text import let

DATE_OUT = "yyyy-MM-dd"

_MONTHS = "jan feb mar apr may jun jul aug sep oct nov dec".split()
_MONTH = r"^(?:jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|sept?(?:ember)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?)$"
_NUMBER = r"^(?:\d{1,2}|\d{4})$"
_TIME = r"(?<!\d)(?:\d{1,2}:\d{2}(?::\d{2})?(?:[.,]\d+)?\s*(?:[ap]\.?m\b\.?)?|\d{1,2}\s*[ap]\.?m\b\.?)\s*(?:z\b|(?:utc|gmt)?\s*[+-]\d{2}:?\d{2}\b)?"
# Dates of numbers alone: year first, eight digits, or year last.
_NUMBERS = r"(?<![\d.])(?:(\d{4})[-/.](\d{1,2})[-/.](\d{1,2})|(\d{4})(\d{2})(\d{2})|(\d{1,2})([-/.])(\d{1,2})[-/.](\d{4}|\d{2}))(?![\d])"
_EPOCH = r"^\d{10}(?:\d{3})?(?:\.\d+)?$"


def week_end_date(week: Column) -> Column:
    """Sunday of publication week ``w``; week 1 ends 2020-02-09.

    The weeks run from the first to the last calendar week of 2020 (w = -4 … 49);
    other values give null.
    """
    sunday = F.date_add(F.lit("2020-02-09").cast("date"), (7 * (week - 1)).cast("int"))
    return F.when(week.between(-4, 49), sunday)


def tweet_date(created_at: Column) -> Column:
    """Day of ``Sun Mar 01 23:59:59 +0000 2020`` in the stamp's own offset."""
    month_day = F.substring(created_at, 5, 6)
    return F.try_to_date(F.concat(month_day, F.lit(" "), F.right(created_at, F.lit(4))), "MMM dd yyyy")


def _whole_year(year: Column) -> Column:
    """Years of two digits lie between 1969 and 2068."""
    short = F.when(year.cast("int") < 69, F.concat(F.lit("20"), year)).otherwise(F.concat(F.lit("19"), year))
    return F.when(F.length(year) == 4, year).when(F.length(year) == 2, short)


def _date(year: Column, month: Column, day: Column) -> Column:
    return F.try_to_date(F.concat_ws("-", _whole_year(year), F.when(F.length(month) <= 2, month), F.when(F.length(day) <= 2, day)), "yyyy-M-d")


def _named_date(text: Column) -> Column:
    """Date around a month's name: what stands next to it tells day and year apart."""

    def around(parts: Column) -> Column:
        at = F.array_position(F.transform(parts, lambda p: p.rlike(_MONTH)), True).cast("int")
        before, name, after, then = (F.get(parts, at + i) for i in (-2, -1, 0, 1))
        month = ((F.position(F.substring(name, 1, 3), F.lit("".join(_MONTHS))) + 2) / 3).cast("int").cast("string")
        month_first = (F.length(after) <= 2) & ((F.length(then) == 4) | before.isNull())
        found = (
            F.when(month_first, _date(then, month, after))
            .when(F.length(before) == 4, _date(before, month, after))
            .otherwise(_date(after, month, before))
        )
        return F.when(at > 0, found)

    tokens = F.regexp_extract_all(text, F.lit(r"\d+|[a-z]+"), 0)
    return let(F.filter(tokens, lambda t: t.rlike(_MONTH) | t.rlike(_NUMBER)), around)


def _numeric_date(text: Column) -> Column:
    """The first date of numbers: ``M/D/Y`` unless it has points or the first can be no month."""
    part = lambda i: F.regexp_extract(F.regexp_extract(text, _NUMBERS, 0), _NUMBERS, i)
    day_first = (part(8) == ".") | (part(7).try_cast("int") > 12)
    return (
        F.when(part(1) != "", _date(part(1), part(2), part(3)))
        .when(part(4) != "", _date(part(4), part(5), part(6)))
        .when(part(7) == "", F.lit(None))
        .when(day_first, _date(part(10), part(9), part(7)))
        .otherwise(_date(part(10), part(7), part(9)))
    )


def article_date(c: Column) -> Column:
    """Free-form date to a calendar date; null when there is none.

    The parts of the text are classed as months, numbers and noise, and chosen by their
    places: a day and a year on the sides of a month's name, else year first, eight
    digits, ``M/D/Y``, ``M-D-Y`` (day first where the first number can be no month) and
    ``D.M.Y``. Times, offsets, weekdays and other words may stand anywhere. Years may have two
    digits; a text of 10 or 13 digits is seconds or milliseconds since 1970, in UTC.
    """

    def read(text: Column) -> Column:
        seconds = F.substring(text, 1, 10).try_cast("bigint")
        epoch = F.date_add(F.lit("1970-01-01").cast("date"), F.floor(seconds / 86_400).cast("int"))
        return F.when(text.rlike(_EPOCH), epoch).otherwise(let(F.regexp_replace(text, _TIME, " "), lambda t: F.coalesce(_named_date(t), _numeric_date(t))))

    return let(F.lower(F.trim(c)), read)


def iso_date(d: Column) -> Column:
    """``YYYY-MM-DD`` text of a date."""
    return F.date_format(d, DATE_OUT)
