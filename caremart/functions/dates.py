"""Dates in many written forms, and date keys.

Trying formatter after formatter costs one caught exception per failed form and row. Here the digits of a text are masked once;
the common forms are told apart by looking the mask up in sets of constants, put into ISO order by position and cast, without
a pattern. Only a text that no mask fits goes through patterns. ``with_parsed_date`` gives text and mask columns of their own, which
lets Spark compile all but the patterns; ``parse_date`` is the same reading as one expression, which is interpreted.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caremart.functions.text import strip, stripped

# Years a lenient parse may yield, and the date that stands in for an unreadable one.
PLAUSIBLE_YEARS = (2020, 2030)
FALLBACK_DATE = dt.date(2025, 1, 1)

Years = tuple[int, int] | None

# ---- common forms, by mask -----------------------------------------------------------------------------------------------------

_CLOCKS = ("00:00", "0:00", "00:00:00", "0:00:00")
_EXACT_CLOCKS = (*_CLOCKS, "00:00:00.000", "00:00:00.000000")


def _masks(dates: tuple[str, ...], joints: tuple[str, ...], clocks: tuple[str, ...]) -> list[str]:
    """The masks of some dates, alone and with a time behind."""
    return [*dates, *(f"{d}{j}{c}" for d, j, c in product(dates, joints, clocks))]


_ISO_MASKS = _masks(("0000-00-00", "0000-0-00", "0000-00-0", "0000-0-0"), (" ", "T"), _EXACT_CLOCKS)
# A time with an offset is read as the local time that is written: the day must not move.
_ZONED_MASKS = [f"0000-00-00T00:00:00{zone}" for zone in ("Z", "+00:00", "-00:00", "+0000", "-0000")]
_YEAR_FIRST_MASKS = _masks(tuple(f"0000{sep}00{sep}00" for sep in "/. "), (" ",), _CLOCKS)
# (digits of the first field, digits of the second field, masks)
_DAY_FIRST_MASKS = [
    (a, b, [m for sep in "/-" for m in _masks((f"{'0' * a}{sep}{'0' * b}{sep}0000",), (" ",), _CLOCKS)])
    for a, b in product((2, 1), repeat=2)
]
# Not the plain forms: the month comes first where the text leaves it open.
_MONTH_FIRST_MASKS = [f"00{sep}00{sep}0000{end}" for sep, end in (
    ("/", " 00:00:00.000"), ("/", " 00:00:00.000000"), ("-", " 00:00:00.000"), ("-", " 00:00:00.000000"), ("/", "T00:00:00"), ("-", "T00:00:00"),
    (".", ""), (".", " 00:00"), (".", " 00:00:00"), (" ", ""), (" ", " 00:00"), (" ", " 00:00:00"))]
_MONTH_FIRST_ZONED = [f"00/00/0000 00:00{zone}" for zone in ("Z", "+00:00", "-00:00", "+0000", "-0000")]
_COMPACT_MASK, _COMPACT_TIME_MASK, _MONTH_MASK = "00000000", "00000000 0000", "00/0000"

# ---- other forms, by pattern, in lower case ------------------------------------------------------------------------------------

# English month names, whole or in short.
_MONTH_NAMES = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
_NAME = (r"(jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|sep(?:t(?:ember)?)?"
         r"|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?)")
_WEEKDAY = r"(?:mon|tues?|wed(?:nes)?|thu(?:rs?)?|fri|sat(?:ur)?|sun)(?:day)?"
_TH = r"(?:st|nd|rd|th)?"

#: What a readable text is made of; anything else is given up at its first other word.
_WORDS = rf"(?Ui)^(?>[\d\s:.,/+-]|{_NAME}|{_WEEKDAY}|st|nd|rd|th|of|[ap]m|[htz])++$"

_CLOCK = r"(\d{1,2}:\d{1,2}(?::\d{1,2}(?:\.\d{1,6})?)?)"
_ZONE = r"(?: ?(?:z|[+-]\d\d(?::?\d\d)?))?"
_TIME = rf"(?:[ t]{_CLOCK}{_ZONE})?"
_PLAIN_TIME = r"(?: (\d{1,2}:\d{1,2}(?::\d{1,2})?))?"
_DAY = r"(3[01]|[12]\d|0[1-9]|[1-9])"
_MONTH = r"(1[0-2]|0[1-9]|[1-9])"

# In these forms the month comes before the day where the text leaves it open; the other reading is tried next.
# (shape, readings in ISO order)
_SHAPES = (
    (rf"^(\d{{4}})([-/.])(\d{{1,2}})\2(\d{{1,2}}){_TIME}$", ("$1-$3-$4 $5",)),
    (rf"^(\d{{4}}) (\d{{1,2}}) (\d{{1,2}}){_TIME}$", ("$1-$2-$3 $4",)),
    (r"^(\d{4})[-/](\d{1,2})$", ("$1-$2-1",)),
    (r"^(\d{4})$", ("$1-1-1",)),
    (rf"^(\d{{1,2}})([-/. ])(\d{{1,2}})\2(\d{{4}}){_TIME}$", ("$4-$1-$3 $5", "$4-$3-$1 $5")),
    (rf"^(\d{{1,2}})([-/.])(\d{{1,2}})\2(\d{{2}}){_TIME}$", ("20$4-$1-$3 $5", "20$4-$3-$1 $5")),
    (r"^(\d{1,2})[-/](\d{4})$", ("$2-$1-1",)),
    (r"^(\d{4})(\d\d)(\d\d)[ t]?(\d\d):?(\d\d)$", ("$1-$2-$3 $4:$5",)),
    (r"^(\d{4})(\d\d)(\d\d)[ t]?(\d\d):?(\d\d):?(\d\d)$", ("$1-$2-$3 $4:$5:$6",)),
)
# A plain date with an unusual time or blanks, day first; and digits with a missing zero, year first.
_PLAIN = (rf"^(\d{{1,2}})([-/])(\d{{1,2}})\2(\d{{4}}){_PLAIN_TIME}$", ("$4-$3-$1 $5", "$4-$1-$3 $5"))
_RUN_TOGETHER = ((rf"^(\d{{4}}){_MONTH}{_DAY}$", "$1-$2-$3"), (rf"^{_DAY}{_MONTH}(\d{{4}})$", "$3-$2-$1"))
# (shape, groups of year, month name, day and time); a missing day is the first.
_NAMED_SHAPES = (
    (rf"^(?:{_WEEKDAY},? )?{_NAME}\.?[ -](\d{{1,2}}){_TH},?[ -](\d{{4}}|\d\d){_TIME}$", (3, 1, 2, 4)),
    (rf"^(?:{_WEEKDAY},? )?(\d{{1,2}}){_TH}[- ](?:of )?{_NAME}\.?,?[- ](\d{{4}}|\d\d){_TIME}$", (3, 2, 1, 4)),
    (rf"^(\d{{4}})[- ]{_NAME}[- ](\d{{1,2}}){_TIME}$", (1, 2, 3, 4)),
    (rf"^(){_NAME}\.?,?[- ](\d{{4}})$", (3, 2, 1, 1)),
)

# Written forms read by the strict parse: seconds only after year-first, none after day-first.
_STRICT_YEAR_FIRST = r"^\d{4}-\d{1,2}-\d{1,2}( \d{1,2}:\d{1,2}:\d{1,2})?$"
_STRICT_DAY_FIRST = (r"^(\d{1,2})([-/])(\d{1,2})\2(\d{4})( \d{1,2}:\d{1,2})?$", "$4-$3-$1$5")


def _as_timestamp(iso: Column, years: Years) -> Column:
    """The timestamp of a text in ISO order, NULL if it is no date or outside the years.

    A month beyond 12 is seen before the cast, which would come to the same NULL by way of a caught exception.
    """
    real = (F.substring(iso, 7, 1) == "-") | (F.substring(iso, 6, 2) <= "12")
    if years is not None:
        low, high = (f"{y:04d}" for y in years)
        real = F.substring(iso, 1, 4).between(low, high) & real
    return F.when(real, iso.try_cast("timestamp"))


def _joined(*parts: Column) -> Column:
    """Year, month and day as an ISO date, with what follows."""
    year, month, day, *rest = parts
    return F.concat(year, F.lit("-"), month, F.lit("-"), day, *rest)


def _by_mask(text: Column, mask: Column) -> tuple[Column, Column]:
    """The first and the second reading of a text of a common form, in ISO order; NULL for other texts."""
    cut = lambda at, n: F.substring(text, at, n)

    def fields(a: int, b: int) -> tuple[Column, ...]:
        """Two fields of ``a`` and ``b`` digits, the year and the time behind them."""
        return cut(1, a), cut(a + 2, b), cut(a + b + 3, 4), cut(a + b + 7, 99)

    def two_fields(chain: Column, day_first: bool) -> Column:
        for a, b, masks in _DAY_FIRST_MASKS:
            one, two, year, time = fields(a, b)
            chain = chain.when(mask.isin(masks), _joined(year, *((two, one) if day_first else (one, two)), time))
        return chain

    first = (
        two_fields(F.when(mask.isin(_ISO_MASKS), text), True)
        .when(mask == _COMPACT_MASK, _joined(cut(1, 4), cut(5, 2), cut(7, 2)))
        .when(mask.isin(_ZONED_MASKS), cut(1, 19))
        .when(mask.isin(_YEAR_FIRST_MASKS), _joined(cut(1, 4), cut(6, 2), cut(9, 99)))
        .when(mask.isin(_MONTH_FIRST_MASKS), _joined(cut(7, 4), cut(1, 2), cut(4, 2), cut(11, 99)))
        .when(mask.isin(_MONTH_FIRST_ZONED), _joined(cut(7, 4), cut(1, 2), cut(4, 2), cut(11, 6)))
        .when(mask == _COMPACT_TIME_MASK, _joined(cut(1, 4), cut(5, 2), cut(7, 3), cut(10, 2), F.lit(":"), cut(12, 2)))
        .when(mask == _MONTH_MASK, _joined(cut(4, 4), cut(1, 2), F.lit("1")))
    )
    second = (
        two_fields(F.when(mask == _COMPACT_MASK, _joined(cut(5, 4), cut(3, 2), cut(1, 2))), False)
        .when(mask.isin(_MONTH_FIRST_MASKS), _joined(cut(7, 4), cut(4, 2), cut(1, 2), cut(11, 99)))
        .when(mask.isin(_MONTH_FIRST_ZONED), _joined(cut(7, 4), cut(4, 2), cut(1, 2), cut(11, 6)))
    )
    return first, second


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once.

    Written out, each use would repeat the expression, and the generated method would outgrow what the virtual machine compiles. A
    lambda is interpreted, step by step of a short chain.
    """
    return F.get(F.transform(F.array(value), body), 0)


def _named_iso(text: Column, shape: str, groups: tuple[int, int, int, int]) -> Column:
    """ISO order of a text with a month name, by one run of its shape."""

    def put(parts: Column) -> Column:
        year, month, day, time = (F.get(parts, n) for n in range(4))
        place = F.position(F.substring(month, 1, 3), F.lit("".join(_MONTH_NAMES)))
        century = F.when(F.length(year) == 2, F.lit("20")).otherwise(F.lit(""))
        first = F.when(F.length(day).isin(1, 2), day).otherwise(F.lit("1"))
        clock = F.when(F.contains(time, F.lit(":")), time).otherwise(F.lit(""))
        return F.concat(century, year, F.lit("-"), F.floor((place + 2) / 3).cast("string"), F.lit("-"), first, F.lit(" "), clock)

    # No shape has a bar in it.
    return _let(F.split(F.regexp_replace(text, shape, "|".join(f"${g}" for g in groups)), r"\|"), put)


def _iso_reading(text: Column, plain: Column, nth: int) -> Column:
    """The first or second reading of a text in ISO order, by the first shape that fits and has one; NULL if none does."""
    chain = F.when(plain & text.rlike(_PLAIN[0]), F.regexp_replace(text, _PLAIN[0], _PLAIN[1][nth]))
    for shape, readings in _SHAPES:
        if nth < len(readings):
            chain = chain.when(text.rlike(shape), F.regexp_replace(text, shape, readings[nth]))
    shape, reading = _RUN_TOGETHER[nth]
    chain = chain.when(text.rlike(shape), F.regexp_replace(text, shape, reading))
    # Every month name has one of these letters, and no other shape does.
    named = text.rlike("[aeou]")
    if nth:
        return F.when(~named, chain)
    (shape, groups), *others = _NAMED_SHAPES
    by_name = F.when(text.rlike(shape), _named_iso(text, shape, groups))
    for shape, groups in others:
        by_name = by_name.when(text.rlike(shape), _named_iso(text, shape, groups))
    return F.when(named, by_name).otherwise(chain)


def _by_pattern(text: Column, years: Years) -> Column:
    """The reading of a trimmed text of any other form."""

    def read(blanks: Column, turned: Column) -> Column:
        # Written as day and month and nothing unusual: the day comes first.
        plain = blanks == turned
        return F.coalesce(*[_let(_iso_reading(turned, plain, nth), lambda iso: _as_timestamp(iso, years)) for nth in (0, 1)])

    def of_blanks(blanks: Column) -> Column:
        half = F.right(blanks, F.lit(2))
        whole = F.when(half.isin("am", "pm"), F.regexp_replace(blanks, " ?[ap]m$", "")).otherwise(blanks)
        # "8h55" is a time, and a time may come first.
        spoken = F.when(F.contains(whole, F.lit("h")), F.regexp_replace(whole, r"(\d)h(\d\d)", "$1:$2")).otherwise(whole)
        turned = lambda t: F.when(t.rlike(r"^\d\d?:"), F.regexp_replace(t, rf"^{_CLOCK} (.*\d)$", "$2 $1")).otherwise(t)
        # Hours above 12 say the half of the day themselves.
        hour = F.regexp_extract(whole, r"(\d{1,2})[:h]\d\d(?::\d\d)?$", 1).try_cast("int")
        shift = F.when((half == "pm") & (hour < 12), F.expr("INTERVAL 12 HOURS")).when(
            (half == "am") & (hour == 12), F.expr("INTERVAL -12 HOURS")).otherwise(F.expr("INTERVAL 0 HOURS"))
        found = _let(spoken, lambda said: _let(turned(said), lambda t: read(blanks, t)))
        return F.when(half.isin("am", "pm"), found + shift).otherwise(found)

    # Mostly there is nothing but single blanks.
    single = F.when(
        text.rlike(r"(?U)[^\S ]|  "), _let(F.lower(F.regexp_replace(text, r"(?U)\s+", " ")), lambda t: t)).otherwise(F.lower(text))
    return F.when(text.rlike(_WORDS), _let(single, of_blanks))


#: Columns of ``with_parsed_date`` on the way.
_ON_THE_WAY = ("_date_texte", "_date_masque", "_date_iso")


def _mask(trimmed: Column) -> Column:
    return F.translate(trimmed, "123456789", "000000000")


def _reading(trimmed: Column, first: Column, second: Column, years: Years) -> Column:
    """The date of a trimmed text, given its readings by mask."""
    common = F.coalesce(_as_timestamp(first, years), _let(second, lambda other: _as_timestamp(other, years)))
    return F.when(first.isNotNull(), common).otherwise(_by_pattern(trimmed, years))


def parse_date(text: Column, years: Years = PLAUSIBLE_YEARS) -> Column:
    """The first reading of the text that is a real date within the plausible years, else NULL.

    A reading outside the window does not end the search, the next one is tried. A time with an offset is read as the local
    time that is written: the day must not move.
    """

    def of_readings(trimmed: Column, first: Column, second: Column) -> Column:
        return _let(first, lambda iso: _reading(trimmed, iso, second, years))

    return _let(strip(text), lambda trimmed: _let(_mask(trimmed), lambda mask: of_readings(trimmed, *_by_mask(trimmed, mask))))


def _in_place(value: Column) -> Column:
    """``value``, which no later condition is moved below.

    To filter early, Spark copies into a condition all that its columns are computed from, a copy for each use on the way: a plan with a condition on a
    date outgrew the driver. An expression that names its task stays where it is, and the condition above it.
    """
    return F.when(F.spark_partition_id() >= 0, value)


def with_parsed_date(df: DataFrame, column: str, years: Years = PLAUSIBLE_YEARS) -> DataFrame:
    """``df`` with the text of ``column`` replaced by its ``parse_date``.

    The trimmed text, its mask and its first reading are columns on the way, each computed once, also under a condition on the date. The lambdas of the
    last step keep it out of whole-stage code, whose one method would outgrow what the virtual machine compiles; Spark splits that step into small methods.
    """
    text, mask, first = (F.col(c) for c in _ON_THE_WAY)
    masked = df.withColumn(_ON_THE_WAY[0], stripped(F.col(column))).withColumn(_ON_THE_WAY[1], _mask(text))
    one, other = _by_mask(text, mask)
    read = masked.withColumn(_ON_THE_WAY[2], one)
    return read.withColumn(column, _in_place(_reading(text, first, other, years))).drop(*_ON_THE_WAY)


def parse_date_or(text: Column, default: dt.date = FALLBACK_DATE, years: Years = PLAUSIBLE_YEARS) -> Column:
    """``parse_date`` with a stand-in for unreadable dates."""
    return F.coalesce(parse_date(text, years), F.lit(default).cast("timestamp"))


def parse_date_strict(text: Column) -> Column:
    """Few written forms, any year, no tolerant reading, no stand-in."""
    clean = F.regexp_replace(strip(text), r"(?U)\s+", " ")
    day_first = F.regexp_replace(clean, *_STRICT_DAY_FIRST)
    return F.when(clean.rlike(_STRICT_YEAR_FIRST), clean.try_cast("timestamp")).when(
        clean.rlike(_STRICT_DAY_FIRST[0]), day_first.try_cast("timestamp"))


def date_key(day: Column) -> Column:
    """The day as the integer yyyymmdd."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")
