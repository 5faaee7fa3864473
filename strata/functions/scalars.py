"""Scalar rules shared by the layers, all built-in expressions."""

import functools
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.fixed_values import BLANKS, ENGLISH_MONTHS, NULL_TEXTS

NUMBER = r"^\s*[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
TIME = r"([ T]\d{1,2}:\d{2}(:\d{2}(\.\d+)?)?( ?[AaPp][Mm])?( ?(Z|[+-]\d{2}:?\d{2}))?)?$"
YEAR_FIRST = r"^\d{4}[-/]\d{1,2}[-/]\d{1,2}" + TIME
DIGITS_ONLY = r"^(\d{4})(\d{2})(\d{2})" + TIME
YEAR_LAST = r"^(\d{1,2})[-/.](\d{1,2})[-/.](\d{4}|\d{2})" + TIME
ORDINAL = r"(?:st|nd|rd|th)?"
DAY_NAMED = r"(?i)^(\d{1,2})" + ORDINAL + r"[ -]([a-z]{3,9})\.?,?[ -](\d{4}|\d{2})" + TIME
NAMED_DAY = r"(?i)^([a-z]{3,9})\.?[ -](\d{1,2})" + ORDINAL + r",?[ -](\d{4})" + TIME
NAMED = r"(?i)^([a-z]{3,9})\.?,?[ -](\d{4})$"
NO_DAY = r"^\d{4}([-/]\d{1,2})?$"
LONG_LIMIT = 9.2e18


def now_utc() -> datetime:
    return datetime.now(timezone.utc)


def stamp(at: datetime | None) -> Column:
    return F.lit(at or now_utc()).cast("timestamp")


def strip(text: Column) -> Column:
    """Remove blanks of every script from both ends."""
    return F.trim(text, F.lit(BLANKS))


def number(value: Column, kind: T.DataType) -> Column:
    """Value as double; what is no finite number becomes null."""
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        value = value.cast("double")
        return F.when(~F.isnan(value), value)
    if isinstance(kind, T.NumericType):
        return value.cast("double")
    if not isinstance(kind, T.StringType):
        return F.lit(None).cast("double")
    parsed = F.when(value.rlike(NUMBER), value.try_cast("double"))
    infinite = F.lit(float("inf"))
    return F.nullif(F.nullif(parsed, infinite), -infinite)


def whole(value: Column, kind: T.DataType) -> Column:
    """Value as bigint; long digit texts keep every digit."""
    parsed = number(value, kind).try_cast("bigint")
    if isinstance(kind, T.IntegralType):
        return value.cast("bigint")
    if isinstance(kind, T.StringType):
        digits = F.when(value.rlike(NUMBER), value.try_cast("bigint"))
        return F.coalesce(digits, parsed)
    return parsed


def round2(value: Column) -> Column:
    """Two decimals, halves of the scaled value to even."""
    return F.rint(value * 100) / 100


def ratio(top: Column, bottom: Column) -> Column:
    """Quotient of doubles; x/0 is infinite with the sign of x, 0/0 is null."""
    infinite = F.lit(float("inf"))
    return (
        F.when(bottom != 0, top / bottom)
        .when((bottom == 0) & (top > 0), infinite)
        .when((bottom == 0) & (top < 0), -infinite)
    )


def summands(value: Column, kind: T.DataType) -> list[Column]:
    """Parts of a value whose sums do not depend on row order, see ``total``.

    Whole numbers and decimals are one part. A double below 1e9 is a decimal of 18
    places, below 1e20 one of 8, which holds all digits it has; sums of 1e10 such rows
    fit. Beyond, and for infinite values, it stays a double. No number adds nothing."""
    if isinstance(kind, T.IntegralType):
        return [value.cast("decimal(20,0)")]
    if isinstance(kind, T.DecimalType):
        return [value]
    value = number(value, kind)
    size = F.abs(value)
    return [
        F.when(size < 1e9, value.cast("decimal(38,18)")),
        F.when((size >= 1e9) & (size < 1e20), value.cast("decimal(38,8)")),
        F.when(size >= 1e20, value),
    ]


def total(sums: Sequence[Column]) -> Column:
    """The sum of summed parts as a double; 0 of nothing."""
    parts = [F.coalesce(s.cast("double"), F.lit(0.0)) for s in sums]
    # From the smallest part on.
    return functools.reduce(lambda a, b: a + b, parts)


def canonical_key(value: Column, kind: T.DataType) -> Column:
    """Key as text, so that 10, 10.0 and ' 10 ' meet."""
    if isinstance(kind, T.StringType):
        return strip(value)
    if isinstance(kind, (T.FloatType, T.DoubleType, T.DecimalType)):
        is_whole = (value == F.floor(value)) & (F.abs(value) < LONG_LIMIT)
        return F.when(is_whole, value.try_cast("bigint").cast("string")).otherwise(
            value.cast("string")
        )
    return value.cast("string")


def clean_text(text: Column) -> Column:
    """Stripped upper-case text, with the texts for missing as null."""
    tidy = F.upper(strip(text))
    return F.when(~tidy.isin(NULL_TEXTS), tidy)


def as_text(value: Column, kind: T.DataType) -> Column:
    """Raw value as text; the text 'nan' is missing."""
    if isinstance(kind, (T.StructType, T.ArrayType, T.MapType)):
        text = F.to_json(value)
    elif isinstance(kind, T.BooleanType):
        text = F.when(value, "True").when(~value, "False")
    elif isinstance(kind, (T.FloatType, T.DoubleType)):
        size, text = F.abs(value), value.cast("string")
        # Outside this range the cast would show an exponent.
        in_full = F.regexp_replace(
            value.try_cast("decimal(38,18)").cast("string"), r"(\.\d+?)0+$", "$1"
        )
        text = (
            F.when((size < 1e7) & (size >= 1e-3), text)
            .when((size < 1e16) & (size >= 1e-4), in_full)
            .otherwise(text)
        )
        text = F.when(~F.isnan(value), text)
    else:
        text = value.cast("string")
    return F.when(text != "nan", text)


def parse_date(value: Column, kind: T.DataType, day_first: bool = False) -> Column:
    """Date of a timestamp, or of a text: year first, yyyymmdd, or year last, then
    month first unless ``day_first`` is set or the parts fit only the other way, or
    with the English name of the month, whole or of three letters. Texts of a year or a
    year and month are its first day. A zone is not applied. What is no date becomes
    null. Shapes are told apart by pattern, so that no row pays for failed parses."""
    if isinstance(kind, T.DateType):
        return value
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.to_date(value)
    text = canonical_key(value, kind)

    def part(pattern: str, group: int) -> Column:
        return F.regexp_extract(text, pattern, group)

    def joined(*parts: Column) -> Column:
        return F.concat_ws("-", *parts).try_cast("date")

    def full_year(year: Column) -> Column:
        return (
            F.when(F.length(year) == 4, year)
            .when(year >= "69", F.concat(F.lit("19"), year))
            .otherwise(F.concat(F.lit("20"), year))
        )

    def named(year: Column, name: Column, day: Column) -> Column:
        month = F.try_element_at(_month_numbers(), F.lower(name))
        return F.when(month.isNotNull(), joined(year, month, day))

    year = full_year(part(YEAR_LAST, 3))
    first, second = part(YEAR_LAST, 1), part(YEAR_LAST, 2)
    month_first, day_leads = joined(year, first, second), joined(year, second, first)
    year_last = (day_leads, month_first) if day_first else (month_first, day_leads)
    whole_text = F.lit(isinstance(kind, T.StringType))
    return (
        F.when(text.rlike(YEAR_FIRST), F.translate(text, "/", "-").try_cast("date"))
        .when(
            text.rlike(DIGITS_ONLY),
            joined(part(DIGITS_ONLY, 1), part(DIGITS_ONLY, 2), part(DIGITS_ONLY, 3)),
        )
        .when(text.rlike(YEAR_LAST), F.coalesce(*year_last))
        .when(
            text.rlike(DAY_NAMED),
            named(full_year(part(DAY_NAMED, 3)), part(DAY_NAMED, 2), part(DAY_NAMED, 1)),
        )
        .when(text.rlike(NAMED_DAY), named(part(NAMED_DAY, 3), part(NAMED_DAY, 1), part(NAMED_DAY, 2)))
        .when(text.rlike(NAMED), named(part(NAMED, 2), part(NAMED, 1), F.lit("1")))
        # A number of four digits is no year.
        .when(whole_text & text.rlike(NO_DAY), F.translate(text, "/", "-").try_cast("date"))
    )


def _month_numbers() -> Column:
    """Names of months, whole and short, to their numbers as text."""
    numbers = {}
    for i, name in enumerate(ENGLISH_MONTHS, 1):
        numbers |= {name: i, name[:3]: i}
    numbers["sept"] = numbers["september"]
    return F.create_map(*[F.lit(x) for name, i in numbers.items() for x in (name, str(i))])


def leading_parts(value: Column, kind: T.DataType) -> tuple[Column, Column]:
    """Whether a date with the year last can only have the day, or only the month, first;
    null for other values."""
    text = canonical_key(value, kind)
    first = F.regexp_extract(text, YEAR_LAST, 1).try_cast("int")
    second = F.regexp_extract(text, YEAR_LAST, 2).try_cast("int")
    month_leads, month_follows = first.between(1, 12), second.between(1, 12)
    return ~month_leads & month_follows, month_leads & ~month_follows


def date_number(day: Column) -> Column:
    """Date as the integer yyyymmdd."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.day(day)
