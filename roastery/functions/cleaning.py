"""Cleaning rules as ``Column -> Column`` expressions.

Batch and streaming code share these, so both clean alike.  All of them are
built-ins that stay inside code generation, and none of them can fail a job
under ANSI mode: text that does not parse becomes NULL, to be counted and
rejected by the caller.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = "decimal(12,2)"


def normalized(text: Column) -> Column:
    return F.lower(F.trim(text))


def canonicalize(text: Column, aliases: Mapping[str, str], on_unknown: str | None = None) -> Column:
    """Canonical name of a messy spelling; anything unlisted (or NULL) gives ``on_unknown``."""
    spelling_to_name = F.create_map(*[F.lit(v) for pair in aliases.items() for v in pair])
    return F.coalesce(
        F.try_element_at(spelling_to_name, normalized(text)), F.lit(on_unknown).cast("string")
    )


def digits_only(text: Column) -> Column:
    return F.regexp_replace(F.trim(text), "[^0-9]", "")


def price_of(text: Column) -> Column:
    """Unsigned list price: everything but digits and the point is noise, the sign too."""
    return F.regexp_replace(text, "[^0-9.]", "").try_cast("double")


def currency_of(text: Column) -> Column:
    """EUR where the euro sign occurs, else USD (a dollar sign or no sign at all)."""
    return F.when(text.contains("€"), "EUR").otherwise("USD")


def numeric_of(text: Column) -> Column:
    """Signed number inside a money text, NULL where what remains is no number."""
    return F.regexp_replace(text, "[^0-9.-]", "").try_cast("double")


def to_usd(amount: Column, currency: Column, eur_to_usd: float, void_amount: float) -> Column:
    """Dollar value with two places; the void marker counts as zero in any currency."""
    dollars = F.when(currency == "EUR", amount * F.lit(eur_to_usd)).otherwise(amount)
    return F.when(amount == F.lit(void_amount), F.lit(0).cast(MONEY)).otherwise(dollars.try_cast(MONEY))


# Fixed texts of the two usual formats: pattern and ISO order of its groups.
_SLASH_DATES = {
    "M/d/yyyy": (r"^0*([0-9]{1,2})/0*([0-9]{1,2})/([0-9]{4})\z", "$3-$1-$2"),
    "dd/MM/yyyy": (r"^([0-9]{2})/([0-9]{2})/([0-9]{4})\z", "$3-$2-$1"),
}


def parse_date(text: Column, date_format: str) -> Column:
    """Date in a given format, NULL where the text does not fit.

    The usual slash formats are turned into ISO text and cast, which answers a
    misfit with NULL; a date formatter raises and catches an error for each.
    """
    if date_format not in _SLASH_DATES:
        return F.try_to_date(text, date_format)
    pattern, iso = _SLASH_DATES[date_format]
    return F.when(text.rlike(pattern), F.regexp_replace(text, pattern, iso)).try_cast("date")


def parse_ambiguous_date(
    text: Column,
    month_cutoff: int = 2,
    month_first: str = "M/d/yyyy",
    day_first: str = "dd/MM/yyyy",
) -> Column:
    """Month-first reading if it lands in an early month, else the day-first reading."""
    trimmed = F.trim(text)
    us_style = parse_date(trimmed, month_first)
    return F.when(F.month(us_style) <= month_cutoff, us_style).otherwise(parse_date(trimmed, day_first))


def parse_timestamp(text: Column, formats: Iterable[str] = ()) -> Column:
    """ISO-like text first, then each of ``formats`` in turn; NULL if none fits."""
    return F.coalesce(
        F.try_to_timestamp(text), *[F.try_to_timestamp(text, F.lit(f)) for f in formats]
    )


def day_key(day: Column) -> Column:
    """yyyyMMdd as an int, by arithmetic on the date (no text formatting per row)."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def one_of(column: str, keys: Iterable[int]) -> Column:
    """``column IN (...)`` over whole numbers, built as one expression however long the list."""
    listed = ", ".join(str(int(k)) for k in keys)
    return F.expr(f"{column} in ({listed})") if listed else F.lit(False)


def date_of_key(key: Column) -> Column:
    return F.try_to_date(key.cast("string"), "yyyyMMdd")


def weekend_flag(day: Column) -> Column:
    return F.when(F.dayofweek(day).isin(1, 7), 1).otherwise(0)


def ratio(numerator: Column, denominator: Column, digits: int) -> Column:
    """Rounded quotient, NULL unless the denominator is positive."""
    return F.when(denominator > 0, F.round(numerator / denominator, digits))


def money_sum(df: DataFrame, column: str) -> Column:
    """Exact sum of a money column.

    Two-place amounts are added as whole cents in a long, about twice as fast as
    decimals too wide for one; the type is that of the plain sum.
    """
    kind = df.schema[column].dataType
    if not (isinstance(kind, T.DecimalType) and kind.scale == 2 and kind.precision <= 12):
        return F.sum(column)
    cents = F.sum((F.col(column) * 100).cast("bigint"))
    return (cents.cast("decimal(20,0)") / 100).cast(T.DecimalType(kind.precision + 10, 2))


def reaches(value: Column, threshold: float, strict: bool = False) -> Column:
    """1 where ``value`` reaches (or, if strict, exceeds) the threshold, else 0."""
    met = value > threshold if strict else value >= threshold
    return F.when(met, 1).otherwise(0)
