from roastery.functions.cleaning import (
    canonicalize,
    currency_of,
    date_of_key,
    day_key,
    digits_only,
    money_sum,
    normalized,
    numeric_of,
    one_of,
    parse_ambiguous_date,
    parse_date,
    parse_timestamp,
    price_of,
    ratio,
    reaches,
    to_usd,
    weekend_flag,
)

__all__ = [
    "canonicalize",
    "currency_of",
    "date_of_key",
    "day_key",
    "digits_only",
    "money_sum",
    "normalized",
    "numeric_of",
    "one_of",
    "parse_ambiguous_date",
    "parse_date",
    "parse_timestamp",
    "price_of",
    "ratio",
    "reaches",
    "to_usd",
    "weekend_flag",
]
