"""Carrier, route and country keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from farespan.functions import fixed
from farespan.functions.timefn import ColumnLike, col


def recode(c: ColumnLike, mapping: dict[str, str], default: Column | None = None) -> Column:
    """Map literal values; anything unmapped keeps ``default`` (its own value if none)."""
    column = col(c)
    by_value: dict[str, list[str]] = {}
    for key, value in mapping.items():
        by_value.setdefault(value, []).append(key)
    chain = None
    for value, keys in by_value.items():
        test = column.isin(keys)
        chain = F.when(test, F.lit(value)) if chain is None else chain.when(test, F.lit(value))
    return chain.otherwise(column if default is None else default)


def home_currency(carrier: ColumnLike) -> Column:
    return recode(carrier, fixed.HOME_CURRENCY, F.lit("MYR"))


def home_currency_strict(carrier: ColumnLike) -> Column:
    """As :func:`home_currency`, with JW, and NULL for an unknown carrier."""
    return recode(carrier, fixed.HOME_CURRENCY_STRICT, F.lit(None).cast("string"))


def pair_key(a: ColumnLike, b: ColumnLike, sep: str = "") -> Column:
    """Undirected pair, smaller code (byte order) first; NULL if either is NULL."""
    x, y = col(a), col(b)
    mid = F.lit(sep)
    return F.when(x <= y, F.concat(x, mid, y)).otherwise(F.concat(y, mid, x))


def route_key(dep: ColumnLike, arr: ColumnLike) -> Column:
    return pair_key(dep, arr)


def route_of_pair(pair: ColumnLike) -> Column:
    """Undirected key of a six-letter market group or route."""
    c = col(pair)
    return pair_key(F.left(c, F.lit(3)), F.right(c, F.lit(3)))


def market_pair(group: ColumnLike) -> Column:
    """``AAA-BBB`` city-pair group as ``AAABBB``."""
    c = col(group)
    return F.concat(F.substring(c, 1, 3), F.substring(c, 5, 3))


def sector(dep: ColumnLike, arr: ColumnLike) -> Column:
    return F.concat(col(dep), col(arr))


def alias_route(route: ColumnLike) -> Column:
    return recode(route, fixed.ROUTE_ALIASES)


def alias_station(station: ColumnLike) -> Column:
    return recode(station, {"MES": "KNO"})


def is_special_flight(carrier: ColumnLike, flight: ColumnLike, of: str, numbers: tuple[str, ...]) -> Column:
    """Carrier ``of`` flying one of ``numbers``."""
    return (col(carrier) == of) & col(flight).isin(list(numbers))


def any_of(tests: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, tests)
