"""Purchase-lead, age and transit bands."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from farespan.functions.timefn import ColumnLike, col, days_between, int_div


def _label(low: Column, high: Column) -> Column:
    return F.concat_ws("-", low.cast("string"), high.cast("string"))


def _tens(n: Column) -> Column:
    """Ten-day band of a positive count: 1..10 -> ``0-10``, 11..20 -> ``11-20``."""
    top = F.ceil(n / 10).cast("int") * 10
    return F.when(n <= 10, F.lit("0-10")).otherwise(_label(top - 9, top))


def lead_list(n: ColumnLike) -> Column:
    c = col(n)
    return F.when(c.between(0, 1000), _tens(c)).otherwise("Unknown")


def lead_to400(n: ColumnLike) -> Column:
    c = col(n)
    return F.when(c.between(0, 400), _tens(c)).otherwise(">400")


def lead_arith(n: ColumnLike) -> Column:
    """No upper end; negative leads get the labels truncating division gives them."""
    c = col(n)
    base = int_div(c, 10) * 10
    return (
        F.when(c.between(0, 10), F.lit("0-10"))
        .when(c % 10 == 0, _label(base - 9, base))
        .otherwise(_label(base + 1, base + 10))
    )


def lead_coarse(n: ColumnLike) -> Column:
    c = col(n)
    return (
        F.when(c <= 0, "0")
        .when(c == 1, "1")
        .when(c <= 7, ">1-7")
        .when(c <= 30, ">7-30")
        .when(c <= 90, ">30-90")
        .when(c >= 91, ">90")
    )


LEAD_BANDS = {"list": lead_list, "arith": lead_arith, "to400": lead_to400, "coarse": lead_coarse}


def lead_bucket(booked: ColumnLike, departs: ColumnLike, kind: str) -> Column:
    return LEAD_BANDS[kind](days_between(booked, departs))


# Fixed values: (lowest age, highest age, label), first match wins; None is no end.
AGE_BANDS = {
    "journey": (
        (
            (0, 11, "<12"), (12, 17, "12-17"), (18, 24, "18-24"), (25, 30, "25-30"),
            (31, 35, "31-35"), (36, 44, "36-44"), (45, 54, "45-54"), (55, 64, "55-64"),
            (65, 75, "65-75"), (76, None, ">75"),
        ),
        None,
    ),
    "analysis": (
        (
            (0, 2, "0-2"), (3, 5, "3-5"), (6, 12, "6-12"), (13, 18, "13-18"), (18, 24, "18-24"),
            (25, 29, "25-29"), (30, 34, "30-34"), (35, 39, "35-39"), (40, 44, "40-44"),
            (45, 49, "45-49"), (50, 54, "50-54"), (55, 59, "55-59"), (60, 64, "60-64"),
            (65, 69, "65-69"), (70, None, ">70"),
        ),
        None,
    ),
    "decades": (
        ((0, 19, "0-19"), (20, 29, "20-29"), (30, 39, "30-39"), (40, 49, "40-49"), (50, None, ">49")),
        "Unknown",
    ),
    "china": (
        (
            (0, 12, "Under 12 years old"), (13, 19, "Teens"), (20, 24, "Youth"), (25, 29, "Young Adult"),
            (30, 39, "Mid Level Execs"), (40, 49, "Mature Affluent"), (50, None, "Senior Citizens"),
        ),
        "Unknown",
    ),
    "fly_thru": (
        (
            (0, 12, "Under12"), (13, 19, "Teens"), (20, 24, "Youth"), (25, 29, "YoungAdult"),
            (30, 39, "MidLevelExecs"), (40, 60, "MatureAffluent"), (60, 100, ">60"),
        ),
        "Unknown",
    ),
}


def age_band(age: ColumnLike, bands: str) -> Column:
    c = col(age)
    rows, default = AGE_BANDS[bands]
    chain = None
    for low, high, label in rows:
        test = (c >= low) if high is None else c.between(low, high)
        chain = F.when(test, label) if chain is None else chain.when(test, label)
    return chain.otherwise(F.lit(default)) if default is not None else chain


# Transit bands in hours, (above, up to).
TRANSIT_BANDS = ((0, 2), (2, 4), (4, 8), (8, 12), (12, 18), (18, 24), (24, 36), (36, 48))


def transit_band(hours: ColumnLike) -> Column:
    """NULL, zero and negative transit all read ``0``."""
    c = col(hours)
    chain = F.when(c > 48, ">48")
    for low, high in TRANSIT_BANDS:
        chain = chain.when((c > low) & (c <= high), f"{low}-{high}")
    return chain.otherwise("0")
