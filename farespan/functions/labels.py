"""Labels derived from one row: channel, cabin, product, flags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from farespan.functions import fixed
from farespan.functions.timefn import ColumnLike, col


def dom_int(flag: ColumnLike, international: str = "INT", domestic: str = "DOM") -> Column:
    """1 is international; everything else, NULL included, is domestic."""
    return F.when(col(flag) == 1, international).otherwise(domestic)


def cabin(fare_class: ColumnLike, premium: tuple[str, ...]) -> Column:
    return F.when(col(fare_class).isin(list(premium)), "Premium").otherwise("Economy")


def premium_flex(product: ColumnLike, fare_class: ColumnLike) -> Column:
    return (
        F.when(col(product) == "HF", "ONLINE_PF")
        .when((col(product) == "FS") & ~col(fare_class).isin("B", "H"), "CORP_PF")
        .otherwise("NON_PF")
    )


def hi_flyer(fare_class: ColumnLike) -> Column:
    return F.when(col(fare_class).isin(list(fixed.HI_FLYER)), "Hi-Flyer")


def payment_group(code: ColumnLike) -> Column:
    chain = None
    for label, codes in fixed.PAYMENT_GROUPS.items():
        test = col(code).isin(list(codes))
        chain = F.when(test, label) if chain is None else chain.when(test, label)
    return chain.otherwise("Others")


def has_letter(c: ColumnLike) -> Column:
    return col(c).rlike("[A-Za-z]")


def channel_label(report_channel: ColumnLike, organisation: ColumnLike,
                  location: ColumnLike | None = None, unknown: str | None = None) -> Column:
    """Corporate split by letters in the organisation code, call centre by location.

    ``location=None`` leaves the call centre unsplit.  ``unknown`` is the label of
    an agent without a known channel; without it that stays NULL.
    """
    channel, org = col(report_channel), col(organisation)
    corporate = channel == "Corporate"
    chain = (
        F.when(corporate & has_letter(org), "Corporate - Direct")
        .when(corporate & ~has_letter(org), "Corporate - TMC")
        .when(corporate & org.isNull(), channel)
    )
    if location is not None:
        for name, places in fixed.CALL_CENTRES.items():
            chain = chain.when(
                (channel == "Call Centre") & col(location).isin(list(places)), f"Call Centre - {name}"
            )
    return chain.otherwise(channel if unknown is None else F.coalesce(channel, F.lit(unknown)))


def clean_nationality(name: ColumnLike) -> Column:
    c = col(name)
    return (
        F.when(c.isNull() | (F.trim(c) == ""), "Unknown")
        .when(c == "United States of America", "United States")
        .otherwise(c)
    )


def passport_country(passport: ColumnLike, nationality: ColumnLike) -> Column:
    return F.when(col(passport).isNull() | (col(passport) == "OT"), col(nationality)).otherwise(col(passport))


def gender(code: ColumnLike) -> Column:
    return F.when(col(code) == 1, "Male").otherwise("Female")
