"""Signed amounts, charge buckets and currency conversion."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farespan.functions import fixed
from farespan.functions.keys import any_of
from farespan.functions.timefn import ColumnLike, col, day

MONEY = "decimal(28,4)"


def money(c: ColumnLike) -> Column:
    return col(c).cast(MONEY)


def zero_filled(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(0).cast(df.schema[c].dataType)) for c in columns})


# ---------------------------------------------------------------- sign

def signed_by_list(types: Sequence[int] = fixed.MINUS_TYPES, charge_type: str = "ChargeType",
                   amount: str = "ChargeAmount") -> Column:
    """Amount, subtracted for the listed charge types; a missing amount is zero."""
    value = F.coalesce(col(amount), F.lit(0).cast("decimal(18,4)"))
    return F.when(col(charge_type).isin(list(types)), -value).otherwise(value)


def signed_by_matrix(charges: DataFrame, matrix: DataFrame, how: str = "inner") -> DataFrame:
    """Adds ``Amount`` = charge amount times the flag of its type."""
    flags = matrix.select(F.col("ChargeTypeID").alias("ChargeType"), "PositiveNegativeFlag")
    return charges.join(flags, "ChargeType", how).withColumn(
        "Amount", F.col("ChargeAmount") * F.col("PositiveNegativeFlag")
    )


def plus_minus(plus: Sequence[int] = (0, 8), minus: Sequence[int] = (1, 7)) -> Column:
    """Types added and subtracted; any other type contributes nothing."""
    value = F.coalesce(F.col("ChargeAmount"), F.lit(0).cast("decimal(18,4)"))
    return F.when(F.col("ChargeType").isin(list(plus)), value).when(F.col("ChargeType").isin(list(minus)), -value)


# ---------------------------------------------------------------- buckets

def of_type(*types: int) -> Column:
    return F.col("ChargeType").isin(list(types))


def of_code(*codes: str) -> Column:
    return F.col("ChargeCode").isin(list(codes))


def with_ancillary(charges: DataFrame, codes: DataFrame, code: str = "ChargeCode") -> DataFrame:
    """Adds ``IsAncillary`` from the ancillary code list."""
    known = codes.select(F.col("Code").alias("_code")).distinct().withColumn("_anc", F.lit(True))
    return (
        charges.join(known, charges[code] == known["_code"], "left")
        .withColumn("IsAncillary", F.coalesce("_anc", F.lit(False)))
        .drop("_code", "_anc")
    )


def bucket(*conditions: Column, amount: str = "Amount") -> Column:
    """Sum of the rows meeting each condition; a row meeting two counts twice."""
    parts = [F.sum(F.when(c, F.col(amount)).otherwise(F.lit(0))) for c in conditions]
    total = parts[0]
    for p in parts[1:]:
        total = total + p
    return total


def bucket_or_null(condition: Column, amount: str = "Amount") -> Column:
    """As :func:`bucket`, but NULL where no row meets the condition."""
    return F.sum(F.when(condition, F.col(amount)))


def fare_types() -> Column:
    return of_type(*fixed.FARE_TYPES)


def fuel() -> Column:
    return of_code(*fixed.FUEL_CODES)


def ancillary() -> Column:
    return F.col("IsAncillary") | of_type(8)


def other() -> Column:
    return ~of_code(*fixed.NOT_OTHER_CODES) & ~F.col("IsAncillary") & ~fare_types()


def segment_charges(
    charges: DataFrame,
    single: dict[str, list[Column]],
    summed: dict[str, Column] | None = None,
    amount: Column | None = None,
    fanout: str = "safe",
) -> DataFrame:
    """One row per (PassengerID, SegmentID) with all charge buckets, in one scan.

    ``single`` maps a bucket to the sub-buckets that the side-by-side form reads as
    unaggregated rows; ``summed`` maps a bucket to one condition aggregated first.
    With ``fanout='reference'`` the totals come out as if the unaggregated rows of
    all sub-buckets had been joined to one another: each sub-total is multiplied by
    the row counts of the others.  The product is computed from counts, so no
    joined pairs are ever produced.
    """
    summed = summed or {}
    amount = signed_by_list() if amount is None else amount
    parts = {f"_{name}_{i}": c for name, cs in single.items() for i, c in enumerate(cs)}
    wanted = any_of(list(parts.values()) + list(summed.values()))
    rows = charges.where(wanted).withColumn("_amt", amount)
    aggregates = [F.sum(F.when(c, F.col("_amt"))).alias(n) for n, c in {**parts, **summed}.items()]
    if fanout == "reference":
        aggregates += [F.greatest(F.count(F.when(c, 1)), F.lit(1)).alias(f"_n{n}") for n, c in parts.items()]
    per = rows.groupBy("PassengerID", "SegmentID").agg(*aggregates)

    def weight(skip: str | None) -> Column:
        out = F.lit(1)
        for n in parts:
            if n != skip:
                out = out * F.col(f"_n{n}")
        return out

    columns = []
    for name, cs in single.items():
        total = F.lit(0)
        for i in range(len(cs)):
            part = f"_{name}_{i}"
            term = F.coalesce(F.col(part), F.lit(0))
            total = total + (term * weight(part) if fanout == "reference" else term)
        columns.append(money(total).alias(name))
    for name in summed:
        term = F.coalesce(F.col(name), F.lit(0))
        columns.append(money(term * weight(None) if fanout == "reference" else term).alias(name))
    return per.select("PassengerID", "SegmentID", *columns)


# ---------------------------------------------------------------- currency

def rates(fx: DataFrame, frm: Sequence[str] | None = None, to: Sequence[str] | None = None) -> DataFrame:
    """The rate history narrowed to the pairs a report can use."""
    if frm is not None:
        fx = fx.where(F.col("FromCurrencyCode").isin(list(frm)))
    if to is not None:
        fx = fx.where(F.col("ToCurrencyCode").isin(list(to)))
    return fx.select(
        F.col("FromCurrencyCode").alias("_from"),
        F.col("ToCurrencyCode").alias("_to"),
        day("ConversionDate").alias("_day"),
        F.col("ConversionRate").alias("_rate"),
    )


RATE_ROWS = 1 << 20  # rates sent to every task at most; of more, rows meet them by key


def everywhere(table: DataFrame) -> DataFrame:
    """A rate table sent to every task where its counted rows allow it.

    A rate key (two currencies and a day) may have a third of all amounts, so amounts had better stay
    where they are. The count reads the narrowed history only, once per narrowing.
    """
    key = table.semanticHash()
    if key not in _rate_rows:
        _rate_rows[key] = table.count()
    return F.broadcast(table) if _rate_rows[key] <= RATE_ROWS else table


_rate_rows: dict[int, int] = {}

#: Home currencies that a report converts into; rates from or to any other can't be asked for.
HOMES = tuple(sorted({*fixed.HOME_CURRENCY_STRICT.values(), "MYR"}))


def with_rate(df: DataFrame, fx: DataFrame, frm: ColumnLike, to: ColumnLike, on: ColumnLike, name: str = "Rate",
              once: bool = False) -> DataFrame:
    """Left join of the rate of (frm, to) on a day; ``frm``/``to`` may be literals.

    With ``once`` equal rate rows of a day count as one.
    """
    table, test = rates(fx), []
    for side, key in ((frm, "_from"), (to, "_to")):
        if isinstance(side, str) and side not in df.columns:
            table = table.where(F.col(key) == side)
        else:
            if isinstance(side, str) and side == "Home":
                table = table.where(F.col(key).isin(*HOMES))
            test.append(col(side) == F.col(key))
    test.append(col(on) == F.col("_day"))
    if once:
        table = table.distinct()
    joined = df.join(everywhere(table), test, "left")
    return joined.withColumn(name, F.col("_rate")).drop("_from", "_to", "_day", "_rate")


def with_rates(df: DataFrame, fx: DataFrame, targets: Sequence[str], to: ColumnLike, on: ColumnLike,
               prefix: str = "Rate_") -> DataFrame:
    """Rates from several currencies at once: the history turned wide, one join."""
    table = rates(fx, frm=targets)
    wide = table.groupBy("_to", "_day").agg(
        *[F.max(F.when(F.col("_from") == c, F.col("_rate"))).alias(f"{prefix}{c}") for c in targets]
    )
    return df.join(everywhere(wide), (col(to) == F.col("_to")) & (col(on) == F.col("_day")), "left").drop("_to", "_day")


def inverse(rate: ColumnLike) -> Column:
    return F.lit(1) / col(rate)


def or_one(df: DataFrame, rate: str) -> Column:
    """The rate, 1 where there is none, in the rate's own type."""
    return F.coalesce(F.col(rate), F.lit(1).cast(df.schema[rate].dataType))


def to_home(amount: ColumnLike, same: Column, rate: ColumnLike) -> Column:
    """Unchanged in the same currency, else times 1/rate; NULL without a rate."""
    return F.when(same, money(amount)).otherwise(money(amount) * inverse(rate))


# (direction of the rate, arithmetic, value without a rate) of each report family.
FX_MODES = {
    "local": ("from_home", "inverse", None),
    "myr": ("from_home", "inverse", None),
    "booking_date": ("from_home", "inverse", None),
    "div_one": ("from_home", "divide", 1),
    "div_null": ("from_home", "divide", None),
    "mul_one": ("to_home", "multiply", 1),
}


def convert(df: DataFrame, fx: DataFrame, amounts: Sequence[str], *, home: ColumnLike, charged: ColumnLike,
            on: ColumnLike, mode: str, suffix: str, on_missing: int | None | str = "mode", once: bool = False) -> DataFrame:
    """Convert amount columns into ``home`` with one rate join.

    ``mode`` is one of :data:`FX_MODES`.  The first three leave amounts already in
    the home currency untouched.  ``once`` is as in :func:`with_rate`.
    """
    direction, arithmetic, missing = FX_MODES[mode]
    missing = missing if on_missing == "mode" else on_missing
    frm, to = (home, charged) if direction == "from_home" else (charged, home)
    out = with_rate(df, fx, frm, to, on, "_fx", once)
    rate = F.col("_fx") if missing is None else or_one(out, "_fx")
    home_col = F.lit(home) if isinstance(home, str) and home not in df.columns else col(home)
    for a in amounts:
        value = money(a)
        if arithmetic == "inverse":
            converted = F.when(col(charged) == home_col, value).otherwise(value * inverse(rate))
        elif arithmetic == "divide":
            converted = value / rate
        else:
            converted = value * rate
        out = out.withColumn(f"{a}{suffix}", converted)
    return out.drop("_fx")
