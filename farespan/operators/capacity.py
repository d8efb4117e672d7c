"""Seats, distance, hubs and availability of inventory legs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from farespan.functions import fixed
from farespan.functions.keys import market_pair, route_of_pair, sector
from farespan.functions.timefn import ColumnLike, col, day, day_number
from farespan.operators.passengers import remap_carrier
from farespan.sources.tables import Tables


# ---------------------------------------------------------------- cabins

def cabin_capacity(legs: DataFrame, premium_seats: dict[tuple[int, str], int] = fixed.PREMIUM_SEATS,
                   economy_only: dict[tuple[int, str], int] | None = None) -> DataFrame:
    """One row per leg and cabin.  Unlisted aircraft have no seats in either cabin.

    ``economy_only`` lists aircraft whose premium seats are taken off the economy
    cabin without being offered as premium.
    """
    def seats(table: dict[tuple[int, str], int]) -> Column:
        chain = F.when(F.lit(False), F.lit(0))
        for (kind, suffix), n in table.items():
            chain = chain.when((F.col("EquipmentType") == kind) & (F.col("EquipmentTypeSuffix") == suffix), F.lit(n))
        return chain

    premium = F.coalesce(seats(premium_seats), F.lit(0))
    taken = seats({**premium_seats, **(economy_only or {})})
    economy = F.when(taken.isNotNull(), F.col("Capacity") - taken).otherwise(F.lit(0))
    cabins = F.array(
        F.struct(F.lit("Premium").alias("Cabin"), premium.cast("int").alias("Seats")),
        F.struct(F.lit("Economy").alias("Cabin"), economy.cast("int").alias("Seats")),
    )
    return (
        legs.withColumn("_cabin", F.explode(cabins))
        .withColumn("Cabin", F.col("_cabin.Cabin"))
        .withColumn("Capacity", F.col("_cabin.Seats"))
        .drop("_cabin")
    )


# ---------------------------------------------------------------- hubs

def assign_hub(df: DataFrame, hubs: DataFrame, pair: ColumnLike, base: Column | None = None,
               carrier: str = "CarrierCode", flight: str = "FlightNumber") -> DataFrame:
    """Hub of a flight by carrier, flight and market; else by carrier and market.

    Market groups match in either direction.  Of several hubs the smallest is used.
    ``base`` is the value kept when neither lookup finds one; rows whose base is not
    the default are not looked up loosely.
    """
    base = F.lit("hub") if base is None else base
    keyed = hubs.select(
        F.col("CarrierCode").alias("_hc"), F.col("FlightNumber").alias("_hf"),
        route_of_pair("MarketGroup").alias("_hm"), F.col("Hub"),
    )
    exact = keyed.groupBy("_hc", "_hf", "_hm").agg(F.min("Hub").alias("_exact"))
    loose = keyed.groupBy(F.col("_hc").alias("_lc"), F.col("_hm").alias("_lm")).agg(F.min("Hub").alias("_loose"))
    out = df.withColumn("_market", route_of_pair(pair)).withColumn("_base", base)
    out = out.join(
        exact, (F.col(carrier) == F.col("_hc")) & (F.col(flight) == F.col("_hf")) & (F.col("_market") == F.col("_hm")), "left"
    ).join(loose, (F.col(carrier) == F.col("_lc")) & (F.col("_market") == F.col("_lm")), "left")
    fallback = F.when(F.lower("_base") == "hub", F.coalesce("_loose", "_base")).otherwise(F.col("_base"))
    return out.withColumn("Hub", F.coalesce(F.col("_exact"), fallback)).drop(
        "_hc", "_hf", "_hm", "_exact", "_lc", "_lm", "_loose", "_market", "_base"
    )


def with_market_pair(df: DataFrame, city_pairs: DataFrame, out: str = "ODPair", how: str = "left") -> DataFrame:
    side = city_pairs.select(
        F.col("DepartureStation").alias("_cd"), F.col("ArrivalStation").alias("_ca"), market_pair("CityPairGroup").alias(out)
    )
    return df.join(
        side, (F.col("DepartureStation") == F.col("_cd")) & (F.col("ArrivalStation") == F.col("_ca")), how
    ).drop("_cd", "_ca")


# ---------------------------------------------------------------- distance and ASK

LONG_HAUL = ("D7", "XJ", "XT")


def ask(capacity: DataFrame, city_pairs: DataFrame, distances: DataFrame) -> DataFrame:
    """Seats times distance.

    Long-haul carriers use the city pair, then the reversed pair, then the distance
    table; the others use the distance table alone.
    """
    def table(df: DataFrame, tag: str, swap: bool = False) -> DataFrame:
        dep, arr = ("ArrivalStation", "DepartureStation") if swap else ("DepartureStation", "ArrivalStation")
        return df.select(
            F.col(dep).alias(f"_d{tag}"), F.col(arr).alias(f"_a{tag}"), F.col("ActualDistance").alias(f"_km{tag}")
        ).distinct()

    out = capacity
    for side, tag in ((table(city_pairs, "1"), "1"), (table(city_pairs, "2", swap=True), "2"), (table(distances, "3"), "3")):
        out = out.join(
            side,
            (F.col("DepartureStation") == F.col(f"_d{tag}")) & (F.col("ArrivalStation") == F.col(f"_a{tag}")),
            "left",
        ).drop(f"_d{tag}", f"_a{tag}")
    km = F.when(F.col("CarrierCode").isin(list(LONG_HAUL)), F.coalesce("_km1", "_km2", "_km3")).otherwise(F.col("_km3"))
    return out.withColumn("Ask", F.col("Capacity") * km).drop("_km1", "_km2", "_km3")


def sector_capacity(legs: DataFrame) -> DataFrame:
    """Capacity by carrier, day and sector."""
    return legs.groupBy(
        "CarrierCode", day("DepartureDate").alias("DepartureDate"), sector("DepartureStation", "ArrivalStation").alias("Sector"),
        "DepartureStation", "ArrivalStation",
    ).agg(F.sum("Capacity").alias("Capacity"))


def ask_currency(ask_rows: DataFrame, t: Tables) -> DataFrame:
    """ASK rows once per currency of either end station, equal rows collapsed.

    The either-end lookup is two plain station joins, one per end.
    """
    override = t["station_currency"].select(F.col("Station").alias("StationCode"), "Currency")
    country = t["country"].select("CountryCode", "DefaultCurrencyCode")
    currency = (
        t["station"].select("StationCode", "CountryCode")
        .join(override, "StationCode", "left")
        .join(country, "CountryCode", "left")
        .select(F.col("StationCode").alias("_station"), F.coalesce("Currency", "DefaultCurrencyCode").alias("AskCurrency"))
    )
    ends = F.explode(F.array("DepartureStation", "ArrivalStation"))
    return (
        ask_rows.withColumn("_end", ends)
        .join(currency, F.col("_end") == F.col("_station"))
        .select("CarrierCode", "DepartureDate", "Sector", "AskCurrency", "Capacity", "Ask")
        .distinct()
    )


def forward_ask(daily: DataFrame, keys: Sequence[str], days: int = 181) -> DataFrame:
    """ASK of each day and the following ones, per key.

    Rows with a missing key are pooled in one row without keys or date.
    """
    daily = daily.groupBy(*keys, "DepartureDate").agg(F.sum("Ask").alias("Ask"))
    whole = F.round(F.col("Ask").cast("decimal(38,4)")).cast("decimal(28,0)")
    known = F.col("DepartureDate").isNotNull()
    for k in keys:
        known = known & F.col(k).isNotNull()
    frame = W.partitionBy(*keys).orderBy(day_number("DepartureDate")).rangeBetween(0, days - 1)
    rolled = daily.where(known).select(*keys, F.col("DepartureDate").alias("Date"), F.sum(whole).over(frame).alias("Ask"))
    pooled = daily.where(~known).agg(F.sum(whole).alias("Ask"), F.count("*").alias("_n")).where(F.col("_n") > 0)
    nothing = [F.lit(None).cast(daily.schema[k].dataType).alias(k) for k in keys]
    return rolled.unionByName(pooled.select(*nothing, F.lit(None).cast("date").alias("Date"), "Ask"))


# ---------------------------------------------------------------- first-row attribution

def first_row(df: DataFrame, partition: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Numbers rows inside a flight; the order columns break ties."""
    frame = W.partitionBy(*partition).orderBy(*[F.col(o).asc_nulls_first() for o in order])
    return df.withColumn("RowNo", F.row_number().over(frame))


# ---------------------------------------------------------------- airport fees

def with_airport_fee(df: DataFrame, fees: DataFrame, on: Column, route: str = "Route") -> DataFrame:
    """Fee per seat of the carrier and sector valid on a day."""
    valid = fees.where(on.between(day("VersionStartDate"), day("VersionEndDate"))).select(
        F.col("CarrierCode").alias("_fc"), F.col("Sector").alias("_fs"), F.col("FeeMYR")
    )
    return df.join(valid, (F.col("CarrierCode") == F.col("_fc")) & (F.col(route) == F.col("_fs")), "left").drop("_fc", "_fs")


# ---------------------------------------------------------------- availability

def class_availability(legs: DataFrame, classes: DataFrame) -> DataFrame:
    """Authorised seats less those sold in the nest, never below zero, per class.

    Both totals are window sums over the leg, so classes are shuffled once.
    """
    rows = legs.join(classes, "InventoryLegID")
    nest = W.partitionBy("InventoryLegID", "ClassNest")
    leg = W.partitionBy("InventoryLegID")
    return (
        rows.withColumn("SeatSold", F.sum("ClassSold").over(leg))
        .withColumn("NestSold", F.sum("ClassSold").over(nest))
        .withColumn(
            "ClassAvail",
            F.when(F.col("ClassAU") > F.col("NestSold"), F.col("ClassAU") - F.col("NestSold")).otherwise(F.lit(0)),
        )
    )


GRID_MOST = 500  # booking classes; the grid has two columns for each


def grid_classes(class_table: DataFrame) -> list[str]:
    """Booking classes to pivot on: single letters and the listed two-letter ones, in their order.

    The list makes columns, so it is read to the driver before the pivot is planned. A table with
    more than GRID_MOST of them is no class table and is refused.
    """
    extra = [c for c in fixed.GRID_CLASSES if len(c) > 1]
    code = F.rtrim("ClassOfServiceCode")
    wanted = class_table.select(code.alias("c")).where((F.length("c") == 1) | F.col("c").isin(extra)).distinct()
    found = sorted(r.c for r in wanted.limit(GRID_MOST + 1).collect())
    if len(found) > GRID_MOST:
        raise ValueError(f"over {GRID_MOST} booking classes")
    return found


def availability_grid(t: Tables, departs_from: Column, captured: Column, classes: Sequence[str] | None = fixed.GRID_CLASSES) -> DataFrame:
    """One row per leg: authorised (``X-AU``) and available (``X``) seats per class.

    Without ``classes`` the columns follow the class table.
    """
    classes = grid_classes(t["class_of_service"]) if classes is None else classes
    legs = t["inventory_leg"].where((F.col("Status") != 2) & (F.col("DepartureDate") >= departs_from))
    legs = remap_carrier(legs, t["carrier_mapping"])
    pairs = t["city_pair"].select("DepartureStation", "ArrivalStation", "CityPairGroup")
    legs = legs.join(pairs, ["DepartureStation", "ArrivalStation"]).select(
        "InventoryLegID", "InventoryLegKey", "CityPairGroup", day("DepartureDate").alias("DepartureDate"), "CarrierCode",
        "FlightNumber", "DepartureStation", "ArrivalStation", "OpSuffix", "Lid", "AdjustedCapacity", "Capacity",
    )
    sold = t["inventory_leg_class"].select("InventoryLegID", "ClassNest", "ClassOfService", "ClassAU", "ClassSold").distinct()
    rows = class_availability(legs, sold)
    head = [c for c in legs.columns] + ["SeatSold"]
    pivoted = rows.groupBy(*head).pivot("ClassOfService", list(classes)).agg(
        F.sum("ClassAvail").alias("AV"), F.sum("ClassAU").alias("AU"), F.max("ClassSold").alias("SOLD")
    )
    out = [captured.alias("CaptureDate"), *[F.col(c) for c in head]]
    out += [F.col(f"`{c}_AU`").alias(f"{c}-AU") for c in classes]
    for c in classes:
        value = F.col(f"`{c}_AV`")
        if c in fixed.GRID_FROM_OWN_SALES:
            own = F.col(f"`{c}_AU`") - F.col(f"`{c}_SOLD`")
            value = F.when(F.col(f"`{c}_AU`").isNotNull(), own).otherwise(value)
        if c == "DI":
            value = F.when(value < 0, F.lit(0)).otherwise(value)
        out.append(value.alias(c))
    return pivoted.select(*out)


def with_city_pair_distance(df: DataFrame, city_pairs: DataFrame, route: str) -> DataFrame:
    """Distance and market pair of a sector."""
    side = city_pairs.select(
        sector("DepartureStation", "ArrivalStation").alias("_r"), F.col("ActualDistance").alias("Distance"),
        market_pair("CityPairGroup").alias("MarketGroup"),
    )
    return df.join(side, F.col(route) == F.col("_r"), "left").drop("_r")


def actual_distance(df: DataFrame, distances: DataFrame, city_pairs: DataFrame) -> DataFrame:
    """Distance and unit from the distance table, else the city pair."""
    def table(source: DataFrame, tag: str) -> DataFrame:
        return source.select(
            F.col("DepartureStation").alias("DepartureStation"), F.col("ArrivalStation").alias("ArrivalStation"),
            F.col("ActualDistance").alias(f"_km{tag}"), F.col("ActualDistanceUnit").alias(f"_u{tag}"),
        )

    keys = ["DepartureStation", "ArrivalStation"]
    return (
        df.join(table(distances, "1"), keys, "left").join(table(city_pairs, "2"), keys, "left")
        .withColumn("ActualDistance", F.coalesce("_km1", "_km2"))
        .withColumn("ActualDistanceUnit", F.coalesce("_u1", "_u2"))
        .drop("_km1", "_km2", "_u1", "_u2")
    )
