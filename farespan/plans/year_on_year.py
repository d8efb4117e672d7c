"""Route performance this year, last year at the same date, and last year in full."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farespan.functions import fixed, labels, windows
from farespan.functions import timefn as tf
from farespan.functions.keys import alias_route, sector
from farespan.functions.windows import Window
from farespan.operators import capacity as cap
from farespan.operators import money as m
from farespan.operators import passengers as px
from farespan.plans.routes import ancillary_by_flight, extra_parts, fee_amounts
from farespan.sources.sinks import scoped, stage
from farespan.sources.tables import Tables
from farespan.sources.views import segment_view

BUCKETS = ("BaseFare", "FuelSurcharge", "ThruFare", "XHISEA", "ADM")
FLIGHT = ("CarrierCode", "FlightNumber", "Route", "DepartureDate", "Cabin")
PERIOD = ("Year", "Month", "WeekNumber")


@dataclass(frozen=True)
class CompareSpec:
    """Carrier rule and currency of one comparison report."""

    name: str
    own: tuple[str, ...] | None
    mapped: tuple[str, ...] | None
    unit: str
    currency: str
    mode: str


COMPARE_D7 = CompareSpec("d7", ("D7",), None, "RM", "MYR", "mul_one")
COMPARE_XJ = CompareSpec("xj", None, ("XJ",), "THB", "THB", "div_one")


@dataclass(frozen=True)
class Snapshot:
    """Booking cut-off and rules of one compared state; last year differs on purpose."""

    booked: Window
    departs: Window
    confirmed_only: bool
    by_charge_number: bool
    premium: tuple[str, ...]


def snapshots(spans: windows.YearOnYear) -> dict[str, Snapshot]:
    return {
        "": Snapshot(spans.booked_now, spans.departs, True, False, fixed.PREMIUM_G1),
        "Y1": Snapshot(spans.booked_last_year, spans.departs_last_year, False, True, fixed.PREMIUM_G1),
        "Y1M": Snapshot(spans.booked_year_end, spans.departs_last_year, False, True, fixed.PREMIUM),
    }


def priced_segments(t: Tables, spec: CompareSpec, departs: Window) -> DataFrame:
    """Segments of every snapshot with revenue under both fare rules, in one pass.

    Charges, bookings and rates are read once; a snapshot is then a filter.
    """
    seg = segment_view(t).where(departs.covers("DepartureDate") & ~F.col("FlightNumber").isin(list(fixed.D7_SPECIAL)))
    if spec.own:
        seg = seg.where(F.col("CarrierCode").isin(list(spec.own)))
    seg = px.remap_carrier(seg, t["carrier_mapping"])
    if spec.mapped:
        seg = seg.where(F.col("CarrierCode").isin(list(spec.mapped)))
    seg = seg.select(
        "PassengerID", "SegmentID", "DepartureDate", "CarrierCode", "FlightNumber", "FareClassOfService", "BookingStatus", "CreatedDate",
        tf.day("CreatedDate").alias("CreatedDay"), sector("DepartureStation", "ArrivalStation").alias("Route"),
    )
    seg = stage(seg, f"compare-{spec.name}-flown")
    charges = t["passenger_journey_charge"].select("PassengerID", "SegmentID", "ChargeNumber", "ChargeType", "ChargeCode", "ChargeAmount")
    charges = px.around(charges, seg, "PassengerID", "SegmentID")
    # A row that is both the first charge and a discount counts in both, so parts stay apart.
    less = [m.of_type(1), m.of_type(7)]
    totals = m.segment_charges(
        charges, {"BaseFare": [m.of_type(0, 8), *less], "FirstFare": [F.col("ChargeNumber") == 0, *less]},
        {"FuelSurcharge": m.fuel(), **extra_parts()},
    )
    people = t["booking_passenger"].select("PassengerID", "BookingID")
    booking = t["booking"].select("BookingID", "RecordLocator", "CurrencyCode")
    rows = seg.join(totals, ["PassengerID", "SegmentID"], "left").join(people, "PassengerID", "left").join(booking, "BookingID", "left")
    amounts = [*BUCKETS, "FirstFare"]
    rows = m.convert(m.zero_filled(rows, amounts), t["fx_history"], amounts, home=spec.currency, charged="CurrencyCode",
                     on="CreatedDay", mode=spec.mode, suffix="_c", once=True)
    return rows.select(
        "PassengerID", "RecordLocator", "DepartureDate", "CarrierCode", "FlightNumber", "Route", "FareClassOfService",
        "BookingStatus", "CreatedDate", *[f"{a}_c" for a in amounts],
    )


def snapshot_passengers(priced: DataFrame, snap: Snapshot) -> DataFrame:
    """Passenger revenue of one snapshot, per flight and cabin."""
    rows = priced.where(snap.booked.shift(-8).covers("CreatedDate") & snap.departs.covers("DepartureDate"))
    if snap.confirmed_only:
        rows = rows.where(F.col("BookingStatus") == "HK")
    rows = rows.withColumn("Cabin", labels.cabin("FareClassOfService", snap.premium))
    source = {b: b for b in BUCKETS} | ({"BaseFare": "FirstFare"} if snap.by_charge_number else {})
    return rows.groupBy("PassengerID", "RecordLocator", *FLIGHT).agg(
        *[m.money(F.sum(f"{source[b]}_c")).alias(b) for b in BUCKETS]
    )


def flights_sold(passengers: DataFrame, ancillary: DataFrame) -> DataFrame:
    """Seats and revenue per flight and cabin, with the passengers' extras."""
    rows = passengers.join(ancillary, ["PassengerID", "CarrierCode", "FlightNumber", "DepartureDate", "Route"], "left")
    return rows.groupBy(*FLIGHT).agg(
        F.count("PassengerID").alias("SeatsSold"), *[F.sum(b).alias(b) for b in BUCKETS],
        F.coalesce(F.sum("Ancillary"), F.lit(0)).alias("AncillaryAmount"),
    )


def cabin_inventory(t: Tables, departs: Window) -> DataFrame:
    """Seats per flight, day and cabin of every carrier's open legs."""
    legs = departs.of(t["inventory_leg"], "DepartureDate").where(
        (F.col("Status") != 2) & (F.col("Lid") > 0)
        & ~F.col("FlightNumber").isin(list(fixed.D7_SPECIAL))
    )
    legs = px.remap_carrier(legs, t["carrier_mapping"]).select(
        "DepartureDate", "CarrierCode", "FlightNumber", "DepartureStation", "ArrivalStation", "EquipmentType",
        "EquipmentTypeSuffix", "Capacity",
    ).distinct()
    seats = cap.cabin_capacity(legs).distinct()
    return seats.groupBy(
        "CarrierCode", "FlightNumber", sector("DepartureStation", "ArrivalStation").alias("Route"), "DepartureDate", "Cabin"
    ).agg(F.sum("Capacity").alias("Capacity"))


def weekly(inventory: DataFrame, sold: DataFrame) -> DataFrame:
    """Capacity and sales per week, month, carrier, route and cabin."""
    joined = inventory.join(sold, list(FLIGHT), "left")
    measures = ["SeatsSold", *BUCKETS, "AncillaryAmount"]
    out = joined.groupBy(
        F.year("DepartureDate").alias("Year"), tf.month_name("DepartureDate").alias("Month"),
        tf.us_week("DepartureDate").cast("string").alias("WeekNumber"), "CarrierCode", "Route", "Cabin",
    ).agg(F.sum("Capacity").alias("Capacity"), *[F.coalesce(F.sum(x), F.lit(0)).alias(x) for x in measures])
    return out.where(F.col("Capacity").isNotNull()).withColumn("Route", alias_route("Route"))


def same_period_join(current: DataFrame, previous: dict[str, DataFrame], year: int, measures: Callable[[str], dict[str, str]]) -> DataFrame:
    """Rows of one year with the year before under suffixed names."""
    keys = ["Year", "Month", "WeekNumber", "CarrierCode", "Route", "Cabin"]
    out = current.where(F.col("Year") == year)
    for tag, df in previous.items():
        renamed = measures(tag)
        shifted = df.where(F.col("Year") == year - 1).select(
            (F.col("Year") + 1).alias("Year"), *keys[1:], *[F.col(a).alias(b) for a, b in renamed.items()]
        )
        out = out.join(shifted, keys, "left")
    return out


@scoped
def route_performance(t: Tables, now: datetime, spec: CompareSpec) -> DataFrame:
    """Three snapshots side by side for this year, and next year against this one."""
    spans = windows.year_on_year(windows.to_local(now, windows.MALAYSIA))
    snaps = snapshots(spans)
    priced = stage(priced_segments(t, spec, spans.departs_all), f"compare-{spec.name}-segments")
    current = stage(snapshot_passengers(priced, snaps[""]), f"compare-{spec.name}-passengers")
    # All snapshots meet the extras of the current passengers.
    ancillary = ancillary_by_flight(
        fee_amounts(current, t, None, True), t, (("", spec.currency, spec.mode),), once=True
    )
    ancillary = stage(ancillary, f"compare-{spec.name}-extras")
    inventory = stage(cabin_inventory(t, spans.departs_all), f"compare-{spec.name}-inventory")

    weeks = {}
    for tag, snap in snaps.items():
        passengers = current if tag == "" else snapshot_passengers(priced, snap)
        weeks[tag] = stage(weekly(inventory, flights_sold(passengers, ancillary)), f"compare-{spec.name}-weeks{tag}")

    def names(tag: str) -> dict[str, str]:
        mid = f"{tag}_" if tag else ""
        unit = {b: f"{b}_{mid}{spec.unit}" for b in (*BUCKETS, "AncillaryAmount")}
        return {"SeatsSold": f"SeatsSold{'_' + tag if tag else ''}", "Capacity": f"Capacity{'_' + tag if tag else ''}", **unit}

    year = spans.captured.year
    now_names = names("")
    base = weeks[""].select("Year", "Month", "WeekNumber", "CarrierCode", "Route", "Cabin", *[F.col(a).alias(b) for a, b in now_names.items()])
    this_year = same_period_join(base, {"Y1": weeks["Y1"], "Y1M": weeks["Y1M"]}, year, names)
    next_year = same_period_join(base, {"Y1": weeks["Y1"], "Y1M": weeks[""]}, year + 1, names)
    rows = this_year.unionByName(next_year).distinct()

    rows = cap.with_city_pair_distance(rows.withColumnRenamed("Route", "Sector"), t["city_pair"], "Sector")
    countries = t["travel_country"].select(
        F.col("CarrierCode").alias("_c"), sector("DepartureStation", "ArrivalStation").alias("_r"), F.col("TravelCountry").alias("Country")
    )
    rows = rows.join(countries, (F.col("CarrierCode") == F.col("_c")) & (F.col("Sector") == F.col("_r")), "left").drop("_c", "_r")
    regions = t["travel_region"].select(F.trim("Country").alias("_country"), "Region").distinct()
    rows = rows.join(regions, F.trim("Country") == F.col("_country"), "left").drop("_country")
    km = t["route_distance"].select(F.col("ODPair").alias("MarketGroup"), "Distance_km")
    rows = rows.join(km, "MarketGroup", "left")
    month_number = F.date_format(F.to_date(F.concat(F.lit("2000 "), "Month"), "yyyy MMMM"), "MM")
    amounts = []
    for tag in ("", "Y1", "Y1M"):
        n = names(tag)
        amounts += [n["SeatsSold"], n["Capacity"], *[n[b] for b in (*BUCKETS, "AncillaryAmount")]]
    money_columns = [c for c in amounts if c.endswith(spec.unit)]
    return rows.select(
        windows.stamp(spans.captured).alias("CapturedDate"), "Year", "Month", "WeekNumber", "CarrierCode", "Cabin", "Sector",
        F.coalesce("Distance_km", "Distance").alias("Distance"), F.col("MarketGroup").alias("Route"), "Country", "Region",
        month_number.alias("MonthNumber"), *[(m.money(c) if c in money_columns else F.col(c)).alias(c) for c in amounts],
    ).distinct()
