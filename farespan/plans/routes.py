"""Route and flight revenue: the long-haul family, all carriers, finance, pax and capacity."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from farespan.functions import fixed, labels, windows
from farespan.functions import timefn as tf
from farespan.functions.keys import (
    alias_station, home_currency_strict, is_special_flight, recode, route_key, sector,
)
from farespan.functions.windows import Window
from farespan.operators import capacity as cap
from farespan.operators import money as m
from farespan.operators import passengers as px
from farespan.sources.sinks import publish, scoped, stage
from farespan.sources.tables import Tables
from farespan.sources.views import fee_view, segment_view

EXTRA_CODES = {"ThruFare": "THRU", "XHISEA": "XHISEA", "ADM": "ADM"}


def fare_parts() -> list[Column]:
    return [m.of_type(0), m.of_type(1), m.of_type(7)]


def extra_parts() -> dict[str, Column]:
    return {name: m.of_code(code) for name, code in EXTRA_CODES.items()}


# ---------------------------------------------------------------- long-haul family

@dataclass(frozen=True)
class RouteSpec:
    """One member of the long-haul route family."""

    name: str
    keeps: Callable[[str, str], Column]
    fee_keeps: Callable[[str, str], Column]
    label: dict[str, str] = field(default_factory=dict)
    matrix_sign: bool = False
    extras: bool = False
    currencies: tuple[tuple[str, str, str], ...] = (("", "MYR", "mul_one"),)
    premium_seats: dict = field(default_factory=lambda: fixed.PREMIUM_SEATS)
    economy_only: dict = field(default_factory=dict)
    airport_fee: str | None = None

    @property
    def measures(self) -> list[str]:
        return ["BaseFare", "FuelSurcharge", *(EXTRA_CODES if self.extras else ())]


def _d7(c: str, f: str) -> Column:
    closed = fixed.D7_SPECIAL + fixed.D7_AS_XT + fixed.D7_AS_XJ
    return (F.col(c) == "D7") & ~F.col(f).isin(list(closed))


def _xt(c: str, f: str) -> Column:
    return (F.col(c) == "XT") | is_special_flight(c, f, "D7", fixed.D7_AS_XT)


def _xj(c: str, f: str) -> Column:
    return (F.col(c) == "XJ") | is_special_flight(c, f, "D7", fixed.D7_AS_XJ)


ROUTE_D7 = RouteSpec("d7", _d7, lambda c, f: F.col(c) == "D7", extras=True, airport_fee="AptChargeRM")
ROUTE_XT = RouteSpec(
    "xt", _xt, _xt, matrix_sign=True, currencies=(("", "USD", "div_one"),),
    premium_seats=fixed.PREMIUM_SEATS_333, airport_fee=None,
)
ROUTE_XJ = RouteSpec(
    "xj", _xj, _xj, label={"D7": "XJ"}, matrix_sign=True, currencies=(("THB", "THB", "div_one"), ("MYR", "MYR", "div_one")),
    premium_seats=fixed.PREMIUM_SEATS_333, economy_only={(330, "F"): 12},
)


def _segment_totals(t: Tables, of: DataFrame, single: dict, summed: dict, by_matrix: bool, fanout: str, few: bool = False) -> DataFrame:
    """Charge buckets of the stored segments; ``few`` is as in :func:`px.around`."""
    charges = t["passenger_journey_charge"].select("PassengerID", "SegmentID", "ChargeNumber", "ChargeType", "ChargeCode", "ChargeAmount")
    charges = px.around(charges, of, "PassengerID", "SegmentID", few=few)
    amount = None
    if by_matrix:
        charges = m.signed_by_matrix(charges, t["charge_type_matrix"], "left")
        amount = F.coalesce(F.col("ChargeAmount"), F.lit(0).cast("decimal(18,4)")) * F.col("PositiveNegativeFlag")
    return m.segment_charges(charges, single, summed, amount, fanout)


def _booking_of(df: DataFrame, t: Tables, columns: tuple[str, ...]) -> DataFrame:
    people = t["booking_passenger"].select("PassengerID", "BookingID")
    return df.join(people, "PassengerID", "left").join(t["booking"].select("BookingID", *columns), "BookingID", "left")


def fee_amounts(passengers: DataFrame, t: Tables, keeps: Column | None, by_matrix: bool) -> DataFrame:
    """Distinct fee charges of the given, stored passengers, by flight of the fee.

    Equal charges of one fee collapse, and fees without a flight are left out.
    """
    people = passengers.select("PassengerID")
    fees = fee_view(t)
    if keeps is not None:
        fees = fees.where(keeps)
    charge = t["passenger_fee_charge"].select("PassengerID", "FeeNumber", "ChargeType", "ChargeAmount", "CurrencyCode", "CreatedDate")
    fees, charge = px.within(fees, people, "PassengerID"), px.within(charge, people, "PassengerID")
    rows = fees.join(charge, ["PassengerID", "FeeNumber"], "left")
    if by_matrix:
        rows = m.signed_by_matrix(rows, t["charge_type_matrix"], "left").withColumn("Amount", F.coalesce("Amount", F.lit(0)))
    else:
        rows = rows.withColumn("Amount", m.signed_by_list())
    flight = ["DepartureDate", "CarrierCode", "FlightNumber", "DepartureStation", "ArrivalStation"]
    for c in flight[1:]:
        rows = rows.where(F.col(c) != "")
    return rows.select("PassengerID", "FeeNumber", "FeeCode", *flight, "CurrencyCode", "CreatedDate", "Amount").distinct()


def ancillary_by_flight(fees: DataFrame, t: Tables, currencies: tuple[tuple[str, str, str], ...], collapse: bool = True,
                        once: bool = False) -> DataFrame:
    """Fee revenue per passenger, flight and currency, converted on the charge day.

    ``collapse`` keeps one of several equal amounts of a passenger's flight; ``once`` makes
    repeated rate rows count once.
    """
    flight = ["DepartureDate", "CarrierCode", "FlightNumber", "DepartureStation", "ArrivalStation"]
    priced = fees.withColumn("CreatedDay", tf.day("CreatedDate"))
    for tag, target, mode in currencies:
        priced = m.convert(priced, t["fx_history"], ["Amount"], home=target, charged="CurrencyCode", on="CreatedDay", mode=mode, suffix=f"_{tag}", once=once)
    sums = [m.money(F.sum(f"Amount_{tag}")).alias(f"Ancillary{tag}") for tag, _, _ in currencies]
    out = priced.groupBy("PassengerID", *flight, "CurrencyCode").agg(*sums)
    out = out.select(
        "PassengerID", "DepartureDate", "CarrierCode", "FlightNumber", sector("DepartureStation", "ArrivalStation").alias("Route"),
        *[f"Ancillary{tag}" for tag, _, _ in currencies],
    )
    return out.distinct() if collapse else out


ROUTE_TABLES = ("passengers", "fare_class_revenue", "inventory_revenue", "inventory_revenue_fare_class")


@scoped
def route_revenue(t: Tables, now: datetime, spec: RouteSpec, fanout: str = "safe", departs: Window | None = None,
                  wanted: tuple[str, ...] = ROUTE_TABLES, publish_to: dict[str, str] | None = None) -> dict[str, DataFrame]:
    """Seats, capacity and revenue by month, flight, route and cabin or fare class.

    Returns the ``wanted`` ones of :data:`ROUTE_TABLES`; nothing is written that they don't
    need. The first two are steps on the way to the others: ``publish_to`` gives paths under
    which they are saved in the middle of the run and read back for the rest of it.
    """
    publish_to = publish_to or {}
    local = windows.to_local(now, windows.MALAYSIA)
    captured_day = windows.midnight(local) - timedelta(days=1)
    departs = departs or windows.season(local, 2)
    booked = Window(None, windows.midnight(local)).shift(-8)
    tags = [tag for tag, _, _ in spec.currencies]
    captured = windows.stamp(captured_day)
    captured_columns = [
        captured.alias("CapturedDate"), F.dayofyear(captured).alias("DayOfYear"), F.dayofweek(captured).alias("DayOfWeek"),
    ]

    # Passengers with fare and fuel in report currencies.
    seg = segment_view(t).where(
        (F.col("BookingStatus") == "HK") & booked.covers("CreatedDate") & departs.covers("DepartureDate")
    )
    seg = px.remap_carrier(seg, t["carrier_mapping"]).where(spec.keeps("CarrierCode", "FlightNumber"))
    seg = seg.select(
        "PassengerID", "SegmentID", "DepartureDate", recode("CarrierCode", spec.label).alias("CarrierCode") if spec.label else "CarrierCode",
        "FlightNumber", sector("DepartureStation", "ArrivalStation").alias("Route"), "FareClassOfService",
        labels.cabin("FareClassOfService", fixed.PREMIUM_G1).alias("Cabin"), tf.day("CreatedDate").alias("CreatedDay"), "CreatedAgentID",
    )
    seg = stage(seg, f"route-{spec.name}-segments")
    totals = _segment_totals(
        t, seg, {"BaseFare": fare_parts()}, {"FuelSurcharge": m.fuel(), **(extra_parts() if spec.extras else {})}, spec.matrix_sign, fanout
    )
    classes = t["fare_class"].select(F.col("ClassOfService").alias("FareClassOfService"), "FareClass").distinct()
    base = _booking_of(seg.join(totals, ["PassengerID", "SegmentID"], "left"), t, ("RecordLocator", "CurrencyCode"))
    base = m.zero_filled(base.join(classes, "FareClassOfService", "left"), spec.measures)
    for tag, target, mode in spec.currencies:
        base = m.convert(base, t["fx_history"], spec.measures, home=target, charged="CurrencyCode", on="CreatedDay", mode=mode, suffix=f"_{tag}")
    names = [(x, tag, f"{x}{tag}") for tag in tags for x in spec.measures]
    who = [
        "PassengerID", "RecordLocator", "DepartureDate", "CarrierCode", "FlightNumber", "Route", "Cabin", "FareClassOfService",
        "FareClass", "CurrencyCode",
    ]
    passengers = base.groupBy(*who, "CreatedAgentID").agg(*[m.money(F.sum(f"{x}_{tag}")).alias(out) for x, tag, out in names])
    if set(wanted) == {"passengers"} and "passengers" not in publish_to:
        return {"passengers": passengers.select(*captured_columns, "*")}
    passengers = publish(passengers.select(*captured_columns, "*"), publish_to.get("passengers"), f"route-{spec.name}-passengers")
    passengers_out, passengers = passengers, passengers.drop("CapturedDate", "DayOfYear", "DayOfWeek")

    fees = fee_amounts(passengers, t, spec.fee_keeps("CarrierCode", "FlightNumber"), spec.matrix_sign)
    if spec.label:
        fees = fees.withColumn("CarrierCode", recode("CarrierCode", spec.label)).distinct()
    extra = ancillary_by_flight(fees, t, spec.currencies)

    # Seats and revenue per flight day and class; bookings are not told apart here.
    sold = passengers.drop("CreatedAgentID").distinct().join(
        extra, ["PassengerID", "CarrierCode", "FlightNumber", "DepartureDate", "Route"], "left"
    )
    flight_class = ["DepartureDate", "CarrierCode", "FlightNumber", "Route", "FareClassOfService", "FareClass", "Cabin", "CurrencyCode"]
    revenue = [out for _, _, out in names]
    ancillary = [f"Ancillary{tag}" for tag in tags]
    sold = sold.groupBy(*flight_class).agg(
        F.count("PassengerID").alias("SeatSold"), *[F.sum(r).alias(r) for r in revenue],
        *[F.coalesce(F.sum(a), F.lit(0)).alias(a) for a in ancillary],
    )

    # Open legs of the same flights, one row per cabin.
    legs = departs.of(t["inventory_leg"], "DepartureDate").where((F.col("Status") != 2) & (F.col("Lid") > 0))
    legs = px.remap_carrier(legs, t["carrier_mapping"]).where(spec.keeps("CarrierCode", "FlightNumber"))
    if spec.label:
        legs = legs.withColumn("CarrierCode", recode("CarrierCode", spec.label))
    legs = cap.with_market_pair(legs, t["city_pair"])
    legs = legs.select(
        "InventoryLegKey", "DepartureDate", "CarrierCode", "FlightNumber", "DepartureStation", "ArrivalStation", "ODPair",
        "EquipmentType", "EquipmentTypeSuffix", "Capacity",
    ).distinct()
    inventory = cap.cabin_capacity(legs, spec.premium_seats, spec.economy_only).distinct()
    flown = legs.where(F.col("ODPair").isNotNull()).select(
        "InventoryLegKey", "DepartureDate", "CarrierCode", "FlightNumber", "DepartureStation", "ArrivalStation", "ODPair"
    ).distinct()

    months = [tf.month_name("DepartureDate").alias("DepartureMonth"), F.year("DepartureDate").alias("DepartureYear")]
    fare_class = sold.join(flown.select("DepartureDate", "CarrierCode", "FlightNumber", "ODPair"), ["DepartureDate", "CarrierCode", "FlightNumber"])
    fare_class = fare_class.groupBy(
        "ODPair", *months, "CarrierCode", "FlightNumber", "Route", "FareClassOfService", "FareClass", "Cabin", "CurrencyCode"
    ).agg(F.sum("SeatSold").alias("SeatSold"), *[m.money(F.sum(r)).alias(r) for r in revenue + ancillary])
    fare_class_out = fare_class.select(F.lit("hub").alias("Hub"), captured.alias("CapturedDate"), "*")
    if not set(wanted) <= {"passengers", "fare_class_revenue"} or "fare_class_revenue" in publish_to:
        fare_class_out = publish(fare_class_out, publish_to.get("fare_class_revenue"), f"route-{spec.name}-fare-class")
        fare_class = fare_class_out.drop("Hub", "CapturedDate")

    month = ["DepartureMonth", "DepartureYear", "FlightNumber"]
    by_cabin = fare_class.groupBy("ODPair", *month, "CarrierCode", "Route", "Cabin").agg(
        F.sum("SeatSold").alias("SeatsSold"), *[F.sum(r).alias(r) for r in revenue + ancillary]
    )
    zero_filled = ["SeatsSold", *revenue, *ancillary]

    open_seats = inventory.groupBy(
        "Cabin", *months, "FlightNumber", "CarrierCode", sector("DepartureStation", "ArrivalStation").alias("Route"), "ODPair"
    ).agg(F.sum("Capacity").alias("Capacity"))
    out = open_seats.join(by_cabin.drop("CarrierCode"), [*month, "Cabin", "Route", "ODPair"], "left")
    out = out.withColumns({c: F.coalesce(c, F.lit(0)) for c in zero_filled})
    fee_key = ["Route", "ODPair", *month, "Cabin"]
    if spec.airport_fee:
        taxed = cap.with_airport_fee(by_cabin, t["airport_fee"], windows.day_literal(captured_day))
        taxed = taxed.withColumn("_fee", F.col("SeatsSold") * F.col("FeeMYR"))
        per_cabin = taxed.groupBy(*fee_key).agg(m.money(F.sum("_fee")).alias("AptCharge"))
        out = out.join(per_cabin, fee_key, "left")
    else:
        out = out.withColumn("AptCharge", m.money(F.lit(0)))
    hub_base = F.when(F.col("ODPair").isNotNull(), F.lit("hub"))
    out = cap.assign_hub(out, t["hub_info"], "ODPair", hub_base)
    inventory_revenue = out.select(
        "Hub", "ODPair", *captured_columns, "DepartureMonth", "DepartureYear", "FlightNumber", "CarrierCode", "Route", "Cabin",
        "SeatsSold", *[m.money(c).alias(c) for c in revenue + ancillary], "Capacity", "AptCharge", F.lit(0).alias("AptEnabled"),
    ).distinct()

    flights = inventory.select(sector("DepartureStation", "ArrivalStation").alias("Route"), *months, "FlightNumber", "CarrierCode").distinct()
    if spec.airport_fee:
        per_flight = taxed.groupBy(*month).agg(m.money(F.sum("_fee")).alias("AptCharge"))
        flights = flights.join(per_flight, month)
    else:
        flights = flights.withColumn("AptCharge", m.money(F.lit(0)))
    classes_sold = fare_class.select(
        F.lit("hub").alias("_hub"), captured.alias("CapturedDate"), F.col("ODPair"), F.col("Route").alias("_route"), *month,
        "FareClass", "FareClassOfService", "SeatSold", *revenue, *ancillary, "Cabin", "CurrencyCode",
    ).withColumn("Route", F.col("_route"))
    by_class = flights.join(classes_sold, ["Route", *month], "left")
    by_class = cap.assign_hub(by_class, t["hub_info"], "ODPair", F.col("_hub"))
    by_class = by_class.select(
        "Hub", "ODPair", "CapturedDate", *captured_columns[1:], "DepartureMonth", "DepartureYear", "FlightNumber", "CarrierCode",
        F.col("_route").alias("Route"), "FareClass", "FareClassOfService", "SeatSold", *revenue, *ancillary, "AptCharge",
        F.lit(0).alias("AptEnabled"),
    ).distinct()
    return {n: df for n, df in zip(ROUTE_TABLES, (passengers_out, fare_class_out, inventory_revenue, by_class)) if n in wanted}


# ---------------------------------------------------------------- all carriers

ALL_BUCKETS = ("BaseFare", "FuelSurcharge", "Connecting", "AptCharges", "ThruFare", "XHISEA", "ADM")


def _open_flight(carrier: str, flight: str) -> Column:
    return ~F.concat_ws(" ", carrier, flight).isin(list(fixed.CLOSED_FLIGHTS))


def _not_closed_fd(df: DataFrame) -> DataFrame:
    closed = (
        is_special_flight("CarrierCode", "FlightNumber", "FD", fixed.FD_CLOSED_FLIGHTS)
        & (F.col("DepartureDate") < F.lit(fixed.FD_CLOSED_BEFORE).cast("date"))
    )
    return df.where(~F.coalesce(closed, F.lit(False)))


@scoped
def all_carrier_revenue(t: Tables, now: datetime, departs: Window | None = None, bounds: str | None = None) -> dict[str, DataFrame]:
    """Seats, lid, capacity and seven revenue buckets in MYR and airline currency.

    Returns ``by_carrier`` and, with PQ folded into Z2, ``merged``.
    """
    local = windows.to_local(now, windows.MALAYSIA)
    today = windows.to_utc(windows.midnight(local), bounds)
    departs = departs or windows.season(local, 3)
    seg = segment_view(t).where(
        (F.col("BookingStatus") == "HK") & Window(None, today).shift(-8).covers("CreatedDate") & departs.covers("DepartureDate")
        & F.col("CarrierCode").isin(list(fixed.GROUP_CARRIERS))
    )
    seg = px.remap_carrier(seg, t["carrier_mapping"]).where(_open_flight("CarrierCode", "FlightNumber"))
    seg = stage(seg.select(
        "PassengerID", "SegmentID", "DepartureDate", "CarrierCode", "FlightNumber", "DepartureStation", "ArrivalStation",
        "CurrencyCode", tf.day("CreatedDate").alias("CreatedDay"),
    ), "carriers-segments")
    totals = _segment_totals(
        t, seg, {},
        {
            "BaseFare": m.of_type(0, 1, 7), "FuelSurcharge": m.fuel(), "Connecting": m.of_type(8),
            "AptCharges": m.of_code("APF"), **extra_parts(),
        },
        False, "safe",
    )
    rows = m.zero_filled(seg.join(totals, ["PassengerID", "SegmentID"], "left"), ALL_BUCKETS)

    # Amounts are summed per flight, currency and charge day before rates are joined.
    flight = ["DepartureDate", "CarrierCode", "FlightNumber", "DepartureStation", "ArrivalStation"]
    rows = rows.groupBy(*flight, "CurrencyCode", "CreatedDay").agg(
        F.count("PassengerID").alias("Seats"), *[F.sum(b).alias(b) for b in ALL_BUCKETS]
    )
    targets = sorted(set(fixed.HOME_CURRENCY_STRICT.values()))
    rows = m.with_rates(rows, t["fx_history"], targets, "CurrencyCode", "CreatedDay")
    home = home_currency_strict("CarrierCode")
    chosen = F.coalesce(*[F.when(home == c, m.or_one(rows, f"Rate_{c}")) for c in targets])
    sums = [m.money(F.sum(m.money(b) / F.col("Rate_MYR"))).alias(f"{b}RM") for b in ALL_BUCKETS]
    sums += [m.money(F.sum(m.money(b) / chosen)).alias(f"{b}AirlineCurrency") for b in ALL_BUCKETS]
    seats = rows.groupBy(*flight).agg(F.sum("Seats").alias("SeatsSold"), *sums)
    seats = _not_closed_fd(seats.withColumns({c: alias_station(c) for c in ("DepartureStation", "ArrivalStation")}))

    legs = departs.of(t["inventory_leg"], "DepartureDate").where(
        (F.col("Status") != 2) & (F.col("Lid") > 0)
        & ((F.col("CreatedDate") <= windows.stamp(today)) | (F.col("ModifiedDate") <= windows.stamp(today)))
    )
    legs = px.remap_carrier(legs, t["carrier_mapping"]).where(_open_flight("CarrierCode", "FlightNumber"))
    legs = cap.with_market_pair(_not_closed_fd(legs), t["city_pair"], "_own")
    legs = legs.withColumns({c: alias_station(c) for c in ("DepartureStation", "ArrivalStation")})
    legs = cap.with_market_pair(legs, t["city_pair"], "_renamed").withColumn("ODPair", F.coalesce("_renamed", "_own"))
    months = [tf.month_name("DepartureDate").alias("DepartureMonth"), F.year("DepartureDate").cast("string").alias("DepartureYear")]
    inventory = legs.groupBy("InventoryLegKey", *months, *flight, "OpSuffix", "ODPair").agg(
        F.sum("Lid").alias("Lid"), F.sum("Capacity").alias("Capacity")
    )
    measures = ["SeatsSold", "Lid", "Capacity"]
    amounts = [f"{b}{s}" for s in ("RM", "AirlineCurrency") for b in ALL_BUCKETS]
    joined = inventory.join(seats, flight, "left")
    keys = ["DepartureYear", "DepartureMonth", "CarrierCode", "FlightNumber", "ODPair"]

    def total(df: DataFrame, by: list[str]) -> DataFrame:
        return df.groupBy(*by).agg(*[F.sum(x).alias(x) for x in measures], *[m.money(F.sum(a)).alias(a) for a in amounts])

    captured = windows.stamp(windows.midnight(local) - timedelta(days=1))
    stamps = [captured.alias("CapturedDate"), F.dayofyear(captured).alias("DayOfYear"), F.dayofweek(captured).alias("DayOfWeek")]
    by_carrier = cap.assign_hub(total(joined, keys), t["hub_info"], "ODPair")
    merged = total(by_carrier.withColumn("CarrierCode", recode("CarrierCode", {"PQ": "Z2"})), [*keys, "Hub"])
    order = [*keys, "Hub", *measures, *amounts]
    return {"by_carrier": by_carrier.select(*stamps, *order), "merged": merged.select(*stamps, *order)}


# ---------------------------------------------------------------- finance

@scoped
def finance_by_flight(t: Tables, now: datetime, departs: Window | None = None) -> DataFrame:
    """Fare and fuel in seven currencies; capacity and distance once per flight."""
    local = windows.to_local(now, windows.MALAYSIA)
    departs = departs or windows.two_back_five_ahead(local)
    known = t["carrier"].where((F.col("CarrierType") == "H") & (F.col("CarrierCode") != fixed.FERRY_CARRIER)).select("CarrierCode")
    seg = segment_view(t).where((F.col("BookingStatus") == "HK") & departs.covers("DepartureDate"))
    seg = px.remap_carrier(seg.join(known, "CarrierCode", "left_semi"), t["carrier_mapping"])
    seg = stage(seg.select(
        "PassengerID", "SegmentID", "DepartureDate", "CarrierCode", "FlightNumber", "InventoryLegID",
        sector("DepartureStation", "ArrivalStation").alias("Route"),
    ), "finance-segments")
    totals = _segment_totals(t, seg, {}, {"BaseFare": m.of_type(0, 8, 1, 7), "FuelSurcharge": m.fuel()}, True, "safe", few=True)
    rows = seg.join(totals, ["PassengerID", "SegmentID"], "left")
    rows = _booking_of(rows, t, ("BookingDate", "CurrencyCode"))
    flight = ["DepartureDate", "CarrierCode", "FlightNumber", "InventoryLegID", "Route", "CurrencyCode"]
    rows = m.zero_filled(rows, ["BaseFare", "FuelSurcharge"]).groupBy(*flight, tf.day("BookingDate").alias("BookedDay")).agg(
        F.count("PassengerID").alias("Seats"), F.sum("BaseFare").alias("BaseFare"), F.sum("FuelSurcharge").alias("FuelSurcharge")
    )
    rows = m.with_rates(rows, t["fx_history"], fixed.FINANCE_CURRENCIES, "CurrencyCode", "BookedDay")
    amounts = []
    for c in fixed.FINANCE_CURRENCIES:
        for b in ("BaseFare", "FuelSurcharge"):
            amounts.append(m.money(F.sum(m.money(b) / m.or_one(rows, f"Rate_{c}"))).alias(f"{b}{'RM' if c == 'MYR' else c}"))
    sold = rows.groupBy(*flight).agg(F.sum("Seats").alias("SeatsSold"), *amounts)
    money_columns = [c for c in sold.columns if c.startswith(("BaseFare", "FuelSurcharge"))]
    numbered = cap.first_row(sold, ["CarrierCode", "FlightNumber", "InventoryLegID", "DepartureDate", "Route"], ["CurrencyCode"])

    # Row 1 of a flight needs an open leg and carries capacity and distance; others carry 0.
    legs = t["inventory_leg"].where((F.col("Lid") > 0) & (F.col("Status") != 2)).select(
        "InventoryLegID", "DepartureStation", "ArrivalStation", "Capacity"
    )
    legs = cap.actual_distance(legs, t["distance"], t["city_pair"]).drop("DepartureStation", "ArrivalStation").withColumn("_open", F.lit(True))
    rows = numbered.join(legs, "InventoryLegID", "left").where((F.col("RowNo") > 1) | F.col("_open"))
    first = F.col("RowNo") == 1
    rows = rows.withColumns({c: F.when(first, F.col(c)).otherwise(F.lit(0)) for c in ("Capacity", "ActualDistance", "ActualDistanceUnit")})
    by_flight = ["DepartureDate", "CarrierCode", "FlightNumber", "Route"]
    rows = rows.select(*by_flight, "CurrencyCode", "SeatsSold", "Capacity", "ActualDistance", "ActualDistanceUnit", *money_columns, "RowNo").distinct()
    return _traffic(rows, by_flight).select(
        windows.stamp(local).alias("CapturedDate"), F.year("DepartureDate").alias("YearInt"), F.month("DepartureDate").alias("MonthInt"),
        tf.month_label("DepartureDate").alias("Month"), *by_flight, "CurrencyCode", "SeatsSold", "Capacity", "ActualDistance",
        "ActualDistanceUnit", F.col("ActualDistanceUnit").alias("FlightCount"), *money_columns, "PassengerMiles", "ASM",
    ).distinct()


def _traffic(rows: DataFrame, by_flight: list[str]) -> DataFrame:
    """Passenger miles and available seat miles of the flight, on its first row."""
    flight = W.partitionBy(*by_flight)
    first = F.col("RowNo") == 1
    km = F.sum("ActualDistance").over(flight)
    return rows.withColumns({
        "PassengerMiles": F.when(first, F.sum("SeatsSold").over(flight) * km).otherwise(F.lit(0)),
        "ASM": F.when(first, F.sum("Capacity").over(flight) * km).otherwise(F.lit(0)),
    })


# ---------------------------------------------------------------- pax and capacity

def pax_capacity(t: Tables, now: datetime, departs: Window | None = None) -> DataFrame:
    """Distinct passengers and capacity per flight and departure."""
    departs = departs or windows.previous_month_to_year_end(now)
    legs = departs.of(px.live_legs(t), "DepartureDate")
    legs = legs.select("InventoryLegID", "DepartureDate", "CarrierCode", "FlightNumber", "DepartureStation", "ArrivalStation", F.col("AdjustedCapacity").alias("Capacity"))
    segments = t["passenger_journey_segment"].select("PassengerID", "SegmentID", "International")
    flown = t["passenger_journey_leg"].select("PassengerID", "SegmentID", "InventoryLegID")
    confirmed = px.bookings(t, None, (2, 3)).select("BookingID").join(t["booking_passenger"].select("PassengerID", "BookingID"), "BookingID")
    rows = flown.join(legs, "InventoryLegID").join(segments, ["PassengerID", "SegmentID"]).join(confirmed, "PassengerID")
    flight = ["DepartureDate", "CarrierCode", "FlightNumber", "DepartureStation", "ArrivalStation", "International", "Capacity"]
    out = rows.groupBy(*flight).agg(F.countDistinct("SegmentID").alias("Pax"))
    out = out.withColumn("Route", route_key("DepartureStation", "ArrivalStation")).withColumn("Sector", sector("DepartureStation", "ArrivalStation"))
    return cap.assign_hub(out, t["hub_info"], "Route")
