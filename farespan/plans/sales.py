"""Booking sales reports: management sales, cash flow, currency sales, ancillaries."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farespan.functions import fixed, windows
from farespan.functions.keys import home_currency, pair_key, route_key, sector
from farespan.functions.timefn import day, minutes_between
from farespan.functions.windows import Window
from farespan.operators import capacity as cap
from farespan.operators import money as m
from farespan.operators import passengers as px
from farespan.operators.channels import with_agent
from farespan.sources.sinks import scoped, stage
from farespan.sources.tables import Tables, by_rows


@scoped
def daily_sales(t: Tables, now: datetime, window: Window | None = None) -> DataFrame:
    """Seats and base fare in home currency by booking day, carrier, status and role."""
    window = window or windows.month_of_yesterday_to_date(now)
    fact = px.passenger_fact(t, px.bookings(t, window, None), px.live_legs(t))
    role = by_rows(t["agent_role"].select(F.col("AgentID").alias("CreatedAgentID"), "RoleCode"), t["agent_role"])
    fact = fact.join(role, "CreatedAgentID", "left")
    fact = stage(fact.select("PassengerID", "SegmentID", "BookingDate", "CarrierCode", "Status", "RoleCode"), "management-passengers")
    charges = px.segment_sums(px.journey_charges(t, of=fact, few=True), {"Fare": m.bucket(m.fare_types())})
    per_segment = fact.join(charges, ["PassengerID", "SegmentID"]).withColumns(
        {"Home": home_currency("CarrierCode"), "BookingDate": day("BookingDate")}
    )
    converted = m.convert(per_segment, t["fx_history"], ["Fare"], home="Home", charged="CurrencyCode", on="CreatedDay",
                          mode="local", suffix="Home")
    return converted.groupBy("BookingDate", "CarrierCode", "Status", "RoleCode").agg(
        F.countDistinct("SegmentID").alias("SeatSold"), m.money(F.sum("FareHome")).alias("SalesAmt")
    ).select(windows.day_literal(now).alias("CapturedDate"), "*")


def _converted_sums(rows: DataFrame, t: Tables, keys: list[str], measures: dict[str, Column], mode: str,
                    home: str | None = None) -> DataFrame:
    """Bucket sums of charge rows per key, converted on the charge day.

    Charges are first summed per key, currency and day, on the map side, so only
    the small result meets the rate history.
    """
    group = list(dict.fromkeys([*keys, "CurrencyCode", *([home] if home else []), "CreatedDay"]))
    if "CreatedDay" not in rows.columns:
        rows = rows.withColumn("CreatedDay", day("CreatedDate"))
    summed = rows.groupBy(*group).agg(*[e.alias(n) for n, e in measures.items()])
    out = m.convert(summed, t["fx_history"], list(measures), home=home or "MYR", charged="CurrencyCode", on="CreatedDay",
                    mode=mode, suffix="_c")
    return out.groupBy(*keys).agg(*[m.money(F.sum(f"{n}_c")).alias(n) for n in measures])


@scoped
def cash_flow(t: Tables, now: datetime, window: Window | None = None, bounds: str | None = None) -> DataFrame:
    """Fare, ancillary and tax revenue by booking day, carrier, charter flag and currency."""
    default, morning = windows.month_to_date_with_cutoff(windows.to_local(now, windows.MALAYSIA), bounds)
    fact = px.passenger_fact(
        t, px.bookings(t, window or default, (1, 2, 3)), px.live_legs(t),
        ("CarrierCode", "OperatingCarrier", "FlightNumber"),
    ).select(
        "PassengerID", "SegmentID", "JourneyNumber", "SegmentNumber", "InventoryLegID",
        day("BookingDate").alias("BookingDate"), "CarrierCode", "Status", px.is_chartered().alias("IsChartered"),
    )
    fact = stage(fact.withColumn("Home", home_currency("CarrierCode")), "cash-passengers")
    keys = ["BookingDate", "CarrierCode", "IsChartered", "Status", "CurrencyCode"]
    codes = t["ancillary_fee_codes"]

    charges = px.segment_sums(
        m.with_ancillary(px.journey_charges(t, of=fact, few=True), codes),
        {
            "FareRevenue": m.bucket(m.fare_types(), m.of_code(*fixed.SURCHARGE_CODES)),
            "AncillaryRevenue": m.bucket(m.ancillary()),
            "Tax": m.bucket(m.of_code(*fixed.TAX_CODES)),
        },
    )
    journey = _converted_sums(
        fact.join(charges, ["PassengerID", "SegmentID"]), t, keys,
        {n: F.sum(n) for n in ("FareRevenue", "AncillaryRevenue", "Tax")}, "local", "Home",
    )
    journey = stage(journey, "cash-journeys")  # what it moved is gone before the fees are
    fees = m.with_ancillary(m.signed_by_matrix(px.fee_lines(t, fact), t["charge_type_matrix"]), codes, "FeeCode")
    measures = {
        "FareRevenue": F.sum(F.lit(0)),
        "AncillaryRevenue": m.bucket_or_null(F.col("IsAncillary")),
        "Tax": m.bucket(m.of_type(5)),
    }
    # Equal rows of fees with and without a leg collapse, so they are told apart until then.
    extra = _converted_sums(px.passenger_fees(fact, fees), t, [*keys, "Loose"], measures, "local", "Home").drop("Loose")

    pax_keys = ["BookingDate", "CarrierCode", "Status", "IsChartered"]
    pax = fact.groupBy(*pax_keys).agg(F.countDistinct("SegmentID").alias("Pax"))
    return journey.union(extra).distinct().join(pax, pax_keys, "left").withColumn(
        "IsMorning", F.lit("Y" if morning else "N")
    )


@scoped
def currency_sales(t: Tables, now: datetime, window: Window | None = None, departs: Window | None = None) -> DataFrame:
    """Sales by booking currency with a ``Total`` row per carrier, and forward ASK."""
    default, default_departs = windows.trailing_31_days(now)
    window, departs = window or default, departs or default_departs
    legs = px.drop_charters(px.live_legs(t), t["chartered_flights"])
    fact = stage(
        px.passenger_fact(t, px.bookings(t, window, (2, 3)), legs).select(
            "PassengerID", "SegmentID", "JourneyNumber", "SegmentNumber", "InventoryLegID",
            day("BookingDate").alias("BookingDate"), "CarrierCode",
        ),
        "currency-passengers",
    )
    keys = ["BookingDate", "CarrierCode", "CurrencyCode"]
    names = ["FareRevenue", "FuelAmount", "FeeAmount", "JourneyChargeOthers"]
    codes = t["ancillary_fee_codes"]
    charges = px.segment_sums(
        m.with_ancillary(px.journey_charges(t, of=fact, few=True), codes),
        {
            "FareRevenue": m.bucket(m.fare_types(), m.of_code("KLIA2")),
            "FuelAmount": m.bucket(m.fuel()),
            "FeeAmount": m.bucket(m.ancillary()),
            "JourneyChargeOthers": m.bucket(m.other()),
        },
    )
    per_segment = fact.join(charges, ["PassengerID", "SegmentID"])
    journey = m.convert(per_segment, t["fx_history"], names, home="MYR", charged="CurrencyCode", on="CreatedDay",
                        mode="myr", suffix="_c").groupBy(*keys).agg(
        *[m.money(F.sum(f"{n}_c")).alias(n) for n in names], F.countDistinct("SegmentID").alias("SeatsSold")
    )
    journey = stage(journey, "currency-journeys")  # what it moved is gone before the fees are
    fees = m.with_ancillary(m.signed_by_matrix(px.fee_lines(t, fact), t["charge_type_matrix"]), codes, "FeeCode")
    measures = {n: F.sum(F.lit(0)) for n in names} | {"FeeAmount": m.bucket(F.col("IsAncillary"))}
    extra = _converted_sums(px.passenger_fees(fact, fees), t, [*keys, "Loose"], measures, "myr").drop("Loose")
    parts = journey.union(extra.withColumn("SeatsSold", F.lit(0).cast("long"))).distinct()
    by_currency = parts.groupBy(*keys).agg(
        *[m.money(F.sum(n)).alias(n) for n in names], F.sum("SeatsSold").alias("SeatsSold")
    ).where(F.col("CarrierCode") != fixed.FERRY_CARRIER)
    by_currency = stage(by_currency, "currency-sales")
    return sales_with_ask(by_currency, *forward_ask_tables(t, departs), window)


def forward_ask_tables(t: Tables, departs: Window) -> tuple[DataFrame, DataFrame]:
    """Forward ASK by carrier and currency, and by carrier."""
    legs = px.drop_charters(departs.of(px.live_legs(t), "DepartureDate"), t["chartered_flights"]).where(F.col("Capacity") > 0)
    sectors = stage(cap.ask(cap.sector_capacity(legs), t["city_pair"], t["distance"]), "currency-sectors")
    per_currency = cap.forward_ask(cap.ask_currency(sectors, t), ["CarrierCode", "AskCurrency"])
    return per_currency, cap.forward_ask(sectors, ["CarrierCode"])


def sales_with_ask(by_currency: DataFrame, ask_currency: DataFrame, ask_carrier: DataFrame, window: Window) -> DataFrame:
    """Full outer join of sales and ASK per currency, plus one Total row per carrier and day."""
    names = ["SeatsSold", "FareRevenue", "FuelAmount", "FeeAmount", "JourneyChargeOthers"]

    def in_window(df: DataFrame) -> DataFrame:
        return df.where(window.covers("Date"))

    def out(joined: DataFrame, currency: Column, wide: str) -> DataFrame:
        return joined.select(
            F.coalesce("BookingDate", "Date").alias("BookingDate"), F.coalesce("CarrierCode", "_carrier").alias("CarrierCode"),
            currency.alias("ForeignCurrencyCode"), *names, m.money(wide).alias("Ask"),
        )

    detail_ask = in_window(ask_currency).withColumnRenamed("CarrierCode", "_carrier").withColumnRenamed("Ask", "_ask")
    detail = by_currency.join(
        detail_ask,
        (F.col("CarrierCode") == F.col("_carrier")) & (F.col("BookingDate") == F.col("Date"))
        & (F.col("CurrencyCode") == F.col("AskCurrency")),
        "full",
    )
    blank = F.coalesce("CurrencyCode", F.lit("")) == ""
    detail = out(detail, F.when(blank, F.col("AskCurrency")).otherwise(F.col("CurrencyCode")), "_ask")

    by_carrier = by_currency.groupBy("BookingDate", "CarrierCode").agg(*[F.sum(n).alias(n) for n in names])
    by_carrier = by_carrier.withColumns({n: m.money(n) for n in names if n != "SeatsSold"})
    total_ask = in_window(ask_carrier).withColumnRenamed("CarrierCode", "_carrier").withColumnRenamed("Ask", "_ask")
    total = by_carrier.join(
        total_ask, (F.col("CarrierCode") == F.col("_carrier")) & (F.col("BookingDate") == F.col("Date")), "full"
    )
    total = out(total, F.lit("Total"), "_ask").groupBy("BookingDate", "CarrierCode", "ForeignCurrencyCode").agg(
        *[(F.sum(n) if n == "SeatsSold" else m.money(F.sum(n))).alias(n) for n in names], m.money(F.avg("Ask")).alias("Ask")
    )
    return detail.unionByName(total).distinct()


@scoped
def ancillary_revenue(t: Tables, now: datetime, window: Window | None = None) -> DataFrame:
    """Ancillary items, quantity and revenue by departure, flight, sector and fee."""
    window = window or windows.previous_month_plus_six(now)
    segments = t["passenger_journey_segment"].where(window.covers("DepartureDate") & (F.col("BookingStatus") == "HK"))
    legs = px.live_legs(t, ferry=True).withColumn("FlightDuration", minutes_between("STDUTC", "STAUTC"))
    fact = px.passenger_fact(
        t, px.bookings(t, None, (2, 3)), legs, ("CarrierCode", "FlightNumber", "FlightDuration"), segments
    )
    flight = ["DepartureDate", "CarrierCode", "FlightNumber", "DepartureStation", "ArrivalStation", "FlightDuration"]
    fact = stage(
        fact.select("PassengerID", "SegmentID", "JourneyNumber", "SegmentNumber", "InventoryLegID", "International", *flight),
        "ancillary-passengers",
    )
    pax = fact.groupBy(*flight).agg(F.count("SegmentID").alias("NoOfPax"))

    segment = ["PassengerID", "SegmentID", "InventoryLegID", "International", *flight]
    line = ["FeeNumber", "FeeCode", "CurrencyCode", "ChargeType", "ChargeAmount", "CreatedDate"]
    fees = px.fee_lines(t, fact)
    charges = t["passenger_journey_charge"].select(
        "PassengerID", "SegmentID", "ChargeNumber", "ChargeType", "ChargeCode", "ChargeAmount", "CurrencyCode", "CreatedDate"
    )
    # Other charges are left out where they are read, before the rest is moved.
    charges = m.with_ancillary(charges, t["ancillary_fee_codes"]).where(m.ancillary())
    charges = px.within(charges, fact, "PassengerID", "SegmentID").select(
        "PassengerID", "SegmentID", F.col("ChargeNumber").cast("long").alias("FeeNumber"),
        F.when(F.col("ChargeType") == 8, "ConnectingFee").otherwise(F.col("ChargeCode")).alias("FeeCode"),
        "CurrencyCode", "ChargeType", "ChargeAmount", "CreatedDate",
    )
    columns = [*segment, "JourneyNumber", "SegmentNumber", *line]
    # What fees moved is gone before the wide lines are.
    of_fees = stage(px.passenger_fees(fact, fees).select(*columns), "ancillary-fees")
    lines = (
        of_fees
        .union(fact.join(charges, ["PassengerID", "SegmentID"]).select(*columns))
        # Equal lines and the lines of an item lie together, so both are found in one move.
        .repartition("PassengerID", "SegmentID", "FeeNumber", "FeeCode")
        .distinct()
        .withColumn("Home", home_currency("CarrierCode"))
        .withColumn("CreatedDay", day("CreatedDate"))
        .withColumn("Signed", m.signed_by_list(fixed.MINUS_TYPES_FEES))
        .withColumn("Signed", F.when(F.col("ChargeAmount").isNotNull(), F.col("Signed")))
    )
    priced = m.convert(lines, t["fx_history"], ["Signed"], home="Home", charged="CurrencyCode", on="CreatedDay",
                       mode="local", suffix="Home")
    priced = m.convert(priced, t["fx_history"], ["Signed"], home="MYR", charged="CurrencyCode", on="CreatedDay",
                       mode="myr", suffix="MYR", on_missing=1)
    items = priced.groupBy(*segment, "FeeNumber", "FeeCode", "Home").agg(
        F.sum("SignedHome").alias("Amount"), F.sum("SignedMYR").alias("AmountMYR")
    )
    by_flight = items.groupBy("InventoryLegID", "International", *flight, "FeeCode").agg(
        F.count("SegmentID").alias("Quantity"), m.money(F.sum("Amount")).alias("Revenue"),
        m.money(F.sum("AmountMYR")).alias("RevenueMYR"),
    )

    out = by_flight.join(pax, flight, "left")
    out = out.join(t["inventory_leg"].select("InventoryLegID", "Capacity"), "InventoryLegID", "left")
    out = px.with_station(out, t["station"], "DepartureStation", DepartureStationName="ShortName", DepCountryCode="CountryCode")
    out = px.with_station(out, t["station"], "ArrivalStation", ArrivalStationName="ShortName", ArrCountryCode="CountryCode")
    out = px.with_country(out, t["country"], "DepCountryCode", "DepartureCountry")
    out = px.with_country(out, t["country"], "ArrCountryCode", "ArrivalCountry")
    fee_name = t["fee"].select("FeeCode", F.col("Name").alias("SSRDesc"))
    out = out.join(fee_name, "FeeCode", "left")
    hubs = t["hub_info"].where(F.length(F.rtrim("Hub")) < 6).select(
        "CarrierCode", "FlightNumber", "DepartureStation", "ArrivalStation", "Hub"
    ).distinct()
    out = out.join(hubs, ["CarrierCode", "FlightNumber", "DepartureStation", "ArrivalStation"], "left")
    return out.select(
        "DepartureDate", "CarrierCode", "FlightNumber", route_key("DepartureStation", "ArrivalStation").alias("Route"),
        sector("DepartureStation", "ArrivalStation").alias("Sector"), "DepartureStationName", "ArrivalStationName",
        pair_key("DepCountryCode", "ArrCountryCode").alias("CountryPair"),
        F.concat("DepCountryCode", "ArrCountryCode").alias("CountryOD"), "DepartureCountry", "ArrivalCountry",
        "International", "FlightDuration", "FeeCode", "SSRDesc", "Quantity", "Revenue", "RevenueMYR",
        F.coalesce("Hub", F.lit("hub")).alias("Hub"), "NoOfPax", "Capacity",
    )
