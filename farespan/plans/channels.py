"""Sales-channel reports: one family for the booking-date reports, one for the older ones."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farespan.functions import bands, fixed, labels, windows
from farespan.functions import timefn as tf
from farespan.functions.keys import home_currency, pair_key, route_key, sector
from farespan.functions.windows import Window
from farespan.operators import channels as ch
from farespan.operators import money as m
from farespan.operators import passengers as px
from farespan.sources.sinks import scoped, stage
from farespan.sources.tables import Tables
from farespan.sources.views import segment_view


@dataclass(frozen=True)
class ChannelSpec:
    """What makes one booking-date channel report differ from the next."""

    keys: tuple[str, ...]
    lead: str | None = None
    agencies: str | None = "organization"
    point_of_sale: bool = True
    any_leg: bool = False
    countries: tuple[str, ...] | None = None
    collapse: bool = False


_ORG = ("OrganizationCode", "OrganizationName", "OrganizationCountryCode", "Category", "SalesChannelGrouping")
_PLACE = ("DomInt", "CountryPair", "CountryPairGroup")
_COUNTRY = ("DepCountry", "ArrCountry", "POSCountry", "POSCurrency")

PREMIUM_FLEX = ChannelSpec(
    keys=(
        "BookingDate", "BookingYear", "BookingMonth", "BookingWeek", "CarrierCode", "MarketGroup", "PurchaseLeadDays",
        "SalesChannel", "CurrencyCode", *_ORG, *_PLACE, "PremFlex", *_COUNTRY,
    ),
    lead="list", agencies="sales_agency",
)
CHANNEL_DAILY = ChannelSpec(
    keys=(
        "BookingDate", "BookingYear", "BookingMonth", "BookingWkYr", "BookingWkMth", "CarrierCode", "MarketGroup", "Sector",
        "PurchaseLeadDays", "RoleCode", "SalesChannel", "CurrencyCode", *_ORG, *_PLACE, *_COUNTRY,
    ),
    lead="arith", collapse=True,
)
CHANNEL_MONTHLY = ChannelSpec(
    keys=(
        "BookingYear", "BookingMonth", "CarrierCode", "MarketGroup", "PurchaseLeadDays", "SalesChannel", "CurrencyCode",
        *_ORG, *_PLACE, *_COUNTRY,
    ),
    lead="list",
)
CHANNEL_BY_COUNTRY = ChannelSpec(
    keys=(
        "BookingYear", "BookingMonth", "BookingDate", "CarrierCode", "FlightNumber", "MarketGroup", "SalesChannel",
        "CurrencyCode", "CountryPair", "DepCountry", "ArrCountry",
    ),
    agencies=None, point_of_sale=False, any_leg=True, countries=fixed.COUNTRY_REPORT,
)


def _key_columns(spec: ChannelSpec) -> dict[str, Column]:
    """How each derived output key is computed; keys not listed are columns already."""
    table = {
        "BookingYear": F.year("BookingDate"),
        "BookingMonth": tf.month_name("BookingDate"),
        "BookingWeek": tf.us_week("BookingDate").cast("string"),
        "BookingWkYr": tf.week_label(tf.us_week("BookingDate")),
        "BookingWkMth": tf.week_label(tf.week_of_month("BookingDate")),
        "MarketGroup": route_key("DepartureStation", "ArrivalStation"),
        "Sector": sector("DepartureStation", "ArrivalStation"),
        "DomInt": labels.dom_int("International"),
        "CountryPair": F.concat("DepCountryCode", F.lit("-"), "ArrCountryCode"),
        "CountryPairGroup": pair_key("DepCountryCode", "ArrCountryCode", "-"),
        "PremFlex": labels.premium_flex("ProductClassCode", "FareClassOfService"),
    }
    if spec.lead:
        table["PurchaseLeadDays"] = bands.lead_bucket("BookingDate", "DepartureDate", spec.lead)
    return {k: e for k, e in table.items() if k in spec.keys}


@scoped
def channel_report(t: Tables, window: Window, spec: ChannelSpec) -> DataFrame:
    """Seats, fare and fuel in booking, MYR, home and point-of-sale currency."""
    booked = px.bookings(t, window, (2, 3))
    if spec.any_leg:
        legs = px.remap_carrier(t["inventory_leg"], t["carrier_mapping"])
    else:
        legs = px.live_legs(t, ferry=True)
    leg_columns = ("CarrierCode", "FlightNumber") if "FlightNumber" in spec.keys else ("CarrierCode",)
    held = stage(px.booked_segments(t, booked).drop("FareJourneyType"), "channel-segments")
    # Many agents move the rows, so they come before the rows are dealt by segment, as legs and charges want them.
    fact = ch.with_agent(held.withColumn("BookingDate", tf.day("BookingDate")), t, "inner")
    fact = px.flown(t, fact, legs, leg_columns, of=held)
    stations = {"DepartureStation": "DepCountryCode", "ArrivalStation": "ArrCountryCode"}
    for code, out in stations.items():
        fact = px.with_station(fact, t["station"], code, "inner", **{out: "CountryCode"})
    if spec.countries:
        wanted = list(spec.countries)
        fact = fact.where(F.col("DepCountryCode").isin(wanted) | F.col("ArrCountryCode").isin(wanted))
    fact = px.with_country(fact, t["country"], "DepCountryCode", "DepCountry", "inner")
    fact = px.with_country(fact, t["country"], "ArrCountryCode", "ArrCountry", "inner")

    kept = [
        "BookingID", "PassengerID", "SegmentID", "BookingDate", "DepartureDate", "DepartureStation", "ArrivalStation",
        "International", "RoleCode", "CarrierCode", "OrganizationCode", "LocationCode", "DepCountryCode", "ArrCountryCode",
        "DepCountry", "ArrCountry",
    ]
    kept += [c for c in ("FlightNumber", "ProductClassCode", "FareClassOfService") if c in fact.columns]
    charges = px.segment_sums(
        px.journey_charges(t, of=held, few=True),
        {"Fare": m.bucket(m.fare_types(), m.of_code("KLIA2")), "Fuel": m.bucket(m.fuel())}, by_day=False,
    )
    per_segment = fact.select(*kept).join(charges, ["PassengerID", "SegmentID"])
    if spec.collapse:
        # Only a later distinct can tell a repeated segment from one with the sum.
        per_segment = per_segment.groupBy(*kept, "CurrencyCode").agg(F.sum("Fare").alias("Fare"), F.sum("Fuel").alias("Fuel"))
    if spec.point_of_sale:
        sold_at = px.point_of_sale(t, held).drop("POSCountryCode" if not spec.collapse else "_none")
        per_segment = per_segment.join(sold_at, ["BookingID", "PassengerID"], "left")

    out = ch.sales_channel(per_segment, t)
    if spec.agencies:
        out = ch.channel_group(out, t)
        out = ch.with_organisation(out, t[spec.agencies])
    if spec.collapse:
        out = out.drop("SalesChannelRpt").distinct()
    out = out.withColumn("Home", home_currency("CarrierCode"))

    out = out.withColumns(_key_columns(spec))
    currencies = ["Home"] + (["POSCurrency"] if spec.point_of_sale else [])
    keys = list(spec.keys)
    rated = out
    for c in ["MYR", *currencies]:
        rated = m.with_rate(rated, t["fx_history"], c, "CurrencyCode", "BookingDate", f"_fx_{c}")

    measures = [F.countDistinct("SegmentID").alias("SeatSold")]
    for name in ("Fare", "Fuel"):
        measures.append(m.money(F.sum(name)).alias(f"{name}RevBookingCurrency"))
    targets = {"MYR": ("MYR", F.lit("MYR")), "Home": ("AOCCurrency", F.col("Home")), "POSCurrency": ("POSCurrency", F.col("POSCurrency"))}
    for c in ["MYR", *currencies]:
        label, target = targets[c]
        differs = F.col("CurrencyCode") != target
        for name in ("Fare", "Fuel"):
            value = F.when(differs, m.money(name) * m.inverse(f"_fx_{c}")).otherwise(m.money(name))
            measures.append(m.money(F.sum(value)).alias(f"{name}Rev{label}"))
    # Segments are nearly as many as the rows, so counting them would move every row twice, once by
    # keys and segment; dealt by the keys, a row moves once for both steps.
    return rated.repartition(*keys).groupBy(*keys).agg(*measures)


def premium_flex_monthly(t: Tables, now: datetime, window: Window | None = None) -> DataFrame:
    local = windows.to_local(now, windows.MALAYSIA)
    return channel_report(t, window or windows.previous_month(local), PREMIUM_FLEX).withColumnRenamed("BookingDate", "CapturedDate")


def premium_flex_weekly(t: Tables, now: datetime, window: Window | None = None, bounds: str | None = None) -> DataFrame:
    local = windows.to_local(now, windows.MALAYSIA)
    return channel_report(t, window or windows.trailing_week(local, bounds=bounds), PREMIUM_FLEX)


def channel_daily(t: Tables, now: datetime, window: Window | None = None) -> DataFrame:
    local = windows.to_local(now, windows.MALAYSIA)
    return channel_report(t, window or windows.yesterday_or_month_on_day_five(local), CHANNEL_DAILY)


def channel_daily_by_country(t: Tables, now: datetime, window: Window | None = None) -> DataFrame:
    return channel_report(t, window or windows.trailing_week(now), CHANNEL_BY_COUNTRY)


def channel_monthly(t: Tables, now: datetime, window: Window | None = None) -> DataFrame:
    return channel_report(t, window or windows.previous_month(now), CHANNEL_MONTHLY)


# ---------------------------------------------------------------- older reports

def _segments_of_known_carriers(t: Tables, mapped: bool, of: DataFrame) -> DataFrame:
    """Confirmed segments of the stored passengers, mapped carrier, of carriers in the carrier table.

    ``mapped`` tells whether the known carrier is tested after or before mapping.
    """
    segments = segment_view(t, of).where(F.col("BookingStatus") == "HK")
    known = t["carrier"].select("CarrierCode").distinct()
    if mapped:
        return px.remap_carrier(segments, t["carrier_mapping"]).join(known, "CarrierCode", "left_semi")
    return px.remap_carrier(segments.join(known, "CarrierCode", "left_semi"), t["carrier_mapping"])


def _booked_segments(t: Tables, window: Window, mapped: bool, columns: list[str], all_routes: bool = True) -> DataFrame:
    """Segments of bookings made in a window of Malaysian time.

    The window's passengers come first, and only their segments and legs are read.
    """
    booked = px.bookings(t, window, (2, 3), hours=8).select(
        "BookingID", "RecordLocator", "CurrencyCode", F.col("CreatedAgentID"),
        tf.plus_hours("BookingDate", 8).alias("BookedAt"),
    )
    people = stage(booked.join(t["booking_passenger"], "BookingID"), "booked-passengers")
    segments = _segments_of_known_carriers(t, mapped, people)
    if not all_routes:
        segments = segments.where(~sector("DepartureStation", "ArrivalStation").isin(list(fixed.CLOSED_ROUTES)))
    return people.join(segments.select("PassengerID", "SegmentID", *columns), "PassengerID")


def _base_fare(t: Tables, of: DataFrame, types: tuple[int, ...] | None = (0, 8, 1, 7, 5)) -> DataFrame:
    """Net fare of each of the stored segments: types 0 and 8 less 1 and 7."""
    charges = px.around(t["passenger_journey_charge"], of, "PassengerID", "SegmentID", few=True)
    if types:
        charges = charges.where(F.col("ChargeType").isin(list(types)))
    return charges.groupBy("PassengerID", "SegmentID").agg(F.sum(m.plus_minus()).alias("NetFare"))


def _priced(df: DataFrame, t: Tables, frm: str, amounts: list[str]) -> DataFrame:
    """Booking-currency amounts divided by the rate of the booking day, 1 without one."""
    return m.convert(df, t["fx_history"], amounts, home=frm, charged="CurrencyCode", on="BookingDate", mode="div_one", suffix="C")


def _seats(rows: DataFrame) -> DataFrame:
    """One row per passenger and segment, fares of its legs added up."""
    keys = [c for c in rows.columns if c not in ("NetFare", "NetFareC")]
    return rows.groupBy(*keys).agg(F.sum("NetFareC").alias("NetFareC"))


@scoped
def older_channel_daily(t: Tables, now: datetime, window: Window | None = None) -> DataFrame:
    """Seats and fare by booking day, route, lead, role, channel and class."""
    window = window or windows.yesterday(windows.to_local(now, windows.MALAYSIA))
    rows = _booked_segments(
        t, window, False,
        ["DepartureStation", "ArrivalStation", "DepartureDate", "JourneyNumber", "CarrierCode", "FareClassOfService"], all_routes=False,
    ).withColumn("BookingDate", tf.day("BookedAt"))
    rows = stage(rows, "older-daily-passengers")
    rows = rows.join(_base_fare(t, rows), ["PassengerID", "SegmentID"], "left")
    rows = _seats(_priced(rows, t, "MYR", ["NetFare"]))
    pairs = t["city_pair"].select(
        "DepartureStation", "ArrivalStation", labels.dom_int("InternationalFlag", "International", "Domestic").alias("DomInt")
    )
    markets = t["market_group"].select("DepartureStation", "ArrivalStation", "MarketGroup")
    ends = ["DepartureStation", "ArrivalStation"]
    rows = rows.join(pairs, ends, "left").join(markets, ends, "left")
    rows = rows.withColumn("_mg1", F.left("MarketGroup", F.lit(3))).withColumn("_mg2", F.right("MarketGroup", F.lit(3)))
    for code, out in (("DepartureStation", "_c1"), ("ArrivalStation", "_c2"), ("_mg1", "_c3"), ("_mg2", "_c4")):
        rows = px.with_station(rows, t["station"], code, **{out: "CountryCode"})
    rows = ch.with_agent(rows, t)
    rows = ch.sales_channel(rows, t, split_location=False, existing_only=True, unknown="UnknownRoleCode")
    rows = ch.channel_group(rows, t, leave_out=False)
    return rows.groupBy(
        F.year("BookingDate").alias("BookingYear"), tf.month_name("BookingDate").alias("BookingMonth"),
        tf.week_label(tf.us_week("BookingDate")).alias("BookingWkYr"),
        tf.week_label(tf.week_of_month("BookingDate")).alias("BookingWkMth"), "BookingDate",
        tf.month_name("DepartureDate").alias("DepartureMonth"), F.year("DepartureDate").alias("DepartureYear"),
        "CarrierCode", "MarketGroup", sector("DepartureStation", "ArrivalStation").alias("FlightPath"), "JourneyNumber",
        bands.lead_bucket("BookingDate", "DepartureDate", "list").alias("PurchaseLeadDays"), "RoleCode", "CurrencyCode",
        "SalesChannel", "Category", "SalesChannelGrouping", "DomInt", "FareClassOfService",
        F.concat("_c1", F.lit("-"), "_c2").alias("CountryPair"), pair_key("_c3", "_c4", "-").alias("CountryPairMktGrp"),
    ).agg(F.count("PassengerID").alias("SeatSold"), m.money(F.sum("NetFareC")).alias("BaseFare"))


@scoped
def older_channel_monthly(t: Tables, as_of: datetime, window: Window | None = None) -> DataFrame:
    """Seats and fare by booking day, route, lead, role and channel since last month."""
    window = window or windows.month_before_to_date(as_of)
    rows = _booked_segments(
        t, window, True, ["DepartureStation", "ArrivalStation", "DepartureDate", "JourneyNumber", "CarrierCode"], all_routes=False
    ).withColumn("BookingDate", tf.day("BookedAt"))
    rows = stage(rows, "older-monthly-passengers")
    rows = _seats(_priced(rows.join(_base_fare(t, rows, None), ["PassengerID", "SegmentID"], "left"), t, "MYR", ["NetFare"]))
    markets = t["market_group"].select("DepartureStation", "ArrivalStation", "MarketGroup")
    rows = rows.join(markets, ["DepartureStation", "ArrivalStation"], "left")
    rows = ch.sales_channel(ch.with_agent(rows, t), t, existing_only=True, by_channel=True)
    week = tf.week_label(tf.us_week("BookingDate"))
    return rows.groupBy(
        F.year("BookingDate").alias("BookingYear"), tf.month_name("BookingDate").alias("BookingMonth"),
        week.alias("BookingWkYr"), week.alias("BookingWkMth"), "BookingDate", "CarrierCode", "MarketGroup",
        sector("DepartureStation", "ArrivalStation").alias("FlightPath"), "JourneyNumber",
        bands.lead_bucket("BookingDate", "DepartureDate", "list").alias("PurchaseLeadDays"), "RoleCode", "CurrencyCode",
        "SalesChannel",
    ).agg(F.count("PassengerID").alias("SeatSold"), m.money(F.sum("NetFareC")).alias("BaseFare"))


def channel_dimensions(t: Tables) -> dict[str, DataFrame]:
    """The three dimension tables published with the monthly channel report."""
    return {
        "city_pair": t["city_pair"].select("DepartureStation", "ArrivalStation", labels.dom_int("InternationalFlag").alias("DomInt")),
        "station": t["station"].select("StationCode", "CountryCode"),
        "country": t["country"].select("CountryCode", "Name"),
    }


@scoped
def booking_date_analysis(t: Tables, now: datetime, window: Window | None = None) -> DataFrame:
    """Guests, fare, extras and airport tax of one booking day by some 25 attributes."""
    local = windows.to_local(now, windows.MALAYSIA)
    window = window or windows.yesterday(local)
    rows = _booked_segments(
        t, window, False,
        ["InventoryLegID", "DepartureStation", "ArrivalStation", "DepartureDate", "JourneyNumber", "CarrierCode", "FareClassOfService"],
    )
    rows = rows.select(
        "BookingID", "PassengerID", "SegmentID", "InventoryLegID", "JourneyNumber", "CarrierCode", "CreatedAgentID",
        "CurrencyCode", tf.day("BookedAt").alias("BookingDate"), tf.day("DepartureDate").alias("DepartureDate"),
        "DepartureStation", "ArrivalStation", sector("DepartureStation", "ArrivalStation").alias("Route"),
        (F.lit(now.year) - F.year("DOB")).alias("Age"), "Nationality", labels.gender("Gender").alias("Gender"),
        labels.cabin("FareClassOfService", fixed.PREMIUM).alias("Cabin"),
    )
    provinces = t["booking_contact"].select("BookingID", "ProvinceState").distinct()
    rows = stage(rows.join(provinces, "BookingID", "left"), "analysis-passengers")

    extras = px.fee_lines(t, rows).withColumn("Signed", m.signed_by_list()).select("PassengerID", "FeeLegID", "Signed")
    extras = px.passenger_fees(rows, extras, first_segment=False, tied=F.col("FeeLegID") > 0)
    rated = m.with_rate(extras, t["fx_history"], "MYR", "CurrencyCode", "BookingDate", "_fx").where(F.col("_fx").isNotNull())
    value = m.money("Signed") / F.col("_fx")
    extras = rated.groupBy("PassengerID", "SegmentID").agg(
        F.sum(F.when(~F.col("Loose"), value)).alias("Extra1"), F.sum(F.when(F.col("Loose"), value)).alias("Extra2")
    )
    extras = stage(extras, "analysis-extras")  # what fees moved is gone before the charges are
    charges = px.around(t["passenger_journey_charge"], rows, "PassengerID", "SegmentID", few=True)
    fare, airport = F.col("ChargeType").isin(0, 8, 1, 7, 5), m.of_type(4, 5)
    charges = charges.where(fare | airport).groupBy("PassengerID", "SegmentID").agg(
        F.sum(F.when(fare, m.plus_minus())).alias("NetFare"), F.sum(F.when(airport, m.signed_by_list())).alias("AirportTax")
    )
    keys = ["PassengerID", "SegmentID"]
    out = rows.where(~F.col("Route").isin(list(fixed.CLOSED_ROUTES)))
    out = out.join(charges, keys, "left").join(extras, keys, "left")
    out = _priced(out, t, "MYR", ["NetFare", "AirportTax"])
    out = out.join(px.first_payment(t["payment"], rows), "BookingID", "left")
    # Hardly two rows share all of the report's keys, so they move before the labels make them wide.
    out = out.drop("BookingID", "SegmentID", "InventoryLegID", "JourneyNumber", "NetFare", "AirportTax")
    out = out.repartition("BookingDate", "DepartureStation", "ArrivalStation", "CarrierCode", "Nationality", "CurrencyCode")
    out = ch.with_agent(out, t, distinct=True)
    out = ch.sales_channel(out, t, split_location=False, existing_only=True, unknown="UnknownRoleCode")
    ends = ["DepartureStation", "ArrivalStation"]
    out = out.join(t["market_group"].select(*ends, "MarketGroup"), ends, "left")
    out = out.join(t["market_group_dmk"].select(*ends, F.col("MarketGroup").alias("MarketGroup2")), ends, "left")
    out = out.join(t["city_pair"].select(*ends, "InternationalFlag"), ends, "left")
    out = px.with_station(out, t["station"], "DepartureStation", "inner", _dep="CountryCode")
    out = px.with_country(out, t["country"], "_dep", "DepartingCountry", "inner")
    out = px.with_country(out, t["country"], "Nationality", "_nat")
    out = px.with_country(out.withColumn("_cur", F.left("CurrencyCode", F.lit(2))), t["country"], "_cur", "PaymentCountry")
    return out.groupBy(
        tf.month_name("DepartureDate").alias("DepartureMonth"), F.year("DepartureDate").cast("string").alias("DepartureYear"),
        "BookingDate", tf.month_name("BookingDate").alias("BookingMonth"), F.year("BookingDate").cast("string").alias("BookingYear"),
        tf.weekday_name("BookingDate").alias("DayOfWeek"), tf.week_label(tf.us_week("BookingDate")).alias("WeekNum"),
        bands.lead_bucket("BookingDate", "DepartureDate", "to400").alias("PurchaseLeadDaysBand"),
        bands.age_band("Age", "analysis").alias("AgeBand"), bands.age_band("Age", "decades").alias("AgeBandJack"), "Gender",
        labels.dom_int("InternationalFlag").alias("Flight"), "CarrierCode", "DepartureStation", "ArrivalStation", "Route",
        "DepartingCountry", "MarketGroup", "MarketGroup2", "Cabin", "ProvinceState", "SalesChannel",
        labels.payment_group("PaymentMethodCode").alias("PaymentMethod"), "Nationality",
        labels.clean_nationality("_nat").alias("NationalityFinal"), "PaymentCountry", "CurrencyCode",
    ).agg(
        F.count("PassengerID").alias("Guests"), m.money(F.sum("NetFareC")).alias("BaseFare"),
        m.money(F.sum("Extra1") + F.sum("Extra2")).alias("SSR"), m.money(F.sum("AirportTaxC")).alias("AirportTax"),
    )


@scoped
def china_market(t: Tables, as_of: datetime, now: datetime, window: Window | None = None) -> DataFrame:
    """Seats, bookings and CNY fare of Chinese, Hong Kong and Macau passengers."""
    window = window or windows.five_months_back(as_of)
    rows = _booked_segments(
        t, window, False, ["DepartureStation", "ArrivalStation", "DepartureDate", "JourneyNumber", "CarrierCode"]
    ).where(F.col("Nationality").isin(list(fixed.CHINA_NATIONALITIES)))
    rows = rows.withColumn("BookingDate", tf.day("BookedAt")).withColumn("Age", F.lit(now.year) - F.year("DOB"))
    rows = px.with_contact(rows, t)
    ends = ["DepartureStation", "ArrivalStation"]
    rows = rows.join(t["market_group"].select(*ends), ends, "left").join(t["city_pair"].select(*ends, "InternationalFlag"), ends, "left")
    rows = ch.with_agent(rows, t, distinct=True)
    rows = ch.sales_channel(rows, t, split_location=False, existing_only=True, unknown="UnknownRoleCode")
    rows = px.with_country(rows, t["country"], "Nationality", "NationalityName")
    rows = stage(rows, "china-passengers")
    rows = _priced(rows.join(_base_fare(t, rows), ["PassengerID", "SegmentID"], "left"), t, "CNY", ["NetFare"])
    seat = ["PassengerID", "SegmentID", "RecordLocator", "BookingDate", "DepartureDate", "JourneyNumber", "CreatedAgentID", "CurrencyCode"]
    rows = rows.select(
        *seat, "NetFareC",
        tf.month_name("BookedAt").alias("BookingMonth"), F.year("BookedAt").alias("BookingYear"), "DepartureStation", "ArrivalStation",
        sector("DepartureStation", "ArrivalStation").alias("Route"), "CarrierCode", labels.gender("Gender").alias("Gender"),
        F.col("NationalityName").alias("Nationality"), "ProvinceState", "City", "EmailAddress", "FirstName", "LastName",
        labels.dom_int("InternationalFlag").alias("DomInt"), bands.age_band("Age", "china").alias("AgeGroup"),
        bands.lead_bucket("BookingDate", "DepartureDate", "coarse").alias("PurchaseLeadDays"), "SalesChannel",
    )
    # A segment reached through two contacts or roles with the same labels is one seat.
    keys = [c for c in rows.columns if c not in (*seat, "NetFareC")]
    return _seats(rows).groupBy(*keys).agg(
        F.count("PassengerID").alias("TotalSeatSold"), F.countDistinct("RecordLocator").alias("TotalBooking"),
        m.money(F.sum("NetFareC")).alias("TotalBaseFareCNY"),
    )


def china_months(report: DataFrame) -> DataFrame:
    """Month list published with the China market report."""
    year = F.col("BookingYear").cast("string")
    return report.select(year.alias("BookingYear"), "BookingMonth", F.concat("BookingMonth", year).alias("BookingMthYr")).distinct()
