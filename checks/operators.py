"""Single operators as queries over the driver's tables, with their DuckDB SQL.

Every query runs over whole tables; results are counts and exact sums per label, so
they stay small while every input row takes part.
"""

from __future__ import annotations

from datetime import date, datetime, time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import sqlkit as k
from checks.reports import NOW, WHOLE, tables
from checks.report_sql import ASK_CTES, LIST_SIGN
from checks.sqlkit import CHARGES, FEES, FX, I, LEGS, M, PAX, SEGVIEW, day, days, inlist, with_standins
from farespan.functions import bands, fixed, keys, labels, windows
from farespan.functions import timefn as tf
from farespan.operators import capacity as cap
from farespan.operators import channels as ch
from farespan.operators import journeys as jn
from farespan.operators import money as m
from farespan.operators import passengers as px
from farespan.sources.tables import Tables, as_of
from farespan.sources.views import fee_view, segment_view

QUERIES: dict = {}
SQL: dict[str, str] = {}


def operator(sql: str | None):
    """Register a plan over the airline tables with the SQL it is compared with."""

    def register(plan):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plan(tables(spark, sf_dir))

        QUERIES[plan.__name__] = run
        if sql is not None:
            SQL[plan.__name__] = with_standins(sql)
        return plan

    return register


def raw_operator(sql: str):
    """Register a plan that reads driver tables directly."""

    def register(plan):
        QUERIES[plan.__name__] = plan
        SQL[plan.__name__] = sql
        return plan

    return register


def _count(df: DataFrame, *by) -> DataFrame:
    return df.groupBy(*by).agg(F.count("*").alias("n"))


# ---------------------------------------------------------------- carriers, keys, bands

@operator(f"WITH {LEGS} SELECT CarrierCode AS Own, Carrier AS CarrierCode, COUNT(*) AS n, {I('SUM(Capacity)')} AS seats FROM legs GROUP BY 1, 2")
def carrier_remap(t: Tables) -> DataFrame:
    legs = px.remap_carrier(t["inventory_leg"].withColumn("Own", F.col("CarrierCode")), t["carrier_mapping"])
    return legs.groupBy("Own", "CarrierCode").agg(F.count("*").alias("n"), F.sum("Capacity").alias("seats"))


@operator(f"""SELECT CarrierCode, {k.home('CarrierCode')} AS Home,
  CASE CarrierCode {' '.join(f"WHEN '{a}' THEN '{b}'" for a, b in fixed.HOME_CURRENCY_STRICT.items())} END AS HomeStrict, COUNT(*) AS n FROM t_inventory_leg GROUP BY ALL""")
def home_currency(t: Tables) -> DataFrame:
    return _count(t["inventory_leg"], "CarrierCode", keys.home_currency("CarrierCode").alias("Home"), keys.home_currency_strict("CarrierCode").alias("HomeStrict"))


@operator(f"""SELECT {k.pair('DepartureStation', 'ArrivalStation')} AS Route, DepartureStation || ArrivalStation AS Sector,
  CASE DepartureStation || ArrivalStation WHEN 'KULSTN' THEN 'KULLGW' WHEN 'STNKUL' THEN 'LGWKUL' WHEN 'TSNKUL' THEN 'PEKKUL' WHEN 'KULTSN' THEN 'KULPEK' ELSE DepartureStation || ArrivalStation END AS Aliased,
  CASE DepartureStation WHEN 'MES' THEN 'KNO' ELSE DepartureStation END AS Station, COUNT(*) AS n FROM t_passenger_journey_segment GROUP BY ALL""")
def route_key(t: Tables) -> DataFrame:
    s = keys.sector("DepartureStation", "ArrivalStation")
    return _count(
        t["passenger_journey_segment"], keys.route_key("DepartureStation", "ArrivalStation").alias("Route"), s.alias("Sector"),
        keys.alias_route(s).alias("Aliased"), keys.alias_station("DepartureStation").alias("Station"),
    )


@operator(f"""SELECT {k.pair('d.CountryCode', 'a.CountryCode', '-')} AS CountryPairGroup, {k.pair('d.CountryCode', 'a.CountryCode')} AS CountryPair, COUNT(*) AS n
FROM t_passenger_journey_segment s LEFT JOIN t_station d ON d.StationCode = s.DepartureStation LEFT JOIN t_station a ON a.StationCode = s.ArrivalStation GROUP BY ALL""")
def country_pair(t: Tables) -> DataFrame:
    df = px.with_station(t["passenger_journey_segment"], t["station"], "DepartureStation", dc="CountryCode")
    df = px.with_station(df, t["station"], "ArrivalStation", ac="CountryCode")
    return _count(df, keys.pair_key("dc", "ac", "-").alias("CountryPairGroup"), keys.pair_key("dc", "ac").alias("CountryPair"))


def _leads(t: Tables, kind: str) -> DataFrame:
    booked = t["booking"].join(t["booking_passenger"].select("BookingID", "PassengerID"), "BookingID")
    df = booked.join(t["passenger_journey_segment"].select("PassengerID", "DepartureDate"), "PassengerID")
    return _count(df, bands.lead_bucket("BookingDate", "DepartureDate", kind).alias("band"))


def _lead_sql(case: str) -> str:
    return f"""SELECT {case} AS band, COUNT(*) AS n FROM (SELECT {days('b.BookingDate', 's.DepartureDate')} AS n0 FROM t_booking b
  JOIN t_booking_passenger p ON p.BookingID = b.BookingID JOIN t_passenger_journey_segment s ON s.PassengerID = p.PassengerID) GROUP BY 1"""


@operator(_lead_sql(k.lead_list("n0")))
def lead_list(t: Tables) -> DataFrame:
    return _leads(t, "list")


@operator(_lead_sql(k.lead_arith("n0")))
def lead_arith(t: Tables) -> DataFrame:
    return _leads(t, "arith")


@operator(_lead_sql(k.lead_to400("n0")))
def lead_to400(t: Tables) -> DataFrame:
    return _leads(t, "to400")


@operator(_lead_sql(k.lead_coarse("n0")))
def lead_coarse(t: Tables) -> DataFrame:
    return _leads(t, "coarse")


_AGE = "(2000 - year(DOB))"


@operator(f"""SELECT {k.age_band(_AGE, k.AGE_ANALYSIS)} AS analysis, {k.age_band(_AGE, k.AGE_DECADES, 'Unknown')} AS decades, {k.age_band(_AGE, k.AGE_CHINA, 'Unknown')} AS china,
  {k.age_band(_AGE, k.AGE_FLY, 'Unknown')} AS fly_thru, {k.age_band(_AGE, k.AGE_JOURNEY)} AS journey, COUNT(*) AS n FROM t_booking_passenger GROUP BY ALL""")
def age_bands(t: Tables) -> DataFrame:
    age = F.lit(2000) - F.year("DOB")
    return _count(t["booking_passenger"], *[bands.age_band(age, b).alias(b) for b in ("analysis", "decades", "china", "fly_thru", "journey")])


@operator(f"""SELECT {k.transit('h')} AS band, h AS hours, COUNT(*) AS n FROM (SELECT CAST({k.hours('b.BookingDate', 's.DepartureDate')} AS INT) AS h FROM t_booking b
  JOIN t_booking_passenger p ON p.BookingID = b.BookingID JOIN t_passenger_journey_segment s ON s.PassengerID = p.PassengerID) GROUP BY ALL""")
def transit_bands(t: Tables) -> DataFrame:
    booked = t["booking"].join(t["booking_passenger"].select("BookingID", "PassengerID"), "BookingID")
    df = booked.join(t["passenger_journey_segment"].select("PassengerID", "DepartureDate"), "PassengerID")
    df = df.withColumn("hours", tf.hours_between("BookingDate", "DepartureDate"))
    return _count(df, bands.transit_band("hours").alias("band"), "hours")


@operator(f"""SELECT CAST(year(l_shipdate) AS INT) AS y, {k.us_week('l_shipdate')} AS week, CAST({k.week_of_month('l_shipdate')} AS INT) AS month_week, dayname(l_shipdate) AS weekday,
  monthname(l_shipdate) AS month_name, strftime(l_shipdate, '%b-%y') AS month_label, COUNT(*) AS n FROM lineitem GROUP BY ALL""")
def calendar_labels(t: Tables) -> DataFrame:
    d = "DepartureDate"
    return _count(
        t["passenger_journey_segment"], F.year(d).alias("y"), tf.us_week(d).alias("week"), tf.week_of_month(d).alias("month_week"),
        tf.weekday_name(d).alias("weekday"), tf.month_name(d).alias("month_name"), tf.month_label(d).alias("month_label"),
    )


@operator(f"""WITH s AS (SELECT BookingDate AS a, BookingDate + INTERVAL '90' MINUTE AS b FROM t_booking)
SELECT CAST({days('a', 'b')} AS INT) AS d, CAST({k.hours('a', 'b')} AS INT) AS h, CAST({k.hours('a', 'b')} * 60 + minute(b) - minute(a) AS INT) AS mi, CAST(year(b) - year(a) AS INT) AS y,
  COUNT(*) AS n FROM s GROUP BY ALL""")
def boundary_counts(t: Tables) -> DataFrame:
    df = t["booking"].withColumn("b", F.col("BookingDate") + F.expr("INTERVAL '90' MINUTE"))
    a = "BookingDate"
    return _count(
        df, tf.days_between(a, "b").alias("d"), tf.hours_between(a, "b").alias("h"), tf.minutes_between(a, "b").alias("mi"),
        tf.years_between(a, "b").alias("y"),
    )


# ---------------------------------------------------------------- charges and currency

_TAX = inlist(fixed.TAX_CODES)


@operator(f"""WITH {CHARGES}
SELECT CurrencyCode, {M('SUM(CASE WHEN ChargeType IN (0,1,7,19) THEN amt ELSE 0 END)')} AS fare, {M("SUM(CASE WHEN ChargeCode IN ('FUEL','FUEX','DOMS') THEN amt ELSE 0 END)")} AS fuel,
  {M('SUM(CASE WHEN ChargeType IN (0,1,7,19) THEN amt ELSE 0 END) + SUM(CASE WHEN ChargeCode IN ' + inlist(fixed.SURCHARGE_CODES) + ' THEN amt ELSE 0 END)')} AS fare_surcharge,
  {M(f'SUM(CASE WHEN ChargeCode IN {_TAX} THEN amt ELSE 0 END)')} AS tax, {M('SUM(CASE WHEN anc OR ChargeType = 8 THEN amt ELSE 0 END)')} AS ancillary,
  {M("SUM(CASE WHEN ChargeCode = 'NONE' THEN amt END)")} AS absent,
  {M('SUM(CASE WHEN ChargeCode NOT IN ' + inlist(fixed.NOT_OTHER_CODES) + ' AND NOT anc AND ChargeType NOT IN (0,1,7,19) THEN amt ELSE 0 END)')} AS other
FROM chg GROUP BY 1""")
def charge_buckets(t: Tables) -> DataFrame:
    rows = m.with_ancillary(px.journey_charges(t), t["ancillary_fee_codes"])
    return rows.groupBy("CurrencyCode").agg(
        m.money(m.bucket(m.fare_types())).alias("fare"), m.money(m.bucket(m.fuel())).alias("fuel"),
        m.money(m.bucket(m.fare_types(), m.of_code(*fixed.SURCHARGE_CODES))).alias("fare_surcharge"),
        m.money(m.bucket(m.of_code(*fixed.TAX_CODES))).alias("tax"), m.money(m.bucket(m.ancillary())).alias("ancillary"),
        m.money(m.bucket_or_null(m.of_code("NONE"))).alias("absent"), m.money(m.bucket(m.other())).alias("other"),
    )


@operator(f"""SELECT ChargeType, {M('SUM(' + LIST_SIGN + ')')} AS by_list, {M('SUM(ChargeAmount * x.PositiveNegativeFlag)')} AS by_matrix,
  {M('SUM(CASE WHEN ChargeType IN (0, 8) THEN ChargeAmount WHEN ChargeType IN (1, 7) THEN -ChargeAmount END)')} AS plus_minus
FROM t_passenger_journey_charge JOIN t_charge_type_matrix x ON x.ChargeTypeID = ChargeType GROUP BY 1""")
def charge_sign(t: Tables) -> DataFrame:
    return px.journey_charges(t).groupBy("ChargeType").agg(
        m.money(F.sum(m.signed_by_list())).alias("by_list"), m.money(F.sum("Amount")).alias("by_matrix"),
        m.money(F.sum(m.plus_minus())).alias("plus_minus"),
    )


def _fanout_sql(joined: bool) -> str:
    src = "t_passenger_journey_charge c"
    amt = LIST_SIGN.replace("Charge", "c.Charge")
    if joined:
        ctes = ", ".join(f"r{n} AS (SELECT PassengerID, SegmentID, {amt} AS v FROM {src} WHERE c.ChargeType = {n})" for n in (0, 1, 7))
        ctes += f", q AS (SELECT PassengerID, SegmentID, SUM({amt}) AS v FROM {src} WHERE c.ChargeCode IN ('FUEL','DOMS','FUEX') GROUP BY 1, 2)"
        joins = " ".join(f"LEFT JOIN {x} ON {x}.PassengerID = s.PassengerID AND {x}.SegmentID = s.SegmentID" for x in ("r0", "r1", "r7", "q"))
        fare, fuel = "coalesce(r0.v, 0) + coalesce(r1.v, 0) + coalesce(r7.v, 0)", "coalesce(q.v, 0)"
    else:
        ctes = f"q AS (SELECT PassengerID, SegmentID, SUM(CASE WHEN ChargeType IN (0, 1, 7) THEN {amt} END) AS fare, SUM(CASE WHEN ChargeCode IN ('FUEL','DOMS','FUEX') THEN {amt} END) AS fuel FROM {src} GROUP BY 1, 2)"
        joins, fare, fuel = "LEFT JOIN q ON q.PassengerID = s.PassengerID AND q.SegmentID = s.SegmentID", "coalesce(q.fare, 0)", "coalesce(q.fuel, 0)"
    return f"WITH {ctes} SELECT s.CurrencyCode, {M(f'SUM({fare})')} AS fare, {M(f'SUM({fuel})')} AS fuel FROM t_passenger_journey_segment s {joins} GROUP BY 1"


def _fanout(t: Tables, how: str) -> DataFrame:
    parts = [m.of_type(0), m.of_type(1), m.of_type(7)]
    totals = m.segment_charges(t["passenger_journey_charge"], {"fare": parts}, {"fuel": m.fuel()}, fanout=how)
    rows = t["passenger_journey_segment"].join(totals, ["PassengerID", "SegmentID"], "left")
    return m.zero_filled(rows, ["fare", "fuel"]).groupBy("CurrencyCode").agg(m.money(F.sum("fare")).alias("fare"), m.money(F.sum("fuel")).alias("fuel"))


@operator(_fanout_sql(True))
def charge_fanout_reference(t: Tables) -> DataFrame:
    return _fanout(t, "reference")


@operator(_fanout_sql(False))
def charge_fanout_safe(t: Tables) -> DataFrame:
    return _fanout(t, "safe")


def _fx_sql(home: str, direction: str, value: str, ccy: str = "c.CurrencyCode", on: str = day("c.CreatedDate"), frm: str = "", label: str = "") -> str:
    join = k.fx_join("x", home, ccy, on) if direction == "from" else k.fx_join("x", ccy, home, on)
    return f"""WITH {LEGS}, {FX}, {SEGVIEW}, c0 AS (SELECT c.PassengerID, c.SegmentID, c.CurrencyCode, c.CreatedDate, c.ChargeAmount AS v, s.Carrier, b.BookingDate, b.CurrencyCode AS bccy
  FROM t_passenger_journey_charge c JOIN seg s ON s.PassengerID = c.PassengerID AND s.SegmentID = c.SegmentID
  JOIN t_booking_passenger p ON p.PassengerID = c.PassengerID JOIN t_booking b ON b.BookingID = p.BookingID)
SELECT c.Carrier AS CarrierCode, {ccy} AS CurrencyCode, {M(f'SUM({value})')} AS converted, {I(f'COUNT({value})')} AS n FROM c0 c {join} GROUP BY 1, 2"""


def _fx(t: Tables, mode: str, home: str, charged: str = "CurrencyCode", on: str = "CreatedDate") -> DataFrame:
    seg = px.remap_carrier(segment_view(t), t["carrier_mapping"]).select("PassengerID", "SegmentID", "CarrierCode")
    charge = t["passenger_journey_charge"].select("PassengerID", "SegmentID", "CurrencyCode", "CreatedDate", "ChargeAmount")
    people = t["booking_passenger"].select("PassengerID", "BookingID")
    booking = t["booking"].select("BookingID", "BookingDate", F.col("CurrencyCode").alias("BookingCurrency"))
    # Charges come last: they are by far the most rows and move once, by passenger, where segments then lie.
    held = seg.join(people.join(booking, "BookingID"), "PassengerID")
    rows = charge.join(held, ["PassengerID", "SegmentID"])
    rows = rows.withColumn("Home", keys.home_currency("CarrierCode")).withColumn("On", tf.day(on))
    out = m.convert(rows, t["fx_history"], ["ChargeAmount"], home=home, charged=charged, on="On", mode=mode, suffix="C")
    return out.groupBy("CarrierCode", F.col(charged).alias("CurrencyCode")).agg(
        m.money(F.sum("ChargeAmountC")).alias("converted"), F.count("ChargeAmountC").alias("n")
    )


@operator(_fx_sql(k.home("c.Carrier"), "from", f"CASE WHEN c.CurrencyCode = {k.home('c.Carrier')} THEN c.v ELSE c.v * x.inv END"))
def fx_local(t: Tables) -> DataFrame:
    return _fx(t, "local", "Home")


@operator(_fx_sql("'MYR'", "from", "CASE WHEN c.CurrencyCode = 'MYR' THEN c.v ELSE c.v * x.inv END"))
def fx_myr(t: Tables) -> DataFrame:
    return _fx(t, "myr", "MYR")


@operator(_fx_sql(k.home("c.Carrier"), "from", f"CASE WHEN c.CurrencyCode <> {k.home('c.Carrier')} THEN c.v * x.inv ELSE c.v END", on=day("c.BookingDate")))
def fx_booking_date(t: Tables) -> DataFrame:
    return _fx(t, "booking_date", "Home", on="BookingDate")


@operator(_fx_sql("'MYR'", "from", "c.v * coalesce(x.inv, 1)", ccy="c.bccy", on=day("c.BookingDate")))
def fx_div_one(t: Tables) -> DataFrame:
    return _fx(t, "div_one", "MYR", "BookingCurrency", "BookingDate")


@operator(_fx_sql("'MYR'", "from", "c.v * x.inv"))
def fx_div_null(t: Tables) -> DataFrame:
    return _fx(t, "div_null", "MYR")


@operator(_fx_sql("'MYR'", "to", "c.v * coalesce(x.rate, 1)", ccy="c.bccy"))
def fx_mul_one(t: Tables) -> DataFrame:
    return _fx(t, "mul_one", "MYR", "BookingCurrency")


_TARGETS = ("MYR", "IDR", "THB", "USD")


@operator(f"""WITH {FX} SELECT c.CurrencyCode, {', '.join(f"{M(f'SUM(c.ChargeAmount * coalesce(x{c}.inv, 1))')} AS in_{c}" for c in _TARGETS)}
FROM t_passenger_journey_charge c {' '.join(k.fx_join(f'x{c}', f"'{c}'", 'c.CurrencyCode', day('c.CreatedDate')) for c in _TARGETS)} GROUP BY 1""")
def fx_many(t: Tables) -> DataFrame:
    rows = t["passenger_journey_charge"].groupBy("CurrencyCode", tf.day("CreatedDate").alias("On")).agg(F.sum("ChargeAmount").alias("v"))
    rows = m.with_rates(rows, t["fx_history"], _TARGETS, "CurrencyCode", "On")
    return rows.groupBy("CurrencyCode").agg(*[m.money(F.sum(m.money("v") / m.or_one(rows, f"Rate_{c}"))).alias(f"in_{c}") for c in _TARGETS])


# ---------------------------------------------------------------- passengers and fees

@operator(f"WITH {LEGS}, {PAX} SELECT Carrier AS CarrierCode, Status, International, COUNT(*) AS n, COUNT(DISTINCT SegmentID) AS segments FROM pax WHERE OwnCarrier <> 'BF' AND LegStatus <> 2 AND Lid > 0 AND Status IN (2, 3) GROUP BY ALL")
def passenger_fact(t: Tables) -> DataFrame:
    fact = px.passenger_fact(t, px.bookings(t, WHOLE, (2, 3)), px.live_legs(t))
    return fact.groupBy("CarrierCode", "Status", "International").agg(F.count("*").alias("n"), F.countDistinct("SegmentID").alias("segments"))


@operator(f"""WITH {LEGS}, {PAX}, {FEES} SELECT p.Carrier AS CarrierCode, f.FeeCode, f.ChargeType, COUNT(*) AS n, {M('SUM(f.ChargeAmount)')} AS amount
FROM pax p JOIN fees f ON f.PassengerID = p.PassengerID AND f.FeeLeg = p.InventoryLegID AND f.FeeLeg <> 0 GROUP BY ALL""")
def leg_fees(t: Tables) -> DataFrame:
    fact = px.passenger_fact(t, px.bookings(t, None, None), px.remap_carrier(t["inventory_leg"], t["carrier_mapping"]))
    rows = px.passenger_fees(fact, px.fee_lines(t)).where(~F.col("Loose"))
    return rows.groupBy("CarrierCode", "FeeCode", "ChargeType").agg(F.count("*").alias("n"), m.money(F.sum("ChargeAmount")).alias("amount"))


@operator(f"""WITH {LEGS}, {PAX}, {FEES} SELECT p.Carrier AS CarrierCode, f.FeeCode, f.ChargeType, COUNT(*) AS n, {M('SUM(f.ChargeAmount)')} AS amount
FROM pax p JOIN fees f ON f.PassengerID = p.PassengerID AND f.FeeLeg = 0 AND p.JourneyNumber = 1 AND p.SegmentNumber = 1 GROUP BY ALL""")
def booking_fees(t: Tables) -> DataFrame:
    fact = px.passenger_fact(t, px.bookings(t, None, None), px.remap_carrier(t["inventory_leg"], t["carrier_mapping"]))
    rows = px.passenger_fees(fact, px.fee_lines(t)).where("Loose")
    return rows.groupBy("CarrierCode", "FeeCode", "ChargeType").agg(F.count("*").alias("n"), m.money(F.sum("ChargeAmount")).alias("amount"))


@operator(f"""WITH q AS (SELECT c.PassengerID, CASE WHEN c.ChargeType = 8 THEN 'ConnectingFee' ELSE c.ChargeCode END AS FeeCode, c.ChargeAmount FROM t_passenger_journey_charge c
  WHERE c.ChargeType = 8 OR c.ChargeCode IN (SELECT Code FROM t_ancillary_fee_codes)) SELECT FeeCode, COUNT(*) AS n, {M('SUM(ChargeAmount)')} AS amount FROM q GROUP BY 1""")
def journey_fees(t: Tables) -> DataFrame:
    rows = m.with_ancillary(t["passenger_journey_charge"], t["ancillary_fee_codes"]).where(m.ancillary())
    code = F.when(F.col("ChargeType") == 8, "ConnectingFee").otherwise(F.col("ChargeCode")).alias("FeeCode")
    return rows.groupBy(code).agg(F.count("*").alias("n"), m.money(F.sum("ChargeAmount")).alias("amount"))


@operator("""SELECT c.CountryCode AS POSCountryCode, c.Name AS POSCountry, c.DefaultCurrencyCode AS POSCurrency, COUNT(*) AS n FROM t_booking b
JOIN t_booking_passenger p ON p.BookingID = b.BookingID JOIN t_passenger_journey_segment s ON s.PassengerID = p.PassengerID AND s.JourneyNumber = 1 AND s.SegmentNumber = 1
JOIN t_station st ON st.StationCode = s.DepartureStation JOIN t_country c ON c.CountryCode = st.CountryCode WHERE b.Status IN (2, 3) GROUP BY ALL""")
def point_of_sale(t: Tables) -> DataFrame:
    return _count(px.point_of_sale(t, px.booked_segments(t, px.bookings(t, None, (2, 3)))), "POSCountryCode", "POSCountry", "POSCurrency")


@operator(f"""SELECT ar.RoleCode, {k.channel('sc.SalesChannelRpt', 'ag.OrganizationCode', 'ag.LocationCode', None)} AS SalesChannel, g.Category, g.Grouping AS SalesChannelGrouping, COUNT(*) AS n
FROM t_booking b LEFT JOIN t_agent_role ar ON ar.AgentID = b.CreatedAgentID LEFT JOIN t_agent ag ON ag.AgentID = b.CreatedAgentID LEFT JOIN t_sales_channel sc ON sc.RoleCode = ar.RoleCode
LEFT JOIN t_sales_channel_group g ON g.ChannelBreakdown = sc.SalesChannelRpt AND g.ChannelBreakdown || g.Category <> 'OthersThird Party' GROUP BY ALL""")
def sales_channel(t: Tables) -> DataFrame:
    rows = ch.channel_group(ch.sales_channel(ch.with_agent(t["booking"], t), t), t)
    return _count(rows, "RoleCode", "SalesChannel", "Category", "SalesChannelGrouping")


@operator(f"""SELECT {k.channel('sc.SalesChannelRpt', 'ag.OrganizationCode', None, 'UnknownRoleCode')} AS SalesChannel, g.Category, COUNT(*) AS n
FROM t_booking b LEFT JOIN t_agent_role ar ON ar.AgentID = b.CreatedAgentID LEFT JOIN t_agent ag ON ag.AgentID = b.CreatedAgentID
LEFT JOIN (SELECT DISTINCT RoleCode, SalesChannelRpt FROM t_sales_channel WHERE Status = 'EXIST') sc ON sc.RoleCode = ar.RoleCode LEFT JOIN t_sales_channel_group g ON g.ChannelBreakdown = sc.SalesChannelRpt GROUP BY ALL""")
def sales_channel_existing(t: Tables) -> DataFrame:
    rows = ch.sales_channel(ch.with_agent(t["booking"], t, distinct=True), t, split_location=False, existing_only=True, unknown="UnknownRoleCode")
    return _count(ch.channel_group(rows, t, leave_out=False), "SalesChannel", "Category")


@operator(f"""SELECT {k.payment('p.PaymentMethodCode')} AS PaymentMethod, COUNT(*) AS n FROM t_booking b
LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY ReferenceID ORDER BY PaymentID) AS rn FROM t_payment) p ON p.ReferenceID = b.BookingID AND p.rn = 1 GROUP BY 1""")
def first_payment_method(t: Tables) -> DataFrame:
    rows = t["booking"].join(px.first_payment(t["payment"]), "BookingID", "left")
    return _count(rows, labels.payment_group("PaymentMethodCode").alias("PaymentMethod"))


@raw_operator("""SELECT user_id AS BookingID, event_type AS PaymentMethodCode FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn FROM events) e WHERE rn = 1""")
def first_event_per_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return px.first_payment(events.select(
        F.col("user_id").alias("ReferenceID"), F.col("event_id").alias("PaymentID"), F.col("event_type").alias("PaymentMethodCode")
    ))


@operator("""SELECT CASE WHEN trim(coalesce(c.Name, '')) = '' THEN 'Unknown' WHEN c.Name = 'United States of America' THEN 'United States' ELSE c.Name END AS Nationality,
  r.Region, r.SubRegion, COUNT(*) AS n FROM t_booking_passenger p LEFT JOIN t_country c ON c.CountryCode = p.Nationality LEFT JOIN t_country_region r ON r.CountryCode = p.Nationality GROUP BY ALL""")
def nationality_region(t: Tables) -> DataFrame:
    region = t["country_region"].select(F.col("CountryCode").alias("_c"), "Region", "SubRegion")
    rows = px.with_country(t["booking_passenger"], t["country"], "Nationality", "_name").join(region, F.col("Nationality") == F.col("_c"), "left")
    return _count(rows, labels.clean_nationality("_name").alias("Nationality"), "Region", "SubRegion")


@operator("""SELECT CASE WHEN d.doc = 'OT' OR d.doc IS NULL THEN p.Nationality ELSE d.doc END AS Passport, COUNT(*) AS n FROM t_booking_passenger p
LEFT JOIN (SELECT DISTINCT PassengerID, Nationality AS doc FROM t_passenger_travel_doc) d ON d.PassengerID = p.PassengerID GROUP BY 1""")
def passport_country(t: Tables) -> DataFrame:
    rows = t["booking_passenger"].join(px.travel_documents(t, "doc"), "PassengerID", "left")
    return _count(rows, labels.passport_country("doc", "Nationality").alias("Passport"))


@operator("""SELECT CASE WHEN ProductClassCode = 'HF' THEN 'ONLINE_PF' WHEN ProductClassCode = 'FS' AND trim(FareClassOfService) NOT IN ('B', 'H') THEN 'CORP_PF' ELSE 'NON_PF' END AS PremFlex,
  CASE WHEN trim(FareClassOfService) IN ('PF','LF','UF','TF','QF','MF','YF','HF') THEN 'Hi-Flyer' END AS HiFlyer, CASE WHEN trim(FareClassOfService) IN ('C','D','G','J','G1') THEN 'Premium' ELSE 'Economy' END AS Cabin,
  CASE WHEN International = 1 THEN 'INT' ELSE 'DOM' END AS DomInt, COUNT(*) AS n FROM t_passenger_journey_segment GROUP BY ALL""")
def product_labels(t: Tables) -> DataFrame:
    c = "FareClassOfService"
    return _count(
        t["passenger_journey_segment"], labels.premium_flex("ProductClassCode", c).alias("PremFlex"), labels.hi_flyer(c).alias("HiFlyer"),
        labels.cabin(c, fixed.PREMIUM_G1).alias("Cabin"), labels.dom_int("International").alias("DomInt"),
    )


@operator("""WITH bc AS (SELECT DISTINCT BookingID, lower(EmailAddress) AS email, upper(ProvinceState) AS prov, upper(trim(City)) AS city, CountryCode, rtrim(upper(FirstName)) AS fn, rtrim(upper(LastName)) AS ln FROM t_booking_contact)
SELECT pv.Name AS ProvinceState, bc.city AS City, COUNT(*) AS n, COUNT(DISTINCT bc.email) AS emails FROM t_booking_passenger p
LEFT JOIN bc ON bc.BookingID = p.BookingID AND bc.fn = rtrim(upper(p.FirstName)) AND bc.ln = rtrim(upper(p.LastName))
LEFT JOIN t_province_state pv ON pv.CountryCode = bc.CountryCode AND pv.ProvinceStateCode = bc.prov GROUP BY ALL""")
def contact_lookup(t: Tables) -> DataFrame:
    rows = px.with_contact(t["booking_passenger"], t)
    return rows.groupBy("ProvinceState", "City").agg(F.count("*").alias("n"), F.countDistinct("EmailAddress").alias("emails"))


# ---------------------------------------------------------------- journeys

@operator(f"""WITH {LEGS},
f AS (SELECT s.PassengerID, s.JourneyNumber, s.SegmentNumber, s.SegmentID, l.Carrier, l.STDUTC, l.STAUTC FROM t_passenger_journey_segment s
  JOIN t_passenger_journey_leg pl ON pl.PassengerID = s.PassengerID AND pl.SegmentID = s.SegmentID JOIN legs l ON l.InventoryLegID = pl.InventoryLegID WHERE s.FareJourneyType = 4)
SELECT CASE WHEN a.SegmentNumber = 1 THEN '1ST LEG' ELSE '2ND LEG' END AS LegSequence, a.Carrier AS Leg1Carrier, b.Carrier AS Leg2Carrier, {k.transit(k.hours('a.STAUTC', 'b.STDUTC'))} AS TransitTime, COUNT(*) AS n
FROM f a LEFT JOIN f b ON a.SegmentNumber = 1 AND b.SegmentNumber = 2 AND b.PassengerID = a.PassengerID AND b.JourneyNumber = a.JourneyNumber GROUP BY ALL""")
def fly_thru_pairs(t: Tables) -> DataFrame:
    pairs = jn.fly_thru(_flown(t), t["inventory_leg"])
    return _count(pairs, "LegSequence", F.col("Leg1CarrierCode").alias("Leg1Carrier"), F.col("Leg2CarrierCode").alias("Leg2Carrier"), "TransitTime")


def _flown(t: Tables) -> DataFrame:
    """All segments in the shape the pairing operators take, without money."""
    seg = px.remap_carrier(segment_view(t), t["carrier_mapping"])
    people = t["booking_passenger"].select("PassengerID", "FirstName", "LastName", "DOB", "Nationality")
    zero = F.lit(0).cast("decimal(28,4)")
    return seg.join(people, "PassengerID").withColumns({"AgeGroup": F.lit(""), **{x: zero for x in jn.LEG_MEASURES}})


@operator(f"""WITH {LEGS}, {SEGVIEW},
f AS (SELECT s.PassengerID, s.SegmentID, s.DepartureDate, s.DepartureStation AS dep, s.ArrivalStation AS arr, trim(p.FirstName) AS fn, trim(p.LastName) AS ln, p.DOB, s.Carrier
  FROM seg s JOIN t_booking_passenger p ON p.PassengerID = s.PassengerID WHERE s.FareJourneyType <> 4)
SELECT a.dep AS Leg1Departure, b.arr AS Leg2Arrival, CASE WHEN b.SegmentID IS NULL THEN 'POINT TO POINT' ELSE 'SELF-CONNECTING' END AS JourneyType, COUNT(*) AS n
FROM f a LEFT JOIN f b ON a.fn = b.fn AND a.ln = b.ln AND a.DOB = b.DOB AND {days('a.DepartureDate', 'b.DepartureDate')} BETWEEN 0 AND 2 AND a.dep <> b.arr AND a.arr = b.dep GROUP BY ALL""")
def self_connect_pairs(t: Tables) -> DataFrame:
    pairs = jn.self_connect(_flown(t), t["inventory_leg"])
    return _count(pairs, F.col("Leg1DepartureStation").alias("Leg1Departure"), F.col("Leg2ArrivalStation").alias("Leg2Arrival"), "JourneyType")


@operator(f"""WITH {LEGS}, {SEGVIEW},
a AS (SELECT * FROM seg WHERE FareJourneyType = 4),
lone AS (SELECT DISTINCT a.PassengerID, a.SegmentID, a.JourneyNumber FROM a LEFT JOIN a b ON b.SegmentNumber = 2 AND b.PassengerID = a.PassengerID AND b.JourneyNumber = a.JourneyNumber
  WHERE a.SegmentNumber = 1 AND b.SegmentID IS NULL),
fe AS (SELECT DISTINCT l.PassengerID, l.SegmentID FROM lone l JOIN seg o ON o.PassengerID = l.PassengerID AND o.JourneyNumber = l.JourneyNumber AND o.SegmentID <> l.SegmentID AND o.CarrierCode = 'BF')
SELECT CASE WHEN fe.SegmentID IS NOT NULL THEN 'FERRY' WHEN a.SegmentNumber = 1 AND b.SegmentID IS NULL THEN 'ERROR' ELSE 'FLYTHRU' END AS JourneyType, COUNT(*) AS n
FROM a LEFT JOIN a b ON a.SegmentNumber = 1 AND b.SegmentNumber = 2 AND b.PassengerID = a.PassengerID AND b.JourneyNumber = a.JourneyNumber
LEFT JOIN fe ON fe.PassengerID = a.PassengerID AND fe.SegmentID = a.SegmentID GROUP BY 1""")
def ferry_relabel(t: Tables) -> DataFrame:
    return _count(jn.mark_ferry(jn.fly_thru(_flown(t), t["inventory_leg"]), t), "JourneyType")


@operator(f"""WITH {LEGS}, {SEGVIEW}, psg AS (SELECT * FROM seg WHERE BookingStatus = 'HK'),
ij1 AS (SELECT b.* FROM psg p JOIN seg b ON b.PassengerID = p.PassengerID WHERE b.BookingStatus = 'HK' AND b.CarrierCode = 'BF' AND b.JourneyNumber = 1),
ij2 AS (SELECT b.* FROM psg p JOIN seg b ON b.PassengerID = p.PassengerID WHERE b.BookingStatus = 'HK' AND b.CarrierCode = 'BF' AND b.JourneyNumber = 2)
SELECT CASE WHEN i1.PassengerID IS NOT NULL OR i2.PassengerID IS NOT NULL THEN 'Y' ELSE 'N' END AS IslandTransfer, coalesce(i1.DepartureStation, i2.DepartureStation) AS DepartureStation2,
  coalesce(i1.ArrivalStation, i2.ArrivalStation) AS ArrivalStation2, COUNT(*) AS n
FROM psg a LEFT JOIN ij1 i1 ON i1.PassengerID = a.PassengerID AND i1.JourneyNumber = a.JourneyNumber AND i1.DepartureStation = a.ArrivalStation
LEFT JOIN ij2 i2 ON i2.PassengerID = a.PassengerID AND i2.JourneyNumber = a.JourneyNumber AND i2.ArrivalStation = a.DepartureStation GROUP BY ALL""")
def island_transfer(t: Tables) -> DataFrame:
    view = segment_view(t)
    psg = view.where(F.col("BookingStatus") == "HK").select("PassengerID", "SegmentID", "JourneyNumber", "DepartureStation", "ArrivalStation")
    return px.island_transfer(psg, view).groupBy("IslandTransfer", "DepartureStation2", "ArrivalStation2").agg(F.sum("Weight").alias("n"))


# ---------------------------------------------------------------- capacity

_PREM = " ".join(f"WHEN EquipmentType = {a} AND EquipmentTypeSuffix = '{b}' THEN {n}" for (a, b), n in fixed.PREMIUM_SEATS_333.items())
_ECON = " ".join(f"WHEN EquipmentType = {a} AND EquipmentTypeSuffix = '{b}' THEN Capacity - {n}" for (a, b), n in {**fixed.PREMIUM_SEATS_333, (330, "F"): 12}.items())


@operator(f"""SELECT EquipmentType, EquipmentTypeSuffix, Cabin, {I('SUM(seats)')} AS seats, COUNT(*) AS n FROM (
  SELECT InventoryLegID, EquipmentType, EquipmentTypeSuffix, 'Premium' AS Cabin, CASE {_PREM} ELSE 0 END AS seats FROM t_inventory_leg
  UNION SELECT InventoryLegID, EquipmentType, EquipmentTypeSuffix, 'Economy', CASE {_ECON} ELSE 0 END FROM t_inventory_leg) GROUP BY 1, 2, 3""")
def cabin_capacity(t: Tables) -> DataFrame:
    rows = cap.cabin_capacity(t["inventory_leg"], fixed.PREMIUM_SEATS_333, {(330, "F"): 12})
    return rows.groupBy("EquipmentType", "EquipmentTypeSuffix", "Cabin").agg(F.sum("Capacity").alias("seats"), F.count("*").alias("n"))


@operator(f"""WITH {LEGS}, f AS (SELECT DISTINCT Carrier, FlightNo, {k.pair('DepartureStation', 'ArrivalStation')} AS Route FROM legs)
SELECT Carrier AS CarrierCode, FlightNo AS FlightNumber, Route, {k.hub_lookup('Carrier', 'FlightNo', 'Route', "'hub'")} AS Hub FROM f""")
def hub_two_pass(t: Tables) -> DataFrame:
    legs = px.remap_carrier(t["inventory_leg"], t["carrier_mapping"])
    flights = legs.select("CarrierCode", "FlightNumber", keys.route_key("DepartureStation", "ArrivalStation").alias("Route")).distinct()
    return cap.assign_hub(flights, t["hub_info"], "Route")


@operator(f"""WITH {LEGS} SELECT Carrier AS CarrierCode, CASE WHEN CarrierCode || FlightNo IN {inlist(fixed.CHARTERED)} THEN 'Y' ELSE 'N' END AS IsChartered, COUNT(*) AS n FROM legs
WHERE Status <> 2 AND Lid > 0 AND CarrierCode <> 'BF' AND InventoryLegID NOT IN (SELECT InventoryLegID FROM t_chartered_flights) GROUP BY 1, 2""")
def charter_anti(t: Tables) -> DataFrame:
    legs = px.drop_charters(px.live_legs(t), t["chartered_flights"])
    return _count(legs, "CarrierCode", px.is_chartered().alias("IsChartered"))


def _sectors(t: Tables) -> DataFrame:
    legs = px.drop_charters(px.live_legs(t), t["chartered_flights"]).where(F.col("Capacity") > 0)
    return cap.ask(cap.sector_capacity(legs), t["city_pair"], t["distance"])


@operator(f"WITH {LEGS}, {ASK_CTES} SELECT Carrier AS CarrierCode, dep || arr AS Sector, {I('SUM(seats)')} AS seats, {I('SUM(ask)')} AS ask FROM asks GROUP BY 1, 2")
def ask_fallback(t: Tables) -> DataFrame:
    return _sectors(t).groupBy("CarrierCode", "Sector").agg(F.sum("Capacity").alias("seats"), F.sum("Ask").alias("ask"))


@operator(f"WITH {LEGS}, {ASK_CTES} SELECT Carrier AS CarrierCode, sector AS Sector, ccy AS AskCurrency, COUNT(*) AS n, {I('SUM(ask)')} AS ask FROM askccy GROUP BY 1, 2, 3")
def ask_currency(t: Tables) -> DataFrame:
    rows = cap.ask_currency(_sectors(t), t)
    return rows.groupBy("CarrierCode", "Sector", "AskCurrency").agg(F.count("*").alias("n"), F.sum("Ask").alias("ask"))


@operator(f"WITH {LEGS}, {ASK_CTES} SELECT Carrier AS CarrierCode, dd AS Date, ccy AS AskCurrency, {M('ask')} AS Ask FROM fwdc")
def forward_ask(t: Tables) -> DataFrame:
    out = cap.forward_ask(cap.ask_currency(_sectors(t), t), ["CarrierCode", "AskCurrency"])
    return out.withColumn("Ask", m.money("Ask"))


@raw_operator("""WITH a AS (SELECT o_orderstatus AS s, CAST(o_orderdate AS DATE) AS d, CAST(COUNT(*) AS BIGINT) AS n FROM orders GROUP BY 1, 2)
SELECT x.s AS CarrierCode, x.d AS Date, CAST(SUM(y.n) AS DECIMAL(28,4)) AS Ask FROM a x RIGHT JOIN a y ON x.s = y.s AND y.d >= x.d AND y.d < x.d + 181 GROUP BY 1, 2""")
def forward_window_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    daily = orders.groupBy(F.col("o_orderstatus").alias("CarrierCode"), tf.day("o_orderdate").alias("DepartureDate")).agg(F.count("*").alias("Ask"))
    return cap.forward_ask(daily, ["CarrierCode"]).withColumn("Ask", m.money("Ask"))


@operator(f"""SELECT l.CarrierCode, f.Sector, SUM(l.Lid * f.FeeMYR) IS NOT NULL AS valid, CAST(SUM(l.Lid * f.FeeMYR) AS DECIMAL(28,4)) AS fees FROM t_inventory_leg l
LEFT JOIN t_airport_fee f ON f.CarrierCode = l.CarrierCode AND f.Sector = l.DepartureStation || l.ArrivalStation AND DATE '2000-06-14' BETWEEN f.VersionStartDate AND f.VersionEndDate GROUP BY 1, 2""")
def airport_fee(t: Tables) -> DataFrame:
    legs = t["inventory_leg"].withColumn("Route", keys.sector("DepartureStation", "ArrivalStation"))
    rows = cap.with_airport_fee(legs, t["airport_fee"], windows.day_literal(date(2000, 6, 14)))
    total = F.sum(F.col("Lid") * F.col("FeeMYR"))
    sector = F.when(F.col("FeeMYR").isNotNull(), F.col("Route")).alias("Sector")
    return rows.groupBy("CarrierCode", sector).agg(total.isNotNull().alias("valid"), m.money(total).alias("fees"))


@operator(f"""WITH n AS (SELECT l.*, row_number() OVER (PARTITION BY CarrierCode, FlightNumber, DepartureDate ORDER BY InventoryLegID) AS rn FROM t_inventory_leg l)
SELECT CarrierCode, {I('SUM(CASE WHEN rn = 1 THEN Capacity ELSE 0 END)')} AS capacity, COUNT(*) AS n FROM n GROUP BY 1""")
def row1_capacity(t: Tables) -> DataFrame:
    rows = cap.first_row(t["inventory_leg"], ["CarrierCode", "FlightNumber", "DepartureDate"], ["InventoryLegID"])
    first = F.when(F.col("RowNo") == 1, F.col("Capacity")).otherwise(F.lit(0))
    return rows.groupBy("CarrierCode").agg(F.sum(first).alias("capacity"), F.count("*").alias("n"))


@operator(f"""WITH r AS (SELECT l.InventoryLegID, c.ClassOfService, c.ClassAU, SUM(c.ClassSold) OVER (PARTITION BY l.InventoryLegID, c.ClassNest) AS nest, SUM(c.ClassSold) OVER (PARTITION BY l.InventoryLegID) AS sold
  FROM t_inventory_leg l JOIN t_inventory_leg_class c ON c.InventoryLegID = l.InventoryLegID)
SELECT trim(ClassOfService) AS ClassOfService, {I('SUM(ClassAU)')} AS au, {I('SUM(greatest(ClassAU - nest, 0))')} AS avail, {I('SUM(sold)')} AS sold FROM r GROUP BY 1""")
def class_availability(t: Tables) -> DataFrame:
    rows = cap.class_availability(t["inventory_leg"].select("InventoryLegID"), t["inventory_leg_class"])
    return rows.groupBy("ClassOfService").agg(F.sum("ClassAU").alias("au"), F.sum("ClassAvail").alias("avail"), F.sum("SeatSold").alias("sold"))


# ---------------------------------------------------------------- set operations and reports' building blocks

@operator(f"""WITH {CHARGES}, {FEES},
a AS (SELECT CurrencyCode, {M("SUM(amt)")} AS v FROM chg GROUP BY 1), b AS (SELECT CurrencyCode, {M('SUM(amt)')} AS v FROM fees GROUP BY 1)
SELECT * FROM a UNION SELECT * FROM b UNION SELECT * FROM b UNION SELECT * FROM a""")
def union_distinct_parts(t: Tables) -> DataFrame:
    a = px.journey_charges(t).groupBy("CurrencyCode").agg(m.money(F.sum("Amount")).alias("v"))
    b = m.signed_by_matrix(px.fee_lines(t), t["charge_type_matrix"]).groupBy("CurrencyCode").agg(m.money(F.sum("Amount")).alias("v"))
    return a.union(b).union(b).union(a).distinct()


@operator(f"""WITH s AS (SELECT c.CurrencyCode AS cur, {day('c.CreatedDate')} AS d, {M('SUM(c.ChargeAmount)')} AS v FROM t_passenger_journey_charge c GROUP BY 1, 2),
o AS (SELECT CurrencyCode AS cur, {day('BookingDate')} AS d, COUNT(*) AS n FROM t_booking GROUP BY 1, 2)
SELECT coalesce(s.d, o.d) AS d, coalesce(s.cur, o.cur) AS label, s.v AS v, {M('o.n')} AS n FROM s FULL JOIN o ON o.cur = s.cur AND o.d = s.d
UNION SELECT coalesce(s.d, o.d), 'Total', {M('s.v')}, {M('o.n')} FROM (SELECT d, SUM(v) AS v FROM s GROUP BY 1) s FULL JOIN (SELECT d, SUM(n) AS n FROM o GROUP BY 1) o ON o.d = s.d""")
def detail_plus_total(t: Tables) -> DataFrame:
    s = t["passenger_journey_charge"].groupBy(F.col("CurrencyCode").alias("cur"), tf.day("CreatedDate").alias("d")).agg(m.money(F.sum("ChargeAmount")).alias("v"))
    o = t["booking"].groupBy(F.col("CurrencyCode").alias("cur"), tf.day("BookingDate").alias("d")).agg(F.count("*").alias("n"))
    detail = s.join(o, ["cur", "d"], "full").select("d", F.col("cur").alias("label"), "v", m.money("n").alias("n"))
    total = s.groupBy("d").agg(F.sum("v").alias("v")).join(o.groupBy("d").agg(F.sum("n").alias("n")), "d", "full")
    return detail.union(total.select("d", F.lit("Total"), m.money("v"), m.money("n"))).distinct()


@operator(f"""WITH {LEGS}, a AS (SELECT Carrier, CASE ArrivalStation WHEN 'MES' THEN 'KNO' ELSE ArrivalStation END AS arr, CASE DepartureStation WHEN 'MES' THEN 'KNO' ELSE DepartureStation END AS dep, Capacity FROM legs)
SELECT CASE WHEN a.Carrier = 'PQ' THEN 'Z2' ELSE a.Carrier END AS CarrierCode, {k.market('cp.CityPairGroup')} AS ODPair, {I('SUM(a.Capacity)')} AS seats, COUNT(*) AS n
FROM a LEFT JOIN t_city_pair cp ON cp.DepartureStation = a.dep AND cp.ArrivalStation = a.arr GROUP BY 1, 2""")
def alias_then_regroup(t: Tables) -> DataFrame:
    legs = px.remap_carrier(t["inventory_leg"], t["carrier_mapping"])
    legs = legs.withColumns({c: keys.alias_station(c) for c in ("DepartureStation", "ArrivalStation")})
    legs = cap.with_market_pair(legs, t["city_pair"])
    return legs.groupBy(keys.recode("CarrierCode", {"PQ": "Z2"}).alias("CarrierCode"), "ODPair").agg(F.sum("Capacity").alias("seats"), F.count("*").alias("n"))


@operator(f"""WITH {LEGS}, {SEGVIEW} SELECT CarrierCode, FlightNo AS FlightNumber, BookingStatus, COUNT(*) AS n FROM seg GROUP BY ALL""")
def segment_view_scan(t: Tables) -> DataFrame:
    return _count(segment_view(t), "CarrierCode", "FlightNumber", "BookingStatus")


@operator("""SELECT l.CarrierCode, f.FeeCode, COUNT(*) AS n FROM t_passenger_fee f JOIN t_inventory_leg l ON l.InventoryLegID = f.InventoryLegID GROUP BY ALL""")
def fee_view_scan(t: Tables) -> DataFrame:
    return _count(fee_view(t), "CarrierCode", "FeeCode")


@operator("""SELECT b.Status, COUNT(*) AS n, COUNT(DISTINCT b.CreatedAgentID) AS agents FROM t_booking b
WHERE b.BookingDate >= (SELECT date_trunc('month', DownloadDate) - INTERVAL '5' MONTH FROM t_download_date) - INTERVAL '8' HOUR
  AND b.BookingDate < (SELECT CAST(DownloadDate AS TIMESTAMP) FROM t_download_date) - INTERVAL '8' HOUR GROUP BY 1""")
def as_of_window(t: Tables) -> DataFrame:
    end = datetime.combine(as_of(t), time())
    rows = px.bookings(t, windows.five_months_back(end), None, hours=8)
    return rows.groupBy("Status").agg(F.count("*").alias("n"), F.countDistinct("CreatedAgentID").alias("agents"))


@operator("""SELECT Status, COUNT(*) AS n FROM t_booking WHERE BookingDate >= TIMESTAMP '2000-05-01' AND BookingDate < TIMESTAMP '2000-06-01' GROUP BY 1""")
def previous_month_window(t: Tables) -> DataFrame:
    return _count(px.bookings(t, windows.previous_month(NOW), None), "Status")
