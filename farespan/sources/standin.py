"""Airline source tables derived from the driver's star-schema tables.

Each table is one query text that both Spark SQL and DuckDB accept.  ``@name``
stands for a driver table and ``@fan(n)`` for n copies of each row numbered
``k`` = 0..n-1; the two engines spell those differently.
"""

from __future__ import annotations

import re
import uuid
import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farespan.sources.sinks import staging_dir
from farespan.sources.tables import Tables

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

# Invented data: 25 flights (carrier, number, departure, arrival), in nation order.
FLIGHTS = (
    ("AK", "326 ", "KUL", "BKI"), ("AK", "327 ", "BKI", "KUL"), ("D7", "216 ", "KUL", "PER"),
    ("D7", "217 ", "PER", "KUL"), ("D7", "502 ", "KUL", "TSN"), ("D7", "503 ", "TSN", "KUL"),
    ("D7", "2994", "KUL", "MEL"), ("D7", "620 ", "DMK", "ICN"), ("FD", "2496", "DMK", "HKT"),
    ("FD", "401 ", "HKT", "DMK"), ("QZ", "122 ", "MES", "KUL"), ("QZ", "123 ", "KUL", "CGK"),
    ("Z2", "701 ", "MNL", "CEB"), ("PQ", "702 ", "CEB", "MNL"), ("XT", "801 ", "CGK", "SIN"),
    ("XJ", "600 ", "DMK", "PEK"), ("I5", "1320", "DEL", "BOM"), ("BF", "9   ", "HKT", "SIN"),
    ("AK", "70  ", "KUL", "HKG"), ("D7", "170 ", "KUL", "LGW"), ("AK", "888 ", "KNO", "KUL"),
    ("JW", "808 ", "KUL", "STN"), ("D7", "404 ", "STN", "KUL"), ("XJ", "601 ", "PEK", "DMK"),
    ("AK", "15  ", "SIN", "PER"),
)
# Invented data: 25 stations and their countries, in nation order.
STATIONS = "KULBKIKCHMESKNOCGKDMKBKKHKTSINMNLCEBPEKTSNCANHKGMFMSTNLGWMELPERDELBOMICNORY"
COUNTRIES = "MYMYMYIDIDIDTHTHTHSGPHPHCNCNCNHKMOGBGBAUAUININKRFR"

CURRENCIES = "MYRTHBIDRPHPINRUSD"
CLASSES = "Y M B H C D G J G1PFHFLFA1A2DIW K L V Z "
GRID_CLASSES = "Y DIA1A2W B C "
METHODS = "MSVSDCC3BDCAZZAX"
FEES = "BAGSMEALSEATINSRWIFI"


def _pick(text: str, index: str, width: int) -> str:
    return f"substring('{text}', CAST({index} AS INT) * {width} + 1, {width})"


def _flight(column: int, index: str) -> str:
    values = [f[column] for f in FLIGHTS]
    return _pick("".join(values), index, len(values[0]))


def _station(index: str) -> str:
    return _pick(STATIONS, index, 3)


def _country(index: str) -> str:
    return _pick(COUNTRIES, index, 2)


def _country_of(station: str) -> str:
    return f"substring('{COUNTRIES}', CAST((position({station} IN '{STATIONS}') - 1) / 3 AS INT) * 2 + 1, 2)"


def _ymd(ts: str) -> str:
    return f"(year({ts}) * 10000 + month({ts}) * 100 + day({ts}))"


SLOT = "(l_suppkey % 25)"
PASSENGER = "(l_orderkey * 2 + l_partkey % 2)"
SEGMENT = "((l_partkey * 100000 + l_suppkey) * 10 + l_linenumber)"
LEG = f"CAST({SLOT} * 100000000 + {_ymd('l_shipdate')} AS BIGINT)"
PRICE = "CAST(l_extendedprice AS DECIMAL(14,2))"
ORG = (
    "CASE c_custkey % 3 WHEN 0 THEN CAST(c_custkey % 60 AS STRING) "
    "WHEN 1 THEN concat('A', CAST(c_custkey % 60 AS STRING)) END"
)
RPT = "CASE c_mktsegment WHEN 'BUILDING' THEN 'Corporate' WHEN 'HOUSEHOLD' THEN 'Call Centre' WHEN 'MACHINERY' THEN 'Others' ELSE c_mktsegment END"
DEP, ARR = _flight(2, "n_nationkey"), _flight(3, "n_nationkey")
CARRIER, NUMBER = _flight(0, "n_nationkey"), _flight(1, "n_nationkey")
PAIR = f"CASE WHEN {DEP} <= {ARR} THEN concat({DEP}, {ARR}) ELSE concat({ARR}, {DEP}) END"
PAIR_DASH = f"CASE WHEN {DEP} <= {ARR} THEN concat({DEP}, '-', {ARR}) ELSE concat({ARR}, '-', {DEP}) END"
PAIR_BACK = f"CASE WHEN {DEP} <= {ARR} THEN concat({ARR}, {DEP}) ELSE concat({DEP}, {ARR}) END"

STANDINS: dict[str, str] = {
    "booking": f"""
        SELECT o_orderkey AS BookingID, o_orderdate + CAST(o_custkey % 24 AS INT) * INTERVAL '1' HOUR AS BookingDate,
          CASE o_orderstatus WHEN 'F' THEN 2 WHEN 'O' THEN 3 ELSE 1 END AS Status,
          concat('R', CAST(o_orderkey AS STRING)) AS RecordLocator,
          {_pick(CURRENCIES, 'o_custkey % 6', 3)} AS CurrencyCode, o_custkey AS CreatedAgentID
        FROM @orders""",
    "booking_passenger": f"""
        SELECT o_orderkey * 2 + k AS PassengerID, o_orderkey AS BookingID,
          concat(' F', CAST(o_custkey AS STRING), ' ') AS FirstName,
          CASE WHEN o_custkey % 10 = 0 THEN 'TBA' ELSE concat('L', CAST(k AS STRING)) END AS LastName,
          CASE WHEN o_custkey % 50 <> 7 THEN DATE '1885-01-01' + CAST(o_custkey % 39000 * 5197 % 39000 AS INT) END AS DOB,
          {_country('(o_custkey + k) % 25')} AS Nationality, CAST(k + 1 AS INT) AS Gender
        FROM @orders @fan(2)""",
    "booking_contact": f"""
        SELECT o_orderkey AS BookingID, concat('U', CAST(o_custkey AS STRING), '-Mail.Example') AS EmailAddress,
          concat('p', CAST(o_custkey % 4 AS STRING)) AS ProvinceState, concat(' City', CAST(o_custkey % 7 AS STRING), ' ') AS City,
          {_country('o_custkey % 25')} AS CountryCode, concat(' F', CAST(o_custkey AS STRING), ' ') AS FirstName,
          'L0' AS LastName
        FROM @orders""",
    "payment": f"""
        SELECT o_orderkey * 2 + k AS PaymentID, o_orderkey AS ReferenceID,
          {_pick(METHODS, '(o_custkey + k) % 8', 2)} AS PaymentMethodCode
        FROM @orders @fan(2)""",
    "passenger_travel_doc": f"""
        SELECT o_orderkey * 2 + k AS PassengerID,
          CASE WHEN o_custkey % 5 = 0 THEN NULL WHEN o_custkey % 5 = 1 THEN 'OT' ELSE {_country('o_custkey % 25')} END AS Nationality
        FROM @orders @fan(2)""",
    "passenger_journey_segment": f"""
        SELECT {PASSENGER} AS PassengerID, {SEGMENT} AS SegmentID,
          CASE WHEN l_linenumber <= 2 THEN 1 WHEN l_linenumber <= 4 THEN 2 ELSE 3 END AS JourneyNumber,
          CASE WHEN l_linenumber % 2 = 1 THEN 1 ELSE 2 END AS SegmentNumber,
          CASE WHEN l_orderkey % 2 = 0 THEN 4 ELSE 1 END AS FareJourneyType,
          l_shipdate AS DepartureDate, {_flight(2, SLOT)} AS DepartureStation, {_flight(3, SLOT)} AS ArrivalStation,
          CASE WHEN {_country_of(_flight(2, SLOT))} = {_country_of(_flight(3, SLOT))} THEN 0 ELSE 1 END AS International,
          {_pick(CLASSES, 'l_partkey % 20', 2)} AS FareClassOfService, {_pick('HFFSEC', 'l_partkey % 3', 2)} AS ProductClassCode,
          CASE WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN 'HL' ELSE 'HK' END AS BookingStatus,
          {_pick(CURRENCIES, 'l_suppkey % 6', 3)} AS CurrencyCode, l_shipdate - INTERVAL '60' DAY AS CreatedDate,
          l_partkey AS CreatedAgentID
        FROM @lineitem""",
    "passenger_journey_leg": f"""
        SELECT {PASSENGER} AS PassengerID, {SEGMENT} AS SegmentID,
          CASE WHEN l_linenumber <= 2 THEN 1 WHEN l_linenumber <= 4 THEN 2 ELSE 3 END AS JourneyNumber, {LEG} AS InventoryLegID
        FROM @lineitem""",
    "passenger_journey_charge": f"""
        SELECT {PASSENGER} AS PassengerID, {SEGMENT} AS SegmentID, CAST(k AS INT) AS ChargeNumber,
          CASE k WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN 4 WHEN 3 THEN 5
            WHEN 4 THEN CASE l_linenumber % 2 WHEN 0 THEN 8 ELSE 7 END
            ELSE CASE l_linenumber WHEN 1 THEN 0 WHEN 2 THEN 19 ELSE 6 END END AS ChargeType,
          CASE k WHEN 0 THEN 'FARE' WHEN 1 THEN 'DISC' WHEN 2 THEN {_pick('FUELFUEXDOMS', 'l_partkey % 3', 4)}
            WHEN 3 THEN trim({_pick('APF   KLIA2 THRU  XHISEAADM   GST   OTF   ', 'l_partkey % 7', 6)})
            WHEN 4 THEN 'CONN' ELSE CASE WHEN l_linenumber <= 2 THEN 'FAR2' ELSE 'BAGS' END END AS ChargeCode,
          CAST(CASE k WHEN 0 THEN {PRICE} * CAST(1 AS DECIMAL(4,2)) WHEN 1 THEN {PRICE} * CAST(l_discount AS DECIMAL(4,2))
            WHEN 2 THEN {PRICE} * CAST(0.05 AS DECIMAL(4,2)) WHEN 3 THEN {PRICE} * CAST(l_tax AS DECIMAL(4,2))
            WHEN 4 THEN {PRICE} * CAST(0.02 AS DECIMAL(4,2)) ELSE {PRICE} * CAST(0.10 AS DECIMAL(4,2)) END AS DECIMAL(18,4)) AS ChargeAmount,
          {_pick(CURRENCIES, 'l_suppkey % 6', 3)} AS CurrencyCode, l_shipdate - INTERVAL '60' DAY AS CreatedDate
        FROM @lineitem @fan(6)""",
    "passenger_fee": f"""
        SELECT {PASSENGER} AS PassengerID, {SEGMENT} AS FeeNumber, {_pick(FEES, 'l_partkey % 5', 4)} AS FeeCode,
          CASE WHEN l_partkey % 4 = 0 THEN 0 ELSE {LEG} END AS InventoryLegID
        FROM @lineitem""",
    "passenger_fee_charge": f"""
        SELECT {PASSENGER} AS PassengerID, {SEGMENT} AS FeeNumber,
          CASE k WHEN 2 THEN 'DISC' ELSE {_pick(FEES, 'l_partkey % 5', 4)} END AS ChargeCode,
          CASE k WHEN 0 THEN 6 WHEN 1 THEN 5 ELSE 1 END AS ChargeType,
          CAST(CASE k WHEN 0 THEN l_quantity ELSE k END AS DECIMAL(18,4)) AS ChargeAmount,
          {_pick(CURRENCIES, 'l_suppkey % 6', 3)} AS CurrencyCode, l_shipdate - INTERVAL '45' DAY AS CreatedDate
        FROM @lineitem @fan(3)""",
    "inventory_leg": f"""
        SELECT InventoryLegID, concat('K', CAST(InventoryLegID AS STRING)) AS InventoryLegKey, d AS DepartureDate,
          {_flight(0, 'slot')} AS CarrierCode, {_flight(1, 'slot')} AS FlightNumber, ' ' AS OpSuffix,
          {_flight(2, 'slot')} AS DepartureStation, {_flight(3, 'slot')} AS ArrivalStation,
          CASE WHEN day(d) = 13 THEN 2 ELSE 1 END AS Status, CASE WHEN day(d) = 29 THEN 0 ELSE 180 END AS Lid,
          CAST(180 + slot AS INT) AS Capacity, CAST(170 + slot AS INT) AS AdjustedCapacity,
          CASE slot % 6 WHEN 0 THEN 320 WHEN 1 THEN 733 WHEN 2 THEN 330 WHEN 3 THEN 340 WHEN 4 THEN 332 ELSE 333 END AS EquipmentType,
          {_pick('ABCDEF', 'month(d) % 6', 1)} AS EquipmentTypeSuffix,
          d + CAST(slot % 20 AS INT) * INTERVAL '1' HOUR AS STDUTC,
          d + CAST(slot % 20 + 1 + slot % 6 AS INT) * INTERVAL '1' HOUR + INTERVAL '25' MINUTE AS STAUTC,
          d - INTERVAL '300' DAY AS CreatedDate, d - INTERVAL '10' DAY AS ModifiedDate
        FROM (SELECT DISTINCT {LEG} AS InventoryLegID, {SLOT} AS slot, l_shipdate AS d FROM @lineitem) legs""",
    "inventory_leg_class": f"""
        SELECT {LEG} AS InventoryLegID, {_pick(GRID_CLASSES, 'l_partkey % 7', 2)} AS ClassOfService,
          CAST(l_partkey % 7 % 3 AS INT) AS ClassNest, CAST(SUM(l_quantity) AS INT) AS ClassAU,
          CAST(COUNT(*) * 9 AS INT) AS ClassSold
        FROM @lineitem GROUP BY {LEG}, {_pick(GRID_CLASSES, 'l_partkey % 7', 2)}, CAST(l_partkey % 7 % 3 AS INT)""",
    "charge_type_matrix": """
        SELECT n_nationkey AS ChargeTypeID, CASE WHEN n_nationkey IN (1, 2, 3, 7, 11, 16) THEN -1 ELSE 1 END AS PositiveNegativeFlag
        FROM @nation""",
    "ancillary_fee_codes": f"""
        SELECT CASE r_regionkey WHEN 4 THEN 'SPEQ' ELSE {_pick(FEES, 'r_regionkey', 4)} END AS Code FROM @region""",
    "fee": f"""
        SELECT {_pick(FEES, 'r_regionkey', 4)} AS FeeCode, concat('Fee ', r_name) AS Name FROM @region""",
    "fx_history": """
        SELECT FromCurrencyCode, ToCurrencyCode, d AS ConversionDate,
          CAST(CASE (day(d) + f + 2 * t) % 4 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 4 ELSE 8 END AS DECIMAL(9,4)) AS ConversionRate
        FROM (SELECT d, CAST(k % 8 AS INT) AS f, CAST((k - k % 8) / 8 AS INT) AS t,
                substring('MYRTHBIDRPHPINRUSDJPYCNY', CAST(k % 8 AS INT) * 3 + 1, 3) AS FromCurrencyCode,
                substring('MYRTHBIDRPHPINRUSDJPYCNY', CAST((k - k % 8) / 8 AS INT) * 3 + 1, 3) AS ToCurrencyCode
              FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM @orders WHERE day(o_orderdate) <> 31) days @fan(64)) pairs
        WHERE FromCurrencyCode <> ToCurrencyCode""",
    "station": f"""
        SELECT {_station('n_nationkey')} AS StationCode, concat('C', {_station('n_nationkey')}) AS CityCode,
          {_country('n_nationkey')} AS CountryCode, n_name AS ShortName FROM @nation""",
    "country": f"""
        SELECT DISTINCT {_country('n_nationkey')} AS CountryCode,
          CASE {_country('n_nationkey')} WHEN 'MY' THEN 'Malaysia' WHEN 'TH' THEN 'Thailand' WHEN 'CN' THEN 'China'
            WHEN 'AU' THEN 'Australia' WHEN 'SG' THEN 'Singapore' WHEN 'IN' THEN 'India' WHEN 'KR' THEN 'South Korea'
            WHEN 'GB' THEN 'United States of America' WHEN 'FR' THEN ' ' ELSE concat('Country ', {_country('n_nationkey')}) END AS Name,
          CASE {_country('n_nationkey')} WHEN 'MY' THEN 'MYR' WHEN 'TH' THEN 'THB' WHEN 'ID' THEN 'IDR' WHEN 'PH' THEN 'PHP'
            WHEN 'IN' THEN 'INR' ELSE 'USD' END AS DefaultCurrencyCode FROM @nation""",
    "province_state": f"""
        SELECT DISTINCT {_country('n_nationkey')} AS CountryCode, concat('P', CAST(k AS STRING)) AS ProvinceStateCode,
          concat('Province ', CAST(k AS STRING)) AS Name FROM @nation @fan(3)""",
    "carrier": f"""
        SELECT DISTINCT {CARRIER} AS CarrierCode, CASE {CARRIER} WHEN 'JW' THEN 'P' ELSE 'H' END AS CarrierType FROM @nation""",
    "agent": f"""
        SELECT c_custkey AS AgentID, {ORG} AS OrganizationCode,
          {_pick('KULDELCANCGKDMKXXX', 'c_nationkey % 6', 3)} AS LocationCode FROM @customer""",
    "agent_role": "SELECT c_custkey AS AgentID, c_mktsegment AS RoleCode FROM @customer",
    "organization": f"""
        SELECT DISTINCT {ORG} AS OrganizationCode, concat('Org ', {ORG}) AS OrganizationName, 'MY' AS CountryCode
        FROM @customer WHERE {ORG} IS NOT NULL""",
    "sales_agency": f"""
        SELECT DISTINCT {ORG} AS OrganizationCode, concat('Agency ', {ORG}) AS OrganizationName, 'SG' AS CountryCode
        FROM @customer WHERE {ORG} IS NOT NULL""",
    "sales_channel": f"""
        SELECT DISTINCT c_mktsegment AS RoleCode, c_mktsegment AS SalesChannel, {RPT} AS SalesChannelRpt,
          CASE c_mktsegment WHEN 'FURNITURE' THEN 'GONE' ELSE 'EXIST' END AS Status FROM @customer""",
    "sales_channel_group": """
        SELECT CASE r_regionkey WHEN 0 THEN 'Corporate' WHEN 1 THEN 'Call Centre' WHEN 4 THEN 'AUTOMOBILE' ELSE 'Others' END AS ChannelBreakdown,
          CASE r_regionkey WHEN 2 THEN 'Third Party' WHEN 3 THEN 'Online' ELSE 'Direct' END AS Category,
          concat('Group ', r_name) AS Grouping FROM @region""",
    "class_of_service": f"SELECT DISTINCT {_pick(CLASSES, 'p_partkey % 20', 2)} AS ClassOfServiceCode FROM @part",
    "fare_class": f"""
        SELECT DISTINCT {_pick(CLASSES, 'p_partkey % 20', 2)} AS ClassOfService,
          concat('FC', CAST(p_partkey % 20 % 4 AS STRING)) AS FareClass FROM @part""",
    "city_pair": f"""
        SELECT {DEP} AS DepartureStation, {ARR} AS ArrivalStation, {PAIR_DASH} AS CityPairGroup,
          CASE WHEN {_country_of(DEP)} = {_country_of(ARR)} THEN 0 ELSE 1 END AS InternationalFlag,
          CASE n_nationkey % 4 WHEN 2 THEN NULL ELSE 900 + n_nationkey END AS ActualDistance, 1 AS ActualDistanceUnit
        FROM @nation""",
    "distance": f"""
        SELECT {DEP} AS DepartureStation, {ARR} AS ArrivalStation,
          CASE n_nationkey % 7 WHEN 3 THEN NULL ELSE 1000 + n_nationkey END AS ActualDistance,
          CASE n_nationkey % 7 WHEN 3 THEN NULL ELSE 2 END AS ActualDistanceUnit FROM @nation""",
    "carrier_mapping": f"""
        SELECT {_pick('AKD7FDXTD7', 'r_regionkey', 2)} AS CarrierCode, {_pick(' 15 620 401 801 404 ', 'r_regionkey', 4)} AS FlightNumber,
          {_pick('D7XJXJQZAK', 'r_regionkey', 2)} AS MappedCarrier FROM @region""",
    "chartered_flights": f"""
        SELECT DISTINCT {LEG} AS InventoryLegID FROM @lineitem WHERE {_flight(0, SLOT)} = 'AK' AND day(l_shipdate) = 1""",
    "hub_info": f"""
        SELECT {CARRIER} AS CarrierCode, CASE WHEN n_nationkey % 3 = 0 THEN '9999' ELSE {NUMBER} END AS FlightNumber,
          {DEP} AS DepartureStation, {ARR} AS ArrivalStation, CASE WHEN k = 0 THEN {PAIR} ELSE {PAIR_BACK} END AS MarketGroup,
          CASE WHEN n_nationkey % 5 = 4 THEN 'LONGHUB' WHEN k = 0 THEN {DEP} ELSE concat('Z', {ARR}) END AS Hub
        FROM @nation @fan(2)""",
    "market_group": f"SELECT {DEP} AS DepartureStation, {ARR} AS ArrivalStation, {PAIR} AS MarketGroup FROM @nation",
    "market_group_dmk": f"SELECT {DEP} AS DepartureStation, {ARR} AS ArrivalStation, {PAIR_BACK} AS MarketGroup FROM @nation",
    "country_region": f"""
        SELECT DISTINCT {_country('n_nationkey')} AS CountryCode, concat('Region ', substring({_country('n_nationkey')}, 1, 1)) AS Region,
          concat('Sub ', {_country('n_nationkey')}) AS SubRegion FROM @nation""",
    "airport_fee": f"""
        SELECT {CARRIER} AS CarrierCode, concat({DEP}, {ARR}) AS Sector, CAST(10.5 + n_nationkey AS DECIMAL(18,4)) AS FeeMYR,
          DATE '1990-01-01' AS VersionStartDate,
          CASE WHEN n_nationkey % 2 = 0 THEN DATE '2100-01-01' ELSE DATE '1996-01-01' END AS VersionEndDate FROM @nation""",
    "station_currency": f"""
        SELECT {_station('n_nationkey')} AS Station, CASE n_nationkey % 4 WHEN 0 THEN 'SGD' END AS Currency FROM @nation""",
    "route_distance": f"SELECT {PAIR} AS ODPair, MIN(3000 + n_nationkey) AS Distance_km FROM @nation WHERE {CARRIER} IN ('D7', 'XJ') GROUP BY {PAIR}",
    "travel_country": f"""
        SELECT {CARRIER} AS CarrierCode, {DEP} AS DepartureStation, {ARR} AS ArrivalStation,
          concat(' ', {_country_of(ARR)}) AS TravelCountry FROM @nation""",
    "travel_region": f"""
        SELECT {_country('n_nationkey')} AS Country, concat('R', substring({_country('n_nationkey')}, 1, 1)) AS Region FROM @nation""",
    "download_date": "SELECT MAX(CAST(o_orderdate AS DATE)) AS DownloadDate FROM @orders",
}


def spark_text(sql: str, view: str = "") -> str:
    sql = re.sub(r"@fan\((\d+)\)", lambda m: f"LATERAL VIEW explode(sequence(0, {int(m[1]) - 1})) f AS k", sql)
    return re.sub(r"@(\w+)", lambda m: f"{view}{m[1]}", sql)


def duckdb_text(sql: str) -> str:
    sql = re.sub(r"@fan\((\d+)\)", lambda m: f"CROSS JOIN unnest(range(0, {m[1]})) AS f(k)", sql)
    return re.sub(r"@(\w+)", lambda m: m[1], sql)


# Tables with a passenger in every line item: dealt by it as line items, before a row becomes several.
BY_LINE = (
    "passenger_journey_segment", "passenger_journey_leg", "passenger_journey_charge", "passenger_fee", "passenger_fee_charge",
)

# Ids are stored as differences, which takes less than plain ones do.
PACKED = {"compression": "zstd", "parquet.writer.version": "v2"}

# Derived tables already written, by application, data directory and name.
_derived: dict[tuple[str, str, str], str] = {}


def driver_view(spark: SparkSession, sf_dir: str, name: str, prefix: str, dealt: int | None = None) -> None:
    """Make a driver table a view; ``dealt``: line items in as many parts by passenger, sorted by it."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    if dealt:
        passenger = F.expr(PASSENGER)
        df = df.repartition(dealt, passenger).sortWithinPartitions(passenger)
    df.createOrReplaceTempView(f"{prefix}{name}")


def derive(spark: SparkSession, sf_dir: str, name: str, dealt: int | None = None) -> DataFrame:
    """One airline table, derived from the driver tables.

    The rows are made where the driver table is read, or ``dealt`` by passenger.
    """
    prefix = f"driver_{zlib.crc32(sf_dir.encode()):08x}_" + ("dealt_" if dealt else "")
    for driver in set(re.findall(r"@(\w+)", STANDINS[name])) & set(DRIVER_TABLES):
        driver_view(spark, sf_dir, driver, prefix, dealt if driver == "lineitem" else None)
    return spark.sql(spark_text(STANDINS[name], prefix))


def unstored(spark: SparkSession, sf_dir: str, buckets: int) -> Tables:
    """The airline tables as they are derived, for one reading each; those of :data:`BY_LINE`
    are dealt by passenger into ``buckets`` parts."""
    sf_dir = sf_dir.rstrip("/")
    return Tables(spark, lambda name: derive(spark, sf_dir, name, buckets if name in BY_LINE else None), list(STANDINS))


def airline(spark: SparkSession, sf_dir: str) -> Tables:
    """The airline tables over one scale-factor directory.

    A table is derived once per application and written as Parquet next to the other
    staged data, so reports scan stored tables, as they would in use.
    """
    sf_dir = sf_dir.rstrip("/")

    def read(name: str) -> DataFrame:
        key = (spark.sparkContext.applicationId, sf_dir, name)
        if key not in _derived:
            path = f"{staging_dir(spark)}/farespan-source/{name}-{uuid.uuid4().hex}"
            derive(spark, sf_dir, name).write.options(**PACKED).parquet(path)
            _derived[key] = path
        return spark.read.parquet(_derived[key])

    return Tables(spark, read, list(STANDINS))
