"""Carrier remap, the passenger fact, fees, points of sale and passenger attributes."""

from __future__ import annotations

from weakref import WeakKeyDictionary

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farespan.functions import fixed
from farespan.functions.timefn import day
from farespan.functions.windows import Window
from farespan.operators.money import signed_by_matrix
from farespan.sources.tables import Tables, by_rows


def remap_carrier(df: DataFrame, mapping: DataFrame, carrier: str = "CarrierCode", flight: str = "FlightNumber",
                  out: str = "CarrierCode") -> DataFrame:
    """Carrier that sells a flight: the mapped one where listed, else its own."""
    table = mapping.select(
        F.col("CarrierCode").alias("_mc"), F.col("FlightNumber").alias("_mf"), F.col("MappedCarrier").alias("_mapped")
    )
    joined = df.join(table, (F.col(carrier) == F.col("_mc")) & (F.col(flight) == F.col("_mf")), "left")
    return joined.withColumn(out, F.coalesce("_mapped", carrier)).drop("_mc", "_mf", "_mapped")


def live_legs(t: Tables, ferry: bool = False) -> DataFrame:
    """Legs that are open for sale, with the mapped carrier and the operating one."""
    legs = t["inventory_leg"].where((F.col("Status") != 2) & (F.col("Lid") > 0))
    if not ferry:
        legs = legs.where(F.col("CarrierCode") != fixed.FERRY_CARRIER)
    return remap_carrier(legs.withColumn("OperatingCarrier", F.col("CarrierCode")), t["carrier_mapping"])


def is_chartered(carrier: str = "OperatingCarrier", flight: str = "FlightNumber") -> Column:
    return F.when(F.concat(carrier, flight).isin(list(fixed.CHARTERED)), "Y").otherwise("N")


def drop_charters(legs: DataFrame, chartered: DataFrame) -> DataFrame:
    return legs.join(chartered.select("InventoryLegID"), "InventoryLegID", "left_anti")


def bookings(t: Tables, window: Window | None, statuses: tuple[int, ...] | None, hours: int = 0) -> DataFrame:
    """Bookings of a window.  ``hours`` shifts the stored time before testing it."""
    out = t["booking"]
    if window is not None:
        out = window.shift(-hours).of(out, "BookingDate")
    if statuses is not None:
        out = out.where(F.col("Status").isin(list(statuses)))
    return out


BOOKING_COLUMNS = ("BookingID", "BookingDate", "Status", "CreatedAgentID")
SEGMENT_COLUMNS = (
    "PassengerID", "SegmentID", "JourneyNumber", "SegmentNumber", "FareJourneyType", "DepartureDate",
    "DepartureStation", "ArrivalStation", "International", "FareClassOfService", "ProductClassCode",
)


def booked_segments(t: Tables, booked: DataFrame, segments: DataFrame | None = None) -> DataFrame:
    """Booking, passenger and segment of the given bookings, whether flown or not.

    The joins run from the windowed bookings outwards, so each step only moves the
    rows the window keeps.
    """
    segments = t["passenger_journey_segment"] if segments is None else segments
    passengers = t["booking_passenger"].select("PassengerID", "BookingID")
    return booked.select(*BOOKING_COLUMNS).join(passengers, "BookingID").join(segments.select(*SEGMENT_COLUMNS), "PassengerID")


def flown(t: Tables, held: DataFrame, legs: DataFrame, leg_columns: tuple[str, ...] = ("CarrierCode",), of: DataFrame | None = None) -> DataFrame:
    """Segments with their leg and inventory leg, in one row per flown leg.

    Legs come last and the columns kept are pruned by use. ``of``: the stored frame that the segments
    come from, of which only the range of passenger ids is read.
    """
    own = t["passenger_journey_leg"].select("PassengerID", "SegmentID", "InventoryLegID")
    if of is not None:
        own = in_range(own, of, "PassengerID")
    return held.join(own, ["PassengerID", "SegmentID"]).join(legs.select("InventoryLegID", *leg_columns), "InventoryLegID")


def passenger_fact(t: Tables, booked: DataFrame, legs: DataFrame, leg_columns: tuple[str, ...] = ("CarrierCode",),
                   segments: DataFrame | None = None) -> DataFrame:
    """Booking, passenger, segment, leg and inventory leg in one row per flown leg."""
    return flown(t, booked_segments(t, booked, segments), legs, leg_columns)


#: Least and greatest id of stored frames and their number of rows, as long as these are in use.
_ends: WeakKeyDictionary[DataFrame, dict[str, tuple]] = WeakKeyDictionary()

PEOPLE_ROWS = 1 << 20  # keys sent to every task at most; of more, blocks of ids are
BLOCKS = 1 << 16  # blocks that the ids of a stored frame fall into at most


def _end(people: DataFrame, key: str) -> tuple:
    known = _ends.setdefault(people, {})
    if key not in known:
        known[key] = people.agg(F.min(key), F.max(key), F.count("*")).first()
    return known[key]


def in_range(rows: DataFrame, people: DataFrame, key: str) -> DataFrame:
    """Rows of a fact from the least to the greatest id of ``people``, a stored frame.

    Ids are given out in order, so a window's passengers lie in a narrow range of them. Its ends
    are literals on the scan, where they skip files and row groups.
    """
    low, high, _ = _end(people, key)
    return rows.where(F.lit(False)) if low is None else rows.where(F.col(key).between(low, high))


def within(rows: DataFrame, people: DataFrame, *keys: str) -> DataFrame:
    """Rows of a fact whose keys occur in ``people``, a stored frame of a report's window.

    After :func:`in_range` a semi-join keeps the very keys; it stands below whatever is aggregated,
    so history outside the window is neither shuffled nor summed.
    """
    return in_range(rows, people, keys[0]).join(people.select(*keys), list(keys), "left_semi")


def around(rows: DataFrame, people: DataFrame, *keys: str, few: bool = False) -> DataFrame:
    """As :func:`within`, for rows that are summed by ``keys`` and meet ``people`` by them afterwards.

    At most PEOPLE_ROWS keys are sent to every task, and no row moves before the sums. More keys meet the
    rows by a shuffle. With ``few`` sums, narrower than the rows they come from, the blocks of ids that hold a
    key are sent instead: tasks add up what they read, and other people's sums stay until they meet ``people``.
    """
    kept, (low, high, n) = in_range(rows, people, keys[0]), _end(people, keys[0])
    if n <= PEOPLE_ROWS:
        return kept.join(F.broadcast(people.select(*keys)), list(keys), "left_semi")
    if not few:
        return within(rows, people, *keys)
    block = F.expr(f"`{keys[0]}` div {(high - low) // BLOCKS + 1}L")
    blocks = people.select(block.alias("_block")).distinct()
    return kept.withColumn("_block", block).join(F.broadcast(blocks), "_block", "left_semi").drop("_block")


def journey_charges(t: Tables, known_types: bool = True, of: DataFrame | None = None, few: bool = False) -> DataFrame:
    """Segment charges with their signed ``Amount``; of types in the matrix only, by default.

    ``of``: a stored frame with the PassengerID and SegmentID whose charges are wanted, as :func:`around` keeps them
    for ``few`` sums or many.
    """
    charges = t["passenger_journey_charge"].select(
        "PassengerID", "SegmentID", "ChargeNumber", "ChargeType", "ChargeCode", "ChargeAmount", "CurrencyCode", "CreatedDate"
    )
    if of is not None:
        charges = around(charges, of, "PassengerID", "SegmentID", few=few)
    return signed_by_matrix(charges, t["charge_type_matrix"], "inner" if known_types else "left")


def segment_sums(charges: DataFrame, measures: dict[str, Column], by_day: bool = True) -> DataFrame:
    """Charge sums per segment, currency and (``by_day``) charge day.

    Charges bounded by a window lie where they are read or are dealt by segment, so this adds no exchange
    of charges, and the join that follows moves one narrow row per segment instead of one per charge.
    """
    keys = ["PassengerID", "SegmentID", "CurrencyCode"]
    days = [day("CreatedDate").alias("CreatedDay")] if by_day else []
    return charges.groupBy(*keys, *days).agg(*[e.alias(n) for n, e in measures.items()])


def fee_lines(t: Tables, of: DataFrame | None = None) -> DataFrame:
    """Fees with the charges booked under the fee's own code.

    ``of``: a stored frame with the PassengerID whose fees are wanted.
    """
    fee = t["passenger_fee"].select("PassengerID", "FeeNumber", F.col("FeeCode"), F.col("InventoryLegID").alias("FeeLegID"))
    charge = t["passenger_fee_charge"].select(
        "PassengerID", "FeeNumber", F.col("ChargeCode").alias("FeeCode"), "ChargeType", "ChargeAmount", "CurrencyCode", "CreatedDate"
    )
    if of is not None:
        fee, charge = within(fee, of, "PassengerID"), within(charge, of, "PassengerID")
    return fee.join(charge, ["PassengerID", "FeeNumber", "FeeCode"])


def passenger_fees(passengers: DataFrame, fees: DataFrame, first_segment: bool = True, tied: Column | None = None) -> DataFrame:
    """Each fee on its segments, in one pass; ``Loose`` tells fees without a leg.

    A fee tied to a flown leg (``tied``: its leg is not 0) goes there. A fee tied to none goes
    to the first segment, or with ``first_segment`` unset to all of journey 1.
    """
    loose = F.col("FeeLegID") == 0
    tied = F.col("FeeLegID") != 0 if tied is None else tied
    first = F.col("JourneyNumber") == 1
    if first_segment:
        first = first & (F.col("SegmentNumber") == 1)
    here = (tied & (F.col("FeeLegID") == F.col("InventoryLegID"))) | (loose & first)
    return passengers.join(fees, "PassengerID").where(here).withColumn("Loose", loose).drop("FeeLegID")


def point_of_sale(t: Tables, held: DataFrame) -> DataFrame:
    """Country and currency of each passenger's first station, of :func:`booked_segments`."""
    first = held.where((F.col("JourneyNumber") == 1) & (F.col("SegmentNumber") == 1)).select("BookingID", "PassengerID", "DepartureStation")
    station = t["station"].select(F.col("StationCode").alias("DepartureStation"), "CountryCode")
    country = t["country"].select(
        "CountryCode", F.col("Name").alias("POSCountry"), F.col("DefaultCurrencyCode").alias("POSCurrency")
    )
    return first.join(station, "DepartureStation").join(country, "CountryCode").select(
        "BookingID", "PassengerID", F.col("CountryCode").alias("POSCountryCode"), "POSCountry", "POSCurrency"
    )


def with_station(df: DataFrame, stations: DataFrame, code: str, how: str = "left", **columns: str) -> DataFrame:
    """Station attributes in one role: ``with_station(df, st, 'DepartureStation', DepCountry='CountryCode')``."""
    key = f"_st_{code}"
    side = stations.select(F.col("StationCode").alias(key), *[F.col(src).alias(out) for out, src in columns.items()])
    return df.join(side, F.col(code) == F.col(key), how).drop(key)


def with_country(df: DataFrame, countries: DataFrame, code: str, name: str, how: str = "left") -> DataFrame:
    key = f"_ct_{name}"
    side = countries.select(F.col("CountryCode").alias(key), F.col("Name").alias(name))
    return df.join(side, F.col(code) == F.col(key), how).drop(key)


def first_payment(payments: DataFrame, of: DataFrame | None = None) -> DataFrame:
    """Method of the lowest-numbered payment of each booking; map-side combined.

    ``of``: a stored frame with the BookingID whose payments are wanted.
    """
    rows = payments.withColumnRenamed("ReferenceID", "BookingID")
    if of is not None:
        rows = within(rows, of, "BookingID")
    first = rows.groupBy("BookingID").agg(F.min_by("PaymentMethodCode", "PaymentID").alias("PaymentMethodCode"))
    return by_rows(first, payments if of is None else _end(of, "BookingID")[2])


def travel_documents(t: Tables, name: str) -> DataFrame:
    """Distinct countries, as ``name``, of each passenger's travel documents; dealt by passenger, as their readers are."""
    documents = t["passenger_travel_doc"].select("PassengerID", F.col("Nationality").alias(name))
    return by_rows(documents.repartition("PassengerID").distinct(), t["passenger_travel_doc"])


def contacts(t: Tables) -> DataFrame:
    """Distinct cleaned contacts with the province name where it is known."""
    contact = t["booking_contact"].select(
        "BookingID",
        F.lower("EmailAddress").alias("EmailAddress"),
        F.upper("ProvinceState").alias("_province"),
        F.upper(F.trim("City")).alias("City"),
        F.col("CountryCode").alias("_country"),
        F.upper("FirstName").alias("_first"),
        F.upper("LastName").alias("_last"),
    ).distinct()
    province = t["province_state"].select(
        F.col("CountryCode").alias("_country"), F.col("ProvinceStateCode").alias("_province"), F.col("Name").alias("ProvinceState")
    )
    return contact.join(province, ["_country", "_province"], "left").drop("_country", "_province")


def with_contact(df: DataFrame, t: Tables) -> DataFrame:
    """Contact of the booking whose name is the passenger's, letter case aside."""
    side = contacts(t).withColumnRenamed("BookingID", "_booking")
    test = (
        (F.col("BookingID") == F.col("_booking"))
        & (F.rtrim(F.upper("FirstName")) == F.rtrim("_first"))
        & (F.rtrim(F.upper("LastName")) == F.rtrim("_last"))
    )
    return df.join(side, test, "left").drop("_booking", "_first", "_last")


def island_transfer(passengers: DataFrame, segments: DataFrame) -> DataFrame:
    """Adds the island ferry legs that feed or follow a segment of journey 1 or 2.

    Each ferry leg counts once per segment the passenger has in the report.  That
    multiplicity is carried as ``Weight`` instead of repeating rows.
    """
    ferry = segments.where(
        (F.col("BookingStatus") == "HK") & (F.col("CarrierCode") == fixed.FERRY_CARRIER) & F.col("JourneyNumber").isin(1, 2)
    )
    held = passengers.groupBy("PassengerID").agg(F.count("*").alias("_held"))
    counted = ferry.join(held, "PassengerID").groupBy(
        "PassengerID", "JourneyNumber", "DepartureStation", "ArrivalStation"
    ).agg(F.sum("_held").alias("_w"))

    def side(number: int, near: str) -> DataFrame:
        tag = f"{number}"
        return counted.where(F.col("JourneyNumber") == number).select(
            F.col("PassengerID").alias(f"_p{tag}"), F.col("JourneyNumber").alias(f"_j{tag}"),
            F.col("DepartureStation").alias(f"_d{tag}"), F.col("ArrivalStation").alias(f"_a{tag}"),
            F.col("_w").alias(f"_w{tag}"),
        )

    out = passengers.join(
        side(1, "DepartureStation"),
        (F.col("PassengerID") == F.col("_p1")) & (F.col("JourneyNumber") == F.col("_j1")) & (F.col("ArrivalStation") == F.col("_d1")),
        "left",
    ).join(
        side(2, "ArrivalStation"),
        (F.col("PassengerID") == F.col("_p2")) & (F.col("JourneyNumber") == F.col("_j2")) & (F.col("DepartureStation") == F.col("_a2")),
        "left",
    )
    return (
        out.withColumn("IslandTransfer", F.when(F.col("_w1").isNotNull() | F.col("_w2").isNotNull(), "Y").otherwise("N"))
        .withColumn("DepartureStation2", F.coalesce("_d1", "_d2"))
        .withColumn("ArrivalStation2", F.coalesce("_a1", "_a2"))
        .withColumn("Weight", F.coalesce("_w1", F.lit(1)) * F.coalesce("_w2", F.lit(1)))
        .drop("_p1", "_j1", "_d1", "_a1", "_w1", "_p2", "_j2", "_d2", "_a2", "_w2")
    )
