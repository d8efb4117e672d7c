"""The two views the reports read besides base tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farespan.operators.passengers import in_range, within
from farespan.sources.tables import Tables

SEGMENT_COLUMNS = (
    "PassengerID", "SegmentID", "JourneyNumber", "SegmentNumber", "FareJourneyType",
    "DepartureDate", "DepartureStation", "ArrivalStation", "International",
    "FareClassOfService", "BookingStatus", "CurrencyCode", "CreatedDate", "CreatedAgentID",
)


def segment_view(t: Tables, of: DataFrame | None = None) -> DataFrame:
    """Passenger segments with the carrier, flight and times of their leg.

    ``of``: a stored frame with the PassengerID whose segments are wanted.
    """
    leg = t["passenger_journey_leg"].select("PassengerID", "SegmentID", "InventoryLegID")
    flown = t["inventory_leg"].select(
        "InventoryLegID", "CarrierCode", "FlightNumber", F.col("STDUTC").alias("SegmentSTD")
    )
    segment = t["passenger_journey_segment"].select(*SEGMENT_COLUMNS)
    if of is not None:
        segment, leg = within(segment, of, "PassengerID"), in_range(leg, of, "PassengerID")
    return segment.join(leg, ["PassengerID", "SegmentID"]).join(flown, "InventoryLegID")


def fee_view(t: Tables) -> DataFrame:
    """Passenger fees with the flight they belong to; fees tied to no leg have none."""
    flown = t["inventory_leg"].select(
        "InventoryLegID", "DepartureDate", "CarrierCode", "FlightNumber", "DepartureStation", "ArrivalStation"
    )
    fee = t["passenger_fee"].select("PassengerID", "FeeNumber", "FeeCode", "InventoryLegID")
    return fee.join(flown, "InventoryLegID").drop("InventoryLegID")
