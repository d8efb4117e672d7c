"""Plans over loaded tables, counted self-connections, rates, and the class list."""

import re
from datetime import date, datetime
from decimal import Decimal as D
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from checks.layout import QUERIES, RUN, colocated_facts, loaded_tables
from farespan.functions import windows
from farespan.operators import capacity as cap
from farespan.operators import journeys as jn
from farespan.operators import money as m
from farespan.operators import passengers as px
from farespan.sources import load
from farespan.sources.tables import Tables
from tests.test_traps import flown, grid_tables, rows

SF = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not Path(SF).exists(), reason="driver data not present")


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(autouse=True)
def whole_plans(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    yield
    spark.conf.unset("spark.sql.maxMetadataStringLength")


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


# ---------------------------------------------------------------- loaded tables

@needs_data
def test_facts_of_a_passenger_join_where_they_lie(spark, no_broadcast):
    t = loaded_tables(spark, SF)
    for df, joins in ((colocated_facts(t), 2), (px.fee_lines(t), 1)):
        plan = physical(df)
        assert plan.count("SortMergeJoin") == joins and "Exchange" not in plan
    sums = px.segment_sums(t["passenger_journey_charge"].withColumn("Amount", F.col("ChargeAmount")), {"Fare": m.bucket(m.fare_types())})
    joined = t["passenger_journey_segment"].select("PassengerID", "SegmentID").join(sums, ["PassengerID", "SegmentID"])
    assert "Exchange" not in physical(joined)


@needs_data
def test_codes_are_stored_as_they_are_compared(spark):
    t = loaded_tables(spark, SF)
    for df, test in (
        (t["passenger_journey_charge"].where(m.of_code("KLIA2") & m.of_type(1)), "EqualTo(ChargeCode,KLIA2)"),
        (t["inventory_leg"].where((F.col("CarrierCode") == "AK") & (F.col("FlightNumber") == "326")), "EqualTo(CarrierCode,AK)"),
    ):
        pushed = re.search(r"PushedFilters: \[([^\]]*)\]", physical(df))[1]
        assert test in pushed and "trim" not in physical(df) and "upper" not in physical(df)


@needs_data
@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n.startswith("window_")))
def test_a_window_reads_its_months_alone(spark, name):
    plan = physical(QUERIES[name](spark, SF))
    found = re.search(r"PartitionFilters: \[([^\]]*)\]", plan)[1]
    assert re.search(r"FiledMonth#\d+ (>=|<=) \d{6}", found)


@needs_data
def test_a_report_prunes_months(spark):
    t = loaded_tables(spark, SF)
    booked = px.bookings(t, windows.yesterday(RUN), (2, 3), hours=8)
    assert re.search(r"FiledMonth#\d+ >= 1997\d\d.*FiledMonth#\d+ <= 1997\d\d", physical(booked))


def test_months_of_a_filed_table(spark):
    dates = [datetime(2015, 4, 30, 23, 59), datetime(2015, 5, 1), datetime(2015, 5, 31), datetime(2015, 6, 1), None]
    df = load.filed(spark.createDataFrame([(d,) for d in dates], "BookingDate timestamp_ntz"), "booking")
    assert rows(df, "FiledMonth") == [(201504,), (201505,), (201505,), (201506,), (None,)]
    for window in (windows.previous_month(datetime(2015, 6, 9)), windows.Window(datetime(2015, 5, 1), datetime(2015, 6, 1), False, True), windows.Window(None, datetime(2015, 5, 1))):
        assert rows(window.of(df, "BookingDate"), "BookingDate") == rows(df.where(window.covers("BookingDate")), "BookingDate")


# ---------------------------------------------------------------- self-connections

def crowd(spark, k):
    """k people of one name on one pair of flights, and one who goes on somewhere else."""
    d = datetime
    data = []
    for i in range(k):
        data += [(i, 10 * i, 1, 1, 1, d(2015, 5, 1), "KUL", "BKI", 1, "A"), (i, 10 * i + 1, 2, 1, 1, d(2015, 5, 2), "BKI", "SIN", 2, " A ")]
    data += [(900, 9000, 1, 1, 1, d(2015, 5, 3), "BKI", "HKG", 3, "A"), (901, 9010, 1, 1, 1, d(2015, 5, 1), "KUL", "BKI", 1, "B"), (902, 9020, 1, 1, 1, d(2015, 5, 9), "BKI", "KUL", 1, "A")]
    pax = flown(spark, data).withColumns({c: (F.col("SegmentID") + n).cast("decimal(28,4)") for n, c in enumerate(jn.LEG_MEASURES)})
    legs = spark.createDataFrame([(1, d(2015, 5, 1, 1), d(2015, 5, 1, 3)), (2, d(2015, 5, 2, 9), d(2015, 5, 2, 11)), (3, d(2015, 5, 3, 5), d(2015, 5, 3, 8))], "InventoryLegID long, STDUTC timestamp_ntz, STAUTC timestamp_ntz")
    return pax, legs


def test_counted_self_connections_are_those_of_all_pairs(spark):
    k = 30
    pax, legs = crowd(spark, k)
    keys = ["JourneyType", "TransitTime", "Leg1ArrivalStation", "Leg2ArrivalStation"]
    sums = [f"Leg{n}{c}" for n in (1, 2) for c in jn.LEG_MEASURES]

    def report(df, pairs):
        return rows(df.groupBy(*keys).agg(F.countDistinct("Leg1SegmentID").alias("n"), F.sum(pairs).alias("pairs"), *[F.sum(s).cast("decimal(28,4)").alias(s) for s in sums]), *keys, "n", "pairs", *sums)

    every = jn.self_connect(pax, legs).distinct()
    counted = jn.self_connect_counted(pax, legs)
    assert report(counted, F.col("Pairs")) == report(every, F.lit(1))
    assert every.count() > k * k and counted.count() <= 4 * k + 10


# ---------------------------------------------------------------- rates

def test_rates_go_to_the_amounts(spark, no_broadcast):
    fx = spark.createDataFrame([("MYR", "THB", date(2015, 5, 1), D("4")), ("THB", "THB", date(2015, 5, 1), D("1")), ("ZZZ", "THB", date(2015, 5, 1), D("9"))], "FromCurrencyCode string, ToCurrencyCode string, ConversionDate date, ConversionRate decimal(9,4)")
    df = spark.createDataFrame([("MYR", "THB", D("8"), date(2015, 5, 1)), ("THB", "THB", D("8"), date(2015, 5, 1)), ("PHP", "THB", D("8"), date(2015, 5, 1))], "Home string, cur string, v decimal(18,4), d date")
    out = m.convert(df, fx, ["v"], home="Home", charged="cur", on="d", mode="local", suffix="C")
    assert "Exchange hashpartitioning" not in physical(out) and "BroadcastHashJoin" in physical(out)
    assert [(h, v and float(v)) for h, v in rows(out, "Home", "vC")] == [("MYR", 2.0), ("PHP", None), ("THB", 8.0)]
    wide = m.with_rates(df, fx, ["MYR", "THB"], "cur", "d")
    assert "BroadcastHashJoin" in physical(wide) and rows(wide, "Home", "Rate_MYR") == [(h, D("4.0000")) for h in ("MYR", "PHP", "THB")]


def test_a_large_rate_table_is_not_sent_everywhere(spark, no_broadcast, monkeypatch):
    monkeypatch.setattr(m, "RATE_ROWS", 1)
    fx = spark.createDataFrame([("MYR", "THB", date(2015, 5, d), D("4")) for d in (1, 2)], "FromCurrencyCode string, ToCurrencyCode string, ConversionDate date, ConversionRate decimal(9,4)")
    df = spark.createDataFrame([("THB", date(2015, 5, 1))], "cur string, d date")
    out = m.with_rate(df, fx, "MYR", "cur", "d")
    assert "BroadcastHashJoin" not in physical(out) and rows(out, "Rate") == [(D("4.0000"),)]


# ---------------------------------------------------------------- class list

def test_grid_columns_follow_the_class_table(spark):
    t = grid_tables(spark)
    own = spark.createDataFrame([("Y ",), ("Q",), ("DI",), ("ZZ",), ("Y",), (None,)], "ClassOfServiceCode string")
    t = Tables.from_frames(spark, {**{n: t[n] for n in t}, "class_of_service": own})
    grid = cap.availability_grid(t, F.lit("2015-01-01").cast("timestamp_ntz"), F.lit(1), None)
    assert [c for c in grid.columns if c.endswith("-AU")] == ["DI-AU", "Q-AU", "Y-AU"]
    row = grid.first()
    assert (row["Y-AU"], row["DI-AU"], row["Q-AU"], row["Y"]) == (50, 5, None, 0)
    letters = spark.createDataFrame([(chr(0x4E00 + i),) for i in range(cap.GRID_MOST + 1)], "ClassOfServiceCode string")
    with pytest.raises(ValueError, match="booking classes"):
        cap.grid_classes(letters)
