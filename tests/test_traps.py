"""Small hand-made inputs, one per rule that is easy to get wrong."""

from datetime import date, datetime
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from farespan.functions.windows import Window
from farespan.operators import capacity as cap
from farespan.operators import journeys as jn
from farespan.operators import money as m
from farespan.operators import passengers as px
from farespan.plans import channels, year_on_year
from farespan.plans.routes import fare_parts
from farespan.sources import sinks
from farespan.sources.standin import airline
from farespan.sources.tables import Tables, as_of, normalise

FX = "FromCurrencyCode string, ToCurrencyCode string, ConversionDate date, ConversionRate decimal(9,4)"
CHARGE = "PassengerID long, SegmentID long, ChargeNumber int, ChargeType int, ChargeCode string, ChargeAmount decimal(18,4), CurrencyCode string, CreatedDate timestamp_ntz"
DAY = date(2015, 5, 1)


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


def fx(spark):
    return spark.createDataFrame([("MYR", "THB", DAY, D("4")), ("THB", "MYR", DAY, D("0.25"))], FX)


def test_padding_and_case_are_normalised(spark):
    hubs = spark.createDataFrame([("ak ", " 326 ", "BKI", "KUL", "bkikul", "KK")], "CarrierCode string, FlightNumber string, DepartureStation string, ArrivalStation string, MarketGroup string, Hub string")
    got = normalise("hub_info", hubs)
    assert rows(got, "CarrierCode", "FlightNumber", "MarketGroup") == [("AK", "326", "BKIKUL")]
    flights = spark.createDataFrame([("AK", "326", "BKIKUL", "HUB"), ("AK", "1", "BKIKUL", "hub"), ("AK", "1", "XXXYYY", "hub")], "CarrierCode string, FlightNumber string, p string, b string")
    out = cap.assign_hub(flights, got, "p", F.col("b"))
    assert rows(out, "FlightNumber", "p", "Hub") == [("1", "BKIKUL", "KK"), ("1", "XXXYYY", "hub"), ("326", "BKIKUL", "KK")]


def test_smallest_of_several_hubs_and_reversed_market(spark):
    hubs = spark.createDataFrame([("AK", "1", "KULBKI", "ZZ"), ("AK", "1", "BKIKUL", "AA")], "CarrierCode string, FlightNumber string, MarketGroup string, Hub string")
    flights = spark.createDataFrame([("AK", "1", "BKIKUL")], "CarrierCode string, FlightNumber string, p string")
    assert rows(cap.assign_hub(flights, hubs, "p"), "Hub") == [("AA",)]


def test_repeated_rate_rows_count_once_where_asked(spark):
    df = spark.createDataFrame([("THB", D("8.0000"), DAY)], "cur string, v decimal(18,4), d date")
    twice = fx(spark).unionAll(fx(spark))
    for once, n in ((True, 1), (False, 2)):
        out = m.convert(df, twice, ["v"], home="MYR", charged="cur", on="d", mode="local", suffix="C", once=once)
        assert [float(r[0]) for r in rows(out, "vC")] == [2.0] * n


def test_stand_in_rates_differ_by_direction_and_ages_spread(spark):
    t = airline(spark, "/root/testdata/sf0.001")
    x, y = t["fx_history"].alias("x"), t["fx_history"].alias("y")
    same = (F.col("x.FromCurrencyCode") == F.col("y.ToCurrencyCode")) & (F.col("x.ToCurrencyCode") == F.col("y.FromCurrencyCode")) & (F.col("x.ConversionDate") == F.col("y.ConversionDate"))
    differ, n = x.join(y, same).agg(F.sum((F.col("x.ConversionRate") != F.col("y.ConversionRate")).cast("int")), F.count("*")).first()
    assert differ > n / 2
    born = t["booking_passenger"].agg(F.min(F.year("DOB")), F.max(F.year("DOB")), F.sum(F.col("DOB").isNull().cast("int"))).first()
    assert born[0] < 1900 and born[1] > 1980 and born[2] > 0


def test_missing_rate_by_mode(spark):
    data = [("A", "THB", D("8.0000"), DAY), ("B", "USD", D("8.0000"), DAY), ("C", "MYR", D("8.0000"), DAY)]
    df = spark.createDataFrame(data, "id string, cur string, v decimal(18,4), d date")

    def run(mode, **kw):
        out = m.convert(df, fx(spark), ["v"], home="MYR", charged="cur", on="d", mode=mode, suffix="C", **kw)
        return [None if r[1] is None else float(r[1]) for r in rows(out, "id", "vC")]

    assert run("local") == run("myr") == run("booking_date") == [2.0, None, 8.0]
    assert run("myr", on_missing=1) == [2.0, 8.0, 8.0]
    assert run("div_null") == [2.0, None, None]
    assert run("div_one") == [2.0, 8.0, 8.0]
    assert run("mul_one") == [2.0, 8.0, 8.0]


def test_one_join_for_several_currencies_equals_single_joins(spark):
    df = spark.createDataFrame([("THB", DAY), ("MYR", DAY), ("USD", DAY)], "cur string, d date")
    wide = m.with_rates(df, fx(spark), ["MYR", "THB"], "cur", "d")
    one = m.with_rate(m.with_rate(df, fx(spark), "MYR", "cur", "d", "a"), fx(spark), "THB", "cur", "d", "b")
    assert rows(wide, "cur", "Rate_MYR", "Rate_THB") == rows(one, "cur", "a", "b")


def charges(spark, data):
    return spark.createDataFrame([(1, 1, n, t, c, D(a), "MYR", datetime(2015, 5, 1)) for n, (t, c, a) in enumerate(data)], CHARGE)


def test_fan_out_of_unaggregated_buckets(spark):
    df = charges(spark, [(0, "F", "10"), (0, "F", "20"), (1, "D", "1"), (1, "D", "2"), (4, "FUEL", "5")])
    safe = m.segment_charges(df, {"fare": fare_parts()}, {"fuel": m.fuel()}).first()
    assert (safe.fare, safe.fuel) == (D("27.0000"), D("5.0000"))
    # Four joined rows: each fare with each discount, and the fuel on all of them.
    reference = m.segment_charges(df, {"fare": fare_parts()}, {"fuel": m.fuel()}, fanout="reference").first()
    assert (reference.fare, reference.fuel) == (D("54.0000"), D("20.0000"))


def test_bucket_without_rows_is_null_only_where_asked(spark):
    df = charges(spark, [(0, "F", "10")]).withColumn("Amount", F.col("ChargeAmount"))
    got = df.agg(m.bucket(m.fuel()), m.bucket_or_null(m.fuel()), m.bucket(m.fare_types(), m.of_code("F"))).first()
    assert (got[0], got[1], got[2]) == (0, None, 20)


def test_null_plus_sum_is_null(spark):
    df = spark.createDataFrame([(D("1"), None)], "a decimal(10,2), b decimal(10,2)")
    assert df.agg(F.sum("a") + F.sum("b")).first()[0] is None


def fees(spark):
    return Tables.from_frames(spark, {
        "passenger_fee": spark.createDataFrame([(1, 1, "BAGS", 7), (1, 2, "BAGS", 0)], "PassengerID long, FeeNumber long, FeeCode string, InventoryLegID long"),
        "passenger_fee_charge": spark.createDataFrame(
            [(1, 1, "BAGS", 6, D("5"), "MYR", datetime(2015, 5, 1)), (1, 2, "BAGS", 6, D("3"), "MYR", datetime(2015, 5, 1)), (1, 2, "OTHER", 6, D("9"), "MYR", datetime(2015, 5, 1))],
            "PassengerID long, FeeNumber long, ChargeCode string, ChargeType int, ChargeAmount decimal(18,4), CurrencyCode string, CreatedDate timestamp_ntz"),
    })


def test_fees_by_leg_and_by_booking(spark):
    t = fees(spark)
    pax = spark.createDataFrame([(1, 10, 1, 1, 7), (1, 11, 1, 2, 8), (2, 12, 1, 1, 7)], "PassengerID long, SegmentID long, JourneyNumber int, SegmentNumber int, InventoryLegID long")
    lines = px.fee_lines(t)
    assert rows(px.passenger_fees(pax, lines), "SegmentID", "ChargeAmount", "Loose") == [(10, D("3.0000"), True), (10, D("5.0000"), False)]
    loose = px.passenger_fees(pax, lines, first_segment=False).where("Loose")
    assert rows(loose, "SegmentID") == [(10,), (11,)]
    assert rows(px.passenger_fees(pax, lines, tied=F.col("FeeLegID") > 7), "Loose") == [(True,)]


def test_row_pick_is_by_currency_with_nulls_first(spark):
    df = spark.createDataFrame([("f", "USD"), ("f", "MYR"), ("f", None)], "f string, c string")
    assert rows(cap.first_row(df, ["f"], ["c"]), "RowNo", "c") == [(1, None), (2, "MYR"), (3, "USD")]


def test_forward_ask_equals_the_self_join_and_pools_missing_keys(spark):
    data = [("AK", "MYR", date(2015, 1, 1), 1), ("AK", "MYR", date(2015, 6, 30), 2), ("AK", "MYR", date(2015, 7, 1), 4), ("AK", None, date(2015, 1, 1), 8)]
    df = spark.createDataFrame(data, "CarrierCode string, AskCurrency string, DepartureDate date, Ask long")
    got = rows(cap.forward_ask(df, ["CarrierCode", "AskCurrency"]), "Date", "Ask")
    assert got == [(None, D(8)), (date(2015, 1, 1), D(3)), (date(2015, 6, 30), D(6)), (date(2015, 7, 1), D(4))]


def test_cabin_capacity_of_an_economy_only_aircraft(spark):
    legs = spark.createDataFrame([(1, 330, "F", 377), (2, 330, "A", 377), (3, 999, "A", 100)], "id int, EquipmentType int, EquipmentTypeSuffix string, Capacity int")
    got = rows(cap.cabin_capacity(legs, economy_only={(330, "F"): 12}), "id", "Cabin", "Capacity")
    assert got == [(1, "Economy", 365), (1, "Premium", 0), (2, "Economy", 365), (2, "Premium", 12), (3, "Economy", 0), (3, "Premium", 0)]


def grid_tables(spark):
    leg = (1, "K1", datetime(2015, 5, 1), "AK", "326", "", "KUL", "BKI", 1, 180, 180, 180)
    return Tables.from_frames(spark, {
        "inventory_leg": spark.createDataFrame([leg], "InventoryLegID long, InventoryLegKey string, DepartureDate timestamp_ntz, CarrierCode string, FlightNumber string, OpSuffix string, DepartureStation string, ArrivalStation string, Status int, Lid int, Capacity int, AdjustedCapacity int"),
        "inventory_leg_class": spark.createDataFrame([(1, "Y", 0, 50, 60), (1, "M", 1, 30, 10), (1, "DI", 2, 5, 9)], "InventoryLegID long, ClassOfService string, ClassNest int, ClassAU int, ClassSold int"),
        "city_pair": spark.createDataFrame([("KUL", "BKI", "BKI-KUL")], "DepartureStation string, ArrivalStation string, CityPairGroup string"),
        "carrier_mapping": spark.createDataFrame([("AK", "326", "D7")], "CarrierCode string, FlightNumber string, MappedCarrier string"),
    })


def test_grid_floors_at_zero_and_leaves_absent_classes_null(spark):
    row = cap.availability_grid(grid_tables(spark), F.lit("2015-01-01").cast("timestamp_ntz"), F.lit(1)).first()
    assert (row["CarrierCode"], row["Y"], row["Y-AU"], row["M"], row["DI"], row["DI-AU"]) == ("D7", 0, 50, 20, 0, 5)
    assert row["B"] is None and row["B-AU"] is None and row["SeatSold"] == 79


def flown(spark, data):
    zero = D("0.0000")
    schema = ("PassengerID long, SegmentID long, JourneyNumber int, SegmentNumber int, FareJourneyType int, DepartureDate timestamp_ntz, DepartureStation string, ArrivalStation string, "
              "CarrierCode string, FlightNumber string, InventoryLegID long, FirstName string, LastName string, DOB date, Nationality string, AgeGroup string, BaseFareMYR decimal(28,4), FuelMYR decimal(28,4), ConnectionMYR decimal(28,4)")
    full = [(p, s, j, n, ft, dep, a, b, "AK", "1", leg, fn, "L", date(1980, 1, 1), "MY", "x", zero, zero, zero) for p, s, j, n, ft, dep, a, b, leg, fn in data]
    return spark.createDataFrame(full, schema)


def test_self_connection_within_two_days_only_and_never_a_return(spark):
    d = datetime
    legs = spark.createDataFrame([(1, d(2015, 5, 1, 1), d(2015, 5, 1, 3))], "InventoryLegID long, STDUTC timestamp_ntz, STAUTC timestamp_ntz")
    pax = flown(spark, [
        (1, 1, 1, 1, 1, d(2015, 5, 1), "KUL", "BKI", 1, "A "), (2, 2, 1, 1, 1, d(2015, 5, 3), "BKI", "SIN", 1, " A"),
        (3, 3, 1, 1, 1, d(2015, 5, 4), "BKI", "SIN", 1, "A"), (4, 4, 1, 1, 1, d(2015, 5, 1), "BKI", "KUL", 1, "A"),
    ])
    pairs = jn.self_connect(pax, legs)
    assert rows(pairs, "Leg1SegmentID", "Leg2SegmentID", "JourneyType") == [
        (1, 2, "SELF-CONNECTING"), (2, None, "POINT TO POINT"), (3, None, "POINT TO POINT"), (4, None, "POINT TO POINT"),
    ]


def test_lone_through_leg_is_ferry_or_error(spark):
    d = datetime
    legs = spark.createDataFrame([(1, "AK", d(2015, 5, 1, 1), d(2015, 5, 1, 3)), (9, "BF", d(2015, 5, 1, 5), d(2015, 5, 1, 6))], "InventoryLegID long, CarrierCode string, STDUTC timestamp_ntz, STAUTC timestamp_ntz")
    leg_rows = [(1, 1, 1, 1), (1, 2, 1, 9), (2, 3, 1, 1)]
    t = Tables.from_frames(spark, {"passenger_journey_leg": spark.createDataFrame(leg_rows, "PassengerID long, SegmentID long, JourneyNumber int, InventoryLegID long"), "inventory_leg": legs})
    pax = flown(spark, [(1, 1, 1, 1, 4, d(2015, 5, 1), "KUL", "BKI", 1, "A"), (2, 3, 1, 1, 4, d(2015, 5, 1), "KUL", "BKI", 1, "B")])
    out = jn.mark_ferry(jn.fly_thru(pax, t["inventory_leg"]), t)
    assert rows(out, "PassengerID", "JourneyType") == [(1, "FERRY"), (2, "ERROR")]
    shown = out.groupBy("JourneyType").count().union(spark.createDataFrame([("POINT TO POINT", 1)], "JourneyType string, count long"))
    assert sorted(r[0] for r in shown.select(jn.journey_label()).collect()) == ["EXCEPTION", "POINT TO POINT", "POINT TO POINT"]


def test_island_transfer_counts_as_repeated_rows_would(spark):
    seg = spark.createDataFrame(
        [(1, 1, 1, "KUL", "LGK", "AK", "HK"), (1, 2, 2, "LGK", "KUL", "AK", "HK"), (1, 3, 1, "LGK", "ISL", "BF", "HK")],
        "PassengerID long, SegmentID long, JourneyNumber int, DepartureStation string, ArrivalStation string, CarrierCode string, BookingStatus string")
    out = px.island_transfer(seg.where("CarrierCode <> 'BF'").drop("CarrierCode", "BookingStatus"), seg)
    assert rows(out, "SegmentID", "IslandTransfer", "ArrivalStation2", "Weight") == [(1, "Y", "ISL", 2), (2, "N", None, 1)]


def test_last_year_follows_other_rules(spark):
    snaps = year_on_year.snapshots(__import__("farespan.functions.windows", fromlist=["x"]).year_on_year(datetime(2015, 10, 22)))
    assert snaps[""].confirmed_only and not snaps["Y1"].confirmed_only and not snaps["Y1M"].confirmed_only
    assert "G1" in snaps[""].premium and "G1" in snaps["Y1"].premium and "G1" not in snaps["Y1M"].premium
    assert snaps["Y1"].by_charge_number and not snaps[""].by_charge_number


def test_as_of_date(spark):
    t = Tables.from_frames(spark, {"download_date": spark.createDataFrame([(DAY,)], "DownloadDate date")})
    assert as_of(t) == DAY


def test_window_bounds_reach_the_scan(spark, tmp_path):
    spark.createDataFrame([(1, datetime(2015, 5, 1))], "BookingID long, BookingDate timestamp_ntz").write.parquet(str(tmp_path / "booking.parquet"))
    t = Tables.from_parquet(spark, str(tmp_path))
    df = px.bookings(t, Window(datetime(2015, 4, 30), datetime(2015, 5, 2)), None, hours=8)
    assert df.count() == 1
    assert "PushedFilters: [IsNotNull(BookingDate), GreaterThanOrEqual(BookingDate" in df._jdf.queryExecution().executedPlan().toString()


def test_stage_save_export_and_drop(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    staged = sinks.stage(df, "unit")
    assert rows(staged, "id", "v") == [(1, "a"), (2, "b")]
    sinks.drop_staged(staged)
    out = str(tmp_path / "out")
    sinks.save(df, out)
    sinks.save(df.limit(1), out)
    assert spark.read.parquet(out).count() == 1
    sinks.export_dim(df, ["v"], out)
    assert spark.read.parquet(out).columns == ["v"]


def test_channel_dimensions(spark):
    t = Tables.from_frames(spark, {
        "city_pair": spark.createDataFrame([("KUL", "BKI", 0), ("KUL", "SIN", 1), ("A", "B", None)], "DepartureStation string, ArrivalStation string, InternationalFlag int"),
        "station": spark.createDataFrame([("KUL", "MY", "x")], "StationCode string, CountryCode string, ShortName string"),
        "country": spark.createDataFrame([("MY", "Malaysia", "MYR")], "CountryCode string, Name string, DefaultCurrencyCode string"),
    })
    dims = channels.channel_dimensions(t)
    assert rows(dims["city_pair"], "ArrivalStation", "DomInt") == [("B", "DOM"), ("BKI", "DOM"), ("SIN", "INT")]
    assert dims["station"].columns == ["StationCode", "CountryCode"] and dims["country"].columns == ["CountryCode", "Name"]


def test_bucketed_facts_join_without_moving(spark, tmp_path):
    spark.sql("DROP TABLE IF EXISTS fs_seg")
    spark.sql("DROP TABLE IF EXISTS fs_chg")
    for name in ("fs_seg", "fs_chg"):
        df = spark.range(0, 1000).select(F.col("id").alias("PassengerID"), (F.col("id") % 7).alias("SegmentID"))
        df.write.mode("overwrite").option("path", str(tmp_path / name)).bucketBy(4, "PassengerID", "SegmentID").sortBy("PassengerID", "SegmentID").saveAsTable(name)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table("fs_seg").join(spark.table("fs_chg"), ["PassengerID", "SegmentID"])
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == 1000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE IF EXISTS fs_seg")
        spark.sql("DROP TABLE IF EXISTS fs_chg")


def test_staging_folder_is_named_on_a_cluster():
    from types import SimpleNamespace

    from farespan.sources.sinks import staging_dir

    conf = {}
    cluster = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: conf.get(key, default)), sparkContext=SimpleNamespace(master="spark://host:7077"))
    with pytest.raises(ValueError):
        staging_dir(cluster)
    conf["spark.checkpoint.dir"] = "hdfs://shared/stage/"
    assert staging_dir(cluster) == "hdfs://shared/stage"
