"""What the operators and the stored tables move, write and spill."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from checks import layout, operators, reports
from farespan.operators import channels as ch
from farespan.operators import passengers as px
from farespan.sources import load, sinks, standin, tables
from farespan.sources.tables import Tables
from tests.test_traps import rows

SF = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not Path(SF).exists(), reason="driver data not present")


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def payments(spark):
    data = [(1, 7, "MS"), (1, 3, "VS"), (2, 9, "CA"), (2, 10, "ZZ"), (None, 1, "AX"), (3, 4, None)]
    return spark.createDataFrame(data, "ReferenceID long, PaymentID long, PaymentMethodCode string")


def test_first_payment_of_all_bookings_or_of_the_stored_ones(spark):
    every = px.first_payment(payments(spark))
    assert sorted(map(tuple, every.select("BookingID", "PaymentMethodCode").collect()), key=str) == [(1, "VS"), (2, "CA"), (3, None), (None, "AX")]
    held = spark.createDataFrame([(2,), (3,), (9,)], "BookingID long")
    assert rows(px.first_payment(payments(spark), held), "BookingID", "PaymentMethodCode") == [(2, "CA"), (3, None)]


def charges(spark):
    data = [(p, s, "MYR", "FARE", 0, p) for p in range(-3, 40) for s in (1, 2)] * 2 + [(None, 1, "MYR", "FARE", 0, 9), (5, None, "MYR", "FARE", 0, 9)]
    row = "PassengerID long, SegmentID long, CurrencyCode string, ChargeCode string, ChargeType int, Amount long"
    return spark.createDataFrame(data, row).withColumn("Amount", F.col("Amount").cast("decimal(18,4)"))


@pytest.mark.parametrize("most, blocks", [(100, 4), (2, 4), (2, 100)])
def test_charges_are_summed_where_they_are_read(spark, monkeypatch, most, blocks):
    """Whether a window's segments or blocks of ids are sent out, its segments get the same sums, and no charge moves before them."""
    held = [(-3, 1), (5, 2), (5, 2), (17, 1), (33, 2), (None, 1), (6, None), (900, 1)]
    held = spark.createDataFrame(held, "PassengerID long, SegmentID long").persist()
    keys = ["PassengerID", "SegmentID"]
    sums = {"Fare": F.sum("Amount")}
    want = held.join(px.segment_sums(px.within(charges(spark), held, *keys), sums, by_day=False), keys, "left")
    monkeypatch.setattr(px, "PEOPLE_ROWS", most)
    monkeypatch.setattr(px, "BLOCKS", blocks)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = px.segment_sums(px.around(charges(spark), held, *keys, few=True), sums, by_day=False)
        plan = physical(got)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
    moved = [line for line in plan.splitlines() if "Exchange hashpartitioning(PassengerID" in line]
    assert len(moved) == 1 and plan.index("partial_sum") > plan.index("Exchange hashpartitioning(PassengerID")
    assert sorted(map(str, held.join(got, keys, "left").collect())) == sorted(map(str, want.collect()))
    held.unpersist()


def test_a_join_on_more_keys_takes_rows_dealt_by_passenger(spark):
    """Fees that met a window's passengers lie by passenger; joining them fee by fee moves neither side again."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fee = spark.range(50).selectExpr("id div 3 AS PassengerID", "id AS FeeNumber")
        people = spark.range(9).selectExpr("id AS PassengerID")
        near = [fee.join(people, "PassengerID", "left_semi") for _ in range(2)]
        plan = physical(near[0].join(near[1], ["PassengerID", "FeeNumber"]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning(PassengerID") >= 2 and "Exchange hashpartitioning(PassengerID#" in plan
    assert not [line for line in plan.splitlines() if "Exchange hashpartitioning" in line and "FeeNumber" in line.split("hashpartitioning")[1].split(")")[0]]


# ---------------------------------------------------------------- stored tables

@needs_data
def test_a_query_stores_the_tables_it_reads_alone(spark, tmp_path):
    here = tmp_path / "sf"
    here.mkdir()
    for f in Path(SF).iterdir():
        (here / f.name).symlink_to(f)
    assert layout.QUERIES["export_station"](spark, str(here)).count() == 25
    schema = layout._loaded[spark.sparkContext.applicationId, str(here)][0]
    stored = {r.tableName for r in spark.sql(f"SHOW TABLES IN {schema}").collect()}
    assert "station" in stored and not stored & {"booking", "inventory_leg", *load.BY_PASSENGER}


@needs_data
def test_line_items_move_once_before_they_become_charges(spark):
    assert "Exchange" not in physical(standin.derive(spark, SF, "passenger_journey_charge"))
    plan = physical(standin.unstored(spark, SF, 3)["passenger_journey_charge"])
    assert plan.count("Exchange hashpartitioning") == 1 and plan.index("Generate explode") < plan.index("Exchange hashpartitioning")


def test_a_bucket_is_one_file_in_order(spark, tmp_path):
    df = spark.range(0, 4000).selectExpr("pmod(id * 7919, 1000) AS PassengerID", "id AS FeeNumber").repartition(5)
    spark.sql("DROP SCHEMA IF EXISTS one_file CASCADE")
    load.create(spark, "one_file", str(tmp_path / "one_file"))
    before = spark.conf.get(load.WRITERS, "0")
    load.store(df, "passenger_fee", "one_file", 4, str(tmp_path / "one_file"))
    assert spark.conf.get(load.WRITERS, "0") == before
    files = sorted(str(f) for f in (tmp_path / "one_file" / "passenger_fee").glob("*.parquet"))
    assert len(files) == 4 and spark.table("one_file.passenger_fee").count() == 4000
    for f in files:
        ids = [r[0] for r in spark.read.parquet(f).select("PassengerID").coalesce(1).collect()]
        assert ids == sorted(ids)


# ---------------------------------------------------------------- reports

@needs_data
def test_channel_reports_move_a_segment_once_to_be_counted(spark):
    with sinks.staging_scope():
        plan = physical(reports.report_queries()["report_premium_flex_monthly"](spark, SF))
        dealt = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line and "PremFlex" in line]
        assert len(dealt) == 1 and "SegmentID" not in dealt[0]


@needs_data
def test_converted_charges_move_once(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = physical(operators.QUERIES["fx_local"](spark, SF))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    lines = plan.splitlines()
    at = next(i for i, line in enumerate(lines) if "Scan parquet" in line and "ChargeAmount" in line)
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    over, least = [], depth(lines[at])
    for line in lines[:at][::-1]:
        if depth(line) < least:
            over, least = [*over, line], depth(line)
    moves = [line for line in over if "Exchange hashpartitioning" in line]
    assert len([line for line in moves if "CarrierCode" not in line]) == 1


@needs_data
def test_booking_date_analysis_moves_rows_before_they_are_labelled(spark):
    with sinks.staging_scope():
        plan = physical(reports.report_queries()["report_booking_date_analysis"](spark, SF))
        dealt = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line and "Nationality" in line]
        assert len(dealt) == 1 and "REPARTITION_BY_COL" in dealt[0]


@needs_data
def test_fee_lines_move_once_for_equal_ones_and_their_sum(spark):
    with sinks.staging_scope():
        plan = physical(reports.report_queries()["report_ancillary_revenue"](spark, SF))
        dealt = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line and "SegmentID" in line and "FeeNumber" in line]
        assert len(dealt) == 1


# ---------------------------------------------------------------- what passes through the driver

def people_tables(spark, tmp_path):
    bookings = spark.createDataFrame([(1,), (2,), (3,), (None,)], "BookingID long")
    passengers = spark.createDataFrame([(1, "MY"), (2, "TH"), (3, None), (None, "SG")], "PassengerID long, Nationality string")
    documents = [(1, "OT"), (1, "OT"), (1, "CN"), (2, None), (4, "HK"), (None, "MO")]
    documents = spark.createDataFrame(documents, "PassengerID long, Nationality string")
    stored = {"booking": bookings, "payment": payments(spark), "booking_passenger": passengers, "passenger_travel_doc": documents}
    for name, df in stored.items():
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    return Tables.from_parquet(spark, str(tmp_path))


@pytest.mark.parametrize("most, sent", [(3, False), (1 << 20, True)])
@pytest.mark.parametrize("name, want", [
    ("first_payment_method", {"Others": 2, "Credit Card": 1, "Cash": 1}), ("passport_country", {"MY": 1, "CN": 1, "TH": 1, None: 1, "SG": 1}),
])
def test_tables_of_many_rows_are_not_sent_by_the_size_of_their_files(spark, tmp_path, monkeypatch, most, sent, name, want):
    monkeypatch.setattr(tables, "SENT_ROWS", most)
    out = getattr(operators, name)(people_tables(spark, tmp_path))
    assert ("BroadcastHashJoin" in physical(out)) == sent
    assert {r[0]: r[1] for r in out.collect()} == want


@pytest.mark.parametrize("how, distinct, n", [("inner", False, 5), ("left", False, 7), ("left", True, 5)])
def test_many_agents_meet_the_rows_by_a_shuffle(spark, tmp_path, monkeypatch, how, distinct, n):
    roles = [(1, "A"), (1, "B"), (2, "A"), (2, "A"), (None, "A"), (4, None)]
    spark.createDataFrame(roles, "AgentID long, RoleCode string").write.parquet(f"{tmp_path}/agent_role.parquet")
    agents = [(1, "X", "KUL"), (2, "Y", "CGK"), (4, "Z", None), (5, "Z", None), (None, "X", "KUL")]
    spark.createDataFrame(agents, "AgentID long, OrganizationCode string, LocationCode string").write.parquet(f"{tmp_path}/agent.parquet")
    t = Tables.from_parquet(spark, str(tmp_path))
    booked = spark.createDataFrame([(1,), (2,), (4,), (9,), (None,)], "CreatedAgentID long")
    few = ch.with_agent(booked, t, how, distinct=distinct)
    monkeypatch.setattr(tables, "SENT_ROWS", 3)
    many = ch.with_agent(booked, t, how, distinct=distinct)
    assert "BroadcastHashJoin" in physical(few) and "BroadcastHashJoin" not in physical(many)
    assert sorted(map(str, many.collect())) == sorted(map(str, few.collect()))
    assert many.count() == n + (distinct and 1)


# ---------------------------------------------------------------- what lies on disk at a time

def test_what_a_staged_frame_moved_is_deleted_when_it_is_written(spark):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        return {f for f in disk.getAllFiles().mkString("\n").split("\n") if "/shuffle_" in f and f.endswith(".data")}

    before = shuffled()
    with sinks.staging_scope():
        held = sinks.stage(spark.range(1000).repartition(3, "id").groupBy((F.col("id") % 7).alias("k")).count(), "moved")
        assert not shuffled() - before
        assert sorted(r["count"] for r in held.collect()) == [142] + [143] * 6


@needs_data
@pytest.mark.parametrize("name", ["daily_management_sales", "cash_flow", "currency_sales", "journey_type", "finance_by_flight"])
def test_reports_of_few_sums_add_charges_up_where_they_are_read(spark, monkeypatch, name):
    seen, around = [], px.around
    monkeypatch.setattr(px, "around", lambda *a, few=False: seen.append(few) or around(*a, few=few))
    with sinks.staging_scope():
        reports.report_queries()[f"report_{name}"](spark, SF)
    assert seen == [True]


@needs_data
def test_other_charges_are_left_out_before_ancillary_ones_move(spark, monkeypatch):
    seen, within = [], px.within
    monkeypatch.setattr(px, "within", lambda rows, *a: seen.append(rows.columns) or within(rows, *a))
    with sinks.staging_scope():
        reports.report_queries()["report_ancillary_revenue"](spark, SF)
    assert ["IsAncillary" in c for c in seen if "ChargeNumber" in c] == [True]


@needs_data
@pytest.mark.parametrize("name, step", [("ancillary_revenue", "ancillary-fees"), ("booking_date_analysis", "analysis-extras"), ("cash_flow", "cash-journeys")])
def test_reports_are_cut_between_charges_and_fees(spark, name, step):
    with sinks.staging_scope():
        assert any(f"/{step}-" in f for f in reports.report_queries()[f"report_{name}"](spark, SF).inputFiles())
