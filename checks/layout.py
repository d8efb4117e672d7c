"""Queries over loaded tables: report windows on filed months, co-located facts, exports, names."""

from __future__ import annotations

import uuid
import zlib
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.report_sql import report_sql
from checks.reports import NOW
from checks.sqlkit import FEES, I, LEGS, M, day, with_standins
from farespan.functions import fixed, windows
from farespan.functions.windows import Window
from farespan.operators import capacity as cap
from farespan.operators import money as m
from farespan.operators import passengers as px
from farespan.plans import channels, routes
from farespan.session import configure
from farespan.sources import load, sinks
from farespan.sources.standin import BY_LINE, unstored
from farespan.sources.tables import Tables

#: A run in the data; the fifth of a month at 09:15, when two of the windows take another turn.
RUN = datetime(1997, 9, 5, 9, 15)
SQL_RUN = "TIMESTAMP '1997-09-05 09:15:00'"
TODAY, MONTH, YEAR = (f"date_trunc('{unit}', {SQL_RUN})" for unit in ("day", "month", "year"))

QUERIES: dict = {}
SQL: dict[str, str] = {}
_loaded: dict[tuple[str, str], tuple[str, str, int]] = {}
_stored: set[tuple[str, str]] = set()
#: Line items a bucket holds at most, about; so a task's share fits its memory however many there are.
LINES_A_BUCKET = 500_000


def loaded_tables(spark: SparkSession, sf_dir: str) -> Tables:
    """The airline tables in a schema of their own; each is stored when it is first read, once
    per application."""
    spark, sf_dir = configure(spark), sf_dir.rstrip("/")
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _loaded:
        lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
        buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-lines // LINES_A_BUCKET))
        name = f"ods_{zlib.crc32(repr(key).encode()):08x}"
        folder = f"{sinks.staging_dir(spark)}/farespan-loaded/{name}-{uuid.uuid4().hex}"
        load.create(spark, name, folder)
        _loaded[key] = (name, folder, buckets)
    name, folder, buckets = _loaded[key]

    def store(table: str) -> None:
        if (name, table) not in _stored:
            load.store(unstored(spark, sf_dir, buckets)[table], table, name, buckets, folder, dealt=table in BY_LINE)
            _stored.add((name, table))

    return load.loaded(spark, name, store)


def layout(sql: str):
    """Register a plan over the loaded tables with the SQL it is compared with."""

    def register(plan):
        QUERIES[plan.__name__] = lambda spark, sf_dir: plan(loaded_tables(spark, sf_dir))
        SQL[plan.__name__] = with_standins(sql)
        return plan

    return register


def _span(df: DataFrame, c: str) -> DataFrame:
    return df.groupBy(F.col("Status").alias("Status")).agg(F.count("*").alias("n"), F.min(c).alias("first"), F.max(c).alias("last"))


def _window(name: str, window: Window, test: str, table: str = "booking", c: str = "BookingDate") -> None:
    """What a report's window selects of a table filed by month, per status."""
    QUERIES[name] = lambda spark, sf_dir: _span(window.of(loaded_tables(spark, sf_dir)[table], c), c)
    SQL[name] = with_standins(f'SELECT Status, COUNT(*) AS n, MIN({c}) AS "first", MAX({c}) AS "last" FROM t_{table} WHERE {test.format(c)} GROUP BY 1')


_window("window_yesterday", windows.yesterday(RUN), f"{{0}} >= {TODAY} - INTERVAL 1 DAY AND {{0}} < {TODAY}")
_window("window_month_to_date_morning", windows.month_to_date_with_cutoff(RUN)[0], f"{{0}} >= date_trunc('month', {TODAY} - INTERVAL 1 DAY) AND {{0}} < {TODAY}")
_window(
    "window_month_to_date_later", windows.month_to_date_with_cutoff(RUN.replace(hour=11))[0],
    f"{{0}} >= {MONTH} AND {{0}} < {TODAY} + INTERVAL 1 DAY",
)
_window("window_month_of_yesterday", windows.month_of_yesterday_to_date(RUN), f"{{0}} >= date_trunc('month', {TODAY} - INTERVAL 1 DAY) AND {{0}} < {TODAY}")
_window("window_previous_month", windows.previous_month(RUN), f"{{0}} >= {MONTH} - INTERVAL 1 MONTH AND {{0}} < {MONTH}")
_window("window_trailing_week", windows.trailing_week(RUN), f"{{0}} >= {TODAY} - INTERVAL 7 DAY AND {{0}} < {TODAY}")
_window("window_trailing_week_to_yesterday", windows.trailing_week(RUN, 1), f"{{0}} >= {TODAY} - INTERVAL 8 DAY AND {{0}} < {TODAY} - INTERVAL 1 DAY")
_window("window_month_on_day_five", windows.yesterday_or_month_on_day_five(RUN), f"{{0}} >= {MONTH} - INTERVAL 1 MONTH AND {{0}} < {TODAY}")
_window(
    "window_yesterday_on_other_days", windows.yesterday_or_month_on_day_five(RUN.replace(day=6)),
    f"{{0}} >= {TODAY} AND {{0}} < {TODAY} + INTERVAL 1 DAY",
)
_window("window_trailing_31_days", windows.trailing_31_days(RUN)[0], f"{{0}} >= {TODAY} - INTERVAL 31 DAY AND {{0}} < {TODAY} + INTERVAL 1 DAY")
_window("window_open_capacity", windows.trailing_31_days(RUN)[1], f"{{0}} >= least({TODAY} - INTERVAL 31 DAY, {YEAR})", "inventory_leg", "DepartureDate")
_window(
    "window_previous_month_plus_six", windows.previous_month_plus_six(RUN),
    f"{{0}} >= date_trunc('month', {SQL_RUN} - INTERVAL 1 DAY) - INTERVAL 1 MONTH AND {{0}} < date_trunc('month', {SQL_RUN} - INTERVAL 1 DAY) + INTERVAL 6 MONTH", "inventory_leg", "DepartureDate",
)
_window(
    "window_previous_month_to_year_end", windows.previous_month_to_year_end(RUN),
    f"{{0}} >= {MONTH} - INTERVAL 1 MONTH AND {{0}} < {YEAR} + INTERVAL 1 YEAR - INTERVAL 1 DAY", "inventory_leg", "DepartureDate",
)
_window(
    "window_two_back_five_ahead", windows.two_back_five_ahead(RUN),
    f"{{0}} > {MONTH} - INTERVAL 2 MONTH AND {{0}} <= {MONTH} + INTERVAL 5 MONTH", "inventory_leg", "DepartureDate",
)
# Sunday-start weeks: Monday of this one is the day after the Sunday on or before today.
SUNDAY = f"{TODAY} - to_days(dayofweek({SQL_RUN})::INT)"
_window("window_fly_thru_bought", windows.fly_thru(RUN)[0], f"{{0}} < {SUNDAY} + INTERVAL 1 DAY")
_window("window_fly_thru_departs", windows.fly_thru(RUN)[1], f"{{0}} >= {YEAR} AND {{0}} <= {SUNDAY} + INTERVAL 1 DAY + INTERVAL 1 YEAR", "inventory_leg", "DepartureDate")
_window("window_from_today", windows.from_today(RUN), f"{{0}} >= {TODAY}", "inventory_leg", "DepartureDate")


# ---------------------------------------------------------------- co-located facts

@layout("""SELECT s.BookingStatus, c.ChargeType, COUNT(*) AS n, CAST(SUM(c.ChargeAmount) AS DECIMAL(28,4)) AS amount
FROM t_passenger_journey_segment s JOIN t_passenger_journey_leg l ON l.PassengerID = s.PassengerID AND l.SegmentID = s.SegmentID
JOIN t_passenger_journey_charge c ON c.PassengerID = s.PassengerID AND c.SegmentID = s.SegmentID GROUP BY ALL""")
def colocated_segments_and_charges(t: Tables) -> DataFrame:
    rows = colocated_facts(t)
    return rows.groupBy("BookingStatus", "ChargeType").agg(F.count("*").alias("n"), m.money(F.sum("ChargeAmount")).alias("amount"))


def colocated_facts(t: Tables) -> DataFrame:
    """Segments, legs and charges, joined where they lie."""
    segment = t["passenger_journey_segment"].select("PassengerID", "SegmentID", "BookingStatus")
    leg = t["passenger_journey_leg"].select("PassengerID", "SegmentID", "InventoryLegID")
    charge = t["passenger_journey_charge"].select("PassengerID", "SegmentID", "ChargeType", "ChargeAmount")
    keys = ["PassengerID", "SegmentID"]
    return segment.join(leg, keys).join(charge, keys)


@layout(f"WITH {FEES} SELECT FeeCode, ChargeType, COUNT(*) AS n, {M('SUM(ChargeAmount)')} AS amount FROM fees GROUP BY ALL")
def colocated_fees(t: Tables) -> DataFrame:
    return px.fee_lines(t).groupBy("FeeCode", "ChargeType").agg(F.count("*").alias("n"), m.money(F.sum("ChargeAmount")).alias("amount"))


# ---------------------------------------------------------------- names, exports, classes

@layout("SELECT CarrierCode, COUNT(*) AS n FROM t_inventory_leg GROUP BY 1")
def cross_catalog_names(t: Tables) -> DataFrame:
    """The same tables by their full name, catalogue and schema."""
    schema = _schema_of(t["inventory_leg"])
    named = Tables.from_catalog(t.spark, f"spark_catalog.{schema}")
    return named["inventory_leg"].groupBy("CarrierCode").agg(F.count("*").alias("n"))


def _schema_of(df: DataFrame) -> str:
    """Schema of a loaded table, by the folder of its files."""
    return df.inputFiles()[0].split("/farespan-loaded/")[1].split("-")[0]


def _export(name: str, sql: str) -> None:
    QUERIES[f"export_{name}"] = lambda spark, sf_dir: channels.channel_dimensions(loaded_tables(spark, sf_dir))[name]
    SQL[f"export_{name}"] = with_standins(sql)


_export("city_pair", "SELECT DepartureStation, ArrivalStation, CASE InternationalFlag WHEN 1 THEN 'INT' ELSE 'DOM' END AS DomInt FROM t_city_pair")
_export("station", "SELECT StationCode, CountryCode FROM t_station")
_export("country", "SELECT CountryCode, Name FROM t_country")


# ---------------------------------------------------------------- result tables

def _folder(spark: SparkSession, name: str) -> str:
    return f"{sinks.staging_dir(spark)}/farespan-results/{name}-{uuid.uuid4().hex}"


@layout(f"""SELECT {day('BookingDate')} AS BookingDay, CAST(CASE WHEN BookingDate >= {MONTH} - INTERVAL 1 MONTH AND BookingDate < {TODAY} THEN COUNT(*) ELSE -COUNT(*) END AS BIGINT) AS n
FROM t_booking GROUP BY {day('BookingDate')}, BookingDate >= {MONTH} - INTERVAL 1 MONTH AND BookingDate < {TODAY}""")
def refreshed_days(t: Tables) -> DataFrame:
    """A result stored by day with wrong numbers, after the rerun of the fifth of a month: the
    days of its window are replaced, all others are as they were."""
    window = windows.yesterday_or_month_on_day_five(RUN)
    by_day = F.to_date("BookingDate").alias("BookingDay")
    path = _folder(t.spark, "daily")
    sinks.save(t["booking"].groupBy(by_day).agg((-F.count("*")).alias("n")), path, "BookingDay")
    again = window.of(t["booking"], "BookingDate").groupBy(by_day).agg(F.count("*").alias("n"))
    sinks.refresh_days(again, path, "BookingDay", window.start.date(), (window.end - timedelta(days=1)).date())
    return t.spark.read.parquet(path).select("BookingDay", "n")


def _published(t: Tables) -> DataFrame:
    """Route revenue whose first two tables are saved on the way and read back."""
    paths = {name: _folder(t.spark, name) for name in ("passengers", "fare_class_revenue")}
    return routes.route_revenue(t, NOW, routes.ROUTE_D7, wanted=("inventory_revenue",), publish_to=paths)["inventory_revenue"]


QUERIES["published_midway"] = lambda spark, sf_dir: _published(loaded_tables(spark, sf_dir))
SQL["published_midway"] = report_sql()["report_route_revenue_d7"]


@layout(f"""WITH {LEGS}, k AS (SELECT DISTINCT rtrim(ClassOfServiceCode) AS cls FROM t_class_of_service WHERE length(rtrim(ClassOfServiceCode)) = 1 OR rtrim(ClassOfServiceCode) IN ({', '.join(f"'{c}'" for c in fixed.GRID_CLASSES if len(c) > 1)})),
r AS (SELECT DISTINCT l.InventoryLegID, trim(c.ClassOfService) AS cls, c.ClassNest, c.ClassAU, c.ClassSold FROM legs l JOIN t_inventory_leg_class c ON c.InventoryLegID = l.InventoryLegID
  JOIN t_city_pair cp ON cp.DepartureStation = l.DepartureStation AND cp.ArrivalStation = l.ArrivalStation WHERE l.Status <> 2),
a AS (SELECT cls, SUM(ClassAU) AS au, COUNT(DISTINCT InventoryLegID) AS legs FROM r GROUP BY 1)
SELECT k.cls AS ClassOfService, {I('a.au')} AS Authorised, CAST(coalesce(a.legs, 0) AS BIGINT) AS Legs FROM k LEFT JOIN a ON a.cls = k.cls""")
def grid_from_class_table(t: Tables) -> DataFrame:
    """The columns of a grid that follows the class table, turned back into rows."""
    grid = cap.availability_grid(t, windows.stamp(datetime(1990, 1, 1)), F.lit(1), None)
    classes = [c.removesuffix("-AU") for c in grid.columns if c.endswith("-AU")]
    sums = grid.agg(*[F.sum(f"`{c}-AU`").alias(f"au_{c}") for c in classes], *[F.count(f"`{c}-AU`").alias(f"n_{c}") for c in classes])
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("ClassOfService"), F.col(f"au_{c}").alias("Authorised"), F.col(f"n_{c}").alias("Legs")) for c in classes]))
    return sums.select(rows.alias("r")).select("r.*")
