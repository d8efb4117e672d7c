"""The report plans as queries over the driver's tables.

Windowed reports are given the whole span of the data, so that a check covers
every row; reports whose windows are their point (season, year on year) run at a
fixed ``now`` inside the data.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from farespan.functions.windows import Window
from farespan.plans import channels, grid, journeys, routes, sales, year_on_year
from farespan.session import configure
from farespan.sources.standin import airline
from farespan.sources.tables import Tables

NOW = datetime(2000, 6, 15, 4, 30)
WHOLE = Window(datetime(1994, 1, 1), datetime(2003, 1, 1))
WHOLE_CLOSED = Window(datetime(1994, 1, 1), datetime(2003, 1, 1), end_closed=True)
AS_OF = datetime(2001, 8, 1)


def tables(spark: SparkSession, sf_dir: str) -> Tables:
    return airline(configure(spark), sf_dir)


def _q(plan):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plan(tables(spark, sf_dir))

    return run


def _route(spec: routes.RouteSpec, table: str, fanout: str = "safe"):
    return _q(lambda t: routes.route_revenue(t, NOW, spec, fanout, wanted=(table,))[table])


def report_queries() -> dict:
    return {
        "report_daily_management_sales": _q(lambda t: sales.daily_sales(t, NOW, WHOLE)),
        "report_cash_flow": _q(lambda t: sales.cash_flow(t, NOW, WHOLE)),
        "report_currency_sales": _q(lambda t: sales.currency_sales(t, NOW, WHOLE, WHOLE)),
        "report_ancillary_revenue": _q(lambda t: sales.ancillary_revenue(t, NOW, WHOLE)),
        "report_premium_flex_monthly": _q(lambda t: channels.premium_flex_monthly(t, NOW, WHOLE)),
        "report_premium_flex_weekly": _q(lambda t: channels.premium_flex_weekly(t, NOW, WHOLE)),
        "report_channel_daily": _q(lambda t: channels.channel_daily(t, NOW, WHOLE)),
        "report_channel_daily_by_country": _q(lambda t: channels.channel_daily_by_country(t, NOW, WHOLE)),
        "report_channel_monthly": _q(lambda t: channels.channel_monthly(t, NOW, WHOLE)),
        "report_older_channel_daily": _q(lambda t: channels.older_channel_daily(t, NOW, WHOLE)),
        "report_older_channel_monthly": _q(lambda t: channels.older_channel_monthly(t, AS_OF, WHOLE)),
        "report_booking_date_analysis": _q(lambda t: channels.booking_date_analysis(t, NOW, WHOLE)),
        "report_china_market": _q(lambda t: channels.china_market(t, AS_OF, NOW, WHOLE)),
        "report_china_market_months": _q(lambda t: channels.china_months(channels.china_market(t, AS_OF, NOW, WHOLE))),
        "report_route_revenue_d7": _route(routes.ROUTE_D7, "inventory_revenue"),
        "report_route_revenue_d7_fare_class": _route(routes.ROUTE_D7, "inventory_revenue_fare_class"),
        "report_route_revenue_d7_classes": _route(routes.ROUTE_D7, "fare_class_revenue"),
        "report_route_revenue_d7_passengers": _route(routes.ROUTE_D7, "passengers"),
        "report_route_revenue_d7_fanout": _route(routes.ROUTE_D7, "passengers", "reference"),
        "report_route_revenue_xt": _route(routes.ROUTE_XT, "inventory_revenue"),
        "report_route_revenue_xt_fare_class": _route(routes.ROUTE_XT, "inventory_revenue_fare_class"),
        "report_route_revenue_xj": _route(routes.ROUTE_XJ, "inventory_revenue"),
        "report_route_revenue_xj_fare_class": _route(routes.ROUTE_XJ, "inventory_revenue_fare_class"),
        "report_all_carrier_revenue": _q(lambda t: routes.all_carrier_revenue(t, NOW)["merged"]),
        "report_all_carrier_revenue_by_carrier": _q(lambda t: routes.all_carrier_revenue(t, NOW)["by_carrier"]),
        "report_finance_by_flight": _q(lambda t: routes.finance_by_flight(t, NOW, WHOLE_CLOSED)),
        "report_pax_capacity": _q(lambda t: routes.pax_capacity(t, NOW, WHOLE)),
        "report_route_performance_d7": _q(lambda t: year_on_year.route_performance(t, NOW, year_on_year.COMPARE_D7)),
        "report_route_performance_xj": _q(lambda t: year_on_year.route_performance(t, NOW, year_on_year.COMPARE_XJ)),
        "report_journey_type": _q(lambda t: journeys.journey_type(t, NOW, WHOLE)),
        "report_fly_thru_monthly": _q(lambda t: journeys.fly_thru_monthly(t, NOW, WHOLE, WHOLE_CLOSED)["monthly"]),
        "report_fly_thru_daily": _q(lambda t: journeys.fly_thru_monthly(t, NOW, WHOLE, WHOLE_CLOSED)["daily"]),
        "report_nationality": _q(lambda t: journeys.nationality_monthly(t, AS_OF, WHOLE)["detail"]),
        "report_nationality_export": _q(lambda t: journeys.nationality_monthly(t, AS_OF, WHOLE)["export"]),
        "report_seat_grid": _q(lambda t: grid.seat_grid(t, NOW, WHOLE.start)),
    }
