"""Building blocks of the DuckDB comparison SQL."""

from __future__ import annotations

import re

from farespan.functions import fixed
from farespan.sources.standin import STANDINS, duckdb_text


def with_standins(sql: str) -> str:
    """Prefix a query with the stand-in tables it names as ``t_<table>``."""
    used = [n for n in STANDINS if re.search(rf"\bt_{n}\b", sql)]
    ctes = [f"t_{n} AS ({duckdb_text(STANDINS[n]).strip()})" for n in used]
    body = sql.strip()
    if not used:
        return body
    if body.upper().startswith("WITH "):
        return "WITH " + ",\n".join(ctes) + ",\n" + body[5:]
    return "WITH " + ",\n".join(ctes) + "\n" + body


def inlist(values) -> str:
    return "(" + ", ".join(repr(v) for v in values) + ")"


def M(x: str) -> str:
    return f"CAST({x} AS DECIMAL(28,4))"


def I(x: str) -> str:
    return f"CAST({x} AS BIGINT)"


def day(x: str) -> str:
    return f"CAST({x} AS DATE)"


def days(a: str, b: str) -> str:
    return f"({day(b)} - {day(a)})"


def hours(a: str, b: str) -> str:
    return f"({days(a, b)} * 24 + hour({b}) - hour({a}))"


def us_week(d: str) -> str:
    return f"CAST((dayofyear({d}) + dayofweek(date_trunc('year', {d})) - 1) // 7 + 1 AS INT)"


def week_of_month(d: str) -> str:
    return f"((day({d}) + 1) // 7 + 1)"


def home(c: str) -> str:
    return (
        f"CASE WHEN {c} IN ('AK','D7') THEN 'MYR' WHEN {c} IN ('FD','XJ') THEN 'THB' WHEN {c} = 'QZ' THEN 'IDR' "
        f"WHEN {c} IN ('PQ','Z2') THEN 'PHP' WHEN {c} = 'XT' THEN 'USD' WHEN {c} = 'I5' THEN 'INR' ELSE 'MYR' END"
    )


def pair(a: str, b: str, sep: str = "") -> str:
    return f"CASE WHEN {a} <= {b} THEN {a} || '{sep}' || {b} ELSE {b} || '{sep}' || {a} END"


def market(group: str) -> str:
    return f"substring({group}, 1, 3) || substring({group}, 5, 3)"


def canon(x: str) -> str:
    return pair(f"left({x}, 3)", f"right({x}, 3)")


def _lead_cases(n: str, top: int) -> str:
    out = [f"WHEN {n} BETWEEN 0 AND 10 THEN '0-10'"]
    out += [f"WHEN {n} BETWEEN {k} AND {k + 9} THEN '{k}-{k + 9}'" for k in range(11, top, 10)]
    return " ".join(out)


def lead_list(n: str) -> str:
    return f"CASE {_lead_cases(n, 1000)} ELSE 'Unknown' END"


def lead_to400(n: str) -> str:
    return f"CASE {_lead_cases(n, 400)} ELSE '>400' END"


def lead_arith(n: str) -> str:
    # Truncating division: DuckDB's // also truncates towards zero for integers.
    q = f"(({n} // 10) * 10)"
    return (
        f"CASE WHEN {n} BETWEEN 0 AND 10 THEN '0-10' WHEN {n} % 10 = 0 "
        f"THEN CAST({q} - 9 AS VARCHAR) || '-' || CAST({q} AS VARCHAR) "
        f"ELSE CAST({q} + 1 AS VARCHAR) || '-' || CAST({q} + 10 AS VARCHAR) END"
    )


def lead_coarse(n: str) -> str:
    return (
        f"CASE WHEN {n} <= 0 THEN '0' WHEN {n} = 1 THEN '1' WHEN {n} BETWEEN 2 AND 7 THEN '>1-7' WHEN {n} BETWEEN 8 AND 30 THEN '>7-30' "
        f"WHEN {n} BETWEEN 31 AND 90 THEN '>30-90' WHEN {n} >= 91 THEN '>90' END"
    )


AGE_JOURNEY = [(0, 11, "<12"), (12, 17, "12-17"), (18, 24, "18-24"), (25, 30, "25-30"), (31, 35, "31-35"), (36, 44, "36-44"),
               (45, 54, "45-54"), (55, 64, "55-64"), (65, 75, "65-75"), (76, 999, ">75")]
AGE_ANALYSIS = [(0, 2, "0-2"), (3, 5, "3-5"), (6, 12, "6-12"), (13, 18, "13-18"), (18, 24, "18-24"), (25, 29, "25-29"),
                (30, 34, "30-34"), (35, 39, "35-39"), (40, 44, "40-44"), (45, 49, "45-49"), (50, 54, "50-54"), (55, 59, "55-59"),
                (60, 64, "60-64"), (65, 69, "65-69"), (70, 999, ">70")]
AGE_DECADES = [(0, 19, "0-19"), (20, 29, "20-29"), (30, 39, "30-39"), (40, 49, "40-49"), (50, 999, ">49")]
AGE_CHINA = [(0, 12, "Under 12 years old"), (13, 19, "Teens"), (20, 24, "Youth"), (25, 29, "Young Adult"),
             (30, 39, "Mid Level Execs"), (40, 49, "Mature Affluent"), (50, 999, "Senior Citizens")]
AGE_FLY = [(0, 12, "Under12"), (13, 19, "Teens"), (20, 24, "Youth"), (25, 29, "YoungAdult"), (30, 39, "MidLevelExecs"),
           (40, 60, "MatureAffluent"), (60, 100, ">60")]


def age_band(a: str, rows, default: str | None = None) -> str:
    cases = " ".join(f"WHEN {a} BETWEEN {lo} AND {hi} THEN '{label}'" for lo, hi, label in rows)
    return f"CASE {cases} {'ELSE ' + repr(default) if default else ''} END"


def transit(h: str) -> str:
    cases = " ".join(f"WHEN {h} > {a} AND {h} <= {b} THEN '{a}-{b}'" for a, b in ((0, 2), (2, 4), (4, 8), (8, 12), (12, 18), (18, 24), (24, 36), (36, 48)))
    return f"CASE WHEN coalesce({h}, 0) <= 0 THEN '0' {cases} ELSE '>48' END"


def channel(rpt: str, org: str, loc: str | None, unknown: str | None) -> str:
    centre = ""
    if loc:
        centre = " ".join(
            f"WHEN {rpt} = 'Call Centre' AND {loc} IN {inlist(places) if len(places) > 1 else '(' + repr(places[0]) + ')'} THEN 'Call Centre - {name}'"
            for name, places in fixed.CALL_CENTRES.items()
        )
    tail = f"coalesce({rpt}, '{unknown}')" if unknown else rpt
    return (
        f"CASE WHEN {rpt} = 'Corporate' AND regexp_matches({org}, '[A-Za-z]') THEN 'Corporate - Direct' "
        f"WHEN {rpt} = 'Corporate' AND NOT regexp_matches({org}, '[A-Za-z]') THEN 'Corporate - TMC' "
        f"WHEN {rpt} = 'Corporate' AND {org} IS NULL THEN {rpt} {centre} ELSE {tail} END"
    )


def payment(code: str) -> str:
    cases = " ".join(f"WHEN {code} IN {inlist(c) if len(c) > 1 else '(' + repr(c[0]) + ')'} THEN '{g}'" for g, c in fixed.PAYMENT_GROUPS.items())
    return f"CASE {cases} ELSE 'Others' END"


# Shared sub-queries -------------------------------------------------------

LEGS = """
legs AS (
  SELECT l.* EXCLUDE (FlightNumber), trim(l.FlightNumber) AS FlightNo, coalesce(mp.MappedCarrier, l.CarrierCode) AS Carrier
  FROM t_inventory_leg l LEFT JOIN t_carrier_mapping mp ON mp.CarrierCode = l.CarrierCode AND trim(mp.FlightNumber) = trim(l.FlightNumber)
)"""

FX = """
fx AS (
  SELECT FromCurrencyCode AS f, ToCurrencyCode AS t, CAST(ConversionDate AS DATE) AS d, ConversionRate AS rate,
    CAST(1.0 / ConversionRate AS DECIMAL(9,4)) AS inv
  FROM t_fx_history
)"""

PAX = """
pax AS (
  SELECT b.BookingID, b.BookingDate, b.Status, b.CreatedAgentID, p.PassengerID, s.SegmentID, s.JourneyNumber, s.SegmentNumber,
    s.DepartureDate, s.DepartureStation, s.ArrivalStation, s.International, trim(s.FareClassOfService) AS FareClass, s.ProductClassCode,
    pl.InventoryLegID, l.Carrier, l.CarrierCode AS OwnCarrier, l.FlightNo, l.Status AS LegStatus, l.Lid
  FROM t_booking b JOIN t_booking_passenger p ON p.BookingID = b.BookingID
  JOIN t_passenger_journey_segment s ON s.PassengerID = p.PassengerID
  JOIN t_passenger_journey_leg pl ON pl.PassengerID = s.PassengerID AND pl.SegmentID = s.SegmentID
  JOIN legs l ON l.InventoryLegID = pl.InventoryLegID
)"""

CHARGES = """
chg AS (
  SELECT c.*, c.ChargeAmount * x.PositiveNegativeFlag AS amt, a.Code IS NOT NULL AS anc
  FROM t_passenger_journey_charge c JOIN t_charge_type_matrix x ON x.ChargeTypeID = c.ChargeType
  LEFT JOIN t_ancillary_fee_codes a ON a.Code = c.ChargeCode
)"""

FEES = """
fees AS (
  SELECT f.PassengerID, f.FeeNumber, f.FeeCode, f.InventoryLegID AS FeeLeg, c.ChargeType, c.ChargeAmount, c.CurrencyCode, c.CreatedDate,
    c.ChargeAmount * x.PositiveNegativeFlag AS amt, a.Code IS NOT NULL AS anc
  FROM t_passenger_fee f JOIN t_passenger_fee_charge c ON c.PassengerID = f.PassengerID AND c.FeeNumber = f.FeeNumber AND c.ChargeCode = f.FeeCode
  JOIN t_charge_type_matrix x ON x.ChargeTypeID = c.ChargeType
  LEFT JOIN t_ancillary_fee_codes a ON a.Code = f.FeeCode
)"""

SEGVIEW = """
seg AS (
  SELECT s.* EXCLUDE (FareClassOfService), trim(s.FareClassOfService) AS FareClassOfService, pl.InventoryLegID, l.CarrierCode, l.FlightNo, l.Carrier, l.STDUTC AS SegmentSTD
  FROM t_passenger_journey_segment s JOIN t_passenger_journey_leg pl ON pl.PassengerID = s.PassengerID AND pl.SegmentID = s.SegmentID
  JOIN legs l ON l.InventoryLegID = pl.InventoryLegID
)"""

FEEVIEW = """
feeview AS (
  SELECT f.PassengerID, f.FeeNumber, f.FeeCode, l.DepartureDate, l.CarrierCode, l.FlightNo, l.DepartureStation, l.ArrivalStation
  FROM t_passenger_fee f JOIN legs l ON l.InventoryLegID = f.InventoryLegID
)"""

NETFARE = """
netfare AS (
  SELECT PassengerID, SegmentID, SUM(CASE WHEN ChargeType IN (0, 8) THEN ChargeAmount WHEN ChargeType IN (1, 7) THEN -ChargeAmount END) AS fare
  FROM t_passenger_journey_charge WHERE ChargeType IN (0, 8, 1, 7, 5) GROUP BY 1, 2
)"""


def fx_join(alias: str, frm: str, to: str, on: str) -> str:
    return f"LEFT JOIN fx {alias} ON {alias}.f = {frm} AND {alias}.t = {to} AND {alias}.d = {on}"


def hub_lookup(carrier: str, flight: str, pair_expr: str, base: str) -> str:
    """Scalar expression: exact hub, else the loose one where the base is the default."""
    exact = (
        f"(SELECT MIN(h.Hub) FROM t_hub_info h WHERE h.CarrierCode = {carrier} AND trim(h.FlightNumber) = {flight} "
        f"AND (h.MarketGroup = {pair_expr} OR (left({pair_expr}, 3) = right(h.MarketGroup, 3) AND right({pair_expr}, 3) = left(h.MarketGroup, 3))))"
    )
    loose = (
        f"(SELECT MIN(h.Hub) FROM t_hub_info h WHERE h.CarrierCode = {carrier} "
        f"AND (h.MarketGroup = {pair_expr} OR (left({pair_expr}, 3) = right(h.MarketGroup, 3) AND right({pair_expr}, 3) = left(h.MarketGroup, 3))))"
    )
    return f"coalesce({exact}, CASE WHEN lower({base}) = 'hub' THEN coalesce({loose}, {base}) ELSE {base} END)"
