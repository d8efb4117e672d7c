"""DuckDB SQL of the report plans, one text per query in :mod:`checks.reports`."""

from __future__ import annotations

from checks import sqlkit as k
from checks.sqlkit import CHARGES, FEES, FEEVIEW, FX, I, LEGS, M, NETFARE, PAX, SEGVIEW, day, days, inlist, with_standins
from farespan.functions import fixed

FARE4 = "ChargeType IN (0, 1, 7, 19)"
FUEL = "ChargeCode IN ('FUEL', 'FUEX', 'DOMS')"
WHOLE = "TIMESTAMP '1994-01-01' AND TIMESTAMP '2002-12-31 23:59:59'"


def sum_if(cond: str, amount: str = "amt") -> str:
    # Kept narrow, so a later product with a rate keeps all its digits.
    return f"CAST(SUM(CASE WHEN {cond} THEN {amount} ELSE 0 END) AS DECIMAL(20,4))"


# ---------------------------------------------------------------- sales

def daily_sales() -> str:
    return f"""
WITH {LEGS}, {FX}, {PAX}, {CHARGES},
per AS (
  SELECT {day('p.BookingDate')} AS bd, p.Carrier, p.Status, r.RoleCode, p.SegmentID, c.CurrencyCode AS ccy,
    {day('c.CreatedDate')} AS cd, {k.home('p.Carrier')} AS home, {sum_if(FARE4)} AS fare
  FROM pax p LEFT JOIN t_agent_role r ON r.AgentID = p.CreatedAgentID
  JOIN chg c ON c.PassengerID = p.PassengerID AND c.SegmentID = p.SegmentID
  WHERE p.OwnCarrier <> 'BF' AND p.LegStatus <> 2 AND p.Lid > 0
  GROUP BY ALL
)
SELECT DATE '2000-06-15' AS CapturedDate, bd AS BookingDate, Carrier AS CarrierCode, Status, RoleCode,
  COUNT(DISTINCT SegmentID) AS SeatSold,
  {M("SUM(CASE WHEN ccy = home THEN fare ELSE fare * x.inv END)")} AS SalesAmt
FROM per {k.fx_join('x', 'per.home', 'per.ccy', 'per.cd')}
GROUP BY bd, Carrier, Status, RoleCode"""


def cash_flow() -> str:
    parts = []
    pax = f"""
px AS (
  SELECT PassengerID, SegmentID, JourneyNumber, SegmentNumber, InventoryLegID, {day('BookingDate')} AS bd, Carrier,
    CASE WHEN OwnCarrier || FlightNo IN {inlist(fixed.CHARTERED)} THEN 'Y' ELSE 'N' END AS charter, Status, {k.home('Carrier')} AS home
  FROM pax WHERE OwnCarrier <> 'BF' AND LegStatus <> 2 AND Lid > 0 AND Status IN (1, 2, 3)
)"""

    def part(source: str, fare: str, anc: str, tax: str) -> str:
        def conv(x: str) -> str:
            return M(f"SUM(CASE WHEN g.ccy = g.home THEN g.{x} ELSE g.{x} * x.inv END)")

        return f"""
SELECT g.bd AS BookingDate, g.Carrier AS CarrierCode, g.charter AS IsChartered, g.Status AS Status, g.ccy AS CurrencyCode,
  {conv('fare')} AS FareRevenue, {conv('anc')} AS AncillaryRevenue, {conv('tax')} AS Tax
FROM (SELECT p.PassengerID, p.SegmentID, p.InventoryLegID, p.bd, p.Carrier, p.charter, p.Status, p.home, c.CurrencyCode AS ccy, {day('c.CreatedDate')} AS cd,
        {fare} AS fare, {anc} AS anc, {tax} AS tax
      FROM px p JOIN {source} GROUP BY ALL) g
{k.fx_join('x', 'g.home', 'g.ccy', 'g.cd')}
GROUP BY 1, 2, 3, 4, 5"""

    surcharge = f"ChargeCode IN {inlist(fixed.SURCHARGE_CODES)}"
    taxes = f"ChargeCode IN {inlist(fixed.TAX_CODES)}"
    parts.append(part(
        "chg c ON c.PassengerID = p.PassengerID AND c.SegmentID = p.SegmentID",
        f"{sum_if(FARE4)} + {sum_if(surcharge)}", sum_if("anc OR ChargeType = 8"), sum_if(taxes),
    ))
    fee = ("CAST(0 AS DECIMAL(18,4))", "CAST(SUM(CASE WHEN anc THEN amt END) AS DECIMAL(20,4))", sum_if("ChargeType = 5"))
    parts.append(part("fees c ON c.PassengerID = p.PassengerID AND c.FeeLeg = p.InventoryLegID AND c.FeeLeg <> 0", *fee))
    parts.append(part("fees c ON c.PassengerID = p.PassengerID AND c.FeeLeg = 0 AND p.JourneyNumber = 1 AND p.SegmentNumber = 1", *fee))
    return f"""
WITH {LEGS}, {FX}, {PAX}, {CHARGES}, {FEES}, {pax},
u AS ({' UNION '.join(parts)}),
n AS (SELECT bd, Carrier, charter, Status, COUNT(DISTINCT SegmentID) AS pax FROM px GROUP BY ALL)
SELECT u.*, n.pax AS Pax, 'N' AS IsMorning
FROM u LEFT JOIN n ON n.bd = u.BookingDate AND n.Carrier = u.CarrierCode AND n.Status = u.Status AND n.charter = u.IsChartered"""


NAMES4 = ["FareRevenue", "FuelAmount", "FeeAmount", "JourneyChargeOthers"]

ASK_CTES = f"""
cap AS (
  SELECT Carrier, {day('DepartureDate')} AS dd, DepartureStation AS dep, ArrivalStation AS arr, SUM(Capacity) AS seats
  FROM legs WHERE CarrierCode <> 'BF' AND Status <> 2 AND Lid > 0 AND Capacity > 0
    AND InventoryLegID NOT IN (SELECT InventoryLegID FROM t_chartered_flights) AND DepartureDate BETWEEN {WHOLE}
  GROUP BY ALL
),
asks AS (
  SELECT cap.Carrier, dd, dep, arr, seats,
    seats * CASE WHEN cap.Carrier IN ('D7', 'XJ', 'XT') THEN coalesce(c1.ActualDistance, c2.ActualDistance, d.ActualDistance) ELSE d.ActualDistance END AS ask
  FROM cap LEFT JOIN t_city_pair c1 ON c1.DepartureStation = dep AND c1.ArrivalStation = arr
  LEFT JOIN t_city_pair c2 ON c2.DepartureStation = arr AND c2.ArrivalStation = dep
  LEFT JOIN t_distance d ON d.DepartureStation = dep AND d.ArrivalStation = arr
),
askccy AS (
  SELECT DISTINCT a.Carrier, a.dd, a.dep || a.arr AS sector, coalesce(sc.Currency, c.DefaultCurrencyCode) AS ccy, a.seats, a.ask
  FROM asks a JOIN t_station s ON s.StationCode = a.dep OR s.StationCode = a.arr
  LEFT JOIN t_station_currency sc ON sc.Station = s.StationCode LEFT JOIN t_country c ON c.CountryCode = s.CountryCode
),
dayc AS (SELECT Carrier, dd, ccy, SUM(ask) AS ask FROM askccy GROUP BY ALL),
dayk AS (SELECT Carrier, dd, SUM(ask) AS ask FROM asks GROUP BY ALL),
fwdc AS (
  SELECT a.Carrier, a.dd, a.ccy, SUM(b.ask) AS ask FROM dayc a RIGHT JOIN dayc b
    ON a.Carrier = b.Carrier AND a.ccy = b.ccy AND b.dd >= a.dd AND b.dd < a.dd + 181 GROUP BY ALL
),
fwdk AS (
  SELECT a.Carrier, a.dd, SUM(b.ask) AS ask FROM dayk a RIGHT JOIN dayk b
    ON a.Carrier = b.Carrier AND b.dd >= a.dd AND b.dd < a.dd + 181 GROUP BY ALL
)"""


def currency_sales() -> str:
    px = f"""
px AS (
  SELECT PassengerID, SegmentID, JourneyNumber, SegmentNumber, InventoryLegID, {day('BookingDate')} AS bd, Carrier
  FROM pax WHERE OwnCarrier <> 'BF' AND LegStatus <> 2 AND Lid > 0 AND Status IN (2, 3)
    AND InventoryLegID NOT IN (SELECT InventoryLegID FROM t_chartered_flights)
)"""

    def part(source: str, measures: list[str], seats: str) -> str:
        inner = ", ".join(f"{m} AS {n}" for m, n in zip(measures, NAMES4))
        outer = ", ".join(M(f"SUM(CASE WHEN g.ccy = 'MYR' THEN g.{n} ELSE g.{n} * x.inv END)") + f" AS {n}" for n in NAMES4)
        return f"""
SELECT g.bd, g.Carrier, g.ccy, {outer}, {seats} AS seats
FROM (SELECT p.PassengerID, p.SegmentID, p.InventoryLegID, p.bd, p.Carrier, c.CurrencyCode AS ccy, {day('c.CreatedDate')} AS cd, {inner}
      FROM px p JOIN {source} GROUP BY ALL) g
{k.fx_join('x', "'MYR'", 'g.ccy', 'g.cd')} GROUP BY g.bd, g.Carrier, g.ccy"""

    klia = "ChargeCode = 'KLIA2'"
    rest = f"ChargeCode NOT IN {inlist(fixed.NOT_OTHER_CODES)} AND NOT anc AND ChargeType NOT IN (0, 1, 7, 19)"
    zero = "CAST(0 AS DECIMAL(18,4))"
    fee = [zero, zero, sum_if("anc"), zero]
    parts = [
        part("chg c ON c.PassengerID = p.PassengerID AND c.SegmentID = p.SegmentID",
             [f"{sum_if(FARE4)} + {sum_if(klia)}", sum_if(FUEL), sum_if("anc OR ChargeType = 8"), sum_if(rest)], "COUNT(DISTINCT SegmentID)"),
        part("fees c ON c.PassengerID = p.PassengerID AND c.FeeLeg = p.InventoryLegID AND c.FeeLeg <> 0", fee, "0"),
        part("fees c ON c.PassengerID = p.PassengerID AND c.FeeLeg = 0 AND p.JourneyNumber = 1 AND p.SegmentNumber = 1", fee, "0"),
    ]
    sums = ", ".join(f"{M(f'SUM({n})')} AS {n}" for n in NAMES4)
    cols = "SeatsSold, " + ", ".join(NAMES4)
    return f"""
WITH {LEGS}, {FX}, {PAX}, {CHARGES}, {FEES}, {px}, {ASK_CTES},
u AS ({' UNION '.join(parts)}),
s AS (SELECT bd, Carrier, ccy, {sums}, {I('SUM(seats)')} AS SeatsSold FROM u GROUP BY bd, Carrier, ccy),
sk AS (SELECT bd, Carrier, {sums}, {I('SUM(SeatsSold)')} AS SeatsSold FROM s GROUP BY bd, Carrier)
SELECT coalesce(s.bd, a.dd) AS BookingDate, coalesce(s.Carrier, a.Carrier) AS CarrierCode,
  CASE WHEN coalesce(s.ccy, '') = '' THEN a.ccy ELSE s.ccy END AS ForeignCurrencyCode, {cols}, {M('a.ask')} AS Ask
FROM (SELECT * FROM s WHERE Carrier <> 'BF') s FULL JOIN (SELECT * FROM fwdc WHERE dd IS NOT NULL) a ON s.Carrier = a.Carrier AND a.dd = s.bd AND s.ccy = a.ccy
UNION
SELECT coalesce(s.bd, a.dd), coalesce(s.Carrier, a.Carrier), 'Total', {cols}, {M('a.ask')}
FROM (SELECT * FROM sk WHERE Carrier <> 'BF') s FULL JOIN (SELECT * FROM fwdk WHERE dd IS NOT NULL) a ON s.Carrier = a.Carrier AND a.dd = s.bd"""


def ancillary() -> str:
    head = """p.DepartureDate, p.PassengerID, p.SegmentID, p.DepartureStation, p.ArrivalStation, p.JourneyNumber, p.SegmentNumber,
  p.InventoryLegID, p.Carrier, p.FlightNo, p.International, p.dur"""
    signed = "CASE WHEN ChargeType IN (1, 2, 3, 7, 11, 16) THEN -1 ELSE 1 END"
    return f"""
WITH {LEGS}, {FX}, {FEES},
px AS (
  SELECT s.DepartureDate, s.PassengerID, s.SegmentID, s.DepartureStation, s.ArrivalStation, s.JourneyNumber, s.SegmentNumber, s.International,
    l.InventoryLegID, l.Carrier, l.FlightNo,
    {days('l.STDUTC', 'l.STAUTC')} * 1440 + (hour(l.STAUTC) - hour(l.STDUTC)) * 60 + minute(l.STAUTC) - minute(l.STDUTC) AS dur
  FROM t_passenger_journey_segment s JOIN t_passenger_journey_leg pl ON pl.PassengerID = s.PassengerID AND pl.SegmentID = s.SegmentID
  JOIN legs l ON l.InventoryLegID = pl.InventoryLegID AND l.Status <> 2 AND l.Lid > 0
  JOIN t_booking_passenger bp ON bp.PassengerID = s.PassengerID JOIN t_booking b ON b.BookingID = bp.BookingID AND b.Status IN (2, 3)
  WHERE s.BookingStatus = 'HK'
),
lines AS (
  SELECT {head}, f.FeeNumber, f.FeeCode, f.CurrencyCode AS ccy, f.ChargeType, f.ChargeAmount, f.CreatedDate FROM px p
    JOIN fees f ON f.PassengerID = p.PassengerID AND f.FeeLeg = p.InventoryLegID AND f.FeeLeg <> 0
  UNION
  SELECT {head}, f.FeeNumber, f.FeeCode, f.CurrencyCode, f.ChargeType, f.ChargeAmount, f.CreatedDate FROM px p
    JOIN fees f ON f.PassengerID = p.PassengerID AND f.FeeLeg = 0 AND p.JourneyNumber = 1 AND p.SegmentNumber = 1
  UNION
  SELECT {head}, c.ChargeNumber, CASE WHEN c.ChargeType = 8 THEN 'ConnectingFee' ELSE c.ChargeCode END, c.CurrencyCode, c.ChargeType, c.ChargeAmount, c.CreatedDate
  FROM px p JOIN t_passenger_journey_charge c ON c.PassengerID = p.PassengerID AND c.SegmentID = p.SegmentID
    AND (c.ChargeCode IN (SELECT Code FROM t_ancillary_fee_codes) OR c.ChargeType = 8)
),
items AS (
  SELECT n.DepartureDate, n.PassengerID, n.SegmentID, n.DepartureStation, n.ArrivalStation, n.InventoryLegID, n.Carrier, n.FlightNo, n.International, n.dur, n.FeeNumber, n.FeeCode,
    SUM({signed} * CASE WHEN ccy = {k.home('n.Carrier')} THEN ChargeAmount ELSE ChargeAmount * x.inv END) AS local,
    SUM({signed} * CASE WHEN ccy = 'MYR' THEN ChargeAmount ELSE ChargeAmount * coalesce(y.inv, 1) END) AS myr
  FROM lines n {k.fx_join('x', k.home('n.Carrier'), 'n.ccy', day('n.CreatedDate'))} {k.fx_join('y', "'MYR'", 'n.ccy', day('n.CreatedDate'))}
  GROUP BY ALL
),
agg AS (
  SELECT DepartureDate, InventoryLegID, Carrier, FlightNo, DepartureStation, ArrivalStation, International, dur, FeeCode,
    COUNT(SegmentID) AS q, SUM(local) AS local, SUM(myr) AS myr FROM items GROUP BY ALL
),
n AS (SELECT Carrier, DepartureDate, DepartureStation, ArrivalStation, FlightNo, dur, COUNT(SegmentID) AS pax FROM px GROUP BY ALL)
SELECT a.DepartureDate, a.Carrier AS CarrierCode, a.FlightNo AS FlightNumber, {k.pair('a.DepartureStation', 'a.ArrivalStation')} AS Route,
  a.DepartureStation || a.ArrivalStation AS Sector, ds.ShortName AS DepartureStationName, ars.ShortName AS ArrivalStationName,
  {k.pair('ds.CountryCode', 'ars.CountryCode')} AS CountryPair, ds.CountryCode || ars.CountryCode AS CountryOD, dc.Name AS DepartureCountry, ac.Name AS ArrivalCountry,
  a.International, CAST(a.dur AS INT) AS FlightDuration, a.FeeCode, f.Name AS SSRDesc, a.q AS Quantity, {M('a.local')} AS Revenue, {M('a.myr')} AS RevenueMYR,
  coalesce(h.Hub, 'hub') AS Hub, n.pax AS NoOfPax, il.Capacity
FROM agg a LEFT JOIN n ON n.Carrier = a.Carrier AND n.DepartureDate = a.DepartureDate AND n.DepartureStation = a.DepartureStation
    AND n.ArrivalStation = a.ArrivalStation AND n.FlightNo = a.FlightNo AND n.dur = a.dur
LEFT JOIN t_inventory_leg il ON il.InventoryLegID = a.InventoryLegID LEFT JOIN t_fee f ON f.FeeCode = a.FeeCode
LEFT JOIN t_station ds ON ds.StationCode = a.DepartureStation LEFT JOIN t_station ars ON ars.StationCode = a.ArrivalStation
LEFT JOIN t_country dc ON dc.CountryCode = ds.CountryCode LEFT JOIN t_country ac ON ac.CountryCode = ars.CountryCode
LEFT JOIN (SELECT DISTINCT CarrierCode, trim(FlightNumber) AS fn, DepartureStation, ArrivalStation, Hub FROM t_hub_info WHERE length(Hub) < 6) h
  ON h.CarrierCode = a.Carrier AND h.fn = a.FlightNo AND h.DepartureStation = a.DepartureStation AND h.ArrivalStation = a.ArrivalStation"""


# ---------------------------------------------------------------- channels

def channel_report(keys: list[str], lead: str | None, agencies: str | None, pos: bool, any_leg: bool = False,
                   countries: bool = False, collapse: bool = False, first: str = "BookingDate") -> str:
    n = days("x.bd", "x.DepartureDate")
    exprs = {
        "BookingDate": "x.bd", "CapturedDate": "x.bd", "BookingYear": "CAST(year(x.bd) AS INT)", "BookingMonth": "monthname(x.bd)",
        "BookingWeek": f"CAST({k.us_week('x.bd')} AS VARCHAR)", "BookingWkYr": f"'W' || CAST({k.us_week('x.bd')} AS VARCHAR)",
        "BookingWkMth": f"'W' || CAST({k.week_of_month('x.bd')} AS VARCHAR)", "CarrierCode": "x.Carrier", "FlightNumber": "x.FlightNo",
        "MarketGroup": k.pair("x.DepartureStation", "x.ArrivalStation"), "Sector": "x.DepartureStation || x.ArrivalStation",
        "PurchaseLeadDays": {"list": k.lead_list(n), "arith": k.lead_arith(n), None: "''"}[lead],
        "SalesChannel": "x.channel", "CurrencyCode": "x.ccy", "OrganizationCode": "x.OrganizationCode", "OrganizationName": "x.OrganizationName",
        "OrganizationCountryCode": "x.orgcountry", "Category": "x.Category", "SalesChannelGrouping": "x.grp", "RoleCode": "x.RoleCode",
        "DomInt": "CASE WHEN x.International = 1 THEN 'INT' ELSE 'DOM' END", "CountryPair": "x.dc || '-' || x.ac",
        "CountryPairGroup": k.pair("x.dc", "x.ac", "-"), "DepCountry": "x.dcn", "ArrCountry": "x.acn", "POSCountry": "x.poscountry", "POSCurrency": "x.posccy",
        "PremFlex": "CASE WHEN x.ProductClassCode = 'HF' THEN 'ONLINE_PF' WHEN x.ProductClassCode = 'FS' AND x.FareClass NOT IN ('B', 'H') THEN 'CORP_PF' ELSE 'NON_PF' END",
    }
    legs_ok = "TRUE" if any_leg else "p.LegStatus <> 2 AND p.Lid > 0"
    where = f"WHERE p.Status IN (2, 3) AND {legs_ok}"
    if countries:
        where += " AND (ds.CountryCode IN ('SG', 'PH', 'ID', 'AU') OR ars.CountryCode IN ('SG', 'PH', 'ID', 'AU'))"
    flight = ", p.FlightNo" if "FlightNumber" in keys else ", '' AS FlightNo"
    pos_cte, pos_join, pos_cols = "", "", ", NULL AS poscountry, NULL AS posccy"
    if pos:
        pos_cte = """
pos AS (
  SELECT bp.BookingID, bp.PassengerID, c.CountryCode AS poscode, c.Name AS poscountry, c.DefaultCurrencyCode AS posccy
  FROM t_booking_passenger bp JOIN t_passenger_journey_segment s ON s.PassengerID = bp.PassengerID AND s.JourneyNumber = 1 AND s.SegmentNumber = 1
  JOIN t_station st ON st.StationCode = s.DepartureStation JOIN t_country c ON c.CountryCode = st.CountryCode
),"""
        pos_join = "LEFT JOIN pos ON pos.BookingID = q.BookingID AND pos.PassengerID = q.PassengerID"
        pos_cols = ", pos.poscode, pos.poscountry, pos.posccy"
    org_join, org_cols = "", ", NULL AS Category, NULL AS grp, NULL AS OrganizationName, NULL AS orgcountry"
    if agencies:
        org_join = f"""LEFT JOIN t_sales_channel_group g ON g.ChannelBreakdown = sc.SalesChannelRpt AND g.ChannelBreakdown || g.Category <> 'OthersThird Party'
  LEFT JOIN t_{agencies} o ON o.OrganizationCode = q.OrganizationCode"""
        org_cols = ", g.Category, g.Grouping AS grp, o.OrganizationName, o.CountryCode AS orgcountry"
    label = k.channel("sc.SalesChannelRpt", "q.OrganizationCode", "q.LocationCode", None)
    money = []
    for name in ("Fare", "Fuel"):
        money.append(f"{M(f'SUM(x.{name.lower()})')} AS {name}RevBookingCurrency")
    sides = [("MYR", "'MYR'", "fm")] + [("AOCCurrency", "x.home", "fa")] + ([("POSCurrency", "x.posccy", "fp")] if pos else [])
    joins = ""
    for out, target, alias in sides:
        joins += "\n" + k.fx_join(alias, target, "x.ccy", "x.bd")
        for name in ("Fare", "Fuel"):
            v = f"x.{name.lower()}"
            money.append(f"{M(f'SUM(CASE WHEN x.ccy <> {target} THEN {v} * {alias}.inv ELSE {v} END)')} AS {name}Rev{out}")
    select = ", ".join(f"{exprs[c]} AS {c}" for c in keys)
    group = ", ".join(str(i + 1) for i in range(len(keys)))
    klia = "ChargeCode = 'KLIA2'"
    return f"""
WITH {LEGS}, {FX}, {PAX}, {CHARGES}, {pos_cte}
q AS (
  SELECT p.BookingID, {day('p.BookingDate')} AS bd, p.PassengerID, p.SegmentID, p.DepartureDate, p.DepartureStation, p.ArrivalStation, p.JourneyNumber, p.SegmentNumber,
    p.International, p.FareClass, p.ProductClassCode, r.RoleCode, p.Carrier{flight}, a.OrganizationCode, a.LocationCode, ds.CountryCode AS dc, ars.CountryCode AS ac,
    dcn.Name AS dcn, acn.Name AS acn, c.CurrencyCode AS ccy, {sum_if(FARE4)} + {sum_if(klia)} AS fare, {sum_if(FUEL)} AS fuel
  FROM pax p JOIN t_agent_role r ON r.AgentID = p.CreatedAgentID JOIN t_agent a ON a.AgentID = p.CreatedAgentID
  JOIN chg c ON c.PassengerID = p.PassengerID AND c.SegmentID = p.SegmentID
  JOIN t_station ds ON ds.StationCode = p.DepartureStation JOIN t_station ars ON ars.StationCode = p.ArrivalStation
  JOIN t_country dcn ON dcn.CountryCode = ds.CountryCode JOIN t_country acn ON acn.CountryCode = ars.CountryCode
  {where} GROUP BY ALL
),
x AS (
  SELECT {'DISTINCT' if collapse else ''} q.*, {label} AS channel, {k.home('q.Carrier')} AS home{pos_cols}{org_cols}
  FROM q {pos_join} LEFT JOIN t_sales_channel sc ON sc.RoleCode = q.RoleCode {org_join}
)
SELECT {select}, COUNT(DISTINCT x.SegmentID) AS SeatSold, {', '.join(money)}
FROM x {joins} GROUP BY {group}"""


_ORG = ["OrganizationCode", "OrganizationName", "OrganizationCountryCode", "Category", "SalesChannelGrouping"]
_PLACE = ["DomInt", "CountryPair", "CountryPairGroup"]
_CTRY = ["DepCountry", "ArrCountry", "POSCountry", "POSCurrency"]


def premium_flex(first: str) -> str:
    return channel_report(
        [first, "BookingYear", "BookingMonth", "BookingWeek", "CarrierCode", "MarketGroup", "PurchaseLeadDays", "SalesChannel", "CurrencyCode",
         *_ORG, *_PLACE, "PremFlex", *_CTRY], "list", "sales_agency", True)


def channel_daily() -> str:
    return channel_report(
        ["BookingDate", "BookingYear", "BookingMonth", "BookingWkYr", "BookingWkMth", "CarrierCode", "MarketGroup", "Sector", "PurchaseLeadDays",
         "RoleCode", "SalesChannel", "CurrencyCode", *_ORG, *_PLACE, *_CTRY], "arith", "organization", True, collapse=True)


def channel_monthly() -> str:
    return channel_report(
        ["BookingYear", "BookingMonth", "CarrierCode", "MarketGroup", "PurchaseLeadDays", "SalesChannel", "CurrencyCode", *_ORG, *_PLACE, *_CTRY],
        "list", "organization", True)


def channel_by_country() -> str:
    return channel_report(
        ["BookingYear", "BookingMonth", "BookingDate", "CarrierCode", "FlightNumber", "MarketGroup", "SalesChannel", "CurrencyCode", "CountryPair",
         "DepCountry", "ArrCountry"], None, None, False, any_leg=True, countries=True)


CLOSED = inlist(fixed.CLOSED_ROUTES)

CHANNEL_JOINS = """LEFT JOIN t_agent_role ar ON ar.AgentID = b.CreatedAgentID LEFT JOIN t_agent ag ON ag.AgentID = b.CreatedAgentID
LEFT JOIN (SELECT DISTINCT RoleCode, SalesChannelRpt FROM t_sales_channel WHERE Status = 'EXIST') sc ON sc.RoleCode = ar.RoleCode"""


def _booked(carrier_test: str, extra: str = "") -> str:
    return f"""
b AS (
  SELECT b.BookingID, b.RecordLocator, b.CurrencyCode AS ccy, b.CreatedAgentID, b.BookingDate + INTERVAL '8' HOUR AS bat, {day("b.BookingDate + INTERVAL '8' HOUR")} AS bd,
    p.PassengerID, p.FirstName, p.LastName, p.DOB, p.Nationality, p.Gender, s.SegmentID, s.DepartureStation AS dep, s.ArrivalStation AS arr, s.DepartureDate, s.JourneyNumber,
    s.Carrier, s.FareClassOfService AS cls, s.InventoryLegID
  FROM t_booking b JOIN t_booking_passenger p ON p.BookingID = b.BookingID JOIN seg s ON s.PassengerID = p.PassengerID
  WHERE b.Status IN (2, 3) AND s.BookingStatus = 'HK' AND {carrier_test} IN (SELECT CarrierCode FROM t_carrier) {extra}
)"""


def _seats(nf: str, frm: str) -> str:
    """One row per passenger and segment with its converted fare."""
    return f"""
st AS (
  SELECT b.* EXCLUDE (InventoryLegID), SUM({nf}.fare * coalesce(x.inv, 1)) AS v FROM b LEFT JOIN {nf} ON {nf}.PassengerID = b.PassengerID AND {nf}.SegmentID = b.SegmentID
  {k.fx_join('x', f"'{frm}'", 'b.ccy', 'b.bd')} GROUP BY ALL
)"""


def older_daily() -> str:
    return f"""
WITH {LEGS}, {FX}, {SEGVIEW}, {NETFARE}, {_booked('s.CarrierCode', f"AND s.DepartureStation || s.ArrivalStation NOT IN {CLOSED}")}, {_seats('netfare', 'MYR')}
SELECT CAST(year(bd) AS INT) AS BookingYear, monthname(bd) AS BookingMonth, 'W' || CAST({k.us_week('bd')} AS VARCHAR) AS BookingWkYr,
  'W' || CAST({k.week_of_month('bd')} AS VARCHAR) AS BookingWkMth, bd AS BookingDate, monthname(b.DepartureDate) AS DepartureMonth,
  CAST(year(b.DepartureDate) AS INT) AS DepartureYear, b.Carrier AS CarrierCode, h.MarketGroup, dep || arr AS FlightPath, b.JourneyNumber,
  {k.lead_list(days('bd', 'b.DepartureDate'))} AS PurchaseLeadDays, ar.RoleCode, b.ccy AS CurrencyCode,
  {k.channel('sc.SalesChannelRpt', 'ag.OrganizationCode', None, 'UnknownRoleCode')} AS SalesChannel, g.Category, g.Grouping AS SalesChannelGrouping,
  CASE WHEN cp.DepartureStation IS NOT NULL THEN CASE WHEN cp.InternationalFlag = 1 THEN 'International' ELSE 'Domestic' END END AS DomInt, cls AS FareClassOfService,
  s1.CountryCode || '-' || s2.CountryCode AS CountryPair, {k.pair('s3.CountryCode', 's4.CountryCode', '-')} AS CountryPairMktGrp,
  COUNT(b.PassengerID) AS SeatSold, {M('SUM(b.v)')} AS BaseFare
FROM st b
LEFT JOIN t_city_pair cp ON cp.DepartureStation = dep AND cp.ArrivalStation = arr LEFT JOIN t_market_group h ON h.DepartureStation = dep AND h.ArrivalStation = arr
LEFT JOIN t_station s1 ON s1.StationCode = dep LEFT JOIN t_station s2 ON s2.StationCode = arr
LEFT JOIN t_station s3 ON s3.StationCode = left(h.MarketGroup, 3) LEFT JOIN t_station s4 ON s4.StationCode = right(h.MarketGroup, 3)
{CHANNEL_JOINS} LEFT JOIN t_sales_channel_group g ON g.ChannelBreakdown = sc.SalesChannelRpt
GROUP BY ALL"""


def older_monthly() -> str:
    week = f"'W' || CAST({k.us_week('bd')} AS VARCHAR)"
    return f"""
WITH {LEGS}, {FX}, {SEGVIEW},
nf AS (
  SELECT PassengerID, SegmentID, SUM(CASE WHEN ChargeType IN (0, 8) THEN ChargeAmount WHEN ChargeType IN (1, 7) THEN -ChargeAmount END) AS fare
  FROM t_passenger_journey_charge GROUP BY 1, 2
), {_booked('s.Carrier', f"AND s.DepartureStation || s.ArrivalStation NOT IN {CLOSED}")}, {_seats('nf', 'MYR')}
SELECT CAST(year(bd) AS INT) AS BookingYear, monthname(bd) AS BookingMonth, {week} AS BookingWkYr, {week} AS BookingWkMth, bd AS BookingDate,
  b.Carrier AS CarrierCode, h.MarketGroup, dep || arr AS FlightPath, b.JourneyNumber, {k.lead_list(days('bd', 'b.DepartureDate'))} AS PurchaseLeadDays,
  ar.RoleCode, b.ccy AS CurrencyCode, {k.channel('sc.SalesChannelRpt', 'ag.OrganizationCode', 'ag.LocationCode', None)} AS SalesChannel,
  COUNT(b.PassengerID) AS SeatSold, {M('SUM(b.v)')} AS BaseFare
FROM st b
LEFT JOIN t_market_group h ON h.DepartureStation = dep AND h.ArrivalStation = arr
{CHANNEL_JOINS}
GROUP BY ALL"""


LIST_SIGN = "CASE WHEN ChargeType IN (1, 2, 3, 7, 16) THEN -coalesce(ChargeAmount, 0) ELSE coalesce(ChargeAmount, 0) END"


def analysis() -> str:
    age = "2000 - year(e.DOB)"
    return f"""
WITH {LEGS}, {FX}, {SEGVIEW}, {NETFARE}, {FEES}, {_booked('s.CarrierCode')},
ap AS (
  SELECT b.*, bc.ProvinceState FROM b LEFT JOIN (SELECT DISTINCT BookingID, ProvinceState FROM t_booking_contact) bc ON bc.BookingID = b.BookingID
),
ssr1 AS (
  SELECT ap.PassengerID, ap.SegmentID, SUM({LIST_SIGN} * x.inv) AS v FROM ap JOIN fees f ON f.PassengerID = ap.PassengerID AND f.FeeLeg = ap.InventoryLegID AND f.FeeLeg > 0
  JOIN fx x ON x.f = 'MYR' AND x.t = ap.ccy AND x.d = ap.bd GROUP BY 1, 2
),
ssr2 AS (
  SELECT ap.PassengerID, ap.SegmentID, SUM({LIST_SIGN} * x.inv) AS v FROM ap JOIN fees f ON f.PassengerID = ap.PassengerID AND f.FeeLeg = 0 AND ap.JourneyNumber = 1
  JOIN fx x ON x.f = 'MYR' AND x.t = ap.ccy AND x.d = ap.bd GROUP BY 1, 2
),
tax AS (SELECT PassengerID, SegmentID, SUM({LIST_SIGN}) AS v FROM t_passenger_journey_charge WHERE ChargeType IN (4, 5) GROUP BY 1, 2),
pay AS (
  SELECT ReferenceID, PaymentMethodCode FROM (SELECT *, row_number() OVER (PARTITION BY ReferenceID ORDER BY PaymentID) AS n FROM t_payment) WHERE n = 1
)
SELECT monthname(e.DepartureDate) AS DepartureMonth, CAST(year(e.DepartureDate) AS VARCHAR) AS DepartureYear, e.bd AS BookingDate, monthname(e.bd) AS BookingMonth,
  CAST(year(e.bd) AS VARCHAR) AS BookingYear, dayname(e.bd) AS DayOfWeek, 'W' || CAST({k.us_week('e.bd')} AS VARCHAR) AS WeekNum,
  {k.lead_to400(days('e.bd', 'e.DepartureDate'))} AS PurchaseLeadDaysBand, {k.age_band(age, k.AGE_ANALYSIS)} AS AgeBand,
  {k.age_band(age, k.AGE_DECADES, 'Unknown')} AS AgeBandJack, CASE WHEN e.Gender = 1 THEN 'Male' ELSE 'Female' END AS Gender,
  CASE WHEN v.InternationalFlag = 1 THEN 'INT' ELSE 'DOM' END AS Flight, e.Carrier AS CarrierCode, e.dep AS DepartureStation, e.arr AS ArrivalStation, e.dep || e.arr AS Route,
  dcn.Name AS DepartingCountry, l.MarketGroup, lb.MarketGroup AS MarketGroup2, CASE WHEN e.cls IN ('C', 'D', 'G', 'J') THEN 'Premium' ELSE 'Economy' END AS Cabin, e.ProvinceState,
  {k.channel('sc.SalesChannelRpt', 'ag.OrganizationCode', None, 'UnknownRoleCode')} AS SalesChannel, {k.payment('pay.PaymentMethodCode')} AS PaymentMethod, e.Nationality,
  CASE WHEN trim(coalesce(nat.Name, '')) = '' THEN 'Unknown' WHEN nat.Name = 'United States of America' THEN 'United States' ELSE nat.Name END AS NationalityFinal,
  pc.Name AS PaymentCountry, e.ccy AS CurrencyCode, COUNT(e.PassengerID) AS Guests, {M('SUM(nf.fare * coalesce(x.inv, 1))')} AS BaseFare,
  {M('SUM(s1.v) + SUM(s2.v)')} AS SSR, {M('SUM(tax.v * coalesce(x.inv, 1))')} AS AirportTax
FROM (SELECT * FROM ap WHERE dep || arr NOT IN {CLOSED}) e
LEFT JOIN netfare nf ON nf.PassengerID = e.PassengerID AND nf.SegmentID = e.SegmentID LEFT JOIN tax ON tax.PassengerID = e.PassengerID AND tax.SegmentID = e.SegmentID
LEFT JOIN ssr1 s1 ON s1.PassengerID = e.PassengerID AND s1.SegmentID = e.SegmentID LEFT JOIN ssr2 s2 ON s2.PassengerID = e.PassengerID AND s2.SegmentID = e.SegmentID
{k.fx_join('x', "'MYR'", 'e.ccy', 'e.bd')} LEFT JOIN pay ON pay.ReferenceID = e.BookingID
{CHANNEL_JOINS.replace('b.Created', 'e.Created')}
LEFT JOIN t_market_group l ON l.DepartureStation = e.dep AND l.ArrivalStation = e.arr LEFT JOIN t_market_group_dmk lb ON lb.DepartureStation = e.dep AND lb.ArrivalStation = e.arr
LEFT JOIN t_city_pair v ON v.DepartureStation = e.dep AND v.ArrivalStation = e.arr
JOIN t_station ds ON ds.StationCode = e.dep JOIN t_country dcn ON dcn.CountryCode = ds.CountryCode
LEFT JOIN t_country nat ON nat.CountryCode = e.Nationality LEFT JOIN t_country pc ON pc.CountryCode = left(e.ccy, 2)
GROUP BY ALL"""


def china() -> str:
    age = "2000 - year(b.DOB)"
    return f"""
WITH {LEGS}, {FX}, {SEGVIEW}, {NETFARE}, {_booked('s.CarrierCode', "AND p.Nationality IN ('CN', 'HK', 'MO')")},
bc AS (
  SELECT DISTINCT BookingID, lower(EmailAddress) AS email, upper(ProvinceState) AS prov, upper(trim(City)) AS city, CountryCode, rtrim(upper(FirstName)) AS fn, rtrim(upper(LastName)) AS ln
  FROM t_booking_contact
), {_seats('netfare', 'CNY')}
SELECT monthname(bat) AS BookingMonth, CAST(year(bat) AS INT) AS BookingYear, dep AS DepartureStation, arr AS ArrivalStation, dep || arr AS Route, b.Carrier AS CarrierCode,
  CASE WHEN b.Gender = 1 THEN 'Male' ELSE 'Female' END AS Gender, co.Name AS Nationality, pv.Name AS ProvinceState, bc.city AS City, bc.email AS EmailAddress,
  b.FirstName, b.LastName, CASE WHEN e.InternationalFlag = 1 THEN 'INT' ELSE 'DOM' END AS DomInt, {k.age_band(age, k.AGE_CHINA, 'Unknown')} AS AgeGroup,
  {k.lead_coarse(days('bd', 'b.DepartureDate'))} AS PurchaseLeadDays, {k.channel('sc.SalesChannelRpt', 'ag.OrganizationCode', None, 'UnknownRoleCode')} AS SalesChannel,
  COUNT(b.PassengerID) AS TotalSeatSold, COUNT(DISTINCT b.RecordLocator) AS TotalBooking, {M('SUM(b.v)')} AS TotalBaseFareCNY
FROM st b LEFT JOIN bc ON bc.BookingID = b.BookingID AND bc.fn = rtrim(upper(b.FirstName)) AND bc.ln = rtrim(upper(b.LastName))
LEFT JOIN t_province_state pv ON pv.CountryCode = bc.CountryCode AND pv.ProvinceStateCode = bc.prov
LEFT JOIN t_city_pair e ON e.DepartureStation = dep AND e.ArrivalStation = arr LEFT JOIN t_country co ON co.CountryCode = b.Nationality
{CHANNEL_JOINS}
GROUP BY ALL"""


def china_months() -> str:
    return f"""
WITH {LEGS}, {SEGVIEW}, {_booked('s.CarrierCode', "AND p.Nationality IN ('CN', 'HK', 'MO')")}
SELECT DISTINCT CAST(year(bat) AS VARCHAR) AS BookingYear, monthname(bat) AS BookingMonth, monthname(bat) || CAST(year(bat) AS VARCHAR) AS BookingMthYr FROM b"""


# ---------------------------------------------------------------- routes

LOCAL_NOW = "TIMESTAMP '2000-06-15 12:30:00'"
CAPTURED = "TIMESTAMP '2000-06-14 00:00:00'"
STAMPS = f"{CAPTURED} AS CapturedDate, CAST(dayofyear({CAPTURED}) AS INT) AS DayOfYear, CAST(dayofweek({CAPTURED}) + 1 AS INT) AS DayOfWeek"
SEASON = "TIMESTAMP '2000-01-01' AND TIMESTAMP '2001-05-31 23:59:00'"
BOOKED_BEFORE = "s.CreatedDate + INTERVAL '8' HOUR < TIMESTAMP '2000-06-15'"

ROUTE = {
    "d7": dict(
        keep="{c} = 'D7' AND {f} NOT IN ('2994','2995','2996','2997','2998','2999','216','217','218','219','620','621')", fee="v.CarrierCode = 'D7'",
        label="{c}", extras=True, matrix=False, seats=fixed.PREMIUM_SEATS, eco={}, tax=True, currencies=[("", "MYR", "mul")],
    ),
    "xt": dict(
        keep="({c} = 'XT' OR {c} = 'D7' AND {f} IN ('216','217','218','219'))",
        fee="(v.CarrierCode = 'XT' OR v.CarrierCode = 'D7' AND v.FlightNo IN ('216','217','218','219'))", label="{c}", extras=False, matrix=True,
        seats=fixed.PREMIUM_SEATS_333, eco={}, tax=False, currencies=[("", "USD", "div")],
    ),
    "xj": dict(
        keep="({c} = 'XJ' OR {c} = 'D7' AND {f} IN ('620','621'))", fee="(v.CarrierCode = 'XJ' OR v.CarrierCode = 'D7' AND v.FlightNo IN ('620','621'))",
        label="CASE WHEN {c} = 'D7' THEN 'XJ' ELSE {c} END", extras=False, matrix=True, seats=fixed.PREMIUM_SEATS_333, eco={(330, "F"): 12}, tax=False,
        currencies=[("THB", "THB", "div"), ("MYR", "MYR", "div")],
    ),
}


def _cabins(seats: dict, eco: dict, source: str, columns: str) -> str:
    prem = " ".join(f"WHEN EquipmentType = {a} AND EquipmentTypeSuffix = '{b}' THEN {n}" for (a, b), n in seats.items())
    econ = " ".join(f"WHEN EquipmentType = {a} AND EquipmentTypeSuffix = '{b}' THEN Capacity - {n}" for (a, b), n in {**seats, **eco}.items())
    return f"""SELECT DISTINCT {columns}, EquipmentType, EquipmentTypeSuffix, 'Premium' AS Cabin, CASE {prem} ELSE 0 END AS seats FROM {source}
  UNION SELECT DISTINCT {columns}, EquipmentType, EquipmentTypeSuffix, 'Economy', CASE {econ} ELSE 0 END FROM {source}"""


def _route_ctes(name: str, fanout: bool) -> tuple[str, list[str], list[str]]:
    r = ROUTE[name]
    buckets = ["BaseFare", "FuelSurcharge"] + (["ThruFare", "XHISEA", "ADM"] if r["extras"] else [])
    revenue = [f"{b}{tag}" for tag, _, _ in r["currencies"] for b in buckets]
    anc = [f"Ancillary{tag}" for tag, _, _ in r["currencies"]]
    amount = "coalesce(c.ChargeAmount, 0) * x.PositiveNegativeFlag" if r["matrix"] else LIST_SIGN.replace("Charge", "c.Charge")
    source = "t_passenger_journey_charge c LEFT JOIN t_charge_type_matrix x ON x.ChargeTypeID = c.ChargeType"
    codes = {"FuelSurcharge": "('FUEL','DOMS','FUEX')", "ThruFare": "('THRU')", "XHISEA": "('XHISEA')", "ADM": "('ADM')"}
    ctes = []
    if fanout:
        # The unaggregated side-by-side join, rows and all.
        for t in (0, 1, 7):
            ctes.append(f"r{t} AS (SELECT PassengerID, SegmentID, {amount} AS v FROM {source} WHERE c.ChargeType = {t})")
        for b in buckets[1:]:
            ctes.append(f"c{b} AS (SELECT PassengerID, SegmentID, SUM({amount}) AS v FROM {source} WHERE c.ChargeCode IN {codes[b]} GROUP BY 1, 2)")
        joins = " ".join(f"LEFT JOIN r{t} ON r{t}.PassengerID = s.PassengerID AND r{t}.SegmentID = s.SegmentID" for t in (0, 1, 7))
        joins += " " + " ".join(f"LEFT JOIN c{b} ON c{b}.PassengerID = s.PassengerID AND c{b}.SegmentID = s.SegmentID" for b in buckets[1:])
        value = {"BaseFare": "coalesce(r0.v, 0) + coalesce(r1.v, 0) + coalesce(r7.v, 0)", **{b: f"coalesce(c{b}.v, 0)" for b in buckets[1:]}}
    else:
        cols = [f"SUM(CASE WHEN c.ChargeType IN (0, 1, 7) THEN {amount} END) AS BaseFare"]
        cols += [f"SUM(CASE WHEN c.ChargeCode IN {codes[b]} THEN {amount} END) AS {b}" for b in buckets[1:]]
        ctes.append(f"tot AS (SELECT PassengerID, SegmentID, {', '.join(cols)} FROM {source} GROUP BY 1, 2)")
        joins = "LEFT JOIN tot ON tot.PassengerID = s.PassengerID AND tot.SegmentID = s.SegmentID"
        value = {b: f"coalesce(tot.{b}, 0)" for b in buckets}
    fxs, ancfx, sums, ancsums = "", "", [], []
    for i, (tag, target, mode) in enumerate(r["currencies"]):
        if mode == "mul":
            fxs += " " + k.fx_join(f"x{i}", "bk.CurrencyCode", f"'{target}'", day("s.CreatedDate"))
            ancfx += " " + k.fx_join(f"x{i}", "f.ccy", f"'{target}'", day("f.CreatedDate"))
            rate = f"coalesce(x{i}.rate, 1)"
        else:
            fxs += " " + k.fx_join(f"x{i}", f"'{target}'", "bk.CurrencyCode", day("s.CreatedDate"))
            ancfx += " " + k.fx_join(f"x{i}", f"'{target}'", "f.ccy", day("f.CreatedDate"))
            rate = f"coalesce(x{i}.inv, 1)"
        sums += [f"{M(f'SUM(({value[b]}) * {rate})')} AS {b}{tag}" for b in buckets]
        ancsums.append(f"{M(f'SUM(f.amt * {rate})')} AS Ancillary{tag}")
    fee_amt = "coalesce(c.ChargeAmount * x.PositiveNegativeFlag, 0)" if r["matrix"] else LIST_SIGN.replace("Charge", "c.Charge")
    lab = r["label"]
    ctes.append(f"""
base AS (
  SELECT s.PassengerID, bk.RecordLocator, s.DepartureDate, {lab.format(c='s.Carrier')} AS CarrierCode, s.FlightNo AS FlightNumber, s.DepartureStation || s.ArrivalStation AS Route,
    CASE WHEN s.FareClassOfService IN ('C','D','G','J','G1') THEN 'Premium' ELSE 'Economy' END AS Cabin, s.FareClassOfService, fc.FareClass, bk.CurrencyCode, s.CreatedAgentID,
    {', '.join(sums)}
  FROM seg s {joins} LEFT JOIN t_booking_passenger bp ON bp.PassengerID = s.PassengerID LEFT JOIN t_booking bk ON bk.BookingID = bp.BookingID {fxs}
  LEFT JOIN (SELECT DISTINCT trim(ClassOfService) AS cls, FareClass FROM t_fare_class) fc ON fc.cls = s.FareClassOfService
  WHERE s.BookingStatus = 'HK' AND {BOOKED_BEFORE} AND s.DepartureDate BETWEEN {SEASON} AND {r['keep'].format(c='s.Carrier', f='s.FlightNo')}
  GROUP BY ALL
),
feed AS (
  SELECT DISTINCT b.PassengerID, v.FeeNumber, v.FeeCode, v.DepartureDate, {lab.format(c='v.CarrierCode')} AS CarrierCode, v.FlightNo, v.DepartureStation, v.ArrivalStation,
    c.CurrencyCode AS ccy, c.CreatedDate, {fee_amt} AS amt
  FROM base b JOIN feeview v ON v.PassengerID = b.PassengerID LEFT JOIN t_passenger_fee_charge c ON c.PassengerID = v.PassengerID AND c.FeeNumber = v.FeeNumber
  LEFT JOIN t_charge_type_matrix x ON x.ChargeTypeID = c.ChargeType WHERE {r['fee']}
),
ancd AS (
  SELECT f.PassengerID, f.DepartureDate, f.CarrierCode, f.FlightNo, f.DepartureStation || f.ArrivalStation AS Route, f.ccy, {', '.join(ancsums)} FROM feed f {ancfx} GROUP BY ALL
),
sold AS (
  SELECT a.RecordLocator, a.DepartureDate, a.CarrierCode, a.FlightNumber, a.Route, a.FareClassOfService, a.FareClass, a.Cabin, a.CurrencyCode, COUNT(a.PassengerID) AS n,
    {', '.join(f'SUM(a.{c}) AS {c}' for c in revenue)}, {', '.join(f'coalesce(SUM(e.{c}), 0) AS {c}' for c in anc)}
  FROM (SELECT DISTINCT * EXCLUDE (CreatedAgentID) FROM base) a
  LEFT JOIN (SELECT DISTINCT * EXCLUDE (ccy) FROM ancd) e ON e.PassengerID = a.PassengerID AND e.CarrierCode = a.CarrierCode AND e.FlightNo = a.FlightNumber
    AND e.DepartureDate = a.DepartureDate AND e.Route = a.Route
  GROUP BY ALL
),
il AS (
  SELECT l.InventoryLegKey, l.DepartureDate, {lab.format(c='l.Carrier')} AS CarrierCode, l.FlightNo AS FlightNumber, l.DepartureStation, l.ArrivalStation, {k.market('cp.CityPairGroup')} AS ODPair,
    l.EquipmentType, l.EquipmentTypeSuffix, l.Capacity
  FROM legs l LEFT JOIN t_city_pair cp ON cp.DepartureStation = l.DepartureStation AND cp.ArrivalStation = l.ArrivalStation
  WHERE l.Status <> 2 AND l.Lid > 0 AND l.DepartureDate BETWEEN {SEASON} AND {r['keep'].format(c='l.Carrier', f='l.FlightNo')}
),
inv AS ({_cabins(r['seats'], r['eco'], 'il', 'InventoryLegKey, DepartureDate, CarrierCode, FlightNumber, DepartureStation, ArrivalStation, ODPair')}),
fi AS (SELECT DISTINCT InventoryLegKey, DepartureDate, CarrierCode, FlightNumber, DepartureStation, ArrivalStation FROM inv),
rev AS (
  SELECT {k.market('j.CityPairGroup')} AS ODPair, monthname(f.DepartureDate) AS m, CAST(year(f.DepartureDate) AS INT) AS y, f.CarrierCode, f.FlightNumber, f.Route, f.FareClassOfService, f.FareClass, f.Cabin,
    f.CurrencyCode, {I('SUM(f.n)')} AS SeatSold, {', '.join(f"{M(f'SUM(f.{c})')} AS {c}" for c in revenue + anc)}
  FROM sold f JOIN fi ON fi.DepartureDate = f.DepartureDate AND fi.CarrierCode = f.CarrierCode AND fi.FlightNumber = f.FlightNumber
  JOIN t_city_pair j ON j.DepartureStation = fi.DepartureStation AND j.ArrivalStation = fi.ArrivalStation GROUP BY ALL
),
tax AS (
  SELECT rev.Route, rev.ODPair, m, y, rev.FlightNumber, rev.Cabin, SUM(SeatSold * fee.FeeMYR) AS apt FROM rev
  LEFT JOIN t_airport_fee fee ON fee.CarrierCode = rev.CarrierCode AND fee.Sector = rev.Route AND DATE '2000-06-14' BETWEEN fee.VersionStartDate AND fee.VersionEndDate
  GROUP BY ALL
)""")
    return f"{LEGS}, {FX}, {SEGVIEW}, {FEEVIEW}, " + ", ".join(ctes), revenue, anc


def route_passengers(name: str, fanout: bool = False) -> str:
    ctes, revenue, _ = _route_ctes(name, fanout)
    who = "PassengerID, RecordLocator, DepartureDate, CarrierCode, FlightNumber, Route, Cabin, FareClassOfService, FareClass, CurrencyCode, CreatedAgentID"
    return f"WITH {ctes} SELECT {STAMPS}, {who}, {', '.join(revenue)} FROM base"


def route_classes(name: str) -> str:
    ctes, revenue, anc = _route_ctes(name, False)
    return f"""WITH {ctes}
SELECT 'hub' AS Hub, {CAPTURED} AS CapturedDate, ODPair, m AS DepartureMonth, y AS DepartureYear, CarrierCode, FlightNumber, Route, FareClassOfService, FareClass, Cabin, CurrencyCode,
  SeatSold, {', '.join(revenue + anc)} FROM rev"""


def route_inventory(name: str) -> str:
    ctes, revenue, anc = _route_ctes(name, False)
    tax = ROUTE[name]["tax"]
    values = ", ".join(f"{M(f'coalesce(s.{c}, 0)')} AS {c}" for c in revenue + anc)
    hub = k.hub_lookup("i.CarrierCode", "i.FlightNumber", "i.ODPair", "CASE WHEN i.ODPair IS NOT NULL THEN 'hub' END")
    return f"""WITH {ctes},
i AS (
  SELECT Cabin, monthname(DepartureDate) AS m, CAST(year(DepartureDate) AS INT) AS y, FlightNumber, CarrierCode, DepartureStation || ArrivalStation AS Route, ODPair, {I('SUM(seats)')} AS Capacity
  FROM inv GROUP BY ALL
),
s AS (SELECT ODPair, m, y, CarrierCode, FlightNumber, Route, Cabin, {I('SUM(SeatSold)')} AS SeatSold, {', '.join(f'SUM({c}) AS {c}' for c in revenue + anc)} FROM rev GROUP BY ALL)
SELECT DISTINCT {hub} AS Hub, i.ODPair, {STAMPS}, i.m AS DepartureMonth, i.y AS DepartureYear, i.FlightNumber, i.CarrierCode, i.Route, i.Cabin,
  coalesce(s.SeatSold, 0) AS SeatsSold, {values}, i.Capacity, {M('tax.apt') if tax else M('0')} AS AptCharge, 0 AS AptEnabled
FROM i LEFT JOIN s ON s.m = i.m AND s.y = i.y AND s.FlightNumber = i.FlightNumber AND s.Cabin = i.Cabin AND s.Route = i.Route AND s.ODPair = i.ODPair
{'LEFT JOIN tax ON tax.m = i.m AND tax.y = i.y AND tax.FlightNumber = i.FlightNumber AND tax.Cabin = i.Cabin AND tax.Route = i.Route AND tax.ODPair = i.ODPair' if tax else ''}"""


def route_fare_class(name: str) -> str:
    ctes, revenue, anc = _route_ctes(name, False)
    tax = ROUTE[name]["tax"]
    hub = k.hub_lookup("i.CarrierCode", "i.FlightNumber", "s.ODPair", "CASE WHEN s.Route IS NOT NULL THEN 'hub' END")
    return f"""WITH {ctes},
i AS (SELECT DISTINCT DepartureStation || ArrivalStation AS Route, monthname(DepartureDate) AS m, CAST(year(DepartureDate) AS INT) AS y, FlightNumber, CarrierCode FROM inv),
tf AS (SELECT m, y, FlightNumber, SUM(apt) AS apt FROM tax GROUP BY ALL)
SELECT DISTINCT {hub} AS Hub, s.ODPair, CASE WHEN s.Route IS NOT NULL THEN {CAPTURED} END AS CapturedDate, CAST(dayofyear({CAPTURED}) AS INT) AS DayOfYear,
  CAST(dayofweek({CAPTURED}) + 1 AS INT) AS DayOfWeek, i.m AS DepartureMonth, i.y AS DepartureYear, i.FlightNumber, i.CarrierCode, s.Route, s.FareClass, s.FareClassOfService,
  s.SeatSold, {', '.join('s.' + c for c in revenue + anc)}, {M('tf.apt') if tax else M('0')} AS AptCharge, 0 AS AptEnabled
FROM i {'JOIN tf ON tf.m = i.m AND tf.y = i.y AND tf.FlightNumber = i.FlightNumber' if tax else ''}
LEFT JOIN rev s ON s.Route = i.Route AND s.m = i.m AND s.y = i.y AND s.FlightNumber = i.FlightNumber"""


def all_carriers(merged: bool) -> str:
    buckets = {
        "BaseFare": "c.ChargeType IN (0, 1, 7)", "FuelSurcharge": "c.ChargeCode IN ('FUEL','DOMS','FUEX')", "Connecting": "c.ChargeType = 8",
        "AptCharges": "c.ChargeCode = 'APF'", "ThruFare": "c.ChargeCode = 'THRU'", "XHISEA": "c.ChargeCode = 'XHISEA'", "ADM": "c.ChargeCode = 'ADM'",
    }
    amount = LIST_SIGN.replace("Charge", "c.Charge")
    strict = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in fixed.HOME_CURRENCY_STRICT.items())
    own = f"CASE s.Carrier {strict} END"
    cols = [f"{M(f'SUM(coalesce(tot.{b}, 0) * m.inv)')} AS {b}RM" for b in buckets]
    cols += [f"{M(f'SUM(coalesce(tot.{b}, 0) * CASE WHEN {own} IS NOT NULL THEN coalesce(h.inv, 1) END)')} AS {b}AirlineCurrency" for b in buckets]
    names = [f"{b}{x}" for x in ("RM", "AirlineCurrency") for b in buckets]
    kno = "CASE WHEN {0} = 'MES' THEN 'KNO' ELSE {0} END"
    fd = "Carrier = 'FD' AND FlightNo IN ('2496', '2497') AND DepartureDate < DATE '2014-02-21'"
    sums = f"{I('SUM(n)')} AS SeatsSold, {I('SUM(Lid)')} AS Lid, {I('SUM(Capacity)')} AS Capacity, " + ", ".join(f"{M(f'SUM({c})')} AS {c}" for c in names)
    resum = ", ".join(f"{I(f'SUM({c})')} AS {c}" for c in ("SeatsSold", "Lid", "Capacity")) + ", " + ", ".join(f"{M(f'SUM({c})')} AS {c}" for c in names)
    hub = k.hub_lookup("q.CarrierCode", "q.FlightNumber", "q.ODPair", "'hub'")
    first = f"SELECT {STAMPS}, q.*, {hub} AS Hub FROM q"
    last = first if not merged else f"""
SELECT {STAMPS}, DepartureYear, DepartureMonth, CASE WHEN CarrierCode = 'PQ' THEN 'Z2' ELSE CarrierCode END AS CarrierCode, FlightNumber, ODPair, Hub, {resum}
FROM (SELECT q.*, {hub} AS Hub FROM q) z GROUP BY DepartureYear, DepartureMonth, CASE WHEN CarrierCode = 'PQ' THEN 'Z2' ELSE CarrierCode END, FlightNumber, ODPair, Hub"""
    return f"""
WITH {LEGS}, {FX}, {SEGVIEW},
tot AS (SELECT c.PassengerID, c.SegmentID, {', '.join(f'SUM(CASE WHEN {cond} THEN {amount} END) AS {b}' for b, cond in buckets.items())} FROM t_passenger_journey_charge c GROUP BY 1, 2),
seats AS (
  SELECT s.DepartureDate, s.Carrier, s.FlightNo, s.DepartureStation, s.ArrivalStation, COUNT(s.PassengerID) AS n, {', '.join(cols)}
  FROM seg s LEFT JOIN tot ON tot.PassengerID = s.PassengerID AND tot.SegmentID = s.SegmentID
  {k.fx_join('m', "'MYR'", 's.CurrencyCode', day('s.CreatedDate'))} {k.fx_join('h', own, 's.CurrencyCode', day('s.CreatedDate'))}
  WHERE s.BookingStatus = 'HK' AND {BOOKED_BEFORE} AND s.DepartureDate BETWEEN {SEASON} AND s.CarrierCode IN {inlist(fixed.GROUP_CARRIERS)}
    AND s.Carrier || ' ' || s.FlightNo NOT IN {inlist(fixed.CLOSED_FLIGHTS)}
  GROUP BY ALL
),
seats2 AS (SELECT * REPLACE ({kno.format('DepartureStation')} AS DepartureStation, {kno.format('ArrivalStation')} AS ArrivalStation) FROM seats WHERE NOT ({fd})),
il AS (
  SELECT l.* EXCLUDE (DepartureStation, ArrivalStation), {kno.format('l.DepartureStation')} AS DepartureStation, {kno.format('l.ArrivalStation')} AS ArrivalStation, {k.market('cp.CityPairGroup')} AS od
  FROM legs l LEFT JOIN t_city_pair cp ON cp.DepartureStation = l.DepartureStation AND cp.ArrivalStation = l.ArrivalStation
  WHERE l.Status <> 2 AND l.Lid > 0 AND l.DepartureDate BETWEEN {SEASON} AND (l.CreatedDate <= TIMESTAMP '2000-06-15' OR l.ModifiedDate <= TIMESTAMP '2000-06-15')
    AND l.Carrier || ' ' || l.FlightNo NOT IN {inlist(fixed.CLOSED_FLIGHTS)} AND NOT ({fd.replace('Carrier', 'l.Carrier').replace('Flight', 'l.Flight').replace('DepartureDate', 'l.DepartureDate')})
),
inv AS (
  SELECT il.InventoryLegKey, il.DepartureDate, il.Carrier, il.FlightNo, il.OpSuffix, il.DepartureStation, il.ArrivalStation,
    CASE WHEN cp.DepartureStation IS NOT NULL THEN {k.market('cp.CityPairGroup')} ELSE il.od END AS ODPair, SUM(il.Lid) AS Lid, SUM(il.Capacity) AS Capacity
  FROM il LEFT JOIN t_city_pair cp ON cp.DepartureStation = il.DepartureStation AND cp.ArrivalStation = il.ArrivalStation GROUP BY ALL
),
q AS (
  SELECT CAST(year(i.DepartureDate) AS VARCHAR) AS DepartureYear, monthname(i.DepartureDate) AS DepartureMonth, i.Carrier AS CarrierCode, i.FlightNo AS FlightNumber, i.ODPair, {sums}
  FROM inv i LEFT JOIN seats2 s ON s.Carrier = i.Carrier AND s.FlightNo = i.FlightNo AND s.DepartureDate = i.DepartureDate AND s.DepartureStation = i.DepartureStation AND s.ArrivalStation = i.ArrivalStation
  GROUP BY 1, 2, 3, 4, 5
)
{last}"""


def finance() -> str:
    amount = "c.ChargeAmount * x.PositiveNegativeFlag"
    cols, names, joins = [], [], ""
    for c in fixed.FINANCE_CURRENCIES:
        joins += " " + k.fx_join(f"x{c}", f"'{c}'", "bk.CurrencyCode", day("bk.BookingDate"))
        for b in ("BaseFare", "FuelSurcharge"):
            n = f"{b}{'RM' if c == 'MYR' else c}"
            names.append(n)
            cols.append(f"{M(f'SUM(coalesce(tot.{b}, 0) * coalesce(x{c}.inv, 1))')} AS {n}")
    flight = "DepartureDate, Carrier, FlightNo, Route"
    vals = ", ".join(names)
    head = f"""{LOCAL_NOW} AS CapturedDate, CAST(year(r.DepartureDate) AS INT) AS YearInt, CAST(month(r.DepartureDate) AS INT) AS MonthInt,
  left(monthname(r.DepartureDate), 3) || '-' || right(CAST(year(r.DepartureDate) AS VARCHAR), 2) AS Month, r.DepartureDate, r.Carrier AS CarrierCode, r.FlightNo AS FlightNumber, r.Route,
  r.ccy AS CurrencyCode, r.seats AS SeatsSold, r.Capacity, r.ActualDistance, r.ActualDistanceUnit, r.ActualDistanceUnit AS FlightCount, {vals}"""
    return f"""
WITH {LEGS}, {FX}, {SEGVIEW},
tot AS (
  SELECT c.PassengerID, c.SegmentID, SUM(CASE WHEN c.ChargeType IN (0, 8, 1, 7) THEN {amount} END) AS BaseFare, SUM(CASE WHEN c.ChargeCode IN ('FUEL','DOMS','FUEX') THEN {amount} END) AS FuelSurcharge
  FROM t_passenger_journey_charge c LEFT JOIN t_charge_type_matrix x ON x.ChargeTypeID = c.ChargeType GROUP BY 1, 2
),
s AS (
  SELECT s.DepartureDate, s.Carrier, s.FlightNo, s.InventoryLegID, s.DepartureStation || s.ArrivalStation AS Route, bk.CurrencyCode AS ccy, COUNT(s.PassengerID) AS seats, {', '.join(cols)}
  FROM seg s LEFT JOIN tot ON tot.PassengerID = s.PassengerID AND tot.SegmentID = s.SegmentID
  LEFT JOIN t_booking_passenger bp ON bp.PassengerID = s.PassengerID LEFT JOIN t_booking bk ON bk.BookingID = bp.BookingID {joins}
  WHERE s.BookingStatus = 'HK' AND s.CarrierCode IN (SELECT CarrierCode FROM t_carrier WHERE CarrierType = 'H' AND CarrierCode <> 'BF') GROUP BY ALL
),
n AS (SELECT *, row_number() OVER (PARTITION BY Carrier, FlightNo, InventoryLegID, DepartureDate, Route ORDER BY ccy NULLS FIRST) AS rn FROM s),
r AS (
  SELECT n.{flight.replace(', ', ', n.')}, n.ccy, n.seats, l.Capacity, coalesce(d.ActualDistance, cp.ActualDistance) AS ActualDistance,
    coalesce(d.ActualDistanceUnit, cp.ActualDistanceUnit) AS ActualDistanceUnit, {vals}, rn
  FROM n JOIN t_inventory_leg l ON l.InventoryLegID = n.InventoryLegID AND l.Lid > 0 AND l.Status <> 2
  LEFT JOIN t_distance d ON d.DepartureStation = l.DepartureStation AND d.ArrivalStation = l.ArrivalStation
  LEFT JOIN t_city_pair cp ON cp.DepartureStation = l.DepartureStation AND cp.ArrivalStation = l.ArrivalStation WHERE rn = 1
  UNION SELECT {flight}, ccy, seats, 0, 0, 0, {vals}, rn FROM n WHERE rn >= 2
),
g AS (SELECT {flight}, SUM(seats) AS seats, SUM(Capacity) AS cap, SUM(ActualDistance) AS km FROM r GROUP BY ALL)
SELECT {head}, {I('g.seats * g.km')} AS PassengerMiles, {I('g.cap * g.km')} AS ASM
FROM r LEFT JOIN g ON g.DepartureDate = r.DepartureDate AND g.Carrier = r.Carrier AND g.FlightNo = r.FlightNo AND g.Route = r.Route WHERE rn = 1
UNION SELECT {head}, 0, 0 FROM r WHERE rn > 1"""


def pax_capacity() -> str:
    return f"""
WITH {LEGS},
f AS (
  SELECT l.DepartureDate, l.Carrier AS CarrierCode, l.FlightNo AS FlightNumber, l.DepartureStation, l.ArrivalStation, s.International, l.AdjustedCapacity AS Capacity, COUNT(DISTINCT s.SegmentID) AS Pax
  FROM legs l JOIN t_passenger_journey_leg pl ON pl.InventoryLegID = l.InventoryLegID JOIN t_passenger_journey_segment s ON s.PassengerID = pl.PassengerID AND s.SegmentID = pl.SegmentID
  JOIN t_booking_passenger bp ON bp.PassengerID = s.PassengerID JOIN t_booking b ON b.BookingID = bp.BookingID AND b.Status IN (2, 3)
  WHERE l.CarrierCode <> 'BF' AND l.Status <> 2 AND l.Lid > 0 GROUP BY ALL
),
g AS (SELECT *, {k.pair('DepartureStation', 'ArrivalStation')} AS Route, DepartureStation || ArrivalStation AS Sector FROM f)
SELECT g.*, {k.hub_lookup('g.CarrierCode', 'g.FlightNumber', 'g.Route', "'hub'")} AS Hub FROM g"""


# ---------------------------------------------------------------- year on year

YOY = {"d7": ("RM", "MYR", "mul", "s.CarrierCode = 'D7'"), "xj": ("THB", "THB", "div", "s.Carrier = 'XJ'")}
YOY_BUCKETS = ["BaseFare", "FuelSurcharge", "ThruFare", "XHISEA", "ADM"]


def route_performance(name: str) -> str:
    unit, target, mode, carrier = YOY[name]
    special = inlist(fixed.D7_SPECIAL)
    amount = LIST_SIGN.replace("Charge", "c.Charge")

    def rate(alias: str, ccy: str, on: str) -> tuple[str, str]:
        if mode == "mul":
            return k.fx_join(alias, ccy, f"'{target}'", on), f"coalesce({alias}.rate, 1)"
        return k.fx_join(alias, f"'{target}'", ccy, on), f"coalesce({alias}.inv, 1)"

    def totals(tag: str, first: str) -> str:
        fare = " + ".join(f"coalesce(SUM(CASE WHEN {c} THEN {amount} END), 0)" for c in (first, "c.ChargeType = 1", "c.ChargeType = 7"))
        codes = {"FuelSurcharge": "('FUEL','DOMS','FUEX')", "ThruFare": "('THRU')", "XHISEA": "('XHISEA')", "ADM": "('ADM')"}
        rest = ", ".join(f"coalesce(SUM(CASE WHEN c.ChargeCode IN {v} THEN {amount} END), 0) AS {b}" for b, v in codes.items())
        return f"tot{tag} AS (SELECT PassengerID, SegmentID, {fare} AS BaseFare, {rest} FROM t_passenger_journey_charge c GROUP BY 1, 2)"

    def people(tag: str, tot: str, booked: str, departs: str, status: str, premium: str) -> str:
        join, r = rate("x", "bk.CurrencyCode", day("s.CreatedDate"))
        sums = ", ".join(f"{M(f'SUM(coalesce(t.{b}, 0) * {r})')} AS {b}" for b in YOY_BUCKETS)
        return f"""
p{tag} AS (
  SELECT s.PassengerID, bk.RecordLocator, s.DepartureDate, s.Carrier, s.FlightNo, s.DepartureStation || s.ArrivalStation AS Route,
    CASE WHEN s.FareClassOfService IN {premium} THEN 'Premium' ELSE 'Economy' END AS Cabin, {sums}
  FROM seg s LEFT JOIN {tot} t ON t.PassengerID = s.PassengerID AND t.SegmentID = s.SegmentID LEFT JOIN t_booking_passenger bp ON bp.PassengerID = s.PassengerID
  LEFT JOIN t_booking bk ON bk.BookingID = bp.BookingID {join}
  WHERE {booked} AND s.DepartureDate BETWEEN {departs} AND s.FlightNo NOT IN {special} AND {carrier} {status} GROUP BY ALL
),
w{tag} AS (
  SELECT p.Carrier, p.FlightNo, p.Route, p.DepartureDate, p.Cabin, COUNT(p.PassengerID) AS SeatsSold, {', '.join(f'SUM(p.{b}) AS {b}' for b in YOY_BUCKETS)}, coalesce(SUM(e.anc), 0) AS AncillaryAmount
  FROM p{tag} p LEFT JOIN extras e ON e.PassengerID = p.PassengerID AND e.CarrierCode = p.Carrier AND e.FlightNo = p.FlightNo AND e.DepartureDate = p.DepartureDate AND e.Route = p.Route GROUP BY ALL
),
k{tag} AS (
  SELECT CAST(year(i.DepartureDate) AS INT) AS y, monthname(i.DepartureDate) AS mo, CAST({k.us_week('i.DepartureDate')} AS VARCHAR) AS wk, i.Carrier,
    CASE i.Route WHEN 'KULSTN' THEN 'KULLGW' WHEN 'STNKUL' THEN 'LGWKUL' WHEN 'TSNKUL' THEN 'PEKKUL' WHEN 'KULTSN' THEN 'KULPEK' ELSE i.Route END AS Route, i.Cabin, i.Route AS raw,
    {I('SUM(i.seats)')} AS Capacity, {I('SUM(coalesce(w.SeatsSold, 0))')} AS SeatsSold, {', '.join(f"{M(f'SUM(coalesce(w.{b}, 0))')} AS {b}" for b in YOY_BUCKETS + ['AncillaryAmount'])}
  FROM inv i LEFT JOIN w{tag} w ON w.Carrier = i.Carrier AND w.FlightNo = i.FlightNo AND w.Route = i.Route AND w.DepartureDate = i.DepartureDate AND w.Cabin = i.Cabin GROUP BY ALL
)"""

    def names(tag: str) -> dict[str, str]:
        mid = f"{tag}_" if tag else ""
        tail = f"_{tag}" if tag else ""
        return {"SeatsSold": f"SeatsSold{tail}", "Capacity": f"Capacity{tail}", **{b: f"{b}_{mid}{unit}" for b in YOY_BUCKETS + ["AncillaryAmount"]}}

    def branch(year: int, y1: str, y1m: str) -> str:
        cols = [f"a.{c} AS {n}" for c, n in names("").items()] + [f"b.{c} AS {n}" for c, n in names("Y1").items()] + [f"c.{c} AS {n}" for c, n in names("Y1M").items()]
        on = "{0}.Carrier = a.Carrier AND {0}.Cabin = a.Cabin AND {0}.wk = a.wk AND {0}.Route = a.Route AND {0}.mo = a.mo AND {0}.y + 1 = a.y"
        return f"SELECT a.y, a.mo, a.wk, a.Carrier, a.Route, a.Cabin, {', '.join(cols)} FROM k a LEFT JOIN {y1} b ON {on.format('b')} LEFT JOIN {y1m} c ON {on.format('c')} WHERE a.y = {year}"

    ajoin, arate = rate("x", "f.ccy", day("f.CreatedDate"))
    g1, plain = "('C','D','G','J','G1')", "('C','D','G','J')"
    cut = "s.CreatedDate + INTERVAL '8' HOUR"
    order = [n for tag in ("", "Y1", "Y1M") for n in names(tag).values()]
    current = people("", "tot0", f"{cut} < TIMESTAMP '2000-06-15'", "TIMESTAMP '2000-01-01' AND TIMESTAMP '2001-12-31'", "AND s.BookingStatus = 'HK'", g1)
    # The passenger part of the first snapshot comes before the extras, the rest after.
    p_now, rest_now = current.split(",\nw AS", 1)
    return f"""
WITH {LEGS}, {FX}, {SEGVIEW}, {FEEVIEW}, {totals('0', 'c.ChargeType IN (0, 8)')}, {totals('1', 'c.ChargeNumber = 0')}, {p_now},
feed AS (
  SELECT DISTINCT p.PassengerID, v.FeeNumber, v.FeeCode, v.DepartureDate, v.CarrierCode, v.FlightNo, v.DepartureStation, v.ArrivalStation, c.CurrencyCode AS ccy, c.CreatedDate,
    coalesce(c.ChargeAmount * m.PositiveNegativeFlag, 0) AS amt
  FROM p JOIN feeview v ON v.PassengerID = p.PassengerID LEFT JOIN t_passenger_fee_charge c ON c.PassengerID = v.PassengerID AND c.FeeNumber = v.FeeNumber
  LEFT JOIN t_charge_type_matrix m ON m.ChargeTypeID = c.ChargeType
),
extras AS (
  SELECT DISTINCT PassengerID, DepartureDate, CarrierCode, FlightNo, Route, anc FROM (
    SELECT f.PassengerID, f.DepartureDate, f.CarrierCode, f.FlightNo, f.DepartureStation || f.ArrivalStation AS Route, f.ccy, {M(f'SUM(f.amt * {arate})')} AS anc FROM feed f {ajoin} GROUP BY ALL) z
),
il AS (SELECT * FROM legs WHERE Status <> 2 AND Lid > 0 AND DepartureDate BETWEEN TIMESTAMP '1999-01-01' AND TIMESTAMP '2001-12-31' AND FlightNo NOT IN {special}),
seats AS ({_cabins(fixed.PREMIUM_SEATS, {}, 'il', 'DepartureDate, Carrier, FlightNo, DepartureStation, ArrivalStation')}),
inv AS (SELECT Carrier, FlightNo, DepartureStation || ArrivalStation AS Route, DepartureDate, Cabin, SUM(seats) AS seats FROM seats GROUP BY ALL),
w AS{rest_now},
{people('Y1', 'tot1', f"{cut} < TIMESTAMP '1999-06-15'", "TIMESTAMP '1999-01-01' AND TIMESTAMP '2000-12-31'", '', g1)},
{people('Y1M', 'tot1', f"{cut} <= TIMESTAMP '1999-12-31'", "TIMESTAMP '1999-01-01' AND TIMESTAMP '2000-12-31'", '', plain)},
h AS ({branch(2000, 'kY1', 'kY1M')} UNION {branch(2001, 'kY1', 'k')})
SELECT DISTINCT TIMESTAMP '2000-06-15' AS CapturedDate, h.y AS Year, h.mo AS Month, h.wk AS WeekNumber, h.Carrier AS CarrierCode, h.Cabin, h.Route AS Sector,
  coalesce(rd.Distance_km, d.ActualDistance) AS Distance, {k.market('d.CityPairGroup')} AS Route, tc.TravelCountry AS Country, tr.Region, strftime(strptime(h.mo || ' 2000', '%B %Y'), '%m') AS MonthNumber,
  {', '.join('h.' + c for c in order)}
FROM h LEFT JOIN t_city_pair d ON d.DepartureStation || d.ArrivalStation = h.Route
LEFT JOIN t_travel_country tc ON tc.CarrierCode = h.Carrier AND tc.DepartureStation || tc.ArrivalStation = h.Route
LEFT JOIN (SELECT DISTINCT trim(Country) AS c, Region FROM t_travel_region) tr ON tr.c = trim(tc.TravelCountry)
LEFT JOIN t_route_distance rd ON rd.ODPair = {k.market('d.CityPairGroup')}"""


# ---------------------------------------------------------------- journeys

def journey_type() -> str:
    meas = ["BaseFareMYR", "FuelMYR", "ConnectionMYR"]
    conds = [FARE4, FUEL, "ChargeType = 8"]
    sums = ", ".join(
        M(f"SUM(CASE WHEN {c} THEN CASE WHEN c.CurrencyCode = 'MYR' THEN c.amt ELSE c.amt * x.inv END ELSE 0 END)") + f" AS {n}" for c, n in zip(conds, meas)
    )
    legcols = ["SegmentID", "DepartureDate", "DepartureStation", "ArrivalStation", "CarrierCode", "FlightNumber", *meas]
    a = ", ".join(f"a.{c} AS Leg1{c}" for c in legcols)
    b = ", ".join(f"b.{c} AS Leg2{c}" for c in legcols)
    hd = k.hours("l1.STAUTC", "l2.STDUTC")
    place = [f"Leg{n}{c}" for n in (1, 2) for c in ("CarrierCode", "FlightNumber", "DepartureStation", "ArrivalStation", "DepartureDate")]
    sumcols = [f"Leg{n}{c}" for n in (1, 2) for c in meas]
    dob = "CAST(bp.DOB AS TIMESTAMP)"
    cities, joins = [], ""
    for n in (1, 2):
        for end in ("Departure", "Arrival"):
            s = f"s{n}{end[0]}"
            cities += [f"{s}.CityCode AS Leg{n}{end}City", f"{s}.CountryCode AS Leg{n}{end}Country"]
            joins += f" LEFT JOIN t_station {s} ON {s}.StationCode = f.Leg{n}{end}Station"
    return f"""
WITH {LEGS}, {FX},
ch AS (SELECT c.*, c.ChargeAmount * m.PositiveNegativeFlag AS amt FROM t_passenger_journey_charge c LEFT JOIN t_charge_type_matrix m ON m.ChargeTypeID = c.ChargeType),
js AS (SELECT s.* FROM t_passenger_journey_segment s JOIN (SELECT DISTINCT PassengerID, JourneyNumber FROM t_passenger_journey_segment WHERE BookingStatus = 'HK') t
  ON t.PassengerID = s.PassengerID AND t.JourneyNumber = s.JourneyNumber),
psg AS (
  SELECT s.PassengerID, s.SegmentID, s.DepartureDate, s.DepartureStation, s.ArrivalStation, s.JourneyNumber, s.SegmentNumber, s.FareJourneyType, l.InventoryLegID, l.Carrier AS CarrierCode,
    l.FlightNo AS FlightNumber, bp.BookingID, bp.FirstName, bp.LastName, bp.Nationality, bp.DOB, {k.age_band(f"({k.hours(dob, 's.DepartureDate')} // 8766)", k.AGE_JOURNEY)} AS AgeGroup, bk.RecordLocator, c.CurrencyCode,
    {sums}
  FROM js s JOIN t_passenger_journey_leg pl ON pl.PassengerID = s.PassengerID AND pl.SegmentID = s.SegmentID
  JOIN legs l ON l.InventoryLegID = pl.InventoryLegID AND l.CarrierCode <> 'BF' AND l.Status <> 2 AND l.Lid > 0
  JOIN t_booking_passenger bp ON bp.PassengerID = s.PassengerID JOIN t_booking bk ON bk.BookingID = bp.BookingID AND bk.Status IN (2, 3)
  LEFT JOIN ch c ON c.PassengerID = s.PassengerID AND c.SegmentID = s.SegmentID {k.fx_join('x', "'MYR'", 'c.CurrencyCode', day('c.CreatedDate'))}
  GROUP BY ALL
),
ft AS (
  SELECT a.PassengerID, a.Nationality, a.AgeGroup, {hd} AS hd, {a}, {b}, CASE WHEN a.SegmentNumber = 1 THEN '1ST LEG' ELSE '2ND LEG' END AS seq
  FROM (SELECT * FROM psg WHERE FareJourneyType = 4) a
  LEFT JOIN psg b ON b.FareJourneyType = 4 AND a.SegmentNumber = 1 AND b.SegmentNumber = 2 AND a.PassengerID = b.PassengerID AND a.JourneyNumber = b.JourneyNumber
  LEFT JOIN t_inventory_leg l1 ON l1.InventoryLegID = a.InventoryLegID LEFT JOIN t_inventory_leg l2 ON l2.InventoryLegID = b.InventoryLegID
),
ferry AS (
  SELECT DISTINCT o.PassengerID, t.Leg1SegmentID FROM (SELECT PassengerID, Leg1SegmentID FROM ft WHERE seq = '1ST LEG' AND Leg2SegmentID IS NULL) t
  JOIN t_passenger_journey_leg own ON own.PassengerID = t.PassengerID AND own.SegmentID = t.Leg1SegmentID
  JOIN t_passenger_journey_leg o ON o.PassengerID = own.PassengerID AND o.JourneyNumber = own.JourneyNumber AND o.SegmentID <> own.SegmentID
  JOIN t_inventory_leg l ON l.InventoryLegID = o.InventoryLegID AND l.CarrierCode = 'BF'
),
ft2 AS (
  SELECT ft.*, CASE WHEN fe.PassengerID IS NOT NULL THEN 'FERRY' WHEN seq = '1ST LEG' AND Leg2SegmentID IS NULL THEN 'ERROR' ELSE 'FLYTHRU' END AS jt
  FROM ft LEFT JOIN ferry fe ON fe.PassengerID = ft.PassengerID AND fe.Leg1SegmentID = ft.Leg1SegmentID
),
sc AS (
  SELECT a.PassengerID, a.Nationality, a.AgeGroup, {hd} AS hd, {a}, {b}, '1ST LEG' AS seq,
    CASE WHEN a.DepartureStation <> b.ArrivalStation THEN 'SELF-CONNECTING' ELSE 'POINT TO POINT' END AS jt
  FROM (SELECT * FROM psg WHERE FareJourneyType <> 4) a
  LEFT JOIN psg b ON b.FareJourneyType <> 4 AND trim(a.FirstName) = trim(b.FirstName) AND trim(a.LastName) = trim(b.LastName) AND a.DOB = b.DOB
    AND {days('a.DepartureDate', 'b.DepartureDate')} BETWEEN 0 AND 2 AND a.DepartureStation <> b.ArrivalStation AND a.ArrivalStation = b.DepartureStation
  LEFT JOIN t_inventory_leg l1 ON l1.InventoryLegID = a.InventoryLegID LEFT JOIN t_inventory_leg l2 ON l2.InventoryLegID = b.InventoryLegID
),
allp AS (SELECT * FROM ft2 UNION SELECT * FROM sc),
f AS (
  SELECT jt, Nationality, AgeGroup, {k.transit('hd')} AS tt, {', '.join(place)}, COUNT(DISTINCT Leg1SegmentID) AS n, {', '.join(f"{M(f'SUM({c})')} AS {c}" for c in sumcols)}
  FROM allp WHERE seq = '1ST LEG' GROUP BY jt, Nationality, AgeGroup, {k.transit('hd')}, {', '.join(place)}
)
SELECT CAST(year(Leg1DepartureDate) AS INT) AS Year, CAST(month(Leg1DepartureDate) AS INT) AS Month, CASE jt WHEN 'FERRY' THEN 'POINT TO POINT' WHEN 'ERROR' THEN 'EXCEPTION' ELSE jt END AS JourneyType,
  Nationality AS PassengerNationality, AgeGroup, tt AS TransitTime, {', '.join('f.' + c for c in place)}, {', '.join(cities)}, n AS NoOfPassenger, {', '.join(sumcols)}
FROM f {joins}"""


FLY = ["BaseFare", "FuelSurcharge", "AncillaryAmount", "ThruFare"]


def _fly_ctes() -> str:
    amount = LIST_SIGN.replace("Charge", "c.Charge")
    first = ", ".join(f"b.{x} AS {x}Leg1" for x in FLY)
    second = ", ".join(f"c.{x} AS {x}Leg2" for x in FLY)

    def half(j: int) -> str:
        return f"""
  SELECT b.RecordLocator, b.PassengerID, b.PurchaseDate, b.DepartureDate, b.Route AS RouteLeg1, b.Carrier AS CarrierCodeLeg1, b.FlightNo AS FlightNumberLeg1,
    c.Route AS RouteLeg2, c.Carrier AS CarrierCodeLeg2, c.FlightNo AS FlightNumberLeg2, {first}, {second}, b.Nationality, b.CountryBooking, b.Age, b.CurrencyCode
  FROM a b JOIN a c ON c.PassengerID = b.PassengerID AND c.dep = b.arr WHERE b.JourneyNumber = {j} AND b.SegmentNumber = 1 AND c.JourneyNumber = {j} AND c.SegmentNumber = 2"""

    return f"""{LEGS}, {FX}, {SEGVIEW}, {FEEVIEW},
tot AS (
  SELECT c.PassengerID, c.SegmentID, SUM(CASE WHEN c.ChargeType IN (0, 1, 7, 8) THEN {amount} END) AS BaseFare, SUM(CASE WHEN c.ChargeCode IN ('FUEL', 'FUEX') THEN {amount} END) AS FuelSurcharge,
    SUM(CASE WHEN c.ChargeCode = 'THRU' THEN {amount} END) AS ThruFare FROM t_passenger_journey_charge c GROUP BY 1, 2
),
s AS (
  SELECT s.PassengerID, s.SegmentID, s.JourneyNumber, s.SegmentNumber, s.CurrencyCode, s.SegmentSTD, s.Carrier, s.FlightNo, s.DepartureStation AS dep, s.ArrivalStation AS arr, {day('s.CreatedDate')} AS PurchaseDate,
    {', '.join(f"{M(f'SUM(coalesce(tot.{x}, 0) * x.inv)')} AS {x}" for x in ('BaseFare', 'FuelSurcharge', 'ThruFare'))}
  FROM seg s LEFT JOIN tot ON tot.PassengerID = s.PassengerID AND tot.SegmentID = s.SegmentID {k.fx_join('x', "'MYR'", 's.CurrencyCode', day('s.CreatedDate'))}
  WHERE s.BookingStatus = 'HK' AND s.FareJourneyType = 4 GROUP BY ALL
),
feed AS (
  SELECT DISTINCT s.PassengerID, v.FeeNumber, v.FeeCode, v.DepartureDate, v.CarrierCode, v.FlightNo, v.DepartureStation, v.ArrivalStation, c.CurrencyCode AS ccy, c.CreatedDate,
    coalesce(c.ChargeAmount * m.PositiveNegativeFlag, 0) AS amt
  FROM s JOIN feeview v ON v.PassengerID = s.PassengerID LEFT JOIN t_passenger_fee_charge c ON c.PassengerID = v.PassengerID AND c.FeeNumber = v.FeeNumber
  LEFT JOIN t_charge_type_matrix m ON m.ChargeTypeID = c.ChargeType
),
ex AS (
  SELECT f.PassengerID, f.DepartureDate, f.CarrierCode, f.FlightNo, f.DepartureStation AS dep, f.ArrivalStation AS arr, f.ccy, {M('SUM(f.amt * x.inv)')} AS anc FROM feed f {k.fx_join('x', "'MYR'", 'f.ccy', day('f.CreatedDate'))} GROUP BY ALL
),
a AS (
  SELECT s.*, s.dep || s.arr AS Route, {day('s.SegmentSTD')} AS DepartureDate, bk.RecordLocator, coalesce(ex.anc, 0) AS AncillaryAmount, n.Name AS Nationality, g.Name AS CountryBooking,
    year(s.SegmentSTD) - year(bp.DOB) AS Age
  FROM s LEFT JOIN ex ON ex.PassengerID = s.PassengerID AND ex.dep = s.dep AND ex.arr = s.arr AND ex.CarrierCode = s.Carrier AND {day('ex.DepartureDate')} = {day('s.SegmentSTD')}
  LEFT JOIN t_booking_passenger bp ON bp.PassengerID = s.PassengerID LEFT JOIN t_booking bk ON bk.BookingID = bp.BookingID
  LEFT JOIN t_country n ON n.CountryCode = bp.Nationality LEFT JOIN t_booking_contact bc ON bc.BookingID = bp.BookingID LEFT JOIN t_country g ON g.CountryCode = bc.CountryCode
  WHERE s.Carrier IN {inlist(fixed.GROUP_CARRIERS)}
),
pr AS ({half(1)} UNION {half(2)})"""


def _fly_sums() -> str:
    out = ["COUNT(RecordLocator) AS Booking", "COUNT(PassengerID) AS SeatsSold"]
    for x in FLY:
        out += [f"{M(f'SUM({x}Leg1)')} AS {x}Leg1", f"{M(f'SUM({x}Leg2)')} AS {x}Leg2", f"{M(f'SUM({x}Leg1 + {x}Leg2)')} AS {x}"]
    both = " + ".join(f"{x}Leg1 + {x}Leg2" for x in FLY)
    return ", ".join(out) + f", {M(f'SUM({both})')} AS TotalRevenue"


FLY_LEGS = "RouteLeg1, RouteLeg2, CarrierCodeLeg1, FlightNumberLeg1, CarrierCodeLeg2, FlightNumberLeg2"
FLY_ROUTE = "left(RouteLeg1, 3) || '-' || right(RouteLeg2, 3)"
FLY_CAPTURED = "TIMESTAMP '2003-01-01'"


def fly_monthly() -> str:
    age = k.age_band("Age", k.AGE_FLY, "Unknown")
    return f"""WITH {_fly_ctes()},
g AS (
  SELECT {FLY_LEGS}, {FLY_ROUTE} AS Route, CAST(year(DepartureDate) AS INT) AS DepartureYear, monthname(DepartureDate) AS DepartureMonth, CAST(month(DepartureDate) AS INT) AS MonthNum,
    CAST(year(PurchaseDate) AS INT) AS PurchaseYear, monthname(PurchaseDate) AS PurchaseMonth, Nationality, CurrencyCode, CountryBooking, {age} AS AgeBand, {_fly_sums()}
  FROM pr GROUP BY ALL
)
SELECT {FLY_CAPTURED} AS CapturedDate, g.*, h.MarketGroup AS ODPair, o.CountryCode AS OrigCountry, d.CountryCode AS DesCountry, CarrierCodeLeg1 || '-' || CarrierCodeLeg2 AS CarrierCodeLeg1toLeg2
FROM g LEFT JOIN t_market_group h ON h.DepartureStation = left(g.Route, 3) AND h.ArrivalStation = right(g.Route, 3)
LEFT JOIN t_station o ON o.StationCode = left(g.Route, 3) LEFT JOIN t_station d ON d.StationCode = right(g.Route, 3)"""


def fly_daily() -> str:
    age = k.age_band("Age", k.AGE_FLY, "Unknown")
    named = f"CASE WHEN Nationality IN {inlist(fixed.FLY_THRU_NATIONALITIES)} THEN Nationality ELSE 'Others' END"
    return f"""WITH {_fly_ctes()}
SELECT {FLY_CAPTURED} AS CapturedDate, {FLY_LEGS}, {FLY_ROUTE} AS Route, DepartureDate, PurchaseDate, {named} AS Nationality, {age} AS AgeBand, {_fly_sums()}
FROM pr GROUP BY {FLY_LEGS}, {FLY_ROUTE}, DepartureDate, PurchaseDate, {named}, {age}"""


def nationality(export: bool) -> str:
    keys = ["DepartureMonth", "DepartureYear", "Flight", "CarrierCode", "Route", "DepartureStation", "ArrivalStation", "Nationality", "Passport", "NationalityDesc",
            "HiFlyer", "IslandTransfer", "DepartureStation2", "ArrivalStation2"]
    cols = ", ".join(keys)
    tail = f"SELECT {cols}, Guests, BaseFare FROM d"
    if export:
        tail = f"""SELECT {', '.join('d.' + c for c in keys)}, r.Region, r.SubRegion, {I('SUM(d.Guests)')} AS Guests, {M('SUM(d.BaseFare)')} AS BaseFare
FROM d LEFT JOIN t_country_region r ON r.CountryCode = d.Nationality GROUP BY ALL"""

    def island(j: int) -> str:
        return f"""ij{j} AS (SELECT b.PassengerID, b.JourneyNumber, b.DepartureStation, b.ArrivalStation FROM psg p JOIN seg b ON b.PassengerID = p.PassengerID
  WHERE b.BookingStatus = 'HK' AND b.CarrierCode = 'BF' AND b.JourneyNumber = {j})"""

    return f"""
WITH {LEGS}, {FX}, {SEGVIEW},
psg AS (
  SELECT s.PassengerID, s.SegmentID, s.JourneyNumber, bk.CurrencyCode AS ccy, {day("bk.BookingDate + INTERVAL '8' HOUR")} AS bd, s.DepartureDate, s.FareClassOfService AS cls,
    CASE s.International WHEN 0 THEN 'DOM' WHEN 1 THEN 'INT' END AS Flight, s.Carrier, s.DepartureStation, s.ArrivalStation, bp.Nationality,
    CASE WHEN d.doc = 'OT' OR d.doc IS NULL THEN bp.Nationality ELSE d.doc END AS Passport, c.Name AS NationalityDesc
  FROM seg s JOIN t_booking_passenger bp ON bp.PassengerID = s.PassengerID JOIN t_booking bk ON bk.BookingID = bp.BookingID AND bk.Status IN (2, 3)
  LEFT JOIN (SELECT DISTINCT PassengerID, Nationality AS doc FROM t_passenger_travel_doc) d ON d.PassengerID = s.PassengerID
  LEFT JOIN t_country c ON c.CountryCode = bp.Nationality
  WHERE s.BookingStatus = 'HK' AND s.CarrierCode IN (SELECT CarrierCode FROM t_carrier)
),
{island(1)}, {island(2)},
nf AS (SELECT PassengerID, SegmentID, SUM(CASE WHEN ChargeType IN (0, 8) THEN ChargeAmount ELSE -ChargeAmount END) AS fare FROM t_passenger_journey_charge WHERE ChargeType IN (0, 8, 1, 7) GROUP BY 1, 2),
d AS (
  SELECT monthname(a.DepartureDate) AS DepartureMonth, CAST(year(a.DepartureDate) AS INT) AS DepartureYear, a.Flight, a.Carrier AS CarrierCode, a.DepartureStation || a.ArrivalStation AS Route,
    a.DepartureStation, a.ArrivalStation, a.Nationality, a.Passport, a.NationalityDesc, CASE WHEN a.cls IN {inlist(fixed.HI_FLYER)} THEN 'Hi-Flyer' END AS HiFlyer,
    CASE WHEN i1.PassengerID IS NOT NULL OR i2.PassengerID IS NOT NULL THEN 'Y' ELSE 'N' END AS IslandTransfer, coalesce(i1.DepartureStation, i2.DepartureStation) AS DepartureStation2,
    coalesce(i1.ArrivalStation, i2.ArrivalStation) AS ArrivalStation2, COUNT(a.PassengerID) AS Guests, {M('SUM(nf.fare * coalesce(x.inv, 1))')} AS BaseFare
  FROM psg a LEFT JOIN nf ON nf.PassengerID = a.PassengerID AND nf.SegmentID = a.SegmentID
  LEFT JOIN ij1 i1 ON i1.PassengerID = a.PassengerID AND i1.JourneyNumber = a.JourneyNumber AND a.ArrivalStation = i1.DepartureStation
  LEFT JOIN ij2 i2 ON i2.PassengerID = a.PassengerID AND i2.JourneyNumber = a.JourneyNumber AND a.DepartureStation = i2.ArrivalStation
  {k.fx_join('x', "'MYR'", 'a.ccy', 'a.bd')} GROUP BY ALL
)
{tail}"""


def seat_grid() -> str:
    cls = fixed.GRID_CLASSES
    au = ", ".join(f"SUM(CASE WHEN cls = '{c}' THEN ClassAU END) AS \"{c}-AU\"" for c in cls)

    def avail(c: str) -> str:
        if c in fixed.GRID_FROM_OWN_SALES:
            v = f"SUM(CASE WHEN cls = '{c}' THEN ClassAU - ClassSold END)"
        else:
            v = f"SUM(CASE WHEN cls = '{c}' THEN greatest(ClassAU - nest, 0) END)"
        if c == "DI":
            v = f"CASE WHEN {v} < 0 THEN 0 ELSE {v} END"
        return f"CAST({v} AS BIGINT) AS \"{c}\""

    au = ", ".join(f"CAST(SUM(CASE WHEN cls = '{c}' THEN ClassAU END) AS BIGINT) AS \"{c}-AU\"" for c in cls)
    return f"""
WITH {LEGS},
r AS (
  SELECT l.InventoryLegID, l.InventoryLegKey, cp.CityPairGroup, {day('l.DepartureDate')} AS DepartureDate, l.Carrier AS CarrierCode, l.FlightNo AS FlightNumber, l.DepartureStation, l.ArrivalStation,
    l.OpSuffix, l.Lid, l.AdjustedCapacity, l.Capacity, trim(c.ClassOfService) AS cls, c.ClassAU, c.ClassSold,
    SUM(c.ClassSold) OVER (PARTITION BY l.InventoryLegID, c.ClassNest) AS nest, SUM(c.ClassSold) OVER (PARTITION BY l.InventoryLegID) AS sold
  FROM legs l JOIN t_inventory_leg_class c ON c.InventoryLegID = l.InventoryLegID JOIN t_city_pair cp ON cp.DepartureStation = l.DepartureStation AND cp.ArrivalStation = l.ArrivalStation
  WHERE l.Status <> 2
)
SELECT {LOCAL_NOW} AS CaptureDate, InventoryLegID, InventoryLegKey, CityPairGroup, DepartureDate, CarrierCode, FlightNumber, DepartureStation, ArrivalStation, OpSuffix, Lid, AdjustedCapacity, Capacity,
  CAST(sold AS BIGINT) AS SeatSold, {au}, {', '.join(avail(c) for c in cls)}
FROM r GROUP BY ALL"""


def report_sql() -> dict[str, str]:
    texts = {
        "report_daily_management_sales": daily_sales(),
        "report_cash_flow": cash_flow(),
        "report_currency_sales": currency_sales(),
        "report_ancillary_revenue": ancillary(),
        "report_premium_flex_monthly": premium_flex("CapturedDate"),
        "report_premium_flex_weekly": premium_flex("BookingDate"),
        "report_channel_daily": channel_daily(),
        "report_channel_daily_by_country": channel_by_country(),
        "report_channel_monthly": channel_monthly(),
        "report_older_channel_daily": older_daily(),
        "report_older_channel_monthly": older_monthly(),
        "report_booking_date_analysis": analysis(),
        "report_china_market": china(),
        "report_china_market_months": china_months(),
        "report_route_revenue_d7": route_inventory("d7"),
        "report_route_revenue_d7_fare_class": route_fare_class("d7"),
        "report_route_revenue_d7_classes": route_classes("d7"),
        "report_route_revenue_d7_passengers": route_passengers("d7"),
        "report_route_revenue_d7_fanout": route_passengers("d7", fanout=True),
        "report_route_revenue_xt": route_inventory("xt"),
        "report_route_revenue_xt_fare_class": route_fare_class("xt"),
        "report_route_revenue_xj": route_inventory("xj"),
        "report_route_revenue_xj_fare_class": route_fare_class("xj"),
        "report_all_carrier_revenue": all_carriers(merged=True),
        "report_all_carrier_revenue_by_carrier": all_carriers(merged=False),
        "report_finance_by_flight": finance(),
        "report_pax_capacity": pax_capacity(),
        "report_route_performance_d7": route_performance("d7"),
        "report_route_performance_xj": route_performance("xj"),
        "report_journey_type": journey_type(),
        "report_fly_thru_monthly": fly_monthly(),
        "report_fly_thru_daily": fly_daily(),
        "report_nationality": nationality(False),
        "report_nationality_export": nationality(True),
        "report_seat_grid": seat_grid(),
    }
    return {name: with_standins(sql) for name, sql in texts.items()}
