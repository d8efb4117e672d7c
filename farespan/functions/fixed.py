"""Fixed values the reports depend on: code lists, maps, sign rules."""

# Carrier -> home currency; any other carrier is MYR.
HOME_CURRENCY = {
    "AK": "MYR", "D7": "MYR",
    "FD": "THB", "XJ": "THB",
    "QZ": "IDR",
    "PQ": "PHP", "Z2": "PHP",
    "XT": "USD",
    "I5": "INR",
}

# The all-carrier route report adds JW and has no default.
HOME_CURRENCY_STRICT = {**HOME_CURRENCY, "JW": "JPY"}

# Charge types that count as base fare.
FARE_TYPES = (0, 1, 7, 19)

# Charge codes.
FUEL_CODES = ("FUEL", "FUEX", "DOMS")
SURCHARGE_CODES = ("FUEL", "FUEX", "DOMS", "KLIA2", "OTF")
TAX_CODES = (
    "ADF", "AIF", "APF", "APFC", "APT", "APTF", "ASC", "ASF", "AUDF", "AVL", "CUTE",
    "DPSC", "IPSC", "IWJR", "PSC", "PSF", "SCF", "SVT", "UDF", "GST", "VAT",
)
NOT_OTHER_CODES = ("FUEL", "FUEX", "DOMS", "APC", "APF", "AFX", "APT", "APTF", "KLIA2")

# Charge types that are subtracted.
MINUS_TYPES = (1, 2, 3, 7, 16)
MINUS_TYPES_FEES = (1, 2, 3, 7, 11, 16)

# Chartered flights, carrier followed by flight number.
CHARTERED = (
    "D7170", "D7171", "D7172", "D7173", "D7176", "D7177",
    "D7192", "D7193", "D7196", "D7197", "AK70", "AK71",
)

# Carriers of the group.
GROUP_CARRIERS = ("AK", "FD", "QZ", "JW", "PQ", "D7", "Z2", "XJ", "I5", "XT")
FERRY_CARRIER = "BF"

# Routes left out of the older channel reports.
CLOSED_ROUTES = (
    "BOMKUL", "CHCKUL", "DELKUL", "DLCKUL", "HRBKUL", "IKAKUL", "KULLGW", "KULORY",
    "KULTSN", "MELPER", "KULWUH", "KULBOM", "KULCHC", "KULDEL", "KULDLC", "KULHRB",
    "KULIKA", "LGWKUL", "ORYKUL", "TSNKUL", "PERMEL", "WUHKUL",
)

# Flights kept out of, or moved between, the route revenue reports.
D7_SPECIAL = ("2994", "2995", "2996", "2997", "2998", "2999")
D7_AS_XT = ("216", "217", "218", "219")
D7_AS_XJ = ("620", "621")
CLOSED_FLIGHTS = ("D7 2994", "D7 2995", "D7 2998", "D7 2999", "I5 9001")
FD_CLOSED_FLIGHTS = ("2496", "2497")
FD_CLOSED_BEFORE = "2014-02-21"

# Premium cabin classes.
PREMIUM = ("C", "D", "G", "J")
PREMIUM_G1 = ("C", "D", "G", "J", "G1")

# Premium seats by (equipment type, suffix).
PREMIUM_SEATS = {
    (320, "A"): 0, (733, "A"): 0,
    (330, "A"): 12, (330, "B"): 12, (330, "C"): 12, (330, "D"): 10, (330, "E"): 12,
    (340, "A"): 18, (340, "B"): 18,
    (332, "A"): 24,
}
PREMIUM_SEATS_333 = {**PREMIUM_SEATS, (333, "A"): 12}

# Call-centre operator by agent location.
CALL_CENTRES = {
    "Scicom": ("KUL", "ORY", "AUH", "ICN", "HND", "MNL"),
    "Sutherland": ("MAA", "DEL"),
    "Sonic": ("SZX", "CAN"),
    "IAA": ("CGK",),
    "TAA": ("DMK", "BKK"),
}

# Payment method codes.
PAYMENT_GROUPS = {
    "Credit Card": ("MS", "VS", "AX", "JB", "MC", "VI"),
    "Direct Debit": (
        "DC", "C3", "M5", "C1", "D4", "C2", "C4", "C5", "C7", "C9", "D1", "D2", "D3",
        "D5", "D6", "D8", "D9", "DF", "I1", "I2", "T1", "V1", "C6", "M2", "PL",
    ),
    "Over the Counter": ("BD", "M4", "P1", "SP", "KS", "N1", "A1", "KT", "SC"),
    "Cash": ("CA",),
}

# Fare classes sold as Hi-Flyer.
HI_FLYER = ("PF", "LF", "UF", "TF", "QF", "MF", "YF", "HF")

# Countries of the by-country channel report.
COUNTRY_REPORT = ("SG", "PH", "ID", "AU")

# Nationalities of the China market report.
CHINA_NATIONALITIES = ("CN", "HK", "MO")

# Nationalities named in the fly-thru export, all others pooled.
FLY_THRU_NATIONALITIES = (
    "Australia", "Indonesia", "China", "Japan", "Malaysia", "South Korea",
    "Thailand", "Taiwan", "India", "Singapore",
)

# Sectors renamed before the year-on-year comparison.
ROUTE_ALIASES = {
    "KULSTN": "KULLGW", "STNKUL": "LGWKUL", "TSNKUL": "PEKKUL", "KULTSN": "KULPEK",
}

# Booking classes of the availability grid, in output order.
GRID_CLASSES = (
    "A", "A1", "B", "C", "D", "DI", "E", "F", "G", "H", "I", "J", "K", "L", "M", "N",
    "O", "P", "Q", "R", "S", "T", "U", "V", "W", "X", "Y", "Z",
    "AF", "A2", "IF", "LF", "MF", "OB", "O1", "PF", "QF", "TF", "UF", "VF", "YF",
)
GRID_FROM_OWN_SALES = ("DI", "A1", "A2", "W")

# Targets of the finance report's seven currencies.
FINANCE_CURRENCIES = ("MYR", "IDR", "THB", "JPY", "PHP", "INR", "USD")
