"""The catalogue of source tables a report reads from."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Columns stored with padding; trimmed once here so joins compare plain keys.
TRIMMED = {
    "inventory_leg": ("CarrierCode", "FlightNumber"),
    "carrier_mapping": ("CarrierCode", "FlightNumber"),
    "hub_info": ("CarrierCode", "FlightNumber", "MarketGroup", "Hub"),
    "passenger_journey_segment": ("FareClassOfService",),
    "inventory_leg_class": ("ClassOfService",),
    "fare_class": ("ClassOfService",),
    "class_of_service": ("ClassOfServiceCode",),
}

# Codes compared without regard to case.
UPPERED = {
    "carrier_mapping": ("CarrierCode",),
    "inventory_leg": ("CarrierCode",),
    "hub_info": ("CarrierCode", "MarketGroup"),
    "passenger_journey_charge": ("ChargeCode",),
    "passenger_fee": ("FeeCode",),
    "passenger_fee_charge": ("ChargeCode",),
    "ancillary_fee_codes": ("Code",),
}

# Codes that arrive as text in some stores and are compared as numbers.
INTEGERS = {
    "passenger_journey_charge": ("ChargeType", "ChargeNumber"),
    "passenger_fee_charge": ("ChargeType",),
    "passenger_journey_segment": ("FareJourneyType", "International"),
    "charge_type_matrix": ("ChargeTypeID", "PositiveNegativeFlag"),
}


def normalise(name: str, df: DataFrame) -> DataFrame:
    """Trim, upper-case and cast the columns listed for a table."""
    changes = {}
    for c in TRIMMED.get(name, ()):
        changes[c] = F.trim(F.col(c))
    for c in UPPERED.get(name, ()):
        changes[c] = F.upper(changes.get(c, F.col(c)))
    for c in INTEGERS.get(name, ()):
        changes[c] = F.col(c).cast("int")
    changes = {c: e for c, e in changes.items() if c in df.columns}
    return df.withColumns(changes) if changes else df


class Tables(Mapping[str, DataFrame]):
    """Named source tables, each read once and normalised on first use."""

    def __init__(self, spark: SparkSession, read: Callable[[str], DataFrame], names: list[str] | None = None,
                 normalised: bool = False):
        """``normalised``: the tables were stored with their codes trimmed, upper-cased and cast."""
        self.spark = spark
        self._normalised = normalised
        self._read = read
        self._names = names or []
        self._cache: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._cache:
            df = self._read(name)
            self._cache[name] = df if self._normalised else normalise(name, df)
        return self._cache[name]

    def __iter__(self):
        return iter(self._names)

    def __len__(self) -> int:
        return len(self._names)

    @classmethod
    def from_parquet(cls, spark: SparkSession, path: str) -> "Tables":
        """One Parquet dataset per table under ``path``."""
        return cls(spark, lambda name: spark.read.parquet(f"{path.rstrip('/')}/{name}.parquet"))

    @classmethod
    def from_catalog(cls, spark: SparkSession, namespace: str) -> "Tables":
        """Tables of one catalogue namespace, ``catalog.schema`` or ``schema``."""
        return cls(spark, lambda name: spark.table(f"{namespace}.{name}"))

    @classmethod
    def from_frames(cls, spark: SparkSession, frames: dict[str, DataFrame]) -> "Tables":
        return cls(spark, frames.__getitem__, list(frames))


SENT_ROWS = 1 << 20  # rows of a table that Spark may send to every task; more meet the other side by key

_rows: dict[int, int] = {}


def by_rows(side: DataFrame, table: DataFrame | int) -> DataFrame:
    """One side of a join, which Spark may send to every task if ``table``, of which it is made, has few rows.

    Spark itself goes by the size of files, where ids stored as differences take next to nothing: the 18
    million payments of 11 MB of Parquet would be gathered in the driver. ``table``: counted rows or what to count.
    """
    if isinstance(table, DataFrame):
        key = table.semanticHash()
        if key not in _rows:
            _rows[key] = table.count()
        table = _rows[key]
    return side if table <= SENT_ROWS else side.hint("merge")


def as_of(tables: Tables):
    """The as-of date of the control table; the one value read to the driver."""
    return tables["download_date"].agg(F.max(F.to_date("DownloadDate"))).first()[0]
