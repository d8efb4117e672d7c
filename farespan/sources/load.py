"""Loading the source tables once, laid out for the joins and windows of the reports.

- Codes are trimmed, upper-cased and cast when they are stored, so that a report compares the
  bare column and its filters reach the Parquet scan.
- All facts about passengers are hashed by PassengerID into the same number of buckets. Every
  join among them holds that key, so none needs an exchange.
- Bookings and inventory legs are filed by month. A report's window is a literal range of months
  too, so other months are not even listed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from farespan.functions.windows import FILED_MONTH
from farespan.sources.tables import Tables

BY_PASSENGER = (
    "booking_passenger", "passenger_journey_segment", "passenger_journey_leg", "passenger_journey_charge", "passenger_fee",
    "passenger_fee_charge", "passenger_travel_doc",
)
#: How many files a writing task may have open at once; more are written one after the other, sorted.
WRITERS = "spark.sql.maxConcurrentOutputFileWriters"
BY_MONTH = {"booking": "BookingDate", "inventory_leg": "DepartureDate"}


def filed(df: DataFrame, name: str) -> DataFrame:
    """Adds the month, as yyyymm, under which rows of a table are filed."""
    c = F.col(BY_MONTH[name])
    return df.withColumn(FILED_MONTH, F.year(c) * 100 + F.month(c))


@contextmanager
def _one_file_a_bucket(spark: SparkSession) -> Iterator[None]:
    """A task that holds one bucket writes its rows as they come, without sorting them again."""
    before = spark.conf.get(WRITERS, "0")
    spark.conf.set(WRITERS, "4")
    try:
        yield
    finally:
        spark.conf.set(WRITERS, before)


def store(df: DataFrame, name: str, namespace: str, buckets: int, folder: str | None = None, dealt: bool = False) -> None:
    """Replace one table of the namespace; ``folder`` keeps its files outside the warehouse.

    ``dealt``: the rows lie in their buckets already, sorted by PassengerID.
    """
    if name in BY_PASSENGER:
        # Dealt as the buckets are, so each bucket is one file.
        rows = df if dealt else df.repartition(buckets, "PassengerID").sortWithinPartitions("PassengerID")
        with _one_file_a_bucket(df.sparkSession):
            _write(rows.write.bucketBy(buckets, "PassengerID"), name, namespace, folder)
    elif name in BY_MONTH:
        # A task writes the rows of a month together, so a month has few files.
        _write(filed(df, name).repartition(FILED_MONTH).write.partitionBy(FILED_MONTH), name, namespace, folder)
    else:
        _write(df.write, name, namespace, folder)


def _write(writer: DataFrameWriter, name: str, namespace: str, folder: str | None) -> None:
    if folder:
        writer = writer.option("path", f"{folder.rstrip('/')}/{name}")
    writer.mode("overwrite").format("parquet").option("compression", "zstd").saveAsTable(f"{namespace}.{name}")


def create(spark: SparkSession, namespace: str, folder: str | None = None) -> None:
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {namespace}" + (f" LOCATION '{folder}'" if folder else ""))


def load(source: Tables, names: Iterable[str], namespace: str, buckets: int, folder: str | None = None) -> Tables:
    """Store the named tables in ``catalog.schema`` or ``schema`` and return them as a source."""
    spark = source.spark
    create(spark, namespace, folder)
    for name in names:
        store(source[name], name, namespace, buckets, folder)
    return loaded(spark, namespace)


def loaded(spark: SparkSession, namespace: str, before: Callable[[str], None] | None = None) -> Tables:
    """Tables that :func:`load` has stored; they are taken as they are.

    Joins on PassengerID and more keys then accept tables that are dealt by PassengerID alone.
    ``before`` is called with a table's name ahead of its first reading.
    """
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")

    def read(name: str) -> DataFrame:
        if before is not None:
            before(name)
        return spark.table(f"{namespace}.{name}")

    return Tables(spark, read, normalised=True)
