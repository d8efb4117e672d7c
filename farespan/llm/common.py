"""Spark helpers that several operators share."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from farespan.sources.sinks import drop_staged, scoped, stage

WORD = r"[^\x20\x09-\x0D]+"
HOT_KEYS = 1000  # a key is hot if it has more than 1/HOT_KEYS of the rows: fewer than HOT_KEYS are


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def n_words(text: str | Column) -> Column:
    """Number of words of a text; a missing text has none."""
    return F.coalesce(F.regexp_count(F.col(text) if isinstance(text, str) else text, F.lit(WORD)), F.lit(0)).cast("long")


def hot_join(left: DataFrame, right: DataFrame, key: str, rows: str, total: int) -> DataFrame:
    """Left join of ``left`` to one row per ``key``, with hot keys sent to every task.

    ``right[rows]`` holds how many of the ``total`` left rows have the key. The keys over
    ``total / HOT_KEYS`` number fewer than HOT_KEYS, whatever the input, so those few are
    broadcast; the rest join on the key, where none has more than its small share.
    ``left`` is read twice, so hand in something stored.
    """
    values = [c for c in right.columns if c != key]
    hot = F.col(rows) > total / HOT_KEYS
    few = F.broadcast(right.filter(hot).select(key, F.struct(*values).alias("_hot")))
    seen = left.join(few, key, "left")
    own = [F.col(c) for c in left.columns]
    near = seen.filter("_hot is not null").select(*own, "_hot.*")
    rest = seen.filter("_hot is null").drop("_hot").join(right.filter(~hot), key, "left").select(*own, *values)
    return near.unionByName(rest)


def running(df: DataFrame, order: list[Column], sums: dict[str, str], rank: str) -> DataFrame:
    """Adds each row's 0-based place in a global order, and sums over the rows before it.

    Rows are range-partitioned and stored, each part is counted, and only one row per part
    meets in a single window; then each part adds what stands before it.
    """
    parts = stage(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "running")
    totals = parts.groupBy("_part").agg(F.count("*").alias("_n"), *[F.sum(c).alias(f"_t_{new}") for new, c in sums.items()])
    above = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    names = ["_n", *(f"_t_{new}" for new in sums)]
    before = totals.select("_part", *[F.coalesce(F.sum(c).over(above), F.lit(0)).alias(f"_b{c}") for c in names])
    inside = Window.partitionBy("_part").orderBy(*order)
    upto = inside.rowsBetween(Window.unboundedPreceding, -1)
    out = parts.join(before, "_part").withColumn(rank, F.row_number().over(inside) - 1 + F.col("_b_n"))
    for new, c in sums.items():
        out = out.withColumn(new, F.coalesce(F.sum(c).over(upto), F.lit(0)) + F.col(f"_b_t_{new}"))
    return out.drop("_part", *(f"_b{c}" for c in names))


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Distributed union-find: the least node reachable from each node that has an edge.

    Alternates the large-star and small-star steps until no edge changes; each step is a
    grouped minimum and a join, and each round is stored, so that lineage stays short.
    Returns ``node, root``.
    """
    x, y = F.col(a), F.col(b)
    now = stage(edges.select(F.greatest(x, y).alias("u"), F.least(x, y).alias("v")).filter("u != v").distinct(), "edges")
    state = (F.count("*"), F.bit_xor(F.xxhash64("u", "v")))
    mark = tuple(now.agg(*state).first())
    while True:
        both = now.unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*").filter("u != v").distinct()
        then = stage(small, "edges")
        new = tuple(then.agg(*state).first())
        drop_staged(now)
        now = then
        if new == mark:
            break
        mark = new
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda p, q: p | q, conditions)
