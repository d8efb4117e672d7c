"""Mixing sources to target weights.

Every row gets a hash-random key. The token counts of each source are summed over ranges of
the key, and sums over the ranges before give the range in which the source's budget ends;
that one range is sorted and summed row by row to find the key at which to cut. What a row
gives then depends on its source and key alone, so the rows themselves are never moved.
A budget over the source's size takes whole epochs first and cuts the next one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from farespan.llm.common import WORD, hot_join, n_words, running, stage

WEIGHTS = (5, 2, 1)
SHARE, CAP = 1.5, 2
RANGE_DIGITS = 4  # ranges of the key: 16 ** RANGE_DIGITS a source


def _key(doc_id: str) -> Column:
    return F.md5(F.coalesce(F.col(doc_id).cast("string"), F.lit("null")).cast("binary"))


def _source_key() -> Column:
    return F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n"))


def budgets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, cap: int = CAP) -> DataFrame:
    """``sizes``: _source, source, source_size, n. Adds target.

    With the sources in order of cap over weight, the level a unit of weight gets is the
    largest of (budget - caps before) / (weights from here on); a target is its weight
    times the level, or its cap if that is less.
    """
    null_last = [F.col("source").isNull(), F.col("source")]
    ranked = running(sizes.select("_source", "source", "source_size", "n"), null_last, {}, "_rank")
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    ranked = stage(ranked.withColumn("_weight", F.element_at(cycle, (F.pmod("_rank", F.lit(len(weights))) + 1).cast("int"))).withColumn("_cap", F.col("source_size") * float(cap)), "mix-weights")
    total, weight = ranked.agg(F.sum("source_size"), F.sum("_weight")).first()
    budget = (total or 0) * share
    level = running(ranked, [F.col("_cap") / F.col("_weight"), F.col("_rank")], {"_caps": "_cap", "_weights": "_weight"}, "_place").agg(
        F.max((F.lit(budget) - F.col("_caps")) / (F.lit(weight or 1.0) - F.col("_weights")))
    ).first()[0]
    return ranked.withColumn("target", F.least("_cap", F.col("_weight") * F.lit(float(level or 0)))).drop("_rank", "_weight", "_cap")


def plan(docs: DataFrame, **how) -> tuple[DataFrame, DataFrame]:
    """(sized rows, one row per source with its target and the key at which it is cut)."""
    sized = stage(docs.select(
        "doc_id", "source", n_words("text").alias("size"), _source_key().alias("_source"), _key("doc_id").alias("_key"),
    ), "mix-rows")
    sized = sized.withColumn("_range", F.substring("_key", 1, RANGE_DIGITS))
    ranges = stage(sized.groupBy("_source", "_range").agg(F.first("source").alias("source"), F.sum("size").alias("_size"), F.count("*").alias("_n")), "mix-ranges")
    sizes = stage(ranges.groupBy("_source").agg(F.first("source").alias("source"), F.sum("_size").alias("source_size"), F.sum("_n").alias("n")), "mix-sources")
    targets = stage(
        budgets(sizes, **how)
        .withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0))
        .withColumn("_rest", F.floor("target") - F.col("epochs") * F.col("source_size")),
        "mix-targets",
    )
    before = Window.partitionBy("_source").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    cut = (
        ranges.select("_source", "_range", "_size", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))
        .join(targets.select("_source", "_rest"), "_source")
        .filter("_before <= _rest and _rest < _before + _size")
    )
    ties = sized.join(cut.select("_source", "_range", "_before", "_rest"), ["_source", "_range"]).groupBy("_source", "_key").agg(
        F.sum("size").alias("_size"), F.count("*").alias("_ties"), F.first("_before").alias("_before"), F.first("_rest").alias("_rest")
    )
    upto = Window.partitionBy("_source").orderBy("_key").rowsBetween(Window.unboundedPreceding, -1)
    at = (
        ties.withColumn("_before", F.col("_before") + F.coalesce(F.sum("_size").over(upto), F.lit(0)))
        .filter("_before <= _rest and _rest < _before + _size")
        .select("_source", F.col("_key").alias("_cut"), F.floor((F.col("_rest") - F.col("_before")) / F.col("_ties")).alias("_part"))
    )
    return sized, stage(targets.join(at, "_source", "left").drop("source", "_rest"), "mix-cuts")


def _taken() -> Column:
    """Whole epochs, and of the cut one all before the cut and a part of the row at it."""
    more = F.when(F.col("_key") < F.col("_cut"), F.col("size")).when(F.col("_key") == F.col("_cut"), F.least("_part", "size")).otherwise(0)
    return (F.col("epochs") * F.col("size") + more).cast("long")


def mix(docs: DataFrame, **how) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken.

    A source without words takes none. Rows of one doc_id and source have one key; at the
    cut they share what is left, rounded down. Empty input gives no rows.
    """
    sized, cuts = plan(docs, **how)
    total = sized.count()
    out = hot_join(sized.drop("source", "_range"), cuts, "_source", "n", total)
    return out.select("doc_id", "size", "source_size", "target", _taken().alias("taken"))


def apply_mix(docs: DataFrame, **how) -> DataFrame:
    """The documents of the mix, with all their columns: a row for each epoch that takes
    any of it (the row at a cut stays whole); rows that nothing is taken of go."""
    sized, cuts = plan(docs, **how)
    total = sized.count()
    names = docs.columns
    cells = docs.filter(F.col("text").rlike(WORD)).select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"), _source_key().alias("_source"), _key("doc_id").alias("_key"))
    out = hot_join(cells, cuts.select("_source", "epochs", "_cut", "_part", "n"), "_source", "n", total)
    whole = F.col("epochs") + F.when((F.col("_key") < F.col("_cut")) | ((F.col("_key") == F.col("_cut")) & (F.col("_part") > 0)), 1).otherwise(0)
    copies = F.explode(F.sequence(F.lit(1), whole.cast("int")))
    return out.filter(whole > 0).select("_row", copies.alias("_copy")).select("_row.*")
