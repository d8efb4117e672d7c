"""License scan: a trained paragraph classifier, confirmed by its templates.

Paragraphs are parted by blank lines; a long one is scored in overlapping windows. Features are
the word 1- to 3-grams of the templates that hold a word which isn't a stop word. A sparse
multinomial logistic regression over license families and an unknown class is fitted on
windows of the templates and on a bounded sample of corpus windows as unknown. A family's score
in a window is its log-odds against unknown: the bias and the weights of the grams found, so
scoring is one join of grams with weights and one sum.

A family is predicted where its odds pass a threshold that is calibrated on all windows that
no template touches, and is confirmed where enough of the window's word trigrams are in
the family's templates, or nearly all of one template's are in the window, and no better
matching family explains them. A window that looks like a license but passes for no family is
``unknown``. Only DataFrame functions and Spark's own ML stages are used.
"""

from __future__ import annotations

import math

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from farespan.llm.common import scoped, stage
from farespan.llm.license_texts import STOP, TEMPLATES

FAMILIES = tuple(TEMPLATES)
SAMPLE = 4000  # corpus windows, about, that stand for the unknown class in the fit; picked by hash
SPAN, STRIDE = 12, 2  # words of a training window of a template
LONG, STEP = 96, 48  # words of a window of a long paragraph; every notice of up to 49 words lies whole in one
CONFIRM = 0.5
CONTAINED = 0.8  # of a template's trigrams
TOUCHED = 3  # trigrams shared with a family: such a window may hold part of a notice
FALSE = 0.001  # share of windows that no template touches that may pass for a family
UNIT = 1e9  # weights are summed as whole numbers of 1 / UNIT, so that no order of rows matters
BIN = 0.05  # of log-odds, in the histogram that thresholds are read from


def tokens(text: str | Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}.]+"), lambda w: F.translate(w, ".", "") != "")


def grams(words: Column, n: int) -> Column:
    return F.when(
        F.size(words) >= n,
        F.transform(F.sequence(F.lit(1), F.size(words) - (n - 1)), lambda i: F.array_join(F.slice(words, i, n), " ")),
    ).otherwise(F.array().cast("array<string>"))


def features(words: Column) -> Column:
    return F.concat(words, grams(words, 2), grams(words, 3))


def parts(words: Column) -> Column:
    """Distinct trigrams of a text; of a shorter one all its words together."""
    return F.array_distinct(F.when(F.size(words) >= 3, grams(words, 3)).otherwise(F.array(F.array_join(words, " "))))


def once(c: Column) -> Column:
    """The value as a generated row: filters on it stay above, so it is evaluated once."""
    return F.explode(F.array(c))


def _templates(spark: SparkSession) -> DataFrame:
    rows = [(i, k, t) for i, f in enumerate(FAMILIES) for k, t in enumerate(TEMPLATES[f])]
    return spark.createDataFrame(rows, "family int, k int, text string").select("family", "k", tokens("text").alias("words"))


def _spans(templates: DataFrame) -> DataFrame:
    """Whole templates and their windows of SPAN words."""
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - (SPAN - 1), F.lit(1)), F.lit(STRIDE))
    cut = templates.select("family", F.explode(F.transform(starts, lambda i: F.slice("words", i, F.lit(SPAN)))).alias("words"))
    return cut.unionByName(templates.select("family", "words")).distinct()


def vocabulary(templates: DataFrame) -> list[str]:
    """All grams of the templates with a word that isn't a stop word."""
    found = templates.select(F.explode(features(F.col("words"))).alias("gram")).distinct()
    return sorted(r.gram for r in found.collect() if any(w not in STOP for w in r.gram.split(" ")))


def windows(docs: DataFrame, cues: list[str]) -> DataFrame:
    """_row, doc_id, paragraph, window, words, _id of every paragraph, or window of a long one, with
    a word of ``cues``; without one a window holds none of the model's features. ``_row`` tells
    the paragraphs of the table apart, ``_id`` the windows; both hold once stored."""
    near = F.array(*map(F.lit, cues))
    blocks = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.posexplode(F.split("text", r"\n[\x20\x09-\x0D]*\n")).alias("paragraph", "block"))
    words = blocks.select("doc_id", "paragraph", once(tokens("block")).alias("words")).filter(F.arrays_overlap("words", near))
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - LONG, F.lit(0)) + STEP, F.lit(STEP))
    words = words.withColumn("_row", F.monotonically_increasing_id())
    cut = words.select("_row", "doc_id", "paragraph", F.posexplode(F.transform(starts, lambda i: F.slice("words", i, F.lit(LONG)))).alias("window", "words"))
    return cut.filter(F.arrays_overlap("words", near)).withColumn("_id", F.monotonically_increasing_id())


def matches(rows: DataFrame, templates: DataFrame) -> DataFrame:
    """Rows (words, family) with ``similarity``, and ``found``, the distinct trigrams they share
    with the family's templates.

    The similarity is the share of the window's trigrams in the family's templates, or the
    largest share of one template's in the window if that reaches CONTAINED. A template of one or
    two words is looked for as a whole.
    """
    known = templates.groupBy("family").agg(F.collect_list(parts(F.col("words"))).alias("templates"))
    out = rows.join(F.broadcast(known), "family").withColumn("parts", parts(F.col("words")))
    short = F.array_distinct(F.concat("parts", grams(F.col("words"), 2), "words"))
    found = F.array_intersect("parts", F.array_distinct(F.flatten("templates")))
    held = F.array_max(F.transform("templates", lambda t: F.size(F.array_intersect(t, short)) / F.size(t)))
    share = F.greatest(F.size(found) / F.size("parts"), F.when(held >= CONTAINED, held).otherwise(0.0))
    whole = F.flatten(F.filter("templates", lambda t: F.size(F.array_intersect(t, short)) >= CONTAINED * F.size(t)))
    return out.select(*rows.columns, share.alias("similarity"), F.array_union(found, F.array_intersect(whole, short)).alias("found"))


def alike_() -> Column:
    return (F.col("similarity") >= CONFIRM) | (F.size("found") >= TOUCHED)


def fit(sample: DataFrame, templates: DataFrame, grams_: list[str]) -> tuple[DataFrame, list[float]]:
    """(gram, w0, w1, ...: weights against unknown in 1 / UNIT; bias of each family)."""
    spark = sample.sparkSession
    known = _spans(templates)
    # A window that a template confirms or touches is no sample of the unknown class.
    every = sample.select("_id", "words", F.explode(F.sequence(F.lit(0), F.lit(len(FAMILIES) - 1))).alias("family"))
    alike = matches(every, templates).filter(alike_()).select("_id").distinct()
    other = sample.join(alike, "_id", "left_anti").select(F.lit(len(FAMILIES)).alias("family"), "words")
    blank = spark.createDataFrame([(len(FAMILIES),)], "family int").withColumn("words", F.array().cast("array<string>"))
    rows = stage(known.unionByName(other).withColumn("weight", F.lit(1.0)).unionByName(blank.withColumn("weight", F.lit(known.count() / 4.0))), "license-fit")
    vectors = CountVectorizer(inputCol="features", outputCol="vector", vocabSize=max(len(grams_), 1), binary=True)
    vectors = vectors.fit(known.select(F.array_intersect(features(F.col("words")), F.array(*map(F.lit, grams_))).alias("features")))
    given = vectors.transform(rows.coalesce(2).select(F.col("family").cast("double").alias("label"), "weight", features(F.col("words")).alias("features")))
    model = LogisticRegression(featuresCol="vector", weightCol="weight", family="multinomial", regParam=0.001, elasticNetParam=0.5, maxIter=40).fit(given)
    w, b = model.coefficientMatrix.toArray(), model.interceptVector.toArray()
    against = w[:-1] - w[-1]
    table = [(g, *(int(round(x * UNIT)) for x in against[:, i])) for i, g in enumerate(vectors.vocabulary) if against[:, i].any()]
    names = [f"w{i}" for i in range(len(FAMILIES))]
    return spark.createDataFrame(table, ", ".join(["gram string", *(f"{n} long" for n in names)])), [float(x) for x in b[:-1] - b[-1]]


def scores(rows: DataFrame, weights: DataFrame, bias: list[float], key: str = "_id") -> DataFrame:
    """key, family, odds: log-odds of each family whose gram a row holds."""
    found = rows.select(key, F.explode(F.array_distinct(features(F.col("words")))).alias("gram")).join(F.broadcast(weights), "gram")
    sums = found.groupBy(key).agg(*[F.sum(f"w{i}").alias(f"w{i}") for i in range(len(FAMILIES))])
    odds = F.array(*[F.col(f"w{i}") / F.lit(UNIT) + F.lit(b) for i, b in enumerate(bias)])
    return sums.select(key, F.posexplode(odds).alias("family", "odds"))


def thresholds(judged: DataFrame, templates: DataFrame, weights: DataFrame, bias: list[float], total: int) -> list[float]:
    """Log-odds that each family has to reach.

    At most FALSE of all windows would pass with no template touching them, but a threshold never lies
    above the score of the family's weakest template, so that every template passes by itself;
    nor below even odds, nor at what a window without any gram has.
    """
    bins = F.floor(F.col("odds") / BIN)
    loose = judged.filter(~alike_()).groupBy("family", bins.alias("bin")).agg(F.count("*").alias("n"))
    seen: dict[int, list[tuple[int, int]]] = {}
    for r in loose.collect():
        seen.setdefault(r.family, []).append((r.bin, r.n))
    # The family's own score of each of its templates; one without a gram of weight has the bias.
    named = templates.withColumn("_id", F.concat_ws(":", "family", "k"))
    own = named.select("_id", F.col("family").alias("_own")).join(scores(named, weights, bias), "_id", "left")
    weakest = {r._own: r.odds for r in own.filter("_own = family").groupBy("_own").agg(F.min("odds").alias("odds")).collect()}
    out = []
    for f in range(len(FAMILIES)):
        limit, over = 0.0, 0
        for b, n in sorted(seen.get(f, ()), reverse=True):
            over += n
            if over > FALSE * total:
                limit = max(0.0, (b + 1) * BIN)
                break
        out.append(max(min(limit, weakest.get(f, limit)), 0.0, bias[f] + BIN))
    return out


@scoped
def scan(docs: DataFrame) -> DataFrame:
    """One row per paragraph and family that it passes for: doc_id, paragraph, window, windows,
    family, probability, similarity, confirmed.

    ``window`` is the best of the ``windows`` of the paragraph in which the family passes (of equals
    the first); the other values are its own, but ``confirmed`` is true if any of them confirms
    the family. A paragraph passes for every family over its threshold, and for ``unknown`` in
    those windows where a family has even odds but none passes. ``probability`` is that of the
    family against unknown. Paragraphs without a word of a template, null, empty and blank texts
    give no rows. Repeated rows and null ids are scanned like others and give rows of their
    own; equal scores of two families give both. Only ``doc_id`` and ``text`` are read.
    """
    spark = docs.sparkSession
    templates = stage(_templates(spark), "license-templates")
    grams_ = vocabulary(templates)
    cues = sorted({w for g in grams_ for w in g.split(" ") if w not in STOP})
    cut = stage(windows(docs, cues), "license-windows")
    total = cut.count()
    taught = F.pmod(F.xxhash64("words"), F.lit(1_000_003)) < int(min(1.0, SAMPLE / max(total, 1)) * 1_000_003)
    weights, bias = fit(cut.filter(taught), templates, grams_)
    likely = scores(cut, weights, bias).filter("odds >= 0").join(cut, "_id")
    judged = stage(matches(likely, templates), "license-judged")
    limits = thresholds(judged if total <= SAMPLE else judged.filter(~taught), templates, weights, bias, total)
    passes = F.col("odds") >= F.element_at(F.array(*map(F.lit, limits)), F.col("family") + 1)

    # A family is confirmed by trigrams that a better matching family of the window doesn't explain.
    better = Window.partitionBy("_id").orderBy(F.desc("similarity")).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    rivals = F.collect_list(F.struct("similarity", "found")).over(better)
    rows = judged.withColumn("_rivals", rivals)
    explained = F.flatten(F.transform(F.filter("_rivals", lambda r: r["similarity"] > F.col("similarity")), lambda r: r["found"]))
    left = F.size(F.array_except("found", explained)) * 2 >= F.size("found")
    rows = rows.withColumns({"passes": passes, "confirmed": (F.col("similarity") >= CONFIRM) & left})
    some = F.max("passes").over(Window.partitionBy("_id"))
    first = F.row_number().over(Window.partitionBy("_id").orderBy(F.desc("odds"), "family")) == 1
    rows = rows.withColumns({"_some": some, "_first": first}).filter("passes or (not _some and _first)")
    name = F.when(F.col("passes"), F.element_at(F.array(*map(F.lit, FAMILIES)), F.col("family") + 1)).otherwise("unknown")
    rows = rows.select(
        "_row", "doc_id", "paragraph", "window", name.alias("family"), "odds", "similarity", (F.col("confirmed") & F.col("passes")).alias("confirmed")
    )
    best = F.max_by(F.struct("window", "odds", "similarity"), F.struct(F.col("odds"), -F.col("window")))
    out = rows.groupBy("_row", "doc_id", "paragraph", "family").agg(best.alias("best"), F.count("*").alias("windows"), F.max("confirmed").alias("confirmed"))
    return out.select(
        "doc_id", F.col("paragraph").cast("long").alias("paragraph"), F.col("best.window").cast("long").alias("window"), "windows", "family",
        F.round(1 / (1 + F.exp(-F.col("best.odds"))), 6).alias("probability"), F.round("best.similarity", 6).alias("similarity"), "confirmed",
    )
