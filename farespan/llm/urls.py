"""URL filters: rules first, then the ratio of two character language models.

Rules that allow or block a host and path also label URLs for training. From the labelled
URLs (all of them, but for a hashed fifth) two variable-order Markov models are counted, one
of allowed and one of blocked URLs. A next character has the probability

    p_k = (n(context, c) + ALPHA * p_{k-1}) / (n(context) + ALPHA)

for contexts of k = 0 .. ORDER characters (bytes), so a longer context counts as far as it has
been seen. A context of ORDER characters and the next one fit in a 64-bit key, so counts are
exact; they stay a DataFrame that grows with the input. Each distinct key gets its gain in
log-likelihood once, then addresses meet the gains of their keys. A URL's score is the difference of the two log-likelihoods per character; the
threshold is where the fifth held out is told apart best.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farespan.llm import arrays as A
from farespan.llm.common import hot_join, stage

ORDER = 5
UNIT = 1e9  # gains are summed as whole numbers of 1 / UNIT, so that no order of rows matters
ALPHA = 2.0
BINS, WIDTH = 2001, 0.01  # score histogram for the threshold
HELD_OUT = 5

#: (verdict, host, path)
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))


def host_of(url: str) -> Column:
    h = F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(h, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: str) -> Column:
    return F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def matched(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(name, verdict) of the longest rule that fits, else null."""
    name = verdict = None
    for v, h, p in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name = F.when(fits, h + p) if name is None else name.when(fits, h + p)
        verdict = F.when(fits, v) if verdict is None else verdict.when(fits, v)
    return name, verdict


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each character of each address: the last ORDER + 1 bytes up to it as one number.

    Each text stands behind ORDER start marks and ends with an end mark."""
    for batch in batches:
        for part in A.pieces(batch, "address", 1 << 18):
            flat, offsets = A.raw(part.column("address"))
            n, size = len(offsets) - 1, np.diff(offsets)
            at = offsets[:-1] + np.arange(n) * (ORDER + 1)
            padded = np.full(len(flat) + n * (ORDER + 1), 2, dtype=np.int64)
            owner = np.repeat(np.arange(n), size)
            padded[np.arange(len(flat)) + (owner + 1) * ORDER + owner] = flat
            padded[at + ORDER + size] = 3
            chars = np.ones(len(padded), dtype=bool)
            for j in range(ORDER):
                chars[at + j] = False
            i = np.flatnonzero(chars)
            gram = sum(padded[i - k] << (8 * k) for k in range(ORDER + 1))
            of = pa.array(np.repeat(np.arange(n), size + 1))
            yield pa.RecordBatch.from_arrays([*(part.column(c).take(of) for c in ("id", "n0", "n1")), pa.array(gram)], ["id", "n0", "n1", "gram"])


def _gains(grams: DataFrame, total: tuple[int, int]) -> DataFrame:
    """gram, rows, gain: log-likelihood as allowed less that as blocked, in 1 / UNIT."""
    out = grams
    p = [F.lit(1 / 256), F.lit(1 / 256)]
    for k in range(ORDER + 1):
        tables = {"c": (F.shiftright("gram", 8).bitwiseAND((1 << 8 * k) - 1), k), "b": (F.col("gram").bitwiseAND((1 << 8 * (k + 1)) - 1), k + 1)}
        seen = {}
        for kind, (key, size) in tables.items():
            if size == 0:
                seen[kind] = [F.lit(float(n)) for n in total]
            elif size == ORDER + 1:
                seen[kind] = [F.col("n0"), F.col("n1")]
            else:
                name = f"_{kind}{k}"
                counts = grams.groupBy(key.alias(name)).agg(F.sum("n0").alias(f"{name}_0"), F.sum("n1").alias(f"{name}_1"))
                # Two bytes or fewer have at most 65,536 values.
                out = out.withColumn(name, key).join(F.broadcast(counts) if size <= 2 else counts, name).drop(name)
                seen[kind] = [F.col(f"{name}_0"), F.col(f"{name}_1")]
        out = out.withColumns({f"_p{k}_{y}": (seen["b"][y] + F.lit(ALPHA) * p[y]) / (seen["c"][y] + F.lit(ALPHA)) for y in (0, 1)})
        p = [F.col(f"_p{k}_0"), F.col(f"_p{k}_1")]
    return out.select("gram", "rows", F.rint((F.log(p[1]) - F.log(p[0])) * UNIT).cast("long").alias("gain"))


def _threshold(held: DataFrame) -> float:
    """Threshold that tells ``label`` apart best by ``score``; at most 2 * BINS rows reach the driver."""
    half = BINS // 2
    bins = F.greatest(F.least(F.rint(F.col("score") / WIDTH), F.lit(float(half))), F.lit(-float(half))).cast("int") + half
    seen = np.zeros((2, BINS))
    for y, b, n in held.groupBy("label", bins.alias("bin")).agg(F.count("*").alias("n")).collect():
        seen[y, b] = n
    share = seen / np.maximum(seen.sum(axis=1, keepdims=True), 1)
    # Youden's index of the threshold below each bin; of equals, the one nearest to zero.
    gain = np.r_[0, np.cumsum(share[0] - share[1])]
    best = np.flatnonzero(gain >= gain.max() - 1e-12)
    edge = best[np.argmin(np.abs(best - half))]
    return float((edge - half) * WIDTH - WIDTH / 2)


def scored(rows: DataFrame) -> DataFrame | None:
    """``rows`` with a ``score``, by the model of their ``address, label`` (1 allowed, 0 blocked,
    null for no rule); None if a class has no row to count. ``rows`` are read several times."""
    rows = rows.withColumn("_id", F.xxhash64("address"))
    seen = F.pmod("_id", F.lit(HELD_OUT)) > 0
    addresses = rows.groupBy("address", F.col("_id").alias("id")).agg(*[F.sum(F.when(seen & (F.col("label") == y), 1).otherwise(0)).alias(f"n{y}") for y in (0, 1)])
    places = stage(addresses.mapInArrow(_grams, "id long, n0 long, n1 long, gram long"), "url-places")
    grams = stage(places.groupBy("gram").agg(F.count("*").alias("rows"), F.sum("n0").alias("n0"), F.sum("n1").alias("n1")), "url-grams")
    n0, n1, total = grams.agg(F.sum("n0"), F.sum("n1"), F.sum("rows")).first()
    if not n0 or not n1:
        return None
    gains = stage(_gains(grams, (n0, n1)), "url-gains")
    sums = hot_join(places.select("id", "gram"), gains, "gram", "rows", total).groupBy("id").agg((F.sum("gain") / F.count("*") / UNIT).alias("score"))
    copies = rows.groupBy(F.col("_id").alias("id")).agg(F.count("*").alias("_copies"))
    sums = stage(sums.join(copies, "id").withColumnRenamed("id", "_id"), "url-scores")
    return hot_join(rows, sums, "_id", "_copies", rows.count()).drop("_id", "_copies")


def judge(pages: DataFrame, rules=RULES) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, score.

    The verdict is that of the longest rule that fits, else the model's: ``allow`` if the
    score reaches the threshold. A null url and one without ``://`` have an empty host and
    path and are scored as an empty address. If rules label no URL of one of the classes,
    there is no model: the score is null and what no rule blocks is allowed.
    """
    host, path = F.col("host"), F.col("path")
    rule, verdict = matched(host, path, rules)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), host_of("url").alias("host"), path_of("url").alias("path"))
    rows = stage(rows.select("*", rule.alias("rule"), verdict.alias("_rule_verdict"), F.concat(host, F.lower(path)).alias("address")), "url-rows")
    rows = rows.withColumn("label", (F.col("_rule_verdict") == "allow").cast("int"))
    out = scored(rows)
    columns = ["page_id", "host", "path", "rule"]
    if out is None:
        return rows.select(*columns, F.coalesce("_rule_verdict", F.lit("allow")).alias("verdict"), F.lit(None).cast("double").alias("score"))
    out = stage(out, "url-scored")
    threshold = _threshold(out.filter(F.col("label").isNotNull() & (F.pmod(F.xxhash64("address"), F.lit(HELD_OUT)) == 0)))
    return out.select(*columns, F.coalesce("_rule_verdict", F.when(F.col("score") >= threshold, "allow").otherwise("block")).alias("verdict"), "score")
