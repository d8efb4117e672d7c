"""Sharding by Karmarkar-Karp differencing.

Documents of equal text (a missing text equals another) form an indivisible group, which is
placed on one shard, so that the bytes of the shards come out as even as the groups allow.
The size of a document is its UTF-8 bytes plus one.

Groups over ``1 / BUNDLES`` of all bytes stand alone; there are fewer than BUNDLES of them.
All others are hashed into BUNDLES bundles. So differencing orders at most 2 * BUNDLES items
whatever the size of the corpus, and its outcome is small enough to broadcast. A group of
more than a shard's share fills a shard of its own as far as it goes.
"""

from __future__ import annotations

import heapq

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from farespan.llm.common import stage

BUNDLES = 1 << 15
SLOT_ROWS = 20_000  # rows of a shard numbered together


def difference(sizes: list[int], k: int) -> list[int]:
    """Shard of each item: the two partial partitions of largest spread are combined,
    the fullest part of one with the emptiest of the other, until one is left."""
    if not sizes:
        return []
    sums = {i: [s] + [0] * (k - 1) for i, s in enumerate(sizes)}
    heap = [(-s, i) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    merges = []
    while len(heap) > 1:
        a, b = heapq.heappop(heap)[1], heapq.heappop(heap)[1]
        joined = [x + y for x, y in zip(sums.pop(a), reversed(sums.pop(b)))]
        order = sorted(range(k), key=joined.__getitem__, reverse=True)
        node = len(sizes) + len(merges)
        merges.append((a, b, order))
        sums[node] = [joined[i] for i in order]
        heapq.heappush(heap, (joined[order[-1]] - joined[order[0]], node))
    place = {heap[0][1]: list(range(k))}
    for n in range(len(merges) - 1, -1, -1):
        a, b, order = merges[n]
        parts = place.pop(len(sizes) + n)
        at = [0] * k
        for slot, i in enumerate(order):
            at[i] = parts[slot]
        place[a], place[b] = at, at[::-1]
    return [place[i][0] for i in range(len(sizes))]


def shard(docs: DataFrame, shards: int = 16, bundles: int = BUNDLES) -> DataFrame:
    """Places every row; returns doc_id, size, text_crc32, law, shard, slot, grown_shard.

    ``slot`` counts from 0 without gaps inside a shard. Empty input gives no rows; a null
    doc_id or text is a row like others, and repeated rows stay together as equal texts.
    """
    digest = F.coalesce(F.unhex(F.sha2("text", 256)), F.lit("").cast("binary"))
    thin = stage(docs.select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32("text").alias("text_crc32"), digest.alias("_digest"),
    ), "shard-rows")
    groups = stage(thin.groupBy("_digest").agg(F.sum("size").alias("_bytes")), "shard-groups")
    total = groups.agg(F.sum("_bytes")).first()[0] or 0
    alone = F.col("_bytes") > total / bundles
    items = groups.select(
        F.when(alone, F.col("_digest")).alias("_digest"),
        F.when(~alone, F.pmod(F.xxhash64("_digest"), F.lit(bundles))).alias("_bundle"), "_bytes",
    ).groupBy("_digest", "_bundle").agg(F.sum("_bytes").alias("_bytes"))

    def place(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.assign(_text=pdf["_digest"].map(lambda x: b"" if x is None else bytes(x)))
        pdf = pdf.sort_values(["_bytes", "_bundle", "_text"], ascending=[False, True, True], kind="stable")
        pdf["shard"] = difference(pdf["_bytes"].astype("int64").tolist(), shards)
        return pdf[["_digest", "_bundle", "shard"]]

    placed = stage(items.withColumn("_all", F.lit(0)).groupBy("_all").applyInPandas(place, "_digest binary, _bundle long, shard int"), "shard-places")
    single = F.broadcast(placed.filter("_digest is not null").select("_digest", F.col("shard").alias("_single")))
    many = F.broadcast(placed.filter("_digest is null").select("_bundle", F.col("shard").alias("_many")))
    rows = (
        thin.withColumn("_bundle", F.pmod(F.xxhash64("_digest"), F.lit(bundles)))
        .join(single, "_digest", "left").join(many, "_bundle", "left")
        .withColumn("shard", F.coalesce("_single", "_many"))
    )
    return numbered(rows, thin.count()).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def numbered(rows: DataFrame, total: int) -> DataFrame:
    """Adds a gapless ``slot`` per shard: rows are counted in hashed parts of a shard, and
    each part starts where the ones before it end."""
    parts = max(1, total // (16 * SLOT_ROWS))
    rows = stage(rows.withColumn("_cell", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(parts))).select("doc_id", "size", "text_crc32", "shard", "_cell"), "shard-cells")
    before = Window.partitionBy("shard").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy("shard", "_cell").agg(F.count("*").alias("_n")).select("shard", "_cell", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    within = Window.partitionBy("shard", "_cell").orderBy("doc_id", "text_crc32", "size")
    return rows.join(starts, ["shard", "_cell"]).withColumn("slot", F.row_number().over(within) - 1 + F.col("_start"))
