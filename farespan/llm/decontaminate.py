"""Benchmark decontamination by size-partitioned MinHash containment search.

A test item leaks into a document if at least ``threshold`` of the item's distinct 5-word
shingles (lower-cased A-Z) are among the document's. Documents are partitioned by their
number of shingles, by powers of two. In a partition of up to u shingles a document's
signature holds the least hash of each of 2u hash ranges, so its length follows the size and
a short item is still found inside a long document: a shared shingle is missed only if
another one of the document is less in the same range, with a chance under a quarter for each of
the item's shared shingles. Items of fewer than SHORT shingles are looked up among all
hashes, not only the least ones. What is found is then counted exactly.

The items are searched in blocks of bounded size, each against all documents in one pass
that moves no document.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farespan.llm import arrays as A

THRESHOLD = 0.8
SHORT = 24
BLOCK_BYTES = 8 << 20  # item text sent to the tasks at a time


class Items:
    """Index of one block of test items."""

    def __init__(self, ids: list[int | None], texts: pa.Array, threshold: float):
        sets = list(A.shingle_sets(texts))
        self.ids = ids
        self.size = np.array([len(s) for s in sets], dtype=np.int64)
        self.need = np.array([math.ceil(round(threshold * n, 9)) for n in self.size], dtype=np.int64)
        hashes = np.concatenate([*sets, np.zeros(0, A.U)])
        owner = np.repeat(np.arange(len(sets)), self.size)
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.owner = hashes[order], owner[order]
        short = self.size[self.owner] < SHORT
        self.short = np.unique(self.hashes[short])
        self.all = np.unique(self.hashes)
        self.quick = np.zeros(1 << 20, dtype=bool)
        self.quick[(self.all >> A.U(44)).astype(np.int64)] = True

    def _among(self, h: np.ndarray, of: np.ndarray) -> np.ndarray:
        h = h[self.quick[(h >> A.U(44)).astype(np.int64)]]
        if not len(h) or not len(of):
            return h[:0]
        return h[of[np.minimum(np.searchsorted(of, h), len(of) - 1)] == h]

    def _owners(self, h: np.ndarray) -> np.ndarray:
        lo, hi = np.searchsorted(self.hashes, h), np.searchsorted(self.hashes, h, "right")
        n = hi - lo
        return self.owner[np.repeat(lo - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())]

    def search(self, own: np.ndarray) -> list[tuple[int, int]]:
        """(item, shared shingles) for the items contained in a sorted set of hashes."""
        if not len(own):
            return []
        bits = A.U(64 - (int(len(own) - 1).bit_length() + 1))
        ranges = own >> bits
        least = own[np.r_[True, ranges[1:] != ranges[:-1]]]
        found = np.unique(np.concatenate([self._owners(self._among(least, self.all)), self._owners(self._among(own, self.short))]))
        if not len(found):
            return []
        shared = np.bincount(self._owners(self._among(own, self.all)), minlength=len(self.size))
        return [(int(i), int(shared[i])) for i in found if shared[i] >= self.need[i]]


def blocks(benchmark: DataFrame) -> Iterator[tuple[list, pa.Array]]:
    """Test items with a word, ids and texts, in blocks of about BLOCK_BYTES."""
    ids, texts, held = [], [], 0
    for row in benchmark.select(F.col("item_id").cast("long"), "text").filter("text is not null").orderBy("item_id", "text").toLocalIterator():
        if ids and held + len(row[1]) > BLOCK_BYTES:
            yield ids, pa.array(texts, pa.string())
            ids, texts, held = [], [], 0
        ids.append(row[0])
        texts.append(row[1])
        held += len(row[1])
    if ids:
        yield ids, pa.array(texts, pa.string())


def leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per leak: doc_id, item_id, item_shingles, shared, containment.

    Null and empty texts hold nothing and are found nowhere; items and documents of fewer
    than five words match as whole sequences. Repeated documents each give their rows.
    """
    schema = "doc_id long, item_id long, item_shingles long, shared long, containment double"
    out = docs.sparkSession.createDataFrame([], schema)
    rows = docs.selectExpr("cast(doc_id as long) doc_id", "text")
    for ids, texts in blocks(benchmark):
        def run(batches: Iterator[pa.RecordBatch], ids=ids, texts=texts) -> Iterator[pa.RecordBatch]:
            index = Items(ids, texts, threshold)
            for batch in batches:
                for part in A.pieces(batch, "text"):
                    hits = [(d, *h) for d, own in zip(part.column("doc_id").to_pylist(), A.shingle_sets(part.column("text"))) for h in index.search(own)]
                    if hits:
                        d, i, n = zip(*hits)
                        size = index.size[list(i)]
                        yield pa.RecordBatch.from_pydict({
                            "doc_id": pa.array(d, pa.int64()), "item_id": pa.array([index.ids[x] for x in i], pa.int64()),
                            "item_shingles": size, "shared": np.array(n, np.int64), "containment": np.array(n) / size,
                        })

        out = out.unionByName(rows.mapInArrow(run, schema))
    return out


def remove_leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that hold no test item, with all their columns; nothing is moved."""
    for ids, texts in blocks(benchmark):
        def run(batches: Iterator[pa.RecordBatch], ids=ids, texts=texts) -> Iterator[pa.RecordBatch]:
            index = Items(ids, texts, threshold)
            for batch in batches:
                for part in A.pieces(batch, "text"):
                    yield part.filter(pa.array([not index.search(own) for own in A.shingle_sets(part.column("text"))], pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
