"""Substring deduplication by prefix-free parsing.

Removes each byte covered by a LENGTH-byte string that also starts in a document with a
smaller doc_id. Rolling-hash triggers cut every text: a TRIGGER-byte window is a trigger if
its hash is the least in some LENGTH-byte string, so each such string holds a trigger, and
equal strings hold the same one at the same place. A phrase is a trigger with all that a
LENGTH-byte string around it can hold. The corpus is a parse, a list of phrases; equal
phrases are one entry of the dictionary. As only matches of LENGTH bytes are asked for, and a
phrase holds each such string round its trigger whole, no order of longer suffixes is needed:
instead of suffix arrays of dictionary and parse, the LENGTH-byte prefixes of the dictionary's
suffixes are compared by 64-bit hashes, trigger by trigger. An occurrence is then judged by
its phrase:

- a phrase that a smaller document has too is repeated in every string it holds;
- of a phrase's first document, each string is compared with the equal suffixes of other
  phrases of that trigger.

As data flow: texts are packed into chunks of about CHUNK bytes and stored. (1) Each chunk
deals its distinct triggers by hash and learns which are in other chunks. (2) For those it
deals its distinct phrases by trigger and learns which suffixes a smaller document has.
A trigger in over HOT chunks would load one group, so strings around it are dealt by
their own hash. (3) Each chunk marks what is covered and cuts it out. A chunk sends what it
holds several times only once, so a group of copies adds little more than its chunks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farespan.llm import arrays as A
from farespan.llm.common import stage

LENGTH, TRIGGER = 50, 24
AHEAD = LENGTH - TRIGGER  # bytes of a string that can stand before its trigger
WIDE = AHEAD + LENGTH  # bytes of a phrase
CHUNK = 2 << 20
HOT = 500
ROWS = 1 << 13  # phrases that are spelled out at a time
BUCKET_BYTES = 4 << 20  # text whose triggers meet in a group: a task holds about six times this, twice
LAST = np.iinfo(np.int64).max  # doc_id of a row that has none: after all others


# -- chunks ----------------------------------------------------------------------------

def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    base, n = TaskContext.get().partitionId() << 32, 0
    for batch in batches:
        for part in A.pieces(batch, "text", CHUNK):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, part.schema) as out:
                out.write_batch(part)
            blob = zstandard.ZstdCompressor(level=3).compress(sink.getvalue().to_pybytes())
            size = pc.sum(pc.binary_length(part.column("text"))).as_py() or 0
            yield pa.RecordBatch.from_arrays(
                [pa.array([base + n], pa.int64()), pa.array([size], pa.int64()), pa.array([blob], pa.binary())], ["chunk", "size", "blob"]
            )
            n += 1


class Chunk:
    """Texts of a chunk, its triggers and their phrases."""

    def __init__(self, blob: bytes):
        data = zstandard.ZstdDecompressor().decompress(blob)
        self.rows = pa.ipc.open_stream(data).read_all().combine_chunks()
        texts = self.rows.column("text")
        texts = texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts
        self.flat, self.offsets = A.raw(texts)
        self.doc_id = self.rows.column("doc_id").to_numpy()
        if self.doc_id.dtype != np.int64:
            self.doc_id = np.array([LAST if x is None else x for x in self.rows.column("doc_id").to_pylist()], dtype=np.int64)
        self.pos, self.g = triggers(self.flat, self.offsets)
        self.doc = np.searchsorted(self.offsets, self.pos, "right") - 1
        self.names, self.name = np.unique(self.g, return_inverse=True)

    def in_two(self) -> np.ndarray:
        """For each distinct trigger whether two doc_ids of the chunk have it."""
        lo, hi = np.full(len(self.names), LAST), np.full(len(self.names), np.iinfo(np.int64).min)
        np.minimum.at(lo, self.name, self.doc_id[self.doc])
        np.maximum.at(hi, self.name, self.doc_id[self.doc])
        return lo < hi

    def phrases(self, which: np.ndarray) -> np.ndarray:
        """WIDE symbols for each of these triggers: bytes plus one, 0 outside the text."""
        padded = np.zeros(len(self.flat) + AHEAD + LENGTH, dtype=np.uint16)
        padded[AHEAD : AHEAD + len(self.flat)] = self.flat.astype(np.uint16) + 1
        at = self.pos[which, None] + np.arange(WIDE)
        out = padded[at]
        at -= AHEAD
        out[(at < self.offsets[self.doc[which]][:, None]) | (at >= self.offsets[self.doc[which] + 1][:, None])] = 0
        return out


def _sliding(x: np.ndarray, k: int, op) -> np.ndarray:
    done = 1
    while done * 2 <= k:
        x = op(x[:-done], x[done:])
        done *= 2
    if done < k:
        more = k - done
        x = op(x[:-more], x[more:])
    return x


def triggers(flat: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the triggers that a LENGTH-byte string inside one text calls for, and hashes."""
    pos, got = [], []
    for start, end in _stretches(offsets):
        part = flat[start:end].astype(A.U) + A.U(1)
        if len(part) < LENGTH:
            continue
        p, q = A.tables(len(part) + 1)
        total = np.zeros(len(part) + 1, dtype=A.U)
        np.cumsum(part * p[: len(part)], out=total[1:])
        h = A.mix((total[TRIGGER:] - total[:-TRIGGER]) * q[: len(part) - TRIGGER + 1])
        least = _sliding(h, AHEAD + 1, np.minimum)
        # Strings that run over the end of a text call for nothing.
        inner = offsets[(offsets > start) & (offsets < end)] - start
        for x in inner:
            least[max(0, x - LENGTH + 1) : x] = 0
        edge = np.zeros(AHEAD, dtype=A.U)
        called = _sliding(np.concatenate([edge, least, edge]), AHEAD + 1, np.maximum)
        at = np.flatnonzero(called == h)
        pos.append(at + start)
        got.append(h[at])
    return np.concatenate([*pos, np.zeros(0, np.int64)]), np.concatenate([*got, np.zeros(0, A.U)])


def _stretches(offsets: np.ndarray, most: int = 1 << 18) -> Iterator[tuple[int, int]]:
    """Whole texts together up to about ``most`` bytes; a longer text alone."""
    at = 0
    for i in range(1, len(offsets)):
        if i == len(offsets) - 1 or offsets[i + 1] - offsets[at] > most:
            if offsets[i] > offsets[at]:
                yield int(offsets[at]), int(offsets[i])
            at = i


def windows(symbols: np.ndarray, o: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the string at offset ``o`` of each phrase, and whether it lies in the text."""
    part = symbols[:, o : o + LENGTH]
    p, _ = A.tables(LENGTH)
    return A.mix(part.astype(A.U) @ p[:LENGTH]), (part[:, 0] > 0) & (part[:, -1] > 0)


def _ranges(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of each hash, in the order of the hashes."""
    return ((hashes >> A.U(32)) * A.U(buckets) >> A.U(32)).astype(np.int64)


def _cut(bucket: np.ndarray, *columns: np.ndarray) -> tuple[np.ndarray, list[list[bytes]]]:
    """Distinct buckets of a sorted array, and for each column the bytes of each bucket."""
    if not len(bucket):
        return bucket, [[] for _ in columns]
    edge = np.r_[np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]), len(bucket)]
    return bucket[edge[:-1]], [[np.ascontiguousarray(c[a:b]).tobytes() for a, b in zip(edge[:-1], edge[1:])] for c in columns]


def _read(column: pa.ChunkedArray, kind) -> list[np.ndarray]:
    return [np.frombuffer(x.as_buffer(), dtype=kind) for x in column]


# -- round 1: triggers that several chunks have --------------------------------------------

def _deal_triggers(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, blob in zip(batch.column("chunk").to_pylist(), batch.column("blob")):
                names = Chunk(blob.as_buffer().to_pybytes()).names
                short = (names & A.U((1 << 40) - 1)).view(np.uint8).reshape(-1, 8)[:, :5]
                bucket, (data,) = _cut(_ranges(names, buckets), short)
                yield pa.RecordBatch.from_arrays([pa.array(bucket), pa.array(np.full(len(bucket), chunk)), pa.array(data, pa.binary())], ["bucket", "chunk", "data"])

    return run


def _spread(table: pa.Table, hot: int) -> pa.Table:
    """Code of each trigger of a bucket: 0 in one chunk, 1 in several, 2 in over ``hot``."""
    parts = []
    for x in _read(table.column("data"), np.uint8):
        wide = np.zeros((len(x) // 5, 8), dtype=np.uint8)
        wide[:, :5] = x.reshape(-1, 5)
        parts.append(wide.view(A.U).ravel())
    every = np.concatenate(parts)
    order = np.argsort(every, kind="stable")
    edge = np.r_[np.flatnonzero(np.r_[True, np.diff(every[order]) != 0]), len(every)]
    n = np.diff(edge)
    code = np.empty(len(every), dtype=np.uint8)
    code[order] = np.repeat((n > 1).astype(np.uint8) + (n > hot), n)
    ends = np.cumsum([len(x) for x in parts])
    codes = [code[b - len(x) : b].tobytes() for x, b in zip(parts, ends)]
    return pa.table({"chunk": table.column("chunk"), "bucket": table.column("bucket"), "codes": pa.array(codes, pa.binary())})


def _codes(chunk: Chunk, replies: pa.Table) -> np.ndarray:
    """Code of each trigger of a chunk, counting what the chunk itself has twice."""
    order = pc.sort_indices(replies, sort_keys=[("bucket", "ascending")])
    got = _read(replies.column("codes").take(order), np.uint8)
    code = np.concatenate([*got, np.zeros(0, np.uint8)])
    return np.maximum(code, chunk.in_two())[chunk.name]


# -- round 2: suffixes of phrases that a smaller document has --------------------------------

def _entries(chunk: Chunk, which: np.ndarray, buckets: int):
    """Distinct phrases of some triggers: for each trigger its entry; for each entry a
    trigger that has it, its least doc_id and bucket, in the order of buckets."""
    p, _ = A.tables(WIDE)
    key = np.empty(len(which), dtype=A.U)
    for i in range(0, len(which), ROWS):
        key[i : i + ROWS] = A.mix(chunk.phrases(which[i : i + ROWS]).astype(A.U) @ p[:WIDE])
    bucket = _ranges(chunk.g[which], buckets)
    doc_id = chunk.doc_id[chunk.doc[which]]
    order = np.lexsort((doc_id, key, bucket))
    new = np.r_[True, (key[order][1:] != key[order][:-1]) | (bucket[order][1:] != bucket[order][:-1])][: len(order)]
    entry = np.empty(len(order), dtype=np.int64)
    entry[order] = np.cumsum(new) - 1
    first = order[new]
    return entry, which[first], doc_id[first], bucket[first]


def _strings(chunk: Chunk, which: np.ndarray, buckets: int):
    """Distinct strings around some triggers: for each start its string; for each string its
    hash, least doc_id and bucket, in the order of buckets."""
    starts = np.unique((chunk.pos[which, None] - np.arange(AHEAD + 1)).ravel())
    starts = starts[starts >= 0]
    doc = np.searchsorted(chunk.offsets, starts, "right") - 1
    inside = starts + LENGTH <= chunk.offsets[doc + 1]
    starts, doc = starts[inside], doc[inside]
    key = np.zeros(len(starts), dtype=A.U)
    p, _ = A.tables(LENGTH)
    for i in range(0, len(starts), ROWS):
        at = starts[i : i + ROWS, None] + np.arange(LENGTH)
        key[i : i + ROWS] = A.mix((chunk.flat[at].astype(A.U) + A.U(1)) @ p[:LENGTH])
    doc_id = chunk.doc_id[doc]
    order = np.lexsort((doc_id, key))
    new = np.r_[True, key[order][1:] != key[order][:-1]][: len(order)]
    name = np.empty(len(order), dtype=np.int64)
    name[order] = np.cumsum(new) - 1
    first = order[new]
    return starts, doc, name, key[first], doc_id[first], _ranges(key[first], buckets)


def _deal_phrases(buckets: int):
    def run(key, chunks: pa.Table, replies: pa.Table) -> pa.Table:
        names = ["bucket", "chunk", "data", "docs"]
        if not chunks.num_rows:
            return pa.table([pa.array([], t) for t in (pa.int64(), pa.int64(), pa.binary(), pa.binary())], names)
        chunk = Chunk(chunks.column("blob")[0].as_buffer().to_pybytes())
        code = _codes(chunk, replies)
        pa.default_memory_pool().release_unused()
        _, first, docs, bucket = _entries(chunk, np.flatnonzero(code == 1), buckets)
        # A byte is sent as it is; a symbol outside the text shows in the two counts before it.
        data = np.empty((len(first), WIDE + 2), dtype=np.uint8)
        for i in range(0, len(first), ROWS):
            symbols = chunk.phrases(first[i : i + ROWS])
            data[i : i + ROWS, 0] = (symbols[:, :AHEAD] > 0).sum(1)
            data[i : i + ROWS, 1] = (symbols[:, AHEAD:] > 0).sum(1)
            data[i : i + ROWS, 2:] = np.maximum(symbols, 1) - 1
        at_a, (data_a, docs_a) = _cut(bucket, data, docs)
        _, _, _, strings, docs, bucket = _strings(chunk, np.flatnonzero(code == 2), buckets)
        at_b, (data_b, docs_b) = _cut(bucket, strings, docs)
        # Buckets of strings stand behind those of phrases.
        return pa.table([
            pa.array(np.r_[at_a, at_b + buckets].astype(np.int64)), pa.array(np.full(len(at_a) + len(at_b), chunks.column("chunk")[0].as_py(), np.int64)),
            pa.array(data_a + data_b, pa.binary()), pa.array(docs_a + docs_b, pa.binary()),
        ], names)

    return run


def _repeated(buckets: int):
    """For each phrase of a bucket the bits of the strings that a smaller document has."""

    def run(table: pa.Table) -> pa.Table:
        docs = _read(table.column("docs"), np.int64)
        size = np.array([len(x) for x in docs])
        doc = np.concatenate(docs)
        if table.column("bucket")[0].as_py() >= buckets:
            keys = np.concatenate(_read(table.column("data"), A.U))
            bits = _later(keys, doc).astype(np.uint32)
        else:
            data = np.concatenate([x.reshape(-1, WIDE + 2) for x in _read(table.column("data"), np.uint8)])
            bits = np.zeros(len(doc), dtype=np.uint32)
            for i in range(AHEAD + 1):
                key = np.empty(len(doc), dtype=A.U)
                p, _ = A.tables(LENGTH)
                for a in range(0, len(doc), ROWS):
                    part = data[a : a + ROWS, 2 + i : 2 + i + LENGTH]
                    key[a : a + ROWS] = A.mix((part.astype(A.U) + A.U(1)) @ p[:LENGTH])
                ok = np.flatnonzero((data[:, 0] >= AHEAD - i) & (data[:, 1] >= LENGTH - AHEAD + i))
                bits[ok] |= _later(key[ok], doc[ok]).astype(np.uint32) << np.uint32(i)
        ends = np.cumsum(size)
        out = [bits[b - n : b].tobytes() for n, b in zip(size, ends)]
        pa.default_memory_pool().release_unused()
        return pa.table({"chunk": table.column("chunk"), "bucket": table.column("bucket"), "bits": pa.array(out, pa.binary())})

    return run


def _later(key: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Whether an equal key has a smaller doc_id."""
    order = np.argsort(key, kind="stable")
    new = np.r_[True, key[order][1:] != key[order][:-1]][: len(order)]
    out = np.zeros(len(key), dtype=bool)
    if len(key):
        least = np.minimum.reduceat(doc[order], np.flatnonzero(new))
        out[order] = doc[order] > least[np.cumsum(new) - 1]
    return out


# -- round 3: what is cut out ------------------------------------------------------------

OUT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _covered(chunk: Chunk, replies: pa.Table, buckets: int) -> np.ndarray:
    first = replies.filter(pc.is_valid(replies.column("codes")))
    second = replies.filter(pc.is_valid(replies.column("bits")))
    code = _codes(chunk, first)
    second = second.take(pc.sort_indices(second, sort_keys=[("bucket", "ascending")]))
    bits = np.concatenate([*_read(second.column("bits"), np.uint32), np.zeros(0, np.uint32)])
    which = np.flatnonzero(code == 1)
    starts = np.zeros(len(chunk.flat) + 1, dtype=bool)
    entry, _, least, _ = _entries(chunk, which, buckets)
    phrase_bits, string_bits = bits[: len(least)], bits[len(least) :]
    later = chunk.doc_id[chunk.doc[which]] > least[entry]
    lo, hi = chunk.offsets[chunk.doc[which]], chunk.offsets[chunk.doc[which] + 1]
    for i in range(AHEAD + 1):
        at = chunk.pos[which] - AHEAD + i
        inside = (at >= lo) & (at + LENGTH <= hi)
        hit = inside & (later | ((phrase_bits[entry] >> np.uint32(i)) & np.uint32(1)).astype(bool))
        starts[at[hit]] = True
    at, doc, name, _, least, _ = _strings(chunk, np.flatnonzero(code == 2), buckets)
    hit = (chunk.doc_id[doc] > least[name]) | (string_bits[name] > 0)
    starts[at[hit]] = True
    step = np.zeros(len(chunk.flat) + LENGTH + 1, dtype=np.int32)
    step[: len(starts)] += starts
    step[LENGTH : LENGTH + len(starts)] -= starts
    return np.cumsum(step)[: len(chunk.flat)] > 0


def _finish(buckets: int, with_text: bool):
    def run(key, chunks: pa.Table, replies: pa.Table) -> pa.Table:
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept"] * with_text
        types = [pa.int64()] * 4 + [pa.string()] + [pa.binary()] * with_text
        if not chunks.num_rows:
            return pa.table([pa.array([], t) for t in types], names)
        chunk = Chunk(chunks.column("blob")[0].as_buffer().to_pybytes())
        gone = _covered(chunk, replies, buckets)
        pa.default_memory_pool().release_unused()
        rows = []
        for i, doc_id in enumerate(chunk.rows.column("doc_id").to_pylist()):
            a, b = chunk.offsets[i], chunk.offsets[i + 1]
            out = gone[a:b]
            kept = chunk.flat[a:b][~out].tobytes()
            spans = int(out[:1].sum()) + int((out[1:] & ~out[:-1]).sum())
            rows.append((doc_id, int(b - a), int(out.sum()), spans, hashlib.sha256(kept).hexdigest(), *([kept] * with_text)))
        return pa.table([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    return run


def dedup(docs: DataFrame, with_text: bool = False, hot: int = HOT) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256 [, kept].

    A null text counts as empty and keeps the digest of no bytes. A row without a doc_id
    comes after all others. Rows of one doc_id don't count against each other.
    """
    chunks = stage(docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(_packed, "chunk long, size long, blob binary"), "substring-chunks")
    total = chunks.agg(F.sum("size")).first()[0] or 0
    buckets = int(total // BUCKET_BYTES) + chunks.sparkSession.sparkContext.defaultParallelism
    blobs = chunks.select("chunk", "blob")
    codes = stage(
        blobs.mapInArrow(_deal_triggers(buckets), "bucket long, chunk long, data binary")
        .groupBy("bucket").applyInArrow(lambda t: _spread(t, hot), "chunk long, bucket long, codes binary"),
        "substring-codes",
    )
    phrases = blobs.groupBy("chunk").cogroup(codes.groupBy("chunk")).applyInArrow(_deal_phrases(buckets), "bucket long, chunk long, data binary, docs binary")
    bits = phrases.groupBy("bucket").applyInArrow(_repeated(buckets), "chunk long, bucket long, bits binary")
    replies = codes.withColumn("bits", F.lit(None).cast("binary")).unionByName(bits.withColumn("codes", F.lit(None).cast("binary")))
    schema = OUT + ", kept binary" * with_text
    return blobs.groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInArrow(_finish(buckets, with_text), schema)
