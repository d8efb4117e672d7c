"""Byte-level BPE encoding and decoding as a monoid tree reduction.

A text falls into matches of the split pattern, and each match is encoded by itself. A match is
encoded by halves, recursively, and the ids of neighbours are joined: if the merges would leave
the two ids at the seam apart, the lists are put one after the other; else the last and
first ids round the seam are encoded anew, in a window that grows until the ids at both of
its ends are left apart from their neighbours.

That is exact. A merge looks at adjacent parts alone and takes the least rank, leftmost first.
The first merge over a seam between two ids happens, if at all, at the state in which it
would happen in the encoding of just these two. So a list is the encoding of its bytes if
and only if each adjacent pair is the encoding of its own bytes, and a window may stop
where its edges pass that test: no id outside can change.

Decoding concatenates the bytes of the ids up a tree of halves.
"""

from __future__ import annotations

import base64
import heapq
from array import array
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType

from farespan.llm import arrays as A

LEAF = 4  # bytes that are merged directly
GATHER = 1 << 16  # ids whose bytes are put together at once
KNOWN = 1 << 18  # entries of each of a worker's memories; beyond it the older half goes
ROWS = 256  # rows decoded together
REMEMBERED = 64  # characters of the longest chunk that is remembered
HALVES, WINDOWS = 8, 16  # bytes of the longest half and of the longest window that are remembered


class Memory(dict):
    """Remembers up to KNOWN results, and the KNOWN before them as long as they are asked for."""

    def __init__(self, make):
        super().__init__()
        self.make, self.older = make, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
            if value is None:
                return None
        if len(self) >= KNOWN:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


class Codec:
    """Ranks of byte strings, and the pattern that splits a text before any merge.

    ``ranks`` holds every single byte; the file has a base64 string and a rank a line.
    """

    def __init__(self, file: bytes, pattern: str):
        self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file.splitlines()) if a}
        self.bytes: list[bytes | None] = [None] * (max(self.ranks.values()) + 1)
        for data, i in self.ranks.items():
            self.bytes[i] = data
        self.table = pa.array(self.bytes, pa.binary())
        self.split = regex.compile(pattern)
        # Whether blanks part matches and letters stay together, as in the usual patterns.
        self.blanks = self.split.findall("Ab cD, x") == ["Ab", " cD", ",", " x"]
        self.pairs = Memory(lambda ab: self.window(self.bytes[ab[0]] + self.bytes[ab[1]]) == [*ab])
        self.halves = Memory(self._reduced)
        self.windows = Memory(self.merged)
        self.parts = Memory(self._part)

    # ------------------------------------------------------------ one match

    def merged(self, data: bytes) -> list[int]:
        """Ids by merges of least rank, leftmost first. A heap holds the pairs that can merge."""
        ranks, n = self.ranks, len(data)
        end = list(range(1, n + 1))  # where the part that begins here ends; 0 for no part
        before = list(range(-1, n - 1))
        heap = [(r, i) for i in range(n - 1) if (r := ranks.get(data[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            j = end[i]
            if not j or j >= n or ranks.get(data[i : end[j]]) != rank:
                continue  # one of the two parts has been merged since
            k = end[i] = end[j]
            end[j] = 0
            if k < n:
                before[k] = i
                if (r := ranks.get(data[i : end[k]])) is not None:
                    heapq.heappush(heap, (r, i))
            if (p := before[i]) >= 0 and (r := ranks.get(data[p:k])) is not None:
                heapq.heappush(heap, (r, p))
        out, i = [], 0
        while i < n:
            out.append(ranks[data[i : end[i]]])
            i = end[i]
        return out

    def window(self, data: bytes) -> list[int]:
        return self.windows[data] if len(data) <= WINDOWS else self.merged(data)

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of the bytes of two encodings; associative, with the empty list as unit.

        ``pairs`` tells of two ids whether they are the encoding of their own bytes.
        """
        apart = self.pairs
        if not left or not right or apart[left[-1], right[0]]:
            return left + right
        k = 1
        while True:
            i, j = max(len(left) - k, 0), min(k, len(right))
            window = self.window(b"".join([self.bytes[x] for x in left[i:] + right[:j]]))
            if (i == 0 or apart[left[i - 1], window[0]]) and (j == len(right) or apart[window[-1], right[j]]):
                return left[:i] + window + right[j:]
            k *= 2

    def reduced(self, data: bytes) -> list[int]:
        """Ids of one match: halves, joined up the tree."""
        return self.halves[data] if len(data) <= HALVES else self._reduced(data)

    def _reduced(self, data: bytes) -> list[int]:
        if len(data) <= LEAF:
            return self.merged(data)
        half = len(data) // 2
        return self.join(self.reduced(data[:half]), self.reduced(data[half:]))

    # ------------------------------------------------------------ texts

    def matches(self, chunk: str) -> bytes:
        """Ids of the matches of a chunk, as 32-bit numbers. A match that is itself ranked is one id."""
        ids: list[int] = []
        word = chunk[1:] if chunk[:1] == " " else chunk
        # Plain letters behind at most one blank are one match.
        for match in (chunk,) if self.blanks and word.isascii() and word.isalpha() else self.split.findall(chunk):
            data = match.encode()
            one = self.ranks.get(data)
            if one is None:
                ids += self.reduced(data)
            else:
                ids.append(one)
        return array("i", ids).tobytes()

    def _part(self, part: str) -> bytes | None:
        """Ids of a part that stands behind a blank; none if it doesn't begin and end with ink."""
        if not part or part[0].isspace() or part[-1].isspace() or len(part) > REMEMBERED:
            return None
        return self.matches(" " + part)

    def encode(self, text: str) -> bytes:
        """Ids of a text, as 32-bit numbers.

        A single blank between two characters that are no white space always begins a match, so
        the text may be cut there; all else stays together for the pattern. A pattern for which that
        doesn't hold gets the whole text.
        """
        if not self.blanks:
            return self.matches(text)
        first, *rest = text.split(" ")
        out = list(map(self.parts.__getitem__, rest))
        if None not in out and not (first and first[-1].isspace()):
            return b"".join([self.matches(first), *out])
        out, held = [], first
        for part in rest:
            if held and part and not held[-1].isspace() and not part[0].isspace():
                out.append(held)
                held = " " + part
            else:
                held += " " + part
        out.append(held)
        return b"".join([(self.parts[x[1:]] if x[:1] == " " else None) or self.matches(x) for x in out])

    def decode(self, ids: Sequence[int] | pa.Array) -> bytes:
        """Bytes of ids, put together up a tree of halves; a KeyError for a null or unknown one."""
        if len(ids) > GATHER:
            half = len(ids) // 2
            return self.decode(ids[:half]) + self.decode(ids[half:])
        try:
            found = self.table.take(ids if isinstance(ids, pa.Array) else pa.array(ids, pa.int64()))
        except (IndexError, TypeError, pa.ArrowException):
            raise KeyError("unknown id") from None
        if found.null_count:
            raise KeyError("unknown id")
        _, offsets, data = found.buffers()
        ends = np.frombuffer(offsets, dtype="<i4")[[found.offset, found.offset + len(found)]] if len(found) else (0, 0)
        return data[ends[0] : ends[1]].to_pybytes() if data else b""


_codecs: dict[tuple[int, str], Codec] = {}


def _codec(file: bytes, pattern: str) -> Codec:
    """The codec of a worker, made once."""
    key = (hash(file), pattern)
    if key not in _codecs:
        _codecs[key] = Codec(file, pattern)
    return _codecs[key]


def _read(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with a column of the ids of each text instead of the text.

    ``path`` is a rank file on the driver; its lines (one a token) go to the executors as a
    broadcast variable. A null or empty text has no ids. All other columns stay, whatever
    their names; a column that has the name of ``ids`` is replaced.
    """
    ranks = docs.sparkSession.sparkContext.broadcast(_read(path))
    names = [c for c in docs.columns if c not in (text, ids)]
    rows = docs.select(*[F.col(f"`{c}`") for c in names], F.col(f"`{text}`").cast("string").alias(ids))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(ranks.value, pattern)
        for batch in batches:
            for part in A.pieces(batch, ids):
                texts = pc.fill_null(part.column(ids).cast(pa.binary()), b"").to_pylist()
                coded = [codec.encode(t.decode("utf-8", "replace")) for t in texts]
                offsets = np.concatenate([[0], np.cumsum([len(c) // 4 for c in coded])]).astype(np.int32)
                flat = np.frombuffer(b"".join(coded), dtype="<i4")
                yield pa.RecordBatch.from_arrays([*map(part.column, names), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], [*names, ids])

    return rows.mapInArrow(task, rows.schema[:-1].add(ids, ArrayType(IntegerType())))


def decode(rows: DataFrame, path: str, pattern: str, ids: str = "ids", out: str = "bytes") -> DataFrame:
    """``rows`` with the bytes of their ids instead of the ids.

    A null list has no bytes; a list with a null or an id that the file doesn't have gives null.
    """
    ranks = rows.sparkSession.sparkContext.broadcast(_read(path))
    names = [c for c in rows.columns if c not in (ids, out)]
    given = rows.select(*[F.col(f"`{c}`") for c in names], F.col(f"`{ids}`").alias(out))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(ranks.value, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part, made = batch.slice(at, ROWS), []
                for listed in part.column(out):
                    try:
                        made.append(codec.decode(listed.values) if listed.is_valid else b"")
                    except KeyError:
                        made.append(None)
                yield pa.RecordBatch.from_arrays([*map(part.column, names), pa.array(made, pa.binary())], [*names, out])

    return given.mapInArrow(task, given.schema[:-1].add(out, BinaryType()))


def ids_text(ids: str) -> Column:
    """Decimal ids joined by commas."""
    return F.array_join(F.col(ids).cast("array<string>"), ",")


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256, decoded_sha256.

    Null and empty texts have no tokens, and the digests of nothing. Repeated rows and null ids
    are rows like others. Bytes that are no UTF-8 count as U+FFFD. Empty input gives no rows.
    """
    ids = encode(docs.select("doc_id", "text"), path, pattern)
    told = ids.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids_text("ids"), 256).alias("ids_sha256"), "ids")
    back = decode(told, path, pattern)
    return back.select("doc_id", "n_tokens", "ids_sha256", F.sha2("bytes", 256).alias("decoded_sha256"))
