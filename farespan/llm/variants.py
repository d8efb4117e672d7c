"""Spelling variants: words one edit apart, grouped by sorted-list dynamic programming.

Words that differ by one inserted, deleted or replaced code point agree everywhere but in one
part of the shorter one. So the vocabulary falls into blocks of words that agree outside a
part, for each part, and each pair of near words meets in a block. A block is a sorted list.
For each of its words a band of three cells of the edit matrix runs down the list: a row
belongs to a prefix, so the next word takes over the rows of the prefix it shares with the
last one, and once a row has no cell under two edits, the whole range that shares its prefix is
skipped.

A block of more than BLOCK words is dealt out anew by halves of its part until it is small or
its part is one code point; no word is dropped, and a block of one code point has no more
words than the alphabet has letters and pairs of letters.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farespan.llm import arrays as A
from farespan.llm.common import drop_staged, scoped, stage

LEAST = 5  # code points of a word
OFTEN = 3  # occurrences of a word
DROP = 97  # one run in so many loses a code point
TIMES = 2  # a form is at least so many times as frequent
PARTS = 3  # parts at first
BLOCK = 2000  # words of a block that is scanned as it is
HELD = 200_000  # words counted by a task, or rows found, before it hands them on
READ = 256 << 20  # bytes of text after which it does so at the latest
RUN = re.compile(rb"(?:[A-Za-z]|\xc3[\x80-\xbf])+")  # A-Z, a-z and U+00C0 to U+00FF, as UTF-8
FAR = 9  # a cell outside the matrix
FIRST, SAME, LAST, ALONE = (FAR, 0, 1), (1, 0, 1), (1, 0, FAR), (FAR, 0, FAR)  # rows of a word against itself


# ---------------------------------------------------------------- words

def _misspelt(run: bytes, h: int) -> bytes:
    """The run without code point ``h % length``."""
    text = run.decode()
    at = h % len(text)
    return (text[:at] + text[at + 1 :]).encode()


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, n) of the runs of each task, counted ahead of the shuffle."""
    seen: Counter[bytes] = Counter()
    read = 0

    def told() -> pa.RecordBatch:
        words = pa.array([w.decode() for w in seen], pa.string())
        return pa.RecordBatch.from_arrays([words, pa.array(list(seen.values()), pa.int64())], ["word", "n"])

    for batch in batches:
        for part in A.pieces(batch, "text"):
            texts = pc.fill_null(part.column("text").cast(pa.binary()), b"").to_pylist()
            read += sum(map(len, texts))
            for key, text in zip(part.column("key").to_pylist(), texts):
                prefix = zlib.crc32(key.encode())
                for run in RUN.findall(text.lower()):
                    if len(run) < LEAST:
                        continue
                    h = zlib.crc32(run, prefix)
                    if not h % DROP:
                        run = _misspelt(run, h)
                    if len(run) - run.count(0xC3) >= LEAST:
                        seen[run] += 1
            if len(seen) > HELD or read > READ:
                yield told()
                seen.clear()
                read = 0
    yield told()


def vocabulary(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """word, n of the words of LEAST code points or more that occur OFTEN or more."""
    key = F.concat(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.lit(":"))
    runs = docs.select(key.alias("key"), F.col(text).alias("text")).mapInArrow(_counts, "word string, n long")
    return runs.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= OFTEN)


# ---------------------------------------------------------------- blocks

def _dealt(rows: DataFrame) -> DataFrame:
    """Rows of (word, n, size, parts, part) with the block each falls into.

    A word stands as the shorter one of a pair (``size`` is its length) or as the longer one
    (``size`` is one less). The key holds all that is outside the part.
    """
    low, high = F.expr("size * part div parts"), F.expr("size * (part + 1) div parts")
    rows = rows.withColumns({"_low": low, "_tail": F.col("size") - high})
    head = F.expr("substring(word, 1, int(_low))")
    tail = F.when(F.col("_tail") > 0, F.expr("right(word, int(_tail))")).otherwise("")
    return rows.withColumn("block", F.xxhash64("size", "parts", "part", head, F.lit("\0"), tail)).drop("_low", "_tail")


def _narrower(rows: DataFrame) -> DataFrame:
    """The rows of blocks that are too large, dealt out by the halves of their part."""
    half = F.explode(F.array(F.col("part") * 2, F.col("part") * 2 + 1)).alias("part")
    return _dealt(rows.select("word", "n", "size", (F.col("parts") * 2).alias("parts"), half))


def blocks(words: DataFrame) -> list[DataFrame]:
    """The vocabulary in blocks of BLOCK words at most, or with a part of one code point."""
    length = F.char_length("word").cast("long")
    sizes = F.explode(F.array(length, length - 1)).alias("size")
    parts = words.select("word", "n", sizes).filter(F.col("size") >= LEAST).withColumn("parts", F.lit(PARTS).cast("long"))
    now = _dealt(parts.withColumn("part", F.explode(F.array(*[F.lit(k).cast("long") for k in range(PARTS)]))))
    out = []
    while True:
        now = stage(now, "variant-blocks")
        large = now.groupBy("block").agg(F.count("*").alias("_n"), F.min(F.col("parts") < F.col("size")).alias("_wide")).filter(f"_n > {BLOCK} and _wide")
        large = stage(large.select("block"), "variant-large")
        out.append(now.join(large, "block", "left_anti"))
        if large.isEmpty():
            return out
        now = _narrower(now.join(large, "block", "left_semi"))


# ---------------------------------------------------------------- one block

def _shared(a: str, b: str) -> int:
    """Length of the longest common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n
    while high - low > 1:
        mid = (low + high) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid
    return low


def near_pairs(words: list[str]) -> Iterator[tuple[int, int]]:
    """Places (i, j), i < j, of words one edit apart in a sorted list of distinct words.

    Row d of a word's matrix belongs to d code points of the listed word. It keeps the cells of
    d - 1, d and d + 1 code points of the word that is looked for: all others are two edits
    off or more.
    """
    m = len(words)
    common = [0] + [_shared(words[j - 1], words[j]) for j in range(1, m)]
    for i in range(m - 1):
        sought = words[i]
        n = len(sought)
        # Against itself a word's rows have no edit on the diagonal; the next word takes over
        # those of the prefix the two share.
        rows = [FIRST, *[SAME] * (n - 1), LAST] if n else [ALONE]
        j, limit = i + 1, common[i + 1]  # rows[: limit + 1] hold for words[j]
        while j < m:
            word = words[j]
            end, d = len(word), limit if limit < len(rows) else len(rows) - 1
            del rows[d + 1 :]
            a, b, c = rows[d]
            while d < end:
                ch = word[d]
                if 0 < d and d + 1 < n:
                    a = a if sought[d - 1] == ch else a + 1
                    if b < a:
                        a = b + 1
                    b = b if sought[d] == ch else b + 1
                    if c < b:
                        b = c + 1
                    if a < b:
                        b = a + 1
                    c = c if sought[d + 1] == ch else c + 1
                    if b < c:
                        c = b + 1
                else:  # at the rim some cells lie outside the matrix
                    a2 = FAR if d > n else min(b + 1, a + (sought[d - 1] != ch)) if d else b + 1
                    b2 = min(c + 1, a2 + 1, b + (sought[d] != ch)) if d < n else FAR
                    c = min(b2 + 1, c + (sought[d + 1] != ch)) if d + 1 < n else FAR
                    a, b = a2, b2
                d += 1
                rows.append((a, b, c))
                if a > 1 and b > 1 and c > 1:
                    break
            if d == end and -1 <= n - end <= 1 and (a, b, c)[n - end + 1] == 1:
                yield i, j
            # Words that share the d code points of a row without hope go by together.
            past = a > 1 and b > 1 and c > 1
            j += 1
            limit = common[j] if j < m else 0
            while past and limit >= d:
                j += 1
                limit = min(limit, common[j]) if j < m else 0


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near words of each block; the rows of a block follow one another, sorted by word."""
    columns = ("word", "n", "near", "near_n")
    types = (pa.string(), pa.int64(), pa.string(), pa.int64())
    block, words, counts = None, [], []
    found: list[tuple] = []

    def search() -> None:
        for i, j in near_pairs(words) if len(words) > 1 else ():
            found.append((words[i], counts[i], words[j], counts[j]))
            found.append((words[j], counts[j], words[i], counts[i]))

    def told() -> pa.RecordBatch:
        values = list(zip(*found)) or [(), (), (), ()]
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, types)], list(columns))

    for batch in batches:
        for key, word, n in zip(*(batch.column(c).to_pylist() for c in ("block", "word", "n"))):
            if key != block:
                search()
                block, words, counts = key, [], []
            if not words or words[-1] != word:  # blocks of one hash may hold a word twice
                words.append(word)
                counts.append(n)
        if len(found) > HELD:
            yield told()
            found.clear()
    search()
    yield told()


def near_words(words: DataFrame) -> DataFrame:
    """word, n, near, near_n of the words one edit apart, each pair in both orders."""
    pairs = None
    for dealt in blocks(words):
        rows = dealt.select("block", "word", "n").repartition("block").sortWithinPartitions("block", "word")
        found = rows.mapInArrow(_scan, "word string, n long, near string, near_n long")
        pairs = found if pairs is None else pairs.unionAll(found)
    return pairs.distinct()


# ---------------------------------------------------------------- groups

def roots(forms: DataFrame) -> DataFrame:
    """word, root: the last word reached by following ``forms`` (word, form).

    Each round doubles the steps taken. A form is TIMES as frequent as its word, so a chain
    has as many steps as the largest count has doublings, at most.
    """
    now = stage(forms.select("word", F.col("form").alias("root")), "variant-roots")
    while True:
        further = now.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        then = stage(now.join(further, "root", "left").select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")), "variant-roots")
        drop_staged(now)
        now = then.select("word", "root")
        if then.filter("_moved").isEmpty():
            return now


@scoped
def group(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n.

    Null texts have no words; a null doc_id counts as an empty one in the hash. Repeated rows
    count as often as they stand there. Of near words of one count the least in code-point
    order is the form. A run of any length is a word, and other columns, whatever their names,
    are not read. Empty input gives no rows.
    """
    words = stage(vocabulary(docs, text, doc_id), "variant-words")
    near = near_words(words).groupBy("word", "n").agg(
        F.count("*").alias("n_near"), F.max("near_n").alias("form_n"), F.min(F.struct(-F.col("near_n"), "near")).getField("near").alias("form")
    )
    near = stage(near.withColumn("_has", F.col("form_n") >= TIMES * F.col("n")), "variant-near")
    ends = roots(near.filter("_has"))
    out = words.join(near.drop("n"), "word", "left").join(ends, "word", "left")
    return out.select(
        "word", F.when(F.col("_has"), F.col("form")).alias("form"), F.coalesce("root", "word").alias("root"),
        "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(F.col("_has"), F.col("form_n")).alias("form_n"),
    )
