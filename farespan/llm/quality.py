"""Quality rules as a short-circuit cascade.

A document is kept if no rule rejects it. Rules read measures of a text, and a measure that several
rules read is taken once. On a sample picked by hash every measure is timed, and each row's
rejections are noted together, so that the rejections of a rule are known given the rules
before it. The cascade takes as its next rule the one with most rejections, among the rows still
alive, for the time of the measures not yet taken; a rule runs only on the rows that those
before it have let through. The order changes the cost alone: the verdict is the same in any
order.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farespan.llm import arrays as A

SAMPLE_ROWS = 2000  # rows, about, on which the rules are timed
ROUND = 1_000_003  # rows are picked by hash modulo this
CHECK = 2e-8  # seconds a row that a rule takes beside its measures

SYMBOL = np.zeros(256, dtype=bool)
SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
UPPER = np.zeros(256, dtype=bool)
UPPER[65:91] = True
LOWER = np.zeros(256, dtype=bool)
LOWER[97:123] = True
BANG = np.zeros(256, dtype=bool)
BANG[ord("!")] = True
HEAD = (np.arange(256) & 0xC0) != 0x80  # first byte of a code point
LETTER = UPPER | LOWER
LETTER[0x80:] = True  # bytes of all code points beyond ASCII
BULLET = np.zeros(256, dtype=bool)
BULLET[[ord(c) for c in "-*+"]] = True

METRICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass
class Texts:
    """Some texts; what a rule asks for is computed once."""

    texts: pa.Array
    _got: dict = field(default_factory=dict)

    def get(self, name: str) -> np.ndarray:
        if name not in self._got:
            self._got[name] = getattr(self, f"_{name}")()
        return self._got[name]

    def take(self, mask: np.ndarray) -> Texts:
        """The rows of the mask, with the per-row values already known."""
        if mask.all():
            return self
        known = {k: v[mask] for k, v in self._got.items() if not k.startswith("_")}
        return Texts(self.texts.filter(pa.array(mask)), known)

    def _count(self, of: np.ndarray) -> np.ndarray:
        flat, offsets = self.raw
        total = np.zeros(len(flat) + 1, dtype=np.int64)
        np.cumsum(of[flat], out=total[1:])
        return total[offsets[1:]] - total[offsets[:-1]]

    @property
    def raw(self):
        if "_raw" not in self._got:
            self._got["_raw"] = A.raw(self.texts)
        return self._got["_raw"]

    @property
    def words(self):
        if "_words" not in self._got:
            self._got["_words"] = A.words(*self.raw)
        return self._got["_words"]

    def _n_words(self):
        return np.diff(self.words[2])

    def _word_chars(self):
        return self._count(HEAD & ~A.SPACE)

    def _n_symbols(self):
        return self._count(SYMBOL)

    def _n_upper(self):
        return self._count(UPPER)

    def _n_lower(self):
        return self._count(LOWER)

    def _n_bangs(self):
        return self._count(BANG)

    @property
    def lines(self):
        """First byte and end of every line with a word, and the text it is in."""
        if "_lines" not in self._got:
            flat, offsets = self.raw
            full = offsets[1:] > offsets[:-1]
            breaks = np.flatnonzero(flat == 10)
            start = np.sort(np.concatenate([offsets[:-1][full], breaks + 1]))
            start = start[start < len(flat)] if len(flat) else start[:0]
            start = np.unique(start)
            end = np.minimum(
                np.append(breaks, len(flat))[np.searchsorted(breaks, start)],
                offsets[np.searchsorted(offsets, start, "right")] if len(start) else start,
            )
            inked = np.concatenate([[0], np.cumsum(~A.SPACE[flat])])
            worded = inked[end] > inked[start]
            start, end = start[worded], end[worded]
            self._got["_lines"] = start, end, np.searchsorted(offsets, start, "right") - 1
        return self._got["_lines"]

    def _n_lines(self):
        return np.bincount(self.lines[2], minlength=len(self.texts))

    def _n_dup_lines(self):
        flat, _ = self.raw
        start, end, doc = self.lines
        key = A.mix(A.word_hashes(flat, start, end) ^ A.mix(doc.astype(A.U) + A.U(1)))
        order = np.argsort(key, kind="stable")
        again = order[1:][key[order][1:] == key[order][:-1]]
        return np.bincount(doc[again], minlength=len(self.texts))

    def _n_bullets(self):
        """Lines whose first character is a bullet, blanks before it aside."""
        flat, _ = self.raw
        start, end, doc = self.lines
        inked = np.flatnonzero(~A.SPACE[flat])
        first = inked[np.searchsorted(inked, start)] if len(start) else start
        lead = BULLET[flat[first]] if len(first) else np.zeros(0, bool)
        if len(first):  # U+2022 is three bytes
            wide = np.minimum(first + 2, len(flat) - 1)
            lead |= (flat[first] == 0xE2) & (flat[np.minimum(first + 1, len(flat) - 1)] == 0x80) & (flat[wide] == 0xA2)
        return np.bincount(doc[lead], minlength=len(self.texts))

    def _n_cut_lines(self):
        """Lines that end in three dots or an ellipsis, blanks after it aside."""
        flat, _ = self.raw
        start, end, doc = self.lines
        inked = np.flatnonzero(~A.SPACE[flat])
        last = inked[np.searchsorted(inked, end) - 1] if len(end) else end
        if not len(last):
            return np.zeros(len(self.texts), np.int64)
        x, y, z = (flat[np.maximum(last - k, 0)] for k in (2, 1, 0))
        cut = ((x == 46) & (y == 46) & (z == 46)) | ((x == 0xE2) & (y == 0x80) & (z == 0xA6))
        return np.bincount(doc[cut & (last - 2 >= start)], minlength=len(self.texts))

    def _n_plain_words(self):
        """Words with a letter, or with a character beyond ASCII."""
        flat, _ = self.raw
        start, end, first = self.words
        letters = np.concatenate([[0], np.cumsum(LETTER[flat])])
        doc = np.repeat(np.arange(len(self.texts)), np.diff(first))
        return np.bincount(doc[letters[end] > letters[start]], minlength=len(self.texts))

    def _n_top_words(self):
        """Words in occurrences of the text's most frequent two-word run."""
        flat, _ = self.raw
        start, end, first = self.words
        pairs = A.shingles(A.word_hashes(flat, start, end), 2)
        out = np.zeros(len(self.texts), dtype=np.int64)
        if not len(pairs):
            return out
        doc = np.repeat(np.arange(len(out)), np.diff(first))
        at = np.flatnonzero(doc[:-1] == doc[1:])
        key = A.mix(pairs[at] ^ A.mix(doc[at].astype(A.U) + A.U(1)))
        order = np.argsort(key, kind="stable")
        edge = np.flatnonzero(np.r_[True, key[order][1:] != key[order][:-1]]) if len(order) else order
        n = np.diff(np.r_[edge, len(order)])
        np.maximum.at(out, doc[at[order[edge]]], np.where(n > 1, 2 * n, 0))
        return out

    def _n_repeat_words(self, k: int = 3):
        flat, _ = self.raw
        start, end, first = self.words
        grams = A.shingles(A.word_hashes(flat, start, end), k)
        out = np.zeros(len(self.texts), dtype=np.int64)
        if not len(grams):
            return out
        doc = np.repeat(np.arange(len(out)), np.diff(first))[: len(start)]
        whole = doc[: len(grams)] == doc[k - 1 :]
        at = np.flatnonzero(whole)
        key = A.mix(grams[at] ^ A.mix(doc[at].astype(A.U) + A.U(1)))
        order = np.argsort(key, kind="stable")
        same = key[order][1:] == key[order][:-1]
        twice = np.zeros(len(at), dtype=bool)
        twice[order[1:]] |= same
        twice[order[:-1]] |= same
        covered = np.zeros(len(start), dtype=bool)
        hit = at[twice]
        for j in range(k):
            covered[hit + j] = True
        return np.bincount(doc[covered], minlength=len(out))


@dataclass(frozen=True)
class Rule:
    name: str
    needs: tuple[str, ...]
    rejects: Callable[[Texts], np.ndarray]


def base_failed(t: Texts) -> np.ndarray:
    return (t.get("n_words") < 50) | (100 * t.get("n_repeat_words") > 50 * t.get("n_words"))


#: Thresholds are whole-number comparisons.
RULES = (
    Rule("few_words", ("n_words",), lambda t: t.get("n_words") < 50),
    Rule("symbols", ("n_symbols", "n_words"), lambda t: 10 * t.get("n_symbols") > 3 * t.get("n_words")),
    Rule("shouting", ("n_upper", "n_lower"), lambda t: t.get("n_upper") > t.get("n_lower")),
    Rule("exclamations", ("n_bangs", "n_words"), lambda t: 4 * t.get("n_bangs") > t.get("n_words")),
    Rule("word_length", ("word_chars", "n_words"), lambda t: (t.get("word_chars") > 16 * t.get("n_words")) | (t.get("word_chars") < 2 * t.get("n_words"))),
    Rule("repeated_lines", ("n_dup_lines", "n_lines"), lambda t: 10 * t.get("n_dup_lines") > 3 * t.get("n_lines")),
    Rule("repeated_words", ("n_repeat_words", "n_words"), lambda t: 100 * t.get("n_repeat_words") > 50 * t.get("n_words")),
    Rule("plain_words", ("n_plain_words", "n_words"), lambda t: 10 * t.get("n_plain_words") < 6 * t.get("n_words")),
    Rule("bullets", ("n_bullets", "n_lines"), lambda t: (t.get("n_lines") > 2) & (10 * t.get("n_bullets") > 9 * t.get("n_lines"))),
    Rule("cut_lines", ("n_cut_lines", "n_lines"), lambda t: (t.get("n_lines") > 2) & (10 * t.get("n_cut_lines") > 3 * t.get("n_lines"))),
    Rule("top_run", ("n_top_words", "n_words"), lambda t: 10 * t.get("n_top_words") > 3 * t.get("n_words")),
)


def kept(t: Texts, order: list[int], rules: tuple[Rule, ...] = RULES) -> np.ndarray:
    """Indices of the rows that no rule rejects; each rule runs on what is left."""
    alive = np.arange(len(t.texts))
    for i in order:
        if not len(alive):
            break
        ok = ~rules[i].rejects(t)
        alive, t = alive[ok], t.take(ok)
    return alive


def _measured(rules: tuple[Rule, ...]):
    """Task: seconds by measure, in rows of ``measure``; rows by their rejections, in rows of ``mask``."""
    names = sorted({m for r in rules for m in r.needs})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spent, masks = dict.fromkeys(names, 0.0), {}
        for batch in batches:
            for part in A.pieces(batch, "text"):
                t = Texts(part.column("text"))
                _ = t.raw, t.words  # all measures start from these
                for m in names:
                    began = time.perf_counter()
                    t.get(m)
                    spent[m] += time.perf_counter() - began
                mask = sum(r.rejects(t).astype(np.int64) << i for i, r in enumerate(rules))
                for value, n in zip(*np.unique(mask, return_counts=True)):
                    masks[int(value)] = masks.get(int(value), 0) + int(n)
        yield pa.RecordBatch.from_pydict({
            "measure": pa.array([*names, *[None] * len(masks)], pa.string()), "mask": pa.array([*[None] * len(names), *masks], pa.int64()),
            "amount": pa.array([*spent.values(), *map(float, masks.values())], pa.float64()),
        })

    return run


def arrange(rules: tuple[Rule, ...], cost: dict[str, float], masks: dict[int, float], paid: tuple[str, ...] = ()) -> list[int]:
    """Order of the rules: most rejections of rows still alive for the time still to pay.

    ``cost``: seconds of a measure over the sample; ``masks``: sample rows by the set of rules
    that reject them; ``paid``: measures that are taken in any case.
    """
    total = sum(masks.values())
    left, order, alive, paid = list(range(len(rules))), [], dict(masks), set(paid)

    def worth(i: int) -> tuple[float, int]:
        hit = sum(n for m, n in alive.items() if m >> i & 1)
        price = CHECK * total + sum(cost.get(m, 0.0) for m in rules[i].needs if m not in paid)
        return hit / max(price, 1e-12), -i

    while left:
        i = max(left, key=worth)
        left.remove(i)
        order.append(i)
        paid |= set(rules[i].needs)
        alive = {m: n for m, n in alive.items() if not m >> i & 1}
    return order


def order_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES, paid: tuple[str, ...] = ()) -> list[int]:
    """The cascade's order, from a sample of about SAMPLE_ROWS rows picked by the hash of their
    text; an empty sample leaves the rules as they are. Few rows, one for each measure and set of
    rejections and task, reach the driver."""
    share = SAMPLE_ROWS / max(docs.count(), 1)
    some = docs.select("text")
    if share < 1:
        some = some.filter(F.pmod(F.xxhash64("text"), F.lit(ROUND)) < int(share * ROUND))
    got = some.mapInArrow(_measured(rules), "measure string, mask long, amount double").groupBy("measure", "mask").agg(F.sum("amount").alias("amount")).collect()
    return arrange(rules, {r.measure: r.amount for r in got if r.measure}, {r.mask: r.amount for r in got if r.mask is not None}, paid)


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per document: doc_id, the five counts, base_failed, kept.

    A missing or empty text has no words and fails the base test. The counts are reported
    for every row, so rules on them cost nothing more and come first; the other rules run only as
    far as the cascade goes. Repeated rows and null ids are rows like others; a very long text
    is judged whole. Only ``doc_id`` and ``text`` are read, whatever the other columns' names.
    """
    order = order_rules(docs, rules, METRICS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in A.pieces(batch, "text"):
                t = Texts(part.column("text"))
                counts = {m: t.get(m).astype(np.int64) for m in METRICS}
                failed = base_failed(t)
                keep = np.zeros(part.num_rows, dtype=bool)
                keep[np.flatnonzero(~failed)[kept(t.take(~failed), order, rules)]] = True
                yield pa.RecordBatch.from_pydict({"doc_id": part.column("doc_id"), **counts, "base_failed": failed, "kept": keep})

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(
        run, "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean"
    )


def filter_docs(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The documents that no rule rejects, with all their columns; nulls and empty texts go."""
    order = order_rules(docs, rules)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in A.pieces(batch, "text"):
                keep = np.zeros(part.num_rows, dtype=bool)
                keep[kept(Texts(part.column("text")), order, rules)] = True
                yield part.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)
