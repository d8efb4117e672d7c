"""Hierarchical empirical Bayes quality classifier.

1. A document classifier, logistic regression on the shape of a text and on the mean
   log-odds of its words, is fitted to at most TRAIN_ROWS labelled documents. Words are told
   by 64-bit hashes; those of fewer than SEEN of the documents they are counted on carry no
   evidence.
2. Its probabilities are summed per host (``source``) and per path (``source`` and
   ``lang``). A host's rate is shrunk toward the global rate, a path's rate toward its host's. How
   many documents a prior is worth is estimated by moments: from the spread of hosts round the
   global rate, and of paths round their own host's. Groups that differ no more than chance
   gives are put on their prior altogether.
3. A document's log-odds move by how far its path's rate is from the global rate. The document
   itself is taken out of its path and of its host first.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farespan.llm import arrays as A
from farespan.llm.common import hot_join, scoped, stage
from farespan.llm.quality import Texts

TRAIN_ROWS = 20_000  # labelled documents used for fitting
SEEN = 3  # documents, of those that words are counted on
WEAKEST, STRONGEST = 1e-3, 1e12  # documents that a prior is worth: next to none, and so many that a group's own don't count


def shapes(t: Texts) -> np.ndarray:
    n = np.maximum(t.get("n_words"), 1)
    return np.stack([
        np.log1p(t.get("n_words")), np.minimum(t.get("n_words") / 50, 1), t.get("word_chars") / n / 10, np.minimum(t.get("n_symbols") / n, 2),
        t.get("n_upper") / np.maximum(t.get("n_upper") + t.get("n_lower"), 1), np.minimum(t.get("n_bangs") / n, 1),
        t.get("n_dup_lines") / np.maximum(t.get("n_lines"), 1), t.get("n_repeat_words") / n, np.ones(len(n)),
    ], axis=1).astype(np.float64)


def word_hashes(t: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word, lower-cased, and the text it is in."""
    flat, offsets = A.raw(t.texts)
    start, end, first = A.words(flat, offsets)
    return A.word_hashes(A.lower(flat), start, end), np.repeat(np.arange(len(offsets) - 1), np.diff(first))


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many good and bad documents each word occurs."""
    for batch in batches:
        for part in A.pieces(batch, "text"):
            word, doc = word_hashes(Texts(part.column("text")))
            label = part.column("quality").to_numpy(zero_copy_only=False).astype(np.int64)
            order = np.lexsort((doc, word))
            word, doc = word[order], doc[order]
            new = np.ones(len(word), dtype=bool)
            new[1:] = (word[1:] != word[:-1]) | (doc[1:] != doc[:-1])
            word, good = word[new], label[doc[new]]
            at = np.flatnonzero(np.r_[True, word[1:] != word[:-1]][: len(word)])
            n = np.diff(np.r_[at, len(word)])
            g = np.add.reduceat(good, at) if len(at) else good
            yield pa.RecordBatch.from_pydict({"word": word[at].astype(np.int64), "good": g, "bad": n - g})


@dataclass(frozen=True)
class Odds:
    """Log-odds of words, by sorted hash; of any other word they are 0."""

    word: np.ndarray
    value: np.ndarray

    def of(self, words: np.ndarray) -> np.ndarray:
        if not len(self.word):
            return np.zeros(len(words))
        at = np.minimum(np.searchsorted(self.word, words), len(self.word) - 1)
        return np.where(self.word[at] == words, self.value[at], 0.0)


def vectors(t: Texts, odds: Odds) -> np.ndarray:
    word, doc = word_hashes(t)
    total = np.bincount(doc, weights=odds.of(word), minlength=len(t.texts))
    return np.concatenate([shapes(t), (total / np.maximum(t.get("n_words"), 1))[:, None]], axis=1)


def _logit(p):
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 25) -> np.ndarray:
    """Newton steps for ridge-penalised logistic regression."""
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hess = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(hess, x.T @ (p - y) + ridge * w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def train(docs: DataFrame, labels: DataFrame) -> tuple[Odds, np.ndarray] | None:
    """(log-odds of words, weights), or None where a class has no labelled document.

    Rows of ``labels`` with a quality of 0 or 1 count, once per doc_id; a document labelled both
    is good. A null doc_id meets no document, and of documents that share a doc_id all are
    taken. The sample is chosen by hash; what it holds of words in SEEN documents reaches the driver.
    """
    chosen = labels.filter("quality in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.max("quality").cast("long").alias("quality"))
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(TRAIN_ROWS).withColumn("_fold", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(2)))
    rows = stage(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id"), "bayes-train")
    sizes = {r[0]: r[1] for r in rows.groupBy("quality").count().collect()}
    if len(sizes) < 2:
        return None
    words = rows.filter("_fold = 0").select("text", "quality").mapInArrow(_word_counts, "word long, good long, bad long")
    words = words.groupBy("word").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad")).filter(F.col("good") + F.col("bad") >= SEEN).toPandas()
    half = {y: max(1, n / 2) for y, n in sizes.items()}
    value = np.log((words["good"].to_numpy(np.float64) + 1) / (half[1] + 2)) - np.log((words["bad"].to_numpy(np.float64) + 1) / (half[0] + 2))
    key = words["word"].to_numpy(np.int64).astype(A.U)
    order = np.argsort(key)
    odds = Odds(key[order], value[order])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in A.pieces(batch, "text"):
                x = vectors(Texts(part.column("text")), odds)
                yield pa.RecordBatch.from_pydict({"x": [r.tolist() for r in x], "y": part.column("quality")})

    # Words are counted on one half of the sample and weighed on the other. Rows come in any
    # order; sorted, they give the same weights in every run.
    got = rows.filter("_fold = 1").select("text", "quality").mapInArrow(run, "x array<double>, y long").toPandas()
    if got["y"].nunique() < 2:
        return None
    table = np.column_stack([np.array(got["x"].tolist()), got["y"].to_numpy(np.float64)])
    table = table[np.lexsort(table.T)]
    return odds, fit_logistic(table[:, :-1], table[:, -1])


def _strength(groups: DataFrame, prior: Column, rate: float) -> float:
    """Documents that the prior is worth: by moments, from the spread of the groups' rates p / n
    round ``prior``, less what chance gives."""
    apart = F.col("n") * F.pow(F.col("p") / F.col("n") - prior, 2)
    spread, n, k = groups.filter("n >= 2").agg(F.sum(apart), F.sum("n"), F.count("*")).first()
    if not k or not n:
        return STRONGEST
    within = rate * (1 - rate)
    between = spread / n - within * k / n
    return float(np.clip(within / between - 1, WEAKEST, STRONGEST)) if between > 1e-12 else STRONGEST


def _logit_col(p: Column) -> Column:
    p = F.greatest(F.least(p, F.lit(1 - 1e-6)), F.lit(1e-6))
    return F.log(p / (1 - p))


@scoped
def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, p_text, host_rate, path_rate, p_good, kept.

    The two rates are those of the host and path without the document. Null and empty texts are
    scored by their shape. A null source or language is a group of its own; repeated rows and
    null ids are documents like others. Where labels lack a class, p_text is 0.5 for all,
    and all are kept; ties of p_good with 0.5 are kept. Only doc_id, text, source and lang
    are read. Empty input gives no rows.
    """
    fitted = train(docs, labels)
    key = F.to_json(F.struct("source"))
    path = F.to_json(F.struct("source", "lang"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", key.alias("_host"), path.alias("_path"))
    if fitted is None:
        scored = rows.select("doc_id", "_host", "_path", F.lit(0.5).alias("p_text"))
    else:
        odds, weights = fitted
        model = docs.sparkSession.sparkContext.broadcast((odds.word, odds.value, weights))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            word, value, w = model.value
            for batch in batches:
                for part in A.pieces(batch, "text"):
                    p = 1 / (1 + np.exp(-np.clip(vectors(Texts(part.column("text")), Odds(word, value)) @ w, -30, 30)))
                    yield pa.RecordBatch.from_arrays([part.column(c) for c in ("doc_id", "_host", "_path")] + [pa.array(p)], ["doc_id", "_host", "_path", "p_text"])

        scored = rows.mapInArrow(run, "doc_id long, _host string, _path string, p_text double")
    scored = stage(scored, "bayes-scored")
    paths = stage(scored.groupBy("_path").agg(F.first("_host").alias("_host"), F.sum("p_text").alias("p"), F.count("*").alias("n")), "bayes-paths")
    hosts = stage(paths.groupBy("_host").agg(F.sum("p").alias("_hp"), F.sum("n").alias("_hn")), "bayes-hosts")
    p, n = hosts.agg(F.sum("_hp"), F.sum("_hn")).first()
    rate = float(p / n) if n else 0.5
    groups = stage(hot_join(paths, hosts, "_host", "_hn", int(n or 0)), "bayes-groups")
    of_hosts = _strength(hosts.select(F.col("_hp").alias("p"), F.col("_hn").alias("n")), F.lit(rate), rate)
    of_paths = _strength(groups, F.col("_hp") / F.col("_hn"), rate)
    own = hot_join(scored.drop("_host"), groups.select("_path", F.col("p").alias("_p"), F.col("n").alias("_n"), "_hp", "_hn"), "_path", "_n", int(n or 0))
    own = own.withColumn("host_rate", (F.col("_hp") - F.col("p_text") + of_hosts * rate) / (F.col("_hn") - 1 + of_hosts))
    own = own.withColumn("path_rate", (F.col("_p") - F.col("p_text") + of_paths * F.col("host_rate")) / (F.col("_n") - 1 + of_paths))
    odds = _logit_col(F.col("p_text")) + _logit_col(F.col("path_rate")) - _logit_col(F.lit(rate))
    good = 1 / (1 + F.exp(-odds))
    return own.select("doc_id", "p_text", "host_rate", "path_rate", good.alias("p_good"), (good >= 0.5 - 1e-9).alias("kept"))
