"""Hierarchical shrinkage against a computation in numpy, and the classifier on held-out labels."""

from collections import defaultdict

import numpy as np
import pytest

from farespan.llm import bayes
from tests.llm.conftest import SCHEMA, prose

LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture(scope="module")
def table(spark):
    rows, labels = [], []
    for i in range(240):
        bad = (i * 7) % 10 < (6 if i % 6 == 0 else 2)
        text = " ".join(w + "###" for w in prose(i, 60 + i % 9).split()) if bad else prose(i, 60 + i % 9)
        rows.append((i, text, ("en", "de")[i % 5 == 0], f"s{i % 6}", 1))
        if i % 3:
            labels.append((i, int(not bad), 0))
    rows += [(None, prose(3, 60), None, None, 1), (500, None, "en", "s0", 1), (501, "", "en", "alone", 1), (502, prose(9, 70), "en", "s1", 1), (502, prose(9, 70), "en", "s1", 1)]
    labels += [(None, 1, 0), (7, None, 0), (8, 5, 0), (1, 1, 1)]
    return rows, labels, [r.asDict() for r in bayes.classify(spark.createDataFrame(rows, SCHEMA).repartition(5), spark.createDataFrame(labels, LABELS)).collect()]


def moments(groups, rate):
    """groups: (p, n, prior)"""
    some = [g for g in groups if g[1] >= 2]
    total = sum(n for _, n, _ in some)
    within = rate * (1 - rate)
    between = sum(n * (p / n - prior) ** 2 for p, n, prior in some) / total - within * len(some) / total
    return min(max(within / between - 1, bayes.WEAKEST), bayes.STRONGEST) if between > 1e-12 else bayes.STRONGEST


def logit(p):
    p = min(max(p, 1e-6), 1 - 1e-6)
    return np.log(p / (1 - p))


def test_rates_are_those_of_numpy(table):
    rows, _, out = table
    # p_text per (doc_id, text) row; rows of one doc_id repeat here with the same text.
    score = {r["doc_id"]: r["p_text"] for r in out}
    paths, hosts = defaultdict(list), defaultdict(list)
    for d, _, lang, source, _ in rows:
        paths[source, lang].append(score[d])
        hosts[source].append(score[d])
    every = [score[r[0]] for r in rows]
    rate = float(np.mean(every))
    a = moments([(sum(v), len(v), rate) for v in hosts.values()], rate)
    b = moments([(sum(v), len(v), np.mean(hosts[k[0]])) for k, v in paths.items()], rate)
    assert len(out) == len(rows)
    where = {r[0]: (r[3], r[2]) for r in rows}
    for r in out:
        source, lang = where[r["doc_id"]]
        p = r["p_text"]
        host = (sum(hosts[source]) - p + a * rate) / (len(hosts[source]) - 1 + a)
        path = (sum(paths[source, lang]) - p + b * host) / (len(paths[source, lang]) - 1 + b)
        good = 1 / (1 + np.exp(-(logit(p) + logit(path) - logit(rate))))
        assert abs(r["host_rate"] - host) < 1e-6 and abs(r["path_rate"] - path) < 1e-6 and abs(r["p_good"] - good) < 1e-6
        assert r["kept"] == (good >= 0.5 - 1e-9) or abs(good - 0.5) < 1e-6


def test_held_out_labels(table):
    rows, labels, out = table
    taught = {d for d, *_ in labels}
    bad = {r[0] for r in rows if r[1] and "###" in r[1]}
    held = [r for r in out if r["doc_id"] is not None and r["doc_id"] < 240 and r["doc_id"] not in taught]
    assert np.mean([r["kept"] == (r["doc_id"] not in bad) for r in held]) > 0.95


def test_words_are_told_apart_by_their_whole_hash():
    words = np.arange(1, 200_001, dtype=np.uint64) * np.uint64(1 << 16)  # equal in their last 16 bits
    odds = bayes.Odds(words, np.arange(200_000, dtype=float))
    assert (odds.of(words) == np.arange(200_000)).all() and (odds.of(words + np.uint64(1)) == 0).all()


def test_no_spread_puts_groups_on_their_prior(spark):
    even = spark.createDataFrame([(5.0, 10), (5.0, 10)], "p double, n long")
    from pyspark.sql import functions as F

    assert bayes._strength(even, F.lit(0.5), 0.5) == bayes.STRONGEST
    apart = spark.createDataFrame([(0.0, 1000), (1000.0, 1000)], "p double, n long")
    assert bayes._strength(apart, F.lit(0.5), 0.5) < 1


def test_empty_tables(spark):
    docs, labels = spark.createDataFrame([], SCHEMA), spark.createDataFrame([], LABELS)
    assert bayes.classify(docs, labels).collect() == []
    some = spark.createDataFrame([(1, "a", "en", "s", 1)], SCHEMA)
    assert [(r.p_text, r.kept) for r in bayes.classify(some, labels).collect()] == [(0.5, True)]
