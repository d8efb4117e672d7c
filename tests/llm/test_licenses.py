"""License scan: planted notices, and the template comparison against brute force."""

import random
import re

import pytest
from pyspark.sql import functions as F

from farespan.llm import licenses
from farespan.llm.license_texts import TEMPLATES
from tests.llm.conftest import SCHEMA, prose


def words(text):
    return [w for w in re.split(r"[^\w.]+|_", text.lower()) if w.replace(".", "")]


def grams(w, n):
    return [" ".join(w[i : i + n]) for i in range(len(w) - n + 1)]


def parts(w):
    return set(grams(w, 3)) if len(w) >= 3 else {" ".join(w)}


def brute_similarity(w, family):
    templates = [parts(words(t)) for t in TEMPLATES[family]]
    own, short = parts(w), parts(w) | set(grams(w, 2)) | set(w)
    held = max(len(t & short) / len(t) for t in templates)
    return max(len(own & set().union(*templates)) / len(own), held if held >= licenses.CONTAINED else 0)


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "en", "a", 1) for i, t in enumerate(texts)], SCHEMA)


def wrapped(text, n):
    w = text.split()
    return "\n".join(" ".join(w[i : i + n]) for i in range(0, len(w), n))


def confirmed(out):
    return {(r.doc_id, r.paragraph, r.family) for r in out if r.confirmed}


def test_similarity_is_that_of_brute_force(spark):
    rnd = random.Random(1)
    texts = []
    for family in TEMPLATES:
        for t in TEMPLATES[family][:3]:
            w = words(t)
            cut = rnd.randrange(len(w))
            texts += [w, w[cut:] or w, prose(cut, 20).split() + w, w[: cut + 1] + ["or", "so"] + w[cut + 1 :]]
    rows = [(k, f, w) for k, w in enumerate(texts) for f in range(len(licenses.FAMILIES))]
    df = spark.createDataFrame(rows, "k int, family int, words array<string>")
    out = licenses.matches(df, licenses._templates(spark)).select("k", "family", "similarity").collect()
    assert len(out) == len(rows)
    for r in out:
        assert abs(r.similarity - brute_similarity(texts[r.k], licenses.FAMILIES[r.family])) < 1e-12


@pytest.fixture(scope="module")
def planted(spark):
    """Every template once: alone, inside prose, wrapped, and as a paragraph of its own."""
    texts, want = [prose(i, 80) for i in range(60)], {}
    for family, templates in TEMPLATES.items():
        for k, t in enumerate(templates):
            shape = [t, prose(k, 70) + "\n" + t + "\n" + prose(k + 1, 90), wrapped(t, 9), prose(k, 20) + "\n \n" + wrapped(t, 11)][k % 4]
            want[len(texts)] = family
            texts.append(shape)
    texts += ["he has a license to drive the old red tractor home", "the apache helicopter flew over the general public", "no claim of liability in this contract of permission", prose(7, 300)]
    return want, licenses.scan(frame(spark, texts)).collect()


def test_recall_and_precision_on_planted_notices(planted):
    want, out = planted
    got = confirmed(out)
    found = sum(bool({(d, 0, f), (d, 1, f)} & got) for d, f in want.items())
    # Some notices are word for word those of several families.
    wrong = [(d, f) for d, _, f in got if want.get(d) != f and not set(TEMPLATES[f]) & {TEMPLATES[want[d]][d - min(k for k, v in want.items() if v == want[d])]}]
    assert found >= 0.97 * len(want), [(d, f) for d, f in want.items() if not {(d, 0, f), (d, 1, f)} & got]
    assert len(wrong) <= 0.03 * len(got), wrong


def test_a_window_gives_every_family_and_no_false_relative(spark):
    apache, mit = TEMPLATES["apache-2.0"][1], TEMPLATES["mit"][4]
    lgpl, agpl, isc = TEMPLATES["lgpl"][1], TEMPLATES["agpl-3.0"][0], TEMPLATES["isc"][3]
    texts = [prose(i, 90) for i in range(30)] + [apache + "\n" + mit, lgpl, agpl, isc, "All rights reserved.", "GPLv3", "Permission is hereby granted, free of charge, to any person obtaining a copy", prose(3, 200) + "\n" + apache + "\n" + prose(4, 200) + "\n" + mit]
    out = licenses.scan(frame(spark, texts)).collect()
    assert confirmed(out) == {
        (30, 0, "apache-2.0"), (30, 0, "mit"), (31, 0, "lgpl"), (32, 0, "agpl-3.0"), (33, 0, "isc"), (34, 0, "proprietary"), (35, 0, "gpl-3.0"), (36, 0, "mit"),
        (37, 0, "apache-2.0"), (37, 0, "mit"),
    }
    at = {r.family: r for r in out if r.doc_id == 37}
    assert at["apache-2.0"].window < at["mit"].window and all(r.windows >= 1 for r in at.values())


def test_wrapped_long_and_unwanted_paragraphs(spark, docs):
    mit, gpl = TEMPLATES["mit"][4], TEMPLATES["gpl-3.0"][0]
    texts = [wrapped(mit, 9), prose(90, 30) + "\n \n" + wrapped(gpl, 11), prose(91, 300) + "\n" + wrapped(mit, 12) + "\n" + prose(92, 300), "he has a license to drive the old red tractor home"]
    extra = spark.createDataFrame([(80 + i, t, "en", "a", 1) for i, t in enumerate(texts)], SCHEMA)
    out = licenses.scan(docs.unionByName(extra)).collect()
    assert confirmed(out) == {(80, 0, "mit"), (81, 1, "gpl-3.0"), (82, 0, "mit")}
    assert {r.doc_id for r in out} <= {80, 81, 82, 83}


def test_repeated_rows_null_ids_ties_and_other_columns(spark):
    notice = "Licensed under the MIT License."
    rows = [(1, notice, 7, "x", 2)] * 2 + [(None, notice, 7, "x", 2), (2, None, 7, "x", 2), (3, "", 7, "x", 2), (4, " \n\n ", 7, "x", 2), (5, f"{notice}\n\n{notice}", 7, "x", 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, family int, words string, window int")
    out = licenses.scan(df).collect()
    assert sorted(((r.doc_id, r.paragraph, r.family, r.confirmed) for r in out), key=str) == sorted(
        [(1, 0, "mit", True)] * 2 + [(None, 0, "mit", True), (5, 0, "mit", True), (5, 1, "mit", True)], key=str
    )


def test_empty_table_and_unevaluated_twice(spark):
    assert licenses.scan(frame(spark, [])).collect() == [] == licenses.scan(frame(spark, ["", None])).collect()
    plan = licenses.windows(frame(spark, ["a license"]).withColumn("text", F.col("text")), ["license"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(lower(") == 1  # the words of a paragraph are made once


def test_reruns_agree(spark):
    texts = [prose(i, 60) + "\n" + TEMPLATES[f][0] for i, f in enumerate(TEMPLATES)]
    a, b = (sorted(map(tuple, licenses.scan(frame(spark, texts).repartition(n)).collect())) for n in (1, 7))
    assert a == b
