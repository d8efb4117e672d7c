"""Spelling variants against brute force over all pairs."""

import random
import re
import zlib
from collections import Counter

import pytest

from farespan.llm import variants

SCHEMA = "doc_id long, text string, word string, block int"


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def brute_vocabulary(rows):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate({c: c + 32 for c in range(65, 91)})
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}


def brute_group(rows):
    n = brute_vocabulary(rows)
    near = {w: [v for v in n if v != w and abs(len(v) - len(w)) < 2 and distance(w, v) == 1] for w in n}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return out


@pytest.fixture(scope="module")
def texts():
    rnd = random.Random(4)
    stems = ["letter", "später", "naïve", "aaaaaa", "ÿþýüûú", "station", "stations", "×÷×÷×", "x" * 300]
    rows = []
    for i in range(60):
        words = []
        for _ in range(40):
            w = list(rnd.choice(stems))
            for _ in range(rnd.choice([0, 0, 1, 1, 2])):
                at = rnd.randrange(len(w))
                w[at : at + rnd.randrange(2)] = rnd.choice(["", "a", "e", "É", "é", "s", "ab"])
            words.append("".join(w).title() if rnd.random() < 0.2 else "".join(w))
        rows.append((i, rnd.choice([" ", "-", "\n", "7", "“"]).join(words)))
    rows += [(None, "letter lettr letterr"), (90, None), (91, ""), (92, "1 2 3 ß"), (93, "letter " * 500), (93, "letter " * 500)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "clash", 1) for d, t in rows], SCHEMA)


def test_matches_brute_force(spark, texts):
    out = variants.group(frame(spark, texts).repartition(3))
    assert out.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    got = [tuple(r) for r in out.collect()]
    want = brute_group(texts)
    assert len(got) == len(want) > 100 and set(got) == want
    assert any(r[1] not in (None, r[2]) for r in got)  # a chain of two forms at least


def test_large_blocks_are_dealt_out_anew(spark, texts, monkeypatch):
    monkeypatch.setattr(variants, "BLOCK", 3)
    assert {tuple(r) for r in variants.group(frame(spark, texts)).collect()} == brute_group(texts)


def test_empty_table(spark):
    assert variants.group(frame(spark, [])).collect() == []
    assert variants.group(frame(spark, [(1, "one"), (2, None)])).collect() == []


@pytest.mark.parametrize("seed", range(8))
def test_sorted_list_scan(seed):
    rnd = random.Random(seed)
    letters = "ab" if seed % 2 else "abcdé"
    words = sorted({"".join(rnd.choice(letters) for _ in range(rnd.randrange(0 if seed > 5 else 2, 8))) for _ in range(120)})
    want = {(i, j) for i in range(len(words)) for j in range(i + 1, len(words)) if distance(words[i], words[j]) == 1}
    got = list(variants.near_pairs(words))
    assert len(got) == len(set(got)) and set(got) == want
