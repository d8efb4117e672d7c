"""Keeping one row of each group where ids are missing or shared; prefixes and hints."""

import numpy as np
import pyarrow as pa

from farespan.llm import jaccard
from tests.llm.conftest import prose


def test_rows_are_kept_by_id_and_text(spark):
    a, b, c = prose(1, 80), prose(2, 80), prose(3, 80)
    near = a.split()
    near[40] = "edited"
    rows = [
        (5, a), (7, " ".join(near)),  # linked: the least doc_id stays
        (9, b), (9, c),  # one doc_id on two texts: judged apart
        (3, b),  # so this one stays for b, and (9, c) for c
        (None, c), (None, prose(4, 80)), (None, prose(4, 80)),  # a copy of c goes; repeated rows count as one
        (11, None), (11, None), (12, ""), (None, None),  # without words all stay, once
    ]
    docs = spark.createDataFrame([(d, t, "x", 1.5) for d, t in rows], "doc_id long, text string, key string, n double").repartition(3)
    out = jaccard.one_per_group(docs)
    assert out.columns == docs.columns
    got = sorted(((r.doc_id, r.text) for r in out.collect()), key=str)
    assert got == sorted([(5, a), (9, c), (3, b), (None, prose(4, 80)), (11, None), (12, ""), (None, None)], key=str)


def test_prefixes_of_linked_sets_share_a_shingle(spark):
    """Whatever the common shingles are, the listed prefix shingles connect every linked pair."""
    rng = np.random.default_rng(3)
    base = [prose(20 + i, 60).split() for i in range(6)]
    texts = []
    for words in base:
        for _ in range(12):
            w = list(words)
            for at in rng.integers(0, len(w), rng.integers(0, 3)):
                w[at] = f"e{rng.integers(0, 99)}"
            texts.append(" ".join(w + prose(90, 12).split()))  # a passage that all share
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    sets = [{tuple(t.split()[i : i + 5]) for i in range(len(t.split()) - 4)} for t in texts]
    up = list(range(len(texts)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                x, y = sorted((find(i), find(j)))
                up[y] = x
    for rows in (8, 1 << 30):  # with common shingles, and without
        jaccard.HINT_ROWS, held = rows, jaccard.HINT_ROWS
        try:
            got = {r.doc_id: r.component_id for r in jaccard.join(docs).collect()}
        finally:
            jaccard.HINT_ROWS = held
        assert got == {i: find(i) for i in range(len(texts))}


def _threads(links, n):
    up = list(range(n))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, j in links:
        x, y = sorted((find(i), find(j)))
        up[y] = x
    return [find(i) for i in range(n)]


def _borderline(count):
    """Sets of 200 shingles that share 178 to 194 with one base, most pairs a little under the limit."""
    rng = np.random.default_rng(11)
    base = rng.integers(0, 1 << 63, 200).astype(np.uint64)
    return [np.unique(np.r_[base[rng.permutation(200)[:k]], rng.integers(0, 1 << 63, 200 - k).astype(np.uint64)]) for k in rng.integers(178, 195, count)]


def test_a_cell_gives_fewer_links_than_sets():
    """Near copies whose similarity lies round the limit: their pairs are tested inside the cell."""
    sets = _borderline(150)
    n = len(sets)
    linked = [(i, j) for i in range(n) for j in range(i) if 100 * len(np.intersect1d(sets[i], sets[j])) >= 80 * len(np.union1d(sets[i], sets[j]))]
    assert 2 * n < len(linked) < n * n / 4
    ids = np.arange(n, dtype=np.int64)
    table = {"sid": np.r_[ids, ids], "cell": np.repeat([5, 6], n), "side": np.r_[np.zeros(n, np.int64), ids % 2], "root": np.r_[ids, ids], "hashes": pa.array([s.tobytes() for s in sets * 2], pa.binary())}
    out = jaccard._cells(pa.table(table)).to_pydict()
    got = list(zip(out["a"], out["b"]))
    assert set(got) <= {(j, i) for i, j in linked} and len(got) < 2 * n
    want = _threads(linked, n)
    one = jaccard.tree_links(sets, list(range(n)))
    assert _threads(one, n) == want and len(one) == n - len(set(want))
    two = jaccard.tree_links(sets, list(range(n)), (ids % 2).tolist())
    assert _threads(two, n) == _threads([(i, j) for i, j in linked if (i - j) % 2], n)
    assert jaccard.tree_links(sets, want) == []  # connected already
