"""Each operator against a brute-force version, with nulls, empty texts, copies and ties."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from farespan.llm import bayes, decontaminate, jaccard, licenses, lines, mixing, quality, sharding, substrings, urls
from tests.llm.conftest import SCHEMA, prose

A_Z = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def shingles(text):
    w = words((text or "").translate(A_Z))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_shards_are_even_whole_and_numbered(docs, corpus):
    out = sharding.shard(docs, 4).collect()
    size = {(r[0], r[1]): len((r[1] or "").encode()) + 1 for r in corpus}
    assert Counter((r.doc_id, r.size) for r in out) == Counter((d, s) for (d, t), s in zip([(r[0], r[1]) for r in corpus], [size[r[0], r[1]] for r in corpus]))
    slots, bytes_, place = defaultdict(list), Counter(), defaultdict(set)
    for r in out:
        slots[r.shard].append(r.slot)
        bytes_[r.shard] += r.size
        place[r.text_crc32].add(r.shard)
        assert r.law == "bytes" and r.grown_shard is None
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert all(len(v) == 1 for v in place.values())
    assert {r.text_crc32 for r in out if r.doc_id == 0} == {zlib.crc32(corpus[0][1].encode())}


def test_differencing_halves_a_known_case():
    sizes = [8, 7, 6, 5, 4]
    sums = Counter()
    for s, k in zip(sizes, sharding.difference(sizes, 2)):
        sums[k] += s
    assert sorted(sums.values()) == [14, 16]


def test_mix_meets_its_targets(docs, corpus):
    out = mixing.mix(docs).collect()
    assert Counter((r.doc_id, r.size) for r in out) == Counter((r[0], len(words(r[1]))) for r in corpus)
    total = sum(r.size for r in out)
    size, target, taken = Counter(), {}, Counter()
    source = {r[0]: r[3] for r in corpus}
    for r in out:
        s = source[r.doc_id]
        size[s] += r.size
        taken[s] += r.taken
        target[s] = r.target
        assert 0 <= r.taken <= 2 * r.size
    order = sorted([s for s in size if s is not None]) + [None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    want, left, free = {}, 1.5 * total, set(order)
    while True:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if weight[s] * level > 2 * size[s]}
        if not over:
            break
        for s in over:
            want[s] = 2 * size[s]
            left -= want[s]
        free -= over
    want |= {s: weight[s] * level for s in free}
    for s in order:
        assert target[s] == pytest.approx(want[s])
        assert abs(taken[s] - target[s]) <= 2
    assert rows(mixing.mix(docs).orderBy("doc_id", "size")) == rows(mixing.mix(docs.repartition(3)).orderBy("doc_id", "size"))
    copies = Counter(r.doc_id for r in mixing.apply_mix(docs).collect())
    assert all((copies[r.doc_id] > 0) == (r.taken > 0) for r in out if r.doc_id is not None)


def brute_components(corpus):
    sets = {}
    for i, r in enumerate(corpus):
        sets[i] = shingles(r[1])
    up = {i: i for i in sets}

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in sets:
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                up[find(i)] = find(j)
    group = defaultdict(list)
    for i in sets:
        group[find(i)].append(corpus[i][0])
    least = {k: min((x for x in v if x is not None), default=None) for k, v in group.items()}
    return Counter((corpus[i][0], len(sets[i]), least[find(i)]) for i in sets)


def test_jaccard_join_finds_every_component(docs, corpus, monkeypatch):
    assert Counter(rows(jaccard.join(docs))) == brute_components(corpus)
    monkeypatch.setattr(jaccard, "GROUP", 4)  # a grid of cells
    assert Counter(rows(jaccard.join(docs))) == brute_components(corpus)


def test_jaccard_keeps_one_of_each_group(docs, corpus):
    kept = [r.doc_id for r in jaccard.one_per_group(docs).collect()]
    firsts = {c for _, _, c in brute_components(corpus)}
    assert sorted(kept, key=str) == sorted(firsts, key=str)


@pytest.mark.parametrize("hot", [500, 1])
def test_substrings_match_brute_force(docs, corpus, hot):
    first = {}
    for r in sorted(corpus, key=lambda r: (r[0] is None, r[0] or 0)):
        b = (r[1] or "").encode()
        for p in range(len(b) - 49):
            first.setdefault(b[p : p + 50], substrings.LAST if r[0] is None else r[0])
    want = Counter()
    for r in corpus:
        b, me = (r[1] or "").encode(), substrings.LAST if r[0] is None else r[0]
        gone = bytearray(len(b))
        for p in range(len(b) - 49):
            if first[b[p : p + 50]] < me:
                gone[p : p + 50] = b"\1" * 50
        kept = bytes(x for x, y in zip(b, gone) if not y)
        spans = sum(gone[j] and not (j and gone[j - 1]) for j in range(len(b)))
        want[r[0], len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()] += 1
    assert Counter(rows(substrings.dedup(docs, hot=hot))) == want


def test_leaks_are_found_exactly(spark, docs, corpus):
    items = [(1, " ".join(corpus[56 if False else 5][1].split()[10:40])), (2, prose(12345, 30)), (3, None), (4, ""), (5, "one two"), (6, " ".join(corpus[-1][1].split()[900:915]).upper())]
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = Counter()
    for d, t, *_ in corpus:
        for i, x in items:
            own = shingles(x)
            both = len(own & shingles(t))
            if own and both >= 0.8 * len(own):
                want[d, i, len(own), both] += 1
    assert Counter((r.doc_id, r.item_id, r.item_shingles, r.shared) for r in decontaminate.leaks(docs, bench).collect()) == want
    clean = Counter(r[0] for r in corpus) - Counter(x for x in dict.fromkeys(k[0] for k in want) for _ in range(sum(1 for r in corpus if r[0] == x)))
    assert Counter(r.doc_id for r in decontaminate.remove_leaks(docs, bench).collect()) == clean


def test_quality_counts_and_verdict(spark, corpus):
    extra = [(60, "up ## up ## up\nup ## up ## up\nother", "en", "a", 1), (61, prose(8, 80).upper() + "!", "en", "a", 1), (62, (prose(9, 4) + "\n") * 30, "en", "a", 1)]
    docs = spark.createDataFrame(corpus + extra, SCHEMA)
    got = {(r.doc_id, r.n_words): r for r in quality.judge(docs).collect()}
    for d, t, *_ in corpus + extra:
        w = words(t)
        grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
        n, hit = Counter(grams), set()
        for i, g in enumerate(grams):
            if n[g] > 1:
                hit |= {i, i + 1, i + 2}
        full = [x for x in (t or "").split("\n") if words(x)]
        r = got[d, len(w)]
        assert r[2:6] == (sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(full) - len(set(full)), len(hit)), d
        assert r.base_failed == (len(w) < 50 or 100 * len(hit) > 50 * len(w))
        assert not (r.base_failed and r.kept)
    assert got[0, 60].kept and not got[61, 80].kept
    assert {r.doc_id for r in quality.filter_docs(docs).collect()} == {k[0] for k, r in got.items() if r.kept}


def test_lines_keep_one_of_each_component(spark, corpus):
    near = prose(77, 40)
    extra = [(70, near + "\nshort\n\nshort", "en", "a", 1), (71, near.replace(near.split()[20], "other"), "en", "a", 1), (72, prose(78, 40), "en", "a", 1)]
    docs = spark.createDataFrame(corpus + extra, SCHEMA)
    out = lines.dedup(docs).collect()
    every = [(r[0], x) for r in corpus + extra for x in (r[1] or "").split("\n") if words(x)]
    assert len(out) == len(every)
    kept = Counter(r.component_id for r in out if r.kept)
    assert set(kept.values()) == {1} and len(kept) == len({r.component_id for r in out})
    at = {(r.doc_id, r.line_no): r.component_id for r in out}
    assert at[70, 0] == at[71, 0] != at[72, 0]
    assert at[70, 1] == at[70, 3]


def test_lines_that_repeat_few_shingles_and_exact_links(spark):
    texts = ["ab" * 500, "ab" * 600, "xy" * 500, "-" * 900, "-" * 90, "wör" * 3, "a", "b", prose(5, 60), prose(5, 60) + " tail of it", prose(5, 60)[: 300] + prose(6, 30)]
    docs = spark.createDataFrame([(i, t, "en", "a", 1) for i, t in enumerate(texts)], SCHEMA)
    got = {r.doc_id: r.component_id for r in lines.dedup(docs).collect()}
    assert got[0] == got[1] and got[3] == got[4] and len({got[i] for i in (0, 2, 3, 5, 6, 7)}) == 6

    def grams(t):
        b = t.encode()
        return {b[i : i + 8] for i in range(max(1, len(b) - 7))}

    ids = {r.line: r.id for r in spark.createDataFrame([(t,) for t in texts], "line string").selectExpr("line", "xxhash64(line) id").collect()}
    pairs = [(x, y) for i, x in enumerate(texts) for y in texts[:i]]
    linked = lines._linked(spark.createDataFrame([(ids[x], ids[y]) for x, y in pairs], "a long, b long"), lines._lines(docs)).collect()
    want = {(ids[x], ids[y]) for x, y in pairs if len(grams(x) & grams(y)) >= 0.8 * len(grams(x) | grams(y))}
    assert {(r.a, r.b) for r in linked} == want and len(want) == len(linked) >= 3


@pytest.mark.parametrize("block", [4000, 7])
def test_lines_that_share_a_frame_meet_all_their_near_copies(spark, monkeypatch, block):
    frame, texts = prose(400, 16), []
    for i in range(60):
        own = prose(500 + i, 20)
        texts += [f"{frame} {own}", f"{frame} {own} end"]
    docs = spark.createDataFrame([(i, t, "en", "a", 1) for i, t in enumerate(texts)], SCHEMA)
    monkeypatch.setattr(lines, "BLOCK", block)
    got = defaultdict(set)
    for r in lines.dedup(docs).collect():
        got[r.component_id].add(r.doc_id)
    sets, up = [{t[i : i + 8] for i in range(len(t) - 7)} for t in texts], list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                up = [up[j] if x == up[i] else x for x in up]
    want = defaultdict(set)
    for i, x in enumerate(up):
        want[x].add(i)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values())) and len(want) == 60


def test_bayes_tells_junk_and_shrinks(spark, corpus):
    junk = [(100 + i, " ".join(w + "###" for w in prose(i, 60).split()), "en", "bad", 1) for i in range(30)]
    docs = spark.createDataFrame(corpus + junk, SCHEMA)
    labels = spark.createDataFrame([(i, 1, 0) for i in range(24)] + [(100 + i, 0, 0) for i in range(20)], "doc_id long, quality int, toxic int")
    out = bayes.classify(docs, labels).collect()
    assert len(out) == len(corpus) + len(junk)
    kept = {r.doc_id: r.kept for r in out}
    assert all(kept[i] for i in range(24)) and not any(kept[120 + i] for i in range(10))
    assert all(r.kept for r in bayes.classify(docs, labels.filter("quality = 1")).collect())


def test_url_rules_and_model(spark):
    urls_ = ["http://A.net/x", "https://b.example.net/en/1?q=://z/", "http://example.com/de/", "http://c.org/fr/1#t", "ftp://x.com", None, "no scheme", "http://evilnet/a", "http://d.net"]
    many = [f"http://w{i}.example.net/en/good{i}" for i in range(40)] + [f"http://casino{i}.net/win{i}" for i in range(40)]
    got = {r.page_id: r for r in urls.judge(spark.createDataFrame(list(enumerate(urls_ + many)), "page_id long, url string")).collect()}
    want = [("a.net", "/x", "net/"), ("b.example.net", "/en/1", "example.net/en/"), ("example.com", "/de/", "example.com/de/"), ("c.org", "/fr/1", "org/fr/"), ("x.com", "", None), ("", "", None), ("", "", None), ("evilnet", "/a", None), ("d.net", "", None)]
    for i, (h, p, r) in enumerate(want):
        assert (got[i].host, got[i].path, got[i].rule) == (h, p, r)
        assert got[i].verdict in ("allow", "block")
    assert [got[i].verdict for i in range(4)] == ["block", "allow", "block", "allow"]


def test_url_scores_are_those_of_exact_counts(spark):
    texts = [f"http://w{i}.example.net/en/{prose(i, 6).replace(' ', '-')}" for i in range(150)] + [f"http://casino{i}.net/{prose(900 + i, 6).replace(' ', '/')}" for i in range(150)]
    texts += ["http://x.com/" + prose(i, 3).replace(" ", "ü") for i in range(20)] + [None, None, texts[0]]
    pages = spark.createDataFrame(list(enumerate(texts)), "page_id long, url string")
    out = urls.judge(pages).withColumn("address", F.concat("host", F.lower("path"))).withColumn("fold", F.pmod(F.xxhash64("address"), F.lit(5))).collect()
    n = [Counter(), Counter()]

    def events(address):
        b = b"\2" * 5 + address.encode() + b"\3"
        return [[(b[i - k : i], b[i]) for k in range(6)] for i in range(5, len(b))]

    for r in out:
        if r.rule and r.fold:
            for place in events(r.address):
                for context, c in place:
                    n[r.rule.startswith("example")][context, c] += 1
                    n[r.rule.startswith("example")][context] += 1
    for r in out:
        total = 0
        for place in events(r.address):
            p = [1 / 256, 1 / 256]
            for context, c in place:
                p = [(n[y][context, c] + 2 * p[y]) / (n[y][context] + 2) for y in (0, 1)]
            total += math.log(p[1] / p[0])
        assert r.score == pytest.approx(total / len(events(r.address)), abs=1e-8)
    assert len(out) == len(texts)


def test_empty_tables(spark, empty):
    bench = spark.createDataFrame([], "item_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    pages = spark.createDataFrame([], "page_id long, url string")
    for df in (
        sharding.shard(empty), mixing.mix(empty), mixing.apply_mix(empty), jaccard.join(empty), jaccard.one_per_group(empty), substrings.dedup(empty),
        decontaminate.leaks(empty, bench), decontaminate.remove_leaks(empty, bench), quality.judge(empty), quality.filter_docs(empty),
        lines.dedup(empty), licenses.scan(empty), bayes.classify(empty, labels), urls.judge(pages),
    ):
        assert df.collect() == []


def test_clashing_columns_pass_through(spark, corpus):
    names = ["size", "shard", "_key", "_source", "n", "target", "_row", "_stays", "label"]
    docs = spark.createDataFrame(corpus, SCHEMA).select("*", *[F.lit(1).alias(c) for c in names])
    bench = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    for df in (mixing.apply_mix(docs), jaccard.one_per_group(docs), decontaminate.remove_leaks(docs, bench), quality.filter_docs(docs)):
        assert df.columns == docs.columns and df.count() > 0
    assert sharding.shard(docs).count() == mixing.mix(docs).count() == len(corpus)
