"""The cascade's measures, verdicts and order against plain Python."""

import random
import re
from collections import Counter

import pyarrow as pa
import pytest

from farespan.llm import quality
from tests.llm.conftest import prose

WORD = r"[^\x20\x09-\x0D]+"


def plain(text):
    t = text or ""
    w = re.findall(WORD, t)
    lines = [x for x in t.split("\n") if re.search(WORD, x)]
    runs = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    seen, hit = Counter(runs), set()
    for i, g in enumerate(runs):
        if seen[g] > 1:
            hit |= {i, i + 1, i + 2}
    two = max(Counter(zip(w, w[1:])).values(), default=0)
    blank = " \t\n\x0b\x0c\r"
    return {
        "n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": len(re.findall(r"[#*$%&|<>]", t)), "n_upper": len(re.findall("[A-Z]", t)),
        "n_lower": len(re.findall("[a-z]", t)), "n_bangs": t.count("!"), "n_lines": len(lines), "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(hit),
        "n_plain_words": sum(bool(re.search(r"[A-Za-z]|[^\x00-\x7f]", x)) for x in w), "n_bullets": sum(x.strip(blank)[0] in "-*+•" for x in lines),
        "n_cut_lines": sum(x.strip(blank).endswith(("...", "…")) for x in lines), "n_top_words": 2 * two if two > 1 else 0,
    }


def rejected(m):
    return {
        "few_words": m["n_words"] < 50, "symbols": 10 * m["n_symbols"] > 3 * m["n_words"], "shouting": m["n_upper"] > m["n_lower"],
        "exclamations": 4 * m["n_bangs"] > m["n_words"], "word_length": m["word_chars"] > 16 * m["n_words"] or m["word_chars"] < 2 * m["n_words"],
        "repeated_lines": 10 * m["n_dup_lines"] > 3 * m["n_lines"], "repeated_words": 100 * m["n_repeat_words"] > 50 * m["n_words"],
        "plain_words": 10 * m["n_plain_words"] < 6 * m["n_words"], "bullets": m["n_lines"] > 2 and 10 * m["n_bullets"] > 9 * m["n_lines"],
        "cut_lines": m["n_lines"] > 2 and 10 * m["n_cut_lines"] > 3 * m["n_lines"], "top_run": 10 * m["n_top_words"] > 3 * m["n_words"],
    }


@pytest.fixture(scope="module")
def texts():
    rnd = random.Random(6)
    out = [None, "", " ", "\n", "\n\n a\n\n", "a\n a\na ", "x…", "..", "...", " - a\n* b\n+ c\n• d", "é…\nü...\nok"]
    for i in range(300):
        lines = []
        for _ in range(rnd.randrange(1, 8)):
            line = prose(rnd.randrange(40), rnd.randrange(1, 30))
            kind = rnd.randrange(9)
            line = [line, line.upper(), line + "...", "- " + line, " • " + line, line.replace("a", "#"), line + "!" * 9, re.sub("[a-z]", "7", line), "  " + line + " … "][kind if rnd.random() < 0.5 else 0]
            lines += [line] * rnd.choice([1, 1, 1, 2, 4])
        out.append(rnd.choice(["\n", "\n\n", "\r\n"]).join(lines))
    out += ["- item one two three four five six\n" * 3 + "\n".join("- " + prose(i, 12) for i in range(12)), "\n".join(prose(i, 20) + "..." for i in range(6)), " ".join(f"{i} {i * 7}" for i in range(90)), "one two " * 40, "a" * 200_000 + " " + prose(3, 99)]
    return out


def test_measures(texts):
    t = quality.Texts(pa.array(texts, pa.string()))
    want = [plain(x) for x in texts]
    for name in want[0]:
        assert t.get(name).tolist() == [w[name] for w in want], name


def test_verdicts_in_any_order(texts):
    names = [r.name for r in quality.RULES]
    want = [i for i, x in enumerate(texts) if not any(rejected(plain(x)).values())]
    assert set(names) == set(rejected(plain("")))
    rnd = random.Random(2)
    for _ in range(6):
        order = rnd.sample(range(len(names)), len(names))
        assert quality.kept(quality.Texts(pa.array(texts, pa.string())), order).tolist() == want
    for i, name in enumerate(names):  # each rule is met by some text
        assert any(rejected(plain(x))[name] for x in texts), name


def test_judged_table(spark, texts):
    rows = [(i if i % 50 else None, x, "clash", 3, True) for i, x in enumerate(texts)] + [(7, texts[30], "", 0, False)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_words string, mask long, kept boolean").repartition(4)
    got = Counter((r.doc_id, r.n_words, r.n_repeat_words, r.base_failed, r.kept) for r in quality.judge(docs).collect())
    want = Counter()
    for d, x, *_ in rows:
        m = plain(x)
        failed = m["n_words"] < 50 or 100 * m["n_repeat_words"] > 50 * m["n_words"]
        want[d, m["n_words"], m["n_repeat_words"], failed, not any(rejected(m).values())] += 1
    assert got == want
    good = quality.filter_docs(docs)
    assert good.columns == docs.columns and good.count() == sum(n for k, n in want.items() if k[-1])


def test_order_is_by_rejections_left_for_the_price_left():
    rules = tuple(quality.Rule(n, m, lambda t: None) for n, m in (("dear", ("a",)), ("twin", ("b",)), ("cheap", ("b", "c")), ("idle", ("d",))))
    cost = {"a": 8.0, "b": 2.0, "c": 0.1, "d": 0.1}
    # 0 rejects 60 rows, 40 of these with 1; 2 rejects 10 more by itself
    masks = {0b0001: 20, 0b0011: 40, 0b0100: 10, 0: 30}
    assert quality.arrange(rules, cost, masks) == [1, 2, 0, 3]
    # With its measure paid, the dear rule comes first, and then the twin has nothing left to reject.
    assert quality.arrange(rules, cost, masks, ("a",)) == [0, 2, 1, 3]


def test_sample_is_picked_by_hash(spark, texts, monkeypatch):
    monkeypatch.setattr(quality, "SAMPLE_ROWS", 100)
    docs = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "doc_id long, text string").repartition(3)
    order = quality.order_rules(docs)
    assert sorted(order) == list(range(len(quality.RULES)))
    assert quality.order_rules(docs.limit(0)) == list(range(len(quality.RULES)))
