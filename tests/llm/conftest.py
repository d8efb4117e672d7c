import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lam mu nu xi omi pi rho sigma tau ups phi chi psi omega".split()


def prose(seed: int, n: int) -> str:
    out, x = [], seed * 7919 + 1
    for _ in range(n):
        x = (x * 1103515245 + 12345) % (1 << 31)
        out.append(WORDS[(x >> 8) % len(WORDS)] + str((x >> 16) % 9))
    return " ".join(out)


@pytest.fixture(scope="session")
def corpus():
    """Rows with copies, near copies, shared passages, nulls, empty and repeated rows."""
    passage = prose(999, 15)
    rows = []
    for i in range(24):
        rows.append((i, prose(i, 60 + i), "en", f"src{i % 4}", 1))
    for i in range(24, 34):
        rows.append((i, prose(3, 63), "en", "src0", 1))
    for i in range(34, 44):
        words = prose(5, 200).split()
        words[(i * 17) % 200] = f"edit{i}"
        rows.append((i, " ".join(words), "de", "src1", 1))
    for i in range(44, 50):
        rows.append((i, prose(i, 40) + "\n" + passage + "\n" + prose(i + 100, 30), "en", "src2", 1))
    rows += [(50, None, "en", None, 0), (51, "", None, "src3", 0), (52, " \n\t", "en", "src3", 3), (53, "one two", "en", "src3", 7), (54, "One TWO", "en", "src3", 7)]
    rows += [(55, "wörter ñandú " * 30, "de", "ü", 9)] * 2
    rows += [(None, prose(3, 63), "en", "src0", 1), (56, prose(7, 3000), "en", "src1", 1)]
    return rows


@pytest.fixture
def docs(spark, corpus):
    return spark.createDataFrame(corpus, SCHEMA).repartition(5)


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
