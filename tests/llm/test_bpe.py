"""Byte-level BPE against the tiktoken library, and round trips."""

import base64
import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from farespan.llm import bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(bpe._read(PATH), PATTERN)


def samples():
    rnd = random.Random(7)
    alphabets = ["ab", "abcde fgh", "aA1 '\n\t.,s", "äöü ñ 你好 мир ", "   \x1c\x85x", "🙂👍 é", "lorem ipsum dolor "]
    out = ["", " ", "  ", "a", " a", "a ", "it's we're I'll", "x  y   z", "\n\n a\r\n", "\x1c a\x1f b", "<|endoftext|>", "a　 b  c", "aaaa" * 999, " " * 500 + "b", "ab" * 777, "1" * 300, "=-" * 200]
    for _ in range(400):
        alphabet = rnd.choice(alphabets)
        out.append("".join(rnd.choice(alphabet) for _ in range(rnd.randrange(200))))
    out += ["".join(chr(rnd.choice([rnd.randrange(32, 0x250), rnd.randrange(0x3000, 0xD000)])) for _ in range(60)) for _ in range(100)]
    return out


def ids(codec, text):
    import numpy as np

    return np.frombuffer(codec.encode(text), dtype="<i4").tolist()


def test_ids_are_those_of_the_library(codec, library):
    for text in samples():
        assert ids(codec, text) == library.encode_ordinary(text), text[:50]
        assert codec.decode(ids(codec, text)) == text.encode()


def test_every_cut_of_a_match_gives_the_same_ids(codec):
    """The join is a monoid's: any tree over any halves gives the merges of the whole."""
    rnd = random.Random(3)
    for data in (b"abababcabcab" * 3, "größenwahnsinnig".encode(), b"a" * 70, b"internationalisation", bytes(range(256))):
        whole = codec.merged(data)
        for _ in range(20):
            a, b = sorted(rnd.choices(range(len(data) + 1), k=2))
            x, y, z = (codec.merged(p) for p in (data[:a], data[a:b], data[b:]))
            assert codec.join(codec.join(x, y), z) == whole == codec.join(x, codec.join(y, z))
        assert codec.reduced(data) == whole


def test_a_full_memory_begins_anew(library, monkeypatch):
    monkeypatch.setattr(bpe, "KNOWN", 2)
    small = bpe.Codec(bpe._read(PATH), PATTERN)
    for text in samples()[:60]:
        assert ids(small, text) == library.encode_ordinary(text)


def test_a_pattern_of_another_kind(library):
    pattern = r"\p{L}|\s+|[^\s\p{L}]+"
    with open(PATH, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    own, other = bpe.Codec(bpe._read(PATH), pattern), tiktoken.Encoding("other", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    for text in samples()[:150]:
        assert ids(own, text) == other.encode_ordinary(text)


def test_round_trip_of_a_table(spark, library):
    rows = [(i, t, "clash", [1]) for i, t in enumerate(samples())] + [(None, None, "", None), (3, "again", "", None), (3, "again", "", None), (9, "word " * 60_000, "", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, bytes string, ids array<int>").repartition(4)
    want = sorted(
        ((d, len(x := library.encode_ordinary(t or "")), hashlib.sha256(",".join(map(str, x)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()) for d, t, *_ in rows),
        key=str,
    )
    assert sorted((tuple(r) for r in bpe.round_trip(docs, PATH, PATTERN).collect()), key=str) == want
    coded = bpe.encode(docs, PATH, PATTERN)
    assert coded.columns == ["doc_id", "bytes", "ids"]
    assert bpe.decode(coded, PATH, PATTERN).columns == ["doc_id", "bytes"]


def test_empty_table_and_unknown_ids(spark):
    assert bpe.round_trip(spark.createDataFrame([], "doc_id long, text string"), PATH, PATTERN).collect() == []
    odd = spark.createDataFrame([(1, [0, 99_999_999]), (2, None), (3, []), (4, [0, None])], "k long, ids array<int>")
    assert {r.k: r.bytes and bytes(r.bytes) for r in bpe.decode(odd, PATH, PATTERN).collect()} == {1: None, 2: b"", 3: b"", 4: None}


def test_ids_are_decoded_where_they_lie(codec, monkeypatch):
    """An Arrow array needs no Python number for each id; ids below zero are unknown like others."""
    import pyarrow as pa

    listed = ids(codec, "größer, und so weiter " * 40)
    for gather in (1 << 16, 7, 1):
        monkeypatch.setattr(bpe, "GATHER", gather)
        assert codec.decode(pa.array([0, *listed, 0], pa.int32())[1:-1]) == codec.decode(listed) == ("größer, und so weiter " * 40).encode()
        for unknown in ([5, -1], [5, None], [None], [2**40]):
            with pytest.raises(KeyError):
                codec.decode(unknown)
    assert codec.decode([]) == codec.decode(pa.array([], pa.int32())) == b""
