import random
import re

import numpy as np
import pyarrow as pa

from terrace.llm import common, words


def _rows(texts):
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.r_[0, np.cumsum([len(r) for r in raw])].astype(np.int64)


def _lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def test_cut_equals_regular_expressions():
    rng = random.Random(1)
    texts = ["".join(rng.choices("aZ9 \t\n.é😀 {~\x7f", k=rng.randint(0, 30))) for _ in range(300)]
    for kind, pattern in ((words.NOT_SPACE, r"[^\x20\x09-\x0D]+"), (words.ALNUM, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")):
        got = words.cut(*_rows(texts), kind)
        low = got.low.tobytes()
        for i, text in enumerate(texts):
            mine = [low[s:e].decode() for s, e in zip(got.start[got.first[i] : got.first[i + 1]], got.end[got.first[i] : got.first[i + 1]])]
            assert mine == re.findall(pattern, _lower(text))


def test_hashes_depend_on_the_word_alone(monkeypatch):
    texts = ["the cat the", "cat", "", "a the b" * 3]
    got = words.cut(*_rows(texts), words.NOT_SPACE)
    low, h = got.low.tobytes(), words.hashes(got)
    known = {}
    for value, s, e in zip(h.tolist(), got.start, got.end):
        assert known.setdefault(low[s:e], value) == value
        assert words.hash_of(low[s:e]) == value
    assert len(set(known.values())) == len(known)


def test_word_longer_than_a_hash_block():
    long = "y" * (words.HASH_BLOCK * 2 + 5)
    got = words.cut(*_rows([f"a {long} b", long, long + "z"]), words.NOT_SPACE)
    h = words.hashes(got)
    assert h[1] == h[3] != h[4] and h[0] != h[2]


def test_hash_index_finds_places():
    rng = np.random.default_rng(3)
    keys = np.unique(rng.integers(0, 2**63, 5000).astype(np.uint64))
    keys[:50] = np.arange(50, dtype=np.uint64)  # all in one corner of the table
    index = words.HashIndex(keys)
    assert (index.find(keys) == np.arange(len(keys))).all()
    assert (index.find(np.setdiff1d(rng.integers(0, 2**63, 1000).astype(np.uint64), keys)) == -1).all()
    assert words.HashIndex(np.empty(0, np.uint64)).find(keys[:3]).tolist() == [-1] * 3


def test_letters():
    text, offsets = words.letters(*_rows(["A1!b", "", "Éç--x"]))
    assert text.tobytes().decode() == "a béç x" and offsets.tolist() == [0, 3, 3, 9]


def test_text_chunks_cover_all_rows():
    array = pa.array(["aa", None, "", "b" * 10, "c"])
    got = [(first, data.tobytes(), offsets.tolist()) for first, data, offsets in common.text_chunks(array.slice(1), 3)]
    assert got == [(0, b"", [0, 0, 0]), (2, b"b" * 10, [0, 10]), (3, b"c", [0, 1])]
