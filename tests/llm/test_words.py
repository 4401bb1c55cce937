"""Word boundaries and hashes against a regular expression."""

import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemart.llm import words

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def plain(texts):
    return [WORD.findall(t.lower()) for t in texts]


def got(texts):
    out = []
    for _, hashes, bounds in words.word_hashes(texts):
        out += [hashes[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    return out


def check(texts):
    found, names = got(texts), {}
    assert [len(x) for x in found] == [len(x) for x in plain(texts)]
    for hashes, own in zip(found, plain(texts), strict=True):
        for h, w in zip(hashes, own, strict=True):
            assert names.setdefault(h, w) == w
    assert len(names) == len({w for own in plain(texts) for w in own})


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(st.sampled_from("aAbé \n\t\x0b\x1f🙂z."), max_size=30), max_size=6))
def test_any_texts(texts):
    check([t.encode() for t in texts])


def test_chunks_and_long_texts(monkeypatch):
    monkeypatch.setattr(words, "CHUNK_BYTES", 64)
    check([b"", b"a b c", b"word " * 100, b"x" * 500, b"q " + b"y" * 300 + b" z", b" ", b"a b c"])


def test_marks_are_runs_of_their_own():
    table = words.classes(words.BLANKS, b"!.")
    (_, hashes, bounds), = words.word_hashes([b"Hi!! there.x"], table)
    assert np.diff(bounds).tolist() == [5] and len(set(hashes.tolist())) == 5


def test_a_chunk_is_small_beside_the_memory_of_a_worker():
    texts = [b"some words of a text " * 200] * 400
    chunks = list(words.word_hashes(texts))
    assert sum(len(b) - 1 for _, _, b in chunks) == 400
    assert max(len(h) for _, h, _ in chunks) <= 80_000
