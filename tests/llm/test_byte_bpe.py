"""Tree-reduced BPE against the tiktoken library, with leaves so small that all borders occur."""

import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from llm_cases import docs, real  # noqa: F401
from tidemart.llm import byte_bpe

RANKS = byte_bpe.load_ranks()
WHOLE = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS,
                          special_tokens={})
SMALL = byte_bpe.Codec(RANKS, leaf=1)
LARGE = byte_bpe.Codec(RANKS)
BITS = ["'", "'r", "e", "'ll", " ", "  ", "\n", "\t \n", "a", "aaaa", "é", "日本", "1", "22", "!?",
        "\x85", " ", "\x1c", "🙂", "the", " the", "s", "'s", "́", "ſ", "\x00"]


def same(codec, text):
    ids = codec.encode(text)
    assert ids == WHOLE.encode_ordinary(text)
    assert codec.decode(ids) == text.encode()


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(BITS), max_size=30))
def test_all_borders(bits):
    same(SMALL, "".join(bits))


@settings(max_examples=100, deadline=None)
@given(st.text(max_size=60))
def test_any_text(text):
    text = text.encode("utf-8", "replace").decode()
    same(SMALL, text)


@pytest.mark.parametrize("unit", ["a", "ab", "é", "日", "=", "1", " ", "\n", "the", "ing", "🙂",
                                  "lolo", "-=", "  \n"])
@pytest.mark.parametrize("size", [255, 2049, 9001])
def test_long_pieces_are_spliced(unit, size):
    text = (unit * size)[:size]
    for around in (text, f"x'{text}", f"{text}x", f"it's {text}'ll", f"'r{text} y"):
        same(LARGE, around)
        same(byte_bpe.Codec(RANKS, leaf=97), around)


def test_random_long_pieces():
    rng = random.Random(5)
    for alphabet in ("abc", "etaoin", "日本語中文", "=-+"):
        text = "".join(rng.choice(alphabet) for _ in range(5000))
        same(byte_bpe.Codec(RANKS, leaf=50), text)


def test_every_letter_is_cut_alike():
    """Classes of letters are those of the library, for all code points."""
    text = " ".join(f"{chr(c)}x{chr(c)}" for c in range(0x30000) if not 0xD800 <= c < 0xE000)
    same(LARGE, text)


def test_neighbours_of_merged_tokens_are_stable():
    for text in ("aaaaaaaaaaaaaaaaaaaaaaa", "internationalisation", "=-=-=-=--=="):
        ids = SMALL.merged(text.encode())
        assert all(SMALL.stable(a, b) for a, b in zip(ids, ids[1:]))
    assert not SMALL.stable(RANKS[b"t"], RANKS[b"h"])


def sha(text):
    return hashlib.sha256(text).hexdigest()


def compare(frame):
    out = byte_bpe.digest(byte_bpe.decode(byte_bpe.encode(frame)))
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    wanted = []
    for r in frame.collect():
        ids = WHOLE.encode_ordinary(r["text"] or "")
        wanted.append((r["doc_id"], len(ids), sha(",".join(map(str, ids)).encode()),
                       sha((r["text"] or "").encode())))
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(wanted, key=repr)


def test_all_documents(real):
    compare(real)


def test_hard_rows(docs):
    texts = [None, "", " ", "x", "x", (3, "again"), (3, "again"), (None, "null id"), "a" * 70_000,
             "word " * 40_000, "<|endoftext|>", "\r\n\r\n", "é" * 3000 + "'s"]
    compare(docs(texts).selectExpr("*", "1 as ids", "'x' as decoded"))
    compare(docs([]))
