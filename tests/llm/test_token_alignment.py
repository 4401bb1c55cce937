"""Alignment against both libraries and plain counters."""

import hashlib
import random
from collections import Counter

import public_tokenizers as P
import pytest
import sentencepiece
import tiktoken
from tokenizers import Tokenizer

from llm_cases import docs, real  # noqa: F401
from tidemart.llm import token_alignment as ta

A = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))


def byte_letters():
    """Letters of byte-level vocabularies: printable bytes stand for themselves."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


LETTERS = byte_letters()
BYTES_A = {i: bytes(LETTERS[c] for c in t) for t, i in A.get_vocab().items() if i != 50256}
BYTES_B = [bytes([int(B.id_to_piece(i)[3:5], 16)]) if B.is_byte(i)
           else B.id_to_piece(i).replace("▁", " ").encode() for i in range(B.get_piece_size())]


def groups(text):
    """[(A ids, B ids)] of a text, or none."""
    if not text:
        return []
    a, b = A.encode(" " + text, add_special_tokens=False).ids, B.encode(text)
    whole = (" " + text).encode()
    if b"".join(BYTES_A[i] for i in a) != whole or b"".join(BYTES_B[i] for i in b) != whole:
        return []
    out, x, y, at_x, at_y = [], [], [], 0, 0
    a, b = a[::-1], b[::-1]
    while a or b:
        if at_x <= at_y:
            x.append(a.pop())
            at_x += len(BYTES_A[x[-1]])
        else:
            y.append(b.pop())
            at_y += len(BYTES_B[y[-1]])
        if at_x == at_y and x and y:
            out.append((x, y))
            x, y = [], []
    return out


def plain(rows):
    found, count = [], Counter()
    for doc, text in rows:
        own = groups(text)
        links = Counter((i, j) for x, y in own for i in x for j in y)
        count.update(links.keys())
        found.append((doc, own, links))
    best = {}
    for (i, _), n in count.items():
        best[i] = max(best.get(i, 0), n)
    out = []
    for doc, own, links in found:
        joined = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in own)
        out.append((doc, sum(len(x) for x, _ in own), sum(len(y) for _, y in own), len(own),
                    sum(links.values()),
                    sum(m for p, m in links.items() if count[p] == best[p[0]]),
                    sum(m * count[p] for p, m in links.items()),
                    hashlib.sha256(joined.encode()).hexdigest() if own else ""))
    return sorted(out, key=repr)


def compare(frame):
    out = ta.align(frame)
    assert out.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
                           "groups_sha256"]
    got = sorted(map(tuple, out.collect()), key=repr)
    assert got == plain([(r["doc_id"], r["text"]) for r in frame.collect()])
    return got


def test_all_documents(real):
    compare(real)


HARD = [
    None, "", " ", "  ", "a ", " a", "a  b", "a\n b", "a \n b  ", "▁", "a ▁b c", "the the the", "x",
    "x", (3, "same id"), (3, "same id"), (None, "null id"), "<|endoftext|> <s> <0x41> <unk>",
    "日本語 中文", "ﬁ ½ Å é", "\x00 \x1c \x85 　  ", "🙂🙂 🙂", "it's we'll 'r e",
    "no_spaces_" * 3000, "a" * 5000, "= " * 3000, "tab\tand\r\nline", "﻿ bom", "é" * 700,
]


def test_hard_cases(docs):
    compare(docs(HARD).selectExpr("*", "1 as part", "2 as idx", "'b' as block"))


def test_many_blocks_passes_and_tasks(spark, docs, monkeypatch):
    rng = random.Random(2)
    words = ["the", "of", "wördlich", "x1", "\n", "tokenizer", "日本", "aaa", "'s"]
    texts = [" ".join(rng.choices(words, k=rng.randint(0, 9))) for _ in range(400)] + HARD[:20]
    whole = compare(docs(texts).repartition(3))
    monkeypatch.setattr(ta, "FAN", 3)
    monkeypatch.setattr(ta, "BLOCK_BYTES", 300)
    monkeypatch.setattr(ta, "TASK_BYTES", 1000)
    monkeypatch.setattr(ta, "SLICE", 7)
    frame = docs(texts).repartition(3)
    both = ta.stored(ta.spilled(frame), "runs")
    assert both.select("block").distinct().count() > 3
    assert compare(frame) == whole


def test_empty_table(docs):
    compare(docs([]))
    compare(docs([None, "", None]))


def test_ranks_give_the_ids_of_the_json_file():
    """All tokens are reached by the merges from their own bytes, so both ways of merging agree;
    and both libraries cut all letters alike."""
    assert all(len(A.model.tokenize(t)) == 1 for t, i in A.get_vocab().items() if i != 50256)
    ranks = tiktoken.Encoding("a", pat_str=P.PATTERN, mergeable_ranks=ta.load_ranks(ta.RANKS),
                              special_tokens={})
    assert {i: t for t, i in ta.load_ranks(ta.RANKS).items()} == BYTES_A
    text = "".join(f"x{chr(c)}1{chr(c)} {chr(c)}{chr(c)}!{chr(c)}" for c in range(0x30000)
                   if not 0xD800 <= c < 0xE000)
    assert ranks.encode_ordinary(text) == A.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("k", [1, 5])
def test_merge_adds_equal_pairs(k):
    import numpy as np

    rng = np.random.default_rng(k)
    runs, want = [], Counter()
    for _ in range(k):
        keys = np.unique(rng.integers(0, 1 << 20, 500))
        n = rng.integers(1, 9, len(keys))
        want.update(dict(zip(keys.tolist(), n.tolist())))
        runs.append(ta.pack_pairs(keys, n))
    got = [(x, y) for keys, n in ta.merged_runs(runs) for x, y in zip(keys.tolist(), n.tolist())]
    assert got == sorted(want.items())
