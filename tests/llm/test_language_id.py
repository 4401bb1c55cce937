"""Language ID: the forward pass against a listing of all segmentations, and accuracy."""

import math
import zlib
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

from llm_cases import docs  # noqa: F401
from tidemart.llm import language_id as lid


def ways(word, probs, pieces):
    """Sum and expected piece counts over all segmentations, by listing them."""
    numbers = {p: i + 1 for i, p in enumerate(pieces)}

    def cut(at):
        if at == len(word):
            yield []
        for n in range(1, min(lid.MAX_PIECE, len(word) - at) + 1):
            piece = numbers.get(word[at:at + n], 0 if n == 1 else None)
            if piece is not None:
                yield from ([piece, *rest] for rest in cut(at + n))

    total, counts = 0.0, np.zeros(len(probs))
    for found in cut(0):
        p = math.prod(probs[i] for i in found)
        total += p
        for i in found:
            counts[i] += p
    return total, counts / total


PIECES = sorted(["a", "b", "ab", "ba", "aba", "▁", "▁a", "▁ab", "é", "bé"])
WORDS = ["▁a", "▁abab", "▁ababa", "▁ébé", "▁xa", "▁", "ba", "▁" + "ab" * 5]


def test_forward_and_expected_counts():
    r = np.random.default_rng(1)
    pieces = lid.Pieces(PIECES)
    probs = r.random((pieces.count, 2)) + 0.01
    probs /= probs.sum(axis=0)
    got = lid.forward(pieces, WORDS, probs)
    for k in (0, 1):
        for i, w in enumerate(WORDS):
            assert got[i, k] == pytest.approx(math.log(ways(w, probs[:, k], PIECES)[0]))
    langs, weights = np.arange(len(WORDS)) % 2, np.arange(1.0, len(WORDS) + 1)
    counts = lid.expected(pieces, WORDS, langs, weights, probs)
    want = np.zeros(probs.shape)
    for w, k, n in zip(WORDS, langs, weights, strict=True):
        want[:, k] += n * ways(w, probs[:, k], PIECES)[1]
    assert np.allclose(counts, want)


def test_words():
    assert lid.letter_words("Ab-c 12 ²x_É") == ["▁ab", "▁c", "▁x", "▁é"]
    assert lid.letter_words(None) == lid.letter_words("12 ² _") == []
    assert lid.letter_words("a" * 70) == ["▁" + "a" * 32, "a" * 32, "a" * 6]


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    truth = {r["doc_id"]: r["lang"] for r in docs.collect()}
    rows = lid.predict(docs.drop("source")).collect()
    assert len(rows) == len(truth)
    held = [r for r in rows if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) / len(held) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_held_out_rows_teach_nothing(spark, docs):
    ids = [i for i in range(200) if zlib.crc32(str(i).encode()) % 5 == 0]
    rest = [i for i in range(200) if i not in ids]
    frame = docs([(i, "eins zwei") for i in rest[:20]], "de").union(
        docs([(i, "one two") for i in ids[:20]], "en"))
    assert {r["lang_pred"] for r in lid.predict(frame).collect()} == {"de"}
    only = docs([(i, "one two") for i in ids[:5]])
    assert {(r["lang_pred"], r["score"]) for r in lid.predict(only).collect()} == {("und", 0.0)}


def test_edge_cases(docs):
    frame = docs([None, "", "12 + ²", "the of and", "the of and", "x" * 300, "日本",
                  (None, "the of"), "the " * 50000]).selectExpr("*", "1 as score", "2 as word")
    rows = lid.predict(frame).collect()
    assert len(rows) == 9
    got = {r["doc_id"]: r["lang_pred"] for r in rows}
    assert got[0] == got[1] == got[2] == "und" and got[3] == got[6] == got[8] == "en"
    assert lid.predict(docs([])).collect() == []


ODD = ["Straße ŒUVRE’s “naïve”", "m²a ² x²", "Дом 日本 ΣΑΣ a", "a_b1c\x85d\xa0e", "q" * 70, "²" * 3,
       "İstanbul ǅ", "", None, "A-b\tC\n\x01d ªº µ ƒˆ", "\x81x\x8dy"]


def test_runs_of_many_texts_are_those_of_each():
    runs, ids, ends = lid.run_numbers(pa.array(ODD, pa.string()))
    assert len(set(runs)) == len(runs)
    for i, text in enumerate(ODD):
        own = [w for k in ids[ends[i]:ends[i + 1]] for w in lid.run_words(runs[k])]
        assert own == lid.letter_words(text)


def test_words_met_again_are_scored_once(monkeypatch):
    scored, forward = [], lid.forward

    def noted(pieces, words, probs):
        scored.extend(words)
        return forward(pieces, words, probs)

    monkeypatch.setattr(lid, "HELD_WORDS", 4)
    monkeypatch.setattr(lid, "forward", noted)
    pieces = lid.Pieces(["▁a", "b", "▁b"])
    probs = np.full((pieces.count, 2), 0.1)
    probs[1] = [0.5, 0.01]
    run = lid._scorer(SimpleNamespace(value=pieces), SimpleNamespace(value=probs),
                              np.zeros(2), ["p", "q"])
    texts = [f"a b {'c' * i}" for i in range(1, 9)] + ["²", None]
    batches = [pa.record_batch({"doc_id": [i], "text": pa.array([t], pa.string())})
               for i, t in enumerate(texts)]
    found = pa.Table.from_batches(run(iter(batches))).to_pylist()
    assert [r["lang_pred"] for r in found] == ["p"] * 8 + ["und"] * 2
    assert scored.count("▁a") == scored.count("▁b") == 1
