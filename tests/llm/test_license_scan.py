"""License scan against a plain search for phrases."""

import json
import math
import re

import pytest

from llm_cases import docs, plan, real  # noqa: F401
from tidemart.llm import license_scan as scans
from tidemart.llm.license_scan import BASE_TEMPLATES, TEMPLATES, TEXTS, Template, license_scan

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def plain(text):
    words = WORD.findall((text or "").translate(LOWER))

    def starts(template):
        key = [(i, w) for i, w in template.places() if i < template.key]
        return [s for s in range(len(words))
                if all(s + i < len(words) and words[s + i] == w for i, w in key)]

    places = sorted(s for t in BASE_TEMPLATES for s in starts(t))
    return {"n_words": len(words), "n_base": len(places),
            "first_word": places[0] if places else None,
            "last_word": places[-1] if places else None,
            "base_labels": ",".join(sorted(t.label for t in BASE_TEMPLATES if starts(t))),
            "labels": ",".join(sorted(t.label for t in TEMPLATES if starts(t)))}


def compare(frame):
    texts = {r["doc_id"]: r["text"] for r in frame.collect()}
    out = license_scan(frame).collect()
    assert len(out) == frame.count()
    for r in out:
        got = r.asDict()
        score = got.pop("score")
        assert 0 <= score <= 1 and (score > 0) == bool(got["labels"])
        assert got == {"doc_id": r["doc_id"], **plain(texts[r["doc_id"]])}
    return out


def test_all_documents(real):
    assert any(r["n_base"] for r in compare(real))


def test_hard_cases(docs):
    compare(docs([
        None, "", "...", "MIT License", "mit-license, MIT\nlicense mit licens", "É mit license",
        "the GNU  General (Public) License version 3 and gnu general public license",
        "cc by sa 4 0 CC-BY cc-by", "apache license version 2 0 apache license version 1",
        "permission is hereby granted, free of charge", "by general license", "license mit", "x " * 60000 + "cc by", "cc " * 30000 + "by", "\u212aind mit license l\u0130cense",
        "\x00mit\x00license\x00", "mit license", "mit license", "ＭＩＴ license",
    ]))


def test_score_follows_the_rest_of_the_template(docs):
    out = {r["doc_id"]: r["score"] for r in license_scan(docs([
        "mozilla public license version 2 0", "mozilla public license only"])).collect()}
    assert out[0] == 1.0 and 0 < out[1] < 1


def test_whole_license_texts(docs):
    texts = [text for _, text in TEXTS.values()]
    out = compare(docs(texts + ["before " * 5000 + texts[0] + " after", texts[0][:400]]))
    by_id = {r["doc_id"]: r for r in out}
    for i, label in enumerate(TEXTS):
        assert by_id[i]["score"] == 1.0 and label in by_id[i]["labels"].split(",")
    assert (by_id[4]["labels"], by_id[4]["score"]) == ("mit-text", 1.0)
    assert by_id[5]["labels"] == "mit-text" and 0.2 < by_id[5]["score"] < 0.6


def test_shares_follow_the_idf_of_all_texts(docs, spark):
    table = scans.template_table(spark, [Template("t", "a b _ c d", 2)])
    texts = ["a b x c", "a b x y d", "c", "c c", "a b", "A", None]
    out = {r["doc_id"]: r["score"] for r in license_scan(docs(texts), table).collect()}
    df = {"a": 4, "b": 3, "c": 3, "d": 1}
    idf = {w: math.log(1 + len(texts) / (n + 1)) for w, n in df.items()}
    total = sum(idf.values())
    want = [total - idf["d"], total - idf["c"], 0, 0, idf["a"] + idf["b"], 0, 0]
    assert [out[i] for i in range(7)] == [pytest.approx(w / total) for w in want]


def test_templates_are_looked_up_by_their_rarest_word(docs, spark):
    table = scans.template_table(spark, [Template("t", "a b c", 2)])
    for texts, word in ((["a", "a", "b"], "b"), (["a", "b", "b"], "a"), (["c"], "a")):
        index = json.loads(scans.template_index(scans.words_of(docs(texts)), table))
        assert index[0]["rare"] == word


def test_native_plan(real):
    assert not re.search("Python|Arrow|Pandas|ExistingRDD", plan(license_scan(real)))


def test_empty_table_and_clashing_names(docs):
    assert license_scan(docs([])).collect() == []
    named = docs(["mit license"]).selectExpr("*", "1 as hits", "2 as n_words", "3 as s0")
    assert license_scan(named).first()["base_labels"] == "mit"
