"""Secret scan against the patterns applied one by one, and the ledger's bookkeeping."""

import hashlib
import re
from dataclasses import replace

from llm_cases import docs, real  # noqa: F401
from tidemart.llm import secret_scan
from tidemart.llm.common import scratch

ASSIGN = re.compile(
    r"""((?:p|P)(?:a|A)(?:s|S){2}(?:w|W)(?:(?:o|O)(?:r|R))?(?:d|D)|(?:s|S)(?:e|E)(?:c|C)(?:r|R)"""
    r"""(?:e|E)(?:t|T)|(?:t|T)(?:o|O)(?:k|K)(?:e|E)(?:n|N)|(?:a|A)(?:p|P)(?:i|I)_?(?:k|K)"""
    r"""(?:e|E)(?:y|Y))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
KINDS = ["assign", "access", "hex"]


def plain(text):
    text = text or ""
    spans = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    spans += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text)
              if len(m[0]) >= 20]
    spans += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    spans.sort(key=lambda s: (s[1], KINDS.index(s[0])))
    return spans


def compare(frame):
    texts = {r["doc_id"]: r["text"] for r in frame.collect()}
    out = secret_scan.digest(secret_scan.scan(frame)).collect()
    assert len(out) == frame.count()
    for r in out:
        spans = plain(texts[r["doc_id"]])
        joined = ",".join(":".join(map(str, s)) for s in spans)
        assert [r[f"n_{k}"] for k in KINDS] == [sum(s[0] == k for s in spans) for k in KINDS]
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        own = [s for s in r["spans"].split(",") if s.split(":")[0] in KINDS]
        assert ",".join(own) == joined
    return out


def test_all_documents(real):
    compare(real)


def test_hard_cases(docs):
    compare(docs([
        None, "", "password", "é password = hunter2x", "PassWord: 'abc' token=abcdefg",
        "password=token: abcdef", "api_key=\"A.b-c/d+e\"apikey : 123456", "AKIA" + "Z" * 16,
        "AKIA12 AKIAAKIA" + "9" * 15, "f" * 24 + "g" + "f" * 23, "Ä" + "0a" * 12 + "token=0123",
        "ſecret=abcdefg", "toKen=abcdefg", "secret secret  =  'aaaaaa", "x" * 200000 + " secret=1234567",
        "token=abcdef", "token=abcdef", "passwd:password=passwd", "🙂secret=🙂abcdef secret=abcdef",
    ]))


def test_ledger_scans_each_pair_once(spark, docs):
    ledger = scratch(spark, "ledger")
    first = docs(["token=abcdef", "token=abcdef", "clean"])
    secret_scan.scan(first, ledger).collect()
    assert secret_scan.read_ledger(spark, ledger).count() == 2
    secret_scan.scan(first, ledger).collect()
    assert secret_scan.read_ledger(spark, ledger).count() == 2
    more = docs(["token=abcdef", "secret=abcdef", None])
    out = secret_scan.scan(more, ledger).collect()
    assert secret_scan.read_ledger(spark, ledger).count() == 4
    assert sorted(len(r["spans"]) for r in out) == [0, 1, 1]
    newer = (replace(secret_scan.RULES[0], version=2, least=7), *secret_scan.RULES[1:])
    out = secret_scan.scan(more, ledger, newer).collect()
    rows = secret_scan.read_ledger(spark, ledger).collect()
    assert len(rows) == 7
    assert [r["spans"] for r in out] == [[], [], []]


def test_more_kinds(docs):
    out = secret_scan.digest(secret_scan.scan(docs([
        "-----BEGIN RSA PRIVATE KEY-----", "ghp_" + "A" * 36,
        "eyJhbGciOiJI.eyJzdWIiOiIx.SflKxwRJSMeKK"]))).collect()
    assert {r["spans"].split(":")[0] for r in out} == {"pem", "forge", "jwt"}
    assert all(r["n_assign"] == r["n_hex"] == 0 for r in out)


def test_redaction(docs):
    frame = docs(["a token=abcdef b", "clean", None, "é" + "0" * 24 + "!", "a token=abcdef b"])
    frame = frame.selectExpr("*", "1 as spans", "2 as body", "3 as blob", "4 as _blob", "5 as Blob_")
    out = {r["doc_id"]: r for r in secret_scan.redact(frame).collect()}
    assert [out[i]["text"] for i in range(5)] == [
        "a [SECRET] b", "clean", None, "é[SECRET]!", "a [SECRET] b"]
    assert out[0]["n_chars"] == 12 and out[2]["n_chars"] is None
    assert secret_scan.redact(frame).columns == frame.columns


def test_empty_table(docs):
    assert secret_scan.scan(docs([])).collect() == []
    assert secret_scan.redact(docs([])).collect() == []


def test_a_new_rule_is_tested_on_every_text(spark, docs):
    """The test before the scan follows from the rules given, with literals or without."""
    rules = (*secret_scan.RULES, secret_scan.Rule("chat", 1, rb"xox[bp]-[0-9]{6,}"),
             secret_scan.Rule("card", 1, rb"(?i)card [0-9]{8}", needs=(b"card ",)))
    frame = docs(["see xox" + "b-1234567 here", "token=abcdef xox" + "p-7654321", "CARD 12345678",
                  "nothing"])
    ledger = scratch(spark, "ledger")
    secret_scan.scan(frame, ledger).collect()
    out = {r["doc_id"]: r["spans"] for r in secret_scan.scan(frame, ledger, rules).collect()}
    assert [sorted(s["kind"] for s in out[i]) for i in range(4)] == [
        ["chat"], ["assign", "chat"], ["card"], []]
