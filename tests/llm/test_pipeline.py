"""The pipeline stage by stage against brute force, and the registered queries' contracts."""

import importlib

import pytest

import corpus_pipeline
from llm_cases import SF, real  # noqa: F401
from test_decontaminate import plain as plain_leaks
from test_ngram_join import plain as plain_groups
from test_packing import valid
from test_secret_scan import KINDS
from test_secret_scan import plain as plain_spans

from tidemart.llm import importance, packing, secret_scan
from tidemart.llm.common import stored


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = [docs]
    for _, stage in corpus_pipeline.STAGES:
        found.append(stored(stage(spark, found[-1], SF), "test-stage"))
    return found


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_stages_keep_the_columns_of_documents(steps):
    assert all(s.columns == steps[0].columns for s in steps[:-1])
    assert 4 <= len(corpus_pipeline.STAGES) <= 5


def test_quality(spark, steps):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    judged = importance.selected(steps[0], labels).collect()
    assert set(texts(steps[1])) == {r["doc_id"] for r in judged if r["kept"]}


def test_near_copies(steps):
    rows = list(texts(steps[1]).items())
    assert set(texts(steps[2])) == {doc for doc, _, name in plain_groups(rows) if doc == name}


def test_decontamination(spark, steps):
    benchmark = [(r["item_id"], r["text"])
                 for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    rows = list(texts(steps[2]).items())
    leaked = {doc for doc, _ in plain_leaks(rows, benchmark)}
    assert set(texts(steps[3])) == {doc for doc, _ in rows} - leaked


def test_secrets(steps):
    before, after = texts(steps[3]), texts(steps[4])
    assert before.keys() == after.keys()
    for doc, text in before.items():
        assert not [s for s in plain_spans(after[doc]) if s[0] in KINDS]
        if not secret_scan.may_hold(text.encode()):
            assert after[doc] == text


def test_packing(steps):
    rows = steps[5].collect()
    held = valid(rows, packing.WINDOW)
    sizes = {doc: len(text.encode()) + 1 for doc, text in texts(steps[4]).items() if text}
    got = {}
    for r in rows:
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + r["length"]
    assert {d: n for d, n in got.items() if n} == sizes and held


CONTRACTS = {
    3: ["doc_id", "n_shingles", "component_id"],
    4: ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"],
    5: ["doc_id", "held_out", "lang_pred", "score"],
    6: ["vec_id", "n_links", "component_id", "kept"],
    9: ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels",
        "score"],
    10: ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
    12: ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    13: ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"],
}


@pytest.mark.parametrize("number", CONTRACTS)
def test_contracts(spark, number):
    queries = importlib.import_module("__spark_entry__").queries()
    name, = [n for n in queries if n.startswith(f"op{number}_")]
    found = queries[name](spark, SF)
    assert found.columns[:len(CONTRACTS[number])] == CONTRACTS[number]
    table = "embeddings" if number == 6 else "documents"
    key = found.columns[0]
    ids = sorted(r[key] for r in spark.read.parquet(f"{SF}/{table}.parquet").collect())
    assert sorted(r[key] for r in found.collect()) == ids


def test_all_operators_are_registered():
    queries = importlib.import_module("__spark_entry__").queries()
    for number in range(1, 14):
        assert len([n for n in queries if n.startswith(f"op{number}_")]) == 1
    assert "pipeline" in queries


def test_entry_works_without_the_subpackage(tmp_path):
    """The entry module imports and keeps its other queries when llm is taken away."""
    import shutil
    import subprocess
    import sys

    root = importlib.import_module("__spark_entry__").__file__.rsplit("/", 1)[0]
    shutil.copy(f"{root}/__spark_entry__.py", tmp_path)
    shutil.copytree(f"{root}/tidemart", tmp_path / "tidemart",
                    ignore=shutil.ignore_patterns("llm", "__pycache__"))
    code = ("import __spark_entry__ as e; q = e.queries(); assert len(q) > 130;"
            "assert not [n for n in q if n.startswith('op') or n == 'pipeline']; e.oracle_sql()")
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, timeout=120)
