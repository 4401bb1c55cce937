"""Registered queries of the operators, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm import (
    byte_bpe, decontaminate, importance, language_id, lexical_search, license_scan,
    metric_join, ngram_join, packing, preference, secret_scan, sharding,
    token_alignment,
)
from tidemart.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str):
    def add(run):
        QUERIES[name] = run
        return run

    return add


@query("op1_importance_resampling")
def _(spark, sf_dir):
    judged = importance.selected(table(spark, sf_dir, "documents"),
                                 table(spark, sf_dir, "labels"))
    return judged.where("kept").drop("kept")


@query("op2_preference_pairs")
def _(spark, sf_dir):
    return preference.preference_pairs(table(spark, sf_dir, "conversations"), derive=True)


SQL["op2_preference_pairs"] = preference.SQL


@query("op3_ngram_jaccard_join")
def _(spark, sf_dir):
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"))


@query("op4_hypergeometric_shards")
def _(spark, sf_dir):
    text = F.col("text")
    sized = table(spark, sf_dir, "documents").select(
        "doc_id", (F.coalesce(F.octet_length(text), F.lit(0)) + 16).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"))
    return sharding.shuffle_into_shards(sized, shards=40).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


@query("op5_marginal_language_id")
def _(spark, sf_dir):
    return language_id.predict(table(spark, sf_dir, "documents"))


@query("op6_metric_range_join")
def _(spark, sf_dir):
    return metric_join.near_vectors(table(spark, sf_dir, "embeddings"))


@query("op7_best_fit_packing")
def _(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"))


@query("op8_simhash_decontamination")
def _(spark, sf_dir):
    return decontaminate.leaks(table(spark, sf_dir, "documents"),
                               table(spark, sf_dir, "benchmark")).drop("mark")


@query("op9_license_scan")
def _(spark, sf_dir):
    return license_scan.license_scan(table(spark, sf_dir, "documents"))


@query("op10_secret_ledger")
def _(spark, sf_dir):
    return secret_scan.digest(secret_scan.scan(table(spark, sf_dir, "documents")))


@query("op11_automaton_search")
def _(spark, sf_dir):
    return lexical_search.best_documents(table(spark, sf_dir, "documents"),
                                         table(spark, sf_dir, "benchmark"))


SQL["op11_automaton_search"] = lexical_search.SQL


@query("op12_tree_bpe")
def _(spark, sf_dir):
    return byte_bpe.digest(byte_bpe.decode(byte_bpe.encode(table(spark, sf_dir, "documents"))))


@query("op13_spill_alignment")
def _(spark, sf_dir):
    return token_alignment.align(table(spark, sf_dir, "documents"))
