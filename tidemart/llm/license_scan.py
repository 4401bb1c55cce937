"""License scans with a positional index of rare words, in DataFrame functions only.

Templates are a table of words by place: short names of licenses and whole license texts. The
first `key` places of a template are its mandatory phrase. Document frequencies over all texts
rank the words of all templates; the index holds each template under the word of its phrase that
has the highest IDF. A scan looks up these rare words in each text. A hit fixes the start of the
template in the text (place in the text minus place in the template); there the words of the
template are compared at their relative places. The mandatory phrase must stand whole; the other
words only raise the score, the share of the template's summed IDF that stands.

Texts are read twice, for the frequencies and for the scan. Rows are not shuffled; the index grows
with the templates only.

Edge cases: a null text counts as empty; a text without words has no places and score 0; equal
rows are all returned; an empty table gives no rows; other columns of the input are ignored.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    """`words` of the template by place, `_` for places that are not looked at; the first
    `key` places are the mandatory phrase."""

    label: str
    words: str
    key: int
    base: bool = False

    def places(self) -> list[tuple[int, str]]:
        return [(i, w) for i, w in enumerate(self.words.split()) if w != "_"]


# Base phrases and their labels.
BASE_TEMPLATES = (
    Template("gpl", "gnu general public license", 4, True),
    Template("apache", "apache license", 2, True),
    Template("cc-by", "cc by", 2, True),
    Template("mit", "mit license", 2, True),
)
MORE_TEMPLATES = (
    Template("gpl-3.0", "gnu general public license version 3", 6),
    Template("gpl-2.0", "gnu general public license version 2", 6),
    Template("lgpl", "gnu lesser general public license", 5),
    Template("agpl", "gnu affero general public license", 5),
    Template("apache-2.0", "apache license version 2 0", 4),
    Template("mpl-2.0", "mozilla public license version 2 0", 3),
    Template("bsd", "bsd license", 2),
    Template("cc-by-sa", "cc by sa", 3),
    Template("cc0", "cc0 1 0 universal", 1),
)
# Public license texts.
TEXTS = {
    "mit-text": (7, """
        Permission is hereby granted, free of charge, to any person obtaining a copy of this
        software and associated documentation files (the "Software"), to deal in the Software
        without restriction, including without limitation the rights to use, copy, modify, merge,
        publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons
        to whom the Software is furnished to do so, subject to the following conditions: The above
        copyright notice and this permission notice shall be included in all copies or substantial
        portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND,
        EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS
        FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT
        HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF
        CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE
        USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    "isc-text": (12, """
        Permission to use, copy, modify, and/or distribute this software for any purpose with or
        without fee is hereby granted, provided that the above copyright notice and this permission
        notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL
        WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY
        AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR
        CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS,
        WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN
        CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    "apache-2.0-notice": (6, """
        Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file
        except in compliance with the License. You may obtain a copy of the License at
        http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to
        in writing, software distributed under the License is distributed on an "AS IS" BASIS,
        WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License
        for the specific language governing permissions and limitations under the License."""),
    "gpl-3.0-notice": (10, """
        This program is free software: you can redistribute it and/or modify it under the terms of
        the GNU General Public License as published by the Free Software Foundation, either version
        3 of the License, or (at your option) any later version. This program is distributed in the
        hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of
        MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for
        more details."""),
}
TEXT_TEMPLATES = tuple(
    Template(label, " ".join(re.split(SEPARATORS, text)).strip().lower(), key)
    for label, (key, text) in TEXTS.items())
TEMPLATES = BASE_TEMPLATES + MORE_TEMPLATES + TEXT_TEMPLATES

ANY = "_"  # a place that is not looked at; no word of a text is like it
_GIVEN = "array<struct<template:int,label:string,base:boolean,key:int,words:array<string>>>"
_INDEX = ("array<struct<label:string,base:boolean,key:int,rare:string,at:int,total:double,"
          "places:array<struct<place:int,word:string,weight:double>>>>")


def template_table(spark: SparkSession, templates=TEMPLATES) -> DataFrame:
    """template, label, base, key, place, word: a row for each place of each template."""
    given = json.dumps([{"template": i, "label": t.label, "base": t.base, "key": t.key,
                         "words": t.words.split()} for i, t in enumerate(templates)])
    rows = spark.range(1).select(F.explode(F.from_json(F.lit(given), _GIVEN)).alias("t"))
    return rows.select("t.template", "t.label", "t.base", "t.key",
                       F.posexplode("t.words").alias("place", "word"))


def words_of(docs: DataFrame) -> DataFrame:
    """doc_id, w: the words of each text, with A-Z in lower case."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    # The Kelvin sign is the one letter beyond ASCII that `lower` would make a letter of a-z.
    low = F.lower(F.replace(text, F.lit("\u212a"), F.lit("\u0137")))
    return docs.select("doc_id", F.array_remove(F.split(low, SEPARATORS), "").alias("w"))


def rarity(words: DataFrame, table: DataFrame) -> DataFrame:
    """word, weight: IDF over all texts of the words in any template."""
    listed = [r["word"] for r in table.select("word").distinct().collect()]  # a template's words
    vocabulary = F.split(F.lit(" ".join(sorted(listed))), " ")
    held = words.select(F.explode(F.concat(
        F.array(F.lit("")), F.array_intersect("w", vocabulary))).alias("word"))
    df = held.groupBy("word").agg(F.count(F.lit(1)).alias("df"))  # the empty word is in all
    counted = {r["word"]: r["df"] for r in df.collect()}  # a row for each word of a template
    rows = counted.pop("", 0)
    known = F.from_json(F.lit(json.dumps(counted)), "map<string,long>")
    found = F.coalesce(F.try_element_at(known, F.col("word")), F.lit(0))
    return table.select("word").distinct().select("word", F.when(
        F.col("word") != ANY, F.log(1 + F.lit(float(rows)) / (found + 1))).otherwise(
        F.lit(0.0)).alias("weight"))


def template_index(words: DataFrame, table: DataFrame) -> str:
    """The templates with the IDF of their words and the rare word they are looked up by, as
    JSON text."""
    placed = table.join(rarity(words, table), "word")
    rank = F.when((F.col("place") < F.col("key")) & (F.col("word") != ANY), F.struct(
        "weight", (-F.col("place")).alias("place"), "word"))
    whole = placed.groupBy("template", "label", "base", "key").agg(
        F.max(rank).alias("rare"), F.sum("weight").alias("total"),
        F.array_sort(F.collect_list(F.struct("place", "word", "weight"))).alias("places"))
    one = F.struct("label", "base", "key", F.col("rare.word").alias("rare"),
                   (-F.col("rare.place")).alias("at"), "total", "places")
    return whole.agg(F.to_json(F.collect_list(one))).first()[0]


def places(words: DataFrame, index: str) -> DataFrame:
    """doc_id, n_words, marks: start, label, base and share of every template whose mandatory
    phrase stands in a text."""
    listed = F.from_json(F.lit(index), _INDEX)
    rare = sorted({t["rare"] for t in json.loads(index)})

    def started(i: Column) -> Column:
        mine = F.filter(listed, lambda t: t["rare"] == F.get("w", i))
        return F.transform(mine, lambda t: F.struct((i - t["at"]).alias("start"), t.alias("t")))

    def along(hit: Column, n: Column) -> Column:
        return F.slice("w", F.greatest(hit["start"] + 1, F.lit(1)), n)

    def stands(hit: Column) -> Column:
        key = hit["t"]["key"]
        same = F.zip_with(F.slice(hit["t"]["places"], F.lit(1), key), along(hit, key),
                          lambda p, x: (p["word"] == ANY) | p["word"].eqNullSafe(x))
        return (hit["start"] >= 0) & F.forall(same, lambda x: x)

    def share(hit: Column) -> Column:
        all_places = hit["t"]["places"]
        worth = F.zip_with(all_places, along(hit, F.size(all_places)), lambda p, x: F.when(
            p["word"] == x, p["weight"]).otherwise(F.lit(0.0)))
        got = F.aggregate(worth, F.lit(0.0), lambda s, x: s + x)
        return F.least(F.lit(1.0), F.coalesce(F.try_divide(got, hit["t"]["total"]), F.lit(1.0)))

    at = F.filter(F.sequence(F.lit(0), F.size("w") - 1), lambda i: F.get("w", i).isin(rare))
    hits = F.filter(F.flatten(F.transform(at, started)), stands)
    marks = F.transform(hits, lambda h: F.struct(
        h["start"].alias("start"), h["t"]["label"].alias("label"), h["t"]["base"].alias("base"),
        share(h).alias("share")))
    return words.select("doc_id", F.size("w").cast("long").alias("n_words"), marks.alias("marks"))


def license_scan(docs: DataFrame, templates: DataFrame | None = None) -> DataFrame:
    """One row per row of `docs`: word count, places of the base phrases, labels and score.

    `templates` are as `template_table` gives them.
    """
    table = template_table(docs.sparkSession) if templates is None else templates
    words = words_of(docs)
    placed = places(words, template_index(words, table)).select(
        "*", F.filter("marks", lambda m: m["base"]).alias("bases"))

    def labels(marks: str) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.col(marks)["label"])), ",")

    return placed.select(
        "doc_id", "n_words", F.size("bases").cast("long").alias("n_base"),
        F.array_min("bases.start").cast("long").alias("first_word"),
        F.array_max("bases.start").cast("long").alias("last_word"),
        labels("bases").alias("base_labels"), labels("marks").alias("labels"),
        F.coalesce(F.array_max("marks.share"), F.lit(0.0)).alias("score"))
