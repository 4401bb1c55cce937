"""Index of the product names by trigrams, which sorts out products before a name search.

The index is a table of (gram, product_id): a row for each three letters in a row of a name, in
lower case. Only ASCII letters, digits and signs are indexed; a name in another script just has
fewer grams. A search takes from its pattern the letters that every match must hold, looks up
their grams, and runs the pattern on the products that have all of them. A pattern without such
letters (`a|b`, `[xy]..`) runs on all names, so the rows are those of `serving.search_names` for
every pattern.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.operators.ordered import join_null_safe
from tidemart.operators.serving import search_names
from tidemart.sources.keyed import KeyedTable

SIZE = 3
MAX_GRAMS = 8  # looked up for one search; fewer only sort out less
MAX_IDS = 1000  # products that are looked up by name; beyond, they are joined
# Letters beyond ASCII that match one of a-z without regard to case.
ALIKE = {"\u212a": "k", "\u017f": "s", "\u0130": "i", "\u0131": "i"}
_PLAIN = set(string.printable) - set("\\^$.|?*+()[]{}\t\n\r\x0b\x0c")


def folded(name: Column) -> Column:
    return F.lower(F.translate(name, "".join(ALIKE), "".join(ALIKE.values())))


def postings(products: DataFrame) -> DataFrame:
    """gram, product_id: the different grams of each name; null names have none."""
    name = folded(F.col("name"))
    at = F.when(F.length(name) >= SIZE, F.sequence(F.lit(1), F.length(name) - SIZE + 1))
    grams = F.array_distinct(F.transform(at, lambda i: F.substr(name, i, F.lit(SIZE))))
    rows = products.select("product_id", F.explode(grams).alias("gram"))
    return rows.where(F.col("gram").rlike("^[ -~]{3}$")).select("gram", "product_id").distinct()


def required(pattern: str) -> list[str]:
    """Runs of plain letters that every match of the pattern holds; none if that is not clear."""
    if "(?" in pattern or "\\Q" in pattern or "&&" in pattern:
        return []
    runs, run, depth, at = [], "", 0, 0
    while at < len(pattern):
        c = pattern[at]
        if c == "\\":
            if pattern[at + 1:at + 2].isalnum():
                return []
            runs, run, at = [*runs, run], "", at + 1
        elif c == "[":
            end = pattern.find("]", at + 2)
            if end < 0 or "[" in pattern[at + 1:end] or "\\" in pattern[at:end]:
                return []
            runs, run, at = [*runs, run], "", end
        elif c in "()":
            depth += 1 if c == "(" else -1
            runs, run = [*runs, run], ""
        elif c == "|" and not depth:
            return []
        elif c in "?*{":
            runs, run = [*runs, run[:-1]], ""
            if c == "{":
                at = pattern.find("}", at)
                if at < 0:
                    return []
        elif not depth and c in _PLAIN:
            run += c
        else:
            runs, run = [*runs, run], ""
        at += 1
    return [r for r in [*runs, run] if r]


def grams_of(pattern: str, literal: bool = False) -> list[str]:
    """Grams that the name of every match has, at most `MAX_GRAMS`, spread over the pattern."""
    if literal:
        runs = "".join(c if " " <= c <= "~" else "\n" for c in pattern.lower()).split("\n")
    else:
        runs = [r.lower() for r in required(pattern)]
    found = sorted({r[i:i + SIZE] for r in runs for i in range(len(r) - SIZE + 1)})
    step = max(1, -(-len(found) // MAX_GRAMS))
    return found[::step]


def candidates(index: KeyedTable, grams: list[str]) -> DataFrame:
    """product_id of the names that have all the grams; only files that can hold them are read."""
    paths = sorted({p for g in grams for p in index.files_of(g)})
    rows = index.spark.read.schema(index.schema).parquet(*paths) if paths else \
        index.spark.createDataFrame([], index.schema)
    return (rows.where(F.col("gram").isin(grams)).groupBy("product_id")
            .agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == len(grams))
            .select("product_id"))


def search(
    products: KeyedTable, index: KeyedTable, pattern: str, literal: bool = False
) -> DataFrame:
    """The rows of `serving.search_names` on the whole table."""
    grams = grams_of(pattern, literal)
    if not grams:
        return search_names(products.read(), pattern, literal)
    found = candidates(index, grams)
    few = [r[0] for r in found.limit(MAX_IDS + 1).collect()]
    if len(few) > MAX_IDS:
        near = join_null_safe(products.read(), found, ["product_id"], "left_semi")
    elif None in few:
        near = products.read().where(F.col("product_id").isin(few) | F.isnull("product_id"))
    else:
        paths = sorted({p for v in few for p in products.files_of(v)})
        rows = products.spark.read.schema(products.schema).parquet(*paths) if paths else \
            products.spark.createDataFrame([], products.schema)
        near = rows.where(F.col("product_id").isin(few))
    return search_names(near, pattern, literal)
