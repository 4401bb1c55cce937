"""Benchmark decontamination by SimHash windows tiled over the items, in DataFrame functions only.

A document is fingerprinted in windows that begin on a grid with a line every `g` words. An item
is fingerprinted in windows of the same size at so many places that, wherever the passage stands,
every unchanged run of 11 of its words (7 in items below 13 words) holds a grid window that equals
one of the item. A similarity of 0.8 leaves such a run: an edit inside an item changes five
shingles and makes five new ones, so it takes at least 22 shingles even where those it changes
weigh next to nothing. A fingerprint has 35 bits, one for each of 35 hash bits of the
words in the window, set if more than half of the words have it. The 35 counters are kept as five
longs of seven byte-wide lanes, so a window's counters are sums of its blocks' counters.

The index is a multi-index over three parts of 10, 10 and 15 bits: fingerprints within a radius of
1 agree in at least two of them, so looking up each two finds all of them. Candidates are verified
on the words: a window of the item's length must have a weighted Jaccard similarity of five-word
shingles of 0.8 or more. Tried are the window that lines up with the item, those a few words off
(n / 9 - 3, what added words can gain), and those up to a quarter of the item off that the text's
begin or end cuts short. A shingle of the item weighs its inverse document frequency among the
items, any other shingle the largest such weight.

Words are lower-cased runs of ASCII letters and digits and of all non-ASCII characters. Items of
13 words or more have windows of 8 words with g = 4, those of 7 to 12 words windows of 4 with
g = 4, shorter ones the largest power of two with g = 1. Items of `LONG` words or more keep half of the
places, which find every unchanged run of 15 words; they have one of 16. An item or window of
fewer than five words is one shingle.

Edge cases: null or empty texts and items match nothing; equal rows are one result row with their
doc_id; a null doc_id is kept; equal items are all reported; empty tables give no rows; other
columns are ignored by `leaks` and kept by `without_leaks`.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.llm.common import free_names, sized_ids, stored
from tidemart.llm.license_scan import SEPARATORS

SHINGLE_WORDS = 5
SIMILARITY = 0.8
RADIUS = 1
LANES = 5
LONG = 49  # words of an item from which every other four places are left out
ONES = 0x01010101010101  # seven bytes: the sums stay within a signed long
_HIGH = 0x80808080808080
PARTS = (0xFFFFFFFF, 0xFFFFFF0000FFFF, 0xFFFFFFFFFF0000)
KEYS_IN_PLAN = 50_000  # rows of an index that also sorts out windows before the join


def split_words(text: Column) -> Column:
    return F.array_remove(F.split(
        F.lower(F.coalesce(text.cast("string"), F.lit(""))), SEPARATORS), "")


def grid(n: Column) -> Column:
    """Words between grid lines for an item of n words."""
    return F.when(n >= 7, 4).otherwise(1)


def window_words(n: Column) -> Column:
    """Words in a window of an item of n words."""
    return F.when(n >= 13, 8).when(n >= 7, 4).otherwise(
        F.pow(F.lit(2), F.floor(F.log2(n)))).cast("int")


def lane_sums(hashes: Column, lane: int) -> Column:
    """Eight counters of one lane set over an array of word hashes."""
    return F.aggregate(hashes, F.lit(0).cast("long"), lambda s, h: s + F.shiftrightunsigned(
        h, lane).bitwiseAND(F.lit(ONES)))


def fingerprint(sums: list[Column], words: Column) -> Column:
    """35 bits, five in each byte: a counter above half of `words` gives 1."""
    bump = (F.lit(127) - F.floor(words / 2).cast("long")) * F.lit(ONES)
    return reduce(lambda a, b: a.bitwiseOR(b), [
        F.shiftrightunsigned((s + bump).bitwiseAND(F.lit(_HIGH)), 7 - k)
        for k, s in enumerate(sums)])


def parts(print_: Column) -> list[Column]:
    """Each two of the three parts."""
    return [print_.bitwiseAND(F.lit(mask)) for mask in PARTS]


def numbered(benchmark: DataFrame) -> DataFrame:
    """item (a number of its own), item_id and words of every item that has words."""
    return stored(benchmark.select("item_id", split_words(F.col("text")).alias("words")).where(
        F.size("words") > 0).select(
        F.monotonically_increasing_id().alias("item"), "item_id", "words"), "items")


def item_prints(items: DataFrame) -> DataFrame:
    """item, n, g, m (blocks in the window), shift (its place in the item) and print of every
    window of an item."""
    n, g = F.col("n"), F.col("g")
    sized = items.select("item", "words", F.size("words").alias("n")).select(
        "*", grid(n).alias("g"), window_words(n).alias("size"))
    shifts = F.filter(F.sequence(F.lit(0), n - F.col("size")),
                      lambda s: (n < LONG) | (s % 8 < 4))
    each = sized.select("item", "words", "n", "g", (F.col("size") / g).cast("int").alias("m"),
                        F.explode(shifts).alias("shift"))
    hashes = F.transform(F.slice("words", F.col("shift") + 1, F.col("m") * F.col("g")),
                         lambda w: F.xxhash64(w))
    print_ = fingerprint([lane_sums(hashes, k) for k in range(LANES)], F.col("m") * F.col("g"))
    return each.select("item", "n", "g", "m", "shift", print_.alias("print"))


def shingles(words: Column) -> Column:
    """Distinct five-word shingles; fewer words are one shingle."""
    n = F.size(words)
    last = F.greatest(F.lit(0), n - SHINGLE_WORDS)
    return F.array_distinct(F.transform(F.sequence(F.lit(0), last), lambda i: F.array_join(
        F.slice(words, i + 1, SHINGLE_WORDS), " ")))


def moved(n):
    """How many words a window that the text cuts short may lie off the item's place."""
    return n // 4 + 1 if isinstance(n, int) else F.floor(n / 4).cast("int") + 1


def item_weights(items: DataFrame) -> DataFrame:
    """item, item_id, weighted (struct shingle, weight), and the weight of any other shingle."""
    total = items.count()
    each = items.select("item", "item_id", F.explode(shingles(F.col("words"))).alias("s"))
    common = each.groupBy("s").agg(F.count(F.lit(1)).alias("df"))
    weight = F.log(F.lit(1.0) + F.lit(float(total)) / F.col("df"))
    return each.join(common, "s").groupBy("item", "item_id").agg(F.collect_list(
        F.struct("s", weight.alias("w"))).alias("weighted")).select(
        "*", F.lit(math.log(1.0 + total)).alias("other"))


def _held(rows: DataFrame, kept: list[str], made: list[str]) -> DataFrame:
    """`rows` with the arrays in `made` evaluated once: a step that generates one row from them
    keeps the optimizer from moving their expressions into the lambdas that read them."""
    return rows.select(*kept, F.explode(F.array(F.struct(*made))).alias("_made")).select(
        *kept, "_made.*")


def _windows(texts: DataFrame, g: int, sizes: dict[int, tuple[int, int]],
             keys: dict[int, list | None]) -> DataFrame:
    """doc_id, mark, g, m, line (grid line), print and near (words around) of the windows whose
    fingerprint has a part that some item has; `sizes` has the longest item and the largest shift
    of each m."""
    lanes, base = range(LANES), ["doc_id", "mark", "words", "nb"]
    blocks = texts.select("*", F.floor(F.size("hashes") / g).cast("int").alias("nb"))
    no_lines = F.array().cast("array<int>")

    def lines(m: int) -> Column:
        """Grid lines at which a window of m blocks begins."""
        return F.when(F.col("nb") >= m, F.sequence(F.lit(0), F.col("nb") - m)).otherwise(no_lines)

    def block_sums(lane: int) -> Column:
        return F.transform(lines(1), lambda b: lane_sums(F.slice("hashes", b * g + 1, g), lane))

    def doubled(m: int, lane: int) -> Column:
        """Counters of m blocks: those of the two halves."""
        return F.transform(lines(m), lambda b: F.get(f"s{lane}", b) + F.get(
            f"s{lane}", b + m // 2))

    def hits(m: int) -> Column:
        back = sizes[m][1] + moved(sizes[m][0])
        found = F.transform(lines(m), lambda b: F.struct(
            b.alias("line"),
            fingerprint([F.get(f"s{k}", b) for k in lanes], F.lit(m * g)).alias("print")))
        if keys[m] is not None:
            found = F.filter(found, lambda x: reduce(lambda a, b: a | b, [
                part.isin(own) for part, own in zip(parts(x["print"]), keys[m], strict=True)]))
        return F.transform(found, lambda x: F.struct(
            F.lit(m).alias("m"), x["line"].alias("line"), x["print"].alias("print"),
            F.lit(back).alias("back"),
            F.slice("words", F.greatest(F.lit(0), x["line"] * g - back) + 1,
                    F.lit(back + sizes[m][0] + moved(sizes[m][0]))).alias("near")))

    sums, found, m = [f"s{k}" for k in lanes], [], 1
    grown = blocks.select(*base, *[block_sums(k).alias(f"s{k}") for k in lanes])
    while m <= max(sizes):
        grown = _held(grown, base + found, sums)
        if m in sizes:
            grown = grown.select("*", hits(m).alias(f"f{m}"))
            found.append(f"f{m}")
        m *= 2
        if m <= max(sizes):
            grown = grown.select(*base, *found, *[doubled(m, k).alias(f"s{k}") for k in lanes])
    each = grown.select("doc_id", "mark", F.explode(F.concat(*found)).alias("h"))
    return each.select("doc_id", "mark", F.lit(g).alias("g"), "h.*")


def candidates(docs: DataFrame, items: DataFrame) -> DataFrame | None:
    """doc_id, mark (hash of the row), item, n, start (where the item would begin), begin (of near)
    and near of every place at which a window is within the radius of one of an item."""
    prints = stored(item_prints(items), "prints")
    index = prints.select("item", "n", "g", "m", "shift", "print", F.posexplode(
        F.array(*parts(F.col("print")))).alias("part", "key"))
    kinds: dict[int, dict[int, tuple[int, int]]] = {}  # a few window sizes
    for r in prints.groupBy("g", "m").agg(F.max("n"), F.max("shift")).collect():
        kinds.setdefault(r["g"], {})[r["m"]] = r[2], r[3]
    index = stored(index, "index")
    keys: dict[tuple[int, int], list[list[int]]] = {}
    if index.count() <= KEYS_IN_PLAN:
        for r in index.select("g", "m", "part", "key").distinct().collect():
            keys.setdefault((r["g"], r["m"]), [[] for _ in PARTS])[r["part"]].append(r["key"])
    text = F.col("text").cast("string")
    texts = docs.select("doc_id", F.xxhash64("doc_id", text).alias("mark"),
                        split_words(text).alias("words")).select(
        "*", F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"))
    found = None
    for g, sizes in sorted(kinds.items()):
        part = _windows(texts, g, sizes, {m: keys.get((g, m)) for m in sizes})
        found = part if found is None else found.unionByName(part)
    if found is None:
        return None
    looked = found.select("*", F.posexplode(F.array(*parts(F.col("print")))).alias(
        "part", "key")).withColumnRenamed("print", "window")
    apart = F.col("window").bitwiseXOR(F.col("print"))
    first = F.array_position(F.array(*parts(apart)), F.lit(0).cast("long")) - 1
    met = looked.join(sized_ids(index), ["g", "m", "part", "key"]).where(
        (F.bit_count(apart) <= RADIUS) & (F.col("part") == first))
    begin = F.greatest(F.lit(0), F.col("line") * F.col("g") - F.col("back"))
    start = F.col("line") * F.col("g") - F.col("shift")
    return met.select("doc_id", "mark", "item", "n", start.alias("start"), F.struct(
        begin.alias("begin"), "near").alias("seen")).groupBy(
        "doc_id", "mark", "item", "n", "start").agg(F.first("seen").alias("seen")).select(
        "doc_id", "mark", "item", "n", "start", "seen.*")


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, mark, item_id, start_word, similarity: the best window of each leaked item."""
    items = numbered(benchmark)
    met = candidates(docs, items)
    kind = {"doc_id": docs.schema["doc_id"].dataType.simpleString(),
            "item_id": benchmark.schema["item_id"].dataType.simpleString()}
    if met is None:
        return docs.sparkSession.createDataFrame(
            [], f"doc_id {kind['doc_id']}, mark long, item_id {kind['item_id']}, "
                "start_word long, similarity double")
    weights = stored(item_weights(items), "weights")
    off = moved(F.col("n"))
    ends = F.col("begin") + F.size("near")  # a window past it is cut by the end of the text
    placed = met.select("doc_id", "mark", "item", "n", "start", "begin", "near", F.explode(
        F.sequence(F.col("start") - off, F.col("start") + off)).alias("a")).where(
        "a + n > 0").where((F.abs(F.col("a") - F.col("start")) <= F.floor(F.col("n") / 9) - 3)
                           | (F.col("a") == F.col("start")) | (F.col("a") < 0)
                           | ((F.col("a") + F.col("n") > ends) & (F.col("a") < ends)))
    start = F.greatest(F.lit(0), "a")
    cut = F.least(F.lit(0), "a")  # below 0 if the text begins within the item
    window = F.slice("near", start - F.col("begin") + 1, F.col("n") + cut)
    held = _held(placed.select("doc_id", "mark", "item", start.alias("start"),
                               window.alias("window")),
                 ["doc_id", "mark", "item", "start"], ["window"])
    both = held.select("doc_id", "mark", "item", "start",
                       shingles(F.col("window")).alias("own")).join(
        sized_ids(weights), "item")
    shared = F.filter("weighted", lambda x: F.array_contains("own", x["s"]))

    def total(pairs: Column) -> Column:
        return F.aggregate(pairs, F.lit(0.0), lambda s, x: s + x["w"])

    known = both.select("*", total(shared).alias("inner"), total(F.col("weighted")).alias("all"),
                        F.size(shared).alias("n_shared"))
    outer = F.col("all") + F.col("other") * (F.size("own") - F.col("n_shared"))
    scored = known.select("doc_id", "mark", "item_id", F.col("start").cast("long").alias("start"),
                          (F.col("inner") / outer).alias("similarity"))
    return scored.where(F.col("similarity") >= SIMILARITY).groupBy(
        "doc_id", "mark", "item_id").agg(
        F.max_by("start", F.struct("similarity", -F.col("start"))).alias("start_word"),
        F.max("similarity").alias("similarity"))


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of `docs` in which no item was found."""
    mark, = free_names(docs, "mark")
    found = stored(leaks(docs, benchmark).select(F.col("mark").alias(mark)).distinct(), "leaked")
    marked = docs.withColumn(mark, F.xxhash64("doc_id", F.col("text").cast("string")))
    return marked.join(sized_ids(found), mark, "left_anti").select(docs.columns)
