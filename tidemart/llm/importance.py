"""Quality by importance resampling with hashed n-gram models.

Two generative models over hashed unigrams and bigrams are counted: the target model from texts
labelled good, the raw model from all texts. A document's log ratio is the sum over its n-grams of
log p_target - log p_raw. That sum spans thousands, beside which Gumbel noise is nothing and drawing
would be sorting. Neighbouring n-grams are far from independent, so the weights are tempered: a text
of n n-grams counts as `WEIGHT_OF` times the root of n independent ones, and its log weight is
`WEIGHT_OF` times the sum over the root of n.

Toxic texts differ from good ones in few words, which a mean over all words drowns. They have a
model of their own: in how many toxic and in how many good labelled texts an n-gram occurs; a
document's toxic score is its most telling n-gram, in log odds of the toxic class. A labelled
document is scored without its own counts. The score is a factor of the weight: the log weight
falls by `TOXIC_WEIGHT` times what the score has above that of all but `UNUSUAL` of the good labels.

Adding Gumbel noise and taking the k largest keys draws k documents without replacement in
proportion to their weights. k is a share of all rows (`rate`) or, without one, the number of
documents whose weight is above a cut that all but `MAX_LOST` of the good labels pass.

Both models are fitted on a bounded sample of the labels (`MAX_LABELS`, those of smallest hash);
the raw model, the weights, the cuts and the selection cover all documents and all labels. The
k-th key and the cuts are found by counting in ranges, so nothing is sorted in one task.

Edge cases: a null or empty text has weight 0; a null doc_id is never labelled; several labels of
a document count as good only if all are; rows that tie with the k-th key are all taken, and equal
rows have the same noise; without toxic or without good labels the toxic factor is 1; without a
rate, and without good or without bad and toxic labels, nothing is rejected; a rate outside 0 to 1
is refused; an empty table gives no rows; other columns are ignored by `scored` and kept by
`resample`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.llm.common import ship_code, sized_ids, stored
from tidemart.llm.words import BLANKS, U64, classes, mix, slices, utf8, word_hashes

BUCKETS = 10_000
MAX_LABELS = 50_000
MAX_LOST = 0.001  # share of the good labels that may lie below the cut
UNUSUAL = 0.002  # share of the good labels whose toxic score lowers their weight
SLICES = 20
PLACES = 1 << 18  # counters of the toxic model; an n-gram has one in each of two halves
PRIOR = 10.0  # texts an n-gram is taken to be in besides those counted, at the classes' shares
WEIGHT_OF = 3.0  # a text of n n-grams counts as so many times the root of n
TOXIC_WEIGHT = 40.0  # how often its most telling n-gram counts beyond those of good labels
NO_SCORE = -99.0  # the toxic score of a text without words
FINE = 1 << 20  # steps of a whole in which keys, weights and scores are counted
_MARKS = bytes(c for c in range(33, 127) if not chr(c).isalnum())
_TABLE = classes(BLANKS + bytes(range(9)) + bytes(range(14, 32)) + b"\x7f", _MARKS)
_STEP = U64(0xC2B2AE3D27D4EB4F)


def grams(texts: list[bytes]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Chunks (index of first text, hashes of its unigrams and bigrams, which are real, bounds)."""
    for at, hashes, bounds in word_hashes(texts, _TABLE):
        both = np.zeros(2 * len(hashes), U64)
        both[0::2] = hashes
        both[1:-1:2] = mix(hashes[:-1] * _STEP + hashes[1:])
        real = np.ones(len(both), bool)
        real[2 * bounds[1:][bounds[1:] > 0] - 1] = False  # no pair reaches into the next text
        yield at, both, real, 2 * bounds


def features(texts: list[bytes]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Chunks (index of first text, buckets, bounds) of unigrams and bigrams of each text."""
    for at, both, real, bounds in grams(texts):
        yield at, _buckets(both, real), bounds


def _buckets(both: np.ndarray, real: np.ndarray) -> np.ndarray:
    return np.where(real, (both % U64(BUCKETS)).astype(np.int64), -1)


def _places(both: np.ndarray) -> np.ndarray:
    """The two counters of each n-gram in the toxic model."""
    last = U64(PLACES - 1)
    return np.stack((both & last, ((both >> U64(32)) & last) + U64(PLACES))).astype(np.int64)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums = np.zeros((2, BUCKETS), np.int64)
    for batch in slices(batches):
        good = np.array(batch.column("good").to_pylist(), dtype=object) == 1
        for at, buckets, bounds in features(utf8(batch.column("text"))):
            n = len(bounds) - 1
            sums[1] += np.bincount(buckets + 1, minlength=BUCKETS + 1)[1:]
            chosen = np.repeat(good[at:at + n], np.diff(bounds))
            sums[0] += np.bincount(buckets[chosen] + 1, minlength=BUCKETS + 1)[1:]
    if sums.any():
        parts = [(m, s, c.tobytes()) for m in (0, 1)
                 for s, c in enumerate(np.split(sums[m], SLICES))]
        yield pa.RecordBatch.from_arrays(
            [pa.array([p[0] for p in parts], pa.int32()),
             pa.array([p[1] for p in parts], pa.int32()),
             pa.array([p[2] for p in parts], pa.binary())], names=["model", "slice", "counts"])


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[tuple[int, int], np.ndarray] = {}
    for batch in batches:
        for m, s, c in zip(*(x.to_pylist() for x in batch.columns), strict=True):
            own = np.frombuffer(c, np.int64)
            sums[m, s] = sums[m, s] + own if (m, s) in sums else own
    if sums:
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in sums], pa.int32()),
             pa.array([k[1] for k in sums], pa.int32()),
             pa.array([c.tobytes() for c in sums.values()], pa.binary())],
            names=["model", "slice", "counts"])


def judged(labels: DataFrame) -> DataFrame:
    """doc_id, good (1 or 0: quality 1 and not toxic in all labels) and toxic (1 or 0: toxic in
    any) of every labelled document."""
    toxic = F.coalesce("toxic", F.lit(0)) != 0
    good = F.coalesce(F.col("quality") == 1, F.lit(False)) & ~toxic
    return labels.where("doc_id is not null").where(F.col("quality").isNotNull() | toxic).groupBy(
        "doc_id").agg(F.min(good.cast("int")).alias("good"),
                      F.max(toxic.cast("int")).alias("toxic"))


def label_sample(labels: DataFrame, limit: int = MAX_LABELS) -> DataFrame:
    """At most `limit` rows of `judged`, for the fit."""
    return judged(labels).orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)


def _count_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums = np.zeros((2, 2 * PLACES), np.int64)
    for batch in slices(batches):
        toxic = batch.column("toxic").to_numpy()
        for at, both, real, bounds in grams(utf8(batch.column("text"))):
            for i, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True), at):
                sums[toxic[i], np.unique(_places(both[a:b][real[a:b]]))] += 1
    if sums.any():
        parts = [(m, s, c.tobytes()) for m in (0, 1) for s, c in enumerate(np.split(sums[m], 16))]
        yield pa.RecordBatch.from_arrays(
            [pa.array([p[0] for p in parts], pa.int32()),
             pa.array([p[1] for p in parts], pa.int32()),
             pa.array([p[2] for p in parts], pa.binary())], names=["model", "slice", "counts"])


def toxic_ratios(docs: DataFrame, sample: DataFrame) -> np.ndarray | None:
    """Log odds of the toxic class over the good one at each counter, for a document that is not
    in the sample, a good and a toxic one of it; None if a class is missing."""
    classes_ = sample.where("good = 1 or toxic = 1")
    sizes = {r["toxic"]: r["count"] for r in classes_.groupBy("toxic").count().collect()}
    if len(sizes) < 2:
        return None
    known = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(
        F.broadcast(classes_), "doc_id").select("text", "toxic")
    spec = "model int, slice int, counts binary"
    parts = known.mapInArrow(_count_texts, spec).repartition(32, "model", "slice")
    sums = np.zeros((2, 16, PLACES // 8))
    for row in parts.mapInArrow(_add, spec).collect():  # 32 rows
        sums[row["model"], row["slice"]] = np.frombuffer(row["counts"], np.int64)
    good, toxic = sums.reshape(2, 2 * PLACES)
    share = sizes[1] / (sizes[0] + sizes[1])

    def odds(own_good: int, own_toxic: int) -> np.ndarray:
        return np.log((np.maximum(toxic - own_toxic, 0) + PRIOR * share)
                      / (np.maximum(good - own_good, 0) + PRIOR * (1 - share))
                      ) - np.log(share / (1 - share))

    return np.stack((odds(0, 0), odds(1, 0), odds(0, 1))).astype(np.float32)


def log_ratios(docs: DataFrame, sample: DataFrame) -> np.ndarray:
    """log p_target - log p_raw of each bucket; `sample` is bounded, so it is broadcast."""
    spec = "model int, slice int, counts binary"
    known = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(
        F.broadcast(sample), "doc_id", "left").select("text", "good")
    parts = known.mapInArrow(_count, spec).repartition(2 * SLICES, "model", "slice")
    sums = np.zeros((2, SLICES, BUCKETS // SLICES))
    for row in parts.mapInArrow(_add, spec).collect():  # 2 * SLICES rows
        sums[row["model"], row["slice"]] = np.frombuffer(row["counts"], np.int64)
    target, raw = sums.reshape(2, BUCKETS) + 1.0
    return np.log(target / target.sum()) - np.log(raw / raw.sum())


def _weigher(ratios: np.ndarray, odds):
    table = np.append(ratios, 0.0)  # the last place is for index -1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            weights, sizes = np.zeros(batch.num_rows), np.zeros(batch.num_rows, np.int64)
            scores = np.full(batch.num_rows, NO_SCORE)
            kinds = batch.column("class").to_numpy()
            for at, both, real, bounds in grams(utf8(batch.column("text"))):
                sums = np.concatenate(([0.0], np.cumsum(table[_buckets(both, real)])))
                n = len(bounds) - 1
                sizes[at:at + n] = np.diff(bounds) // 2
                root = np.sqrt(np.maximum(2 * sizes[at:at + n] - 1, 1))
                weights[at:at + n] = WEIGHT_OF * (sums[bounds[1:]] - sums[bounds[:-1]]) / root
                if odds is not None and len(both):
                    some = np.flatnonzero(np.diff(bounds))
                    kind = np.repeat(kinds[at:at + n], np.diff(bounds))
                    one, two = _places(both)
                    found = np.minimum(odds.value[kind, one], odds.value[kind, two])
                    scores[at + some] = np.maximum.reduceat(
                        np.where(real, found, NO_SCORE), bounds[:-1][some])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("mark"), pa.array(sizes),
                 pa.array(weights), pa.array(scores)],
                names=["doc_id", "mark", "n_words", "log_ratio", "toxic_score"])

    return run


def gumbel_key(weight: Column, mark: Column) -> Column:
    """A log weight with Gumbel noise from a 64-bit hash."""
    uniform = (F.shiftrightunsigned(mark, 11) + F.lit(0.5)) / F.lit(float(1 << 53))
    return weight - F.log(-F.log(uniform))


def scored(docs: DataFrame, sample: DataFrame, seed: int = 11) -> DataFrame:
    """doc_id, n_words, log_ratio (tempered), toxic_score and mark (hash of row and seed) of every
    row; `sample` has doc_id, good and perhaps toxic."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    text = F.col("text").cast("string")
    odds, known = None, F.lit(0)
    marked = docs.select("doc_id", text.alias("text"),
                         F.xxhash64("doc_id", text, F.lit(seed)).alias("mark"))
    if "toxic" in sample.columns and (odds := toxic_ratios(docs, sample)) is not None:
        odds = docs.sparkSession.sparkContext.broadcast(odds)
        known = F.when(F.col("toxic") == 1, 2).when(F.col("good") == 1, 1).otherwise(0)
        marked = marked.join(F.broadcast(sample), "doc_id", "left")
    return marked.select("doc_id", "text", "mark", known.alias("class")).mapInArrow(
        _weigher(log_ratios(docs, sample), odds),
        f"doc_id {kind}, mark long, n_words long, log_ratio double, toxic_score double")


def weighted(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, n_words, log_weight and gumbel_key of the rows of `scored`; `labels` is `judged`."""
    score = fine(F.col("toxic_score"))
    good = rows.join(labels.where("good = 1"), "doc_id").select(score.alias("code"))
    usual = kth_largest(good, int(UNUSUAL * good.count()) + 1)
    excess = F.lit(0.0) if usual is None else F.greatest(
        F.col("toxic_score") - F.lit(usual / FINE), F.lit(0.0))
    weight = F.col("log_ratio") - F.lit(TOXIC_WEIGHT) * excess
    return rows.select("doc_id", "n_words", weight.alias("log_weight"),
                       gumbel_key(weight, F.col("mark")).alias("gumbel_key"))


def fine(value: Column) -> Column:
    return F.floor(value * FINE).cast("long")


def cut(labelled: DataFrame) -> int | None:
    """The highest weight, in steps of `fine`, below which at most MAX_LOST of the good labels
    lie; `labelled` has all labelled documents. None if good or if bad and toxic labels are
    missing."""
    good = labelled.where("good = 1")
    n, others = labelled.agg(F.count_if(F.col("good") == 1), F.count_if(F.col("good") == 0)).first()
    if not n or not others:
        return None
    return kth_largest(good.select(fine(F.col("log_weight")).alias("code")),
                       n - int(MAX_LOST * n))


def kth_largest(values: DataFrame, k: int, ranges: int = 4096) -> int | None:
    """The k-th largest of the long column `code`, by counting in ever smaller ranges."""
    low, high = values.agg(F.min("code"), F.max("code")).first()
    if low is None or k <= 0:
        return None
    while low < high:
        width = -(-(high - low + 1) // ranges)
        counts = values.where(F.col("code").between(low, high)).groupBy(
            F.floor((F.col("code") - low) / width).alias("r")).count().collect()
        for row in sorted(counts, key=lambda r: -r["r"]):
            if row["count"] >= k or row["r"] == min(c["r"] for c in counts):
                low, high = low + row["r"] * width, min(high, low + (row["r"] + 1) * width - 1)
                break
            k -= row["count"]
    return low


def selected(
    docs: DataFrame, labels: DataFrame, seed: int = 11, rate: float | None = None
) -> DataFrame:
    """doc_id, n_words, log_weight, gumbel_key, kept of every row."""
    if rate is not None and not 0.0 <= rate <= 1.0:
        raise ValueError("rate must be in 0..1")
    ship_code(docs.sparkSession)
    sample = stored(label_sample(labels), "sample")
    labels = stored(judged(labels), "labels")
    weighed = weighted(stored(scored(docs, sample, seed), "weights"), labels)
    if rate is not None:
        k = round(rate * weighed.count())
    else:
        labelled = weighed.select("doc_id", "log_weight").join(labels, "doc_id")
        least = cut(stored(labelled.select("log_weight", "good"), "labelled"))
        if least is None:
            return weighed.withColumn("kept", F.lit(True))
        k = weighed.where(fine(F.col("log_weight")) >= least).count()
    code = fine(F.col("gumbel_key"))
    least = kth_largest(weighed.select(code.alias("code")), k)
    return weighed.withColumn("kept", F.lit(False) if least is None else code >= least)


def resample(
    docs: DataFrame, labels: DataFrame, seed: int = 11, rate: float | None = None
) -> DataFrame:
    """The rows of `docs` that the resampling takes; rows without a doc_id all stay, and so do
    all rows of a doc_id of which one is taken."""
    drawn = selected(docs, labels, seed, rate)
    gone = stored(drawn.where("doc_id is not null").groupBy("doc_id").agg(
        F.max("kept").alias("kept")).where("not kept").select("doc_id"), "rejected")
    return docs.join(sized_ids(gone), "doc_id", "left_anti").select(docs.columns)
