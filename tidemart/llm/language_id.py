"""Language ID by unigram models whose segmentations are summed out.

Each language has a probability for every piece of a fixed public vocabulary. The probability of
a word is the sum, over all ways to cut it into pieces, of the product of their probabilities; a
forward pass gives it without listing the ways. A text's score for a language is the sum over its
words, plus the language's share of the training texts. Piece probabilities are fitted by
expectation maximisation over the distinct words of the training texts: expected piece counts
come from forward and backward passes.

Words are runs of letters, lower-cased, opened by the word mark; runs are cut every 32 letters,
so that no product underflows. A letter outside the vocabulary is an unknown piece with the
same small probability in all languages. All words of all texts count, in training and scoring.

Edge cases: a text that is null or has no letter is `und` with score 0; so is every text if
there is no training text; equal rows are all returned; ties go to the language that sorts
first; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import compress, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.llm.common import ship_code, stored
from tidemart.llm.words import U64, mix

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
MAX_PIECE = 8  # longer pieces of the vocabulary are left out
MAX_RUN = 32
FLOOR = 1e-8
HELD_WORDS = 100_000  # distinct words whose scores a task keeps
RUNS = re.compile(r"[^\W\d_]+")
_BASE = 0x9E3779B97F4A7C15
def _powers(base: int, n: int = 1 << 18) -> np.ndarray:
    steps = np.full(n, base, U64)
    steps[0] = 1
    return np.cumprod(steps, dtype=U64)


_UP, _DOWN = _powers(_BASE), _powers(pow(_BASE, -1, 1 << 64))


def letter_words(text: str | None) -> list[str]:
    """Runs of letters of a text, opened by the word mark and cut to MAX_RUN."""
    words = RUNS.findall(text.lower()) if text else []
    if max(map(len, words), default=0) > MAX_RUN or not all(map(str.isalpha, words)):
        words = ["".join(c for c in w if c.isalpha()) for w in words]
        return [(MARK if i == 0 else "") + w[i:i + MAX_RUN]
                for w in words for i in range(0, len(w), MAX_RUN)]
    return [MARK + w for w in words]


def run_words(run: str) -> list[str]:
    """`letter_words` of a single run."""
    return [MARK + run] if len(run) <= MAX_RUN and run.isalpha() else letter_words(run)


def _plain_table() -> bytes:
    """For each byte of cp1252: the small letter, a blank for what ends a run, or a mark."""
    table = bytearray(b" " * 256)
    for i in range(256):
        c = bytes([i]).decode("cp1252", "ignore")
        if c.isalpha():
            table[i:i + 1] = c.lower().encode("cp1252")
        elif RUNS.match(c):
            table[i] = 1  # numbers such as a raised two, which belong to runs
    return bytes(table)


_PLAIN = _plain_table()


def _letter_runs(text: str | None) -> str:
    """The runs of `letter_words` with a blank between them, neither marked nor cut."""
    if not text:
        return ""
    try:
        plain = text.encode("cp1252").translate(_PLAIN)
    except UnicodeEncodeError:
        plain = b"\1"
    if b"\1" in plain:
        return " ".join(RUNS.findall(text.lower()))
    return plain.decode("cp1252")


def run_numbers(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct runs of letters of the texts, the number of each run, and the texts' bounds."""
    split = pc.ascii_split_whitespace(
        pa.array([_letter_runs(t) for t in texts.to_pylist()], pa.large_string()))
    coded = split.flatten().dictionary_encode()
    return (coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False),
            split.offsets.to_numpy())


def load_pieces(path: str = VOCABULARY) -> list[str]:
    """Pieces of the vocabulary that letters and the word mark can form."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = (model.id_to_piece(i) for i in range(model.get_piece_size())
              if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)))
    return sorted({p.lower() for p in pieces if len(p) <= MAX_PIECE
                   and all(c.isalpha() for c in p.removeprefix(MARK)) and p.lower() != ""})


def _codes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Running hash sums over all letters of the words, and the words' starts and end."""
    starts = np.concatenate(([0], np.cumsum([len(w) for w in words], dtype=np.int64)))
    letters = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(U64)
    sums = np.concatenate((np.zeros(1, U64), np.cumsum(
        (letters + U64(1)) * _UP[:len(letters)], dtype=U64)))
    return sums, starts


class Pieces:
    """Numbers of vocabulary pieces at every place of many words; number 0 is unknown."""

    def __init__(self, pieces: list[str]):
        self.count = len(pieces) + 1
        self.by_length = {}
        for length in range(1, MAX_PIECE + 1):
            own = [(i + 1, p) for i, p in enumerate(pieces) if len(p) == length]
            sums, starts = _codes([p for _, p in own])
            keys = self._keys(sums, starts[:-1], length)
            order = np.argsort(keys)
            seen = np.zeros(1 << 18, bool)  # sorts out most places before the search
            seen[keys >> U64(46)] = True
            self.by_length[length] = (
                keys[order], np.array([i for i, _ in own], np.int64)[order], seen)

    @staticmethod
    def _keys(sums, starts, length):
        return mix((sums[starts + length] - sums[starts]) * _DOWN[starts])

    def places(self, words: list[str]) -> tuple[np.ndarray, list[np.ndarray]]:
        """Starts of the words, and for each length the piece at every place, -1 for none."""
        sums, starts = _codes(words)
        total, found = len(sums) - 1, []
        for length, (keys, numbers, seen) in self.by_length.items():
            ends = max(0, total - length + 1)
            own = np.full(total, 0 if length == 1 else -1, np.int64)
            if len(keys) and ends:
                wanted = mix((sums[length:length + ends] - sums[:ends]) * _DOWN[:ends])
                at = np.flatnonzero(seen[wanted >> U64(46)])
                wanted = wanted[at]
                near = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
                hit = keys[near] == wanted
                own[at[hit]] = numbers[near[hit]]
            found.append(own)
        return starts, found


def forward(pieces: Pieces, words: list[str], probs: np.ndarray) -> np.ndarray:
    """log probability of each word in each language, summed over all segmentations.

    `probs` has a row for each piece and a column for each language.
    """
    out = np.zeros((len(words), probs.shape[1]))
    for at in range(0, len(words), 4096):
        part = sorted(range(at, min(at + 4096, len(words))), key=lambda i: -len(words[i]))
        starts, found = pieces.places([words[i] for i in part])
        sizes = np.diff(starts)
        longest = int(sizes[0])
        # All pieces at all places, by their end and then by word; every place has one of a letter.
        word = np.repeat(np.arange(len(part)), sizes)
        begin = np.arange(len(word)) - starts[word]
        arcs = []
        for length, numbers in enumerate(found, 1):
            at_piece = np.flatnonzero(numbers >= 0)
            at_piece = at_piece[begin[at_piece] + length <= sizes[word[at_piece]]]
            own = word[at_piece]
            arcs.append(((begin[at_piece] + length) * len(part) + own, length, numbers[at_piece]))
        keys = np.concatenate([a[0] for a in arcs])
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        back = np.repeat([a[1] for a in arcs], [len(a[0]) for a in arcs])[order]
        chance = probs.take(np.concatenate([a[2] for a in arcs])[order], axis=0)
        first = np.flatnonzero(np.diff(keys, prepend=-1))
        cuts = np.searchsorted(keys, np.arange(1, longest + 2) * len(part))
        groups = np.searchsorted(first, cuts)
        source = keys - back * len(part)
        ways = np.ones(((longest + 1) * len(part), probs.shape[1]))
        for t in range(1, longest + 1):
            low, high = cuts[t - 1], cuts[t]
            flow = ways.take(source[low:high], axis=0) * chance[low:high]
            now = np.add.reduceat(flow, first[groups[t - 1]:groups[t]] - low, axis=0)
            ways[t * len(part):t * len(part) + len(now)] = now
        ways = ways.reshape(longest + 1, len(part), -1)
        for t in range(1, int(sizes[0]) + 1):
            own = np.flatnonzero(sizes == t)
            out[np.array(part)[own]] = np.log(ways[t][own])
    return out


def expected(pieces: Pieces, words: list[str], langs: np.ndarray, weights: np.ndarray,
             probs: np.ndarray) -> np.ndarray:
    """Expected piece counts by language, given each word's language and weight."""
    kinds = probs.shape[1]
    sums = np.zeros(probs.shape[0] * kinds)
    flat = np.append(probs.reshape(-1), 0.0)
    for at in range(0, len(words), 4096):
        part = sorted(range(at, min(at + 4096, len(words))), key=lambda i: -len(words[i]))
        starts, found = pieces.places([words[i] for i in part])
        sizes, lang = np.diff(starts), langs[part]
        longest = int(sizes[0])

        def arcs(t, lang=lang, starts=starts, sizes=sizes, found=found):
            live = int(np.searchsorted(-sizes, -t, side="right"))
            for length in range(1, min(MAX_PIECE, t) + 1):
                piece = found[length - 1][starts[:live] + t - length]
                yield length, live, np.where(piece < 0, len(flat) - 1, piece * kinds + lang[:live])

        ways = np.zeros((longest + 1, len(part)))
        ways[0] = 1
        for t in range(1, longest + 1):
            for length, live, place in arcs(t):
                ways[t, :live] += ways[t - length, :live] * flat[place]
        back = np.zeros((longest + 1, len(part)))
        back[sizes, np.arange(len(part))] = weights[part] / ways[sizes, np.arange(len(part))]
        for t in range(longest, 0, -1):
            for length, live, place in arcs(t):
                flow = flat[place] * back[t, :live]
                back[t - length, :live] += flow
                sums += np.bincount(place, ways[t - length, :live] * flow,
                                    minlength=len(flat))[:-1]
    return sums.reshape(probs.shape)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[tuple[str, str], int] = {}

    def flush():
        found = [(lang, word, n) for (lang, run), n in counts.items() for word in run_words(run)]
        out = pa.RecordBatch.from_arrays(
            [pa.array([f[0] for f in found], pa.string()),
             pa.array([f[1] for f in found], pa.string()),
             pa.array([f[2] for f in found], pa.int64())], names=["lang", "word", "n"])
        counts.clear()
        return out

    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            runs, ids, ends = run_numbers(part.column("text"))
            langs = part.column("lang").dictionary_encode()
            own = np.repeat(langs.indices.to_numpy(zero_copy_only=False), np.diff(ends))
            pairs, times = np.unique(own * len(runs) + ids.astype(np.int64), return_counts=True)
            names = langs.dictionary.to_pylist()
            for pair, n in zip(pairs.tolist(), times.tolist(), strict=True):
                key = names[pair // len(runs)], runs[pair % len(runs)]
                counts[key] = counts.get(key, 0) + n
            if len(counts) > 200_000:
                yield flush()
    yield flush()


def word_counts(train: DataFrame) -> DataFrame:
    """lang, word, n over all training texts."""
    return train.select("lang", "text").mapInArrow(
        _count_words, "lang string, word string, n long").groupBy("lang", "word").agg(
        F.sum("n").alias("n"))


def fit(counts: DataFrame, langs: list[str], names: list[str], rounds: int = 2) -> np.ndarray:
    """Piece probabilities, one row for each piece and one column for each language."""
    context = counts.sparkSession.sparkContext
    pieces = context.broadcast(Pieces(names))
    size = pieces.value.count
    probs = np.full((size, len(langs)), 1.0 / size)
    index = {lang: i for i, lang in enumerate(langs)}
    for _ in range(rounds):
        model = context.broadcast(probs)

        def gather(batches, model=model):
            sums = np.zeros(model.value.shape)
            for batch in batches:
                where = np.array([index[x] for x in batch.column("lang").to_pylist()], np.int64)
                sums += expected(pieces.value, batch.column("word").to_pylist(), where,
                                 batch.column("n").to_numpy().astype(float), model.value)
            piece, lang = np.nonzero(sums)
            yield pa.RecordBatch.from_arrays(
                [pa.array(piece), pa.array(lang), pa.array(sums[piece, lang])],
                names=["piece", "lang", "n"])

        found = counts.mapInArrow(gather, "piece long, lang long, n double").groupBy(
            "piece", "lang").agg(F.sum("n").alias("n")).collect()  # pieces times languages
        sums = np.full(probs.shape, 0.1)
        for row in found:
            sums[row["piece"], row["lang"]] += row["n"]
        sums[0] = 0
        probs = np.maximum(sums / sums.sum(axis=0), FLOOR)
    return probs


def _sums(values: np.ndarray, lists: list[list]) -> np.ndarray:
    """Sums of the rows of `values` that belong to each list, whose items they stand for."""
    if len(values) == len(lists) and all(map(len, lists)):
        return values
    out = np.zeros((len(lists), values.shape[1]))
    np.add.at(out, np.repeat(np.arange(len(lists)), [len(own) for own in lists]), values)
    return out


def _scorer(pieces, model, prior: np.ndarray, langs: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number: dict[str, int] = {}
        scores = np.zeros((0, len(langs)))
        counted = uses = np.zeros(0, np.int64)  # words of each run, and parts that held it
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                runs, ids, ends = run_numbers(part.column("text"))
                if len(number) > HELD_WORDS:  # runs met again stay, unless they are too many
                    again = uses > 1 if (uses > 1).sum() <= HELD_WORDS // 2 else uses < 0
                    number = {r: i for i, r in enumerate(compress(number, again))}
                    scores, counted = scores[again], counted[again]
                    uses = np.ones(len(number), np.int64)
                held = len(number)
                of_run = np.array([number.setdefault(r, len(number)) for r in runs], np.int64)
                if len(number) > held:
                    fresh = [run_words(r) for r in islice(number, held, None)]
                    scores = np.vstack((scores, _sums(forward(
                        pieces.value, [w for own in fresh for w in own], model.value), fresh)))
                    counted = np.append(counted, [len(own) for own in fresh])
                    uses = np.append(uses, np.zeros(len(fresh), np.int64))
                uses[of_run] += 1
                places = of_run[ids]
                sums = np.concatenate((np.zeros((1, len(langs))), np.cumsum(
                    scores[places], axis=0)))
                filled = np.concatenate(([0], np.cumsum(counted[places])))
                total = sums[ends[1:]] - sums[ends[:-1]] + prior
                best = total.argmax(axis=1)
                share = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
                some = filled[ends[1:]] > filled[ends[:-1]]
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"),
                    pa.array([langs[b] if s else "und"
                              for b, s in zip(best, some, strict=True)], pa.string()),
                    pa.array(np.where(some, np.minimum(share, 1.0), 0.0)),
                ], names=["doc_id", "lang_pred", "score"])

    return run


def predict(docs: DataFrame, path: str = VOCABULARY, rounds: int = 2) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row; fitted on the rows not held out."""
    ship_code(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    train = docs.where(~held_out(F.col("doc_id"))).where("lang is not null").select(
        F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    shares = {r["lang"]: r["count"] for r in train.groupBy("lang").count().collect()}
    langs = sorted(shares)
    if not langs:
        return texts.select("doc_id", held_out(F.col("doc_id")).alias("held_out"),
                            F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    names = load_pieces(path)
    probs = fit(stored(word_counts(train), "words"), langs, names, rounds)
    context = docs.sparkSession.sparkContext
    prior = np.log([shares[x] / sum(shares.values()) for x in langs])
    run = _scorer(context.broadcast(Pieces(names)), context.broadcast(probs), prior, langs)
    scored = texts.mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"),
                         "lang_pred", "score")
