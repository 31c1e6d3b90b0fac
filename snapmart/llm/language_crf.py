"""Language ID by a linear-chain conditional random field over the words of a text.

Every word is a node whose label is a language. Features are the n-grams of the word between boundary marks (those at a
mark are its affixes), hashed into BUCKETS, and the lexicons its training languages know it from; transitions between the
labels of neighbours are learned. Forward-backward gives each word's posterior, also in code-switched text; a document's
language is the one with the largest sum of posteriors, its score that sum's share.

The model is fitted on a bounded sample: SAMPLE_DOCS different texts of each language, SAMPLE_CHARS characters of each
from a hashed place, cut into segments that are shuffled into code-switched chains. Copies of a text count once. With many
languages each gets fewer texts, SAMPLE_ALL in all, and beyond LANGUAGES those with the most different texts are learned.
The sample is drawn in Spark; everything else (counts of languages, prediction) covers whole texts of all documents.

Prediction strings the documents of a batch into one chain whose label is forgotten where a document starts. Blocks of
the chain are multiplied side by side, a scan over blocks carries the state, and the blocks are then filled side by side,
so a text of any length costs the same per word. Where those matrices would be large (many labels, a very long text), the
words go one by one instead, with the same result.

Defined results: a text that is null or has no letters is `und` with score 0; so is every text if nothing can be learned.
Rows without a language teach nothing; a null id counts as not held out. Repeated rows get equal results. Ties go to the
first language in order. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapmart.llm.store import fresh, materialize, numbered, slices, without_rows

UNKNOWN = "und"
WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*")
SIZES = (2, 3, 4)
BUCKETS = 1 << 15
BLOCK = 64
#: Characters of text labelled at a time.
BATCH_CHARS = 200_000

SAMPLE_DOCS = 120
SAMPLE_CHARS = 2500
LEXICON_MIN = 3
#: Texts of all languages, and languages learned, at most; beyond these, those with the most different texts.
SAMPLE_ALL = 2400
LANGUAGES = 200
#: Labels and numbers up to which blocks of a chain are multiplied side by side, and numbers a fitting step holds.
BLOCK_LABELS = 16
STATES = 1 << 22
NUMBERS = 1 << 22
EPOCHS = 25
RATE = 0.1
RIDGE = 1e-5
SEED = 7


def hashed(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams (one row per size; BUCKETS where a window leaves its word) and where each word starts."""
    marked = "".join([f"\x02{word}\x03" for word in words])
    points = np.frombuffer(marked.encode("utf-32-le"), np.uint32).astype(np.uint64)
    starts = np.flatnonzero(points == 2)
    ends = np.flatnonzero(points == 3)
    room = np.repeat(ends, ends - starts + 1) - np.arange(len(points)) + 1
    buckets = np.full((len(SIZES), len(points)), BUCKETS, np.int32)
    rolled = points * np.uint64(0x9E3779B97F4A7C15)
    for size in range(2, max(SIZES) + 1):
        rolled = rolled.copy()
        rolled[: len(points) - size + 1] = (
            rolled[: len(points) - size + 1] ^ (rolled[: len(points) - size + 1] >> np.uint64(29))
        ) * np.uint64(0xBF58476D1CE4E5B9) + points[size - 1 :]
        if size in SIZES:
            whole = room >= size
            mixed = (rolled ^ (rolled >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
            buckets[SIZES.index(size), whole] = (mixed[whole] >> np.uint64(40)).astype(np.int64) % BUCKETS
    return buckets, starts


@dataclass
class Model:
    languages: list[str]
    grams: np.ndarray  # BUCKETS + 1 by languages; the last row is zero
    known: np.ndarray  # lexicons by languages
    lexicon: dict[str, int]  # word: its row of knows
    knows: np.ndarray  # words by languages, which of them know the word; the last row is of words that none knows
    moves: np.ndarray
    start: np.ndarray

    def emissions(self, words: list[str]) -> np.ndarray:
        buckets, starts = hashed(words)
        total = sum(np.add.reduceat(self.grams[row], starts, axis=0) for row in buckets)
        return total + in_lexicons(words, self.lexicon, self.knows) @ self.known


def in_lexicons(words: list[str], lexicon: dict[str, int], knows: np.ndarray) -> np.ndarray:
    rows = np.fromiter((lexicon.get(word, -1) for word in words), np.int64, len(words))
    return knows[rows].astype(np.float64)


@dataclass
class Chain:
    """What a chain gives: factors of its words, the step between neighbours, forward and backward vectors of sum 1."""

    factor: np.ndarray
    step: np.ndarray
    forward: np.ndarray
    backward: np.ndarray

    def beliefs(self) -> np.ndarray:
        both = self.forward * self.backward
        return both / both.sum(axis=1, keepdims=True)

    def moved(self, first: np.ndarray) -> np.ndarray:
        """How often each label is expected to follow each other one."""
        after = np.flatnonzero(~first)
        before, here = self.forward[after - 1], (self.factor * self.backward)[after]
        weight = np.einsum("ti,ti->t", before @ self.step, here)
        return self.step * ((before / weight[:, None]).T @ here)


def chain(emissions: np.ndarray, first: np.ndarray, moves: np.ndarray, start: np.ndarray) -> Chain:
    """Forward-backward over words strung together; first marks where a text starts.

    Blocks side by side need a matrix of all labels for every word; beyond STATES numbers of them the words go one by one.
    """
    n, k = emissions.shape
    factor = np.exp(emissions - emissions.max(axis=1, keepdims=True))
    step = np.exp(moves - moves.max())
    begin = np.exp(start - start.max())
    sweep = by_blocks if n * k * k <= STATES and k <= BLOCK_LABELS else by_words
    return Chain(factor, step, *sweep(factor, first, step, begin))


def by_words(factor: np.ndarray, first: np.ndarray, step: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n, k = factor.shape
    forward, backward = np.empty((n, k)), np.empty((n, k))
    even = state = np.full(k, 1 / k)
    for t in range(n):
        state = (begin if first[t] else state @ step) * factor[t]
        state = state / state.sum()
        forward[t] = state
    state = even
    for t in range(n - 1, -1, -1):
        backward[t] = state
        state = even if first[t] else step @ (factor[t] * state)
        state = state / state.sum()
    return forward, backward


def by_blocks(factor: np.ndarray, first: np.ndarray, step: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n, k = factor.shape
    blocks = -(-n // BLOCK)
    matrices = np.broadcast_to(np.eye(k), (blocks * BLOCK, k, k)).copy()
    matrices[:n] = np.where(first[:, None, None], np.broadcast_to(begin, (k, k)), step)
    matrices[:n] *= factor[:, None, :]
    matrices = matrices.reshape(blocks, BLOCK, k, k)
    whole = matrices[:, 0]
    for at in range(1, BLOCK):
        whole = whole @ matrices[:, at]
        whole = whole / whole.max(axis=(1, 2), keepdims=True)
    forward, backward = np.empty((blocks, BLOCK, k)), np.empty((blocks, BLOCK, k))
    into, out = np.empty((blocks, k)), np.empty((blocks, k))
    state = np.full(k, 1 / k)
    for b in range(blocks):
        into[b] = state
        state = state @ whole[b]
        state = state / state.sum()
    state = np.full(k, 1 / k)
    for b in range(blocks - 1, -1, -1):
        out[b] = state
        state = whole[b] @ state
        state = state / state.sum()
    state = into
    for at in range(BLOCK):
        state = np.einsum("bi,bij->bj", state, matrices[:, at])
        state = state / state.sum(axis=1, keepdims=True)
        forward[:, at] = state
    state = out
    for at in range(BLOCK - 1, -1, -1):
        backward[:, at] = state
        state = np.einsum("bij,bj->bi", matrices[:, at], state)
        state = state / state.sum(axis=1, keepdims=True)
    return forward.reshape(-1, k)[:n], backward.reshape(-1, k)[:n]


def posteriors(emissions: np.ndarray, first: np.ndarray, moves: np.ndarray, start: np.ndarray) -> np.ndarray:
    return chain(emissions, first, moves, start).beliefs()


def indexed(words: list[str]) -> tuple[list[str], np.ndarray]:
    """The different words and the place of each word among them."""
    place = {word: i for i, word in enumerate(dict.fromkeys(words))}
    return list(place), np.fromiter(map(place.__getitem__, words), np.int64, len(words))


def fit(sample: list[tuple[str, str]], epochs: int = EPOCHS) -> Model | None:
    """The model of a sample of (language, text), by full-batch gradient steps of adaptive size."""
    languages = sorted({lang for lang, _ in sample})
    rng = np.random.default_rng(SEED)
    segments = []
    for lang, text in sample:
        words = WORD.findall(text.lower())
        at = 0
        while at < len(words):
            size = int(rng.integers(5, 50))
            segments.append((languages.index(lang), words[at : at + size]))
            at += size
    if not segments:
        return None
    segments = [segments[i] for i in rng.permutation(len(segments))]
    words = [word for _, part in segments for word in part]
    labels = np.repeat([label for label, _ in segments], [len(part) for _, part in segments])
    first = np.zeros(len(words), bool)
    lengths = np.cumsum([0] + [len(part) for _, part in segments[:-1]])
    first[lengths[::10]] = True  # ten segments make a chain
    different, place = indexed(words)
    k = len(languages)
    seen = np.zeros((len(different), k), np.int32)
    np.add.at(seen, (place, labels), 1)
    common = np.flatnonzero((seen >= LEXICON_MIN).any(axis=1))
    lexicon = {different[i]: row for row, i in enumerate(common)}
    knows = np.append(seen[common] >= LEXICON_MIN, np.zeros((1, k), bool), axis=0)
    taught = Taught(different, place, labels, first, in_lexicons(different, lexicon, knows))
    parts = [np.zeros((BUCKETS + 1, k)), np.zeros((k, k)), np.zeros((k, k)), np.zeros(k)]
    squares = [np.zeros_like(part) for part in parts]
    for _ in range(epochs):
        for part, square, slope in zip(parts, squares, taught.slopes(*parts)):
            slope = slope / len(words) + RIDGE * part
            square += slope**2
            part -= RATE * slope / np.sqrt(square + 1e-16)
    parts[0][BUCKETS] = 0
    grams, known, moves, start = (np.round(part, 5) for part in parts)
    return Model(languages, grams.astype(np.float32), known, lexicon, knows, moves, start)


class Taught:
    """Words whose labels are known, strung into chains; place is that of each word among the different ones."""

    def __init__(self, different: list[str], place: np.ndarray, labels: np.ndarray, first: np.ndarray, bits: np.ndarray):
        self.place, self.labels, self.first, self.bits = place, labels, first, bits
        self.buckets, self.starts = hashed(different)
        self.owner = np.repeat(np.arange(len(different)), np.diff(np.append(self.starts, self.buckets.shape[1])))
        # Whole chains at a time, so that what a step holds does not grow with words by labels.
        begins, room = np.flatnonzero(first), max(NUMBERS // bits.shape[1], 1)
        cuts = begins[np.append(True, np.diff(begins // room) > 0)]
        self.groups = list(zip(cuts, np.append(cuts[1:], len(place))))

    def slopes(self, grams: np.ndarray, known: np.ndarray, moves: np.ndarray, start: np.ndarray) -> list[np.ndarray]:
        """Gradient of minus the log likelihood of the labels."""
        k = len(start)
        scores = sum(np.add.reduceat(grams[row], self.starts, axis=0) for row in self.buckets) + self.bits @ known
        wrong, of_moves, of_start = np.zeros_like(scores), np.zeros((k, k)), np.zeros(k)
        for a, b in self.groups:
            place, labels, first = self.place[a:b], self.labels[a:b], self.first[a:b]
            found = chain(scores[place], first, moves, start)
            error = found.beliefs()
            error[np.arange(b - a), labels] -= 1
            of_moves += found.moved(first)
            after = np.flatnonzero(~first)
            np.subtract.at(of_moves, (labels[after - 1], labels[after]), 1)
            of_start += error[first].sum(axis=0)
            for label in range(k):
                wrong[:, label] += np.bincount(place, error[:, label], len(wrong))
        slope = np.zeros_like(grams)
        for row in self.buckets:
            for label in range(k):
                slope[:, label] += np.bincount(row, wrong[self.owner, label], BUCKETS + 1)
        slope[BUCKETS] = 0
        return [slope, self.bits.T @ wrong, of_moves, of_start]


def held_out(id_: Column) -> Column:
    return F.coalesce(F.crc32(id_.cast("string")) % 3 == 1, F.lit(False))


def training_sample(
    docs: DataFrame, docs_per_language: int = SAMPLE_DOCS, chars: int = SAMPLE_CHARS, docs_in_all: int = SAMPLE_ALL
) -> list[tuple[str, str]]:
    """(language, text) of a bounded number of different texts per language and in all. docs: text, lang."""
    labelled = docs.filter("lang is not null and text is not null").withColumn("key", F.xxhash64("text"))
    counts = materialize(labelled.groupBy("lang").agg(F.approx_count_distinct("key").alias("n")))
    languages = counts.count()
    if languages > LANGUAGES:
        counts, languages = materialize(counts.orderBy(F.desc("n"), "lang").limit(LANGUAGES)), LANGUAGES
    each = min(docs_per_language, docs_in_all // max(languages, 1))
    # Twice the wanted number are expected, so that chance leaves enough; one row per language and text.
    wanted = 2.0 * each if each >= docs_per_language else 2.0 * each + 20
    share = F.least(F.lit(1.0), wanted / F.col("n"))
    drawn = labelled.join(F.broadcast(counts), "lang").filter(F.pmod(F.xxhash64(F.col("key")), F.lit(1 << 24)) < share * (1 << 24))
    place = F.pmod(F.col("key"), F.greatest(F.length("text") - chars, F.lit(1)).cast("long")).cast("int") + 1
    drawn = drawn.groupBy("lang", "key").agg(F.max(F.substring("text", place, F.lit(chars))).alias("text"))
    taken: dict[str, list[str]] = {}
    for row in drawn.orderBy("lang", "key").collect():
        taken.setdefault(row["lang"], []).append(row["text"])
    return [(lang, text) for lang, texts in taken.items() for text in texts[:each]]


def label_texts(model: Model, texts: list[str | None]) -> list[tuple[str, float, list[tuple[str, int, int]]]]:
    """Language, score, and runs of equally labelled words (language, first word, words) of each text."""
    found = [WORD.findall(text.lower()) if text else [] for text in texts]
    sizes = np.array([len(words) for words in found])
    out: list = [(UNKNOWN, 0.0, [])] * len(texts)
    filled = np.flatnonzero(sizes)
    if not len(filled):
        return out
    words = [word for part in found for word in part]
    different, place = indexed(words)
    begins = np.cumsum(np.append(0, sizes[filled][:-1]))
    first = np.zeros(len(words), bool)
    first[begins] = True
    belief = posteriors(model.emissions(different)[place], first, model.moves, model.start)
    sums = np.add.reduceat(belief, begins, axis=0)
    best = sums.round(9).argmax(axis=1)
    labels = belief.argmax(axis=1)
    runs = np.flatnonzero(first | np.append(True, labels[1:] != labels[:-1]))
    run_sizes = np.diff(np.append(runs, len(words)))
    of_doc = np.searchsorted(runs, np.append(begins, len(words)))
    for i, doc in enumerate(filled):
        own = range(of_doc[i], of_doc[i + 1])
        segments = [(model.languages[labels[runs[r]]], int(runs[r] - begins[i]), int(run_sizes[r])) for r in own]
        share = float(sums[i, best[i]] / sizes[doc])
        out[doc] = (model.languages[best[i]], min(max(round(share, 6), 0.0), 1.0), segments)
    return out


def predict(model: Model | None):
    names = ("lang", "first_word", "n_words")
    segments = pa.list_(pa.struct(list(zip(names, (pa.string(), pa.int32(), pa.int32())))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            chars = np.cumsum(pc.utf8_length(part["text"].fill_null("")).to_numpy()) // BATCH_CHARS
            ends = [0, *(np.flatnonzero(np.diff(chars)) + 1).tolist(), part.num_rows]
            for own in (part.slice(a, b - a) for a, b in zip(ends, ends[1:])):
                texts = own["text"].to_pylist()
                found = label_texts(model, texts) if model else [(UNKNOWN, 0.0, [])] * len(texts)
                lang, score, runs = zip(*found)
                told = [[dict(zip(names, segment)) for segment in own_runs] for own_runs in runs]
                columns = [own["row_id"], own["doc_id"], pa.array(lang), pa.array(score), pa.array(told, segments)]
                yield pa.RecordBatch.from_arrays(columns, names=["row_id", "doc_id", "lang_pred", "score", "segments"])

    return run


def identify(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: row_id, doc_id, lang_pred, score, segments."""
    row = fresh(docs, "row")
    texts = numbered(docs, row).select(
        F.col(row).alias("row_id"), F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")
    )
    kind = texts.schema["doc_id"].dataType.simpleString()
    segments = "array<struct<lang:string,first_word:int,n_words:int>>"
    return texts.mapInArrow(
        predict(model), f"row_id long, doc_id {kind}, lang_pred string, score double, segments {segments}"
    )


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model | None:
    """The model of the documents that are not held out; null if none has a language and letters."""
    taught = docs.filter(~held_out(F.col(id_col))).select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    sample = training_sample(taught)
    return fit(sample) if sample else None


def known_languages(docs: DataFrame, model: Model | None, min_score: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents whose language is known with the score, with all their columns; docs must be a stored table."""
    found = identify(docs, model, id_col, text_col)
    rejected = found.filter((F.col("lang_pred") == UNKNOWN) | (F.col("score") < min_score)).select("row_id")
    return without_rows(docs, rejected)
