import itertools
import zlib

import numpy as np
import pytest
from edges import ROWS
from pyspark.sql import functions as F

from snapmart.llm import language_crf as crf


def test_posteriors_against_all_paths():
    rng = np.random.default_rng(1)
    n, k = 6, 3
    scores, moves, start = rng.normal(size=(n, k)), rng.normal(size=(k, k)), rng.normal(size=k)
    first = np.array([True, False, False, True, False, False])
    want = np.zeros((n, k))
    for path in itertools.product(range(k), repeat=n):
        total = sum(scores[t, label] + (start[label] if first[t] else moves[path[t - 1], label]) for t, label in enumerate(path))
        for t, label in enumerate(path):
            want[t, label] += np.exp(total)
    want /= want.sum(axis=1, keepdims=True)
    assert np.allclose(crf.posteriors(scores, first, moves, start), want)


def test_chains_longer_than_a_block():
    rng = np.random.default_rng(2)
    n, k = 500, 4
    scores, moves, start = 30 * rng.normal(size=(n, k)), 3 * rng.normal(size=(k, k)), rng.normal(size=k)
    first = np.zeros(n, bool)
    first[[0, 1, 63, 64, 65, 300]] = True
    got = crf.posteriors(scores, first, moves, start)
    begins = [*np.flatnonzero(first), n]
    for a, b in zip(begins, begins[1:]):
        forward = [start + scores[a]]
        for t in range(a + 1, b):
            forward.append(np.logaddexp.reduce(forward[-1][:, None] + moves, axis=0) + scores[t])
        backward = [np.zeros(k)]
        for t in range(b - 1, a, -1):
            backward.insert(0, np.logaddexp.reduce(moves + scores[t] + backward[0], axis=1))
        want = np.array(forward) + np.array(backward)
        want = np.exp(want - np.logaddexp.reduce(want, axis=1)[:, None])
        assert np.allclose(got[a:b], want, atol=1e-9)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet").cache()


@pytest.fixture(scope="module")
def model(docs):
    return crf.learn(docs)


def test_held_out_accuracy(docs, model):
    found = crf.identify(docs, model).join(docs.select("doc_id", "lang"), "doc_id").filter(crf.held_out(F.col("doc_id")))
    n, right = found.agg(F.count("*"), F.sum((F.col("lang") == F.col("lang_pred")).cast("int"))).first()
    assert n > 250 and right >= 0.98 * n
    assert found.filter("score < 0 or score > 1").count() == 0


def test_words_of_code_switched_text(docs, model):
    of = {lang: docs.filter((F.col("lang") == lang) & (F.length("text") > 800)).first().text for lang in ("en", "de", "fr")}
    words = {lang: crf.WORD.findall(text)[20:50] for lang, text in of.items()}
    text = " ".join(word for lang in ("en", "de", "fr") for word in words[lang])
    _, _, segments = crf.label_texts(model, [text])[0]
    labels = [lang for lang, _, n in segments for _ in range(n)]
    truth = [lang for lang in ("en", "de", "fr") for _ in words[lang]]
    assert sum(a == b for a, b in zip(labels, truth)) >= 0.85 * len(truth)


def test_batches_do_not_matter(model, monkeypatch):
    texts = [row[1] for row in ROWS]
    one_by_one = [crf.label_texts(model, [text])[0] for text in texts]
    assert [(a, round(b, 5), c) for a, b, c in crf.label_texts(model, texts)] == [(a, round(b, 5), c) for a, b, c in one_by_one]


def test_edges(spark, edge, empty, model):
    got = crf.identify(edge, model).collect()
    assert len(got) == len(ROWS)
    for r in got:
        assert (r.lang_pred == crf.UNKNOWN) == (r.doc_id in (3, 4, 5, 6) or r.doc_id is None and r.lang_pred == "und")
        assert 0 <= r.score <= 1
    held = {r.doc_id: r.h for r in edge.select("doc_id", crf.held_out(F.col("doc_id")).alias("h")).collect()}
    assert held == {i: i is not None and zlib.crc32(str(i).encode()) % 3 == 1 for i in held}
    assert crf.learn(empty) is None
    assert crf.identify(edge, None).filter("lang_pred = 'und' and score = 0").count() == len(ROWS)
    assert crf.identify(empty, model).count() == 0
    kept = crf.known_languages(edge, model)
    assert kept.columns == edge.columns
    assert {r.doc_id for r in kept.collect()} == {1, 2, 7, 8, 9, None} and kept.filter("text is null").count() == 0


def test_word_by_word_equals_blocks(monkeypatch):
    rng = np.random.default_rng(5)
    n, k = 300, 5
    scores, moves, start = 5 * rng.normal(size=(n, k)), rng.normal(size=(k, k)), rng.normal(size=k)
    first = rng.random(n) < 0.05
    first[0] = True
    blocks = crf.chain(scores, first, moves, start)
    monkeypatch.setattr(crf, "STATES", 0)
    words = crf.chain(scores, first, moves, start)
    assert np.allclose(blocks.beliefs(), words.beliefs(), atol=1e-12)
    assert np.allclose(blocks.moved(first), words.moved(first), atol=1e-9)


@pytest.mark.parametrize("numbers", [1 << 22, 4])
def test_gradient_against_all_paths(numbers, monkeypatch):
    monkeypatch.setattr(crf, "NUMBERS", numbers)
    rng = np.random.default_rng(6)
    different, k = ["ab", "cde", "abé"], 2
    place, labels = np.array([0, 1, 2, 0, 1]), np.array([0, 1, 1, 0, 1])
    first = np.array([True, False, False, True, False])
    bits = rng.integers(0, 2, (3, k)).astype(float)
    taught = crf.Taught(different, place, labels, first, bits)
    assert len(taught.groups) == (1 if numbers > 4 else 2)
    parts = [rng.normal(size=shape) for shape in ((crf.BUCKETS + 1, k), (k, k), (k, k), k)]
    parts[0][crf.BUCKETS] = 0
    buckets, starts = crf.hashed(different)
    owner = np.repeat(np.arange(3), np.diff([*starts, buckets.shape[1]]))

    def loss(grams, known, moves, start):
        word = np.array([sum(grams[row[owner == w]].sum(axis=0) for row in buckets) for w in range(3)]) + bits @ known
        total = 0.0
        for a, b in ((0, 3), (3, 5)):
            def score(path, a=a):
                own = start[path[0]] + sum(word[place[a + t], label] for t, label in enumerate(path))
                return own + sum(moves[x, y] for x, y in itertools.pairwise(path))
            total += np.logaddexp.reduce([score(p) for p in itertools.product(range(k), repeat=b - a)]) - score(labels[a:b])
        return total

    slopes = taught.slopes(*parts)
    used = np.unique(buckets[buckets < crf.BUCKETS])
    for i, at in [(0, (used[0], 0)), (0, (used[-1], 1)), *((p, c) for p in (1, 2) for c in np.ndindex(k, k)), (3, (0,)), (3, (1,))]:
        up, down = [part.copy() for part in parts], [part.copy() for part in parts]
        up[i][at] += 1e-5
        down[i][at] -= 1e-5
        assert abs((loss(*up) - loss(*down)) / 2e-5 - slopes[i][at]) < 1e-6


def test_seventy_languages(spark):
    letters = "abcdefghijklmnopqrstuvwxyz"
    rng = np.random.default_rng(7)
    rows = []
    for n in range(70):
        words = ["".join(rng.choice(list(letters), 5)) for _ in range(6)]
        rows += [(n * 30 + i, " ".join(rng.choice(words, 15)), f"l{n:02d}") for i in range(9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = crf.learn(docs)
    assert len(model.languages) == 70
    found = crf.identify(docs, model).collect()
    truth = {doc_id: lang for doc_id, _, lang in rows}
    assert sum(truth[r.doc_id] == r.lang_pred for r in found) >= 0.95 * len(rows)


def test_sample_is_bounded_in_all(spark, monkeypatch):
    rows = [(f"text {lang} {i}", f"l{lang}") for lang in range(6) for i in range(40 - lang)]
    docs = spark.createDataFrame(rows, "text string, lang string")
    sample = crf.training_sample(docs, docs_in_all=30)
    assert len(sample) == 30 and len({lang for lang, _ in sample}) == 6
    monkeypatch.setattr(crf, "LANGUAGES", 2)
    assert len({lang for lang, _ in crf.training_sample(docs)}) == 2
