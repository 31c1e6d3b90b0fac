import hashlib
import random

import pytest
from edges import ROWS, edge_docs, stored

from snapmart.llm import de_bruijn
from snapmart.llm.de_bruijn import remove_repeats, repeated_spans

SF_DIR = "/root/testdata/sf0.001"


def slow(rows, span):
    """doc_id, n_words, n_removed, kept_sha256 of every row, by a dictionary of all windows."""
    late = 1 << 63
    words = [(text or "").encode().split() for _, text in rows]
    first = {}
    for (doc_id, _), own in zip(rows, words):
        for at in range(len(own) - span + 1):
            window = tuple(own[at : at + span])
            first[window] = min(first.get(window, late), late if doc_id is None else doc_id)
    out = []
    for (doc_id, _), own in zip(rows, words):
        gone = set()
        for at in range(len(own) - span + 1):
            if first[tuple(own[at : at + span])] < (late if doc_id is None else doc_id):
                gone.update(range(at, at + span))
        kept = b" ".join(word for at, word in enumerate(own) if at not in gone)
        out.append((doc_id, len(own), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def fast(docs, **more):
    return sorted((tuple(row)[1:] for row in remove_repeats(docs, **more).collect()), key=str)


def texts(seed, n, alphabet):
    """Documents with shared passages, edited copies, and repeats within."""
    rng, out = random.Random(seed), []
    passages = [[rng.choice(alphabet) for _ in range(rng.randint(3, 30))] for _ in range(6)]
    for doc_id in range(n):
        words = []
        for _ in range(rng.randint(0, 5)):
            part = list(rng.choice(passages)) if rng.random() < 0.6 else [rng.choice(alphabet) for _ in range(rng.randint(0, 20))]
            if part and rng.random() < 0.3:
                part[rng.randrange(len(part))] = rng.choice(alphabet)
            words += part
        out.append((rng.choice([doc_id, doc_id, 3, None]), rng.choice([" ", "\n", " \t"]).join(words)))
    return out


@pytest.mark.parametrize(("span", "anchor", "alphabet"), [(5, 2, "abcdefgh"), (6, 6, "abcdefghijklmnop"), (3, 1, "ab"), (9, 4, "abc")])
def test_against_all_windows(spark, tmp_path, span, anchor, alphabet):
    rows = texts(span, 60, alphabet)
    docs = stored(spark, spark.createDataFrame(rows, "doc_id long, text string").repartition(5), tmp_path)
    assert fast(docs, span=span, anchor=anchor) == slow(rows, span)


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = [(row["doc_id"], row["text"]) for row in docs.select("doc_id", "text").collect()]
    found = fast(docs)
    assert found == slow(rows, 50) and any(row[2] for row in found)


def test_edges(edge, empty):
    rows = [row[:2] for row in ROWS]
    assert fast(edge) == slow(rows, 50)
    assert fast(edge, span=4, anchor=2) == slow(rows, 4)
    assert remove_repeats(empty).count() == 0


def test_texts_cut_into_chunks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(de_bruijn, "CHUNK", 16)
    rows = texts(1, 40, "abcdefgh")
    docs = stored(spark, spark.createDataFrame(rows, "doc_id long, text string"), tmp_path)
    assert fast(docs, span=5, anchor=2) == slow(rows, 5)


def test_a_shared_passage_is_one_span(spark, tmp_path):
    rng = random.Random(0)
    passage = [f"w{at}" for at in range(200)]
    rows = [(i, " ".join([*(f"{rng.random()}" for _ in range(30)), *passage, *(f"{rng.random()}" for _ in range(30))])) for i in range(9)]
    _, spans, _ = repeated_spans(stored(spark, spark.createDataFrame(rows, "doc_id long, text string"), tmp_path))
    found = sorted((row["rank"], row["start"], row["size"], row["first"], row["from_start"]) for row in spans.collect())
    assert found == [(i, 30, 151, 0, 30) for i in range(1, 9)]


def test_colliding_hashes_are_found_and_mended(spark, tmp_path, monkeypatch):
    def weak(words, seed, span, whole=de_bruijn.edges_of):
        return whole(words, seed, span) % 7 if seed == 0 else whole(words, seed, span)

    rows = texts(2, 40, "abcdefgh")
    docs = stored(spark, spark.createDataFrame(rows, "doc_id long, text string"), tmp_path)
    monkeypatch.setattr(de_bruijn, "edges_of", weak)
    monkeypatch.setattr(de_bruijn, "CHUNK", 8)
    assert fast(docs, span=5, anchor=2) == slow(rows, 5)
    monkeypatch.setattr(de_bruijn, "SEEDS", 1)
    with pytest.raises(RuntimeError):
        remove_repeats(docs, span=5, anchor=2).collect()


def test_clashing_columns(spark, tmp_path):
    docs = stored(spark, edge_docs(spark).withColumnsRenamed({"block": "size", "gram": "start", "fp": "first"}), tmp_path)
    assert fast(docs) == slow([row[:2] for row in ROWS], 50)
