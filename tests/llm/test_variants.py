import random
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from edges import ROWS, edge_docs, stored

from snapmart.llm import variants
from snapmart.llm.variants import near_words, neighbours, pairs_within_one, spelling_variants

SF_DIR = "/root/testdata/sf0.001"


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def slow_words(rows):
    words = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            words[run] += 1
    return {word: n for word, n in words.items() if len(word) >= 5 and n >= 3}


def slow(rows):
    words = slow_words(rows)
    wild = {}
    for word in words:  # near words share a word with one letter masked or taken out
        for i in range(len(word)):
            wild.setdefault(word[:i] + "?" + word[i + 1 :], set()).add(word)
            wild.setdefault(word[:i] + word[i + 1 :], set()).add(word)
        wild.setdefault(word, set()).add(word)
    near = {word: set() for word in words}
    for group in wild.values():
        for a in group:
            near[a].update(b for b in group if one_edit(a, b))
    forms = {}
    for word, others in near.items():
        best = min(others, key=lambda x: (-words[x], x), default=None)
        forms[word] = best if best and words[best] >= 2 * words[word] else None
    out = []
    for word, n in words.items():
        root = word
        while forms[root]:
            root = forms[root]
        out.append((word, forms[word], root, n, len(near[word]), words.get(forms[word])))
    return sorted(out)


def fast(docs, **more):
    return sorted(map(tuple, spelling_variants(docs, **more).collect()))


def drawn(seed, n, alphabet, low=5, high=9):
    rng = random.Random(seed)
    return sorted({"".join(rng.choice(alphabet) for _ in range(rng.randint(low, high))) for _ in range(n)})


@pytest.mark.parametrize("alphabet", ["ab", "abcÿ", "abcdefgh"])
def test_one_list_against_all_pairs(alphabet):
    words = drawn(1, 150, alphabet)
    same = np.zeros(len(words), np.int64)
    found = set()
    for size in range(5, 10):  # one shard of all places, for every length of the shorter word
        a, b = pairs_within_one(words, same, same + size, same, same + size + 1)
        found.update(zip(a.tolist(), b.tolist()))
    assert found == {(i, j) for i, a in enumerate(words) for j, b in enumerate(words) if one_edit(a, b)}


@pytest.mark.parametrize("shard_words", [2, 7, 4096])
def test_shards_against_all_pairs(spark, shard_words):
    words = drawn(2, 300, "abc")
    counts = {word: 3 + i % 11 for i, word in enumerate(words)}
    found = neighbours(spark.createDataFrame(list(counts.items()), "word string, n long"), shard_words)
    want = {}
    for a in words:
        near = [b for b in words if one_edit(a, b)]
        if near:
            want[a] = (len(near), *min((-counts[b], b) for b in near))
    assert {row["word"]: (row["n_near"], -row["best_n"], row["best"]) for row in found.collect()} == want


def test_shards_that_span_batches(monkeypatch):
    monkeypatch.setattr(variants, "BATCH_WORDS", 8)
    words = drawn(3, 120, "ab")
    rows = pd.DataFrame(
        [(w, 3, 5, 0, 6, w[:1]) for w in words if len(w) < 7] + [(w, 3, 7, 0, 8, w[:1]) for w in words], columns=["word", "n", *variants.SHARD]
    ).sort_values([*variants.SHARD, "word"])
    whole = pd.concat(near_words(iter([rows])))
    parts = pd.concat(near_words(rows.iloc[at : at + 5].reset_index(drop=True) for at in range(0, len(rows), 5)))
    assert sorted(whole.itertuples(index=False)) == sorted(parts.itertuples(index=False))


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    found = fast(docs)
    assert found == slow([(row["doc_id"], row["text"]) for row in docs.select("doc_id", "text").collect()])
    assert any(row[1] for row in found)


def test_chains_lead_to_the_last_form(spark, tmp_path):
    words = ["abcde"] * 3 + ["abcdef"] * 6 + ["abcdefg"] * 12 + ["abcdefgh"] * 24 + ["abcdefghi"] * 48 + ["zzzzz"] * 3
    rows = [(i, word) for i, word in enumerate(words)]
    rows = [(i + 1000 if slow_words([(i, word)] * 3) != {word: 3} else i, word) for i, word in rows]
    docs = stored(spark, spark.createDataFrame(rows, "doc_id long, text string"), tmp_path)
    assert fast(docs) == slow(rows)


def test_edges(spark, edge, empty):
    rows = [row[:2] for row in ROWS]
    assert fast(edge) == slow(rows) and fast(edge, shard_words=1) == slow(rows)
    assert spelling_variants(empty).count() == 0
    words = [("x" * 40_000, 5), ("x" * 40_001, 50), ("y" + "x" * 39_999, 9)]
    found = neighbours(spark.createDataFrame(words, "word string, n long"))
    assert {(len(row["word"]), row["n_near"], row["best_n"]) for row in found.collect()} == {(40_000, 2, 50), (40_001, 1, 5), (40_000, 1, 5)}


def test_clashing_columns(spark, tmp_path):
    docs = stored(spark, edge_docs(spark).withColumnsRenamed({"block": "word", "gram": "n", "fp": "size"}), tmp_path)
    assert fast(docs) == slow([row[:2] for row in ROWS])
