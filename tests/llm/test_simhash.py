import random

import numpy as np
import pytest
import xxhash
from edges import ROWS
from pyspark.sql import functions as F

from snapmart.llm import simhash
from snapmart.llm.components import components
from snapmart.llm.simhash import bk_links, fingerprint, near_duplicates, near_links, one_of_each


def slow_fingerprint(text, shingle=3):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for space in "\t\n\x0b\x0c\r":
        words = words.replace(space, " ")
    words = [word for word in words.split(" ") if word]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def slow_roots(points, radius):
    root = {p: p for p in points}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for p in points:
        for q in points:
            if p < q and (p ^ q).bit_count() <= radius:
                a, b = find(p), find(q)
                root[max(a, b)] = min(a, b)
    return {p: find(p) for p in points}


def slow_components(rows, radius=3):
    prints = [slow_fingerprint(text) for _, text in rows]
    roots = slow_roots(sorted(set(prints)), radius)
    least = {}
    for (doc_id, _), p in zip(rows, prints):
        if doc_id is not None:
            least[roots[p]] = min(doc_id, least.get(roots[p], doc_id))
    return sorted(((i, f"{p:016x}", least.get(roots[p])) for (i, _), p in zip(rows, prints)), key=str)


def result(df):
    return sorted(((r.doc_id, r.fingerprint, r.component_id) for r in df.collect()), key=str)


def test_fingerprint_is_that_of_the_contract(monkeypatch):
    monkeypatch.setattr(simhash, "CHUNK", 7)
    rng = random.Random(1)
    for n in (0, 1, 2, 3, 4, 9, 60):
        text = " ".join(rng.choice(["Ab", "é", "c", "d e", "F"]) for _ in range(n))
        assert fingerprint(text) == slow_fingerprint(text)
    assert fingerprint(None) == fingerprint(" \t\n") == 0


def cluster(rng, n, flips):
    base = rng.getrandbits(64)
    return [base ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(flips + 1))) for _ in range(n)]


def test_bk_tree_finds_the_forest_of_all_links():
    rng = random.Random(2)
    points = sorted({*cluster(rng, 120, 4), *cluster(rng, 60, 2), *(rng.getrandbits(64) for _ in range(50))})
    links = bk_links(np.array(points, np.uint64), 3)
    pairs = [(points[a], points[b]) for a, b in links]
    want = slow_roots(points, 3)
    assert all(want[a] == want[b] for a, b in pairs)
    assert len(pairs) == len(points) - len(set(want.values()))


@pytest.mark.parametrize("shard_rows", [3, 4096])
def test_links_of_a_dense_group_at_any_shard_size(spark, shard_rows):
    rng = random.Random(3)
    points = sorted({*cluster(rng, 250, 5), *cluster(rng, 40, 3), *(rng.getrandbits(64) for _ in range(80))})
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in points]
    df = spark.createDataFrame(signed, "fp long").cache()
    links = near_links(df, shard_rows=shard_rows)
    assert links.filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) > 0).count() == links.count()
    found = {r.node % (1 << 64): r.root for r in components(links).collect()}
    want = slow_roots(points, 3)
    sets = {}
    for p in points:
        sets.setdefault(want[p], set()).add(found.get(p, p - (1 << 64) if p >> 63 else p))
    assert all(len(roots) == 1 for roots in sets.values()) and len(set().union(*sets.values())) == len(sets)


def test_documents_against_brute_force(spark):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(300)]
    base = [rng.choice(vocabulary) for _ in range(200)]
    rows = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(1, 60)))) for i in range(60)]
    for i in range(60):  # near copies of one text
        copy = list(base)
        copy[rng.randrange(200)] = "changed"
        rows.append((100 + i, " ".join(copy)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4).cache()
    assert result(near_duplicates(docs)) == slow_components(rows)


def test_edges(edge, empty):
    rows = [(row[0], row[1]) for row in ROWS]
    assert result(near_duplicates(edge)) == slow_components(rows)
    assert near_duplicates(empty).count() == 0
    assert one_of_each(empty).columns == empty.columns


def test_stage_keeps_the_smallest_id_of_each_component(edge):
    kept = one_of_each(edge)
    want = slow_components([(row[0], row[1]) for row in ROWS])
    assert kept.columns == edge.columns
    assert kept.count() == len({w[1] for w in want})  # no two fingerprints here are near but unequal
    assert kept.filter("doc_id = 1").count() == 1 and kept.filter("doc_id = 2").count() == 0


def test_components_of_a_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(30)] + [(7, 7)]
    roots = {r.node: r.root for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert all(roots[i] == 0 for i in range(1, 41)) and all(roots[100 + i] == 100 for i in range(1, 30))
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
