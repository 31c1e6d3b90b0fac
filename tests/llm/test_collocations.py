import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from edges import ROWS, edge_docs, stored
from pyspark.sql import functions as F

from snapmart.llm import collocations as operator
from snapmart.llm.collocations import collocations, counted_pairs, exact_score, grown, packed, packed_keys, pieces_of, shrunk, tokens_of, unpacked, unpacked_keys

UPPER = {code: code + 32 for code in range(65, 91)}


def slow(rows, least, most_words=5, top=2000):
    """lang, rank, phrase, a, l, r, n, score by counting every phrase of every piece."""
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(UPPER)):
            words = re.findall("[^ \t]+", piece)
            totals[lang] += len(words)
            for size in range(1, most_words + 1):
                counts.update((lang, *words[at : at + size]) for at in range(len(words) - size + 1))
    found = {key: n for key, n in counts.items() if n >= least}
    out = {}
    for (lang, *words), a in found.items():
        if len(words) < 2:
            continue
        longer = [n for (other, *more), n in found.items() if other == lang and len(more) > len(words)
                  and any(more[at : at + len(words)] == words for at in range(len(more) - len(words) + 1))]
        if any(n >= a for n in longer):
            continue
        best = None
        for k in range(1, len(words)):
            left, right = found[(lang, *words[:k])], found[(lang, *words[k:])]
            score = 1000 * a * totals[lang] // (left * right)
            if best is None or score < best[0]:
                best = (score, left, right)
        out.setdefault(lang, []).append((-best[0], -a, " ".join(words).encode(), best[1], best[2]))
    return sorted(
        (lang, rank, phrase.decode(), -a, left, right, totals[lang], -score)
        for lang, own in out.items() for rank, (score, a, phrase, left, right) in enumerate(sorted(own)[:top], 1)
    )


def fast(docs, **more):
    return sorted(map(tuple, collocations(docs, **more).collect()))


def test_tokens_and_parts():
    text = "The End. of\tall é\xa0x;A\x0bb\x1cc ,,  d"
    assert tokens_of(text.encode()) == [b"the", b"end", b"\xff", b"of", b"all", "é\xa0x".encode(), b"\xff", b"a", b"\xff", b"b\x1cc", b"\xff", b"\xff", b"d", b"\xff"]
    for size in (1, 3, 7, 100):
        parts = list(pieces_of(text, size))
        assert b"".join(parts) == text.encode()
        mine = [token for part in parts for token in tokens_of(part)]
        assert [t for t in b"|".join(mine).split(b"\xff")] and [t for t in mine if t != b"\xff"] == [t for t in tokens_of(text.encode()) if t != b"\xff"]


@pytest.mark.parametrize(("seed", "block", "top"), [(1, 40, 2000), (2, 1 << 20, 3), (3, 200, 7)])
def test_against_every_phrase(spark, tmp_path, seed, block, top):
    rng = random.Random(seed)
    words, rows = ["a", "B", "c", "é", "dd"], []
    for _ in range(80):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", " ", "\t", ", ", ".", "\n"]) for _ in range(rng.randint(0, 60)))
        rows.append((rng.choice(["en", "en", "de", None, "und"]), text))
    docs = stored(spark, spark.createDataFrame(rows, "lang string, text string").repartition(5), tmp_path)
    want = slow(rows, 4, top=top)
    assert want and fast(docs, least=4, block=block, top=top) == want


def test_parts_of_longer_phrases_go(spark, tmp_path):
    rows = [("en", "new york city hall. new york")] * 5 + [("en", "york city hall x")]
    docs = stored(spark, spark.createDataFrame(rows, "lang string, text string"), tmp_path)
    found = {row[2] for row in fast(docs, least=5)}
    assert found == {row[2] for row in slow(rows, 5)} == {"new york city hall", "new york", "york city hall"}


def test_scores_beyond_64_bits(spark):
    one = spark.createDataFrame([(3_000_000_000, 70_000_000_000_000, 4_000_000_000, 9_000_000_001)], "a long, n long, l long, r long")
    assert one.select(exact_score("a", "n", "l", "r")).first()[0] == 1000 * 3_000_000_000 * 70_000_000_000_000 // (4_000_000_000 * 9_000_000_001)


def test_edges(edge, empty):
    rows = [(row[2], row[1]) for row in ROWS]
    want = slow(rows, 100)
    assert want and fast(edge) == want and fast(edge, block=64) == want
    assert collocations(empty).count() == 0


def test_clashing_columns(spark, tmp_path):
    docs = edge_docs(spark).withColumnsRenamed({"block": "phrase", "gram": "f", "fp": "group", "key": "n"})
    docs = stored(spark, docs.withColumn("rank", F.lit(1)), tmp_path)
    assert fast(docs) == slow([(row[2], row[1]) for row in ROWS], 100)


@pytest.mark.parametrize(("bound", "part"), [(0, 1 << 20), (0, 100), (20, 100), (200_000, 100)])
def test_groups_looked_up_or_joined(spark, tmp_path, monkeypatch, bound, part):
    monkeypatch.setattr(operator, "BROADCAST_GROUPS", bound)
    monkeypatch.setattr(operator, "PART", part, raising=False)
    rng = random.Random(bound)
    rows = [(rng.choice(["en", "de", None, "e n"]), " ".join(rng.choices(["a", "b", "c d", "é", "n a", "e."], k=rng.randint(0, 50)))) for _ in range(90)]
    docs = stored(spark, spark.createDataFrame(rows, "lang string, text string").repartition(4), tmp_path)
    want = slow(rows, 5)
    assert want and fast(docs, least=5, block=150) == want


def test_few_groups_move_no_block(spark, tmp_path, monkeypatch):
    """Frequent groups that fit a broadcast make one row for each block, and neither blocks nor counted rows travel."""
    plans = []

    def seen(df):
        plans.append(df)
        return df.checkpoint(eager=True)

    for name in ("materialize", "materialize_texts"):
        monkeypatch.setattr(operator, name, seen, raising=False)
    rows = [("en", "a b c d e f g h")] * 40
    docs = stored(spark, spark.createDataFrame(rows, "lang string, text string").repartition(4), tmp_path)
    assert fast(docs, least=10, block=30) == slow(rows, 10)
    relations = [df for df in plans if df.columns == ["block", "groups", "data"]]
    assert len(relations) == 4
    for df in relations:
        plan = df._jdf.queryExecution().toString()
        plan = plan[plan.index("Physical Plan") :]
        assert "BroadcastNestedLoopJoin" in plan and "HashJoin" not in plan and "Exchange hashpartitioning" not in plan


def test_many_groups_are_counted_once(spark, tmp_path, monkeypatch):
    """Beyond the broadcast the parts that counted answer the blocks: no counted rows are made, joined or sent a second time."""
    plans = []

    def seen(df):
        plans.append(df)
        return df.checkpoint(eager=True)

    monkeypatch.setattr(operator, "materialize", seen)
    monkeypatch.setattr(operator, "BROADCAST_GROUPS", 0)
    rows = [("en", "a b c d e f g h")] * 40 + [("de", "..,,;\n" * 20)] * 9 + [(None, "a b. a b")] * 12
    docs = stored(spark, spark.createDataFrame(rows, "lang string, text string").repartition(4), tmp_path)
    assert fast(docs, least=10, block=30) == slow(rows, 10)
    relations = [df for df in plans if df.columns == ["block", "groups", "data"]]
    assert len(relations) == 4
    for df in relations:
        plan = df._jdf.queryExecution().toString()
        plan = plan[plan.index("Physical Plan") :]
        assert "FlatMapCoGroupsIn" in plan and "MapInArrow" not in plan and "Generate" not in plan and "MergeJoin" not in plan


def test_words_travel_as_places_counts_and_texts():
    for words in (["a en", "é\n b", "a ", " x"], []):
        keys = pa.concat_arrays([pa.array(["before"]), pa.array(words, pa.string())])[1:]
        at, n = np.arange(len(words)) * 3, np.arange(len(words)) + (1 << 33)
        places, counts, sizes, text = unpacked_keys(packed_keys(at, n, keys), len(words))
        assert places.tolist() == at.tolist() and counts.tolist() == n.tolist()
        assert sizes.tolist() == [len(word.encode()) for word in words] and text == "".join(words).encode()


def test_pairs_travel_in_a_few_bytes(spark):
    """A block sends each part one row, and all its pairs once."""
    rng = np.random.default_rng(1)
    which = rng.integers(0, 500, 40_000).astype(np.int32)
    groups = rng.permutation(np.arange(500) << 33)
    rows = spark.createDataFrame([(7, groups.tolist(), bytearray(shrunk(np.arange(len(which), dtype=np.int32), which)))], "block long, groups array<long>, data binary")
    made = counted_pairs(rows, 5).collect()
    assert sorted(row["part"] for row in made) == [0, 1, 2, 3, 4] and {row["block"] for row in made} == {7}
    want = Counter(zip(groups[which[:-1]].tolist(), groups[which[1:]].tolist()))
    found = {}
    for row in made:
        left, right, n = unpacked(bytes(row["data"]), row["size"], 3)
        found |= {(a, b): c for a, b, c in zip(left.tolist(), right.tolist(), n.tolist())}
    assert sum(row["size"] for row in made) == len(found) and found == want
    assert sum(len(row["data"]) for row in made) < 4 * len(want)
    assert [len(a) for a in unpacked(packed(*[np.zeros(0, np.int64)] * 3), 0, 3)] == [0, 0, 0]


def test_places_are_stored_as_steps():
    places = np.arange(5, 1 << 20, dtype=np.int32)[np.arange((1 << 20) - 5) % 9 > 0]
    which = (places % 7).astype(np.int32)
    data = shrunk(places, which)
    assert len(data) < len(places) // 20
    assert all((a == b).all() and a.dtype == np.int32 for a, b in zip(grown(data), (places, which), strict=True))
    assert [len(a) for a in grown(shrunk(places[:0], which[:0]))] == [0, 0]
