import random
import zlib
from bisect import bisect_left, insort
from collections import Counter, defaultdict

import numpy as np
import pytest
from edges import ROWS
from tokenizers import Tokenizer

from snapmart.llm import packing, tokens


def slow_best_fit(sizes, length):
    """Number of sequences of best-fit decreasing, one piece after the other."""
    gaps, n = [], 0
    for size in sorted(sizes, reverse=True):
        at = bisect_left(gaps, size)
        if at == len(gaps):
            n += 1
            gap = length
        else:
            gap = gaps.pop(at)
        if gap > size:
            insort(gaps, gap - size)
    return n


def check_places(rows, length):
    """Rows (sequence, offset, size) fill each sequence from 0 without gaps."""
    by = defaultdict(list)
    for sequence, offset, size in rows:
        by[sequence].append((offset, size))
    for own in by.values():
        at = 0
        for offset, size in sorted(own):
            assert offset == at
            at += size
        assert at <= length
    return len(by)


def test_rounds_equal_best_fit_decreasing():
    rng = random.Random(1)
    for _ in range(200):
        length = rng.choice([8, 16, 100, 1024])
        counts = Counter(rng.randint(1, length) for _ in range(rng.randrange(1, 300)))
        rows, placed = [], Counter()
        for size, first, last, sequence, at, per in packing.best_fit(counts, length):
            placed[size] += last - first
            rows += [(sequence + n // per, at + n % per * size, size) for n in range(last - first)]
        assert placed == counts
        assert check_places(rows, length) == slow_best_fit(list(counts.elements()), length)


def slow_pieces(library, rows, length):
    out = []
    for doc_id, text in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, packing.END]
        cuts = [0] * bool(len(ids) % length) + list(range(len(ids) % length, len(ids), length)) + [len(ids)]
        for piece, (a, b) in enumerate(zip(cuts, cuts[1:])):
            out.append((doc_id, piece, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    return sorted(out, key=str)


@pytest.mark.parametrize("length", [1024, 7])
def test_edges(edge, length):
    library = Tokenizer.from_file(tokens.default_path())
    rows = packing.pack(edge, length=length).collect()
    want = slow_pieces(library, [(row[0], row[1]) for row in ROWS], length)
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows), key=str) == want
    n = check_places([(r.sequence_id, r.offset, r.length) for r in rows], length)
    assert n == slow_best_fit([w[3] for w in want], length)


def test_documents_of_many_partitions(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").repartition(7).cache()
    rows = packing.pack(docs).collect()
    n = check_places([(r.sequence_id, r.offset, r.length) for r in rows], 1024)
    assert n == slow_best_fit([r.length for r in rows], 1024)
    assert len({(r.doc_id, r.piece) for r in rows}) == len(rows)


def test_empty(empty):
    assert packing.pack(empty).count() == 0
