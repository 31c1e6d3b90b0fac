"""Best-fit decreasing packing of tokenized documents into sequences, by classes of equal size.

The dealt method, bulk-synchronous rounds over range-sorted tables of documents and gaps, is replaced. Its rounds depend on
one another, and each would be a Spark job over tables that hold at most a class for each size up to the sequence length.
Here the counts of the classes, at most `length` rows whatever the corpus, are taken to the driver, and best-fit decreasing
runs over them: the largest class left goes to the smallest gaps that hold it, as many pieces as there is room for; the
gaps shrink; pieces that find none open sequences. The result is that of best-fit decreasing, one piece at a time.

What grows with the corpus stays in Spark: encoding where the documents are read, counting, the rank of each piece in its
class (a count per reading partition, a running sum over partitions, a row number inside each, so that no class meets in
one task), and the join of each piece's class and rank with the places of its class.

Defined results: a null or empty text is one piece holding the end token only. Repeated rows and ids are packed one by
one. An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snapmart.llm.store import materialize, materialize_texts, slices, small_enough
from snapmart.llm.tokens import default_path, load

LENGTH = 1024
END = 2
#: Places broadcast at most, six numbers each.
BROADCAST_PLACES = 100_000


def piece_starts(n: int, length: int) -> list[int]:
    """Starts of the pieces of n ids: the first piece takes what whole pieces leave."""
    first = n % length
    return [0] * bool(first) + list(range(first, n, length))


def cut_pieces(path: str, length: int, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = load(path)
        for part in slices(batches):
            rows = []
            for at, text in enumerate(part["text"]):
                ids = np.append(tokenizer.encode(text.as_py()), np.uint32(end)).astype("<u4")
                starts = piece_starts(len(ids), length)
                for piece, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)])):
                    rows.append((at, piece, a, b - a, zlib.crc32(ids[a:b].tobytes())))
            of, piece, start, size, crc = (pa.array(column, pa.int64()) for column in zip(*rows))
            yield pa.RecordBatch.from_arrays(
                [part["row_id"].take(of), part["doc_id"].take(of), piece.cast(pa.int32()), start, size, crc],
                names=["row_id", "doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return run


def pieces(docs: DataFrame, id_col: str, text_col: str, path: str, length: int, end: int) -> DataFrame:
    texts = docs.select(
        F.monotonically_increasing_id().alias("row_id"),
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    kind = texts.schema["doc_id"].dataType.simpleString()
    schema = f"row_id long, doc_id {kind}, piece int, start long, length long, ids_crc32 long"
    return texts.mapInArrow(cut_pieces(path, length, end), schema)


def best_fit(counts: dict[int, int], length: int) -> list[tuple[int, int, int, int, int, int]]:
    """Places of all classes: (size, first rank, end rank, first sequence, offset, pieces per sequence).

    counts: pieces by size. A run of sequences with equal gaps is one entry, so the work does not grow with the pieces.
    """
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap: runs of sequences (first, count)
    sizes: list[int] = []  # the gaps in order
    places, sequences = [], 0

    def leave(gap: int, first: int, count: int) -> None:
        if gap and count:
            if gap not in gaps:
                sizes.insert(bisect_left(sizes, gap), gap)
            gaps.setdefault(gap, []).append((first, count))

    def fill(size: int, rank: int, left: int, gap: int, first: int, count: int) -> int:
        """Place pieces in a run of gaps, each gap as full as it goes; returns how many were placed."""
        per = gap // size
        full = min(count, left // per)
        if full:
            places.append((size, rank, rank + full * per, first, length - gap, per))
            leave(gap - per * size, first, full)
        placed, some = full * per, left - full * per
        if full < count and some:  # fewer than a gap holds
            places.append((size, rank + placed, rank + left, first + full, length - gap, some))
            leave(gap - some * size, first + full, 1)
            full, placed = full + 1, left
        leave(gap, first + full, count - full)
        return placed

    for size in sorted(counts, reverse=True):
        rank, total = 0, counts[size]
        while rank < total:
            at = bisect_left(sizes, size)
            if at == len(sizes):
                opened = -(-(total - rank) // (length // size))
                rank += fill(size, rank, total - rank, length, sequences, opened)
                sequences += opened
                break
            gap = sizes[at]
            first, count = gaps[gap].pop()
            if not gaps[gap]:
                del gaps[gap], sizes[at]
            rank += fill(size, rank, total - rank, gap, first, count)
    return places


def ranked(cut: DataFrame) -> tuple[DataFrame, dict[int, int]]:
    """The pieces with their rank among those of their size, and the number of pieces by size."""
    # The high bits of a row id are its reading partition.
    parted = cut.withColumn("part", F.shiftright("row_id", 33))
    counts = materialize(parted.groupBy("part", "length").count())
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("part", "length", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    within = Window.partitionBy("part", "length").orderBy("row_id", "piece")
    ranks = parted.withColumn("own", F.row_number().over(within) - 1).join(offsets, ["part", "length"])
    totals = {row["length"]: row["n"] for row in counts.groupBy("length").agg(F.sum("count").alias("n")).collect()}
    return ranks.withColumn("rank", F.col("before") + F.col("own")), totals


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    path: str | None = None,
    length: int = LENGTH,
    end: int = END,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    cut = materialize_texts(pieces(docs, id_col, text_col, path or default_path(), length, end))
    ranks, totals = ranked(cut)
    spark = docs.sparkSession
    schema = "length long, first long, last long, sequence long, at long, per long"
    # Some places for each class of size; counted all the same.
    places = small_enough(spark.createDataFrame(best_fit(totals, length), schema), BROADCAST_PLACES)
    own = (ranks["length"] == places["length"]) & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("last"))
    placed = ranks.join(places, own).withColumn("n", F.col("rank") - F.col("first"))
    return placed.select(
        "doc_id", "piece", "start", ranks["length"], "ids_crc32",
        (F.col("sequence") + F.expr("n div per")).alias("sequence_id"),
        (F.col("at") + F.col("n") % F.col("per") * ranks["length"]).alias("offset"),
    )
