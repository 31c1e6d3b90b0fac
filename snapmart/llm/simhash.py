"""SimHash near-duplicates with BK-trees over shards of the fingerprints.

Fingerprints that differ in few bits share whole blocks of bits: of BLOCKS blocks, a difference of RADIUS bits leaves
BLOCKS - RADIUS untouched. A shard is the distinct fingerprints that agree on such a choice of blocks, so every link lies
within some shard. A shard with more than SHARD_ROWS fingerprints is dealt anew by the blocks of its remaining bits,
until none is larger; the fingerprints being distinct, a shard with b free bits has 2^b at most, so this ends after four
levels and nothing is dropped. Each shard's BK-tree is built and asked within one task: children hang on their parent by
the integer distance, and a query follows the edges within the radius of its distance only. A whole shard is asked at
once, one array of queries per node.

The operator returns components, so a shard yields a spanning forest of its links and not all pairs.

The dealt method broadcasts the shard trees. Here a tree and its queries are sent to the same task by the shard's key
instead: trees together grow with the corpus, so a broadcast of them would have no bound.

Defined results: null and wordless texts have fingerprint zero, which links like any other. Repeated rows and ids stay
as they are. A component in which all ids are null has a null id. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapmart.llm.components import components
from snapmart.llm.store import fresh, materialize, materialize_texts, numbered, slices, without_rows

SHINGLE = 3
RADIUS = 3
SEED = 42
BLOCKS = 5
SHARD_ROWS = 4096
#: Bits that a shard may leave free without being dealt anew: at most 2 to that power fingerprints.
FREE_BITS = 10
#: Shingles hashed at a time, so that a very long text needs no more memory than a long one.
CHUNK = 1 << 16


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64 bits as an unsigned number."""
    words = (text or "").encode("utf-8").lower().split()
    if not words:
        return 0
    total, ones = max(len(words) - shingle + 1, 1), np.zeros(64, np.int64)
    digest, join = xxhash.xxh64_digest, b" ".join
    for at in range(0, total, CHUNK):
        part = words[at : at + CHUNK + shingle - 1]
        grams = map(join, zip(*(part[i:] for i in range(shingle)))) if len(part) >= shingle else [join(part)]
        hashes = np.frombuffer(b"".join([digest(gram, SEED) for gram in grams]), np.uint8).reshape(-1, 8)
        ones += np.unpackbits(hashes, axis=1).sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(2 * ones > total).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """row_id, doc_id, fp: the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            found = [fingerprint(text.as_py(), shingle) for text in part["text"]]
            fp = pa.array(np.array(found, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([part["row_id"], part["doc_id"], fp], names=["row_id", "doc_id", "fp"])

    row = fresh(docs, "row")
    slim = numbered(docs, row).select(
        F.col(row).alias("row_id"), F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")
    )
    kind = slim.schema["doc_id"].dataType.simpleString()
    return slim.mapInArrow(run, f"row_id long, doc_id {kind}, fp long")


def deeper(mask: int, radius: int) -> list[int]:
    """The masks below a mask: it and every choice of enough blocks of the bits it leaves free."""
    free = [bit for bit in range(64) if not mask >> bit & 1]
    blocks = [sum(1 << int(bit) for bit in block) for block in np.array_split(free, radius + 2)]
    return [mask | sum(chosen) for chosen in combinations(blocks, 2)]


def signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def bk_links(points: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links of a spanning forest of distinct fingerprints, found through a BK-tree.

    The tree is walked from the root with all queries at once; a node passes to the child at distance c those whose own
    distance is within the radius of c.
    """
    everyone = np.arange(len(points))
    label = everyone.copy()
    stack = [(everyone, everyone)]
    while stack:
        members, queries = stack.pop()
        node, rest = members[0], members[1:]
        far = np.bitwise_count(points[queries] ^ points[node])
        near = queries[far <= radius]
        groups = np.unique(label[near])
        if len(groups) > 1:
            label[np.isin(label, groups)] = groups[0]
        if len(rest):
            edge = np.bitwise_count(points[rest] ^ points[node])
            order = np.argsort(edge, kind="stable")
            cuts = np.flatnonzero(np.diff(edge[order])) + 1
            for child in np.split(rest[order], cuts):
                at = int(np.bitwise_count(points[child[0]] ^ points[node]))
                stack.append((child, queries[np.abs(far.astype(np.int16) - at) <= radius]))
    return [(i, int(label[i])) for i in range(len(points)) if label[i] != i]


def shard_links(radius: int):
    """Edges of every shard of a partition sorted by shard; a shard may span batches."""

    def links(points: np.ndarray) -> pd.DataFrame:
        pairs = np.array(bk_links(points.view(np.uint64), radius), np.int64).reshape(-1, 2)
        return pd.DataFrame({"a": points[pairs[:, 0]], "b": points[pairs[:, 1]]})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for batch in batches:
            rows = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            mask, value = rows["mask"].to_numpy(), rows["value"].to_numpy()
            cuts = np.flatnonzero((np.diff(mask) != 0) | (np.diff(value) != 0)) + 1
            ends = [0, *cuts.tolist()]
            fps = rows["fp"].to_numpy()
            found = [links(fps[a:b]) for a, b in zip(ends, ends[1:]) if b - a > 1]
            rest = rows.iloc[ends[-1] :]
            if found:
                yield pd.concat(found, ignore_index=True)
        if rest is not None and len(rest) > 1:
            yield links(rest["fp"].to_numpy())

    return run


def near_links(points: DataFrame, radius: int = RADIUS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """a, b: links that connect all fingerprints within the radius. points: fp, distinct."""
    spark, found = points.sparkSession, None
    rows = points.select("fp", F.explode(F.array(*[F.lit(signed(m)) for m in deeper(0, radius)])).alias("mask"))
    while True:
        rows = rows.withColumn("value", F.col("fp").bitwiseAND(F.col("mask")))
        shards = materialize(rows.groupBy("mask", "value").count().filter("count > 1"))
        large = (F.col("count") > shard_rows) & (64 - F.bit_count("mask") > FREE_BITS)
        cold = rows.join(shards.filter(~large), ["mask", "value"], "left_semi")
        cold = cold.repartition("mask", "value").sortWithinPartitions("mask", "value", "fp")
        links = materialize(cold.mapInPandas(shard_links(radius), "a long, b long"))
        found = links if found is None else found.unionByName(links)
        hot = shards.filter(large)
        masks = [row["mask"] for row in hot.select("mask").distinct().collect()]  # at most ten per level and mask
        if not masks:
            return found
        pairs = [(mask, signed(sub)) for mask in masks for sub in deeper(mask % (1 << 64), radius)]
        subs = F.broadcast(spark.createDataFrame(pairs, "mask long, sub long"))
        rows = rows.join(hot, ["mask", "value"], "left_semi").join(subs, "mask").select("fp", F.col("sub").alias("mask"))
        rows = materialize(rows.distinct())


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    shingle: int = SHINGLE,
    radius: int = RADIUS,
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """One row per document: row_id, doc_id, fingerprint (hex), component_id (the smallest id reachable)."""
    keys = materialize_texts(fingerprints(docs, id_col, text_col, shingle))
    points = materialize(keys.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = components(near_links(points.select("fp"), radius, shard_rows))
    rooted = points.join(roots, points["fp"] == roots["node"], "left")
    rooted = rooted.select("fp", "least", F.coalesce("root", "fp").alias("root"))
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = rooted.join(ids, "root").select("fp", "root", "component_id")
    return keys.join(classes, "fp").select(
        "row_id", "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", "root"
    )


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents without their near-duplicates: of each group the smallest id stays, null ids last, then the first
    row. docs must be a stored table."""
    found = materialize(near_duplicates(docs, id_col, text_col))
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_id")
    best = found.groupBy("root").agg(F.min(rank).alias("best")).select("root", F.col("best.row_id").alias("kept"))
    return without_rows(docs, found.join(best, "root").filter("row_id <> kept").select("row_id"))
