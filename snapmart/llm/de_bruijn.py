"""Substring dedup by De Bruijn compaction: word k-mers are edges, and repeated paths that do not branch are one row.

An edge is a window of SPAN words, its nodes are the windows of one word less. The graph is made compact before it is
made large:

- Within a document, consecutive edges under the same anchor (the least hash of ANCHOR words in the window) form a run.
  Equal windows have equal anchors, so a run whose anchor no other document has holds no repeated edge, and is dropped.
- Runs that read the same are one path, joined by anchor and digest. Where all runs of an anchor do, the path does not
  branch. The others are taken apart into single edges, once for each different run, and a join by edge finds those that
  several documents have.
- Every path knows its source, the first place in the first document that holds it. Neighbouring paths whose sources are
  neighbours too compact into one span.

Paths and edges are told by 64-bit hashes. So at last the words of each span and those at its source coordinates are read
and compared by SHA-256. If any differ, everything is done again with another seed, so that the result is exact.

Nothing is broadcast but row ids of counted number; a hot passage is only aggregated with map-side combining or joined from
its large side, which adaptive execution splits.

Defined results: words are runs of anything but ASCII white space; a null text has none. Ids are whole numbers; null ids come
after all others. Documents with the same id, repeated rows among them, are the same document to each other: neither is a
source of the other. Documents shorter than a span keep all words. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from snapmart.llm.store import fresh, materialize, numbered, slices, small_enough

SPAN = 50
ANCHOR = 12
#: Words whose edges are made at a time; a run cut here is taken for a branching one.
CHUNK = 1 << 18
#: Row ids broadcast at most, 8 bytes each.
BROADCAST_IDS = 1_000_000
NO_ID = (1 << 63) - 1
SEEDS = 8


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8").split()


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of a number over all of them."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hashes of sequences from those of their two parts."""
    n = min(len(left), len(right))
    return mixed(left[:n] * np.uint64(0x9E3779B97F4A7C15) + right[:n])


def window_hashes(hashes: np.ndarray, sizes: tuple[int, ...]) -> list[np.ndarray]:
    """For each size, the hashes of all windows of so many words, put together from windows of powers of two."""
    powers, made = {1: hashes}, []
    for size in sizes:
        whole, at = None, 0
        for bit in reversed(range(size.bit_length())):
            length = 1 << bit
            if not size & length:
                continue
            for step in range(1, bit + 1):
                half = powers[1 << (step - 1)]
                powers.setdefault(1 << step, joined(half, half[1 << (step - 1) :]))
            part = powers[length][at:]
            whole, at = part if whole is None else joined(whole, part), at + length
        made.append(whole[: max(len(hashes) - size + 1, 0)])
    return made


def least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every so many neighbours."""
    done = 1
    while done < width:
        step = min(done, width - done)
        values, done = np.minimum(values[:-step], values[step:]), done + step
    return values


def edges_of(words: list[bytes], seed: int, span: int) -> np.ndarray:
    hashes = np.fromiter((xxhash.xxh64_intdigest(word, seed) for word in words), np.uint64, len(words))
    return window_hashes(hashes, (span,))[0]


def runs_of(words: list[bytes], seed: int, span: int, anchor: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchors, digests, first windows and numbers of windows of the runs of some words."""
    hashes = np.fromiter((xxhash.xxh64_intdigest(word, seed) for word in words), np.uint64, len(words))
    edges, short = window_hashes(hashes, (span, anchor))
    if not len(edges):
        return edges, edges, np.array([], np.int32), np.array([], np.int32)
    anchors = least(short, span - anchor + 1)
    starts = np.flatnonzero(np.concatenate([[True], anchors[1:] != anchors[:-1]]))
    sizes = np.diff(starts, append=len(edges))
    place = np.arange(len(edges)) - np.repeat(starts, sizes)
    digests = np.add.reduceat(mixed(edges + place.astype(np.uint64) * np.uint64(0xA24BAED4963EE407)), starts)
    return anchors[starts], digests, starts.astype(np.int32), sizes.astype(np.int32)


def documents_runs(docs: DataFrame, seed: int, span: int, anchor: int) -> DataFrame:
    """row_id, doc_id, rank, n_words, sha, and the runs of every document as four arrays. docs: row_id, doc_id, text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            counts, shas, found = [], [], []
            for text in part["text"]:
                words = words_of(text.as_py())
                counts.append(len(words))
                shas.append(hashlib.sha256(b" ".join(words)).hexdigest())
                parts = []
                for at in range(0, max(len(words) - span + 1, 1), CHUNK):
                    own = runs_of(words[at : at + CHUNK + span - 1], seed, span, anchor)
                    parts.append((own[0].view(np.int64), own[1].view(np.int64), own[2] + np.int32(at), own[3]))
                found.append([np.concatenate(column) for column in zip(*parts)])
            ends = np.cumsum([0, *(len(one[0]) for one in found)]).astype(np.int32)
            flat = [np.concatenate(column) if column else np.array([], np.int64) for column in zip(*found)]
            lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(column)) for column in flat]
            yield pa.RecordBatch.from_arrays(
                [part["row_id"], part["doc_id"], part["rank"], pa.array(counts, pa.int64()), pa.array(shas, pa.string()), *lists],
                names=["row_id", "doc_id", "rank", "n_words", "sha", "keys", "digests", "starts", "sizes"],
            )

    slim = docs.select("row_id", "doc_id", rank_of("doc_id").alias("rank"), "text")
    kind = slim.schema["doc_id"].dataType.simpleString()
    return slim.mapInArrow(
        run,
        f"row_id long, doc_id {kind}, rank long, n_words long, sha string, "
        "keys array<long>, digests array<long>, starts array<int>, sizes array<int>",
    )


def rank_of(name: str):
    return F.coalesce(F.col(name).cast("long"), F.lit(NO_ID))


def with_texts(docs: DataFrame, by_row: DataFrame) -> DataFrame:
    """The rows of by_row (unique row_id) with the text of theirs: only texts that are asked for move."""
    ids = small_enough(materialize(by_row.select("row_id")), BROADCAST_IDS)
    texts = docs.select("row_id", "text").join(ids, "row_id", "left_semi")
    return texts.join(by_row, "row_id")


def single_edges(docs: DataFrame, runs: DataFrame, seed: int, span: int) -> DataFrame:
    """row_id, run, low, high, place, keys: the edges of the runs, from place on. runs: row_id, start, size, low, high."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            out: list[dict] = []
            for row, text, own in zip(part["row_id"].to_pylist(), part["text"], part["runs"].to_pylist()):
                words, done = words_of(text.as_py()), 0
                for one in sorted(own, key=lambda x: x["start"]):
                    if one["start"] + one["size"] > done:  # neighbours are hashed together
                        begin, end = one["start"], one["start"] + max(one["size"], CHUNK)
                        done = min(len(words) - span + 1, end)
                        edges = edges_of(words[begin : done + span - 1], seed, span).view(np.int64)
                    at = one["start"] - begin
                    out.append({**one, "row_id": row, "keys": edges[at : at + one["size"]]})
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([one["row_id"] for one in out], pa.int64()), pa.array([one["start"] for one in out], pa.int32()),
                    pa.array([one["low"] for one in out], pa.int64()), pa.array([one["high"] for one in out], pa.int64()),
                    pa.ListArray.from_arrays(
                        pa.array(np.cumsum([0, *(len(one["keys"]) for one in out)]).astype(np.int32)),
                        pa.array(np.concatenate([one["keys"] for one in out]) if out else np.array([], np.int64)),
                    ),
                ],
                names=["row_id", "run", "low", "high", "keys"],
            )

    by_row = runs.groupBy("row_id").agg(F.collect_list(F.struct("start", "size", "low", "high")).alias("runs"))
    return with_texts(docs, by_row).mapInArrow(run, "row_id long, run int, low long, high long, keys array<long>")


def compacted(pieces: DataFrame, by: list[str]) -> DataFrame:
    """Neighbouring pieces whose sources are neighbours too, as one. pieces: by, start, size, first, from_row, from_start."""
    order = Window.partitionBy(*by).orderBy("start")
    before = lambda name: F.lag(name).over(order)
    goes_on = (
        (before("from_row") == F.col("from_row"))
        & (before("start") + before("size") == F.col("start"))
        & (before("from_start") + before("size") == F.col("from_start"))
    )
    numbers = pieces.withColumn("begins", F.when(goes_on, 0).otherwise(1))
    numbers = numbers.withColumn("path", F.sum("begins").over(order))
    head = F.min(F.struct("start", "first", "from_row", "from_start")).alias("head")
    paths = numbers.groupBy(*by, "path").agg(head, F.sum("size").cast("int").alias("size"))
    return paths.select(*by, "head.start", "size", "head.first", "head.from_row", "head.from_start")


def repeated_paths(docs: DataFrame, runs: DataFrame, seed: int, span: int) -> DataFrame:
    """row_id, rank, start, size, first, from_row, from_start: paths of windows that several documents have, with the place
    of the first occurrence and the rank of its document."""
    rows = runs.select("row_id", "rank", "digests", "starts", "sizes", F.posexplode("keys").alias("at", "key"))
    at = lambda name: F.element_at(name, F.col("at") + 1)
    rows = rows.select(
        "row_id", "rank", at("starts").alias("start"), at("sizes").alias("size"), "key", at("digests").alias("digest")
    )
    anchors = rows.groupBy("key").agg(
        F.min("rank").alias("first"), F.max("rank").alias("last"), F.min("digest").alias("low"), F.max("digest").alias("high")
    )
    anchors = anchors.filter("first < last").select("key", (F.col("low") < F.col("high")).alias("branches"))
    found = materialize(rows.join(anchors, "key"))
    source = F.min(F.struct("rank", "row_id", "start")).alias("source")
    # Runs that read the same are one path, whose edges are those of its first occurrence.
    same = found.groupBy("key", "digest", "branches").agg(source, F.max("rank").alias("high"), F.min("size").alias("size"))
    same = materialize(
        same.select(
            "key", "digest", "branches", F.col("source.rank").alias("first"), "high", "size",
            F.col("source.row_id").alias("from_row"), F.col("source.start").alias("from_start"),
        )
    )
    solid = found.filter("not branches").drop("size").join(same.drop("branches", "high"), ["key", "digest"])

    branching = same.filter("branches")
    asked = branching.select(
        F.col("from_row").alias("row_id"), F.col("from_start").alias("start"), "size", F.col("first").alias("low"), "high"
    )
    edges = materialize(single_edges(docs, asked, seed, span))
    edges = edges.select("row_id", "run", "low", "high", F.posexplode("keys").alias("at", "key"))
    edges = edges.withColumn("start", F.col("run") + F.col("at")).drop("at")
    first = edges.groupBy("key").agg(F.min(F.struct("low", "row_id", "start")).alias("source"), F.max("high").alias("last"))
    first = first.filter("source.low < last").select(
        "key",
        F.col("source.low").alias("first"),
        F.col("source.row_id").alias("from_row"),
        F.col("source.start").alias("from_start"),
    )
    parts = edges.drop("low", "high").join(first, "key").withColumn("size", F.lit(1))
    parts = compacted(parts, ["row_id", "run"])
    place = ["size", "first", "from_row", "from_start"]
    parts = parts.groupBy("row_id", "run").agg(F.collect_list(F.struct("start", *place)).alias("parts"))
    parts = branching.select("key", "digest", "from_row", "from_start").join(
        parts, (F.col("from_row") == F.col("row_id")) & (F.col("from_start") == F.col("run"))
    )
    rest = found.filter("branches").select("row_id", "rank", "start", "key", "digest")
    rest = rest.join(parts.select("key", "digest", "run", "parts"), ["key", "digest"])
    rest = rest.select("row_id", "rank", F.col("start").alias("run_start"), "run", F.explode("parts").alias("part"))
    start = (F.col("run_start") + F.col("part.start") - F.col("run")).alias("start")
    rest = rest.select("row_id", "rank", start, *[f"part.{name}" for name in place])
    return compacted(solid.select(rest.columns).unionByName(rest), ["row_id", "rank"])


def read_again(docs: DataFrame, spans: DataFrame, span: int) -> DataFrame:
    """row_id, n_removed, sha of the words kept, and for every span and source of a span (start, size) 128 bits of the
    SHA-256 of the words there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            out = []
            for row, text, own in zip(part["row_id"].to_pylist(), part["text"], part["places"].to_pylist()):
                words, read = words_of(text.as_py()), []
                gone = np.zeros(len(words) + 1, np.int32)
                for one in own:
                    start, end = one["start"], one["start"] + one["size"] + span - 1
                    digest = hashlib.sha256(b" ".join(words[start:end])).digest()
                    high, low = np.frombuffer(digest[:16], np.int64).tolist()
                    read.append({"start": start, "size": one["size"], "high": high, "low": low})
                    if one["goes"]:
                        gone[start] += 1
                        gone[end] -= 1
                covered = np.cumsum(gone[:-1]) > 0
                kept = [word for word, out_ in zip(words, covered) if not out_]
                sha = hashlib.sha256(b" ".join(kept)).hexdigest()
                out.append({"row_id": row, "n_removed": int(covered.sum()), "sha": sha, "read": read})
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    place = [("start", pa.int32()), ("size", pa.int32()), ("high", pa.int64()), ("low", pa.int64())]
    read_type = pa.list_(pa.struct(place))
    schema = pa.schema([("row_id", pa.int64()), ("n_removed", pa.int64()), ("sha", pa.string()), ("read", read_type)])
    own = spans.select("row_id", "start", "size", (F.col("first") < F.col("rank")).alias("goes"))
    sources = spans.select(
        F.col("from_row").alias("row_id"), F.col("from_start").alias("start"), "size", F.lit(False).alias("goes")
    )
    places = own.unionByName(sources).groupBy("row_id", "start", "size").agg(F.max("goes").alias("goes"))
    by_row = places.groupBy("row_id").agg(F.collect_list(F.struct("start", "size", "goes")).alias("places"))
    return with_texts(docs, by_row).mapInArrow(
        run, "row_id long, n_removed long, sha string, read array<struct<start:int,size:int,high:long,low:long>>"
    )


def differ(spans: DataFrame, read: DataFrame) -> bool:
    """Whether the words of a span differ from those at its source."""
    words = read.select("row_id", F.explode("read").alias("at")).select("row_id", "at.*")
    source = words.toDF("from_row", "from_start", "size", "from_high", "from_low")
    both = spans.join(words, ["row_id", "start", "size"]).join(source, ["from_row", "from_start", "size"])
    return not both.filter("high <> from_high or low <> from_low").isEmpty()


def repeated_spans(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, span: int = SPAN, anchor: int = ANCHOR
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Three tables: the documents (row_id, doc_id, n_words, sha); the spans found elsewhere before (row_id, rank, start,
    size in windows, first, from_row, from_start), verified; what they leave of theirs and of their sources' documents
    (row_id, n_removed, sha). docs must be stored."""
    row = fresh(docs, "row")
    slim = numbered(docs, row).select(
        F.col(row).alias("row_id"), F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")
    )
    anchor = min(anchor, span)
    for seed in range(SEEDS):
        runs = materialize(documents_runs(slim, seed, span, anchor))
        spans = repeated_paths(slim, runs, seed, span)
        spans = materialize(spans.filter("from_row <> row_id or from_start <> start"))
        read = materialize(read_again(slim, spans, span))
        if not differ(spans, read):
            return runs.select("row_id", "doc_id", "n_words", "sha"), spans, read.drop("read")
    raise RuntimeError(f"hashes of different windows met with each of {SEEDS} seeds")


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, span: int = SPAN, anchor: int = ANCHOR
) -> DataFrame:
    """One row per document: row_id, doc_id, n_words, n_removed, kept_sha256. docs must be a stored table."""
    keys, _, read = repeated_spans(docs, id_col, text_col, span=span, anchor=anchor)
    rows = keys.join(read.withColumnRenamed("sha", "after"), "row_id", "left")
    return rows.select(
        "row_id",
        "doc_id",
        "n_words",
        F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("after", "sha").alias("kept_sha256"),
    )
