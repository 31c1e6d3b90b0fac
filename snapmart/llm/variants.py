"""Spelling variants: words one edit apart, found by dynamic programming over sorted word lists.

A pair within one edit agrees before the edit and after it. Of the shorter word's length, a shard fixes a range of places
where the edit may be: its words agree before the range and behind it. Two ranges, the front and the back half, hold every
pair; a shard of more than SHARD_WORDS words is dealt anew by the halves of its range, down to one place, where words that
agree on all the rest can only be as many as the letters. A pair counts in the range that holds its first difference only.

A shard's words are sorted, and the list is read as what its adjacent common prefixes make it: ranges of neighbours that
share a prefix. The edit matrix of a query is kept as a band of three cells. A step goes one letter deeper for all ranges
and all queries of a batch at once: a range's row is computed once from that of the shorter prefix, not once per word, and
ranges whose row has no cell within one edit are skipped with all their words.

Only sums and the best word leave a batch, not the pairs. Roots are found by pointer doubling, in joins.

Defined results: a null text has no words; a null id is written as an empty string before the colon. Repeated rows count
again. Ties of equal n take the first word in code-point order. An empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapmart.llm.store import materialize, slices, small_enough

RUN = re.compile("[a-zÀ-ÿ]+")
MIN_LENGTH = 5
MIN_COUNT = 3
#: One in so many runs of a document loses a letter, by the checksum of id and run.
LOSES = 97
SHARD_WORDS = 2048
BATCH_WORDS = 16_384
#: Different words counted in a task before they are handed on, and hot shards broadcast at most.
HELD_WORDS = 1 << 19
HOT_SHARDS = 100_000
SHARD = ["size", "low", "high", "shared"]
FAR = 9


def runs_of(doc_id: object, text: str | None) -> Counter:
    """Runs of a text, folded, those that lose a letter without it, and how often each occurs."""
    found = Counter(RUN.findall((text or "").encode("utf-8").lower().decode("utf-8")))
    start, out = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode()), Counter()
    for run, n in found.items():
        h = zlib.crc32(run.encode("utf-8"), start)
        if h % LOSES == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
        out[run] += n
    return out


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """word, n: the words that are long and frequent enough."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        held: Counter = Counter()

        def flush():
            batch = pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"]
            )
            held.clear()
            return batch

        for part in slices(batches):
            for doc_id, text in zip(part["doc_id"].to_pylist(), part["text"]):
                for word, n in runs_of(doc_id, text.as_py()).items():
                    if len(word) >= MIN_LENGTH:
                        held[word] += n
            if len(held) > HELD_WORDS:
                yield flush()
        yield flush()

    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    counted = slim.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return materialize(counted.filter(F.col("n") >= MIN_COUNT))


def in_shards(words: DataFrame) -> DataFrame:
    """word, n and the shards of its front and back half, as the shorter word and as the longer one."""
    size = F.explode(F.filter(F.array(F.length("word"), F.length("word") - 1), lambda x: x >= MIN_LENGTH)).alias("size")
    rows = words.select("word", "n", size)
    half = F.floor((F.col("size") + 1) / 2).cast("int")
    ranges = F.array(F.struct(F.lit(0).alias("low"), half.alias("high")), F.struct(half.alias("low"), (F.col("size") + 1).alias("high")))
    rows = rows.select("word", "n", "size", F.explode(ranges).alias("range"))
    return keyed(rows.select("word", "n", "size", "range.low", "range.high"))


def keyed(rows: DataFrame) -> DataFrame:
    """With what the words of a shard share: the letters before the range and behind it."""
    shared = F.expr("concat(substr(word, 1, low), right(word, greatest(size - high, 0)))")
    return rows.withColumn("shared", shared)


def halved(rows: DataFrame) -> DataFrame:
    middle = F.floor((F.col("low") + F.col("high")) / 2).cast("int")
    ranges = F.array(F.struct("low", middle.alias("high")), F.struct(middle.alias("low"), "high"))
    rows = rows.select("word", "n", "size", F.explode(ranges).alias("range"))
    return keyed(rows.select("word", "n", "size", "range.low", "range.high"))


def pairs_within_one(
    words: list[str], shard: np.ndarray, size: np.ndarray, low: np.ndarray, high: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Queries and words (as places in the list) at one edit, within each shard. words: sorted by shard, then as such."""
    points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    base = np.cumsum(lengths) - lengths + low
    rest = lengths - low
    points = np.append(points, np.zeros(3, np.uint32))

    def letter(who: np.ndarray, at: int) -> np.ndarray:
        inside = (at >= 0) & (at < rest[who])
        return np.where(inside, points[np.where(inside, base[who] + at, 0)], 0)

    # Common prefix with the word before, beyond what the shard shares; -1 where a shard begins.
    prefix = np.full(len(words), -1, np.int64)
    left = np.flatnonzero(shard[1:] == shard[:-1]) + 1
    prefix[left], depth = 0, 0
    while len(left):
        a, b = letter(left - 1, depth), letter(left, depth)
        left, depth = left[(a == b) & (a > 0)], depth + 1
        prefix[left] = depth

    starts = np.flatnonzero(prefix < 0)
    query = np.arange(len(words))
    node = np.searchsorted(starts, query, "right") - 1
    rows = np.array([[FAR, 0, 1]] * len(words), np.int8).reshape(-1, 3).T
    rows[2][rest < 1] = FAR
    differs = np.full(len(words), -1, np.int64)
    # A word of nothing but what its shard shares is the shard's first, and a letter off those of one letter more.
    b = starts[node]
    bare = (rest[b] == 0) & (rest[query] == 1) & (lengths[b] == size[b])
    found, depth = [(query[bare], b[bare]), (b[bare], query[bare])], 0
    query, node, differs, rows = (x[..., rest[query] > 0] for x in (query, node, differs, rows))
    while len(query):
        ranges = np.flatnonzero((prefix <= depth) & (rest > depth))
        parent = np.searchsorted(starts, ranges, "right") - 1
        begins = np.searchsorted(parent, np.arange(len(starts) + 1))
        often = np.diff(begins)[node]
        again = np.repeat(np.arange(len(query)), often)
        child = np.repeat(begins[node] - np.cumsum(often) + often, often) + np.arange(len(again))
        query, differs, (e0, e1, e2) = query[again], differs[again], rows[:, again]
        own = letter(ranges, depth)[child]
        here, ends = letter(query, depth), rest[query]
        n0 = np.minimum(e1 + 1, e0 + (own != letter(query, depth - 1)))
        n1 = np.minimum(np.minimum(e2, n0) + 1, e1 + (own != here))
        n1[ends < depth + 1] = FAR
        n2 = np.minimum(n1 + 1, e2 + (own != letter(query, depth + 1)))
        n2[ends < depth + 2] = FAR
        n0[ends < depth] = FAR
        differs = np.where((differs < 0) & (own != here), depth, differs)
        rows = np.minimum(np.stack([n0, n1, n2]), FAR).astype(np.int8)
        depth += 1
        word = ranges[child]
        over = ends - depth + 1
        last = (rest[word] == depth) & (over >= 0) & (over <= 2)
        at = np.flatnonzero(last)
        at = at[rows[over[at], at] == 1]
        a, b = query[at], word[at]
        where = np.where(differs[at] < 0, np.minimum(rest[a], rest[b]), differs[at]) + low[a]
        good = (np.minimum(lengths[a], lengths[b]) == size[a]) & (where < high[a])
        found.append((a[good], b[good]))
        near = rows.min(axis=0) <= 1
        query, node, differs, rows, starts = query[near], child[near], differs[near], rows[:, near], ranges
    return tuple(np.concatenate(side) for side in zip(*found))


def near_words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """word, n_near, best_n, best of each shard. Rows are sorted by shard and word; a shard may span batches."""

    def judged(rows: pd.DataFrame) -> pd.DataFrame:
        words, n = rows["word"].tolist(), rows["n"].to_numpy()
        shard = (rows[SHARD] != rows[SHARD].shift()).any(axis=1).cumsum().to_numpy()
        a, b = pairs_within_one(words, shard, *(rows[name].to_numpy(np.int64) for name in SHARD[:3]))
        order = np.lexsort((b, -n[b], a))
        a, b = a[order], b[order]
        first = np.flatnonzero(np.diff(a, prepend=-1))
        return pd.DataFrame(
            {
                "word": pd.Series([words[i] for i in a[first]], dtype=object),
                "n_near": np.diff(first, append=len(a)),
                "best_n": n[b[first]],
                "best": pd.Series([words[i] for i in b[first]], dtype=object),
            }
        )

    rest = None
    for batch in batches:
        rows = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
        cuts, begin = np.flatnonzero((rows[SHARD] != rows[SHARD].shift()).any(axis=1).to_numpy()), 0
        for end in cuts[1:]:  # the last shard may go on in the next batch
            if end - begin >= BATCH_WORDS or end == cuts[-1]:
                yield judged(rows.iloc[begin:end])
                begin = end
        rest = rows.iloc[begin:]
    if rest is not None and len(rest):
        yield judged(rest)


def neighbours(words: DataFrame, shard_words: int = SHARD_WORDS) -> DataFrame:
    """word, n_near, best_n, best of the words that have near ones. words: word, n, each word once."""
    rows, found = in_shards(words), None
    while True:
        counts = rows.groupBy(*SHARD).count()
        hot = materialize(counts.filter((F.col("count") > shard_words) & (F.col("high") - F.col("low") > 1)).drop("count"))
        any_hot = not hot.isEmpty()
        keys = small_enough(hot, HOT_SHARDS)
        cold = rows.join(keys, SHARD, "left_anti") if any_hot else rows
        cold = cold.repartition(*SHARD).sortWithinPartitions(*SHARD, "word")
        near = materialize(cold.mapInPandas(near_words, "word string, n_near long, best_n long, best string"))
        found = near if found is None else found.unionByName(near)
        if not any_hot:
            break
        rows = materialize(halved(rows.join(keys, SHARD, "left_semi")))
    best = F.min(F.struct((-F.col("best_n")).alias("n"), "best")).alias("top")
    found = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best)
    return found.select("word", "n_near", (-F.col("top.n")).alias("best_n"), F.col("top.best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """word, root: where the forms lead. forms: word, form. A form is twice as frequent at least, so that ways end."""
    ways = materialize(forms.select("word", F.col("form").alias("root")))
    while True:
        onward = ways.toDF("via", "onward")
        longer = ways.join(onward, F.col("root") == F.col("via"), "left")
        longer = materialize(longer.select("word", F.coalesce("onward", "root").alias("root"), F.col("onward").isNotNull().alias("moved")))
        ways = longer.drop("moved")
        if longer.filter("moved").isEmpty():
            return ways


def spelling_variants(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, shard_words: int = SHARD_WORDS
) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word."""
    words = vocabulary(docs, id_col, text_col)
    rows = words.join(neighbours(words, shard_words), "word", "left")
    often = F.col("best_n") >= 2 * F.col("n")
    rows = materialize(
        rows.select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(often, F.col("best")).alias("form"),
            F.when(often, F.col("best_n")).alias("form_n"),
        )
    )
    led = rows.join(roots(rows.filter("form is not null").select("word", "form")), "word", "left")
    return led.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
