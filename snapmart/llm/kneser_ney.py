"""Perplexity by an interpolated modified Kneser-Ney model over characters, and thresholds by language.

The model is of order ORDER over code points; those beyond the basic plane share one symbol, so that a gram is one long.
Counts come from all trusted text: every reading partition counts its own grams, and a shuffle by gram sums them.
Lower orders count different left neighbours. Discounts follow from the counts of counts of each order. All tables are
sharded by gram, and probabilities are joins of counts with the totals of their context and the probability of their
suffix. To score, the different grams of each block of documents are joined with the tables once, which gives each block
the part of the model it needs; that part and the block's documents, which travel as compressed Arrow batches, meet in
one task. A block is so much text, whatever the number of files. But for trusted ids up to a counted number, nothing is
broadcast, and no document's grams are shuffled one by one.

A document is kept if its perplexity is at most the QUANTILE quantile of the trusted documents of its language; languages
without trusted documents take that of all trusted documents. A model knows the documents it counted better than others,
so the quantile is of perplexities by a model that did not count them: trusted documents fall in two folds by the hash of
their text, which keeps copies together, and each fold is scored by the counts of the other; only trusted documents are.

Defined results: a null text counts as empty, and an empty text has the perplexity of the end mark. Null languages are a
language of their own. Repeated rows are scored one by one; a trusted id that repeats is trusted in every row. Without
any trusted text the perplexity is null and every document is kept. Where all trusted text falls in one fold, the quantile
is of the perplexities by the whole model. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapmart.llm.store import fresh, materialize, numbered, small_enough

ORDER = 4
QUANTILE = 0.99
FOLDS = 2
#: Trusted ids broadcast at most: 8 bytes each.
BROADCAST_IDS = 2_000_000
#: Characters of a block, and of what a task reads at least.
BLOCK = 32 << 20
TASK = 4 << 20
#: Zstandard level of the texts that travel to their grams: they are the larger part of what is shuffled.
LEVEL = 6
#: Grams that a task of the model holds at least.
TASK_GRAMS = 1 << 19
BEGIN, STOP, BEYOND = 0x02, 0x03, 0xFFFD
BITS = 16


def grams_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Grams of all texts, each text begun by marks and ended by one, and how many each text has."""
    marked = [np.frombuffer(text.encode("utf-32-le"), np.uint32) for text in texts]
    sizes = np.array([len(points) + 1 for points in marked], np.int64)
    begin, stop = np.full(ORDER - 1, BEGIN, np.uint32), np.array([STOP], np.uint32)
    points = np.concatenate([part for text in marked for part in (begin, text, stop)] or [begin[:0]])
    points = np.where(points > 0xFFFF, BEYOND, points).astype(np.uint64)
    if not len(points):
        return np.array([], np.int64), sizes
    grams = points[: len(points) - ORDER + 1].copy()
    for at in range(1, ORDER):
        grams = (grams << np.uint64(BITS)) | points[at : len(points) - ORDER + 1 + at]
    # A text's windows are followed by those that reach into the marks of the next.
    ends = np.cumsum(sizes + ORDER - 1)
    keep = np.ones(len(grams), bool)
    for back in range(1, ORDER):
        keep[ends[:-1] - back] = False
    return grams[keep].view(np.int64), sizes


def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Grams of a partition and their counts; what is held is bounded by the partition's different grams."""
    grams, counts = np.array([], np.int64), np.array([], np.int64)
    for batch in batches:
        for at in range(0, len(batch), 512):
            own, n = np.unique(grams_of(batch["text"].iloc[at : at + 512].tolist())[0], return_counts=True)
            grams, where = np.unique(np.concatenate([grams, own]), return_inverse=True)
            counts = np.bincount(where, np.concatenate([counts, n]), len(grams)).astype(np.int64)
    yield pd.DataFrame({"gram": grams, "n": counts})


def packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Documents of a block as compressed Arrow streams."""
    for batch in batches:
        for part in (own for at in range(0, len(batch), 512) for _, own in batch.iloc[at : at + 512].groupby("block")):
            table = pa.Table.from_pandas(part.drop(columns="block"), preserve_index=False)
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", LEVEL))) as writer:
                writer.write_table(table)
            yield pd.DataFrame({"block": part["block"].iloc[:1].to_numpy(), "data": [sink.getvalue().to_pybytes()]})


def scored(docs: pd.DataFrame, model: pd.DataFrame) -> pd.DataFrame:
    """Log probability of each document of a block."""
    model = model.sort_values("gram")
    grams, logs = model["gram"].to_numpy(), model["log_p"].to_numpy()
    out = []
    for data in docs["data"]:
        part = pa.ipc.open_stream(data).read_pandas()
        own, sizes = grams_of(part["text"].tolist())
        at = np.minimum(np.searchsorted(grams, own), len(grams) - 1)
        if not np.array_equal(grams[at], own):
            raise ValueError("a block has grams that it did not ask for")
        sums = np.add.reduceat(logs[at], np.cumsum(sizes) - sizes)
        out.append(pd.DataFrame({"row_id": part["row_id"], "log_p": sums, "events": sizes}))
    return pd.concat(out, ignore_index=True) if out else pd.DataFrame({"row_id": [], "log_p": [], "events": []})


def suffix(gram: Column, order: int) -> Column:
    """The last characters of a gram, as a gram of that order."""
    return gram.bitwiseAND(F.lit((1 << BITS * order) - 1))


def context(gram: Column) -> Column:
    return F.shiftrightunsigned(gram, BITS)


def discounts(counts: DataFrame) -> list[float]:
    """Discounts of counts of one, two, and three or more."""
    n = counts.agg(*[F.sum((F.col("n") == k).cast("long")).alias(f"n{k}") for k in (1, 2, 3, 4)]).first()
    if not all(n):
        return [0.5, 0.75, 0.9]
    rate = n[0] / (n[0] + 2 * n[1])
    return [min(max(k - (k + 1) * rate * n[k] / n[k - 1], 0.05), k - 0.05) for k in (1, 2, 3)]


def model_tables(counts: DataFrame) -> tuple[list[DataFrame], list[DataFrame], float]:
    """By order from 1: probabilities (gram, p) and back-off weights (context, back); and that of an unseen character.

    counts: gram, n of the highest order, materialized. The tables of the other orders are no larger, and get as few tasks.
    """
    tasks = counts.count() // TASK_GRAMS + 1
    levels = [counts]
    for order in range(ORDER - 1, 0, -1):
        shorter = levels[0].groupBy(suffix(F.col("gram"), order).alias("gram")).agg(F.count(F.lit(1)).alias("n"))
        levels.insert(0, materialize(shorter.coalesce(tasks)))
    probabilities, backs, unseen = [], [], 0.0
    for order, level in enumerate(levels, 1):
        cut = discounts(level)
        taken = F.when(F.col("n") == 1, cut[0]).when(F.col("n") == 2, cut[1]).otherwise(cut[2])
        rows = level.select("gram", "n", context(F.col("gram")).alias("context"), taken.alias("cut"))
        totals = rows.groupBy("context").agg(F.sum("n").alias("total"), F.round(F.sum("cut"), 9).alias("taken"))
        totals = materialize(totals.coalesce(tasks))
        totals = totals.select("context", "total", (F.col("taken") / F.col("total")).alias("back"))
        own = rows.join(totals, "context").select("gram", ((F.col("n") - F.col("cut")) / F.col("total")).alias("own"), "back")
        if order == 1:
            symbols, back = own.agg(F.count(F.lit(1)), F.max("back")).first()
            unseen = back / (symbols + 1)
            p = own.select("gram", (F.col("own") + unseen).alias("p"))
        else:
            lower = probabilities[-1].select(F.col("gram").alias("lower"), F.col("p").alias("rest"))
            joined = own.join(lower, suffix(F.col("gram"), order - 1) == F.col("lower"))
            p = joined.select("gram", (F.col("own") + F.col("back") * F.col("rest")).alias("p"))
        probabilities.append(materialize(p.coalesce(tasks)))
        backs.append(totals.select("context", "back"))
    return probabilities, backs, unseen


def log_probabilities(asked: DataFrame, probabilities: list[DataFrame], backs: list[DataFrame], unseen: float) -> DataFrame:
    """gram, log_p of the asked grams, seen or not: the longest seen suffix, times the back-off weights above it.

    asked: gram, materialized."""
    tasks = asked.count() // TASK_GRAMS + 1
    rows = asked.select("gram", F.lit(None).cast("double").alias("p"), F.lit(1.0).alias("weight"))
    for order in range(ORDER, 0, -1):
        own, above = suffix(F.col("gram"), order) if order < ORDER else F.col("gram"), probabilities[order - 1]
        seen = above.select(F.col("gram").alias("seen"), F.col("p").alias("found"))
        rows = rows.join(seen, own == F.col("seen"), "left")
        rows = rows.withColumn("p", F.coalesce("p", F.col("weight") * F.col("found"))).drop("seen", "found")
        if order > 1:
            rows = rows.join(backs[order - 1], context(own) == F.col("context"), "left")
            rows = rows.withColumn("weight", F.col("weight") * F.coalesce("back", F.lit(1.0))).drop("context", "back")
        rows = rows.coalesce(tasks)
    return rows.select("gram", F.log(F.coalesce("p", F.col("weight") * unseen)).alias("log_p"))


def train(trusted: DataFrame, text_col: str = "text") -> DataFrame:
    """Counts of all grams of the trusted documents."""
    texts = trusted.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return materialize(texts.mapInPandas(counted, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")))


def merged(parts: list[DataFrame]) -> DataFrame:
    """Counts of all parts together. parts: gram, n, materialized."""
    tasks, both = sum(part.count() for part in parts) // TASK_GRAMS + 1, parts[0]
    for part in parts[1:]:
        both = both.unionByName(part)
    return materialize(both.groupBy("gram").agg(F.sum("n").alias("n")).coalesce(tasks))


def fold_of(text: Column) -> Column:
    """The fold of a text; copies have the same."""
    return F.pmod(F.xxhash64(F.coalesce(text, F.lit(""))), F.lit(FOLDS)).cast("int")


def sized(docs: DataFrame, text_col: str = "text") -> tuple[int, int, int]:
    """Rows of a block of about BLOCK characters, the files it spans, and the tasks that read TASK characters at least."""
    row = fresh(docs, "row")
    files = F.count_distinct(F.shiftright(row, 33))
    rows, chars, files = numbered(docs, row).agg(F.count(F.lit(1)), F.sum(F.length(text_col)), files).first()
    chars, block_rows = max(chars or 0, 1), BLOCK * rows // max(chars or 0, 1)
    return max(block_rows, 1), max(block_rows * files // max(rows, 1), 1), chars // TASK + 1


def perplexities(
    docs: DataFrame,
    counts: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    sizes: tuple[int, int, int] | None = None,
    only: DataFrame | None = None,
    fold: int | None = None,
) -> DataFrame:
    """row_id, perplexity, events of the documents under the model of the counts.

    sizes: what sized() says of the table, if known. only: the ids (doc_id) and fold: the fold of the documents to score.
    """
    row = fresh(docs, "row")
    block_rows, block_files, tasks = sizes or sized(docs, text_col)
    rows = numbered(docs, row).select(
        F.col(row).alias("row_id"), F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    if only is not None:
        rows = rows.filter(fold_of(F.col("text")) == fold).join(only, "doc_id", "left_semi")
    # Rows are numbered by file and place, so that a block is the same rows in every scan, and of any cut of the files.
    file, place = F.shiftright("row_id", 33), F.col("row_id").bitwiseAND(F.lit((1 << 33) - 1))
    block = F.shiftleft(F.floor(file / block_files), 33) + F.floor(place / block_rows)
    rows = rows.select("row_id", "text", block.alias("block"))

    def grams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block, found = None, None
        for batch in batches:
            for at, part in batch.groupby("block", sort=False):
                if at != block and found is not None:
                    yield pd.DataFrame({"block": block, "gram": found})
                    found = None
                fresh_grams = next(counted(iter([part])))["gram"].to_numpy()
                found = fresh_grams if found is None else np.union1d(found, fresh_grams)
                block = at
        if found is not None:
            yield pd.DataFrame({"block": block, "gram": found})

    # Few tasks, however many files, ask for the grams of a block.
    asked = rows.select("block", "text").coalesce(tasks).mapInPandas(grams, "block long, gram long")
    asked = materialize(asked.distinct().coalesce(tasks))
    logs = log_probabilities(materialize(asked.select("gram").distinct()), *model_tables(counts))
    parts = asked.join(logs, "gram")
    texts = rows.coalesce(tasks).mapInPandas(packed, "block long, data binary")
    met = texts.groupBy("block").cogroup(parts.groupBy("block"))
    out = met.applyInPandas(scored, "row_id long, log_p double, events long")
    return out.select("row_id", F.round(F.exp(-F.col("log_p") / F.col("events")), 6).alias("perplexity"), "events")


def quality(
    docs: DataFrame,
    trusted_ids: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    *,
    quantile: float = QUANTILE,
) -> DataFrame:
    """One row per document: row_id, doc_id, lang, trusted, perplexity, threshold, kept. trusted_ids: doc_id."""
    ids = materialize(trusted_ids.select("doc_id").filter("doc_id is not null").distinct())
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    known = slim.join(small_enough(ids, BROADCAST_IDS), "doc_id", "left_semi")
    folds = [train(known.filter(fold_of(F.col("text")) == fold)) for fold in range(FOLDS)]
    row = fresh(docs, "row")
    keys = numbered(docs, row).select(F.col(row).alias("row_id"), F.col(id_col).alias("doc_id"), F.col(lang_col).alias("lang"))
    keys = keys.join(ids.withColumn("trusted", F.lit(True)), "doc_id", "left").withColumn("trusted", F.coalesce("trusted", F.lit(False)))
    held = [not fold.isEmpty() for fold in folds]
    if not any(held):
        nothing = F.lit(None).cast("double")
        return keys.select("row_id", "doc_id", "lang", "trusted", nothing.alias("perplexity"), nothing.alias("threshold"), F.lit(True).alias("kept"))
    sizes = sized(docs, text_col)
    rows = keys.join(perplexities(docs, merged(folds), id_col, text_col, sizes).drop("events"), "row_id")
    if all(held):
        only = small_enough(ids, BROADCAST_IDS)
        other = [perplexities(docs, folds[1 - fold], id_col, text_col, sizes, only, fold) for fold in range(FOLDS)]
        unseen = other[0].unionByName(other[1]).select("row_id", F.col("perplexity").alias("unseen"))
        rows = materialize(rows.join(unseen, "row_id", "left"))
    else:
        rows = materialize(rows.withColumn("unseen", F.lit(None).cast("double")))
    at = F.round(F.percentile_approx(F.coalesce("unseen", "perplexity"), F.lit(quantile), F.lit(10_000)), 6)
    trusted = rows.filter("trusted")
    by_lang = trusted.groupBy(F.col("lang").alias("of")).agg(at.alias("own"))
    overall = trusted.agg(at).first()[0]
    judged = rows.join(by_lang, F.col("lang").eqNullSafe(F.col("of")), "left")
    threshold = F.coalesce("own", F.lit(overall))
    return judged.select(
        "row_id", "doc_id", "lang", "trusted", "perplexity", threshold.alias("threshold"), (F.col("perplexity") <= threshold).alias("kept")
    )
