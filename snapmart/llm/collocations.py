"""Phrase collocations by set-oriented mining (SETM): relations of occurrences, extended by merge-joins.

The relation of length k holds every occurrence of a frequent phrase of k words as (piece, position, group), sorted. It is
persisted a block per row: a block is so many bytes of text in whole pieces, numbered throughout, with a place left free
between pieces, so that piece and position are one ascending number. A round

- merge-joins the relation with itself where a place follows another, which gives the phrases of one word more,
- counts them by group: every block sums its own, a shuffle by group sums those. Words, and pairs by both sides, are dealt to
  parts by a hash, as many as keep a part small, and a block sends each part its own as one compressed row. A part numbers
  what is frequent, and answers each block with one compressed row of what it sent and is frequent,
- semi-joins the frequent groups: each block keeps the occurrences of those that it holds as the next relation. Only they
  are extended.

Occurrences never leave their block: what is shuffled to be counted are its different phrases. Groups are per language from
the words on. Up to a counted number the frequent groups are broadcast as one row, and every block looks them up where it
lies. Beyond it the blocks, compressed, travel to meet their answers.

Parts of a frequent phrase are frequent, so that the counts of all cuts are at hand. Products are decimals of 38 digits.

Defined results: a null text is empty, a null language `und`. Repeated rows count again. Texts longer than a block are dealt
to several at the ends of pieces. Ids are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import gc
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from snapmart.llm.store import give_back, materialize, materialize_texts, slices

MIN_COUNT = 100
MAX_WORDS = 5
TOP = 2000
#: Bytes of text in a block.
BLOCK = 16 << 20
#: Occurrences whose pairs are counted in one part, about.
PART = 2 << 20
#: Words of blocks counted in one part, about.
WORDS = 1 << 19
#: Occurrences looked up at a time.
SPAN = 1 << 20
#: Parts of a language whose best are found before those of the language.
SALTS = 64
#: Rows broadcast at most: frequent groups, some tens of bytes each, and languages.
BROADCAST_GROUPS = 200_000
LANGS = 10_000
NO_LANG = "und"
# What ends a piece, and what else parts words. No UTF-8 text holds the byte 0xFF.
ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
MARK = b"\xff"
FOLD = bytes.maketrans(ENDS + b"\t", b"\n" * len(ENDS) + b" ")


def tokens_of(data: bytes) -> list[bytes]:
    """Words of a text, with a mark behind each piece."""
    return data.lower().translate(FOLD).replace(b"\n", b" " + MARK + b" ").split() + [MARK]


def pieces_of(text: str | None, size: int) -> Iterator[bytes]:
    """A text in parts of about so many bytes, cut where pieces end."""
    data = (text or "").encode("utf-8")
    begin = 0
    while len(data) - begin > size:
        end = min((at for at in (data.find(bytes([c]), begin + size) for c in ENDS) if at >= 0), default=len(data))
        yield data[begin:end]
        begin = end
    yield data[begin:]


def blocks(docs: DataFrame, size: int) -> DataFrame:
    """block, langs with the words of each (how many) and all their occurrences, words (different ones by language) with their
    tags (which language) and counts, data: places and words of all occurrences. docs: lang, text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, ids, tags, words = 0, [], [], []
        known: dict[str, tuple[int, dict[bytes, int]]] = {}

        def made() -> pa.RecordBatch:
            whole = np.concatenate(ids)
            places = np.flatnonzero(whole >= 0).astype(np.int32)
            counts = np.bincount(whole[places], minlength=len(words))
            sums = np.zeros(len(known), np.int64)
            np.add.at(sums, tags, counts)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([list(known)], pa.list_(pa.string())),
                    pa.array([np.bincount(tags, minlength=len(known))], pa.list_(pa.int64())),
                    pa.array([sums], pa.list_(pa.int64())),
                    pa.array([tags], pa.list_(pa.int32())),
                    pa.array([words], pa.list_(pa.string())),
                    pa.array([counts], pa.list_(pa.int32())),
                    pa.array([shrunk(places, whole[places])], pa.binary()),
                ],
                names=["langs", "sizes", "sums", "tags", "words", "counts", "data"],
            )

        for part in slices(batches):
            for lang, text in zip(part["lang"].to_pylist(), part["text"]):
                tag, own = known.setdefault(lang, (len(known), {MARK: -1}))
                for data in pieces_of(text.as_py(), size):
                    tokens = tokens_of(data)
                    for word in dict.fromkeys(tokens):
                        if word not in own:
                            own[word] = len(words)
                            words.append(word.decode("utf-8"))
                            tags.append(tag)
                    ids.append(np.fromiter(map(own.__getitem__, tokens), np.int32, len(tokens)))
                    held += len(data)
                    if held >= size:
                        yield made()
                        held, ids, tags, words = 0, [], [], []
                        known.clear()
                        tag, own = known.setdefault(lang, (0, {MARK: -1}))
        if words:
            yield made()

    lists = "langs array<string>, sizes array<long>, sums array<long>, tags array<int>, words array<string>, counts array<int>"
    made = docs.mapInArrow(run, f"{lists}, data binary")
    return materialize(made.withColumn("block", F.monotonically_increasing_id()))


def shrunk(places: np.ndarray, which: np.ndarray) -> bytes:
    """Ascending places, as steps from one to the next, and what is there as one compressed Arrow stream."""
    steps = np.diff(places, prepend=places.dtype.type(0))
    batch = pa.RecordBatch.from_arrays([pa.array(steps), pa.array(which)], names=["steps", "which"])
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def grown(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    steps, which = (column.to_numpy() for column in pa.ipc.open_stream(data).read_next_batch().columns)
    return np.cumsum(steps, dtype=steps.dtype), which


def packed(first: np.ndarray, *more: np.ndarray) -> bytes:
    """Whole numbers, the first as steps from one to the next, compressed with like bytes side by side."""
    arrays = [np.diff(first, prepend=0), *more]
    planes = [np.ascontiguousarray(array, np.int64).view(np.uint8).reshape(-1, 8).T.tobytes() for array in arrays]
    return pa.compress(b"".join(planes), codec="zstd", asbytes=True)


def unpacked(data: bytes, size: int, arrays: int) -> list[np.ndarray]:
    raw = np.frombuffer(pa.decompress(data, 8 * size * arrays, codec="zstd", asbytes=True), np.uint8)
    first, *more = (np.ascontiguousarray(planes.T).view(np.int64).ravel() for planes in raw.reshape(arrays, 8, size))
    return [np.cumsum(first), *more]


def keys_of(row: pa.RecordBatch) -> pa.StringArray:
    """The words of a block, each with its language behind a blank, which no word holds."""
    langs, tags, words = (row[name].flatten() for name in ("langs", "tags", "words"))
    return pc.binary_join_element_wise(words, langs.take(tags), " ")


def dealt(block: int, part: np.ndarray, parts: int, rows) -> pa.RecordBatch:
    """part, block, size, data: what a block sends each part. part: of each row. rows: the data of those at some places."""
    order = np.argsort(part.astype(np.uint16) if parts <= 1 << 16 else part, kind="stable")
    sizes = np.bincount(part, minlength=parts)
    to = np.flatnonzero(sizes)
    ends = np.cumsum(sizes)[to]
    data = [rows(order[end - size : end]) for size, end in zip(sizes[to], ends)]
    columns = [pa.array(to, pa.int32()), pa.array(np.full(len(to), block)), pa.array(sizes[to], pa.int32()), pa.array(data, pa.binary())]
    return pa.RecordBatch.from_arrays(columns, names=["part", "block", "size", "data"])


def answered(own: pa.Table, ids: np.ndarray, n: np.ndarray, named: list[np.ndarray], least: int, answers: bool) -> tuple[np.ndarray, np.ndarray, list]:
    """Which ids are frequent in a part and how often they occur; and what the blocks that sent its rows are told: block, size,
    data (names and groups of the frequent ones). ids, n, named: of each row."""
    sums = np.zeros(ids.max() + 1, np.int64)
    np.add.at(sums, ids, n)
    some = np.flatnonzero(sums >= least)
    groups = np.full(len(sums), -1, np.int64)
    groups[some] = (own["part"][0].as_py() << 32) + np.arange(len(some))
    groups = groups[ids]
    told, end = [], 0
    for block, size in zip(own["block"].to_pylist(), own["size"].to_pylist()) if answers else ():
        begin, end = end, end + size
        good = np.flatnonzero(groups[begin:end] >= 0) + begin
        if len(good):
            told.append((block, len(good), packed(*(names[good] for names in named), groups[good])))
    return some, sums[some], told


def frequent_groups(counted: DataFrame, names: dict[str, str], run) -> tuple[DataFrame, DataFrame]:
    """The frequent groups: group, more, f; and what blocks are told of them: of (the block), size, data.

    counted: what blocks sent the parts. names: more columns of a group and their types. run: values of these columns, f and the
    answers of a part. A group's number is that of its part and its place there.
    """
    listed = {**names, "f": "long"}
    kinds = {"string": pa.string(), "long": pa.int64()}
    schema = pa.schema(
        [("part", pa.int32()), ("of", pa.int64()), ("size", pa.int32()), ("data", pa.binary()), *((name, pa.list_(kinds[kind])) for name, kind in listed.items())]
    )

    def part(own: pa.Table) -> pa.Table:
        # Rows come in any order: that of the blocks gives the same numbers again.
        own = own.sort_by("block")
        *columns, told = run(own)
        at = own["part"][0].as_py()
        rows = [{"part": at, **{name: column for name, column in zip(listed, columns)}}, *({"part": at, "of": of, "size": size, "data": data} for of, size, data in told)]
        made = pa.Table.from_pylist(rows, schema)
        del own, columns, told, rows
        give_back()
        return made

    kinds_of = ", ".join(f"{name} array<{kind}>" for name, kind in listed.items())
    whole = materialize(counted.groupBy("part").applyInArrow(part, f"part int, of long, size int, data binary, {kinds_of}"))
    groups = whole.filter("of is null").select("part", F.posexplode(F.arrays_zip(*listed)).alias("at", "own"))
    number = F.shiftleft(F.col("part").cast("long"), 32) + F.col("at")
    groups = groups.select(number.alias("group"), *(F.col(f"own.{name}").alias(name) for name in listed))
    return materialize(groups), whole.filter("of is not null").select("of", "size", "data")


def frequent_words(counted: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """The frequent words: group, key, f; and what blocks are told: places in their words, and groups."""

    def run(own: pa.Table) -> tuple:
        at, n, sizes, texts = [], [], [], []
        for data, size in zip(own["data"], own["size"].to_pylist()):
            *numbers, text = unpacked_keys(data.as_py(), size)
            for held, some in zip((at, n, sizes), numbers):
                held.append(some)
            texts.append(text)
        at, n, sizes = (np.concatenate(held) for held in (at, n, sizes))
        ends = np.concatenate([np.zeros(1, np.int64), np.cumsum(sizes)])
        keys = pa.Array.from_buffers(pa.large_string(), len(sizes), [None, pa.py_buffer(ends), pa.py_buffer(b"".join(texts))])
        del texts
        found = keys.dictionary_encode()
        some, f, told = answered(own, found.indices.to_numpy(), n, [at], least, True)
        return found.dictionary.take(pa.array(some)).to_pylist(), f, told

    return frequent_groups(counted, {"key": "string"}, run)


def frequent_pairs(counted: DataFrame, least: int, answers: bool = True) -> tuple[DataFrame, DataFrame]:
    """The frequent pairs of groups: group, left, right, f; and what blocks are told: left, right and group."""

    def run(own: pa.Table) -> tuple:
        arrays = [unpacked(data.as_py(), size, 3) for data, size in zip(own["data"], own["size"].to_pylist())]
        left, right, n = (np.concatenate(column) for column in zip(*arrays))
        del arrays
        (first, lefts), (second, rights) = (pd.factorize(side) for side in (left, right))
        ids, codes = pd.factorize(first * np.int64(len(rights)) + second)
        del first, second
        some, f, told = answered(own, ids, n, [left, right], least, answers)
        codes = codes[some]
        return lefts[codes // len(rights)], rights[codes % len(rights)], f, told

    return frequent_groups(counted, {"left": "long", "right": "long"}, run)


def released(df: DataFrame) -> None:
    """Let Spark delete the shuffle and checkpoint files of tables no longer named: it does when the driver's JVM collects them,
    which by itself can be after the last round. What a job before this call used may go with the next call only."""
    gc.collect()
    df.sparkSession.sparkContext._jvm.System.gc()


def kept(places: np.ndarray, codes: np.ndarray, some: np.ndarray, groups: np.ndarray) -> tuple[np.ndarray, bytes]:
    """Groups and data of a relation: the occurrences whose code is one of some, which differ and have these groups."""
    found = np.full(len(codes), -1, np.int32)
    if len(some):
        index = pd.Index(some.astype(codes.dtype))
        for at in range(0, len(codes), SPAN):
            found[at : at + SPAN] = index.get_indexer(codes[at : at + SPAN])
    good = found >= 0
    found = found[good]
    held = np.bincount(found, minlength=len(some)) > 0
    new = np.cumsum(held, dtype=np.int32) - np.int32(1)
    return groups[held], shrunk(places[good], new[found])


def looked_up(rows: DataFrame, groups: DataFrame, codes, look_up) -> DataFrame:
    """block, groups, data (places and, for each, which of the groups): the occurrences of the frequent groups, sorted.

    All groups come as one row to where the rows lie. codes: places and codes of the occurrences in the data of a row.
    look_up: codes and groups of those that a row can hold.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1)
                own, data = kept(*codes(row["data"][0].as_py()), *look_up(row, row["frequent"].flatten()))
                columns = [row["block"], pa.array([own], pa.list_(pa.int64())), pa.array([data], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["block", "groups", "data"])
                del row, own, data, columns
            del batch
            give_back()

    listed = groups.agg(F.collect_list(F.struct(*groups.columns)).alias("frequent"))
    return materialize_texts(rows.crossJoin(F.broadcast(listed)).mapInArrow(run, "block long, groups array<long>, data binary"))


def joined(rows: DataFrame, answers: DataFrame, arrays: int, run) -> DataFrame:
    """The same by what every block is told. run: groups and data of a row and its answers, so many arrays."""

    def told(own: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        found = [unpacked(data, size, arrays) for data, size in zip(answers["data"], answers["size"])]
        found = [np.concatenate(column) for column in zip(*found)] if found else [np.zeros(0, np.int64)] * arrays
        made = [(row.block, *run(row, *found)) for row in own.itertuples()]
        del own, answers, found
        give_back()
        return pd.DataFrame(made, columns=["block", "groups", "data"])

    return materialize(rows.groupBy("block").cogroup(answers.groupBy("of")).applyInPandas(told, "block long, groups array<long>, data binary"))


def words_kept(blocks: DataFrame, groups: DataFrame, answers: DataFrame) -> DataFrame:
    """The relation of the frequent words."""

    def look_up(row: pa.RecordBatch, listed: pa.StructArray) -> tuple[np.ndarray, np.ndarray]:
        at = pc.index_in(keys_of(row), value_set=listed.field("key")).fill_null(-1).to_numpy()
        some = np.flatnonzero(at >= 0)
        return some, listed.field("group").to_numpy()[at[some]]

    if groups.count() <= BROADCAST_GROUPS:
        return looked_up(blocks.select("block", "langs", "tags", "words", "data"), groups.select("key", "group"), grown, look_up)
    return joined(blocks.select("block", "data"), answers, 2, lambda row, at, group: kept(*grown(row.data), at, group))


def pairs_kept(rows: DataFrame, groups: DataFrame, answers: DataFrame) -> DataFrame:
    """The relation of the frequent pairs of groups."""

    def codes_of(own: np.ndarray, left: np.ndarray, right: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        index = pd.Index(own)
        left, right = (index.get_indexer(side) for side in (left, right))
        both = (left >= 0) & (right >= 0)
        return left[both].astype(np.int64) << 32 | right[both], group[both]

    def look_up(row: pa.RecordBatch, listed: pa.StructArray) -> tuple[np.ndarray, np.ndarray]:
        return codes_of(row["groups"].flatten().to_numpy(), *(listed.field(name).to_numpy() for name in ("left", "right", "group")))

    if groups.count() <= BROADCAST_GROUPS:
        return looked_up(rows, groups.select("left", "right", "group"), adjacent, look_up)
    return joined(rows, answers, 3, lambda row, *found: kept(*adjacent(row.data), *codes_of(np.array(row.groups, np.int64), *found)))


def adjacent(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The merge-join of an ascending relation with itself at adjacent places: first places, and codes of both groups."""
    places, which = grown(data)
    next_to = np.diff(places) == 1
    codes = which[:-1][next_to].astype(np.int64)
    codes <<= 32
    codes |= which[1:][next_to]
    return places[:-1][next_to], codes


def packed_keys(at: np.ndarray, n: np.ndarray, keys: pa.StringArray) -> bytes:
    """Places, counts and texts: 8 bytes that tell the length of the numbers, the numbers, the texts."""
    ends = np.frombuffer(keys.buffers()[1], np.int32, len(keys) + 1, 4 * keys.offset)
    numbers = packed(at, n, np.diff(ends))
    texts = keys.buffers()[2].slice(ends[0], ends[-1] - ends[0])
    return len(numbers).to_bytes(8, "little") + numbers + pa.compress(texts, codec="zstd", asbytes=True)


def unpacked_keys(data: bytes, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, bytes]:
    """Places, counts, lengths of the texts, the texts in one."""
    begin = 8 + int.from_bytes(data[:8], "little")
    at, n, sizes = unpacked(data[8:begin], size, 3)
    return at, n, sizes, pa.decompress(data[begin:], int(sizes.sum()), codec="zstd", asbytes=True)


def counted_words(blocks: DataFrame, parts: int) -> DataFrame:
    """part, block, size, data: the different words of every block (place among them, n, word and language), dealt by a hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                row = batch.slice(row, 1)
                keys, n = keys_of(row), row["counts"].flatten().to_numpy()
                part = np.fromiter((zlib.crc32(key) % parts for key in keys.cast(pa.binary()).to_pylist()), np.int64, len(keys))
                yield dealt(row["block"][0].as_py(), part, parts, lambda some: packed_keys(some, n[some], keys.take(pa.array(some))))
                del row, keys, n, part
            del batch
            give_back()

    return blocks.select("block", "langs", "tags", "words", "counts").mapInArrow(run, "part int, block long, size int, data binary")


def counted_pairs(rows: DataFrame, parts: int) -> DataFrame:
    """part, block, size, data: the different pairs of groups of every block (left, right, n), dealt by what they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, groups, data in zip(batch["block"], batch["groups"], batch["data"]):
                codes = adjacent(data.as_py())[1]
                own = groups.values.to_numpy()
                order = np.argsort(own)
                rank = np.empty(len(own), np.int64)
                rank[order] = np.arange(len(own))
                own = own[order]
                codes = rank[codes >> 32] << 32 | rank[codes & 0xFFFFFFFF]
                codes.sort()
                firsts = np.flatnonzero(np.diff(codes, prepend=-1))
                codes, n = codes[firsts], np.diff(firsts, append=len(codes))
                mixed = (own.view(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
                mixed ^= mixed >> np.uint64(29)
                mixed = (mixed[codes >> 32] * np.uint64(0xBF58476D1CE4E5B9) + mixed[codes & 0xFFFFFFFF]) * np.uint64(0x94D049BB133111EB)
                part = ((mixed >> np.uint64(32)) % np.uint64(parts)).astype(np.int64)
                yield dealt(block.as_py(), part, parts, lambda some: packed(own[codes[some] >> 32], own[codes[some] & 0xFFFFFFFF], n[some]))
                del codes, firsts, n, mixed, part
            give_back()

    return rows.mapInArrow(run, "part int, block long, size int, data binary")


def frequent_phrases(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", *, least: int = MIN_COUNT, most_words: int = MAX_WORDS, block: int = BLOCK
) -> tuple[DataFrame, DataFrame]:
    """lang, phrase, words, f of every frequent phrase; and lang, n: all word occurrences."""
    slim = docs.select(F.coalesce(F.col(lang_col), F.lit(NO_LANG)).alias("lang"), F.col(text_col).alias("text"))
    whole = blocks(slim, block)
    sums = whole.select(F.explode(F.arrays_zip("langs", "sizes", "sums")).alias("own")).select("own.*").toDF("lang", "words", "n")
    sums = materialize(sums.groupBy("lang").agg(F.sum("words").alias("words"), F.sum("n").alias("n")))
    words = sums.agg(F.sum("words")).first()[0] or 0
    groups, answers = frequent_words(counted_words(whole, words // WORDS + 1), least)
    rows = words_kept(whole, groups, answers)
    del whole, answers
    released(rows)
    # A key is a word, which holds no blank, a blank and a language.
    phrase = F.substring_index("key", " ", 1)
    level = groups.select(F.expr("substring(key, instr(key, ' ') + 1)").alias("lang"), phrase.alias("phrase"), F.lit(1).alias("words"), "f", "group")
    levels = [level]
    for length in range(2, most_words + 1):
        occurrences = groups.agg(F.sum("f")).first()[0] or 0
        groups, answers = frequent_pairs(counted_pairs(rows, occurrences // PART + 1), least, length < most_words)
        released(rows)
        left = level.select("lang", F.col("phrase").alias("head"), F.col("group").alias("left"))
        right = level.select(F.substring_index("phrase", " ", -1).alias("last"), F.col("group").alias("right"))
        level = materialize(
            groups.join(left, "left").join(right, "right").select(
                "lang", F.concat_ws(" ", "head", "last").alias("phrase"), F.lit(length).alias("words"), "f", "group"
            )
        )
        levels.append(level)
        if length == most_words or level.isEmpty():
            break
        rows = pairs_kept(rows, groups, answers)
        del answers
        released(rows)
    found = levels[0]
    for level in levels[1:]:
        found = found.unionByName(level)
    return found.drop("group"), sums.drop("words")


def exact_score(a: str, n: str, left: str, right: str):
    """floor(1000 a n / (l r)), for counts of up to 13 and totals of up to 16 digits."""
    above = f"cast(1000 as decimal(4, 0)) * cast({a} as decimal(13, 0)) * cast({n} as decimal(16, 0))"
    return F.expr(f"({above}) div (cast({left} as decimal(13, 0)) * cast({right} as decimal(13, 0)))")


def collocations(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    *,
    least: int = MIN_COUNT,
    most_words: int = MAX_WORDS,
    top: int = TOP,
    block: int = BLOCK,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the best phrases of every language."""
    found, totals = frequent_phrases(docs, text_col, lang_col, least=least, most_words=most_words, block=block)
    phrases = found.filter("words > 1").withColumn("word", F.split("phrase", " ")).withColumnRenamed("f", "a")
    part = lambda at, size: F.concat_ws(" ", F.slice("word", at, size))
    cuts = phrases.select("lang", "phrase", "a", "words", "word", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("cut"))
    cuts = cuts.select("lang", "phrase", "a", "cut", part(F.lit(1), F.col("cut")).alias("head"), part(F.col("cut") + 1, F.col("words") - F.col("cut")).alias("tail"))
    heads = found.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l"))
    tails = found.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r"))
    cuts = cuts.join(heads, ["lang", "head"]).join(tails, ["lang", "tail"]).join(F.broadcast(totals) if totals.count() <= LANGS else totals, "lang")
    cuts = cuts.withColumn("score", exact_score("a", "n", "l", "r"))
    scored = cuts.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "cut", "l", "r")).alias("best"))

    # Parts of a longer candidate that occur nowhere else.
    inner = phrases.filter("words > 2").select("lang", "a", "word", "words", F.explode(F.sequence(F.lit(2), F.col("words") - 1)).alias("size"))
    inner = inner.select("lang", "a", "word", "size", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("size") + 1)).alias("at"))
    inner = inner.groupBy("lang", part(F.col("at"), F.col("size")).alias("phrase")).agg(F.max("a").alias("longer"))
    scored = scored.join(inner, ["lang", "phrase"], "left").filter("longer is null or longer < a")

    rows = scored.select("lang", "phrase", "a", "best.l", "best.r", "n", "best.score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salt = F.pmod(F.xxhash64("phrase"), F.lit(SALTS))
    some = rows.withColumn("salt", salt).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order)))
    some = some.filter(F.col("rank") <= top).withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    best = some.filter(F.col("rank") <= top)
    return best.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
