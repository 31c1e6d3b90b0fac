"""BPE encoding and decoding, with tree concatenation for long texts.

Short texts are encoded where they are read. A long text is cut between pre-tokens, where its encoding falls apart by
itself; a single pre-token that is long (an unsplit run of letters, digits or signs) is cut into parts at any byte. All
parts are dealt over the cluster and encoded in parallel. The parts of a run are then joined in a tree, half by half:
a window around each join is encoded anew and grows until its first token is one of the left half's and its last token
one of the right half's. A sequence of BPE tokens is the encoding of its bytes exactly if every two neighbours are, so
such agreement on both sides makes the join exact. If the halves never agree, the window becomes both halves whole.

Defined results: a null or empty text has no tokens and decodes to the empty text. Special tokens written in a text are
encoded as the library does by default. Repeated rows and ids are encoded one by one; an empty table gives none.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapmart.llm.tokens import Loaded, default_path, load

#: Characters from which a text is encoded in parts, and the bytes of a part.
LONG_TEXT = 1 << 16
PART = 1 << 14
WINDOW = 16

#: The characters that the pre-tokenizer's pattern takes as white space.
WHITE = frozenset("\t\n\x0b\x0c\r \x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000") | {chr(c) for c in range(0x2000, 0x200B)}

ENCODED = "n_tokens long, ids_sha256 string, decoded_sha256 string"


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8")).hexdigest()


def digests(tokenizer: Loaded, ids: np.ndarray) -> tuple[int, str, str]:
    """Number of tokens, hash of the ids, hash of the text decoded from them."""
    return len(ids), sha256(",".join(map(str, ids.tolist()))), sha256(tokenizer.decode(ids))


def encode_run(tokenizer: Loaded, run: str) -> np.ndarray:
    """Ids of a text in the byte alphabet, taken as one pre-token."""
    return np.array([token.id for token in tokenizer.whole.model.tokenize(run)], np.uint32)


def join_halves(tokenizer: Loaded, left: np.ndarray, right: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Ids of the run whose halves have these ids."""
    name, size = tokenizer.whole.id_to_token, window
    while True:
        a, b = left[-size:], right[:size]
        ids = encode_run(tokenizer, "".join(map(name, [*a.tolist(), *b.tolist()])))
        agrees_left = len(a) == len(left) or len(ids) and ids[0] == a[0]
        agrees_right = len(b) == len(right) or len(ids) and ids[-1] == b[-1]
        if agrees_left and agrees_right:
            return np.concatenate([left[: len(left) - len(a)], ids, right[len(b) :]])
        size *= 2


def join_tree(tokenizer: Loaded, parts: list[np.ndarray], window: int = WINDOW) -> np.ndarray:
    """Ids of a run from those of its parts, neighbours first."""
    while len(parts) > 1:
        joined = [join_halves(tokenizer, a, b, window) for a, b in zip(parts[::2], parts[1::2])]
        parts = joined + parts[len(joined) * 2 :]
    return parts[0]


def cut(tokenizer: Loaded, text: str, part: int = PART) -> list[tuple[str, int, str]]:
    """(kind, run, text) of each part in order: plain texts, special tokens, and numbered runs in the byte alphabet."""
    parts: list[tuple[str, int, str]] = []
    plain: list[str] = []
    runs = room = 0

    def close(following: str = "") -> None:
        """End a part. White space before other text is split otherwise than at the end of a text, so it goes alone."""
        nonlocal room
        alone = [plain.pop()] if plain and following and following not in WHITE and plain[-1][-1] in WHITE else []
        for text in ("".join(plain), *alone):
            if text:
                parts.append(("plain", -1, text))
        plain.clear()
        room = part

    def add(section: str) -> None:
        nonlocal runs, room
        for written, (a, b) in tokenizer.whole.pre_tokenizer.pre_tokenize_str(section):
            if len(written) > part:
                close(section[a])
                parts.extend(("run", runs, written[at : at + part]) for at in range(0, len(written), part))
                runs += 1
                continue
            if len(written) > room:
                close(section[a])
            plain.append(section[a:b])
            room -= len(written)

    close()
    at = 0
    for match in tokenizer.special.finditer(text) if tokenizer.special else ():
        add(text[at : match.start()])
        close()
        parts.append(("special", -1, match.group()))
        at = match.end()
    add(text[at:])
    close()
    return parts


def split_long(path: str, part: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokenizer = load(path)
        for batch in batches:
            for row_id, doc_id, text in zip(batch["row_id"], batch["doc_id"], batch["text"]):
                parts = cut(tokenizer, text, part)
                out = pd.DataFrame(parts, columns=["kind", "run", "text"])
                yield out.assign(row_id=row_id, doc_id=doc_id, seq=range(len(parts)))

    return run


def encode_parts(path: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokenizer = load(path)
        for batch in batches:
            ids = [
                encode_run(tokenizer, text) if kind == "run" else tokenizer.encode(text)
                for kind, text in zip(batch["kind"], batch["text"])
            ]
            yield batch.drop(columns="text").assign(ids=[part.astype("<u4").tobytes() for part in ids])

    return run


def assemble(path: str):
    def run(parts: pd.DataFrame) -> pd.DataFrame:
        tokenizer = load(path)
        parts = parts.sort_values("seq")
        ids = [np.frombuffer(part, "<u4") for part in parts["ids"]]
        whole, runs, at = [], parts["run"].tolist(), 0
        while at < len(ids):
            end = at + 1
            while runs[at] >= 0 and end < len(ids) and runs[end] == runs[at]:
                end += 1
            whole.append(join_tree(tokenizer, ids[at:end]))
            at = end
        first = parts.iloc[:1][["row_id", "doc_id"]].reset_index(drop=True)
        n, ids_sha, text_sha = digests(tokenizer, np.concatenate(whole) if whole else np.array([], np.uint32))
        return first.assign(n_tokens=n, ids_sha256=ids_sha, decoded_sha256=text_sha)

    return run


def encode_short(path: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokenizer = load(path)
        for batch in batches:
            rows = [digests(tokenizer, tokenizer.encode(text)) for text in batch["text"]]
            out = pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])
            out.insert(0, "row_id", batch["row_id"].to_numpy())
            out.insert(1, "doc_id", batch["doc_id"].to_numpy())
            yield out

    return run


def encode_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    path: str | None = None,
    long_text: int = LONG_TEXT,
    part: int = PART,
) -> DataFrame:
    """One row per document: row_id, doc_id, n_tokens, ids_sha256, decoded_sha256."""
    path = path or default_path()
    texts = docs.select(
        F.monotonically_increasing_id().alias("row_id"),
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    key = f"row_id long, doc_id {texts.schema['doc_id'].dataType.simpleString()}"
    short = texts.filter(F.length("text") <= long_text).mapInPandas(encode_short(path), f"{key}, {ENCODED}")
    parts = texts.filter(F.length("text") > long_text).mapInPandas(
        split_long(path, part), f"{key}, seq int, kind string, run int, text string"
    )
    dealt = parts.repartition("row_id", "seq")
    encoded = dealt.mapInPandas(encode_parts(path), f"{key}, seq int, kind string, run int, ids binary")
    long = encoded.groupBy("row_id").applyInPandas(assemble(path), f"{key}, {ENCODED}")
    return short.unionByName(long)
