"""Loading public byte-level BPE tokenizers in tasks, and encoding many texts with them.

The file is a parameter. Texts of Latin letters only, whose classes every Unicode version agrees on, and without special
tokens are encoded by the faster of two libraries that implement the same merges; all others by the file's own library.
Both give the same ids, which the tests hold against each other.
"""

from __future__ import annotations

import json
import re
import sys
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import public_tokenizers
import tiktoken
import tokenizers

#: The name of the tokenizer file the queries use.
DEFAULT = "byte_bpe_50k.json"
OTHER_SCRIPTS = re.compile("[^\x00-ɏ‐-‧]")


def default_path() -> str:
    return public_tokenizers.path(DEFAULT)


@dataclass
class Loaded:
    """A tokenizer of one file; fast is None if its ids do not follow the order of its merges.

    The file's own library is loaded when a text needs it: each worker holds its vocabulary once, not twice.
    """

    path: str
    fast: tiktoken.Encoding | None
    special: re.Pattern | None

    @cached_property
    def whole(self) -> tokenizers.Tokenizer:
        return tokenizers.Tokenizer.from_file(self.path)

    def encode(self, text: str) -> np.ndarray:
        if self.fast is None or OTHER_SCRIPTS.search(text) or self.special and self.special.search(text):
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, np.uint32)
        return self.fast.encode_to_numpy(text, disallowed_special=())

    def decode(self, ids: np.ndarray) -> str:
        if self.fast is None or len(ids) and int(ids.max()) >= self.fast.n_vocab:
            return self.whole.decode(ids.tolist(), skip_special_tokens=False)
        return self.fast.decode_bytes(ids.tolist()).decode("utf-8", "replace")


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in the file, as the pre-tokenizer writes it.

    Printable Latin-1 bytes stand for themselves, the rest for the characters from U+0100 on in order.
    """
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [byte for byte in range(256) if byte not in printable]
    return {chr(byte): byte for byte in printable} | {chr(256 + i): byte for i, byte in enumerate(rest)}


def load(path: str) -> Loaded:
    """The tokenizer of a file, kept by the worker between tasks.

    Functions travel by value, so what outlives a task is kept in a module that the worker imports.
    """
    kept = vars(sys.modules["tokenizers"]).setdefault("_loaded_by_path", {})
    if path not in kept:
        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        vocab, added = told["model"]["vocab"], [token["content"] for token in told["added_tokens"]]
        merges = ["".join(m.split(" ") if isinstance(m, str) else m) for m in told["model"]["merges"]]
        ordered = all(vocab[merge] == 256 + i for i, merge in enumerate(merges)) and told["normalizer"] is None
        fast = None
        if ordered:
            alphabet = byte_alphabet()
            ranks = {bytes(alphabet[c] for c in token): i for token, i in vocab.items() if token not in added}
            fast = tiktoken.Encoding(path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        special = re.compile("|".join(map(re.escape, added))) if added else None
        kept[path] = Loaded(path, fast, special)
    return kept[path]
