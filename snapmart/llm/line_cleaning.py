"""Line-first cleaning: rules judge every line, failing lines go, and documents that lose too much text go too.

A line fails
- the punctuation rule if it does not end in a closing mark, or bears more than one symbol or doubled mark for three words;
- the navigation rule if it has two separators or more, or is a short list of menu words;
- the boilerplate rule if it holds a phrase that sites repeat on every page.

One Arrow batch of whole texts at a time, without a shuffle. Lines are split at \\n; lines without a word are neither
judged nor counted. Words are runs of anything but ASCII white space.

Defined results: a null text has no words, and so base_failed; its cleaned text stays null. Repeated rows get equal
results; ids may be null or repeated. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
SYMBOLS = b"#*$%&|<>"
# Closing marks, separators of navigation, menu words and boilerplate phrases.
CLOSING = tuple(".!?…:;\"'”’»)]。！？")
SEPARATOR = re.compile(r"[|»›•·]| > ")
MARKS = re.compile(r"[#*$%&|<>]|!!+|\?\?+")
MENU = re.compile(
    r"[.,:]*(?:home|menu|login|logout|search|contact|about|help|next|previous|share|sitemap)[.,:]*", re.IGNORECASE | re.ASCII
)
BOILERPLATE = re.compile(
    r"all rights reserved|privacy policy|terms of (?:use|service)|cookie|javascript|lorem ipsum|click here|read more"
    r"|sign up|subscribe|powered by|licensed under|license",
    re.IGNORECASE | re.ASCII,
)
WORD = re.compile("[^\x20\x09-\x0D]+")
MIN_WORDS = 50
#: Share of the word characters that a document may lose.
MAX_LOST = 0.5


def fails(line: str) -> str | None:
    """The rule a line with words breaks, if any."""
    words = WORD.findall(line)
    if len(SEPARATOR.findall(line)) >= 2:
        return "navigation"
    if len(words) <= 6 and 2 * sum(MENU.fullmatch(word) is not None for word in words) > len(words):
        return "navigation"
    if BOILERPLATE.search(line):
        return "boilerplate"
    if not words[-1].endswith(CLOSING) or 3 * len(MARKS.findall(line)) > len(words):
        return "punctuation"
    return None


def word_chars(text: str) -> int:
    data = text.encode("utf-8")
    return len(text) - len(data) + len(data.translate(None, SPACES))


def repeated_words(words: list[bytes]) -> int:
    """Words in three-word windows found twice or more."""
    windows = Counter(zip(words, words[1:], words[2:]))
    if len(windows) >= len(words) - 2:
        return 0
    count, covered = 0, 0
    for at, window in enumerate(zip(words, words[1:], words[2:])):
        if windows[window] > 1:
            count += at + 3 - max(covered, at)
            covered = at + 3
    return count


def clean(text: str | None) -> dict:
    """Measures, cleaned text and verdict of one document."""
    whole = text or ""
    data = whole.encode("utf-8")
    words = data.split()
    lines = whole.split("\n")
    worded = [line for line in lines if line.encode("utf-8").split()] if len(lines) > 1 else [whole] * bool(words)
    verdicts = {line: fails(line) for line in set(worded)}
    lost = Counter()
    for line in worded:
        if verdicts[line]:
            lost[verdicts[line]] += word_chars(line)
    chars, repeats = word_chars(whole), repeated_words(words)
    base_failed = len(words) < MIN_WORDS or 100 * repeats > 50 * len(words)
    return {
        "n_words": len(words),
        "word_chars": chars,
        "n_symbols": len(data) - len(data.translate(None, SYMBOLS)),
        "n_dup_lines": len(worded) - len(verdicts),
        "n_repeat_words": repeats,
        "base_failed": base_failed,
        "kept": not base_failed and sum(lost.values()) <= MAX_LOST * chars,
        "lost_punctuation": lost["punctuation"],
        "lost_navigation": lost["navigation"],
        "lost_boilerplate": lost["boilerplate"],
        "cleaned": text if text is None else "\n".join(line for line in lines if not verdicts.get(line)),
    }


SCHEMA = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
    "kept boolean, lost_punctuation long, lost_navigation long, lost_boilerplate long, cleaned string"
)


def clean_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, measures, verdict, characters lost by rule, and the cleaned text."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = pd.DataFrame([clean(text) for text in batch["text"]], columns=[c.split()[0] for c in SCHEMA.split(", ")])
            out.insert(0, "doc_id", batch["doc_id"].to_numpy())
            yield out

    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = slim.schema["doc_id"].dataType.simpleString()
    return slim.mapInPandas(run, f"doc_id {kind}, {SCHEMA}")
