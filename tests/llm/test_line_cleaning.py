import re
from collections import Counter

from edges import ROWS
from hypothesis import given, settings
from hypothesis import strategies as st

from snapmart.llm.line_cleaning import clean, clean_lines, fails

WORDS = re.compile("[^\x20\x09-\x0d]+")


def slow(text):
    text = text or ""
    words = WORDS.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {p for i, window in enumerate(windows) if often[window] > 1 for p in (i, i + 1, i + 2)}
    lines, seen, copies = text.split("\n"), set(), 0
    for line in lines:
        if WORDS.search(line):
            copies += line in seen
            seen.add(line)
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": len(re.findall("[#*$%&|<>]", text)),
        "n_dup_lines": copies, "n_repeat_words": len(covered),
        "base_failed": len(words) < 50 or 100 * len(covered) > 50 * len(words),
    }


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from(list("ab c\n\t  é#|<.!\x1c\r")), max_size=200))
def test_measures_against_brute_force(text):
    assert slow(text).items() <= clean(text).items()


def test_rules_by_line():
    assert fails("A plain sentence ends here.") is None
    assert fails("No closing mark at the end") == "punctuation"
    assert fails("Buy now!! $$$ cheap!!") == "punctuation"
    assert fails("one | two | three | four.") == "navigation"
    assert fails("Home Contact About.") == "navigation"
    assert fails("All rights reserved.") == "boilerplate"


def test_documents_that_lose_too_much_go():
    prose = " ".join(f"word{i}" for i in range(60)) + "."
    assert clean(prose)["kept"] and clean(prose)["cleaned"] == prose
    menu = " | ".join(f"item{i}" for i in range(30))
    mixed = clean(f"{prose}\n{menu}\n\nlast one.")
    assert mixed["kept"] and mixed["cleaned"] == f"{prose}\n\nlast one." and mixed["lost_navigation"] > 0
    lost = clean(f"{prose}\n" + "\n".join(menu.replace("item", f"item{i}") for i in range(5)))
    assert not lost["base_failed"] and not lost["kept"]


def test_edges(edge, empty):
    found = sorted(clean_lines(edge).collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0, r.n_words))
    rows = sorted(((row[0], row[1]) for row in ROWS), key=lambda r: (r[0] is None, r[0] or 0, slow(r[1])["n_words"]))
    for got, (doc_id, text) in zip(found, rows, strict=True):
        assert got.doc_id == doc_id and {k: got[k] for k in slow(text)} == slow(text)
        assert not (got.base_failed and got.kept) and (got.cleaned is None) == (text is None)
    assert clean_lines(empty).count() == 0
