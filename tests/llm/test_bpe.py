import hashlib
import random

import pytest
from edges import ROWS
from tokenizers import Tokenizer

from snapmart.llm import bpe, tokens


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokens.default_path())


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def slow(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    return len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))


def result(df):
    return sorted(((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in df.collect()), key=str)


def test_the_fast_library_gives_the_same_ids(library):
    rng, loaded = random.Random(1), tokens.load(tokens.default_path())
    assert loaded.fast is not None
    pool = [chr(i) for i in (*range(0x250), *range(0x2010, 0x2028))]
    common = list(" \n\t'stabcdelé12,.!")
    for _ in range(4000):
        text = "".join(rng.choice(pool if rng.random() < 0.4 else common) for _ in range(rng.randrange(40)))
        ids = library.encode(text, add_special_tokens=False).ids
        assert loaded.encode(text).tolist() == ids
        assert loaded.decode(loaded.encode(text)) == library.decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize("letters", ["a", "ab", "=-_*", "theranin", "abcdefghijklmnop", "0123456789", "üéß"])
def test_joined_parts_are_the_encoding_of_the_whole(letters):
    rng, loaded = random.Random(2), tokens.load(tokens.default_path())
    for _ in range(60):
        text = "".join(rng.choice(letters) for _ in range(rng.randrange(40, 900)))
        run = "".join(part for part, _ in loaded.whole.pre_tokenizer.pre_tokenize_str(text))
        size = rng.randrange(3, 60)
        parts = [bpe.encode_run(loaded, run[i : i + size]) for i in range(0, len(run), size)]
        assert bpe.join_tree(loaded, parts, rng.choice([1, 2, 16])).tolist() == bpe.encode_run(loaded, run).tolist()


def test_long_texts_in_parts(spark, library):
    rng = random.Random(3)
    texts = ["".join(rng.choice(["word ", "  ", "\n\n", "don't", "'", "x" * 90, "é", "<|endoftext|>", "中文", "12,5 "]) for _ in range(rng.randrange(200))) for _ in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = result(bpe.encode_documents(docs, long_text=30, part=25))
    assert got == sorted(((i, *slow(library, t)) for i, t in enumerate(texts)), key=str)


def test_edges(edge, empty, library):
    want = sorted(((row[0], *slow(library, row[1])) for row in ROWS), key=str)
    assert result(bpe.encode_documents(edge)) == want
    assert result(bpe.encode_documents(edge, long_text=1000, part=500)) == want
    assert bpe.encode_documents(empty).count() == 0
