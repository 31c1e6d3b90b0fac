"""The whole pipeline against the same steps in plain Python."""

import random

from test_exact_dedup import FOLD
from test_packing import check_places, slow_best_fit, slow_pieces
from test_pii import slow_base
from test_simhash import slow_components
from tokenizers import Tokenizer

import corpus_pipeline
from edges import SCHEMA, edge_docs, stored
from snapmart.llm import language_crf as crf
from snapmart.llm import tokens


def redact(text):
    out, at = "", 0
    for kind, a, b in sorted(slow_base(text), key=lambda s: (s[1], s[2])):
        out, at = (out + text[at:a] + f"<{kind}>" if a >= at else out), max(at, b)
    return out + text[at:]


def test_run_against_brute_force(spark, tmp_path):
    rng = random.Random(1)
    source = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(90).collect()
    rows = [tuple(row) for row in source]
    rows += [(1000 + i, row[1].upper() if i % 2 else row[1], *row[2:]) for i, row in enumerate(rng.sample(rows, 10))]
    rows += [(2000, "123 456", "en", "x", 7), (2001, None, "en", "x", 0), (2002, "", None, None, None)]
    rows += [(3000, "The thing was sent with erth and shand to a.b@c.example and 10.1.2.3 then over.", "en", "x", 80)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        str(tmp_path / "documents.parquet")
    )
    packed = corpus_pipeline.run(spark, str(tmp_path)).collect()

    model = crf.learn(spark.read.parquet(str(tmp_path / "documents.parquet")))
    found = crf.label_texts(model, [row[1] for row in rows])
    docs = [(row[0], row[1]) for row, (lang, score, _) in zip(rows, found) if lang != "und" and score >= 0.5]
    largest = {}
    for doc_id, text in docs:
        largest[text.translate(FOLD)] = max(doc_id, largest.get(text.translate(FOLD), doc_id))
    docs = [(i, t) for i, t in docs if largest[t.translate(FOLD)] == i]
    docs = [(i, t) for i, t in docs if i in {c for _, _, c in slow_components(docs)}]
    docs = [(i, redact(t)) for i, t in docs]
    want = slow_pieces(Tokenizer.from_file(tokens.default_path()), docs, 1024)
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed), key=str) == want
    assert check_places([(r.sequence_id, r.offset, r.length) for r in packed], 1024) == slow_best_fit([w[3] for w in want], 1024)
    assert 3000 in {w[0] for w in want} and not {2000, 2001, 2002} & {w[0] for w in want}


def test_stages_take_edge_rows_and_empty_tables(spark, tmp_path):
    for name, rows in (("edge", None), ("empty", [])):
        docs = edge_docs(spark) if rows is None else spark.createDataFrame(rows, SCHEMA)
        (tmp_path / name).mkdir()
        docs = stored(spark, docs, tmp_path / name)
        for at, (_, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, docs, str(tmp_path))
            if at < len(corpus_pipeline.STAGES) - 1:
                assert out.columns == docs.columns
                out.write.parquet(str(tmp_path / f"{name}-{at}"))
                docs = spark.read.parquet(str(tmp_path / f"{name}-{at}"))
        assert (out.count() > 0) == (rows is None)


def test_stage_names_and_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "simhash_near_dedup", "pii", "best_fit_packing"]
