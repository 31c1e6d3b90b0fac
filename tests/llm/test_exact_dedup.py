import hashlib
from collections import defaultdict

from edges import ROWS
from pyspark.sql import functions as F

from snapmart.llm.exact_dedup import drop_exact_duplicates, exact_duplicates
from snapmart.llm.store import LOWER, UPPER

FOLD = str.maketrans(UPPER, LOWER)


def brute(rows):
    """keep_id, group_size and sha of each row, by whole texts."""
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[(text or "").translate(FOLD)].append(doc_id)
    out = []
    for doc_id, text in rows:
        folded = (text or "").translate(FOLD)
        ids = [i for i in groups[folded] if i is not None]
        out.append((doc_id, max(ids, default=None), len(groups[folded]), hashlib.sha256(folded.encode()).hexdigest()))
    return sorted(out, key=str)


def result(df):
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in df.collect()), key=str)


def test_edges(edge):
    want = brute([(row[0], row[1]) for row in ROWS])
    assert result(exact_duplicates(edge)) == want
    kept = exact_duplicates(edge).filter("kept")
    assert kept.count() == kept.select("text_sha256").distinct().count() == len({w[3] for w in want})


def test_empty(empty):
    assert exact_duplicates(empty).count() == 0
    assert drop_exact_duplicates(empty).columns == empty.columns


def test_hot_groups_and_digests_that_clash(spark):
    texts = ["Same"] * 40 + ["same"] * 5 + [f"text {i % 30}" for i in range(60)] + ["É", "é"] * 3
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6).cache()
    want = brute(rows)
    # Every digest hot, one digest for many texts, and both.
    assert result(exact_duplicates(docs, hot_rows=0, salts=3)) == want
    weak = lambda sha: F.substring(sha, 1, 1)
    assert result(exact_duplicates(docs, digest_of=weak)) == want
    clashing = exact_duplicates(docs, hot_rows=4, salts=3, digest_of=weak)
    assert result(clashing) == want
    assert clashing.filter("kept").count() == len({w[3] for w in want})


def test_stage_keeps_columns_and_one_row_of_each_text(edge):
    kept = drop_exact_duplicates(edge)
    assert kept.columns == edge.columns
    assert kept.count() == len({(row[1] or "").translate(FOLD) for row in ROWS})
    assert {row.doc_id for row in kept.filter("text like 'T%'").collect()} == {2}


def test_plan_has_no_python(edge):
    plan = exact_duplicates(edge)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Cartesian", "NestedLoop"))
