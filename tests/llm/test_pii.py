import hashlib
import itertools
import random
import re
import time

import pytest
from edges import ROWS, edge_docs, stored
from pyspark.sql import functions as F

from snapmart.llm import pii

DOCS = "/root/testdata/sf0.01/documents.parquet"


def luhn(digits):
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def slow_base(text):
    """The spans of the contract's patterns as written there."""
    text, out = text or "", []
    out += [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(part) <= 255 for part in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[ -]", "", m.group())
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out.append(("phone", *m.span()))
    return out


TEXTS = [
    "mail a.b@c.de and x@y, a@b.c+d@e.f, é@ü.de a@b..c @x.y a@@b.c",
    "1.2.3.4 256.1.1.1 1.2.3.4.5.6.7.8 01.002.0255.0 1.2.3 10.0.0.256 00000000000000000001.1.1.1",
    "4111 1111 1111 1111 4111-1111-1111-1112 4111111111111111 4111  1111 12345678901234567890",
    "+1 (927) 555-7911, +49.30.1234567 +1 ( +12345678 +123456789 +1234567890123456 ++1 927 555 7911.",
    "\U0001f600 +1 (927) 555-7911 \U0001f600 a@b.cd 1.1.1.1",
    "", None, "a" * 5_000 + "@", "1" * 3_000, "a@b" + ".c" * 20_000, "1 " * 5_000, "+" * 1000 + "1 2",
]


def spans(found):
    return [(s["kind"], s["start"], s["end"]) for s in found]


def test_base_spans_against_the_patterns_as_given(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    found = {r.doc_id: spans(r.base) for r in pii.personal_data(df).collect()}
    assert {i: slow_base(text) for i, text in enumerate(TEXTS)} == found


def test_base_spans_of_documents(spark):
    docs = spark.read.parquet(DOCS)
    text = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    got = pii.personal_data(docs).collect()
    assert len(got) == len(text) and sum(len(r.base) for r in got) > 50
    for r in got:
        assert spans(r.base) == slow_base(text[r.doc_id])
        assert set(spans(r.base)) <= set(spans(r.spans))


def test_contexts_discover_unseen_identifiers(spark):
    rows = [(i, f"please call hotline +1 (927) 555-{1000 + i} during office hours") for i in range(12)]
    rows += [(50, "please call hotline +1-9-5-99 during office hours")]  # too few digits to be a phone
    rows += [(60, "the order number A-1234567 arrived"), (61, "hotline B7654321 elsewhere")]
    rows += [(20 + i, f"please call hotline +1-927-555-{2000 + i} during office hours") for i in range(8)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: (spans(r.base), spans(r.spans)) for r in pii.personal_data(df).collect()}
    assert found[50] == ([], [("phone", 20, 29)])
    assert found[60] == found[61] == ([], [])
    assert all(base == all_ for i, (base, all_) in found.items() if i != 50)


def test_edges_and_redaction(spark, edge, empty, tmp_path):
    base = {}
    for r in pii.personal_data(edge).collect():
        base.setdefault(r.doc_id, []).append(spans(r.base))
    assert sum(map(len, base.values())) == len(ROWS) and all(s == [] for found in base.values() for s in found)
    assert pii.personal_data(empty).count() == 0 and pii.redact_documents(empty).columns == empty.columns
    rows = [*ROWS, (70, "x 1.2.3.4, +1 (927) 555-7911 and é a@b.cd!", "en", None, 1, None, None)]
    docs = stored(spark, edge_docs(spark, rows), tmp_path)
    clean = pii.redact_documents(docs)
    assert clean.columns == docs.columns and clean.count() == len(rows)
    assert clean.filter("doc_id = 70").first().text == "x <ip>, <phone> and é <email>!"
    assert clean.filter("doc_id = 7").first().text == ROWS[9][1]
    assert clean.filter("text is null").count() == 2


def test_written_spans_hash(spark):
    df = spark.createDataFrame([(1, "a@b.cd 1.2.3.4"), (2, None)], "doc_id long, text string")
    got = {r.doc_id: (r.w, r.h) for r in pii.personal_data(df).select("doc_id", pii.written(F.col("base")).alias("w"), F.sha2(pii.written(F.col("base")), 256).alias("h")).collect()}
    assert got[1] == ("email:0:6,ip:7:14", hashlib.sha256(b"email:0:6,ip:7:14").hexdigest())
    assert got[2] == ("", hashlib.sha256(b"").hexdigest())


@pytest.mark.parametrize("overlap", [[("card", 0, 5), ("phone", 3, 8)], [("ip", 2, 4)]])
def test_overlapping_spans_are_redacted_once(spark, overlap):
    df = spark.createDataFrame([("0123456789", overlap)], "text string, s array<struct<kind:string,start:int,end:int>>")
    want = {"card": "<card>89", "ip": "01<ip>456789"}[overlap[0][0]]
    assert df.select(pii.redacted(F.col("text"), F.col("s"))).first()[0] == want


def test_contexts_discover_other_writings(spark):
    call, write = "please call hotline {} during office hours", "kindly write to {} about any matter"
    rows = [(i, call.format(f"+1 (017) 555-{1000 + i}")) for i in range(20)]
    rows += [(100 + i, write.format(f"clerk{i}@host.example")) for i in range(20)]
    other = {200: (call, "555-123-4567"), 201: (call, "(555) 123-4567"), 202: (write, "name[at]host.tld"), 203: (write, "name (at) host (dot) tld")}
    rows += [(i, text.format(value)) for i, (text, value) in other.items()]
    rows += [(300, "10.0.0.1 555-987-6543 elsewhere"), (301, call.format("Z1234567"))]
    found = {r.doc_id: (spans(r.base), spans(r.spans)) for r in pii.personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, (text, value) in other.items():
        start = text.index("{")
        assert found[i] == ([], [("phone" if text == call else "email", start, start + len(value))])
    assert all(base == all_ for i, (base, all_) in found.items() if i not in other)


def test_discovered_values_count_wherever_they_stand(spark, tmp_path):
    seeds = [f"please call hotline +1 202 555 {i:04d} today" for i in range(1000, 1040)]  # nine digits and more
    texts = [*seeds, "please call hotline 555-123-4567 today", "555-123-4567 is closed", "12 555-123-4567"]
    docs = stored(spark, spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), tmp_path)
    found = {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans] for r in pii.personal_data(docs).filter("doc_id >= 40").collect()}
    assert found == {40: [("phone", 20, 32)], 41: [("phone", 0, 12)], 42: [("phone", 3, 15)]}


def test_many_matches_in_one_text(spark, tmp_path):
    n = 20_000
    text = " ".join(f"10.{i // 250 % 250}.{i % 250}.7 A{i:06d}" for i in range(n))
    docs = stored(spark, spark.createDataFrame([(1, text)], "doc_id long, text string"), tmp_path)
    begun = time.time()
    found = pii.personal_data(docs).first()
    assert spans(found.base) == slow_base(text) and len(found.base) == n
    assert pii.redact_documents(docs).first().text == re.sub(r"10(\.\d+){3}", "<ip>", text)
    assert time.time() - begun < 90


@pytest.mark.parametrize("numbers", [[], [3], list(range(1, 30)), [5, 2, 9, 1, 9, 0]])
def test_running_totals(spark, numbers):
    df = spark.createDataFrame([(numbers,)], "n array<int>")
    got = df.select(pii.running(F.col("n"), lambda a, b: a + b), pii.running(F.col("n"), F.greatest)).first()
    assert list(got) == [list(itertools.accumulate(numbers)), list(itertools.accumulate(numbers, max))]


def test_tokens_that_touch_a_span_are_not_unseen_instances(spark):
    rng = random.Random(5)
    texts = [" ".join(rng.choice(["1.2.3.4", "x1.2.3.4", "555-1234", "a9@b.cd", "+1", "202 555 0123", "A12345", "+12 (345) 678 90", "(12) 34 567"]) for _ in range(40)) for _ in range(60)]
    scanned = pii.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), "doc_id", "text").cache()
    want = {}
    for r in scanned.collect():
        base = [s for kind in pii.KINDS for s in r[kind]]
        free = [t for t in r.tokens if t.end > t.start and not any(b.start < t.end and t.start < b.end for b in base)]
        want[r.row_id] = {(s.start, s.end) for s in free}
    got = {i: set() for i in want}
    for r in pii.mentions(scanned).filter("kind is null").collect():
        got[r.row_id].add((r.start, r.end))
    assert got == want and sum(map(len, want.values())) > 100
