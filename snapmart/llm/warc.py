"""WARC archives: writing captures, reading records back, and assembling transactions.

Writing is one pass: each page becomes a request, a response (or revisit) and a metadata record, joined to the response by
WARC-Concurrent-To, and Spark's text writer stores them with the line end that WARC puts between records, gzipped. Pages
of equal payload are found by their SHA-256; the smallest page id holds the response. Only digests are grouped, with
map-side combining; the join back to the pages is left to adaptive execution, which splits hot digests.

Reading takes whole archive files of bounded size through Spark's binary source, so any store will do, and cuts records
by their Content-Length: a payload may hold anything, also what looks like a record.

Assembly joins requests and metadata with their response through concurrent-to identifiers, given on either side or
through another record of the transaction, and emits one nested row per capture.

Defined results: a null html is an empty payload, and empty payloads are equal to each other. A null URL writes no target
URI; line breaks in a URL are percent-encoded. A null page id is larger than any other. Of rows that repeat page id and
payload the first as read holds the response. Records without a response keep a capture of their own each, with a null
response. An empty table gives an empty result. pages must be a stored table: it is read twice.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snapmart.llm.store import checkpoint_dir, fresh, materialize, numbered

CRLF = "\r\n"
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
#: Captures in one archive file at most.
CAPTURES_PER_FILE = 20_000
ANCHORS = ("response", "revisit", "resource")


def base32_sha1(data: Column) -> Column:
    """Bare upper-case base32 of the SHA-1: five hex digits give four letters."""
    letters = []
    for group in range(8):
        number = F.conv(F.substring(F.sha1(data), group * 5 + 1, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            letters.append(F.substring(F.lit(BASE32), F.shiftright(number, shift).bitwiseAND(F.lit(31)) + 1, F.lit(1)))
    return F.concat(*letters)


def record_id(row_id: Column, kind: str) -> Column:
    digits = F.md5(F.concat(F.lit(f"{kind} "), row_id.cast("string")))
    return F.concat(F.lit("<urn:uuid:"), F.regexp_replace(digits, "^(.{8})(.{4})(.{4})(.{4})", "$1-$2-$3-$4-"), F.lit(">"))


def record(kind: Column, id_: Column, block: Column, **fields: Column | str) -> Column:
    """The text of a record; fields that are null are left out."""
    named = {
        "WARC-Type": kind, "WARC-Record-ID": id_, "WARC-Date": F.lit(DATE),
        **{f"WARC-{name.replace('_', '-')}" if name != "Content_Type" else "Content-Type": value for name, value in fields.items()},
        "Content-Length": F.octet_length(block).cast("string"),
    }
    lines = [F.concat(F.lit(f"{name}: "), F.lit(value) if isinstance(value, str) else value) for name, value in named.items()]
    return F.concat(F.concat_ws(CRLF, F.lit("WARC/1.1"), *lines), F.lit(CRLF * 2), block)


def first_of_equals(pages: DataFrame) -> DataFrame:
    """row_id, first_row of the pages whose payload another page holds; pages: row_id, page_id, payload."""
    keys = materialize(pages.select("row_id", "page_id", F.sha2("payload", 256).alias("key")))
    best = F.min(F.struct(F.col("page_id").isNull().alias("none"), "page_id", "row_id")).alias("best")
    firsts = keys.groupBy("key").agg(best, F.count(F.lit(1)).alias("n")).filter("n > 1")
    joined = keys.join(firsts.select("key", F.col("best.row_id").alias("first_row")), "key")
    return joined.filter("row_id <> first_row").select("row_id", "first_row")


def write_archives(pages: DataFrame, path: str, smallest_revisited: int = 0) -> None:
    """Write page_id, url, html as gzipped WARC files below a new path. Payloads of fewer bytes are never revisits."""
    payload = F.coalesce("html", F.lit(""))
    row = fresh(pages, "row")
    rows = numbered(pages, row).select(F.col(row).alias("row_id"), "page_id", "url", payload.alias("payload"))
    revisits = first_of_equals(rows.filter(F.octet_length("payload") >= smallest_revisited))
    rows = rows.join(revisits, "row_id", "left")
    # Any control character would end a header line.
    url = F.regexp_replace(F.regexp_replace(F.col("url"), "\r", "%0D"), "\n", "%0A")
    id_, again = record_id(F.col("row_id"), "capture"), F.col("first_row").isNotNull()
    path_ = F.regexp_extract(url, r"^[^:]*://[^/?#]*([^#]*)", 1)
    host = F.regexp_extract(url, r"^[^:]*://([^/?#]*)", 1)
    got = F.concat(F.lit("GET "), F.coalesce(F.nullif(path_, F.lit("")), F.lit("/")), F.lit(" HTTP/1.1"), F.lit(CRLF + "Host: "), F.coalesce(host, F.lit("")), F.lit(CRLF * 2))
    size = F.octet_length("payload").cast("string")
    head = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), size, F.lit(CRLF * 2))
    told = F.coalesce(F.concat(F.lit("page-id: "), F.col("page_id").cast("string"), F.lit(CRLF)), F.lit(""))
    request = record(
        F.lit("request"), record_id(F.col("row_id"), "request"), got,
        Target_URI=url, Concurrent_To=id_, Content_Type="application/http; msgtype=request",
    )
    response = record(
        F.when(again, "revisit").otherwise("response"), id_, F.concat(head, F.when(again, "").otherwise(F.col("payload"))),
        Target_URI=url,
        Payload_Digest=F.concat(F.lit("sha1:"), base32_sha1(F.col("payload"))),
        Profile=F.when(again, PROFILE),
        Refers_To=F.when(again, record_id(F.col("first_row"), "capture")),
        Content_Type="application/http; msgtype=response",
    )
    metadata = record(
        F.lit("metadata"), record_id(F.col("row_id"), "metadata"), told,
        Target_URI=url, Concurrent_To=id_, Content_Type="application/warc-fields",
    )
    text = F.concat_ws(CRLF * 2, request, response, metadata)
    writer = rows.select(text.alias("value")).write.option("maxRecordsPerFile", CAPTURES_PER_FILE)
    writer.option("lineSep", CRLF * 2).option("compression", "gzip").text(path)


def records_of(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, list[str]], bytes]]:
    """Header fields by lower-case name, and block, of each record of an archive."""
    while True:
        line = stream.readline()
        if not line:
            return
        if not line.strip():
            continue
        fields: dict[str, list[str]] = {}
        while (line := stream.readline()).strip():
            name, _, value = line.decode("utf-8", "replace").partition(":")
            fields.setdefault(name.strip().lower(), []).append(value.strip())
        yield fields, stream.read(int(fields["content-length"][0]))


def payload_of(kind: str, content_type: str, block: bytes) -> bytes | None:
    """What follows the HTTP header of a message, or the whole block; a revisit has none."""
    if kind == "revisit":
        return None
    return block.partition(b"\r\n\r\n")[2] if content_type.startswith("application/http") else block


FIELDS = (
    "record_id string, type string, target_uri string, concurrent_to array<string>, refers_to string, "
    "payload_bytes long, payload_digest string, fields string, payload binary"
)


def parse(with_payload: bool):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                rows = []
                with gzip.GzipFile(fileobj=io.BytesIO(content)) as stream:
                    for fields, block in records_of(stream):
                        one = lambda name, fields=fields: fields.get(name, [None])[0]
                        kind, content_type = one("warc-type"), one("content-type") or ""
                        payload = payload_of(kind, content_type, block)
                        told = one("warc-payload-digest")
                        digest = told.removeprefix("sha1:") if told else None
                        if payload is not None and kind not in ("request", "metadata"):
                            digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                        rows.append((
                            one("warc-record-id"), kind, one("warc-target-uri"), fields.get("warc-concurrent-to", []),
                            one("warc-refers-to"), None if payload is None else len(payload), digest,
                            block.decode("utf-8", "replace") if content_type == "application/warc-fields" else None,
                            payload if with_payload else None,
                        ))
                        if len(rows) == 1000:
                            yield pd.DataFrame(rows, columns=NAMES)
                            rows = []
                yield pd.DataFrame(rows, columns=NAMES)

    return run


NAMES = [field.split()[0] for field in FIELDS.split(", ")]


def read_records(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """One row per record of the archives below a path; digests of responses are computed from what was read."""
    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(parse(with_payload), FIELDS)


def transactions(records: DataFrame) -> DataFrame:
    """capture_id, request, response, metadata: one nested row per capture.

    records: record_id, type, concurrent_to and any other columns, read more than once. Of several requests the smallest
    id is taken; metadata records come as an array by id, other records of a capture are left out.
    """
    anchors = records.filter(F.col("type").isin(*ANCHORS))
    others = records.filter(~F.col("type").isin(*ANCHORS))
    named = others.select("record_id", F.explode("concurrent_to").alias("to"))
    ids = anchors.select(F.col("record_id").alias("capture_id"))
    forward = named.join(ids, F.col("to") == F.col("capture_id")).select("record_id", "capture_id")
    backward = anchors.select(F.col("record_id").alias("capture_id"), F.explode("concurrent_to").alias("record_id"))
    direct = forward.unionByName(backward.select("record_id", "capture_id"))
    through = named.join(direct.withColumnRenamed("record_id", "to"), "to").select("record_id", "capture_id")
    known = direct.unionByName(through).groupBy("record_id").agg(F.min("capture_id").alias("capture_id"))
    row = F.struct("record_id", *[c for c in records.columns if c != "record_id"])
    own = others.join(known, "record_id", "left").select(
        F.coalesce("capture_id", "record_id").alias("capture_id"), F.col("type").alias("kind"), row.alias("record")
    )
    own = own.unionByName(anchors.select(F.col("record_id").alias("capture_id"), F.lit("response").alias("kind"), row.alias("record")))
    of = lambda kind: F.when(F.col("kind") == kind, F.col("record"))
    return own.groupBy("capture_id").agg(
        F.min_by(of("request"), F.when(F.col("kind") == "request", F.col("record.record_id"))).alias("request"),
        F.min_by(of("response"), F.when(F.col("kind") == "response", F.col("record.record_id"))).alias("response"),
        F.array_sort(F.collect_list(of("metadata"))).alias("metadata"),
    )


def revisited(captures: DataFrame) -> DataFrame:
    """Captures with the payload's size and digest and the page they refer to, revisits resolved through the record
    they refer to. captures: page_id, response."""
    own = captures.select(
        "page_id", F.col("response.type").alias("record_type"), F.col("response.refers_to").alias("to"),
        F.col("response.record_id").alias("id"), F.col("response.payload_bytes").alias("bytes"),
        F.col("response.payload_digest").alias("digest"),
    )
    held = own.filter("record_type = 'response'").select(
        F.col("id").alias("to"), F.col("page_id").alias("refers_to"), F.col("bytes").alias("held"), F.col("digest").alias("held_digest")
    )
    return own.join(held, "to", "left").select(
        "page_id", F.coalesce("bytes", "held").alias("payload_bytes"), F.coalesce("held_digest", "digest").alias("payload_digest"),
        "record_type", "refers_to",
    )


def archived_pages(pages: DataFrame, smallest_revisited: int = 0) -> DataFrame:
    """Write the pages to archives in the shared folder, read them back and assemble them: one row per page."""
    spark = pages.sparkSession
    path = f"{checkpoint_dir(spark)}/warc-{uuid.uuid4().hex}"
    write_archives(pages, path, smallest_revisited)
    records = materialize(read_records(spark, path, with_payload=False).drop("payload"))
    told = F.regexp_extract(F.get("metadata", F.lit(0))["fields"], r"page-id: (\S+)", 1)
    kind = pages.schema["page_id"].dataType
    captures = materialize(transactions(records).withColumn("page_id", F.nullif(told, F.lit("")).cast(kind)))
    return revisited(captures)
