"""Content-addressed WARC archive.

Payload bytes are stored once per strong digest (SHA-256, with SHA-1 and the
length in the key as well, so copies are merged only if all three agree).
Record headers are kept apart, byte for byte, with the digest of the payload
they belong to. Joining both by digest gives back the original records, which
``export_warc`` writes as gzip WARC 1.1 files and ``read_warc`` parses again
by Content-Length, so a payload may hold anything, record separators included.

Of records with equal payloads the one with the largest page id is the
response; the others are revisits of it (identical-payload-digest profile)
with an empty block. Payloads shorter than ``min_revisit_bytes`` are always
responses.

A payload that a third of all records share is combined before the shuffle
(one row per task). Header rows meet their digest's keeper in an equi-join
that AQE can split.

Edge cases: null html is an empty payload; a null url an empty target; line
breaks and other control characters in a url are percent-encoded, so that
headers stay intact; a null page id is kept, written as ``null``, never a
keeper while an equal payload has an id; repeated rows of a keeper are all
responses, their payload stored once; an empty table gives empty archives.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.llm.frames import stored
from blotter.session import shared_dir

BREAK = "\r\n"
WARC_DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1: 5 hex digits are 20 bits are 4 digits
    of base 32, whose alphabet is then exchanged."""
    hexes = F.sha1(payload)
    groups = [F.lpad(F.conv(F.substring(hexes, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*groups), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _record_id(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("null")), F.lit(">"))


def _header(url: Column, page_id: Column, kind: Column, refers_to: Column, sha1: Column, length: Column) -> Column:
    safe = F.translate(F.coalesce(url, F.lit("")), "\r\n", "\x1a\x1b")
    safe = F.regexp_replace(F.regexp_replace(safe, "\x1a", "%0D"), "\x1b", "%0A")
    safe = F.regexp_replace(safe, r"[\x00-\x1F\x7F]", "%20")
    revisit = F.when(
        kind == "revisit", F.concat(F.lit("WARC-Refers-To: "), _record_id(refers_to), F.lit(f"{BREAK}WARC-Profile: {PROFILE}{BREAK}"))
    ).otherwise("")
    return F.concat(
        F.lit(f"WARC/1.1{BREAK}WARC-Type: "), kind,
        F.lit(f"{BREAK}WARC-Record-ID: "), _record_id(page_id),
        F.lit(f"{BREAK}WARC-Date: {WARC_DATE}{BREAK}WARC-Target-URI: "), safe,
        F.lit(f"{BREAK}WARC-Payload-Digest: sha1:"), sha1,
        F.lit(BREAK), revisit,
        F.lit("Content-Type: text/html; charset=utf-8" + BREAK + "Content-Length: "), F.when(kind == "revisit", F.lit(0)).otherwise(length).cast("string"),
        F.lit(BREAK + BREAK),
    )


def write_archive(pages: DataFrame, min_revisit_bytes: int = 0) -> tuple[DataFrame, DataFrame]:
    """Write both tables of the archive to the shared folder and return them:
    payloads (digest, n_bytes, sha1, payload) and headers (page_id, digest,
    record_type, refers_to, header)."""
    payload = F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8")
    records = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    address = [F.sha2("payload", 256).alias("digest"), F.length("payload").cast("long").alias("n_bytes"), base32_sha1(F.col("payload")).alias("sha1")]
    keyed = records.select("page_id", "url", "payload", *address)
    store = stored(keyed.groupBy("digest", "n_bytes", "sha1").agg(F.max("page_id").alias("keeper"), F.first("payload").alias("payload")), "warc-payloads")
    narrow = keyed.select("page_id", "url", *(F.col(c).alias(f"own_{c}") for c in ("digest", "n_bytes", "sha1")))
    same = (F.col("own_digest") == F.col("digest")) & (F.col("own_n_bytes") == F.col("n_bytes")) & (F.col("own_sha1") == F.col("sha1"))
    joined = narrow.join(store.drop("payload"), same)
    revisit = (F.col("n_bytes") >= min_revisit_bytes) & F.col("keeper").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("keeper"))
    typed = joined.withColumn("record_type", F.when(revisit, "revisit").otherwise("response")).withColumn("refers_to", F.when(revisit, F.col("keeper")))
    header = _header(F.col("url"), F.col("page_id"), F.col("record_type"), F.col("refers_to"), F.col("sha1"), F.col("n_bytes"))
    headers = stored(typed.select("page_id", "digest", "record_type", "refers_to", header.alias("header")), "warc-headers")
    return store.drop("keeper"), headers


def original_records(store: DataFrame, headers: DataFrame) -> DataFrame:
    """(record): header and block of every record, rebuilt by joining headers
    and payloads; stored bytes must still hash to their address."""
    checked = F.when(F.sha2("payload", 256) == F.col("digest"), F.col("payload")).otherwise(
        F.raise_error(F.concat(F.lit("payload does not match its digest "), F.col("digest"))).cast("binary")
    )
    whole = headers.where("record_type = 'response'").join(store.select("digest", checked.alias("block")), "digest")
    full = whole.select(F.concat(F.col("header").cast("binary"), F.col("block")).cast("string").alias("record"))
    return full.unionAll(headers.where("record_type = 'revisit'").select(F.col("header").alias("record")))


def export_warc(store: DataFrame, headers: DataFrame) -> str:
    """Write the records as WARC files to a fresh shared folder. The text
    writer's line end is the two line breaks that close a WARC record."""
    path = shared_dir(store.sparkSession, "warc-files")
    original_records(store, headers).write.option("lineSep", BREAK + BREAK).option("compression", "gzip").text(path)
    return path


def parse_records(content: bytes, step: int = 1 << 20) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, block) of each record of one gzip WARC file; holds one
    record and a step of input at a time."""
    inflate, at, done = zlib.decompressobj(31), 0, False
    buffer, begin = b"", 0  # records before ``begin`` are done with

    def more() -> None:
        nonlocal buffer, begin, at, done
        piece = content[at : at + step]
        at += step
        buffer = buffer[begin:] + (inflate.decompress(piece) if piece else inflate.flush())
        begin, done = 0, not piece

    while True:
        while (blank := buffer.find(b"\r\n\r\n", begin)) < 0 and not done:
            more()
        if blank < 0:
            return
        fields = dict(re.findall(r"^([\w-]+): ?(.*?)\r?$", buffer[begin:blank].decode("utf-8"), re.M))
        head, size = blank + 4 - begin, int(fields["Content-Length"])
        while len(buffer) < begin + head + size + 4 and not done:
            more()
        first = begin + head
        yield fields, buffer[first : first + size]
        begin = first + size + 4


_READ = "page_id long, record_type string, refers_to long, header_digest string, n_bytes long, sha1 string"


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Records of the WARC files of a folder: ids, type, the digest that the
    header states, and length and SHA-1 of the block as read."""

    def number(value: str | None) -> int | None:
        found = re.fullmatch(r"<urn:page:(-?\d+)>", value or "")
        return int(found[1]) if found else None

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        schema = pa.schema([("page_id", pa.int64()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("header_digest", pa.string()), ("n_bytes", pa.int64()), ("sha1", pa.string())])
        for batch in batches:
            for content in batch.column(0):
                rows = [
                    (
                        number(f["WARC-Record-ID"]),
                        f["WARC-Type"],
                        number(f.get("WARC-Refers-To")),
                        f["WARC-Payload-Digest"].removeprefix("sha1:"),
                        len(block),
                        base64.b32encode(hashlib.sha1(block).digest()).decode(),
                    )
                    for f, block in parse_records(content.as_py())
                ]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    return files.mapInArrow(run, _READ)


def archive_pages(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Archive ``pages``, read the WARC files back and return (page_id,
    payload_bytes, payload_digest, record_type, refers_to) per page. A
    revisit gets length and digest of the response it refers to, which must
    be the digest that its own header states."""
    records = stored(read_warc(spark, export_warc(*write_archive(pages))), "warc-read")
    response = records.where("record_type = 'response'")
    kept = response.where("page_id is not null").groupBy(F.col("page_id").alias("r_id"), F.col("sha1").alias("r_sha1")).agg(F.max("n_bytes").alias("r_bytes"))
    revisit = records.where("record_type = 'revisit'").join(kept, (F.col("refers_to") == F.col("r_id")) & (F.col("header_digest") == F.col("r_sha1")), "left")
    return response.select(
        "page_id", F.col("n_bytes").alias("payload_bytes"), F.col("sha1").alias("payload_digest"), "record_type", "refers_to"
    ).unionAll(revisit.select("page_id", F.col("r_bytes").alias("payload_bytes"), F.col("r_sha1").alias("payload_digest"), "record_type", "refers_to"))
