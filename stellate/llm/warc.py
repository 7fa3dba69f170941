"""Content-addressed web archive.

Payload bytes are stored once, compressed, under their SHA-256, which is held
against the SHA-1 on writing; exact record headers are stored apart, each with
its payload's key.  Joining the two gives the original records back, and
reading goes through them: header and block are parsed from the rebuilt bytes
and both digests recomputed from the block.  Equal payloads are reduced inside
each map task before they are shuffled; headers meet their payload by an
equi-join that adaptive execution splits where one payload has very many
records.

Null html counts as an empty payload and a null url leaves its header line
out; control characters and line separators in a url are percent-encoded.  Of
equal payloads of at least ``REVISIT_BYTES`` the largest page_id (null only if
all are) is the response; rows that share that page_id are all responses.  An
empty table gives an empty archive.  Other columns are not looked at.
"""

from __future__ import annotations

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stellate.llm.common import empty_text, materialize

REVISIT_BYTES = 1000
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CRLF = "\r\n"
#: What would end or split a header line for some reader.
BREAKING = "[\\p{Cc}\u2028\u2029]"
BROKEN = "a stored payload does not match its record"


def _line(name: str, *parts) -> Column:
    """One header line; null if a part is."""
    return F.concat(F.lit(f"{name}: "), *[p if isinstance(p, Column) else F.lit(p) for p in parts], F.lit(CRLF))


def _header(date: str) -> Column:
    revisit = F.col("type") == "revisit"
    coded = F.array_join(F.transform(F.split("url", ""), lambda c: F.when(c.rlike(BREAKING), F.regexp_replace(
        F.hex(c.cast("binary")), "(..)", "%$1")).otherwise(c)), "")
    url = F.when(F.col("url").rlike(BREAKING), coded).otherwise(F.col("url"))
    number = F.coalesce(F.col("page_id").cast("string"), F.lit("none"))
    lines = [F.lit("WARC/1.1" + CRLF), _line("WARC-Type", F.col("type")), _line("WARC-Record-ID", "<urn:page:", number, ">"),
             F.coalesce(_line("WARC-Target-URI", url), F.lit("")), _line("WARC-Date", date),
             _line("WARC-Payload-Digest", "sha1:", F.col("sha1")),
             F.when(revisit, F.concat(_line("WARC-Profile", PROFILE),
                                      _line("WARC-Refers-To", "<urn:page:", F.col("keeper").cast("string"), ">"))).otherwise(""),
             _line("X-Payload-Length", F.col("bytes").cast("string")),
             F.when(revisit, F.lit("")).otherwise(_line("Content-Type", "text/html")),
             _line("Content-Length", F.when(revisit, F.lit("0")).otherwise(F.col("bytes").cast("string")))]
    return F.concat(*lines).cast("binary")


def _squeezed(df: DataFrame, schema: str) -> DataFrame:
    """``df`` with ``payload`` compressed."""
    def run(batches):
        squeeze = zstandard.ZstdCompressor(level=1).compress
        for b in batches:
            at = b.schema.get_field_index("payload")
            yield b.set_column(at, "payload", pa.array([squeeze(x.as_buffer()) for x in b.column(at)], pa.binary()))

    return df.mapInArrow(run, schema)


def write(pages: DataFrame, revisit_bytes: int = REVISIT_BYTES, date: str = DATE) -> tuple[DataFrame, DataFrame]:
    """(headers: header, payload_key; payloads: payload_key, payload), both written; payloads are zstd frames."""
    payload = empty_text(pages["html"]).cast("binary")
    records = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                           F.sha2(payload, 256).alias("payload_key"), F.sha1(payload).alias("sha1"),
                           F.octet_length(payload).cast("long").alias("bytes"), payload.alias("payload"))
    squeezed = _squeezed(records.select("payload_key", "page_id", "sha1", "payload"),
                         "payload_key string, page_id long, sha1 string, payload binary")
    stored = squeezed.groupBy("payload_key").agg(
        F.first("payload").alias("payload"), F.max("page_id").alias("keeper"),
        F.min("sha1").alias("sha1"), F.max("sha1").alias("other"))
    agreed = F.when(F.col("sha1") == F.col("other"), F.col("payload")).otherwise(
        F.raise_error(F.lit("payloads of one SHA-256 differ")).cast("binary"))
    payloads = materialize(stored.select("payload_key", "keeper", agreed.alias("payload")), "payloads")
    keeper = F.col("page_id").eqNullSafe(F.col("keeper"))
    headers = (records.drop("payload").join(payloads.select("payload_key", "keeper"), "payload_key")
               .withColumn("type", F.when((F.col("bytes") < revisit_bytes) | keeper, "response").otherwise("revisit"))
               .select(_header(date).alias("header"), "payload_key"))
    return materialize(headers, "headers"), payloads.select("payload_key", "payload")


def field(name: str) -> Column:
    """A header field's value; null where the header has no such line.  Lines end with CR LF only."""
    found = F.regexp_extract(F.col("header").cast("string"), f"(?:^|\r\n){name}: ([^\r\n]*)\r\n", 1)
    return F.when(found != "", found)


def records(headers: DataFrame, payloads: DataFrame) -> DataFrame:
    """headers' columns and ``record``: the exact bytes of each record (a revisit has no payload)."""
    revisit = field("WARC-Type") == "revisit"
    body = headers.filter(~revisit).join(payloads, "payload_key").select(*headers.columns, "payload")
    bare = headers.filter(revisit).withColumn("payload", F.lit(None).cast("binary"))

    def run(batches):
        expand = zstandard.ZstdDecompressor().decompress
        end = CRLF.encode()
        for b in batches:
            made = []
            for header, payload in zip(b.column("header").to_pylist(), b.column("payload").to_pylist()):
                try:
                    made.append(b"".join([header, end, expand(payload) if payload else b"", end, end]))
                except zstandard.ZstdError as e:
                    raise ValueError(BROKEN) from e
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(made, pa.binary())], [*b.schema.names[:-1], "record"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in headers.schema)
    return body.unionByName(bare).mapInArrow(run, f"{schema}, record binary")


def parse(rebuilt: DataFrame) -> DataFrame:
    """Of whole records with their payload_key: page_id, url, record_type, refers_to, what the header says, and the block's digests."""
    head = F.substring_index(F.col("record").cast("string"), CRLF * 2, 1)
    number = r"<urn:page:(-?\d+)>"
    cut = rebuilt.select("payload_key", "record", head.alias("head")).withColumn("header", F.concat("head", F.lit(CRLF)))
    block = F.substring(F.col("record"), F.octet_length("head") + 5, F.octet_length("record") - F.octet_length("head") - 8)

    def page(name: str) -> Column:
        return F.regexp_extract(field(name), number, 1).try_cast("long")

    return cut.withColumn("block", block).select(
        "payload_key", page("WARC-Record-ID").alias("page_id"), field("WARC-Target-URI").alias("url"),
        field("WARC-Type").alias("record_type"), page("WARC-Refers-To").alias("refers_to"),
        F.substring(field("WARC-Payload-Digest"), 6, 40).alias("said"), field("X-Payload-Length").cast("long").alias("payload_bytes"),
        (field("Content-Length").cast("long") == F.octet_length("block")).alias("whole"),
        F.sha1("block").alias("sha1"), F.sha2("block", 256).alias("key"), F.octet_length("block").cast("long").alias("bytes"))


def read(headers: DataFrame, payloads: DataFrame) -> DataFrame:
    """page_id, url, payload_bytes, payload_digest, record_type, refers_to; fails on a record whose payload isn't its own.

    A response is held against its own block, a revisit against a response of the same payload.
    """
    parsed = materialize(parse(records(headers, payloads)), "records")
    response = F.col("record_type") == "response"
    stored = parsed.filter(response).groupBy("payload_key").agg(
        F.min("sha1").alias("sha1"), F.max("sha1").alias("other"), F.min("key").alias("key"), F.max("key").alias("last"),
        F.min("bytes").alias("bytes"))
    known = (F.col("sha1") == F.col("other")) & (F.col("key") == F.col("last")) & (F.col("key") == F.col("payload_key"))
    good = F.col("whole") & F.col("known") & (F.col("said") == F.col("sha1")) & (F.col("payload_bytes") == F.col("bytes"))
    joined = parsed.drop("sha1", "key", "bytes").join(
        stored.select("payload_key", "sha1", "bytes", known.alias("known")), "payload_key", "left")
    lost = headers.select("payload_key").join(payloads.select("payload_key"), "payload_key", "left_anti").select(
        F.lit(None).cast("long").alias("page_id"), F.lit(None).cast("string").alias("url"), F.lit(None).cast("long").alias("payload_bytes"),
        F.lit(None).cast("string").alias("said"), F.lit("").alias("record_type"), F.lit(None).cast("long").alias("refers_to"),
        F.lit(False).alias("good"))
    return joined.withColumn("good", F.coalesce(good, F.lit(False))).select(*lost.columns).union(lost).select(
        "page_id", "url", "payload_bytes",
        F.when(F.col("good"), F.col("said")).otherwise(F.raise_error(F.lit(BROKEN)).cast("string")).alias("payload_digest"),
        "record_type", "refers_to")
