"""Content-addressed web archive.

An archive is two tables below one path: ``payloads`` holds the bytes of every distinct payload once under its SHA-256,
``headers`` holds, for every record, the exact bytes in front of its payload and the digest that names it.  Joining the
two gives the original records byte for byte; the digest of what was read is compared with the digest it is stored under.
A repeated payload is a revisit: its headers name the record that holds it.

Defined results: a null payload is the empty payload; a null id is written as an empty text; of records with equal
payloads of at least ``least_bytes`` bytes those with the largest id are responses (rows that repeat an id are all
alike), the others revisits; where all ids are null all are responses; an empty table gives an empty archive.  Extra
columns of pages are not part of an archive.
"""

from __future__ import annotations

import gzip
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from treeledger.llm.common import stored

EOL = "\r\n"
# The alphabets of base 32 as digits of a number and as RFC 4648 writes them.
DIGITS, LETTERS = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def sha1_base32(payload: Column) -> Column:
    """Upper-case base-32 SHA-1 of bytes: 40 hexadecimal digits are 8 groups of 20 bits, 4 letters each."""
    return F.transform(
        F.array(F.sha1(payload)),
        lambda h: F.concat(
            *(
                F.translate(F.lpad(F.conv(F.substr(h, F.lit(1 + 5 * i), F.lit(5)), 16, 32), 4, "0"), DIGITS, LETTERS)
                for i in range(8)
            )
        ),
    )[0]


def records(
    pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", least_bytes: int = 0
) -> DataFrame:
    """One record a page: ``page_id, refers_to, header, digest, payload``; the payload is null for revisits."""
    body = F.coalesce(F.col(html), F.lit("")).cast("binary")
    base = pages.select(
        F.col(page_id).alias("page_id"),
        F.coalesce(F.col(url), F.lit("")).alias("_url"),
        body.alias("payload"),
        F.sha2(body, 256).alias("digest"),
    )
    # Only payloads that occur more than once have to be looked up; the stored table shows the planner how few they are.
    repeated = stored(
        base.where(F.octet_length("payload") >= least_bytes)
        .groupBy(F.col("digest").alias("_digest"))
        .agg(F.count("*").alias("_n"), F.max("page_id").alias("_last"))
        .where("_n > 1")
        .drop("_n"),
        "warc-repeated",
    )
    whole = base.join(repeated, F.col("digest") == F.col("_digest"), "left")
    revisit = F.coalesce(F.col("_last").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_last")), F.lit(False))
    whole = whole.withColumn("refers_to", F.when(revisit, F.col("_last")))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(EOL))
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(">"))
    revisited = F.col("refers_to").isNotNull()
    length = F.octet_length("payload").cast("string")
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{EOL}Content-Type: text/html; charset=utf-8{EOL}"), line("Content-Length", length), F.lit(EOL))
    sent = F.octet_length(http) + F.when(revisited, F.lit(0)).otherwise(F.octet_length("payload"))
    header = F.concat(
        F.lit(f"WARC/1.1{EOL}"),
        line("WARC-Type", F.when(revisited, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", urn("page_id")),
        line("WARC-Target-URI", F.regexp_replace("_url", r"[\r\n]", " ")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), sha1_base32(F.col("payload")))),
        F.when(
            revisited,
            F.concat(
                line("WARC-Refers-To", urn("refers_to")),
                F.lit(f"WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest{EOL}"),
            ),
        ).otherwise(F.lit("")),
        F.lit(f"Content-Type: application/http; msgtype=response{EOL}"),
        line("Content-Length", sent.cast("string")),
        F.lit(EOL),
        http,
    )
    return whole.select(
        "page_id",
        "refers_to",
        header.cast("binary").alias("header"),
        "digest",
        F.when(~revisited, F.col("payload")).alias("payload"),
        F.col("_digest").isNotNull().alias("shared"),
    )


def write_archive(found: DataFrame, path: str) -> None:
    """Write records: payloads once by digest, headers apart.

    ``found`` has ``header, digest, payload`` and ``shared``, false for a payload known to occur once.
    """
    found.select("digest", "header").write.parquet(f"{path}/headers")
    bodies = found.where(F.col("payload").isNotNull())
    alone = bodies.where(~F.col("shared")).select("digest", "payload")
    shared = bodies.where("shared").select("digest", "payload").dropDuplicates(["digest"])
    alone.unionByName(shared).write.parquet(f"{path}/payloads")


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Records of an archive with their payloads, revisits too; fails where bytes do not have their digest."""
    headers = spark.read.parquet(f"{path}/headers")
    bodies = spark.read.parquet(f"{path}/payloads").select(F.col("digest").alias("_digest"), "payload")
    proven = F.when(F.sha2("payload", 256) == F.col("_digest"), F.col("payload")).otherwise(
        F.raise_error(F.concat(F.lit("payload does not have the digest "), F.col("_digest"))).cast("binary")
    )
    joined = headers.join(bodies.withColumn("payload", proven), F.col("digest") == F.col("_digest"), "left")
    missing = F.raise_error(F.concat(F.lit("no payload with the digest "), F.col("digest"))).cast("binary")
    return joined.select("header", "digest", F.coalesce("payload", missing).alias("payload"))


def field(header: Column, name: str) -> Column:
    """The value of a header field, null where it is missing.  Only the block of the record is searched."""
    block = F.substring_index(header.cast("string"), EOL + EOL, 1)
    found = F.regexp_extract(block, f"(?i)(?:^|\n){name}: ?([^\r\n]*)", 1)
    return F.when(block.rlike(f"(?i)(?:^|\n){name}:"), found)


def original_bytes(header: Column, payload: Column) -> Column:
    """The bytes of a record as a WARC file holds them."""
    body = F.when(field(header, "WARC-Type") == "revisit", F.lit("").cast("binary")).otherwise(payload)
    return F.concat(header, body, F.lit(EOL + EOL).cast("binary"))


FILE_SCHEMA = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("offset", T.LongType()),
        T.StructField("header", T.BinaryType()),
        T.StructField("payload", T.BinaryType()),
    ]
)


def split_records(data: bytes) -> Iterator[tuple[int, bytes, bytes]]:
    """Offset, header bytes and payload of each record of an uncompressed WARC file."""
    at = 0
    while at < len(data):
        end = data.find(b"\r\n\r\n", at)
        if end < 0 or not data.startswith(b"WARC/", at):
            raise ValueError(f"no record at byte {at}")
        end += 4
        fields = dict(x.split(b":", 1) for x in data[at:end].split(b"\r\n")[1:] if b":" in x)
        lowered = {k.strip().lower(): v.strip() for k, v in fields.items()}
        stop = end + int(lowered[b"content-length"])
        if stop + 4 > len(data) or data[stop : stop + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} does not end where it says")
        body = end
        if lowered.get(b"content-type", b"").startswith(b"application/http"):
            inner = data.find(b"\r\n\r\n", end, stop)
            body = stop if inner < 0 else inner + 4
        yield at, data[at:body], data[body:stop]
        at = stop + 4


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """Records of WARC files, plain or gzip, one file after the other in each task."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                data = gzip.decompress(content) if content[:2] == b"\x1f\x8b" else content
                for at, header, payload in split_records(data):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name]), pa.array([at]), pa.array([header]), pa.array([payload])], FILE_SCHEMA.names
                    )

    return files.mapInArrow(run, FILE_SCHEMA)


def from_files(found: DataFrame) -> DataFrame:
    """Records of files in the form that ``write_archive`` takes; empty bodies of revisits are no payloads of their own.

    A revisit of a record in the same files gets the digest of that payload through its WARC-Payload-Digest.
    """
    kind = field(F.col("header"), "WARC-Type")
    named = F.regexp_replace(field(F.col("header"), "WARC-Payload-Digest"), "^sha1:", "")
    base = found.withColumn("_kind", kind).withColumn("_sha1", named).withColumn("digest", F.sha2("payload", 256))
    held = base.where("_kind <> 'revisit'").groupBy(F.col("_sha1").alias("_s")).agg(F.min("digest").alias("_digest"))
    own = base.where("_kind <> 'revisit'").select("header", "digest", "payload", F.lit(True).alias("shared"))
    again = base.where("_kind = 'revisit'").join(held, F.col("_sha1") == F.col("_s"), "left")
    return own.unionByName(
        again.select(
            "header",
            F.coalesce("_digest", "digest").alias("digest"),
            F.when(F.col("_digest").isNull(), F.col("payload")).alias("payload"),
            F.lit(True).alias("shared"),
        )
    )
