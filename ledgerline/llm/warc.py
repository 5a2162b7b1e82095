"""WARC archives: write pages as records, read archives back even when they are damaged.

Writing is Spark's text sink, so archives come and go with the job's commit on any file system. Each record is a gzip
member of its own, packed in the tasks, so damage costs the records it touches and no later ones; the sink's line
separator is an empty member. The salvage reader also takes plain files and members of many records. It walks from record to record; where a check fails (version line, header, length,
end of record, digest, compressed member) it searches for the next valid version line or gzip member, goes on there,
and reports the bytes between as a quarantined gap.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from ledgerline.llm.common import small_batches, store
from ledgerline.workspace import new_dir

#: Payload bytes per archive file; a file is read by one task.
FILE_BYTES = 16 << 20
_END = "\r\n\r\n"
#: An empty gzip member, which stands between two records.
_EMPTY = gzip.compress(b"", mtime=0)
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
#: Stands for a null id in joins.
_NO_ID = -(2**63)
_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(data: Column) -> Column:
    """Upper-case base32 of the SHA-1: each 5 hex digits are four characters."""
    digest = F.sha1(data)

    def character(j: Column) -> Column:
        five = F.conv(F.substring(digest, F.floor(j / 4).cast("int") * 5 + 1, F.lit(5)), 16, 10).cast("int")
        place = F.call_function("shiftright", five, F.lit(15) - (j % 4) * 5).bitwiseAND(31)
        return F.substring(F.lit(_ALPHABET), place + 1, F.lit(1))

    return F.array_join(F.transform(F.sequence(F.lit(0), F.lit(31)), character), "")


def _name(page: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.when(page != _NO_ID, page.cast("string")).otherwise(F.lit("null")), F.lit(">"))


def write_archives(
    df: DataFrame, page_id: str = "page_id", url: str = "url", payload: str = "html", least_bytes: int = 0,
    root: str | None = None, file_bytes: int = FILE_BYTES,
) -> str:
    """Write one record per row and return the folder.

    Of records with equal payloads of at least ``least_bytes`` bytes the one with the largest id is a response, the
    others revisit it; of repeated rows with that id one is the response. Null payloads are empty, null ids are the
    smallest, a null address leaves its field out.
    """
    spark = df.sparkSession
    root = root or new_dir(spark, "archive")
    content = F.coalesce(F.col(payload).cast("string"), F.lit(""))
    pages = df.select(
        F.coalesce(F.col(page_id).cast("long"), F.lit(_NO_ID)).alias("_id"), F.col(url).cast("string").alias("_url"), content.alias("_body"),
        F.octet_length(content).cast("long").alias("_bytes"), base32_sha1(content.cast("binary")).alias("_digest"),
        F.sha2(content, 256).alias("_same"),
    )
    # Narrow rows decide who is the response; payloads move once, by id, whatever their copies.
    named = pages.select("_id", "_same", "_bytes").groupBy("_id", "_same", "_bytes").agg(F.count("*").alias("_n"))
    newest = named.where(F.col("_bytes") >= least_bytes).groupBy("_same").agg(
        F.max("_id").alias("_top"))
    kinds = store(
        named.join(newest, "_same", "left").select(
            "_id", "_same", F.when(F.col("_bytes") >= least_bytes, F.col("_top")).alias("_target"),
        ),
        "kinds",
    )
    total = named.agg(F.sum(F.col("_bytes") * F.col("_n"))).first()[0] or 0
    files = max(1, -(-total // file_bytes))
    joined = pages.repartition(files, "_id", "_same").join(kinds, ["_id", "_same"])
    twin = F.row_number().over(Window.partitionBy("_id", "_same").orderBy("_url"))
    is_revisit = F.col("_target").isNotNull() & ((F.col("_id") != F.col("_target")) | (F.col("_twin") > 1))
    body = F.when(is_revisit, F.lit("")).otherwise(F.concat(F.lit(_HTTP), F.col("_body")))

    def field(label: str, value: Column) -> Column:
        return F.concat(F.lit(label + ": "), value, F.lit("\r\n"))

    record = F.concat(
        F.lit("WARC/1.0\r\n"),
        field("WARC-Type", F.when(is_revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        field("WARC-Record-ID", _name(F.col("_id"))),
        F.coalesce(field("WARC-Target-URI", F.regexp_replace("_url", r"[\x00-\x20]", "%20")), F.lit("")),
        F.when(is_revisit, F.concat(
            field("WARC-Profile", F.lit("http://netpreserve.org/warc/1.0/revisit/identical-payload-digest")),
            field("WARC-Refers-To", _name(F.col("_target"))),
        )).otherwise(F.lit("")),
        field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("_digest"))),
        field("X-Payload-Length", F.col("_bytes").cast("string")),
        field("Content-Type", F.lit("application/http; msgtype=response")),
        field("Content-Length", F.octet_length(body).cast("string")),
        F.lit("\r\n"),
        body,
        F.lit(_END),
    )
    small_batches(df)

    def pack(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            packed = []
            for data in batch:
                packer = zlib.compressobj(wbits=31)
                packed.append(packer.compress(data.as_buffer()) + packer.flush())
            yield pa.array(packed, pa.binary())

    pack.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    members = F.arrow_udf(pack, "binary")(record.cast("binary")).cast("string")  # the sink writes the bytes as they are
    (
        joined.withColumn("_twin", twin).select(members.alias("value"))
        .write.option("lineSep", _EMPTY.decode("latin-1")).option("encoding", "ISO-8859-1").option("compression", "none").text(root)
    )
    return root


#: What the reader returns for each record or gap.
ROWS = (
    "file string, position long, inner long, length long, kind string, reason string, record_type string, record_id string, "
    "target_uri string, refers_to string, payload_bytes long, payload_digest string, payload binary"
)
_SCHEMA = pa.schema([
    ("file", pa.string()), ("position", pa.int64()), ("inner", pa.int64()), ("length", pa.int64()), ("kind", pa.string()), ("reason", pa.string()),
    ("record_type", pa.string()), ("record_id", pa.string()), ("target_uri", pa.string()), ("refers_to", pa.string()),
    ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary()),
])


class Damaged(Exception):
    """A check failed at this place."""


def parse_plain(data: bytes, at: int) -> tuple[dict[str, str], bytes, int]:
    """Headers, block and end of the record whose version line starts at ``at``."""
    if data[at : at + 7] != b"WARC/1.":
        raise Damaged("version line")
    head_end = data.find(b"\r\n\r\n", at)
    if head_end < 0:
        raise Damaged("header end")
    headers = {}
    for line in data[at:head_end].split(b"\r\n")[1:]:
        label, colon, value = line.partition(b":")
        if not colon or b" " in label:
            raise Damaged("header field")
        headers[label.decode("latin-1").lower()] = value.strip().decode("utf-8", "replace")
    if not headers.get("content-length", "").isdigit():
        raise Damaged("content length")
    start = head_end + 4
    end = start + int(headers["content-length"])
    if data[end : end + 4] != b"\r\n\r\n":
        raise Damaged("record end")
    return headers, data[start:end], end + 4


def inflate(data: bytes, at: int) -> tuple[bytes, int | None]:
    """What the gzip member at ``at`` inflates to, and its end, None if it breaks off; all that comes before an error counts."""
    inflater, parts, place = zlib.decompressobj(wbits=31), [], at
    while place < len(data) and not inflater.eof:
        before = inflater.copy()
        try:
            parts.append(inflater.decompress(data[place : place + 65536]))
        except zlib.error:  # a failing call gives nothing: go on from before it, byte by byte
            try:
                for k in range(place, min(place + 65536, len(data))):
                    parts.append(before.decompress(data[k : k + 1]))
            except zlib.error:
                pass
            return b"".join(parts), None
        place += 65536
    return b"".join(parts), min(place, len(data)) - len(inflater.unused_data) if inflater.eof else None


def checked(headers: dict[str, str], block: bytes) -> tuple[dict[str, str], bytes, str, int]:
    """Payload, digest and length, after the digest of a record with a payload has been compared."""
    payload = block
    if headers.get("content-type", "").startswith("application/http") and block:
        payload = block.partition(b"\r\n\r\n")[2]
    told = headers.get("warc-payload-digest", "").rpartition(":")[2].upper()
    if headers.get("warc-type") == "revisit":
        length = headers.get("x-payload-length", "")
        return headers, payload, told, int(length) if length.isdigit() else None
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    if told and told != digest:
        raise Damaged("payload digest")
    return headers, payload, digest, len(payload)


def salvage(data: bytes, packed: bool = True) -> Iterator[tuple]:
    """(position, inner position, length, reason, (headers, payload, digest, payload bytes)), without a reason for records.

    Of a gzip member that breaks off, the records before the break count; the member itself is a gap.
    """
    at, lost, why = 0, None, None
    while at < len(data):
        rows = []
        try:
            if packed and data[at : at + 2] == b"\x1f\x8b":
                plain, end = inflate(data, at)
                rows = [(at, inner, size, reason, found) for inner, _, size, reason, found in salvage(plain, False)]
                if end is None:
                    raise Damaged("gzip member")
            else:
                headers, block, end = parse_plain(data, at)
                rows = [(at, 0, end - at, None, checked(headers, block))]
        except Damaged as error:
            yield from (row for row in rows if row[4])
            if lost is None:
                lost, why = at, str(error)
            later = [x for x in (data.find(b"WARC/1.", at + 1), data.find(b"\x1f\x8b\x08", at + 1)) if x >= 0]
            at = min(later, default=len(data))
            continue
        if lost is not None:
            yield lost, 0, at - lost, why, None
            lost = None
        yield from rows
        at = end
    if lost is not None:
        yield lost, 0, len(data) - lost, why, None


def _urn(value: str | None) -> str | None:
    name = value.removeprefix("<urn:page:").removesuffix(">") if value else None
    return None if name == "null" else name


def read_archives(spark: SparkSession, root: str, with_payload: bool = True) -> DataFrame:
    """Records (``kind`` 'record') and gaps (``kind`` 'gap', with ``reason``) of all files below ``root``; see ``ROWS``.

    Plain and gzip-member archives are told apart record by record. An empty file gives no rows; one without any valid
    record is a single gap. A record is returned once its checks hold; nothing is guessed.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                rows, held = [], 0
                for at, inner, length, reason, found in salvage(content.as_py() or b""):
                    if found is None:
                        rows.append((name, at, inner, length, "gap", reason, *[None] * 7))
                    else:
                        headers, payload, digest, size = found
                        rows.append((
                            name, at, inner, length, "record", None, headers.get("warc-type"), _urn(headers.get("warc-record-id")),
                            headers.get("warc-target-uri"), _urn(headers.get("warc-refers-to")), size, digest or None,
                            payload if with_payload else None,
                        ))
                        held += len(payload) if with_payload else 0
                    if len(rows) >= 4096 or held >= 32 << 20:
                        yield _batch(rows)
                        rows, held = [], 0
                if rows:
                    yield _batch(rows)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path", "content")
    return files.mapInArrow(run, ROWS)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=f.type) for c, f in zip(zip(*rows, strict=True), _SCHEMA, strict=True)], schema=_SCHEMA
    )
