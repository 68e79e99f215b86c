"""WARC archives: writing with Spark's text writer, reading by boundary-chain verification.

Writing. A record is one line of a text file whose line separator is the blank lines that end a
WARC record, so the archives come from Spark's own writer, on any file system it knows.

Reading. The files are split anywhere, so a task cannot tell a record's first bytes from the
same bytes inside a payload.
1. Spark's text reader cuts each file at the magic ``WARC/1.`` (in parallel over splits). The
   start of each piece follows from the lengths of the pieces before it: a running total inside
   a split, plus the total of the splits before it.
2. Each piece with a parsable header is a candidate record with an edge from its offset to that
   of its successor, which the content length gives.
3. Pointer jumping from offset 0 of each file, doubling the jump each round, finds the candidates
   on the chain; all others are magic inside payloads. The rounds move (file, offset, offset)
   rows only, and their number is the logarithm of the records in a file.
4. A payload that lies in one piece is hashed where it was read and does not travel. Those cut
   by magic inside them are put together in a second scan, of which only their pieces travel.
The chain must end at the end of each file, or the reading fails: nothing is lost silently.

Defined cases: a null payload is empty; a null key or URL has no header; CR and LF in a URL are
percent-encoded, and keys are form-encoded and decoded again; a content length of over 18 digits, or beyond
its file's size, makes no candidate; repeated rows are records of their own; of equal payloads the record with the
smallest key is the response (null keys last, then the first in file order) and others are its
revisits; empty tables make empty archives; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from urllib.parse import unquote_plus

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from airledger.llm.common import shared_dir, stored, utf8

MAGIC = "WARC/1."
KEY_HEADER = "X-Record-Key"
DATE = "1970-01-01T00:00:00Z"
_BLANK = b"\r\n\r\n"
_VERSION = re.compile(rb"[01]\r\n")
_HEADER = re.compile(rb"(?m)^([A-Za-z0-9-]+):[ \t]*(.*?)[ \t]*\r?$")
_CELL_BITS = 20
#: Pieces of cut records up to which their places (some 100 bytes each) are broadcast to the second scan.
BROADCAST_PIECES = 200_000


def base32_sha1(data: Column) -> Column:
    """Bare upper-case base32 of the SHA-1: 5 hex digits are 20 bits, or 4 base32 digits."""
    hexed = F.sha1(data)
    digits = [F.lpad(F.conv(F.substring(hexed, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.upper(F.concat(*digits)), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def write_archives(rows: DataFrame, folder: str, key: str, url: str, payload: str) -> None:
    """One response record per row, in one archive per partition."""
    body = F.coalesce(F.col(payload), F.lit(""))
    target = F.replace(F.replace(F.replace(F.col(url), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A")), F.lit(MAGIC), F.lit("WARC%2F1."))
    mark = F.md5(F.concat_ws(" ", F.col(key).cast("string"), F.col(url), F.sha1(utf8(F.col(payload)))).cast("binary"))
    uuid = F.concat_ws("-", *(F.substring(mark, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))))
    lines = [F.lit(f"{MAGIC}1"), F.lit("WARC-Type: response"),
             F.concat(F.lit("WARC-Record-ID: <urn:uuid:"), uuid, F.lit(">")), F.lit(f"WARC-Date: {DATE}"),
             F.concat(F.lit("WARC-Target-URI: "), target), F.concat(F.lit(f"{KEY_HEADER}: "), F.url_encode(F.col(key).cast("string"))),
             F.concat(F.lit("WARC-Payload-Digest: sha1:"), base32_sha1(utf8(F.col(payload)))),
             F.lit("Content-Type: text/html; charset=utf-8"), F.concat(F.lit("Content-Length: "), F.octet_length(body).cast("string"))]
    head = F.concat_ws("\r\n", *lines)  # leaves out null lines
    rows.select(F.concat(head, F.lit("\r\n\r\n"), body).alias("value")).write.option("lineSep", "\r\n\r\n").text(folder)


def _pieces(spark: SparkSession, folder: str) -> DataFrame:
    return (spark.read.option("lineSep", MAGIC).text(folder)
            .select(F.col("value").cast("binary").alias("piece"), F.col("_metadata.file_path").alias("file"),
                    F.col("_metadata.file_block_start").alias("block"), F.col("_metadata.file_size").alias("size")))


def _header(piece: bytes, size: int) -> tuple[int, int, dict[bytes, bytes]] | None:
    """Bytes of the header up to its blank line, the content length and the fields; None if it
    isn't the header of a record that a file of ``size`` bytes can hold."""
    if not _VERSION.match(piece) or (end := piece.find(_BLANK)) < 0:
        return None
    fields = {m[1].lower(): m[2] for m in _HEADER.finditer(piece[:end])}
    length = fields.get(b"content-length", b"").lstrip(b"0") or b"0"
    if b"content-length" not in fields or not length.isdigit() or len(length) > 18 or int(length) > size:
        return None
    return end + 4, int(length), fields


def _digest(body: bytes) -> str:
    return base64.b32encode(hashlib.sha1(body).digest()).decode()


_SCAN = ("file string, block long, size long, local long, bytes long, head long, body long, key string, uri string, "
         "kind string, declared string, digest string")


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each piece's place in its split, and of a candidate what its header says."""
    place, local = None, 0
    for batch in batches:
        out = []
        for i in range(batch.num_rows):
            piece, file, block, size = (batch.column(c)[i].as_py() for c in range(4))
            if (file, block) != place:
                place, local = (file, block), 0
            row = [file, block, size, local, len(piece)] + [None] * 7
            if got := _header(piece, size):
                head, body, fields = got
                text = lambda name: fields[name].decode("utf-8", "replace") if name in fields else None  # noqa: B023, E731
                key = text(KEY_HEADER.lower().encode())
                row[5:] = [head, body, None if key is None else unquote_plus(key), text(b"warc-target-uri"), text(b"warc-type"), text(b"warc-payload-digest"),
                           _digest(piece[head:head + body]) if head + body <= len(piece) else None]
            out.append(row)
            local += len(piece) + len(MAGIC)
        yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], type=t.type) for c, t in enumerate(_SCHEMA)], schema=_SCHEMA)


_SCHEMA = pa.schema([(n, pa.string() if t == "string" else pa.int64()) for n, t in (f.split() for f in _SCAN.split(", "))])


def _with_offsets(pieces: DataFrame, bases: DataFrame) -> DataFrame:
    """``at``: the file offset where a piece begins, just after its magic."""
    return pieces.join(bases.hint("merge"), ["file", "block"]).withColumn("at", F.col("base") + F.col("local"))


def chain(edges: DataFrame) -> DataFrame:
    """(file, at) of the candidates reachable from offset 0 of their file over edges (file, at,
    to), by pointer jumping."""
    # both sides grow with the records, whatever their files' size says
    nodes = edges.select("file", F.col("at").alias("to")).hint("merge")
    jump = stored(edges.join(nodes, ["file", "to"], "left_semi").select("file", "at", "to"), "jump")
    found = stored(edges.where("at = 0").select("file", "at"), "found")
    while not jump.isEmpty():
        found = stored(found.union(found.join(jump.hint("merge"), ["file", "at"]).select("file", F.col("to").alias("at"))), "found")
        second = jump.select("file", F.col("at").alias("to"), F.col("to").alias("end")).hint("merge")
        jump = stored(jump.join(second, ["file", "to"]).select("file", "at", F.col("end").alias("to")), "jump")
    return found


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """Per record: file, at (offset), key, uri, kind, declared (payload digest as written),
    payload_bytes, payload_digest (as read)."""
    pieces = stored(_pieces(spark, folder).mapInArrow(_scan, _SCAN), "pieces")
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    bases = (pieces.groupBy("file", "block").agg(F.sum(F.col("bytes") + len(MAGIC)).alias("__sum"))
             .select("file", "block", F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("base")))
    placed = stored(_with_offsets(pieces.where("head is not null"), bases).select(
        "file", "size", (F.col("at") - len(MAGIC)).alias("at"), (F.col("at") + F.col("head")).alias("from"), "body",
        (F.col("at") + F.col("head") + F.col("body") + 4).alias("to"), "key", "uri", "kind", "declared", "digest"), "candidates")
    records = stored(placed.join(chain(placed.select("file", "at", "to")).hint("merge"), ["file", "at"], "left_semi"), "records")

    ends = pieces.groupBy("file").agg(F.max("size").alias("size")).join(records.groupBy("file").agg(F.max("to").alias("to")), "file", "left")
    broken = ends.where("size > 0 and not (to <=> size)").select("file", "size", "to").head(1)
    if broken:
        raise ValueError(f"{broken[0]['file']}: the chain of records ends at {broken[0]['to']}, the file at {broken[0]['size']}")

    cut = records.where("digest is null")
    if not cut.isEmpty():
        whole = _assembled(_pieces(spark, folder), _with_offsets(pieces.select("file", "block", "local"), bases), cut)
        records = records.join(whole.hint("merge"), ["file", "at"], "left").withColumn("digest", F.coalesce("digest", "joined"))
    return records.select("file", "at", "key", "uri", "kind", "declared", F.col("body").alias("payload_bytes"), F.col("digest").alias("payload_digest"))


def _join_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for i in range(batch.num_rows):
            file, at, start, body, parts = (batch.column(c)[i].as_py() for c in range(5))
            parts = sorted(parts, key=lambda p: p["at"])
            data = MAGIC.encode().join(p["piece"] for p in parts)
            skip = start - parts[0]["at"]
            if skip < 0 or len(data) < skip + body:
                raise ValueError(f"{file}: the pieces of the record at {at} are not those of the first scan")
            out.append((file, at, _digest(data[skip:skip + body])))
        yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], type=t) for c, t in enumerate((pa.string(), pa.int64(), pa.string()))],
                                         names=["file", "at", "joined"])


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    place, local = None, 0
    for batch in batches:
        starts = []
        for i in range(batch.num_rows):
            here = (batch.column(1)[i].as_py(), batch.column(2)[i].as_py())
            if here != place:
                place, local = here, 0
            starts.append(local)
            local += len(batch.column(0)[i].as_buffer() or b"") + len(MAGIC)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(starts, pa.int64())],
                                         names=["piece", "file", "block", "local"])


def _assembled(pieces: DataFrame, placed: DataFrame, cut: DataFrame) -> DataFrame:
    """(file, at, joined): the digest of each cut record's payload. Records and the places of
    pieces, without their bytes, meet by file and 1 MB cell; of the second scan's pieces only those
    found there travel, and a record's own pieces are all that a group holds."""
    cell = lambda c: F.shiftright(c, _CELL_BITS)
    ranges = cut.select("file", F.col("at").alias("record"), "from", "body", "to",
                        F.explode(F.sequence(cell(F.col("at")), cell(F.col("to")))).alias("cell"))
    met = placed.withColumn("cell", cell(F.col("at"))).join(ranges.hint("merge"), ["file", "cell"]).where("at > record and at < to")
    needed = stored(met.select("file", "block", "local", "at", "record", "from", "body"), "needed")
    few = needed.count() <= BROADCAST_PIECES
    local = pieces.mapInArrow(_placed, "piece binary, file string, block long, local long")
    there = local.join(F.broadcast(needed) if few else needed.hint("merge"), ["file", "block", "local"])
    groups = there.groupBy("file", "record", "from", "body").agg(F.collect_list(F.struct("at", "piece")).alias("parts"))
    return groups.select("file", F.col("record").alias("at"), "from", "body", "parts").mapInArrow(_join_pieces, "file string, at long, joined string")


def with_revisits(records: DataFrame, key_type: str = "long") -> DataFrame:
    """``records`` with key as ``key_type``, record_type and refers_to. A digest's smallest
    record is taken before the shuffle, so a payload of which there are many is one row there."""
    own = F.struct(F.col("key").isNull().alias("unkeyed"), F.col("key"), F.col("file"), F.col("at"))
    typed = records.withColumn("key", F.col("key").cast(key_type))
    first = typed.groupBy("payload_digest", "payload_bytes").agg(F.min(own).alias("first"))
    joined = typed.join(first.hint("merge"), ["payload_digest", "payload_bytes"])
    is_first = (F.col("file") == F.col("first.file")) & (F.col("at") == F.col("first.at"))
    return (joined.withColumn("record_type", F.when(is_first, "response").otherwise("revisit"))
            .withColumn("refers_to", F.when(~is_first, F.col("first.key"))).drop("first"))


def archived_pages(pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    """The pages written to archives in the shared folder and read back: per record the key,
    payload_bytes, payload_digest, record_type, refers_to."""
    folder = f"{shared_dir(pages.sparkSession)}/warc"
    write_archives(pages, folder, key, url, payload)
    records = with_revisits(read_archives(pages.sparkSession, folder), pages.schema[key].dataType.simpleString())
    return records.select(F.col("key").alias(key), "payload_bytes", "payload_digest", "record_type", "refers_to")
