"""WARC archives with an index: written record by record, read back by byte ranges.

Records go to gzipped archives of a bounded size, one gzip member each, and their offset,
length, URL and digest to an index table. A payload is stored once: of equal ones that of
the largest page is a response, the others revisit it. Readers sort the records that an
index selects, put neighbouring ones into one read, and take them apart again.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.skew import SALTS
from ..session import checkpoint, shared_dir
from .common import streamed

ARCHIVE = 1 << 30
GAP, READ = 1 << 16, 1 << 23
LEVEL = 5
COPIES = 100_000
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
INDEX = "page_id long, url string, record_type string, payload_digest string, payload_bytes long, refers_to long, record string, archive string, offset long, length long"
FOUND = "page_id long, url string, record_type string, payload_digest string, payload_bytes long, refers_to long, record string"


def store(folder: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder that every executor reaches (file:, hdfs:, s3:, gs:, or a plain path)."""
    if ":/" not in folder:
        return fs.LocalFileSystem(), folder
    if folder.startswith("file:"):
        return fs.LocalFileSystem(), "/" + folder.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(folder)


# ---- which records there are


def base32(hexed: Column) -> Column:
    """Upper-case base32 of 20 bytes given in hex: every five hex digits are four letters."""
    parts = [F.lpad(F.conv(F.substring(hexed, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def record_id(page: Column, url: Column, digest: Column, copy: Column | None = None) -> Column:
    parts = [F.coalesce(c.cast("string"), F.lit("\x00")) for c in (page, url, digest, *([] if copy is None else [copy]))]
    return F.md5(F.concat_ws("\x1f", *parts).cast("binary"))


def described(pages: DataFrame, key: str, url: str, html: str) -> DataFrame:
    """(page_id, url, payload, payload_bytes, payload_digest, record) of every page; equal pages have one record."""
    own = pages.select(F.col(f"`{key}`").cast("long").alias("page_id"), F.col(f"`{url}`").alias("url"), F.coalesce(F.col(f"`{html}`"), F.lit("")).cast("binary").alias("payload"))
    own = own.select("*", F.octet_length("payload").cast("long").alias("payload_bytes"), base32(F.sha1("payload")).alias("payload_digest"))
    return own.withColumn("record", record_id(F.col("page_id"), F.col("url"), F.col("payload_digest")))


def records(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", least: int = 0) -> DataFrame:
    """One row for each row of `pages`, with the payload for responses only.

    Which payload stays is decided on rows without payloads. Payloads are shuffled once,
    one of equal pages a map task, and meet the decision about their own page.
    """
    rows = described(pages, key, url, html)
    short = F.first(F.when(F.col("payload_bytes") < least, F.col("payload"))) if least > 0 else F.first(F.lit(None).cast("binary"))
    about = ["record", "page_id", "url", "payload_digest", "payload_bytes"]
    groups = checkpoint(rows.groupBy(*about).agg(F.count(F.lit(1)).alias("n"), short.alias("short")))
    largest = groups.where(F.col("payload_bytes") >= least).groupBy(F.col("payload_digest").alias("of")).agg(F.max(F.struct("page_id", "url")).alias("keeper"), F.count(F.lit(1)).alias("pages"))
    # one payload may be that of most pages: pages are spread over salts, the few rows about repeated payloads repeated for each
    repeated = largest.where("pages > 1").select("of", "keeper", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("place"))
    salted = groups.withColumn("salt", F.pmod(F.xxhash64("record"), F.lit(SALTS)))
    told = salted.join(repeated, (F.col("payload_digest") == F.col("of")) & (F.col("salt") == F.col("place")), "left")
    own = F.struct("page_id", "url")
    told = checkpoint(told.select(*about, "n", "short", F.coalesce("keeper", own).alias("to"), (F.col("keeper").isNull() | own.eqNullSafe(F.col("keeper"))).alias("kept")))

    payloads = rows.groupBy(F.col("record").alias("of")).agg(F.first("payload").alias("payload"))
    kept = told.where("kept").join(payloads, F.col("record") == F.col("of")).select(*about, "payload", F.lit("response").alias("record_type"), F.lit(None).cast("struct<page_id:bigint,url:string>").alias("to"), F.lit(0).cast("long").alias("copy"))

    more = told.withColumn("more", F.col("n") - F.col("kept").cast("long")).where("more > 0")
    more = more.withColumn("lot", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("more") - 1) / COPIES)))).repartition(F.xxhash64("record", "lot"))
    more = more.withColumn("copy", F.explode(F.sequence(F.col("lot") * COPIES + 1, F.least(F.col("more"), (F.col("lot") + 1) * COPIES))))
    each = F.col("payload_bytes") < least  # short payloads are always stored
    more = more.select(*about, "short", F.when(each, "response").otherwise("revisit").alias("record_type"), F.when(~each, F.col("to")).alias("to"), "copy")
    out = kept.unionByName(more.withColumnRenamed("short", "payload"))
    refers = F.when(F.col("record_type") == "revisit", record_id(F.col("to.page_id"), F.col("to.url"), F.col("payload_digest")))
    number = F.when(F.col("copy") > 0, record_id(F.col("page_id"), F.col("url"), F.col("payload_digest"), F.col("copy"))).otherwise(F.col("record"))
    return out.select(*about[1:], "payload", "record_type", F.col("to.page_id").alias("refers_to"), refers.alias("refers_record"), number.alias("record"))


# ---- the format


def member(row: dict, level: int = LEVEL) -> bytes:
    """A record as one gzip member."""
    head = (HEAD % row["payload_bytes"]).encode()
    block = head + (row["payload"] or b"")
    lines = [
        "WARC/1.1", f"WARC-Type: {row['record_type']}", f"WARC-Record-ID: <urn:uuid:{uuid.UUID(row['record'])}>", f"WARC-Date: {DATE}", "Content-Type: application/http;msgtype=response",
        f"WARC-Payload-Digest: sha1:{row['payload_digest']}", f"Content-Length: {len(block)}",
    ]
    if row["url"] is not None:
        lines.append("WARC-Target-URI: " + quote(row["url"], safe="!#$&'()*+,/:;=?@[]~%"))
    if row["page_id"] is not None:
        lines.append(f"Page-ID: {row['page_id']}")
    if row["record_type"] == "revisit":
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:uuid:{uuid.UUID(row['refers_record'])}>"]
        if row["refers_to"] is not None:
            lines.append(f"Refers-To-Page-ID: {row['refers_to']}")
    coder = zlib.compressobj(level, zlib.DEFLATED, 31)
    return coder.compress("\r\n".join([*lines, "", ""]).encode() + block + b"\r\n\r\n") + coder.flush()


def parsed(data: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """Named fields, head of the block and payload of one gzip member."""
    text = zlib.decompress(data, 31)
    end = text.index(b"\r\n\r\n")
    version, *lines = text[:end].decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines)
    block = text[end + 4 : end + 4 + int(fields["Content-Length"])]
    if not version.startswith("WARC/") or text[end + 4 + len(block) :] != b"\r\n\r\n":
        raise ValueError("not a WARC record")
    middle = block.index(b"\r\n\r\n") + 4
    return fields, block[:middle], block[middle:]


def opening() -> bytes:
    block = b"software: relweave\r\nformat: WARC File Format 1.1\r\n"
    head = f"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:{uuid.uuid4()}>\r\nWARC-Date: {DATE}\r\nContent-Type: application/warc-fields\r\nContent-Length: {len(block)}\r\n\r\n"
    coder = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return coder.compress(head.encode() + block + b"\r\n\r\n") + coder.flush()


# ---- archives


def write(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", html: str = "html", least: int = 0, most: int = ARCHIVE) -> DataFrame:
    """Write archives of `pages` and their index into `folder`; returns the index, read from there.

    Of pages with equal payloads of at least `least` bytes that with the largest page_id is
    the response (then the larger url; of wholly equal rows any one), shorter payloads are
    all responses. Null html is an empty payload; null ids and urls stay null; null ids are
    the smallest. A page of any length is one record, archives go on in a new file beyond
    `most` bytes. An empty table gives an empty index. Further columns of `pages` do not
    matter, whatever their names. A task that runs again writes new files; those of the lost
    run are named by no index row.
    """

    def run(batches):
        system, path = store(folder)
        system.create_dir(path)
        task = TaskContext.get()
        out, size, name, number = None, 0, "", 0
        for batch in batches:
            rows: list[tuple] = []
            for row in batch.to_pylist():
                if out is None or size >= most:
                    if out is not None:
                        out.close()
                    name = f"pages-{task.partitionId():06d}-{task.taskAttemptId()}-{uuid.uuid4().hex[:8]}-{number:04d}.warc.gz"
                    out, number = system.open_output_stream(f"{path}/{name}", compression=None), number + 1
                    first = opening()
                    out.write(first)
                    size = len(first)
                data = member(row)
                out.write(data)
                rows.append((*[row[c] for c in ("page_id", "url", "record_type", "payload_digest", "payload_bytes", "refers_to", "record")], name, size, len(data)))
                size += len(data)
            columns = list(zip(*rows, strict=True)) or [()] * 10
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)
        if out is not None:
            out.close()

    names = [x.split(" ")[0] for x in INDEX.split(", ")]
    kinds = [pa.int64() if x.endswith("long") else pa.string() for x in INDEX.split(", ")]
    records_ = streamed(records(pages, key, url, html, least))
    records_.mapInArrow(run, INDEX).write.parquet(f"{folder}/index")
    return pages.sparkSession.read.parquet(f"{folder}/index")


def ranges(rows: Iterator[tuple[str, int, int]], gap: int = GAP, most: int = READ) -> Iterator[tuple[str, int, int, list[tuple[int, int]]]]:
    """(archive, start, end, records) of sorted records: near neighbours share one read of up to `most` bytes."""
    held: list[tuple[int, int]] = []
    name, start, end = "", 0, 0
    for archive, offset, length in rows:
        if held and (archive != name or offset > end + gap or offset + length - start > most):
            yield name, start, end, held
            held = []
        if not held:
            name, start, end = archive, offset, offset
        held.append((offset, length))
        end = max(end, offset + length)
    if held:
        yield name, start, end, held


def read_back(index: DataFrame, folder: str, payload: bool = False, gap: int = GAP, most: int = READ) -> DataFrame:
    """The records that rows of `index` (archive, offset, length) name, from the archives in `folder`.

    Digest and size of a response are those of the payload that was read, and must be the
    stated ones; those of a revisit are the stated ones of the payload it refers to. With
    `payload`, responses carry theirs. A record named twice comes twice; an empty selection
    reads nothing. Files are cut into stretches of 16 reads, so a large archive has many readers,
    and the number of tasks follows the bytes to be read.
    """

    def run(batches):
        system, path = store(folder)
        opened, name = None, None

        def asked():
            for batch in batches:
                yield from zip(*[batch.column(i).to_pylist() for i in range(3)], strict=True)

        out: list[tuple] = []
        held = 0
        for archive, start, end, some in ranges(asked(), gap, most):
            if archive != name:
                if opened is not None:
                    opened.close()
                opened, name = system.open_input_file(f"{path}/{archive}"), archive
            data = opened.read_at(end - start, start)
            for offset, length in some:
                fields, head, body = parsed(data[offset - start : offset - start + length])
                kind, stated = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:")
                size = int(re.search(rb"Content-Length: (\d+)", head)[1])
                if kind == "response" and (base64.b32encode(hashlib.sha1(body).digest()).decode() != stated or len(body) != size):
                    raise ValueError(f"{archive}, {offset}: the payload is not the one that was written")
                page, other = fields.get("Page-ID"), fields.get("Refers-To-Page-ID")
                record = fields["WARC-Record-ID"].removeprefix("<urn:uuid:").rstrip(">").replace("-", "")
                row = (page and int(page), fields.get("WARC-Target-URI"), kind, stated, size, other and int(other), record)
                out.append((*row, body if kind == "response" else None) if payload else row)
                held += 256 + (len(body) if payload else 0)
            if held >= most:
                yield from given(out)
                out, held = [], 0
        if opened is not None:
            opened.close()
        yield from given(out)

    def given(rows):
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    schema = FOUND + (", payload binary" if payload else "")
    names = [x.split(" ")[0] for x in schema.split(", ")]
    kinds = [{"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}[x.split(" ")[1]] for x in schema.split(", ")]
    stretch = F.floor(F.col("offset") / (16 * most))
    tasks = max(index.sparkSession.sparkContext.defaultParallelism, (index.agg(F.sum("length")).first()[0] or 0) // (16 * most))
    placed = index.select("archive", "offset", "length").repartition(int(tasks), "archive", stretch).sortWithinPartitions("archive", "offset")
    return streamed(placed).mapInArrow(run, schema)


def round_trip(pages: DataFrame, folder: str | None = None, **options) -> DataFrame:
    """Write `pages` and read every record back."""
    spark: SparkSession = pages.sparkSession
    folder = folder or f"{shared_dir(spark)}/warc-{uuid.uuid4().hex[:12]}"
    return read_back(write(pages, folder, **options), folder)
