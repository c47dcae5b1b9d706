"""WARC archives: writing, reading, and revisit resolution.

Archives are written by Spark's text writer (one record a line, the line end being
the blank lines that close a record; gzip) and read as binary files, so any file
system that Spark reaches will do.  Files hold at most ``RECORDS`` records.  A task
unpacks one file as a stream and holds one record at a time.

Resolution shuffles headers only: digest, length and place of every record.  For
each digest the original is chosen by an aggregate, the other records become
revisits of it, and each archive file is rewritten with its own list of revisits:
what moves are headers, the places of revisits and, once, the packed files to their places,
in parts of about ``TASK_BYTES``; never single payloads.
"""

from __future__ import annotations

import hashlib
import zlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewatch.llm.common import pick, shared_path

RECORDS = 4000                  # records of an archive file at most
TASK_BYTES = 32 << 20           # packed bytes that a rewriting task gets, about
MIN_BYTES = 1000                # shorter payloads are never revisits
# Fixed values of the format.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = "\r\n\r\n"

_HEADERS = ("file string, at long, type string, record_id string, uri string, refers_to string, "
            "digest string, payload_bytes long, sound boolean")


# ---------------------------------------------------------------------- writing

def _clean(column):
    """A header value on one line: control characters become percent codes of their own."""
    return F.regexp_replace(F.regexp_replace(column, "\r", "%0D"), "\n", "%0A")


def responses(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
              date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """One response record per row as text (column value).

    A null payload is an empty one, a null address leaves its header out, and a row
    without an id gets the record id <urn:page:>.
    """
    src = pick(pages, id=id_col, url=url_col, html=html_col)
    body = F.coalesce("html", F.lit(""))
    size = F.octet_length(body)
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    size.cast("string"), F.lit("\r\n\r\n"))
    uri = F.coalesce(F.concat(F.lit("WARC-Target-URI: "), _clean(F.col("url")), F.lit("\r\n")), F.lit(""))
    return src.select(F.concat(
        F.lit(f"{VERSION}\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:"),
        F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit(f">\r\nWARC-Date: {date}\r\n"), uri,
        F.lit("WARC-Payload-Digest: sha1:"), F.sha1(body.cast("binary")),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "),
        (F.octet_length(http) + size).cast("string"), F.lit("\r\n\r\n"), http, body).alias("value"))


def write(records: DataFrame, path: str) -> str:
    """Write records (column value, text or bytes) as gzipped archive files below ``path``."""
    records.select(F.col("value").cast("string").alias("value")).write.option("lineSep", END) \
        .option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").option("maxRecordsPerFile", RECORDS).text(path)
    return path


# ---------------------------------------------------------------------- reading

class _Stream:
    """Bytes of a packed or plain archive, unpacked as far as asked for."""

    def __init__(self, raw: bytes):
        self.raw, self.at, self.buffer, self.done = memoryview(raw), 0, bytearray(), 0
        self.unpack = zlib.decompressobj(31) if raw[:2] == b"\x1f\x8b" else None

    def _more(self) -> bool:
        if self.at >= len(self.raw):
            return False
        chunk = self.raw[self.at:self.at + (1 << 16)]
        self.at += len(chunk)
        if self.unpack is None:
            self.buffer += chunk
            return True
        self.buffer += self.unpack.decompress(chunk)
        while self.unpack.eof:                       # the next member, if there is one
            rest = self.unpack.unused_data
            self.at -= len(rest)
            if not rest:
                if self.at >= len(self.raw):
                    break
            self.unpack = zlib.decompressobj(31)
            chunk = self.raw[self.at:self.at + (1 << 16)]
            self.at += len(chunk)
            self.buffer += self.unpack.decompress(chunk)
        return True

    def until(self, mark: bytes) -> bytes | None:
        """Bytes before the next mark, which is skipped; None at the end."""
        seen = 0
        while (found := self.buffer.find(mark, seen)) < 0:
            seen = max(0, len(self.buffer) - len(mark))
            if not self._more():
                return None
        return self.take(found + len(mark))[:found]

    def skip(self, letters: bytes) -> None:
        """Pass over bytes of the given kinds."""
        while True:
            n = 0
            while n < len(self.buffer) and self.buffer[n] in letters:
                n += 1
            del self.buffer[:n]
            self.done += n
            if self.buffer or not self._more():
                return

    def take(self, n: int) -> bytes:
        while len(self.buffer) < n and self._more():
            pass
        out = bytes(self.buffer[:n])
        del self.buffer[:n]
        self.done += len(out)
        return out


def records(raw: bytes):
    """(offset, headers, block) of every record of one archive file; header names in lower case."""
    stream = _Stream(raw)
    while True:
        stream.skip(b"\r\n")
        at = stream.done
        head = stream.until(b"\r\n\r\n")
        if head is None:
            return
        lines = head.split(b"\r\n")
        if not lines[0].startswith(b"WARC/"):
            raise ValueError(f"no WARC record at byte {at}: {lines[0][:40]!r}")
        fields = {}
        for line in lines[1:]:
            name, _, value = line.partition(b":")
            fields[name.strip().lower().decode("ascii", "replace")] = value.strip().decode("utf-8", "replace")
        size = int(fields.get("content-length", 0))
        block = stream.take(size)
        if len(block) < size:
            raise ValueError(f"record at byte {at} ends early")
        yield at, fields, block


def payload(fields: dict[str, str], block: bytes) -> tuple[bytes, bytes]:
    """(HTTP head, payload) of a block; all of it is payload where the record is no HTTP message."""
    if "application/http" in fields.get("content-type", ""):
        head, mark, body = block.partition(b"\r\n\r\n")
        return head + mark, body
    return b"", block


def headers(path, spark) -> DataFrame:
    """One row per record of the archives below ``path``; digest is the SHA-1 of the payload, revisits keep the declared one.

    ``sound`` is false where a declared digest differs from the payload's.
    """
    def run(batches):
        import pyarrow as pa
        names = [c.split(" ")[0] for c in _HEADERS.split(", ")]
        kinds = [pa.string(), pa.int64(), *[pa.string()] * 5, pa.int64(), pa.bool_()]
        for b in batches:
            for i in range(b.num_rows):
                file, rows = b.column(0)[i].as_py(), []
                for at, f, block in records(b.column(1)[i].as_buffer().to_pybytes()):
                    _, body = payload(f, block)
                    kind, own = f.get("warc-type"), hashlib.sha1(body).hexdigest()
                    told = (f.get("warc-payload-digest") or "").partition(":")[2].lower() or None
                    visit = kind == "revisit"
                    rows.append((file, at, kind, f.get("warc-record-id"), f.get("warc-target-uri"), f.get("warc-refers-to"),
                                 told if visit else own, None if visit else len(body), visit or told in (None, own)))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
    return files(path, spark).mapInArrow(run, _HEADERS)


def files(path, spark) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select(F.col("path").alias("file"), "content")


def page_number(column: str = "record_id"):
    return F.expr(f"try_cast(regexp_extract({column}, '<urn:page:(-?[0-9]+)>', 1) as bigint)")


# ------------------------------------------------------------------- resolution

def revisits(heads: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """(file, at, target): the records that repeat the payload of an original.

    Of equal payloads the record with the largest page number is the original; between
    equal numbers the place in the archives decides.
    """
    able = heads.where((F.col("type") == "response") & (F.col("payload_bytes") >= min_bytes)) \
        .select("digest", page_number().alias("page"), "file", "at", "record_id")
    first = able.groupBy("digest").agg(F.count("*").alias("n"), F.max(F.struct("page", "file", "at", "record_id")).alias("best")) \
        .where("n > 1").select("digest", "best")
    return able.join(first, "digest").where("not (file = best.file and at = best.at)") \
        .select("file", "at", F.col("best.record_id").alias("target"))


def deduplicate(source: str, target: str, spark, min_bytes: int = MIN_BYTES) -> DataFrame:
    """Rewrite the archives below ``source`` to ``target`` with revisit records in place of repeated payloads.

    Returns the headers of the new archives.  Records that are no responses go over
    unchanged; an empty source gives an empty target.
    """
    lists = revisits(headers(source, spark), min_bytes)

    def run(batches):
        import pyarrow as pa
        name, moved = None, {}
        for b in batches:
            for i in range(b.num_rows):
                if name != (file := b.column(0)[i].as_py()):
                    name, moved = file, {}
                if not b.column(4)[i].is_valid:                # a place of the list, before its file
                    moved[b.column(2)[i].as_py()] = b.column(3)[i].as_py()
                    continue
                out, size = [], 0
                for at, f, block in records(b.column(4)[i].as_buffer().to_pybytes()):
                    out.append(fresh(f, block, moved.get(at)))
                    size += len(out[-1])
                    if size > 1 << 22:
                        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])
                        out, size = [], 0
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])
    # as many parts as the packed bytes ask for: they stay of one size however much there is; within one
    # the places of a file (at most RECORDS) come before it
    packed = spark.read.format("binaryFile").load(source).agg(F.sum("length")).first()[0] or 0
    places = lists.select("file", F.lit(0).alias("kind"), "at", "target", F.lit(None).cast("binary").alias("content"))
    bodies = files(source, spark).select("file", F.lit(1).alias("kind"), F.lit(None).cast("long").alias("at"),
                                         F.lit(None).cast("string").alias("target"), "content")
    both = places.unionByName(bodies).repartition(int(packed // TASK_BYTES) + 1, "file").sortWithinPartitions("file", "kind")
    write(both.mapInArrow(run, "value binary"), target)
    return headers(target, spark)


def fresh(fields: dict[str, str], block: bytes, target: str | None) -> bytes:
    """A record with headers made anew; with a target it becomes a revisit without payload."""
    f = dict(fields)
    if target is not None:
        block = payload(fields, block)[0]
        f |= {"warc-type": "revisit", "warc-refers-to": target, "warc-profile": PROFILE}
    f["content-length"] = str(len(block))
    f.pop("warc-block-digest", None)
    order = ("warc-type", "warc-record-id", "warc-date")
    names = [n for n in order if n in f] + [n for n in f if n not in (*order, "content-length")] + ["content-length"]
    head = "".join(f"{_title(n)}: {f[n]}\r\n" for n in names)
    return f"{VERSION}\r\n{head}\r\n".encode() + block


def _title(name: str) -> str:
    upper = {"warc": "WARC", "id": "ID", "uri": "URI", "ip": "IP"}
    return "-".join(upper.get(p, p.capitalize()) for p in name.split("-"))


def resolve(pages: DataFrame, min_bytes: int = MIN_BYTES, id_col: str = "page_id", url_col: str = "url",
            html_col: str = "html") -> DataFrame:
    """Write pages as archives, deduplicate them, and join the revisits read back with their originals.

    One row per input row: page_id, payload_bytes, payload_digest, record_type, refers_to.
    Rows with a null id have a null page_id (and come after all others as originals);
    repeated rows are records like any other.  Only the three columns are read; an
    empty table gives no rows.
    """
    spark = pages.sparkSession
    raw = write(responses(pages, id_col, url_col, html_col), shared_path(spark, "warc-raw"))
    done = deduplicate(raw, shared_path(spark, "warc-dedup"), spark, min_bytes)
    answer = done.where("type <> 'revisit'")
    visit = done.where("type = 'revisit'").select("record_id", "digest", F.col("refers_to").alias("target"))
    original = answer.select(F.col("record_id").alias("target"), "digest", "payload_bytes").where(F.col("payload_bytes") >= min_bytes)
    again = visit.join(original, ["digest", "target"], "left").select(
        page_number().alias("page_id"), "payload_bytes", F.col("digest").alias("payload_digest"),
        F.lit("revisit").alias("record_type"), page_number("target").alias("refers_to"))
    return answer.select(page_number().alias("page_id"), "payload_bytes", F.col("digest").alias("payload_digest"),
                         F.col("type").alias("record_type"), F.lit(None).cast("long").alias("refers_to")).unionByName(again)
