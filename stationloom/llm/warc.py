"""WARC archives: writing pages with revisit records, and a reader that splits compressed archives.

Every record is a gzip member of its own. A reading task owns a byte range of an archive: it looks for the gzip magic,
accepts a place only if the member there decodes to a WARC header and is followed by another member or the end of the file,
and then reads member after member while they start inside its range, so each record has one owner wherever ranges are cut.

Of pages with equal payloads, the one with the smallest page_id is a response and the others revisit it; smaller payloads
than ``least_bytes`` are all responses. Which pages are revisits is found from digests alone (one row per digest and task
before the shuffle); the page contents are joined by page, not by digest, so a payload in a third of all pages is no hot key.

Defined results: NULL html is an empty payload, NULL url is left out of the record; rows that repeat the response's page_id
and payload are responses as well; a page without page_id revisits an equal page that has one. A repeated attempt at a
writing task leaves an archive that the returned table does not name.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationloom.llm.shared_files import attempt_name, open_fs, write_file
from stationloom.storage import materialize, scratch_path

MAGIC = b"\x1f\x8b\x08"
DATE = "1970-01-01T00:00:00Z"
ARCHIVE_BYTES = 32 << 20
RANGE_BYTES = 8 << 20
#: Bytes read at once.
STEP = 1 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_SCHEMA = (
    "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, html string"
)


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{page_id}/{digest}')}>"


def _header_value(text: str) -> str:
    """No control characters in a header line."""
    return "".join(c if c.isprintable() else "".join(f"%{b:02X}" for b in c.encode("utf-8", "replace")) for c in text)


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One record as a gzip member."""
    digest = base32_sha1(payload)
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block += b"" if revisit else payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_record_id(page_id, digest)}"]
    lines += [f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha1:{digest}"]
    lines += [f"WARC-Target-URI: {_header_value(url)}"] if url is not None else []
    lines += [f"Page-ID: {page_id}"] if page_id is not None else []
    if revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_record_id(refers_to, digest)}", f"Refers-To-Page-ID: {refers_to}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return gzip.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n", compresslevel=6, mtime=0)


def parse(data: bytes) -> dict | None:
    """A record's fields from its uncompressed bytes; None if it is none."""
    head, cut, rest = data.partition(b"\r\n\r\n")
    if not cut or not head.startswith(b"WARC/1."):
        return None
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in head.decode("utf-8", "replace").split("\r\n")[1:])}
    block = rest[: int(fields.get("content-length", 0))]
    http, _, payload = block.partition(b"\r\n\r\n")
    sizes = [x.split(b":")[1] for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")]
    kind = fields.get("warc-type", "")
    number = lambda name: int(fields[name]) if name in fields else None
    response = kind == "response"
    return {
        "page_id": number("page-id"), "url": fields.get("warc-target-uri"),
        "payload_bytes": len(payload) if response else int(sizes[0]) if sizes else None,
        "payload_digest": base32_sha1(payload) if response else fields.get("warc-payload-digest", "").removeprefix("sha1:"),
        "record_type": kind, "refers_to": number("refers-to-page-id"),
        "html": payload.decode("utf-8", "replace") if response else None,
    }


# --- reading --------------------------------------------------------------------------------------


class _Bytes:
    """A file by place, read in steps; keeps what is still needed."""

    def __init__(self, file, at: int):
        self._file, self.start, self.data, self.ended = file, at, b"", False
        file.seek(at)

    def more(self) -> bool:
        got = b"" if self.ended else self._file.read(STEP)
        self.ended = self.ended or not got
        self.data += got
        return bool(got)

    def drop(self, at: int) -> None:
        """Forget what lies before ``at``."""
        self.data, self.start = self.data[at - self.start :], at


def _member(source: _Bytes, at: int) -> tuple[bytes, int] | None:
    """The contents of the gzip member at ``at`` and where it ends; None if there is none."""
    while len(source.data) < at - source.start + len(MAGIC) and source.more():
        pass
    if source.data[at - source.start : at - source.start + len(MAGIC)] != MAGIC:
        return None
    inflate, out, pos = zlib.decompressobj(zlib.MAX_WBITS | 16), [], at - source.start
    seen = 0
    try:
        while not inflate.eof:
            if pos >= len(source.data) and not source.more():
                return None
            part = inflate.decompress(source.data[pos:])
            pos = len(source.data) - len(inflate.unused_data)
            if not seen and part:
                head = part[:7]
                if not b"WARC/1.".startswith(head) and not head.startswith(b"WARC/1."):
                    return None
            seen += len(part)
            out.append(part)
    except zlib.error:
        return None
    return b"".join(out), source.start + pos


def _follows(source: _Bytes, end: int) -> bool:
    """Whether ``end`` is the end of the file or the start of another member."""
    while len(source.data) < end - source.start + len(MAGIC) and source.more():
        pass
    return source.data[end - source.start : end - source.start + len(MAGIC)] in (b"", MAGIC)


def records_in_range(path: str, begin: int, end: int) -> Iterator[dict]:
    """The records that start in [begin, end) of an archive."""
    system, name = open_fs(path)
    with system.open_input_file(name) as file:
        source, at, sure = _Bytes(file, begin), begin, begin == 0
        while at < end:
            source.drop(at)
            found = _member(source, at)
            row = parse(found[0]) if found and (sure or _follows(source, found[1])) else None
            if row:
                yield row
                at, sure = found[1], True
                continue
            # not a record: look for the next magic
            sure, place = False, -1
            skip = 1
            while place < 0:
                place = source.data.find(MAGIC, skip)
                if place < 0:
                    skip = max(1, len(source.data) - len(MAGIC) + 1)
                    if source.start + skip >= end or not source.more():
                        return
            at = source.start + place


# --- tables -----------------------------------------------------------------------------------------


def revisits(keys: DataFrame) -> DataFrame:
    """(page_id, digest, refers_to) of distinct (page_id, digest) whose payload a smaller page_id has.

    The first pages are stored, so both sides of the join are plain scans and nothing above it asks for a distribution:
    the rows of a payload in a third of all pages may be split over tasks.
    """
    firsts = keys.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("n")).where("n > 1")
    firsts = materialize(firsts.drop("n"), "first-pages")
    other = F.col("refers_to").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("refers_to"))
    return keys.join(firsts, "digest").where(other).select("page_id", "digest", "refers_to")


def with_revisits(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """(page_id, url, html, refers_to, revisit) of every row."""
    html = F.coalesce("html", F.lit(""))
    rows = pages.select("page_id", "url", html.alias("html"))
    rows = rows.withColumn("digest", F.sha1(F.encode("html", "UTF-8")))
    keys = rows.where(F.octet_length("html") >= least_bytes).select("page_id", "digest").distinct()
    again = materialize(revisits(materialize(keys, "page-digests")), "revisits")
    again = again.select(F.col("page_id").alias("r_page"), F.col("digest").alias("r_digest"), "refers_to")
    out = rows.join(again, F.col("page_id").eqNullSafe(F.col("r_page")) & (F.col("digest") == F.col("r_digest")), "left")
    return out.select("page_id", "url", "html", "refers_to", F.col("refers_to").isNotNull().alias("revisit"))


def write_archives(
    pages: DataFrame, least_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES, folder: str | None = None
) -> DataFrame:
    """Write a record per row; returns (path, bytes, records) of the archives."""
    folder = folder or scratch_path(pages.sparkSession, "warc")
    rows = with_revisits(pages, least_bytes)
    rows = rows.withColumns({n: F.col(n).cast("string") for n in ("page_id", "refers_to")})

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts: list[bytes] = []
        held = seq = 0

        def flush() -> pd.DataFrame:
            nonlocal held, seq
            path = write_file(folder, f"{attempt_name()}-{seq:06d}.warc.gz", parts)
            row = (path, held, len(parts))
            held, seq = 0, seq + 1
            parts.clear()
            return pd.DataFrame([row], columns=["path", "bytes", "records"])

        number = lambda x: None if pd.isna(x) else int(x)
        for batch in batches:
            for page_id, url, html, refers_to, revisit in batch.itertuples(index=False, name=None):
                url = None if pd.isna(url) else url
                one = record(number(page_id), url, html.encode("utf-8", "surrogatepass"), number(refers_to), bool(revisit))
                if held and held + len(one) > archive_bytes:
                    yield flush()
                parts.append(one)
                held += len(one)
        if parts:
            yield flush()

    return materialize(rows.mapInPandas(write, "path string, bytes long, records long"), "archives")


def read_archives(spark: SparkSession, archives: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """The records of archives given by (path, bytes), each archive read by ranges in separate tasks."""
    begins = F.sequence(F.lit(0).cast("long"), F.greatest(F.col("bytes") - 1, F.lit(0)), F.lit(range_bytes).cast("long"))
    ranges = archives.select("path", "bytes", F.explode(begins).alias("begin"))
    # a given number of partitions, as the size of this table says nothing about the work in its rows
    ranges = ranges.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "path", "begin")
    names = [x.split()[0] for x in RECORD_SCHEMA.split(", ")]

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def frame(rows: list[dict]) -> pd.DataFrame:
            out = pd.DataFrame(rows, columns=names)
            return out.astype({"page_id": "Int64", "refers_to": "Int64", "payload_bytes": "Int64"})

        for batch in batches:
            for path, size, begin in zip(batch["path"], batch["bytes"], batch["begin"]):
                rows: list[dict] = []
                held = 0
                for row in records_in_range(path, int(begin), min(int(begin) + range_bytes, int(size))):
                    rows.append(row)
                    held += row["payload_bytes"] or 0
                    if held > 4 * STEP or len(rows) >= 4096:
                        yield frame(rows)
                        rows, held = [], 0
                if rows:
                    yield frame(rows)

    return ranges.mapInPandas(read, RECORD_SCHEMA)
