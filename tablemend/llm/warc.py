"""WARC archives as chunked record tables.

Pages are written as WARC records into gzip archives, one per task, in a folder that all executors share. Reading
gives a table of chunks: (record, chunk number) rows of bounded size, each carrying the SHA-1 and the length of the
payload up to its end, so an oversized record never is one value and the last chunk has the digest of the whole.

Which record is a revisit is a join on the digest: of records with equal payloads of at least 1000 bytes the one with
the largest page_id is the response, and the others refer to it. Hot payloads are a skewed join side, which Spark
splits; the digest table is combined before its shuffle.

Defined cases: a NULL payload is empty; a NULL page_id is less than any other and, if all ids of a group are NULL, all
are responses; rows that share the largest page_id all are responses; NULL urls are left out of the header; an empty
table gives an empty archive index and no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablemend.llm.common import fresh_folder, stored

LEAST = 1000  # bytes of payload from which equal payloads are written once
CHUNK = 1 << 20
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_URN = "urn:page:"
_INDEX = pa.schema([("archive", pa.string()), ("records", pa.int64())])
_CHUNKS = pa.schema(
    [
        ("archive", pa.string()), ("record_id", pa.string()), ("record_type", pa.string()), ("refers_to", pa.string()), ("target_uri", pa.string()),
        ("declared_digest", pa.string()), ("chunk_no", pa.int64()), ("chunk", pa.binary()), ("bytes_so_far", pa.int64()), ("sha1_so_far", pa.string()), ("last", pa.bool_()),
    ]
)
CHUNK_COLUMNS = "archive string, record_id string, record_type string, refers_to string, target_uri string, declared_digest string, chunk_no long, chunk binary, bytes_so_far long, sha1_so_far string, last boolean"


def planned(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """page_id, url, payload, sha1 and response_id (the page it revisits, else NULL)."""
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"), payload.alias("payload"), F.sha1(payload).alias("sha1"))
    several = (
        rows.where(F.octet_length("payload") >= least)
        .groupBy(F.col("sha1").alias("same"))
        .agg(F.max("page_id").alias("most"), F.count("*").alias("n"))
        .where("n > 1")
        .select("same", "most")
    )
    met = rows.join(several, F.col("sha1") == F.col("same"), "left")
    revisits = F.col("most").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("most"))
    return met.select("page_id", "url", "payload", "sha1", F.when(revisits, F.col("most")).alias("response_id"))


def _open(folder: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system of a folder given as a URI or a plain path."""
    if folder.startswith("file:/") and not folder.startswith("file://"):
        folder = folder.removeprefix("file:")
    return pyarrow.fs.FileSystem.from_uri(folder)


def _head(fields: list[tuple[str, str]]) -> bytes:
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in fields)]
    return ("\r\n".join(lines) + "\r\n\r\n").encode()


def write_record(out: BinaryIO, page_id: int | None, url: str | None, payload: memoryview, response_id: int | None, sha1: str) -> None:
    """One record as a gzip member of its own; the payload passes in pieces."""
    packer = zlib.compressobj(4, zlib.DEFLATED, 31)
    body = memoryview(b"") if response_id is not None else payload
    fields = [("WARC-Type", "response" if response_id is None else "revisit"), ("WARC-Record-ID", f"<{_URN}{'' if page_id is None else page_id}>"), ("WARC-Date", DATE)]
    if url is not None:
        fields.append(("WARC-Target-URI", "".join(c if c > " " else f"%{ord(c):02X}" for c in url)))
    if response_id is not None:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<{_URN}{response_id}>")]
    fields += [("WARC-Payload-Digest", f"sha1:{sha1}"), ("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(len(body)))]
    out.write(packer.compress(_head(fields)))
    for at in range(0, len(body), CHUNK):
        out.write(packer.compress(body[at : at + CHUNK]))
    out.write(packer.compress(b"\r\n\r\n"))
    out.write(packer.flush())


def write_archives(records: DataFrame, folder: str) -> DataFrame:
    """Write one archive per task; the result lists the archives of the tasks that ended well (archive, records).

    A task that is run again writes a file of a new name, and only names in the stored result count.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = _open(folder)
        files.create_dir(base, recursive=True)
        name = f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.gz"
        n, out = 0, None
        try:
            for batch in batches:
                payloads = batch.column(2)
                for k, (page_id, url, sha1, response_id) in enumerate(zip(*(batch.column(c).to_pylist() for c in (0, 1, 3, 4)), strict=True)):
                    out = out or files.open_output_stream(f"{base}/{name}", compression=None)
                    write_record(out, page_id, url, memoryview(payloads[k].as_buffer()), response_id, sha1)
                    n += 1
        finally:
            if out:
                out.close()
        if n:
            yield pa.RecordBatch.from_pydict({"archive": [name], "records": [n]}, _INDEX)

    return stored(records.mapInArrow(write, "archive string, records long"), "warc-index")


class _Members:
    """Bytes of a gzip file of many members, in pieces of bounded size."""

    def __init__(self, raw: BinaryIO, size: int):
        self.raw, self.size, self.unpacker, self.packed, self.plain = raw, size, zlib.decompressobj(31), b"", b""

    def more(self) -> bool:
        """Unpack the next piece; false at the end."""
        while True:
            if self.unpacker.eof:
                self.packed, self.unpacker = self.unpacker.unused_data or self.packed, zlib.decompressobj(31)
            if not self.packed:
                self.packed = bytes(self.raw.read(1 << 18))
                if not self.packed:
                    return False
            piece = self.unpacker.decompress(self.packed, self.size)
            self.packed = b"" if self.unpacker.eof else self.unpacker.unconsumed_tail
            if piece:
                self.plain += piece
                return True

    def until(self, mark: bytes) -> bytes | None:
        """Up to and with a mark; None at the end of the file."""
        while (at := self.plain.find(mark)) < 0:
            if not self.more():
                if self.plain.strip():
                    raise ValueError("the archive ends within a record")
                return None
        found, self.plain = self.plain[: at + len(mark)], self.plain[at + len(mark) :]
        return found

    def take(self, n: int) -> bytes:
        """At most n bytes, at least one."""
        if not self.plain and not self.more():
            raise ValueError("the archive ends within a payload")
        found, self.plain = self.plain[:n], self.plain[n:]
        return found


def chunks_of(raw: BinaryIO, archive: str, size: int = CHUNK) -> Iterator[dict]:
    """The rows of one archive: chunks of at most `size` bytes with running length and digest."""
    source = _Members(raw, size)
    while (head := source.until(b"\r\n\r\n")) is not None:
        lines = head.decode().strip().split("\r\n")
        fields = dict(line.split(": ", 1) for line in lines[1:])
        row = {
            "archive": archive, "record_id": fields["WARC-Record-ID"].strip("<>"), "record_type": fields["WARC-Type"], "target_uri": fields.get("WARC-Target-URI"),
            "refers_to": fields["WARC-Refers-To"].strip("<>") if "WARC-Refers-To" in fields else None, "declared_digest": fields["WARC-Payload-Digest"].removeprefix("sha1:"),
        }
        left, done, number, digest, held = int(fields["Content-Length"]), 0, 0, hashlib.sha1(), b""
        while True:
            while left and len(held) < size:
                piece = source.take(min(left, size - len(held)))
                held += piece
                left -= len(piece)
            digest.update(held)
            done += len(held)
            yield row | {"chunk_no": number, "chunk": held, "bytes_so_far": done, "sha1_so_far": digest.hexdigest(), "last": not left}
            if not left:
                break
            number, held = number + 1, b""
        if source.until(b"\r\n\r\n") != b"\r\n\r\n":
            raise ValueError("a record has no end")


def read_chunks(index: DataFrame, folder: str, size: int = CHUNK) -> DataFrame:
    """The chunk table of the archives in an index: columns as in CHUNK_COLUMNS."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = _open(folder)
        for batch in batches:
            for archive in batch.column(0).to_pylist():
                rows, held = [], 0
                with files.open_input_stream(f"{base}/{archive}", compression=None) as raw:
                    for row in chunks_of(raw, archive, size):
                        rows.append(row)
                        held += len(row["chunk"]) + 300
                        if held >= 4 << 20:
                            yield pa.RecordBatch.from_pylist(rows, _CHUNKS)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, _CHUNKS)

    spread = index.select("archive").repartition(max(1, min(index.count(), 4096)), "archive")
    return spread.mapInArrow(read, CHUNK_COLUMNS)


def page_id_of(record_id):
    """The page of a record identifier; NULL for a page without an id."""
    number = F.substring(record_id, len(_URN) + 1, 40)
    return F.when(number != "", number.cast("long"))


def archived(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """Write all pages to archives and return their chunk table."""
    folder = fresh_folder(pages.sparkSession, "warc")
    return read_chunks(write_archives(planned(pages, least), folder), folder)


def page_records(chunks: DataFrame) -> DataFrame:
    """Per page, from the chunk table: page_id, payload_bytes, payload_digest, record_type, refers_to, target_uri.

    The last chunk of a response has both figures of the payload; a revisit takes them from its response. A revisit whose
    response is not in the table stops the job.
    """
    ends = stored(chunks.where("last").select("record_id", "record_type", "refers_to", "target_uri", "declared_digest", "bytes_so_far", "sha1_so_far", (F.col("chunk_no") + 1).alias("chunks")), "warc-ends")
    page = page_id_of(F.col("record_id"))
    responses = ends.where("record_type = 'response'")
    own = responses.select(
        page.alias("page_id"), F.col("bytes_so_far").alias("payload_bytes"), F.col("sha1_so_far").alias("payload_digest"), "record_type", F.lit(None).cast("long").alias("refers_to"), "target_uri", "chunks"
    )
    # A response may stand in several rows of equal payload: one figure per record is enough.
    figures = responses.groupBy(F.col("record_id").alias("target"), F.col("sha1_so_far").alias("payload_digest")).agg(F.max("bytes_so_far").alias("payload_bytes"))
    lost = F.raise_error(F.concat(F.lit("no response for "), F.col("record_id"))).cast("long")
    again = (
        ends.where("record_type = 'revisit'")
        .join(figures, (F.col("refers_to") == F.col("target")) & (F.col("declared_digest") == F.col("payload_digest")), "left")
        .select(page.alias("page_id"), F.when(F.col("target").isNull(), lost).otherwise(F.col("payload_bytes")).alias("payload_bytes"), F.col("declared_digest").alias("payload_digest"), "record_type", page_id_of(F.col("refers_to")).alias("refers_to"), "target_uri", F.lit(0).cast("long").alias("chunks"))
    )
    return own.unionByName(again)
