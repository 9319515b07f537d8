"""WARC archives: write with an index first, then read selected records by coalesced byte ranges.

Writing appends one gzip member per record to an archive of the task, begins a new archive when one is full, and emits
one index row per record: file, offset, length, URL and digest.  Reading starts from the index: the rows that a query
selects are dealt in stretches of bytes over enough tasks, sorted by file and offset, neighbouring ranges are merged
while the gap between them is small, and each merged range is one read.

Equal payloads of at least ``REVISIT_BYTES`` are stored once.  Only digests and ids are shuffled to find them; groups
with one member drop out before anything is joined, so the payloads themselves move only when many pages repeat (Spark
broadcasts the table of groups where its written size is small, and joins by sorting otherwise).

Archives lie in the shared folder.  A task writes to a name of its own, so a task that runs twice cannot mix two
attempts: the index, which is written as a table, names the files of the attempts that counted.

Defined results: a null payload is empty; a null url or id is left out of the record's header and reads back as null;
rows that repeat one page are all response; among equal payloads null ids are the smallest; an empty table gives an
empty result; extra input columns are not archived.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.storage import bounded_batches, materialize, open_fs, scratch_path

REVISIT_BYTES = 1000
#: Reads are merged across gaps of this many bytes, up to this many bytes a read.
GAP_BYTES, READ_BYTES = 64 << 10, 8 << 20
#: A full archive, and the stored bytes that one task reads.
ARCHIVE_BYTES, TASK_BYTES = 1 << 30, 128 << 20
INDEX = "file string, offset long, length long, url string, digest string, record_type string"


def record(record_id: str, page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC/1.1 record; a revisit has no payload but tells the size and digest of the full one."""
    body = b"" if revisit else payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:uuid:{record_id}>", "WARC-Date: 1970-01-01T00:00:00Z"]
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if url is not None:
        head.append("WARC-Target-URI: " + quote(url, safe=":/?#[]@!$&'()*+,;=-._~%"))
        head.append("X-Target-Escaped: " + quote(url, safe=""))
    head.append("WARC-Payload-Digest: sha1:" + base64.b32encode(bytes.fromhex(digest)).decode())
    head.append(f"X-Payload-Length: {len(payload)}")
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"X-Refers-To-Page-ID: {refers_to}"]
    head += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(body)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and block of one record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    length = int(fields["Content-Length"])
    if not lines[0].startswith("WARC/") or rest[length:] != b"\r\n\r\n":
        raise ValueError("not one whole WARC record")
    return fields, rest[:length]


def _writer(folder: str, archive_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = open_fs(folder)
        out, offset, name, n = None, 0, "", 0
        try:
            for batch in batches:
                rows = {k: [] for k in ("file", "offset", "length", "url", "digest", "record_type")}
                columns = (batch.column(n).to_pylist() for n in ("page_id", "url", "payload", "digest", "refers_to", "revisit"))
                for page_id, url, payload, digest, refers_to, revisit in zip(*columns):
                    if out is not None and offset >= archive_bytes:
                        out.close()
                        out = None
                    if out is None:
                        store.create_dir(base, recursive=True)
                        of, offset, n = uuid.uuid4(), 0, 0
                        name = f"{of.hex}.warc.gz"
                        out = store.open_output_stream(f"{base}/{name}", compression=None)
                    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
                    member = packer.compress(record(str(uuid.uuid5(of, str(n))), page_id, url, payload, digest, refers_to, revisit)) + packer.flush()
                    out.write(member)
                    for k, v in zip(rows, (f"{folder}/{name}", offset, len(member), url, digest, "revisit" if revisit else "response")):
                        rows[k].append(v)
                    offset, n = offset + len(member), n + 1
                yield pa.RecordBatch.from_pydict(rows, schema=pa.schema([("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("url", pa.string()), ("digest", pa.string()), ("record_type", pa.string())]))
        finally:
            if out is not None:
                out.close()

    return run


def write_archives(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", folder: str | None = None, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write one record per row; returns the index, a written table with one row per record."""
    spark = pages.sparkSession
    bounded_batches(spark, rows=500)
    folder = folder or scratch_path(spark, "warc")
    payload = F.coalesce(F.col(f"`{payload_col}`").cast("binary"), F.lit(b""))
    rows = pages.select(F.col(f"`{id_col}`").cast("long").alias("page_id"), F.col(f"`{url_col}`").alias("url"), payload.alias("payload")).withColumn("digest", F.sha1("payload"))
    large = rows.where(F.length("payload") >= REVISIT_BYTES).groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.max("page_id").alias("last")).where("n > 1 AND last IS NOT NULL")
    repeated = materialize(large.select("digest", "last"), "repeated")
    joined = rows.join(repeated, "digest", "left").withColumn("revisit", F.col("last").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("last")))
    written = joined.select("page_id", "url", "payload", "digest", F.when(F.col("revisit"), F.col("last")).alias("refers_to"), "revisit")
    return materialize(written.mapInArrow(_writer(folder, archive_bytes), INDEX), "warc-index")


def ranges(rows: list[tuple[str, int, int]]) -> Iterator[tuple[str, int, int, list[tuple[int, int]]]]:
    """Merged reads (file, offset, length, members) of records sorted by file and offset."""
    held: list[tuple[int, int]] = []
    file, begin, end = "", 0, 0
    for name, offset, length in rows:
        if held and (name != file or offset - end > GAP_BYTES or offset + length - begin > READ_BYTES):
            yield file, begin, end - begin, held
            held = []
        if not held:
            file, begin, end = name, offset, offset
        held.append((offset - begin, length))
        end = max(end, offset + length)
    if held:
        yield file, begin, end - begin, held


READ = "page_id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long"


def _reader(with_payload: bool):
    def whole(text: str | None) -> int | None:
        return None if text is None else int(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = list(zip(*(batch.column(n).to_pylist() for n in ("file", "offset", "length"))))
            opened, source = "", None
            for file, begin, length, members in ranges(rows):
                if file != opened:
                    if source is not None:
                        source.close()
                    store, path = open_fs(file)
                    source, opened = store.open_input_file(path), file
                block = source.read_at(length, begin)
                out = {k: [] for k in ("page_id", "url", "payload", "payload_bytes", "payload_digest", "record_type", "refers_to")}
                for at, size in members:
                    fields, body = parse(zlib.decompress(block[at : at + size], 31))
                    kind = fields["WARC-Type"]
                    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
                    if kind == "response" and (hashlib.sha1(body).hexdigest() != digest or len(body) != int(fields["X-Payload-Length"])):
                        raise ValueError(f"payload of {fields['WARC-Record-ID']} does not match its digest")
                    url = fields.get("X-Target-Escaped")
                    values = (whole(fields.get("X-Page-ID")), None if url is None else unquote(url), body if with_payload else None, int(fields["X-Payload-Length"]), digest, kind, whole(fields.get("X-Refers-To-Page-ID")))
                    for k, v in zip(out, values):
                        out[k].append(v)
                yield pa.RecordBatch.from_pydict(out, schema=pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())]))
            if source is not None:
                source.close()

    return run


def read_records(index: DataFrame, with_payload: bool = True) -> DataFrame:
    """The records that ``index`` rows select; every response is checked against its digest.

    A stretch of an archive holds ``READ_BYTES`` at most beside its last record, so dealing stretches evens out bytes.
    """
    spark = index.sparkSession
    bounded_batches(spark, rows=5_000)
    total = index.agg(F.sum("length")).first()[0] or 0
    tasks = max(spark.sparkContext.defaultParallelism, -(-total // TASK_BYTES))
    dealt = index.select("file", "offset", "length").repartition(tasks, "file", F.floor(F.col("offset") / READ_BYTES)).sortWithinPartitions("file", "offset")
    return dealt.mapInArrow(_reader(with_payload), READ)
