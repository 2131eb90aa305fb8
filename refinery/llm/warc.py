"""WARC archives through a chunked record table.

A record's payload travels as rows of (record, chunk number, chunk), so neither
writer nor reader ever holds a whole record: the writer feeds chunks into one
gzip member per record, the reader turns the stream back into chunk rows that
carry the byte count and the SHA-256 of the payload so far.  Each task writes
its own files under a fresh name in the shared checkpoint folder; only files
named in the manifest of successful tasks are read, so a lost executor leaves
at most files that nobody reads.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from refinery.llm.common import written
from refinery.session import scratch_dir
from refinery.sources.files import open_path

CHUNK = 1 << 20
#: an archive is closed after the record that takes it over this size
ARCHIVE_BYTES = 256 << 20
LEAST_REVISIT = 100
URN = "urn:refinery:record:"


def plan(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
         least: int = LEAST_REVISIT) -> DataFrame:
    """``id``, ``url``, ``payload``, ``payload_bytes``, ``digest``, ``record_type``, ``refers_to`` of every row.

    Of equal payloads of at least ``least`` bytes those under the smallest id are responses, the others
    revisit it; smaller ones are all responses.  A null payload is empty; a null id is larger than any
    other, and where all ids are null all are responses; repeated rows give one record each.
    """
    rows = (pages.select(F.col(id_col).alias("id"), F.coalesce(F.col(url_col), F.lit("")).alias("url"),
                         F.coalesce(F.col(payload_col), F.lit("")).cast("binary").alias("payload"))
            .withColumn("payload_bytes", F.octet_length("payload").cast("long"))
            .withColumn("digest", F.sha2("payload", 256)))
    firsts = written(rows.where(F.col("payload_bytes") >= least).groupBy("digest")
                     .agg(F.min("id").alias("first"), F.count("*").alias("n"))
                     .where("n > 1").select("digest", "first"), "warc-firsts")
    again = F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("id"))
    return rows.join(firsts, "digest", "left").select(
        "id", "url", "payload", "payload_bytes", "digest",
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.when(again, F.col("first")).alias("refers_to"))


def chunk_table(records: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """One row per chunk, in order, rows of a record together; a revisit or an empty payload has one empty chunk."""
    body = F.when(F.col("record_type") == "response", F.col("payload")).otherwise(F.lit(b""))
    last = F.greatest(F.ceil(F.octet_length("body") / chunk) - 1, F.lit(0)).cast("int")
    return (records.withColumn("body", body)
            .select("id", "url", "payload_bytes", "digest", "record_type", "refers_to", "body",
                    F.explode(F.sequence(F.lit(0), last)).alias("chunk_no"), last.alias("last_no"))
            .select(F.col("id").cast("string").alias("id"), "url", "payload_bytes", "digest", "record_type",
                    F.col("refers_to").cast("string").alias("refers_to"), "chunk_no",
                    (F.col("chunk_no") == F.col("last_no")).alias("last"),
                    F.substring("body", F.col("chunk_no") * chunk + 1, F.lit(chunk)).alias("chunk")))


def _head(row: dict) -> bytes:
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['payload_bytes']}\r\n\r\n")
    body = row["payload_bytes"] if row["record_type"] == "response" else 0
    lines = ["WARC/1.1", f"WARC-Type: {row['record_type']}", f"WARC-Record-ID: <{URN}{row['id']}>",
             "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Target-URI: {' '.join(row['url'].split())}",
             f"WARC-Payload-Digest: sha256:{row['digest']}", "Content-Type: application/http; msgtype=response",
             f"Content-Length: {len(http) + body}"]
    if row["refers_to"] is not None:
        lines += [f"WARC-Refers-To: <{URN}{row['refers_to']}>",
                  "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    return ("\r\n".join(lines) + "\r\n\r\n" + http).encode()


def write(records: DataFrame, archive_bytes: int = ARCHIVE_BYTES, chunk: int = CHUNK) -> DataFrame:
    """Write the records of :func:`plan`; returns the manifest, itself a written table.

    It names each archive by its path on its file system (``file``) and in full, with scheme and host (``uri``), and
    counts its ``records``.  Archives are ``.warc.gz`` with one gzip member per record.  An empty table gives an empty manifest.
    """
    root = scratch_dir(records.sparkSession, "warc")

    def run(batches):
        fs, folder = open_path(root)
        sink, name, records, size, pack = None, "", 0, 0, None
        for batch in batches:
            done = []
            for row in batch.to_pylist():
                if sink is None:
                    name, records, size = f"{folder}/{uuid.uuid4().hex}.warc.gz", 0, 0
                    sink = fs.open_output_stream(name, compression=None)
                if row["chunk_no"] == 0:
                    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
                    out = pack.compress(_head(row))
                else:
                    out = b""
                out += pack.compress(row["chunk"])
                if row["last"]:
                    out += pack.compress(b"\r\n\r\n") + pack.flush()
                    records += 1
                sink.write(out)
                size += len(out)
                if row["last"] and size >= archive_bytes:
                    sink.close()
                    sink = None
                    done.append((name, records))
            yield pa.RecordBatch.from_pylist([{"file": f, "records": n} for f, n in done],
                                             pa.schema([("file", pa.string()), ("records", pa.int64())]))
        if sink is not None:
            sink.close()
            yield pa.RecordBatch.from_pylist([{"file": name, "records": records}],
                                             pa.schema([("file", pa.string()), ("records", pa.int64())]))

    made = chunk_table(records, chunk).mapInArrow(run, "file string, records bigint")
    uri = F.concat(F.lit(root + "/"), F.substring_index("file", "/", -1))
    return written(made.withColumn("uri", uri), "warc-manifest")


class _Inflated:
    """Reads a stream of gzip members as one byte stream, a bounded piece at a time."""

    def __init__(self, raw, step: int = 1 << 18):
        self.raw, self.step, self.held, self.gz, self.rest = raw, step, bytearray(), None, b""

    def _more(self) -> bool:
        if not self.rest:
            self.rest = self.raw.read(self.step)
            if not self.rest:
                return False
        if self.gz is None:
            self.gz = zlib.decompressobj(31)
        self.held += self.gz.decompress(self.rest, self.step)
        if self.gz.eof:
            self.rest, self.gz = self.gz.unused_data, None
        else:
            self.rest = self.gz.unconsumed_tail
        return True

    def until(self, mark: bytes) -> bytes | None:
        """Bytes up to and with ``mark``; None at the end of the stream."""
        at = 0
        while (found := self.held.find(mark, at)) < 0:
            at = max(0, len(self.held) - len(mark))
            if not self._more():
                if self.held.strip():
                    raise ValueError("archive ends inside a record")
                return None
        out = bytes(self.held[:found + len(mark)])
        del self.held[:found + len(mark)]
        return out

    def take(self, n: int) -> bytes:
        """At most ``n`` bytes, at least one unless the stream has ended."""
        while not self.held and self._more():
            pass
        out = bytes(self.held[:n])
        del self.held[:n]
        return out


def _records(stream: _Inflated, chunk: int, payload: bool):
    """Chunk rows of every record of one archive."""
    while (head := stream.until(b"\r\n\r\n")) is not None:
        fields = dict(x.split(": ", 1) for x in head.decode().strip().split("\r\n")[1:])
        http = stream.until(b"\r\n\r\n")
        told = dict(x.split(": ", 1) for x in http.decode().strip().split("\r\n")[1:])
        left, no, seen, digest = int(fields["Content-Length"]) - len(http), 0, 0, hashlib.sha256()
        row = {"record": fields["WARC-Record-ID"][1 + len(URN):-1], "record_type": fields["WARC-Type"],
               "refers_to": fields.get("WARC-Refers-To", "<" + URN + "None>")[1 + len(URN):-1],
               "told_digest": fields["WARC-Payload-Digest"].removeprefix("sha256:"),
               "told_bytes": int(told["Content-Length"])}
        while True:
            part, want = [], min(left, chunk)
            while want:
                got = stream.take(want)
                if not got:
                    raise ValueError("archive ends inside a payload")
                digest.update(got)
                want, left, seen = want - len(got), left - len(got), seen + len(got)
                if payload:
                    part.append(got)
            yield row | {"chunk_no": no, "last": not left, "chunk": b"".join(part), "bytes_so_far": seen,
                         "digest_so_far": digest.hexdigest()}
            no += 1
            if not left:
                break
        if row["record_type"] == "response" and (digest.hexdigest(), seen) != (row["told_digest"], row["told_bytes"]):
            raise ValueError(f"record {row['record']}: payload differs from its digest")
        if stream.until(b"\r\n\r\n") is None:
            raise ValueError("record without an end")


READ = pa.schema([("record", pa.string()), ("record_type", pa.string()), ("refers_to", pa.string()),
                  ("told_digest", pa.string()), ("told_bytes", pa.int64()), ("chunk_no", pa.int32()),
                  ("last", pa.bool_()), ("chunk", pa.binary()), ("bytes_so_far", pa.int64()),
                  ("digest_so_far", pa.string())])


def read(manifest: DataFrame, chunk: int = CHUNK, payload: bool = True) -> DataFrame:
    """The chunk table of the archives in a manifest, one task slot per archive.

    Every response is checked against its digest and length.  ``payload=False`` leaves ``chunk`` empty
    (digests and counts are still those of the bytes read).
    """
    files = manifest.select("uri")
    files = files.repartition(max(1, files.count()))

    def run(batches):
        for batch in batches:
            for f in batch.to_pylist():
                fs, path = open_path(f["uri"])
                held, size = [], 0
                with fs.open_input_stream(path, compression=None) as raw:
                    for row in _records(_Inflated(raw), chunk, payload):
                        held.append(row)
                        size += len(row["chunk"]) + 300
                        if size > 8 << 20:
                            yield pa.RecordBatch.from_pylist(held, READ)
                            held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, READ)

    return files.mapInArrow(run, "record string, record_type string, refers_to string, told_digest string, "
                                 "told_bytes bigint, chunk_no int, last boolean, chunk binary, bytes_so_far bigint, "
                                 "digest_so_far string")


def summaries(chunks: DataFrame, id_type: str = "bigint") -> DataFrame:
    """One row per record of a chunk table: id, length and digest of the full payload, type and referred id."""
    ident = lambda c: F.when(F.col(c) != "None", F.col(c)).cast(id_type)
    response = F.col("record_type") == "response"
    return chunks.where("last").select(
        ident("record").alias("id"),
        F.when(response, F.col("bytes_so_far")).otherwise(F.col("told_bytes")).alias("payload_bytes"),
        F.when(response, F.col("digest_so_far")).otherwise(F.col("told_digest")).alias("payload_digest"),
        "record_type", ident("refers_to").alias("refers_to"))
