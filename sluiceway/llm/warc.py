"""WARC archives: a deterministic sharded writer, and a reader that checks what it reads."""

from __future__ import annotations

import gzip
import hashlib
import json
import uuid
from collections.abc import Iterator
from io import BytesIO
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import saved

#: A shard is a range of so many ids; its files are rolled at so many compressed bytes.
SHARD_IDS = 1024
ROLL_BYTES = 32 << 20
#: Payloads of fewer bytes are never written as revisits.
LEAST_REVISIT = 100
DATE = "2000-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_NO_ID = -(1 << 63)


def _record(kind: str, name: str, headers: list[tuple[str, str]], content_type: str, block: bytes, date: str) -> bytes:
    """One WARC record as a gzip member; equal arguments give equal bytes."""
    lines = [("WARC-Type", kind), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>"), ("WARC-Date", date), *headers]
    lines += [("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"), ("Content-Type", content_type), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines) + "\r\n"
    return gzip.compress(head.encode() + block + b"\r\n\r\n", 6, mtime=0)


class _Output:
    """Files that get their names when they are whole."""

    def __init__(self, folder: str) -> None:
        from pyarrow import fs

        if "://" not in folder:
            folder = "file://" + folder.removeprefix("file:")
        self._fs, self._folder = fs.FileSystem.from_uri(folder)
        self._fs.create_dir(self._folder, recursive=True)

    def begin(self):
        self._temporary = f"{self._folder}/.{uuid.uuid4().hex}.tmp"
        return self._fs.open_output_stream(self._temporary)

    def commit(self, name: str) -> None:
        from pyarrow import fs

        final = f"{self._folder}/{name}"
        # Another attempt of the task has written the same bytes.
        if self._fs.get_file_info(final).type == fs.FileType.NotFound:
            self._fs.move(self._temporary, final)
        else:
            self._fs.delete_file(self._temporary)


class _Shard:
    """The open file of a shard, and what its manifest will say."""

    def __init__(self, output: _Output, number: int, roll: int, date: str) -> None:
        self._output, self._number, self._roll, self._date = output, number, roll, date
        self._stream, self.files = None, []

    def _open(self) -> None:
        self._name = f"{'n' if self._number < 0 else 'p'}{abs(self._number):016d}-{len(self.files):05d}.warc.gz"
        self._stream, self._sum, self._bytes, self._records = self._output.begin(), hashlib.sha256(), 0, 0
        self._put(_record("warcinfo", self._name, [("WARC-Filename", self._name)], "application/warc-fields", b"format: WARC File Format 1.1\r\n", self._date))

    def _put(self, member: bytes) -> None:
        self._stream.write(member)
        self._sum.update(member)
        self._bytes += len(member)

    def write(self, member: bytes) -> None:
        if self._stream is not None and self._bytes + len(member) > self._roll and self._records:
            self._end()
        if self._stream is None:
            self._open()
        self._put(member)
        self._records += 1

    def _end(self) -> None:
        self._stream.close()
        self._output.commit(self._name)
        self.files.append({"file": self._name, "bytes": self._bytes, "records": self._records, "sha256": self._sum.hexdigest()})
        self._stream = None

    def close(self) -> None:
        if self._stream is not None:
            self._end()
        stream = self._output.begin()
        stream.write("".join(json.dumps(f) + "\n" for f in self.files).encode())
        stream.close()
        self._output.commit(f"{self.files[0]['file'][:17]}.manifest.json")


def _safe(url: str | None, key: int) -> str:
    """The address as printable ASCII; a page without one is named by its id."""
    return quote(url, safe="".join(map(chr, range(33, 127)))) if url else f"urn:page:{key}"


def write_warc(
    pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
    shard_ids: int = SHARD_IDS, roll_bytes: int = ROLL_BYTES, date: str = DATE,
) -> DataFrame:
    """Write a record for each row of ``pages`` and return (shard, files, records, bytes) of each shard.

    Shards are ranges of ids, and records are sorted by id, so files are equal to the byte however the input
    is partitioned. Of equal payloads of at least LEAST_REVISIT bytes the one with the smallest id is a response,
    the others are revisits of it; of rows that repeat an id and payload one is the response. A file gets its
    name, and a shard its manifest, when it is complete, so a task that is run again does no harm. Null html
    is an empty payload, a null url is replaced by a name, a null id counts as the smallest. Other columns are
    ignored. ``folder`` is a URI that pyarrow can write; all executors must reach it.
    """
    _Output(folder)  # the folder is there even for an empty table
    payload = F.coalesce(F.col(html_col).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.coalesce(F.col(id_col).cast("long"), F.lit(_NO_ID)).alias("key"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    digests = rows.where(F.octet_length("payload") >= LEAST_REVISIT).select("key", F.sha2("payload", 256).alias("digest"))
    digests = saved(digests, "digests")
    first = digests.groupBy("digest").agg(F.min("key").alias("first"), F.count("*").alias("n")).where("n > 1").select("digest", "first")
    known = digests.join(saved(first, "first"), "digest").distinct()
    shard = F.floor(F.col("key") / F.lit(shard_ids)).cast("long").alias("shard")
    # What is known of a page goes just before it in one shuffle; a join would move the payloads twice.
    notes = known.select(shard, "key", F.lit(0).alias("kind"), "digest", "first", F.lit(None).cast("string").alias("url"), F.lit(None).cast("binary").alias("payload"))
    whole = rows.select(shard, "key", F.lit(1).alias("kind"), F.lit(None).cast("string").alias("digest"), F.lit(None).cast("long").alias("first"), "url", "payload")
    ordered = notes.unionByName(whole).repartitionByRange("shard").sortWithinPartitions("shard", "key", "kind", "digest", "url", "payload")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        output, shard, number = _Output(folder), None, None
        key, notes, nth = None, {}, 0

        def closed() -> pa.RecordBatch:
            shard.close()
            sums = [sum(f[k] for f in shard.files) for k in ("records", "bytes")]
            return pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in (number, len(shard.files), *sums)], ["shard", "files", "records", "bytes"])

        for batch in batches:
            columns = [batch.column(c) for c in ("shard", "key", "kind", "digest", "first", "url", "payload")]
            for i in range(batch.num_rows):
                of_shard, this, kind, digest, source, url, body = (c[i].as_py() for c in columns)
                if shard is None or of_shard != number:
                    if shard is not None:
                        yield closed()
                    shard, number = _Shard(output, of_shard, roll_bytes, date), of_shard
                if this != key:
                    key, notes, nth = this, {}, 0
                if kind == 0:
                    notes[digest] = source
                    continue
                digest = hashlib.sha256(body).hexdigest()
                source = notes.get(digest)
                headers = [("WARC-Target-URI", _safe(url, this)), ("WARC-Payload-Digest", f"sha256:{digest}"), ("X-Page-ID", "" if this == _NO_ID else str(this))]
                http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(body)}\r\n\r\n".encode()
                name = f"{this}/{nth}/{digest}"
                nth += 1
                if source is not None and source != this:
                    about = [("WARC-Profile", _PROFILE), ("WARC-Refers-To", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{source}/{digest}')}>"), ("X-Refers-To-Page", "" if source == _NO_ID else str(source))]
                    shard.write(_record("revisit", name, headers + about, "application/http; msgtype=response", http, date))
                    continue
                if source == this:
                    # The response; further rows with this id and payload revisit it.
                    name = f"{this}/{digest}"
                    if ("seen", digest) in notes:
                        about = [("WARC-Profile", _PROFILE), ("WARC-Refers-To", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>"), ("X-Refers-To-Page", headers[-1][1])]
                        shard.write(_record("revisit", f"{name}/{nth}", headers + about, "application/http; msgtype=response", http, date))
                        continue
                    notes["seen", digest] = True
                shard.write(_record("response", name, headers, "application/http; msgtype=response", http + body, date))
        if shard is not None:
            yield closed()

    return saved(ordered.mapInArrow(run, "shard long, files long, records long, bytes long"), "manifest")


def _headers(stream) -> dict[str, str]:
    out = {}
    while (line := stream.readline().rstrip(b"\r\n")):
        name, _, value = line.partition(b":")
        out[name.strip().lower().decode()] = value.strip().decode()
    return out


def records_of(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of a compressed archive; a digest that does not fit raises."""
    with gzip.GzipFile(fileobj=BytesIO(content)) as stream:
        while (version := stream.readline()):
            if version != b"WARC/1.1\r\n":
                raise ValueError(f"not a WARC record: {version[:40]!r}")
            headers = _headers(stream)
            block = stream.read(int(headers["content-length"]))
            stream.read(4)
            if f"sha256:{hashlib.sha256(block).hexdigest()}" != headers["warc-block-digest"]:
                raise ValueError(f"damaged record {headers['warc-record-id']}")
            yield headers, block


def read_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Every page record of the files that the manifests in ``folder`` list, with what was checked on the way.

    Returns page_id, url, payload_bytes, payload_digest, record_type, refers_to and payload (null for revisits).
    Files that no manifest lists are left out; a listed file that is missing or of another length raises, as
    does a record with a wrong digest.
    """
    listed = spark.read.schema("file string, bytes long, records long, sha256 string").option("pathGlobFilter", "*.manifest.json").json(folder)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(folder)
    files = files.select(F.element_at(F.split("path", "/"), -1).alias("file"), "length", "content")
    # Reads names and lengths only.
    lost = listed.join(files.select("file", F.col("length").alias("bytes")), ["file", "bytes"], "left_anti").select("file").first()
    if lost:
        raise ValueError(f"{lost[0]} is missing or not as its manifest says")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
        for batch in batches:
            for content in batch.column("content"):
                rows, held = [], 0
                for headers, block in records_of(content.as_py()):
                    kind = headers["warc-type"]
                    if kind == "warcinfo":
                        continue
                    stream = BytesIO(block)
                    stream.readline()
                    http, body = _headers(stream), stream.read()
                    digest = headers["warc-payload-digest"].removeprefix("sha256:")
                    if kind == "response" and hashlib.sha256(body).hexdigest() != digest:
                        raise ValueError(f"damaged payload {headers['warc-record-id']}")
                    number = lambda name: int(headers[name]) if headers.get(name) else None
                    rows.append((number("x-page-id"), headers["warc-target-uri"], int(http["content-length"]), digest, kind, number("x-refers-to-page"), body if kind == "response" else None))
                    held += len(body)
                    if held > 4 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    return files.join(listed.select("file"), "file", "left_semi").select("content").mapInArrow(
        run, "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"
    )
