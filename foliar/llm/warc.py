"""WARC archives of pages: monolithic gzip files, and their normal form with one member per record.

``write_archives`` writes WARC 1.1 records into files that are each one gzip
stream, as some crawlers leave them. ``normalise`` inflates every such stream
once, front to back, writes each record as a gzip member of its own and a
sidecar index of offsets beside the file. ``read_records`` reads records back by
that index, one member each, and checks length and digest.

Of records with equal payloads of at least MIN_REVISIT_BYTES the one with the
largest id is the response, the others are revisits that name it and carry no
payload; smaller payloads are all responses. Files are written below a folder
all executors share, under a name for each partition and roll, first as a file
of the attempt and then renamed, so lost or repeated tasks leave whole files.

A missing page has an empty payload. Rows that repeat an id and payload are one
page seen twice: all copies are written, and revisits name the id. An empty
table gives no files and no rows.
"""

from __future__ import annotations

import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliar.llm._jobs import narrow, stored
from foliar.session import scratch_path

MIN_REVISIT_BYTES = 1000
ROLL_BYTES = 32 << 20  # of records before compression
LEVEL = 3
_CHUNK = 1 << 20


def _record(kind: str, page_id, url: str, payload: bytes, digest: str, size: int, refers_to) -> bytes:
    uri = f"urn:page:{'' if page_id is None else page_id}"
    head = [
        b"WARC/1.1",
        b"WARC-Type: " + kind.encode(),
        f"WARC-Record-ID: <{uri}>".encode(),
        b"WARC-Date: 2020-01-01T00:00:00Z",
        b"WARC-Target-URI: " + " ".join((url or "").split()).encode(),
        f"WARC-Payload-Digest: sha1:{digest}".encode(),
        f"X-Payload-Length: {size}".encode(),
        b"Content-Type: text/html; charset=utf-8",
        f"Content-Length: {len(payload)}".encode(),
    ]
    if kind == "revisit":
        head.insert(4, f"WARC-Refers-To: <urn:page:{refers_to}>".encode())
        head.insert(4, b"WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    return b"\r\n".join(head) + b"\r\n\r\n" + payload + b"\r\n\r\n"


class _Output:
    """A file that appears under its name only when it is whole."""

    def __init__(self, folder: str, name: str):
        self.files, root = fs.FileSystem.from_uri(folder)
        self.files.create_dir(root, recursive=True)
        self.path, self.name = f"{root}/{name}", name
        self.draft = f"{root}/_{uuid.uuid4().hex}-{name}"
        self.stream = self.files.open_output_stream(self.draft, compression=None)
        self.size = 0

    def write(self, data: bytes) -> None:
        self.stream.write(data)
        self.size += len(data)

    def close(self) -> None:
        self.stream.close()
        self.files.move(self.draft, self.path)


def _write(folder: str, level: int, roll: int):
    def run(batches):
        from pyspark import TaskContext

        part, turn, out, gz, seen, count = TaskContext.get().partitionId(), 0, None, None, 0, 0
        for batch in batches:
            for i in range(batch.num_rows):
                page_id, url, payload, digest, size, kind, refers_to = (batch.column(k)[i].as_py() for k in range(7))
                if out is None:
                    out, gz, seen, count = _Output(folder, f"pages-{part:06d}-{turn:04d}.warc.gz"), zlib.compressobj(level, zlib.DEFLATED, 31), 0, 0
                record = _record(kind, page_id, url, payload if kind == "response" else b"", digest, size, refers_to)
                out.write(gz.compress(record))
                seen, count = seen + len(record), count + 1
                if seen >= roll:
                    out.write(gz.flush())
                    out.close()
                    yield pa.RecordBatch.from_pylist([{"file": out.name, "records": count}])
                    out, turn = None, turn + 1
        if out is not None:
            out.write(gz.flush())
            out.close()
            yield pa.RecordBatch.from_pylist([{"file": out.name, "records": count}])

    return run


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", level: int = LEVEL, roll: int = ROLL_BYTES) -> DataFrame:
    """Write pages into monolithic archives; returns the manifest (file, records) of what was written."""
    rows = narrow(pages, page_id=id_col, url=url_col, html=html_col)
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    facts = rows.select("page_id", "url", payload.alias("payload")).withColumns({"digest": F.sha1("payload"), "size": F.length("payload").cast("long")})
    # Payload classes on narrow rows; the largest id of a class is its response.
    first = stored(facts.where(F.col("size") >= MIN_REVISIT_BYTES).groupBy("digest").agg(F.max("page_id").alias("response"), F.count("*").alias("n")).where("n > 1").select("digest", "response"), "payloads")
    copies = stored(
        facts.where(F.col("size") >= MIN_REVISIT_BYTES).select("page_id", "digest").join(first, "digest").where("page_id <> response").select("page_id", "digest", "response").distinct(),
        "copies",
    )
    ready = facts.join(copies, ["page_id", "digest"], "left").select(
        "page_id", "url", F.when(F.col("response").isNull(), F.col("payload")).otherwise(F.lit(b"")).alias("payload"), "digest", "size",
        F.when(F.col("response").isNull(), "response").otherwise("revisit").alias("kind"), "response",
    )
    return stored(ready.mapInArrow(_write(folder, level, roll), "file string, records long"), "manifest")


def _inflated(stream) -> Iterator[bytes]:
    """Bytes of a gzip file of one or more members, in pieces."""
    inflate = zlib.decompressobj(31)
    while data := stream.read(_CHUNK):
        while data:
            yield inflate.decompress(data)
            data = inflate.unused_data
            if inflate.eof:
                inflate = zlib.decompressobj(31)
    if tail := inflate.flush():
        yield tail


def split_records(pieces: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes, bytes]]:
    """Header fields (names in lower case), payload and whole bytes of each record of an inflated stream."""
    data = bytearray()

    def fill(test) -> bool:
        while not test():
            piece = next(pieces, None)
            if piece is None:
                return False
            data.extend(piece)
        return True

    while True:
        if not fill(lambda: data.find(b"\r\n\r\n") >= 0):
            if data.strip():
                raise ValueError("archive ends within a record")
            return
        end = data.find(b"\r\n\r\n") + 4
        lines = bytes(data[:end]).decode("utf-8", "replace").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record starts with {lines[0][:40]!r}")
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:] if x)}
        whole = end + int(fields["content-length"]) + 4
        if not fill(lambda: len(data) >= whole):
            raise ValueError("archive ends within a record")
        yield fields, bytes(data[end : whole - 4]), bytes(data[:whole])
        del data[:whole]


def _normalise(source: str, target: str, level: int):
    def run(batches):
        for batch in batches:
            for name in batch.column(0).to_pylist():
                files, root = fs.FileSystem.from_uri(source)
                out, index, rows = _Output(target, name), _Output(target, name + ".index"), 0
                with files.open_input_stream(f"{root}/{name}", compression=None) as stream:
                    for fields, _, whole in split_records(_inflated(stream)):
                        gz = zlib.compressobj(level, zlib.DEFLATED, 31)
                        member = gz.compress(whole) + gz.flush()
                        line = {"offset": out.size, "length": len(member), "record": fields["warc-record-id"], "type": fields["warc-type"]}
                        index.write(json.dumps(line).encode() + b"\n")
                        out.write(member)
                        rows += 1
                out.close()
                index.close()
                yield pa.RecordBatch.from_pylist([{"file": name, "records": rows}])

    return run


def _spread(files: DataFrame) -> DataFrame:
    """About one task per file; a number of tasks that is given is not merged for the few bytes of the names."""
    return files.repartition(max(1, files.count()), "file")


def normalise(manifest: DataFrame, source: str, target: str, level: int = LEVEL) -> DataFrame:
    """Rewrite the archives of a manifest with one gzip member per record and a sidecar index; returns the new manifest."""
    done = _spread(manifest.select("file")).mapInArrow(_normalise(source, target, level), "file string, records long")
    return stored(done, "normalised")


def _read(folder: str):
    def run(batches):
        for batch in batches:
            for name in batch.column(0).to_pylist():
                files, root = fs.FileSystem.from_uri(folder)
                rows: list[dict] = []
                with files.open_input_stream(f"{root}/{name}.index", compression=None) as lines, files.open_input_file(f"{root}/{name}") as archive:
                    left = b""
                    while piece := lines.read(_CHUNK):
                        *full, left = (left + piece).split(b"\n")
                        for line in full:
                            at = json.loads(line)
                            archive.seek(at["offset"])
                            rows.append(_row(zlib.decompress(archive.read(at["length"]), 31)))
                            if len(rows) >= 500:
                                yield pa.RecordBatch.from_pylist(rows, schema=_READ)
                                rows = []
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=_READ)

    return run


def _row(record: bytes) -> dict:
    ((fields, payload, _),) = split_records(iter([record]))
    kind, digest = fields["warc-type"], fields["warc-payload-digest"].removeprefix("sha1:")
    if kind == "response" and (hashlib.sha1(payload).hexdigest() != digest or len(payload) != int(fields["x-payload-length"])):
        raise ValueError(f"payload of {fields['warc-record-id']} is damaged")
    page = lambda x: x[len("<urn:page:") : -1] or None if x else None
    return {
        "page_id": page(fields["warc-record-id"]), "url": fields["warc-target-uri"], "payload": payload, "payload_bytes": int(fields["x-payload-length"]),
        "payload_digest": digest, "record_type": kind, "refers_to": page(fields.get("warc-refers-to")),
    }


_READ = pa.schema([("page_id", pa.string()), ("url", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.string())])


def read_records(manifest: DataFrame, folder: str) -> DataFrame:
    """Records of normalised archives by their index: (page_id, url, payload, payload_bytes, payload_digest, record_type, refers_to)."""
    return _spread(manifest.select("file")).mapInArrow(
        _read(folder), "page_id string, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to string"
    )


def qualified(spark: SparkSession, path: str) -> str:
    """The path with the file system Spark resolves it to, so executors write where Spark does."""
    jvm = spark.sparkContext._jvm
    given = jvm.org.apache.hadoop.fs.Path(path)
    full = given.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(given).toString()
    return "file://" + full.removeprefix("file:") if full.startswith("file:/") and not full.startswith("file://") else full


def round_trip(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Write pages as monolithic archives below the shared folder, normalise them and read them back."""
    raw, whole = (qualified(spark, scratch_path(spark, label)) for label in ("warc-monolithic", "warc"))
    return read_records(normalise(write_archives(pages, raw), raw, whole), whole)
