"""Deterministic sharded WARC writer and its reader."""

from __future__ import annotations

import hashlib
import io
import json
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm._shared import materialize, new_path

#: Payloads of fewer bytes are always written out.
REVISIT_BYTES = 100
#: Compressed bytes at which a file is closed, payload bytes of a shard, and ids from which shard borders are chosen: in all at least, and for each shard.
ROLL_BYTES, SHARD_BYTES, BORDER_IDS, IDS_PER_SHARD = 256 << 20, 1 << 30, 20_000, 20
#: All records carry one date, so that the same input gives the same bytes.
DATE = "2020-01-01T00:00:00Z"
#: Characters that stand in a URL as they are.
_URL = ":/?#[]@!$&()*+,;=%~"
#: Fixed value: the profile of a revisit with an identical payload.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def open_fs(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a URI, the same for local, HDFS and object-store folders."""
    return fs.FileSystem.from_uri(uri if "://" in uri else "file://" + uri.removeprefix("file:"))


def _digest(data: bytes) -> str:
    return "sha256:" + hashlib.sha256(data).hexdigest()


def record(page_id: int | None, url: str, payload: bytes | None, size: int, digest: str, refers_to: int | None) -> bytes:
    """One WARC/1.1 record: a response with its payload, or a revisit whose block is the HTTP header alone."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + (payload or b"") if refers_to is None else http
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:x-page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {quote(url, safe=_URL)}",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: {digest}",
        f"WARC-Block-Digest: {_digest(block)}",
    ]
    if quote(url, safe=_URL) != url:  # a URL that had to be escaped, as it was
        head.append(f"X-Page-URL: {json.dumps(url)}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:x-page:{refers_to}>", f"WARC-Profile: {PROFILE}"]
    return ("\r\n".join([*head, f"Content-Length: {len(block)}", "", ""])).encode() + block + b"\r\n\r\n"


class _Files:
    """The rolling files of one shard: written under a temporary name of this attempt, renamed when complete."""

    def __init__(self, top: str, shard: int, roll: int):
        self.fs, self.top = open_fs(top)
        self.shard, self.roll, self.seq, self.out, self.rows = shard, roll, 0, None, []
        context = TaskContext.get()
        self.attempt = context.taskAttemptId() if context else 0

    def add(self, data: bytes) -> None:
        z = zlib.compressobj(6, zlib.DEFLATED, 31)  # each record is a gzip member of its own
        packed = z.compress(data) + z.flush()
        if self.out is not None and self.size + len(packed) > self.roll:
            self.close()
        if self.out is None:
            self.name = f"shard-{self.shard:06d}-{self.seq:05d}.warc.gz"
            self.temp = f"{self.top}/_temporary/{self.name}.{self.attempt}"
            self.fs.create_dir(f"{self.top}/_temporary", recursive=True)
            self.out, self.size, self.records, self.sha = self.fs.open_output_stream(self.temp, compression=None), 0, 0, hashlib.sha256()
        self.out.write(packed)
        self.sha.update(packed)
        self.size += len(packed)
        self.records += 1

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.fs.move(self.temp, f"{self.top}/{self.name}")  # a repeated attempt replaces the file by an equal one
            self.rows.append((self.shard, self.name, self.records, self.size, self.sha.hexdigest()))
            self.out, self.seq = None, self.seq + 1


MANIFEST = "shard int, file string, records bigint, bytes bigint, sha256 string"


def _borders(pages: DataFrame, sizes: int, shard_bytes: int) -> list[int]:
    """Ids at which shards begin, from the ids with the least digests: the same ids for the same table, some for each shard (of a gigabyte, say)."""
    shards = max(1, -(-sizes // shard_bytes))
    if shards == 1:
        return []
    ids = pages.select("id").where("id is not null").distinct().orderBy(F.md5(F.col("id").cast("string")), "id").limit(max(BORDER_IDS, IDS_PER_SHARD * shards)).collect()
    ordered = sorted(r["id"] for r in ids)
    return sorted({ordered[len(ordered) * n // shards] for n in range(1, shards)}) if ordered else []


def write_warc(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", roll_bytes: int = ROLL_BYTES, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Write a record for each page below path and return the manifest (shard, file, records, bytes, sha256), as committed.

    Pages go to shards by id ranges and are sorted by id in each, so files depend on the table alone. A shard's file is closed when
    the next record would take it over roll_bytes compressed. Of equal payloads of REVISIT_BYTES or more the
    smallest id's record is the response and others revisit it. Files are renamed into place when complete; the manifest, written last by
    Spark's committer, is what makes them part of the archive, so what failed attempts leave is never read.

    A null payload is empty, a null url the empty string; a very long payload is one record. Of a URL that WARC must escape the record keeps the raw form, too. Null ids come first in their order and are responses unless the same payload has
    an id; rows that repeat an id and payload are a response and revisits of that id. An empty table gives an empty manifest; other columns, whatever their names, are not read."""
    spark = pages.sparkSession
    payload = F.encode(F.coalesce(html_col, F.lit("")), "UTF-8")
    rows = pages.select(F.col(id_col).cast("bigint").alias("id"), F.coalesce(url_col, F.lit("")).alias("url"), payload.alias("payload"))
    narrow = materialize(rows.select("id", F.unhex(F.sha2("payload", 256)).alias("digest"), F.octet_length("payload").cast("long").alias("size")), "payloads")
    firsts = narrow.where(F.col("size") >= REVISIT_BYTES).groupBy("digest").agg(F.min("id").alias("of"), F.count(F.lit(1)).alias("n")).where("n > 1")
    later = narrow.join(firsts, "digest").where("id is null or id != of or of is null").select("id", "digest", "of").distinct()
    twice = narrow.where(F.col("size") >= REVISIT_BYTES).groupBy("id", "digest").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("id", "digest", F.col("id").alias("of"))
    total = narrow.agg(F.sum("size")).first()[0] or 0
    borders = spark.sparkContext.broadcast(np.array(_borders(narrow, total, shard_bytes), np.int64))  # a number for each shard

    @F.pandas_udf("int")
    def shard_of(ids):  # noqa: ANN001, ANN202
        import pandas as pd

        known = ids.fillna(np.iinfo(np.int64).min).astype("int64").to_numpy()
        return pd.Series(np.searchsorted(borders.value, known, side="right").astype(np.int32))

    # what is decided about a page travels to its shard as a row of its own, ahead of the payload
    said = later.union(twice).groupBy("id", "digest").agg(F.min("of").alias("of"))
    said = said.select("id", F.lit(0).alias("kind"), F.lit(None).cast("string").alias("url"), F.col("digest").alias("payload"), "of")
    all_ = said.union(rows.select("id", F.lit(1).alias("kind"), "url", "payload", F.lit(None).cast("bigint").alias("of")))
    shards = len(borders.value) + 1
    dealt = all_.withColumn("shard", shard_of("id")).repartitionById(shards, "shard").sortWithinPartitions("shard", "id", "kind", "payload", "url")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, known, page = None, {}, object()
        rows_ = []
        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                shard, i, kind, url, data, of = row
                if files is None or files.shard != shard:
                    if files:
                        files.close()
                        rows_ += files.rows
                    files = _Files(path, shard, roll_bytes)
                if i != page:
                    page, known = i, {}
                if kind == 0:
                    known[data] = [of, 0]
                    continue
                digest = hashlib.sha256(data).digest()
                refers = None
                if digest in known:
                    of, times = known[digest]
                    known[digest][1] += 1
                    refers = of if of != i or times else None
                files.add(record(i, url, data, len(data), "sha256:" + digest.hex(), refers))
        if files:
            files.close()
            rows_ += files.rows
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows_, strict=True) if rows_ else [[]] * 5, (pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.string()), strict=True)], ["shard", "file", "records", "bytes", "sha256"])

    dealt.select("shard", "id", "kind", "url", "payload", "of").mapInArrow(run, MANIFEST).write.parquet(f"{path}/manifest")
    return spark.read.schema(MANIFEST).parquet(f"{path}/manifest")


def parse(stream: io.BufferedIOBase | pa.NativeFile, block: int = 1 << 20) -> Iterator[bytes]:
    """The records of a file, one gzip member at a time."""
    z, out, held = zlib.decompressobj(31), [], b""
    while True:
        data = held or stream.read(block)
        held = b""
        if not data:
            break
        out.append(z.decompress(data))
        if z.eof:
            yield b"".join(out)
            held, z, out = z.unused_data, zlib.decompressobj(31), []
    if any(out):
        raise ValueError("the file ends within a record")


def read_record(data: bytes) -> tuple:
    """page_id, url, record_type, payload_bytes, payload_digest, refers_to, payload of a record, its digests checked."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError(f"not a WARC record: {lines[0]!r}")
    fields = dict(x.split(": ", 1) for x in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    kind = fields["WARC-Type"]
    if _digest(block) != fields["WARC-Block-Digest"] or kind == "response" and (_digest(payload) != fields["WARC-Payload-Digest"] or len(payload) != size):
        raise ValueError(f"{fields['WARC-Record-ID']}: its digest does not match")
    number = lambda x: int(x[12:-1]) if x[12:-1] else None  # noqa: E731  <urn:x-page:7>
    return number(fields["WARC-Record-ID"]), json.loads(fields["X-Page-URL"]) if "X-Page-URL" in fields else fields["WARC-Target-URI"], kind, size, fields["WARC-Payload-Digest"].removeprefix("sha256:"), number(fields["WARC-Refers-To"]) if kind == "revisit" else None, payload if kind == "response" else None


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """The records of the files in the manifest: page_id, url, record_type, payload_bytes, payload_digest, refers_to, payload (null in a revisit)."""
    files = spark.read.schema(MANIFEST).parquet(f"{path}/manifest").select("file")
    n = max(1, min(10_000, files.count()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, top = open_fs(path)
        names = ["page_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to", "payload"]
        kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]
        for b in batches:
            for file in b.column(0).to_pylist():
                with store.open_input_stream(f"{top}/{file}", compression=None) as stream:
                    held, size = [], 0
                    for data in parse(stream):
                        held.append(read_record(data))
                        size += len(data)
                        if size > 8 << 20:
                            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*held, strict=True), kinds, strict=True)], names)
                            held, size = [], 0
                    if held:
                        yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*held, strict=True), kinds, strict=True)], names)

    return files.repartition(n, "file").mapInArrow(run, "page_id bigint, url string, record_type string, payload_bytes bigint, payload_digest string, refers_to bigint, payload binary")


def archive(pages: DataFrame, path: str | None = None, **options) -> DataFrame:
    """Write pages to a new folder of the shared directory, or to path, and read the records back."""
    at = path or new_path(pages.sparkSession, "warc")
    write_warc(pages, at, **options)
    return read_warc(pages.sparkSession, at)
