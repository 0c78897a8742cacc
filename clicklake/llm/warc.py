"""WARC archives from a deterministic sharded writer, and their reader.

Records are sorted by id over ranges of ids. The borders of ranges come from a sample that a hash of the record picks,
so they depend on the records alone and not on how the session dealt them. A task writes a range as a run of files, each
begun anew once its compressed size reaches ``roll_bytes``. Headers and digests are made here, from the payload alone. A file is written
under a temporary name and then renamed; what was committed is what the manifest lists, which is itself written as a
table after all files are there. A task that runs again, or another session, writes the same bytes under the same names.

Of records with equal payloads of at least ``MIN_SHARED`` bytes, the one with the smallest id is a response and the
others revisit it, without the payload. Null payloads count as empty, null urls as ``urn:unknown``, null ids sort last.
Repeated ids are records of their own; records that are equal in id and payload share a range. One payload is held at a time.
"""

from __future__ import annotations

import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from clicklake.llm.common import filled
from clicklake.sources.files import settled, shared_dir

MIN_SHARED = 100
ROLL_BYTES = 16 << 20
#: Payload bytes that one range of records should have; several files, also once compressed.
RANGE_BYTES = 128 << 20
#: Sampled records per range, from which its border is chosen.
SAMPLES_PER_RANGE = 200
DATE = "2024-01-01T00:00:00Z"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
MANIFEST = "file string, records long, bytes long, sha256 string"
RECORD = "id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def records(pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    """What the writer needs: id, url, payload (null for revisits), its size and digest, and the id it refers to."""
    body = filled(F.col(payload)).cast("binary")
    rows = pages.select(F.col(key).cast("long").alias("id"), F.col(url).cast("string").alias("url"), body.alias("payload"))
    rows = rows.withColumns({"size": F.octet_length("payload").cast("long"), "digest": F.sha2("payload", 256)})
    # Copies shrink to one row per digest before the shuffle.
    firsts = rows.where(F.col("size") >= MIN_SHARED).groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("n"))
    shared = settled(firsts.where("n > 1").select("digest", "first"))
    out = rows.join(shared, "digest", "left")
    refers = F.when(F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first")), F.col("first"))
    out = out.withColumn("refers_to", refers)
    return out.select(
        "id", "url", F.when(F.col("refers_to").isNull(), F.col("payload")).alias("payload"), "size", "digest", "refers_to"
    )


def record_id(page_id: int | None, digest: str) -> str:
    """A record's id: that of the page, or of the payload where the page has none."""
    name = f"page:{page_id}" if page_id is not None else f"payload:{digest}"
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>"


def record(page_id, url, payload, size, digest, refers_to) -> bytes:
    """One record, uncompressed."""
    block = HTTP + b"Content-Length: %d\r\n\r\n" % size + (payload or b"")
    headers = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": record_id(page_id, digest),
        "WARC-Date": DATE,
        "WARC-Target-URI": " ".join((url or "urn:unknown").split()),
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": str(len(block)),
        "WARC-Payload-Digest": f"sha256:{digest}",
        "WARC-Block-Digest": f"sha256:{hashlib.sha256(block).hexdigest()}",
        "X-Payload-Length": str(size),
        "X-Page-Id": "" if page_id is None else str(page_id),
    }
    if refers_to is not None:
        headers["WARC-Profile"] = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        headers["WARC-Refers-To"] = record_id(refers_to, digest)
        headers["X-Refers-To-Page-Id"] = str(refers_to)
    lines = "".join(f"{k}: {v}\r\n" for k, v in headers.items())
    return f"WARC/1.1\r\n{lines}\r\n".encode() + block + b"\r\n\r\n"


def _member(data: bytes) -> bytes:
    """A gzip member without a time, so that equal records compress to equal bytes."""
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


class _File:
    """An archive under a temporary name until it is committed."""

    def __init__(self, filesystem, path: str, name: str):
        self.filesystem, self.path, self.name = filesystem, path, name
        self.temporary = f"{path}/.{name}.{uuid.uuid4().hex}.tmp"
        self.stream = filesystem.open_output_stream(self.temporary)
        self.sha, self.records, self.bytes = hashlib.sha256(), 0, 0

    def add(self, data: bytes) -> None:
        self.stream.write(data)
        self.sha.update(data)
        self.records += 1
        self.bytes += len(data)

    def commit(self) -> tuple:
        self.stream.close()
        self.filesystem.move(self.temporary, f"{self.path}/{self.name}")
        return self.name, self.records, self.bytes, self.sha.hexdigest()


def borders(rows: DataFrame, ranges: int) -> list[tuple[bool, int, str]]:
    """The first records (no id, id, digest) of all ranges but the first, so that ranges hold about as many bytes each.

    About ``ranges * SAMPLES_PER_RANGE`` records, picked by a hash of what they hold, reach the driver.
    """
    n = rows.count()
    if ranges < 2 or not n:
        return []
    share = min(1.0, ranges * SAMPLES_PER_RANGE / n)
    spot = F.pmod(F.xxhash64("id", "digest"), F.lit(1 << 40)) / float(1 << 40)
    picked = rows.where(spot < share).groupBy(*_place()).agg(F.sum(F.col("size") + 512).alias("bytes")).collect()
    picked.sort(key=lambda r: r[:3])
    whole, seen, out = sum(r["bytes"] for r in picked), 0, []
    for r in picked:
        if len(out) < ranges - 1 and seen * ranges >= whole * (len(out) + 1):
            out.append(tuple(r[:3]))
        seen += r["bytes"]
    return out


def _place() -> list[Column]:
    return [F.col("id").isNull().alias("no_id"), F.coalesce("id", F.lit(0)).alias("number"), F.col("digest").alias("sum")]


def _range_of(bounds: list[tuple[bool, int, str]]) -> Column:
    """How many borders lie at or before a record, by binary search."""
    if not bounds:
        return F.lit(0)
    one = lambda b: F.struct(F.lit(b[0]).alias("no_id"), F.lit(b[1]).cast("long").alias("number"), F.lit(b[2]).alias("sum"))
    array, steps = F.array(*map(one, bounds)), F.array(*[F.lit(1 << s) for s in reversed(range(len(bounds).bit_length()))])
    value = F.struct(*_place())
    return F.aggregate(steps, F.lit(0), lambda low, step: F.when(F.get(array, low + step - 1) <= value, low + step).otherwise(low))


def write(rows: DataFrame, root: str, roll_bytes: int = ROLL_BYTES, ranges: int | None = None) -> DataFrame:
    """Write ``records`` below ``root``; returns the manifest, which is also kept there."""
    if ranges is None:
        ranges = -(-(rows.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]) // RANGE_BYTES) or 1
    filesystem, path = pa.fs.FileSystem.from_uri(root)
    filesystem.create_dir(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, path = pa.fs.FileSystem.from_uri(root)
        shard, number, now, done = None, 0, None, []
        for batch in batches:
            columns = [batch.column(n) for n in ("id", "url", "payload", "size", "digest", "refers_to")]
            for i, own in enumerate(batch.column("range").to_pylist()):
                if own != shard:
                    if now is not None:
                        done.append(now.commit())
                    shard, number, now = own, 0, None
                if now is None:
                    now = _File(filesystem, path, f"part-{shard:06d}-{number:05d}.warc.gz")
                    number += 1
                now.add(_member(record(*[c[i].as_py() for c in columns])))
                if now.bytes >= roll_bytes:
                    done.append(now.commit())
                    now = None
        if now is not None:
            done.append(now.commit())
        yield pa.RecordBatch.from_arrays(
            [pa.array([d[i] for d in done], t) for i, t in enumerate((pa.string(), pa.int64(), pa.int64(), pa.string()))],
            names=["file", "records", "bytes", "sha256"],
        )

    # The digest and the url order records without an id, so that a task that runs again sees the same order.
    order = [F.col("id").asc_nulls_last(), F.col("digest").asc(), F.col("url").asc()]
    placed = rows.withColumn("range", _range_of(borders(rows, ranges)))
    placed = placed.repartitionByRange(ranges, "range").sortWithinPartitions("range", *order)
    placed.mapInArrow(run, MANIFEST).write.mode("overwrite").parquet(f"{root}/_manifest")
    return rows.sparkSession.read.parquet(f"{root}/_manifest")


def members(stream, size: int = 1 << 20) -> Iterator[bytes]:
    """The members of a gzip stream, one at a time."""
    unpacker, out, left = zlib.decompressobj(31), io.BytesIO(), b""
    while True:
        data = left or stream.read(size)
        left = b""
        if not data:
            return
        out.write(unpacker.decompress(data))
        if unpacker.eof:
            left = unpacker.unused_data
            yield out.getvalue()
            unpacker, out = zlib.decompressobj(31), io.BytesIO()


def parse(member: bytes) -> tuple:
    """Id, payload size and digest, type and reference of a record; checks digests of what it holds."""
    head, _, rest = member.partition(b"\r\n\r\n")
    headers = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in head.decode().split("\r\n")[1:])
    block = rest[: int(headers["Content-Length"])]
    if f"sha256:{hashlib.sha256(block).hexdigest()}" != headers["WARC-Block-Digest"]:
        raise ValueError(f"damaged record {headers['WARC-Record-ID']}")
    digest, size = headers["WARC-Payload-Digest"].removeprefix("sha256:"), int(headers["X-Payload-Length"])
    if headers["WARC-Type"] == "response":
        payload = block.partition(b"\r\n\r\n")[2]
        if hashlib.sha256(payload).hexdigest() != digest or len(payload) != size:
            raise ValueError(f"damaged payload in {headers['WARC-Record-ID']}")
    number = lambda name: int(headers[name]) if headers.get(name) else None
    return number("X-Page-Id"), size, digest, headers["WARC-Type"], number("X-Refers-To-Page-Id")


def read(spark: SparkSession, root: str) -> DataFrame:
    """One row per record of the files that the manifest below ``root`` lists."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, path = pa.fs.FileSystem.from_uri(root)
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
        names = ["id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
        pack = lambda rows: pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names=names
        )
        for batch in batches:
            for file in batch.column("file").to_pylist():
                rows = []
                with filesystem.open_input_stream(f"{path}/{file}", compression=None) as stream:
                    for member in members(stream):
                        rows.append(parse(member))
                        if len(rows) == 10_000:
                            yield pack(rows)
                            rows = []
                yield pack(rows)

    files = spark.read.parquet(f"{root}/_manifest").select("file")
    n = max(files.count(), 1)
    return files.repartition(n, "file").mapInArrow(run, RECORD)


def archived(pages: DataFrame, root: str | None = None, **columns: str) -> DataFrame:
    """Write pages below a folder (by default a new one in the shared folder) and read them back."""
    spark = pages.sparkSession
    root = root or shared_dir(spark)
    if "://" not in root and not root.startswith("file:"):
        root = f"file://{root}"
    write(records(pages, **columns), root)
    return read(spark, root)
