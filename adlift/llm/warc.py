"""Deterministic sharded WARC writer, and the reader of what it wrote.

Records are range-sorted by page id and dealt to shards. A shard's task writes
one gzip member per record and starts a new file when the compressed size
reaches ``roll_bytes``. Every header is made anew from the page: the digest of
the payload, a record id that follows from page id and digest, one date for the
whole run. So a file's bytes depend on its records alone, and a task that is
run again writes the same file. Spark samples the bounds of the ranges: a run
over a table larger than its sample may cut shards elsewhere than another run.

Commit: a task writes under a temporary name of its own and renames when the
file is complete; which files belong to the archive is told by the manifest, a
table of file names, sizes, record counts and digests, that is written last. A
reader follows the manifest only, so leftovers of lost tasks are never read.

Pages with equal payloads are one response, the one with the largest page id,
and revisits that refer to it. The keeper is found by a maximum per digest,
combined before the shuffle, and joined back without payloads: one row per
digest on that side, so that the planner can split a digest that a third of all
pages share on the other.

Null html is an empty payload, null urls an empty target; null page ids sort
first and are never referred to while another page has the payload; rows with
the same page id are records of their own: for a payload the one whose url has
the largest hash responds, and of rows equal in everything the first one
written. A revisit of a page without id names its record, but no page.
Other columns are not read. Pages are streamed record by record.
"""

from __future__ import annotations

import base64
import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlift.llm.frames import ship_package

ROLL_BYTES = 64 << 20
DATE = "2024-01-01T00:00:00Z"
_SPACE = uuid.UUID("6f2b6a0e-6d0c-4c52-9a57-2d1f1f0d5c11")
MANIFEST = "shard int, file string, records long, bytes long, sha256 string"
READ = (
    "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, "
    "html string"
)


def _store(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


def _record_id(page_id, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, f'{page_id}/{digest}')}>"


def _record(page_id, url: str, payload: bytes, digest: str, responds: bool, keeper) -> bytes:
    """One record: the page as a response, or as a revisit of its keeper, which may be a page without an id."""
    url = "".join(url.split())
    if responds:
        body, kind = payload, "response"
    else:
        body, kind = b"", "revisit"
    head = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: {_record_id(page_id, digest)}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {url}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"WARC-Block-Digest: sha1:{sha1_base32(body)}",
        f"X-Page-ID: {'' if page_id is None else page_id}",
        f"X-Payload-Length: {len(payload)}",
        "Content-Type: text/html; charset=utf-8",
        f"Content-Length: {len(body)}",
    ]
    if not responds:
        head[6:6] = [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: {_record_id(keeper, digest)}",
            f"X-Refers-To-Page: {'' if keeper is None else keeper}",
        ]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _member(record: bytes) -> bytes:
    """A gzip member without time stamp."""
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(record) + packer.flush()


class _File:
    """A file under a temporary name, renamed on completion."""

    def __init__(self, folder: str, shard: int, number: int):
        self.store, base = _store(folder)
        self.name = f"shard-{shard:06d}-{number:06d}.warc.gz"
        self.final = f"{base}/{self.name}"
        self.temporary = f"{base}/_tmp-{uuid.uuid4().hex}-{self.name}"
        self.store.create_dir(base, recursive=True)
        self.out = self.store.open_output_stream(self.temporary, compression=None)
        self.digest, self.bytes, self.records, self.shard = hashlib.sha256(), 0, 0, shard

    def add(self, member: bytes) -> None:
        self.out.write(member)
        self.digest.update(member)
        self.bytes += len(member)
        self.records += 1

    def commit(self) -> tuple:
        self.out.close()
        self.store.move(self.temporary, self.final)
        return self.shard, self.name, self.records, self.bytes, self.digest.hexdigest()


def _manifest_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.string()]
    columns = zip(*rows) if rows else [[]] * 5
    names = ["shard", "file", "records", "bytes", "sha256"]
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names)


def keepers(pages: DataFrame) -> DataFrame:
    """For each (page_id, url, digest): whether it responds, else ``keeper``, the page that does for the same payload.

    ``order_key`` tells rows with the same page id apart.
    """
    best = pages.groupBy(F.col("digest").alias("d")).agg(F.max(F.struct("page_id", F.col("order_key"))).alias("best"))
    joined = pages.join(best, F.col("digest") == F.col("d"))
    first = F.col("best.page_id").eqNullSafe(F.col("page_id")) & (F.col("best.order_key") == F.col("order_key"))
    keeper = F.when(~first, F.col("best.page_id"))
    return joined.select("page_id", "url", "digest", first.alias("responds"), keeper.alias("keeper")).distinct()


def write_warc(
    pages: DataFrame,
    folder: str,
    shards: int | None = None,
    roll_bytes: int = ROLL_BYTES,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
) -> DataFrame:
    """Write the pages as WARC files below ``folder`` and return the manifest, written beside them."""
    spark = pages.sparkSession
    ship_package(spark)
    rows = pages.select(
        pages[page_id].cast("long").alias("page_id"),
        F.coalesce(pages[url].cast("string"), F.lit("")).alias("url"),
        F.coalesce(pages[html].cast("string"), F.lit("")).alias("html"),
    )
    rows = rows.withColumn("digest", F.unhex(F.sha1(F.col("html").cast("binary"))))
    # Larger is first: the hash of the url breaks ties between rows of one page id.
    rows = rows.withColumn("order_key", F.xxhash64("url"))
    count = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # What is known of a page travels as a row of its own to where the page goes, so that payloads are shuffled once.
    known = keepers(rows.drop("html")).withColumn("html", F.lit(None).cast("string"))
    both = rows.select("page_id", "url", "html", "digest").unionByName(known, allowMissingColumns=True)
    both = both.withColumn("is_page", F.col("html").isNotNull())
    key = ["page_id", "url", "digest"]
    ranged = both.repartitionByRange(count, *key).sortWithinPartitions(*key, "is_page")
    ranged = ranged.select(*key, "html", "responds", "keeper", F.spark_partition_id().alias("shard"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, number, known = None, 0, None
        for batch in batches:
            done = []
            for i in range(batch.num_rows):
                key, target, digest, text, *of_page, shard = (c[i].as_py() for c in batch.columns)
                if text is None:
                    known = of_page
                    continue
                responds, keeper = known
                payload = text.encode()
                own = base64.b32encode(digest).decode()
                if current is None:
                    current = _File(folder, shard, number)
                current.add(_member(_record(key, target, payload, own, responds, keeper)))
                if responds:  # rows equal in everything stand side by side: one responds
                    known = [False, key]
                if current.bytes >= roll_bytes:
                    done.append(current.commit())
                    current, number = None, number + 1
            yield _manifest_batch(done)
        if current is not None:
            yield _manifest_batch([current.commit()])

    manifest = ranged.mapInArrow(write, MANIFEST)
    manifest.write.mode("overwrite").parquet(f"{folder}/manifest.parquet")
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest.parquet")


class _Reader:
    """Records of a gzip file, one member at a time."""

    def __init__(self, raw):
        self.raw, self.left = raw, b""

    def __iter__(self) -> Iterator[tuple[dict[str, str], bytes]]:
        while True:
            unpack, out = zlib.decompressobj(31), io.BytesIO()
            while not unpack.eof:
                data = self.left or self.raw.read(1 << 18)
                self.left = b""
                if not data:
                    if out.tell():
                        raise ValueError("a record is cut off")
                    return
                out.write(unpack.decompress(data))
                self.left = unpack.unused_data
            head, _, rest = out.getvalue().partition(b"\r\n\r\n")
            lines = head.decode().split("\r\n")
            fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
            yield fields, rest[: int(fields["Content-Length"])]


def read_warc(manifest: DataFrame, folder: str) -> DataFrame:
    """The records of the files of a manifest; a response's payload is checked against its digest."""
    ship_package(manifest.sparkSession)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
        names = [c.split()[0] for c in READ.split(", ")]
        number = lambda x: int(x) if x else None
        for batch in batches:
            for name in batch.column(0).to_pylist():
                store, base = _store(folder)
                rows, held = [], 0
                with store.open_input_stream(f"{base}/{name}", compression=None) as raw:
                    for fields, body in _Reader(raw):
                        digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                        response = fields["WARC-Type"] == "response"
                        if response and sha1_base32(body) != digest:
                            raise ValueError(f"{name}: a payload differs from its digest")
                        rows.append((
                            number(fields["X-Page-ID"]), fields["WARC-Target-URI"], int(fields["X-Payload-Length"]),
                            digest, fields["WARC-Type"], number(fields.get("X-Refers-To-Page")),
                            body.decode() if response else None,
                        ))
                        held += len(body)
                        if held > 1 << 22:
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)], names
                            )
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)], names)

    files = manifest.select("file")
    files = files.repartition(int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions")), "file")
    return files.mapInArrow(read, READ)
