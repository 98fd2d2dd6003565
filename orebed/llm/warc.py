"""Deterministic sharded WARC writer and a reader for its archives.

Rows are cut into key ranges that depend on the data alone (sums of bytes over
key prefixes, refined where a prefix is too heavy), sorted within each range and
written as one gzip member per record. Files roll by compressed size. A file is
written under a temporary name and renamed when complete; only files listed in
the manifest, which is written last, belong to the archive. A task that runs
again writes the same bytes under the same names, so lost executors do no harm.

Of rows with equal payloads the one with the largest id is the response and the
others are revisits without a body. Executors write through pyarrow's file
systems, so the folder may be local to a test or an object store or HDFS.

Defined results: a null payload is empty; a null url has no target header; rows
without an id come first and are responses unless a row with an id has the same
payload; of repeated rows with one id and payload the first is the response and
the others revisit it; an empty table gives an empty archive; other columns are
ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orebed.llm.common import cut
from orebed.session import release

ROLL_BYTES = 256 << 20  # compressed bytes after which a file is closed
SHARD_BYTES = 256 << 20  # payload bytes of a key range
LEAST_SHARDS = 64  # ranges that even small tables are dealt to, unless they fall below LEAST_BYTES each
LEAST_BYTES = 4 << 20
RADIX_BITS = 2
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the standard URL namespace
MANIFEST = "shard int, file string, records long, bytes long, sha1 string"
RECORDS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"


def file_system(path: str):
    """pyarrow file system and path of a Hadoop-style location."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))


def _sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _record_id(page_id: int | None, digest: str, nth: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, f'{page_id}:{digest}:{nth}')}>"


def _member(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = "".join(f"{k}: {v}\r\n" for k, v in headers)
    raw = f"WARC/1.1\r\n{lines}Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress(raw) + pack.flush()


def _page_record(page_id, url, payload: bytes, digest: str, nth: int, refers_to: int | None, revisit: bool) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    headers = [
        ("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", _record_id(page_id, digest, nth)),
        ("WARC-Date", DATE), ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", f"sha1:{digest}"), ("WARC-Block-Digest", f"sha1:{_sha1(block)}"),
    ]
    if url is not None:
        clean = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)
        headers.insert(3, ("WARC-Target-URI", clean))
    if page_id is not None:
        headers.append(("X-Page-Id", str(page_id)))
    if revisit:
        headers += [("WARC-Profile", PROFILE), ("WARC-Refers-To", _record_id(refers_to, digest, 0)),
                    ("X-Refers-To-Page-Id", str(refers_to))]
    return _member(headers, block)


class _Files:
    """Rolling files of one shard, each renamed to its name once complete."""

    def __init__(self, folder: str, shard: int, roll_bytes: int):
        self.fs, self.folder = file_system(folder)
        self.fs.create_dir(f"{self.folder}/_temporary")
        self.shard, self.roll_bytes, self.count = shard, roll_bytes, 0
        self.stream = None

    def write(self, record: bytes) -> dict | None:
        if self.stream is None:
            self.name = f"part-{self.shard:06d}-{self.count:05d}.warc.gz"
            self.temporary = f"{self.folder}/_temporary/{uuid.uuid4().hex}"
            self.stream, self.records, self.bytes, self.sha1 = self.fs.open_output_stream(self.temporary, compression=None), 0, 0, hashlib.sha1()
            info = f"software: orebed\r\nformat: WARC File Format 1.1\r\nisPartOf: {self.name}\r\n".encode()
            self._put(_member([
                ("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(NAMESPACE, self.name)}>"),
                ("WARC-Date", DATE), ("WARC-Filename", self.name), ("Content-Type", "application/warc-fields"),
            ], info))
        self._put(record)
        self.records += 1
        return self.close() if self.bytes >= self.roll_bytes else None

    def _put(self, data: bytes) -> None:
        self.stream.write(data)
        self.sha1.update(data)
        self.bytes += len(data)

    def close(self) -> dict | None:
        if self.stream is None:
            return None
        self.stream.close()
        self.stream = None
        self.fs.move(self.temporary, f"{self.folder}/{self.name}")
        self.count += 1
        return {"shard": self.shard, "file": self.name, "records": self.records, "bytes": self.bytes,
                "sha1": self.sha1.hexdigest()}


def shard_bounds(rows: DataFrame, shard_bytes: int) -> list[int]:
    """First ids of the second and later shards: prefix sums of bytes over ranges of ids.

    Ranges are nodes of a radix tree over the ids, four to a parent. Only nodes
    heavier than half a shard are opened, so each level sends the driver at most
    eight sums per shard, whatever the number of rows.
    """
    low, high = rows.agg(F.min("page_id"), F.max("page_id")).first()
    if low is None:
        return []
    shift, above, heavy, leaves = max(0, 62 if low < 0 <= high else (low ^ high).bit_length() - RADIX_BITS), 0, None, []
    while True:
        part = rows.where("page_id is not null")
        if heavy is not None:
            opened = rows.sparkSession.createDataFrame([(h,) for h in heavy], "parent long")
            part = part.join(F.broadcast(opened), F.shiftright("page_id", above) == F.col("parent"), "left_semi")
        sums = part.groupBy(F.shiftright("page_id", shift).alias("node")).agg(F.sum("size").alias("size")).collect()
        heavy = sorted(r["node"] for r in sums if shift and r["size"] > shard_bytes // 2)
        leaves += [(r["node"] << shift, r["size"]) for r in sums if not shift or r["size"] <= shard_bytes // 2]
        if not heavy:
            break
        above, shift = shift, max(0, shift - RADIX_BITS)
    bounds, held = [], 0
    for first, size in sorted(leaves):
        if held and held + size > shard_bytes:
            bounds.append(first)
            held = 0
        held += size
    return bounds


def write_archives(
    pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
    revisit_from: int = 0, shard_bytes: int | None = None, roll_bytes: int = ROLL_BYTES,
) -> DataFrame:
    """Write ``pages`` as archives below ``folder`` and return the manifest table.

    Equal payloads of at least ``revisit_from`` bytes are stored once.
    """
    spark = pages.sparkSession
    payload = F.coalesce(F.col(payload_col), F.lit(""))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), payload.alias("payload"))
    small = cut(rows.select("page_id", F.octet_length("payload").cast("long").alias("size"), F.sha2("payload", 256).alias("key")))
    if shard_bytes is None:
        total = small.agg(F.sum("size")).first()[0] or 0
        shard_bytes = min(SHARD_BYTES, max(LEAST_BYTES, total // LEAST_SHARDS))
    bounds = np.array(shard_bounds(small, shard_bytes), dtype="int64")

    @F.pandas_udf("int")
    def shard_of(ids: pd.Series) -> pd.Series:
        found = np.searchsorted(bounds, ids.fillna(0).to_numpy("int64"), side="right")
        return pd.Series(np.where(ids.isna(), 0, found).astype("int32"))

    keepers = small.where(F.col("size") >= revisit_from).groupBy("key").agg(
        F.max("page_id").alias("keeper"), F.count("*").alias("n")).where("n > 1 and keeper is not null")
    revisits = small.join(keepers, "key").where("page_id is null or page_id <> keeper").select(
        "page_id", F.lit(None).cast("string").alias("url"), F.lit(None).cast("string").alias("payload"),
        "key", F.col("keeper").alias("refers_to")).distinct()
    both = rows.select("page_id", "url", "payload", F.sha2("payload", 256).alias("key"), F.lit(None).cast("long").alias("refers_to"))
    dealt = both.unionByName(revisits).withColumn("shard", shard_of("page_id")).repartitionById(len(bounds) + 1, F.col("shard"))
    ordered = dealt.sortWithinPartitions("shard", F.asc_nulls_first("page_id"), F.desc_nulls_last("refers_to"), "key", "url")

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files, page, known, done = None, object(), {}, {}
        made: list[dict] = []
        for batch in batches:
            for shard, page_id, url, text, key, refers in zip(
                batch["shard"], batch["page_id"], batch["url"], batch["payload"], batch["key"], batch["refers_to"], strict=True
            ):
                page_id = None if pd.isna(page_id) else int(page_id)
                if files is None or shard != files.shard:
                    made += [files.close()] if files else []
                    files, page = _Files(folder, shard, roll_bytes), object()
                if page_id != page:
                    page, known, done = page_id, {}, {}
                if text is None:
                    known[key] = int(refers)
                    continue
                data = text.encode()
                nth = done.get(key, 0)
                done[key] = nth + 1
                target = known.get(key)
                if target is None and nth and page_id is not None and len(data) >= revisit_from:
                    target = page_id
                made.append(files.write(_page_record(page_id, url, data, _sha1(data), nth, target, target is not None)))
            yield pd.DataFrame([m for m in made if m], columns=["shard", "file", "records", "bytes", "sha1"])
            made = []
        if files:
            yield pd.DataFrame([m for m in [files.close()] if m], columns=["shard", "file", "records", "bytes", "sha1"])

    ordered.mapInPandas(write, MANIFEST).write.mode("overwrite").parquet(f"{folder}/_manifest")
    release(small)
    return spark.read.schema(MANIFEST).parquet(f"{folder}/_manifest")


def _members(stream) -> Iterator[bytes]:
    """The decompressed gzip members of a stream, one after the other."""
    unpack, parts = zlib.decompressobj(31), []
    while data := stream.read(1 << 20):
        while data:
            parts.append(unpack.decompress(data))
            data = b""
            if unpack.eof:
                yield b"".join(parts)
                data, unpack, parts = unpack.unused_data, zlib.decompressobj(31), []
    if any(parts):
        raise ValueError("the archive ends inside a record")


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (names lower-cased) and block of one record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in head.decode().split("\r\n")[1:])}
    return headers, rest[: int(headers["content-length"])]


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """(page_id, url, payload_bytes, payload_digest, record_type, refers_to) of every page record.

    Block digests, and payload digests of responses, are recomputed; a mismatch
    is an error. Revisits state the length and digest of the payload they repeat.
    """
    manifest = spark.read.schema(MANIFEST).parquet(f"{folder}/_manifest").select("file")

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, base = file_system(folder)
        for batch in batches:
            for name in batch["file"]:
                found = []
                with fs.open_input_stream(f"{base}/{name}", compression=None) as stream:
                    for raw in _members(stream):
                        headers, block = parse_record(raw)
                        if headers["warc-type"] == "warcinfo":
                            continue
                        http, _, payload = block.partition(b"\r\n\r\n")
                        digest = headers["warc-payload-digest"].removeprefix("sha1:")
                        response = headers["warc-type"] == "response"
                        if headers["warc-block-digest"] != f"sha1:{_sha1(block)}" or response and _sha1(payload) != digest:
                            raise ValueError(f"digest mismatch in {name}: {headers['warc-record-id']}")
                        size = int(re.search(rb"\r\nContent-Length: (\d+)", http)[1])
                        page, refers = headers.get("x-page-id"), headers.get("x-refers-to-page-id")
                        found.append((page and int(page), headers.get("warc-target-uri"), size, digest,
                                      headers["warc-type"], refers and int(refers)))
                        if len(found) == 10_000:
                            yield _records(found)
                            found = []
                yield _records(found)

    return manifest.repartition(max(1, spark.sparkContext.defaultParallelism), "file").mapInPandas(read, RECORDS)


def _records(rows: list[tuple]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"])
    return out.astype({"page_id": "Int64", "payload_bytes": "int64", "refers_to": "Int64"})
