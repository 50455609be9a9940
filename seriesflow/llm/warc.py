"""Deterministic WARC archives: writer, manifest and reader.

Pages are put in the order of page_id and cut into shards by bytes; each task writes the
files of its shards, starting a new one when the compressed size is reached. A file gets its
final name only when it is complete, and counts only once the manifest, written by Spark
after all tasks, names it. Names and contents depend on the pages alone, so a task that is
run again writes the same files.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from seriesflow.llm.common import share, small_batches
from seriesflow.sources.storage import store

# Fixed value: the profile of records that repeat the payload of another.
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_MANIFEST = "file string, shard int, part int, records bigint, bytes bigint, sha1 string"
_RECORDS = "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"


@dataclass(frozen=True)
class Archive:
    """``shard_bytes`` of payload are meant for a shard, a file is closed from ``file_bytes``
    compressed bytes on, payloads from ``revisit_bytes`` on are written once. ``date`` is the
    WARC-Date of all records, as the files must not depend on the time of writing."""

    prefix: str = "pages"
    shard_bytes: int = 256 << 20
    file_bytes: int = 64 << 20
    revisit_bytes: int = 1000
    date: str = "2024-01-01T00:00:00Z"
    level: int = 6


def file_system(folder: str):
    """File system and path of a folder given by URI or absolute path."""
    from pyarrow.fs import FileSystem

    folder = re.sub(r"^file:/(?!/)", "file:///", folder)
    return FileSystem.from_uri(folder)


DIGITS = 15  # of a digest, as a number: where rows of one id are told apart
NO_ID = -(1 << 63)  # rows without an id come first, as this one would


def _number(digest):
    """The first digits of a hexadecimal digest."""
    return F.conv(F.substring(digest, 1, DIGITS), 16, 10).cast("bigint")


def last_not_after(ids: np.ndarray, marks: np.ndarray, id_: np.ndarray, mark: np.ndarray) -> np.ndarray:
    """Number of the pairs (ids, marks), in ascending order, that are not after each (id_, mark)."""
    left, right = np.searchsorted(ids, id_, "left"), np.searchsorted(ids, id_, "right")
    found = right.copy()
    several = np.flatnonzero(left < right)  # rows of an id at which something begins
    for edge in np.unique(left[several]):
        rows = several[left[several] == edge]
        end = right[rows[0]]
        found[rows] = edge + np.searchsorted(marks[edge:end], mark[rows], "right")
    return found


def boundaries(sizes: DataFrame, target: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (page_id, mark) at which shards begin, the first excluded, for rows (page_id,
    mark, bytes); marks tell the rows of one id apart, rows without an id have NO_ID.

    From histograms of bytes over equal ranges of ids; ranges over the target are divided
    again, all in one job a level, a single id by its marks. The same rows always give the
    same shards; the number of ranges is about that of shards. Rows of one id and mark stay
    together.
    """
    top = 16 ** DIGITS - 1
    total = sizes.agg(F.min("page_id"), F.max("page_id"), F.sum("bytes"),
                      F.min(F.when(F.col("page_id") > NO_ID, F.col("page_id")))).first()
    if total[0] is None or not total[2]:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    low = int(total[3]) if total[3] is not None else NO_ID
    # (first id, last id, first mark, last mark, bytes); apart from a single id all marks
    heavy, found = [(low, int(total[1]), 0, top, int(total[2]))], []
    if total[0] == NO_ID and low > NO_ID:
        heavy.insert(0, (NO_ID, NO_ID, 0, top, int(total[2])))
    while heavy:
        heavy.sort()
        grid = []  # how each range is divided: by id or mark, first place, width of a cell
        for a, b, m, n, volume in heavy:
            by_mark = a == b
            first, last = (m, n) if by_mark else (a, b)
            cells = max(4096 if by_mark else 16, min(65_536, 4 * volume // target))
            grid.append((by_mark, first, max(1, -(-(last - first + 1) // cells))))
        ranges_ = [np.array(x, np.int64) for x in list(zip(*heavy))[:4]]

        @F.pandas_udf("struct<number:int,cell:bigint>")
        def cell(ids: pd.Series, marks: pd.Series) -> pd.DataFrame:
            ids, marks = ids.to_numpy(np.int64), marks.to_numpy(np.int64)
            number = last_not_after(ranges_[0], ranges_[2], ids, marks) - 1
            at = np.maximum(number, 0)
            inside = (number >= 0) & (ids >= ranges_[0][at]) & (ids <= ranges_[1][at]) & (marks <= ranges_[3][at])
            by_mark, first, width = (np.array(x) for x in zip(*grid))
            # distances of ids may pass 2**63
            place = np.where(by_mark[at], marks, ids).astype(np.uint64) - first[at].astype(np.int64).astype(np.uint64)
            place = place // np.array([min(w, 2**64 - 1) for w in width.tolist()], np.uint64)[at]
            return pd.DataFrame({"number": np.where(inside, at, -1).astype(np.int32), "cell": place.astype(np.int64)})

        rows = (sizes.select(cell("page_id", "mark").alias("c"), "bytes").where("c.number >= 0")
                .groupBy("c.number", "c.cell").agg(F.sum("bytes").alias("bytes"), F.count("*").alias("rows"))
                .collect())
        next_ = []
        for r in rows:
            a, b, m, n, _ = heavy[r.number]
            by_mark, first, width = grid[r.number]
            begin = first + r.cell * width
            end = min(n if by_mark else b, begin + width - 1)
            part = (a, b, begin, end, int(r.bytes)) if by_mark else (begin, end, 0, top, int(r.bytes))
            can_be_divided = r.rows > 1 and (part[1] > part[0] or part[3] > part[2])
            (next_ if r.bytes > target and can_be_divided else found).append(part)
        heavy = next_
    starts, filled = [], 0
    for a, _, m, _, volume in sorted(found):
        if filled and filled + volume > target:
            starts.append((a, m))
            filled = 0
        filled += volume
    return tuple(np.array([x[i] for x in starts], np.int64) for i in (0, 1))


def _record(kind: str, headers: list[tuple[str, str]], block: bytes, date: str) -> bytes:
    digest = base64.b32encode(hashlib.sha1(block).digest()).decode()
    lines = [("WARC-Type", kind), ("WARC-Date", date), *headers, ("WARC-Block-Digest", f"sha1:{digest}"),
             ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines).encode() + b"\r\n" + block + b"\r\n\r\n"


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}')}>"


def page_record(page_id, url, payload: bytes, digest: str, refers_to, settings: Archive) -> bytes:
    """The response, or the revisit of the page that has the payload."""
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m.group()):02X}", url) if url else f"urn:page:{page_id}"
    headers = [("WARC-Record-ID", record_id(page_id, digest)), ("WARC-Target-URI", target),
               ("Content-Type", "application/http; msgtype=response"),
               ("WARC-Payload-Digest", f"sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}"),
               ("X-Payload-Length", str(len(payload)))]
    if page_id is not None:
        headers.append(("X-Page-Id", str(page_id)))
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    if refers_to is None:
        return _record("response", headers, http + payload, settings.date)
    headers += [("WARC-Profile", SAME_PAYLOAD), ("WARC-Refers-To", record_id(refers_to, digest)),
                ("X-Refers-To-Page", str(refers_to))]
    return _record("revisit", headers, http, settings.date)


class _Files:
    """Files of one shard after the other; ``done`` lists the complete ones."""

    def __init__(self, folder: str, settings: Archive):
        self.system, self.path = file_system(folder)
        self.settings, self.done, self.out, self.shard = settings, [], None, None

    def write(self, shard: int, record: bytes) -> None:
        if shard != self.shard:
            self.close()
            self.shard, self.part = shard, 0
        if self.out is None:
            self._open()
        self._add(record)
        self.records += 1
        if self.size >= self.settings.file_bytes:
            self.close()
            self.part += 1

    def _open(self):
        self.name = f"{self.settings.prefix}-{self.shard:06d}-{self.part:05d}.warc.gz"
        self.temporary = f"{self.path}/_temporary/{uuid.uuid4().hex}-{self.name}"
        self.system.create_dir(f"{self.path}/_temporary", recursive=True)
        self.out, self.sha1 = self.system.open_output_stream(self.temporary, compression=None), hashlib.sha1()
        self.size = self.records = 0
        info = f"software: seriesflow\r\nformat: WARC File Format 1.1\r\nfilename: {self.name}\r\n".encode()
        self._add(_record("warcinfo", [("WARC-Record-ID", record_id(None, self.name)), ("WARC-Filename", self.name),
                                       ("Content-Type", "application/warc-fields")], info, self.settings.date))

    def _add(self, record: bytes):
        packer = zlib.compressobj(self.settings.level, zlib.DEFLATED, 31)
        member = packer.compress(record) + packer.flush()
        self.out.write(member)
        self.sha1.update(member)
        self.size += len(member)

    def close(self):
        if self.out is None:
            return
        self.out.close()
        self.system.move(self.temporary, f"{self.path}/{self.name}")
        self.done.append((self.name, self.shard, self.part, self.records, self.size, self.sha1.hexdigest()))
        self.out = None


def write_archives(pages: DataFrame, folder: str, settings: Archive = Archive()) -> DataFrame:
    """Write a record per row of pages (page_id, url, html) and return the manifest.

    Null html is an empty payload. Of rows with equal payloads of at least
    ``settings.revisit_bytes`` that with the largest page_id is a response, the others are
    revisits of it; rows without a page_id are responses and come first, rows that repeat
    both page_id and payload are alike and share a shard; others of one page_id, or without,
    may be in several. Null urls are replaced by one of the page_id. Pages are shuffled once,
    with a short row for each revisit beside them; ids, digests and sizes are written once.
    An empty table gives an empty manifest.
    """
    small_batches(pages)
    payload = F.coalesce(F.col("html").cast("string").cast("binary"), F.lit("").cast("binary"))
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"),
                        payload.alias("payload")).withColumn("digest", F.sha1("payload"))
    slim = store(rows.select("page_id", "digest", F.octet_length("payload").alias("bytes")), "warc-sizes")
    starts = share(pages, boundaries(
        slim.select(F.coalesce("page_id", F.lit(NO_ID)).alias("page_id"), _number("digest").alias("mark"),
                    (F.col("bytes") + 1000).alias("bytes")), settings.shard_bytes))

    @F.pandas_udf("int")
    def shard(ids: pd.Series, marks: pd.Series) -> pd.Series:
        return pd.Series(last_not_after(*starts(), ids.to_numpy(np.int64), marks.to_numpy(np.int64)).astype(np.int32))

    large = slim.where((F.col("bytes") >= settings.revisit_bytes) & F.col("page_id").isNotNull())
    kept = large.groupBy("digest").agg(F.max("page_id").alias("kept"), F.count("*").alias("rows")).where("rows > 1")
    revisits = large.join(kept, "digest").where("page_id < kept").select(
        "page_id", "digest", F.lit(0).alias("kind"), F.col("kept").alias("refers_to"),
        F.lit(None).cast("string").alias("url"), F.lit(None).cast("binary").alias("payload"))
    both = revisits.unionByName(rows.select("page_id", "digest", F.lit(1).alias("kind"),
                                            F.lit(None).cast("bigint").alias("refers_to"), "url", "payload"))
    place = shard(F.coalesce("page_id", F.lit(NO_ID)), _number("digest"))
    dealt = both.withColumn("shard", place).repartition("shard").sortWithinPartitions(
        F.col("shard"), F.col("page_id").asc_nulls_first(), "digest", "kind", "url")
    order = ["shard", "page_id", "digest", "kind", "refers_to", "url", "payload"]

    def write(batches):
        files, revisit = _Files(folder, settings), None
        for batch in batches:
            columns = [batch.column(order.index(c)) for c in order]
            for values in zip(*columns):
                number, page_id, digest, kind, refers_to, url, body = (v.as_py() for v in values)
                if kind == 0:
                    revisit = (page_id, digest, refers_to)
                    continue
                to = revisit[2] if revisit and revisit[:2] == (page_id, digest) else None
                files.write(number, page_record(page_id, url, body, digest, to, settings))
            yield _manifest_batch(files.done)
            files.done = []
        files.close()
        yield _manifest_batch(files.done)

    manifest = dealt.select(*order).mapInArrow(write, _MANIFEST)
    manifest.write.json(f"{folder}/_manifest")
    system, path = file_system(folder)
    left = f"{path}/_temporary"  # of attempts that failed
    if system.get_file_info(left).type.name == "Directory":
        system.delete_dir_contents(left)
    return read_manifest(pages.sparkSession, folder)


def _manifest_batch(rows):
    kinds = [pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.string()]
    columns = list(zip(*rows)) or [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)],
                                      names=["file", "shard", "part", "records", "bytes", "sha1"])


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(_MANIFEST).json(f"{folder}/_manifest")


def records_of(stream, chunk: int = 1 << 20):
    """(headers, block) of each record of a stream of gzip members."""
    raw = b""
    while True:
        raw = raw or stream.read(chunk)
        if not raw:
            return
        unpacker, parts = zlib.decompressobj(31), []
        while not unpacker.eof:
            if not raw:
                raise ValueError("archive ends inside a record")
            parts.append(unpacker.decompress(raw))
            raw = unpacker.unused_data if unpacker.eof else stream.read(chunk)
        record = b"".join(parts)
        head, _, rest = record.partition(b"\r\n\r\n")
        lines = head.decode().split("\r\n")
        if not lines[0].startswith("WARC/1."):
            raise ValueError(f"not a record: {lines[0][:40]}")
        headers = dict(line.split(": ", 1) for line in lines[1:])
        block = rest[:int(headers["Content-Length"])]
        if len(block) != int(headers["Content-Length"]) or rest[len(block):] != b"\r\n\r\n":
            raise ValueError("wrong record length")
        yield headers, block


def _hex(digest: str) -> str:
    return base64.b32decode(digest.removeprefix("sha1:")).hex()


class _Counted:
    """A stream that keeps the size and digest of what was read."""

    def __init__(self, stream):
        self.stream, self.size, self.sha1 = stream, 0, hashlib.sha1()

    def read(self, n: int) -> bytes:
        data = self.stream.read(n)
        self.size += len(data)
        self.sha1.update(data)
        return data


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """The page records of all files that the manifest names.

    Columns page_id, url, payload_bytes, payload_digest (hex SHA-1), record_type, refers_to.
    Lengths and digests, also those of the manifest, are checked; a damaged file fails the
    job. Files are read by their own task each, as streams.
    """
    manifest = read_manifest(spark, folder)

    def read(batches):
        system, path = file_system(folder)
        for batch in batches:
            for name, count, size, sha1 in zip(*(c.to_pylist() for c in batch.columns)):
                rows = []
                with system.open_input_stream(f"{path}/{name}", compression=None) as opened:
                    stream = _Counted(opened)
                    for headers, block in records_of(stream):
                        if hashlib.sha1(block).hexdigest() != _hex(headers["WARC-Block-Digest"]):
                            raise ValueError(f"{name}: damaged block")
                        if headers["WARC-Type"] == "warcinfo":
                            continue
                        rows.append(_parsed(name, headers, block))
                        count -= 1
                        if len(rows) == 5000:
                            yield _record_batch(rows)
                            rows = []
                if count:
                    raise ValueError(f"{name}: {count} records missing")
                if (stream.size, stream.sha1.hexdigest()) != (size, sha1):
                    raise ValueError(f"{name}: not the file of the manifest")
                yield _record_batch(rows)

    files = manifest.select("file", "records", "bytes", "sha1")
    tasks = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return files.repartition(tasks, "file").mapInArrow(read, _RECORDS)


def _parsed(name, headers, block):
    digest, size = _hex(headers["WARC-Payload-Digest"]), int(headers["X-Payload-Length"])
    if headers["WARC-Type"] == "response":
        payload = block.partition(b"\r\n\r\n")[2]
        if len(payload) != size or hashlib.sha1(payload).hexdigest() != digest:
            raise ValueError(f"{name}: damaged payload")
    page, to = headers.get("X-Page-Id"), headers.get("X-Refers-To-Page")
    return (int(page) if page else None, headers["WARC-Target-URI"], size, digest, headers["WARC-Type"],
            int(to) if to else None)


def _record_batch(rows):
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()]
    columns = list(zip(*rows)) or [()] * len(kinds)
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), k) for c, k in zip(columns, kinds)],
        names=["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"])
