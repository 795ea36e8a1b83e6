"""WARC archives as a Spark data source, and identical-payload revisits.

``register(spark)`` adds the format ``warc``. Reading plans one partition
for each file, or for several small ones; predicates on the record type and other
headers are pushed into it. A record's headers are parsed first; the
payload of an unwanted record isn't decoded, and where the archive says how
long a compressed record is (the ``sl`` extra field, which the writer sets)
it isn't read either. Writing makes each record a gzip member of its own;
a commit record names the files of the tasks that succeeded, so leftovers of
failed attempts are never read.

Columns: ``record_id, record_type, target_uri, warc_date, content_type,
payload_digest, refers_to, content_length, headers, payload``. Absent
headers are null. The payload of an ``application/http`` record is what follows
the HTTP headers; a revisit has none. With the option ``payload=false`` no
payload is decoded and the column is null.
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import uuid
import zlib
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, In,
                                    InputPartition, IsNotNull, IsNull, Not, StringStartsWith,
                                    WriterCommitMessage)

from clickscope.llm.common import fresh, stage
from clickscope.sources.files import open_fs, qualified

# Header names of the WARC 1.1 format by column, and its revisit profile.
HEADERS = {
    "record_id": "WARC-Record-ID", "record_type": "WARC-Type", "target_uri": "WARC-Target-URI",
    "warc_date": "WARC-Date", "content_type": "Content-Type", "payload_digest": "WARC-Payload-Digest",
    "refers_to": "WARC-Refers-To",
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SCHEMA = ("record_id string, record_type string, target_uri string, warc_date string, content_type string, "
          "payload_digest string, refers_to string, content_length bigint, headers map<string,string>, "
          "payload binary")

CLOSING = b"\r\n\r\n"  # behind a record's block
CHUNK = 1 << 16
BATCH_BYTES = 8 << 20
GROUP_BYTES = 16 << 20   # small files read by one task
ROLL_BYTES = 256 << 20   # a task starts another file beyond this


# ---------------------------------------------------------------- reading

class _Plain:
    """Bytes of an uncompressed archive; skipping seeks."""

    def __init__(self, f):
        self.f, self.size, self.buf = f, f.size(), b""

    def more(self) -> bool:
        data = self.f.read(CHUNK)
        self.buf += data
        return bool(data)

    def read(self, n: int) -> bytes:
        if len(self.buf) < n:
            self.buf += self.f.read(n - len(self.buf))
        out, self.buf = self.buf[:n], self.buf[n:]
        return out

    def skip(self, n: int) -> None:
        if n <= len(self.buf):
            self.buf = self.buf[n:]
        else:
            to = self.f.tell() + n - len(self.buf)
            if to > self.size:
                raise ValueError("the archive ends within a record")
            self.f.seek(to)
            self.buf = b""


class _Gzip:
    """Bytes of an archive of gzip members; skipping seeks past a member
    whose length its extra field gives, and inflates otherwise."""

    def __init__(self, f):
        self.f, self.raw, self.at, self.d, self.buf = f, b"", 0, None, b""
        self.end = self.left = None  # of the member: its end in the file, bytes not yet inflated

    def _raw(self) -> bool:
        data = self.f.read(CHUNK)
        self.raw += data
        self.at += len(data)
        return bool(data)

    def _start(self) -> bool:
        while len(self.raw) < 24 and self._raw():
            pass
        if not self.raw:
            return False
        head, self.end, self.left = self.raw[:24], None, None
        if len(head) == 24 and head[3] & 4 and head[12:16] == b"sl\x08\x00":
            packed, plain = struct.unpack("<II", head[16:24])
            if packed:
                self.end, self.left = self.at - len(self.raw) + packed, plain
        self.d = zlib.decompressobj(31)
        return True

    def more(self) -> bool:
        while True:
            if self.d is None and not self._start():
                return False
            if not self.raw and not self._raw():
                raise ValueError("the archive ends within a compressed record")
            data = self.d.decompress(self.raw, CHUNK)
            self.raw = self.d.unused_data if self.d.eof else self.d.unconsumed_tail
            if self.left is not None:
                self.left -= len(data)
            if self.d.eof:
                self.d = None
            if data:
                self.buf += data
                return True

    def read(self, n: int) -> bytes:
        parts, got = [self.buf], len(self.buf)
        self.buf = b""
        while got < n and self.more():
            parts.append(self.buf)
            got += len(self.buf)
            self.buf = b""
        data = b"".join(parts)
        self.buf = data[n:]
        return data[:n]

    def skip(self, n: int) -> None:
        while n > len(self.buf):
            n -= len(self.buf)
            self.buf = b""
            # what a member holds behind the block is the record's closing line ends
            if self.d is not None and self.end is not None and n >= self.left - len(CLOSING):
                n = max(0, n - self.left)
                self.f.seek(self.end)
                self.at, self.raw, self.d = self.end, b"", None
            elif not self.more():
                raise ValueError("the archive ends within a record")
        self.buf = self.buf[n:]


def _records(f, gz: bool):
    """(headers, body) of each record; body(True) reads the block, body(False) skips it."""
    src = _Gzip(f) if gz else _Plain(f)
    while True:
        while True:  # line ends between records
            src.buf = src.buf.lstrip(b"\r\n")
            if src.buf:
                break
            if not src.more():
                return
        seen = 0  # headers may be long (a url): each byte is searched once
        while (end := src.buf.find(b"\r\n\r\n", max(0, seen - 3))) < 0:
            seen = len(src.buf)
            if not b"WARC/".startswith(src.buf[:5]) or not src.more():
                raise ValueError("not a WARC record")
        first, *lines = src.buf[:end].decode("utf-8", "replace").split("\r\n")
        if not first.startswith("WARC/"):
            raise ValueError("not a WARC record")
        src.buf = src.buf[end + 4:]
        heads = dict((k.strip(), v.strip()) for k, _, v in (x.partition(":") for x in lines))
        lower = {k.lower(): v for k, v in heads.items()}
        size, done = int(lower.get("content-length", 0)), []

        def body(wanted: bool, size=size, done=done):
            done.append(1)
            if not wanted:
                return src.skip(size)
            block = src.read(size)
            if len(block) < size:
                raise ValueError("the archive ends within a record")
            return block

        yield heads, lower, size, body
        if not done:
            src.skip(size)


def _holds(f, value) -> bool:
    if isinstance(f, Not):
        return value is not None and not _holds(f.child, value)
    if isinstance(f, IsNull):
        return value is None
    if isinstance(f, IsNotNull):
        return value is not None
    if value is None:
        return False
    if isinstance(f, EqualTo):
        return value == f.value
    if isinstance(f, In):
        return value in f.value
    return value.startswith(f.value)


@dataclass
class Files(InputPartition):
    paths: list[str]


class WarcReader(DataSourceReader):
    def __init__(self, options):
        self.path = options["path"]
        self.payload = options.get("payload", "true").lower() != "false"
        self.verify = options.get("verify", "false").lower() == "true"
        self.filters = []

    def _column(self, f):
        inner = f.child if isinstance(f, Not) else f
        ok = EqualTo if isinstance(f, Not) else (EqualTo, In, IsNull, IsNotNull, StringStartsWith)
        name = ".".join(inner.attribute) if isinstance(inner, ok) else None
        return name if name in HEADERS else None

    def pushFilters(self, filters):
        for f in filters:
            if name := self._column(f):
                self.filters.append((name, f))
            else:
                yield f

    def partitions(self):
        fs, path = open_fs(self.path)
        found = {x.path: x.size for x in fs.get_file_info(pa.fs.FileSelector(path, allow_not_found=True))
                 if x.is_file}
        marks = [p for p in found if p.rpartition("/")[2].startswith("_COMMITTED-")]
        names = {f"{path.rstrip('/')}/{n}" for p in marks for n in json.loads(fs.open_input_file(p).read())}
        if lost := names - set(found):
            raise FileNotFoundError(f"{len(lost)} committed archives are missing, as {min(lost)}")
        files = names or {p for p in found if p.endswith((".warc", ".warc.gz"))}
        out, size = [], 0
        for p in sorted(files):
            if not out or size + found[p] > GROUP_BYTES:
                out.append(Files([]))
                size = 0
            out[-1].paths.append(p)
            size += found[p]
        return out or [Files([])]

    def read(self, partition):
        fs, _ = open_fs(self.path)
        rows, size = [], 0
        for path in partition.paths:
            with fs.open_input_file(path) as f:
                for heads, lower, length, body in _records(f, path.endswith(".gz")):
                    cols = {c: lower.get(h.lower()) for c, h in HEADERS.items()}
                    if not all(_holds(x, cols[c]) for c, x in self.filters):
                        body(False)
                        continue
                    payload = self._payload(cols, body) if self.payload else body(False)
                    rows.append(cols | {"content_length": length, "headers": list(heads.items()),
                                        "payload": payload})
                    size += 1000 + len(payload or b"")
                    if size >= BATCH_BYTES:
                        yield self._batch(rows)
                        rows, size = [], 0
        if rows:
            yield self._batch(rows)

    def _payload(self, cols, body) -> bytes:
        block = body(True)
        if (cols["content_type"] or "").startswith("application/http"):
            block = block.partition(b"\r\n\r\n")[2]
        if self.verify and cols["record_type"] != "revisit" and (want := cols["payload_digest"]):
            if want != "sha1:" + base32_sha1(block):
                raise ValueError(f"payload of {cols['record_id']} doesn't fit its digest")
        return block

    @staticmethod
    def _batch(rows):
        text, kinds = pa.string(), {"content_length": pa.int64(), "payload": pa.binary(),
                                    "headers": pa.map_(pa.string(), pa.string())}
        names = [*HEADERS, "content_length", "headers", "payload"]
        return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], kinds.get(n, text)) for n in names], names)


# ---------------------------------------------------------------- writing

def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _line(name: str, value: str) -> str:
    """A header line; control characters become percent escapes."""
    clean = "".join(f"%{ord(c):02X}" if ord(c) < 32 or ord(c) == 127 else c for c in value)
    return f"{name}: {clean}\r\n"


def record_bytes(cols: dict, extra: dict, payload: bytes, gz: bool = True) -> bytes:
    """One record, as a gzip member that tells its own length."""
    kind = cols.get("record_type") or "resource"
    block, about = payload, cols.get("content_type") or "application/octet-stream"
    if kind in ("response", "revisit"):
        http = "HTTP/1.1 200 OK\r\n" + _line("Content-Type", about) + "\r\n"
        block, about = http.encode() + (payload if kind == "response" else b""), "application/http; msgtype=response"
    lines = [_line(HEADERS[c], v) for c, v in cols.items() if v is not None and c in HEADERS and c != "content_type"]
    if kind == "revisit":
        lines.append(_line("WARC-Profile", REVISIT_PROFILE))
    lines += [_line(k, v) for k, v in extra.items() if v is not None]
    data = ("WARC/1.1\r\n" + "".join(lines) + _line("Content-Type", about)
            + f"Content-Length: {len(block)}\r\n\r\n").encode("utf-8", "surrogatepass") + block + CLOSING
    if not gz:
        return data
    c = zlib.compressobj(5, zlib.DEFLATED, -15)
    packed = c.compress(data) + c.flush()
    size = 24 + len(packed) + 8
    known = (size, len(data)) if max(size, len(data)) < 1 << 32 else (0, 0)
    return (b"\x1f\x8b\x08\x04" + b"\0" * 5 + b"\xff" + struct.pack("<H", 12) + b"sl\x08\x00"
            + struct.pack("<II", *known) + packed + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF))


@dataclass
class Wrote(WriterCommitMessage):
    names: list[str]


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options):
        self.path = options["path"]
        self.gz = options.get("compression", "gzip").lower() == "gzip"

    def write(self, iterator):
        fs, path = open_fs(self.path)
        fs.create_dir(path, recursive=True)
        names, out, size = [], None, 0
        for batch in iterator:
            cols = batch.schema.names
            for row in batch.to_pylist():
                if out is None or size > ROLL_BYTES:
                    if out:
                        out.close()
                    names.append(f"part-{uuid.uuid4().hex}.warc" + ".gz" * self.gz)
                    out, size = fs.open_output_stream(f"{path}/{names[-1]}", compression=None), 0
                    size += out.write(record_bytes({"record_type": "warcinfo",
                                                    "record_id": f"<urn:uuid:{uuid.uuid4()}>",
                                                    "content_type": "application/warc-fields"}, {},
                                                   b"format: WARC File Format 1.1\r\n", self.gz))
                size += out.write(record_bytes({c: row[c] for c in HEADERS if c in cols},
                                               dict(row.get("headers") or ()), row.get("payload") or b"", self.gz))
        if out:
            out.close()
        return Wrote(names)

    def commit(self, messages):
        fs, path = open_fs(self.path)
        fs.create_dir(path, recursive=True)
        with fs.open_output_stream(f"{path}/_COMMITTED-{uuid.uuid4().hex}") as f:
            f.write(json.dumps([n for m in messages if m for n in m.names]).encode())

    def abort(self, messages):
        pass  # files without a commit record are never read


class WarcSource(DataSource):
    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return WarcReader(self.options)

    def writer(self, schema, overwrite):
        return WarcWriter(self.options)


def register(spark: SparkSession) -> None:
    """Make ``spark.read.format("warc")`` and ``df.write.format("warc").mode("append")`` available."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


def read_warc(spark: SparkSession, path: str, payload: bool = True, verify: bool = False) -> DataFrame:
    register(spark)
    return (spark.read.format("warc").option("path", qualified(spark, path)).option("payload", str(payload).lower())
            .option("verify", str(verify).lower()).load())


def write_warc(records: DataFrame, path: str, compression: str = "gzip") -> None:
    """Write records with the columns of the format (absent ones are left
    out); ``headers`` are written beside the named ones. An empty frame
    gives an archive folder without records."""
    register(records.sparkSession)
    records.write.format("warc").option("path", qualified(records.sparkSession, path)).option("compression", compression).mode("append").save()


# ---------------------------------------------------------------- records of pages

def page_records(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html",
                 min_revisit_bytes: int = 0, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Records to write, one for each page row.

    The payload is the html in UTF-8 (null: empty). Of the rows with equal
    payloads of at least ``min_revisit_bytes`` bytes, those with the largest
    page id are responses and the others revisits that refer to it; rows
    with smaller payloads are responses. A null id is below any other; if all
    of a group are null they're all responses. Repeats of the largest id
    are responses too. ``X-Page-Id`` and ``X-Payload-Length`` headers carry the id and
    the full payload's length. The digests that repeat are found by a partially
    aggregated count, staged, and joined back, so that one very
    frequent payload is a split join partition and never one group.
    """
    d, body, hexes, top, n = fresh(pages.columns, "_doc", "_body", "_sha1", "_top", "_n")
    p = pages.select(F.col(page_id).cast("bigint").alias(d), F.col(url).cast("string").alias("target_uri"),
                     F.coalesce(F.col(html).cast("binary"), F.lit(b"")).alias(body))
    p = p.withColumn(hexes, F.sha1(body))
    repeated = stage(p.where(F.octet_length(body) >= min_revisit_bytes).groupBy(hexes)
                     .agg(F.max(d).alias(top), F.count(F.lit(1)).alias(n)).where(F.col(n) > 1).drop(n), "warc_repeats")

    def name(col):
        h = F.md5(F.concat_ws("|", F.coalesce(col.cast("string"), F.lit("")), F.col(hexes)).cast("binary"))
        part = [h.substr(i, k) for i, k in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
        return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *part), F.lit(">"))

    again = F.col(top).isNotNull() & ~F.col(d).eqNullSafe(F.col(top))
    return p.join(repeated, hexes, "left").select(
        name(F.col(d)).alias("record_id"), F.when(again, "revisit").otherwise("response").alias("record_type"),
        "target_uri", F.lit(date).alias("warc_date"), F.lit("text/html; charset=utf-8").alias("content_type"),
        F.concat(F.lit("sha1:"), base32(F.col(hexes))).alias("payload_digest"),
        F.when(again, name(F.col(top))).alias("refers_to"),
        F.map_filter(F.create_map(F.lit("X-Page-Id"), F.col(d).cast("string"),
                                  F.lit("X-Payload-Length"), F.octet_length(body).cast("string"),
                                  F.lit("X-Refers-To-Page-Id"), F.when(again, F.col(top)).cast("string")),
                     lambda k, v: v.isNotNull()).alias("headers"),
        F.when(again, F.lit(b"")).otherwise(F.col(body)).alias("payload"))


def base32(hexes):
    """Upper-case base32 of a hexadecimal column whose length divides by 10."""
    digits = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

    def group(g):  # 5 hexadecimal digits are 4 of base32
        v = F.conv(F.substr(hexes, g * 5 + 1, F.lit(5)), 16, 10).cast("int")
        return F.concat(*[F.substr(F.lit(digits), F.shiftright(v, s).bitwiseAND(31) + 1, F.lit(1))
                          for s in (15, 10, 5, 0)])

    return F.array_join(F.transform(F.sequence(F.lit(0), (F.length(hexes) / 5).cast("int") - 1), group), "")


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` of an
    archive of :func:`page_records`.

    Responses are read with payloads, whose digests are verified; for revisits
    only headers are parsed (the record type is a pushed predicate of both reads).
    """
    page = F.col("headers")["X-Page-Id"].cast("bigint").alias("page_id")
    digest = F.regexp_replace("payload_digest", "^sha1:", "").alias("payload_digest")
    whole = (read_warc(spark, path, verify=True).where("record_type = 'response'")
             .select(page, F.octet_length("payload").cast("bigint").alias("payload_bytes"), digest, "record_type",
                     F.lit(None).cast("bigint").alias("refers_to")))
    again = (read_warc(spark, path, payload=False).where("record_type = 'revisit'")
             .select(page, F.col("headers")["X-Payload-Length"].cast("bigint").alias("payload_bytes"), digest,
                     "record_type", F.col("headers")["X-Refers-To-Page-Id"].cast("bigint").alias("refers_to")))
    return whole.unionByName(again)
