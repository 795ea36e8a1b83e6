"""A log of lines in stored segments: partitions, offsets, and appends that happen once.

``segment_log`` is a Spark data source, batch and streaming, over a folder on shared storage. An
append writes a segment file in each task; the driver publishes them all by one
record, which names the run. What no record lists is never read, so a failed
task or job leaves nothing, and a run that is repeated under its id adds nothing.

Each segment is dealt to one of the log's partitions, at the offset (in bytes) where that one ends.
A stream's offset is a position in each partition; a micro-batch is planned as
ranges of bytes, of ``RANGE_BYTES`` at most, and a range has the lines that begin in it. A
restarted query reads the same ranges again. One writer may append at a time.

Columns: ``value, log_partition, offset``.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceStreamReader,
                                    InputPartition, WriterCommitMessage)

from clickscope.sources.files import open_fs, qualified

FORMAT = "segment_log"
SCHEMA = "value string, log_partition int, offset bigint"
PARTITIONS = 8
ROLL_BYTES = 256 << 20
RANGE_BYTES = 32 << 20
CHUNK = 4 << 20


@dataclass
class Segment:
    partition: int
    base: int   # offset of its first byte in the partition
    size: int
    file: str


def records(fs, path: str) -> list[dict]:
    """The log's records, in the order of their appends."""
    found = fs.get_file_info(pyarrow.fs.FileSelector(f"{path}/_log", allow_not_found=True))
    names = sorted(x.path for x in found if x.is_file and x.path.endswith(".json"))
    return [json.loads(fs.open_input_file(n).read()) for n in names]


def segments(fs, path: str) -> list[Segment]:
    return [Segment(**s) for r in records(fs, path) for s in r["segments"]]


def ends(found: list[Segment]) -> dict[int, int]:
    out: dict[int, int] = {}
    for s in found:
        out[s.partition] = max(out.get(s.partition, 0), s.base + s.size)
    return out


# ---------------------------------------------------------------- writing

@dataclass
class Wrote(WriterCommitMessage):
    files: list[tuple[str, int]]


class SegmentWriter(DataSourceArrowWriter):
    def __init__(self, options):
        self.path, self.run = options["path"], options["run_id"]
        self.partitions = int(options.get("partitions", PARTITIONS))

    def write(self, iterator):
        fs, path = open_fs(self.path)
        fs.create_dir(f"{path}/data", recursive=True)
        files, out, size = [], None, 0
        try:
            for batch in iterator:
                lines = batch.column(batch.schema.get_field_index("value")).drop_null()
                if pc.any(pc.match_substring(lines, "\n")).as_py():
                    raise ValueError("a line holds a line end")
                if not len(lines):
                    continue
                if out is None or size > ROLL_BYTES:
                    if out:
                        out.close()
                        files[-1] = (files[-1][0], size)
                    files.append((f"data/{uuid.uuid4().hex}.log", 0))
                    out, size = fs.open_output_stream(f"{path}/{files[-1][0]}"), 0
                size += out.write("".join(x + "\n" for x in lines.to_pylist()).encode())
            if out:
                out.close()
                files[-1] = (files[-1][0], size)
        except BaseException:
            if out and not out.closed:
                out.close()
            self._drop(fs, path, files)
            raise
        return Wrote(files)

    @staticmethod
    def _drop(fs, path, files):
        for name, _ in files:
            if fs.get_file_info(f"{path}/{name}").is_file:
                fs.delete_file(f"{path}/{name}")

    def commit(self, messages):
        fs, path = open_fs(self.path)
        files = [f for m in messages if m for f in m.files]
        known = records(fs, path)
        if any(r["run_id"] == self.run for r in known):
            return self._drop(fs, path, files)
        at, new = ends([Segment(**s) for r in known for s in r["segments"]]), []
        for i, (name, size) in enumerate(sorted(files)):
            p = i % self.partitions
            new.append({"partition": p, "base": at.get(p, 0), "size": size, "file": name})
            at[p] = at.get(p, 0) + size
        fs.create_dir(f"{path}/_log", recursive=True)
        mark = f"{path}/_log/{len(known):010d}.json"
        with fs.open_output_stream(f"{mark}.tmp") as f:
            f.write(json.dumps({"run_id": self.run, "segments": new}).encode())
        fs.move(f"{mark}.tmp", mark)

    def abort(self, messages):
        fs, path = open_fs(self.path)
        self._drop(fs, path, [f for m in messages if m for f in m.files])


# ---------------------------------------------------------------- reading

class Range(InputPartition):
    """Bytes ``start`` to ``end`` of a segment."""

    def __init__(self, segment: Segment, start: int, end: int):
        self.segment, self.start, self.end = segment, start, end


def ranges(found: list[Segment], start: dict[int, int], end: dict[int, int], size: int) -> list[Range]:
    """What lies between two positions, in ranges of at most ``size`` bytes."""
    out = []
    for s in sorted(found, key=lambda s: (s.partition, s.base)):
        a, b = max(start.get(s.partition, 0) - s.base, 0), min(end.get(s.partition, 0) - s.base, s.size)
        out += [Range(s, k, min(k + size, b)) for k in range(a, b, size)]
    return out


def read_range(path: str, part: Range) -> Iterator[pa.RecordBatch]:
    """The lines that begin in a range, a chunk at a time."""
    fs, root = open_fs(path)
    with fs.open_input_file(f"{root}/{part.segment.file}") as f:
        # the byte before the range tells whether a line begins with it
        at, rest, begun = max(part.start - 1, 0), b"", part.start == 0
        f.seek(at)
        while at < part.end:  # ``rest`` begins at ``at``
            data = f.read(CHUNK)
            if not data:
                return
            rest += data
            if not begun:
                k = rest.find(b"\n") + 1
                at, rest, begun = (at + k, rest[k:], True) if k else (at + len(rest), b"", False)
                if not begun:
                    continue
            *lines, rest = rest.split(b"\n")  # a segment ends with a line end
            values, offsets = [], []
            for line in lines:
                if at < part.end:
                    values.append(line.decode("utf-8", "replace"))
                    offsets.append(part.segment.base + at)
                at += len(line) + 1
            if values:
                yield pa.RecordBatch.from_arrays([pa.array(values, pa.string()), pa.array([part.segment.partition] * len(values), pa.int32()),
                                                  pa.array(offsets, pa.int64())], ["value", "log_partition", "offset"])


class SegmentReader(DataSourceReader):
    def __init__(self, options):
        self.path, self.size = options["path"], int(options.get("rangeBytes", RANGE_BYTES))

    def partitions(self):
        fs, path = open_fs(self.path)
        found = segments(fs, path)
        return ranges(found, {}, ends(found), self.size) or [Range(Segment(0, 0, 0, ""), 0, 0)]

    def read(self, partition):
        if partition.end > partition.start:
            yield from read_range(self.path, partition)


class SegmentStream(DataSourceStreamReader):
    """Offsets: ``{partition: position}``."""

    def __init__(self, options):
        self.path, self.size = options["path"], int(options.get("rangeBytes", RANGE_BYTES))
        self.first = options.get("startingOffsets", "earliest")

    def _position(self) -> dict:
        return {str(p): n for p, n in sorted(ends(segments(*open_fs(self.path))).items())}

    def initialOffset(self) -> dict:
        return self._position() if self.first == "latest" else {}

    def latestOffset(self) -> dict:
        return self._position()

    def partitions(self, start: dict, end: dict):
        def number(x):
            return {int(k): v for k, v in x.items()}
        return ranges(segments(*open_fs(self.path)), number(start), number(end), self.size)

    def read(self, partition):
        yield from read_range(self.path, partition)

    def commit(self, end: dict) -> None:
        pass  # the checkpoint holds the position; segments stay for other readers


class SegmentSource(DataSource):
    @classmethod
    def name(cls):
        return FORMAT

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return SegmentReader(self.options)

    def streamReader(self, schema):
        return SegmentStream(self.options)

    def writer(self, schema, overwrite):
        if overwrite:
            raise ValueError("a segment log is only appended to")
        return SegmentWriter(self.options)


# ---------------------------------------------------------------- use

def append_lines(lines: DataFrame, path: str, run_id: str, partitions: int = PARTITIONS) -> None:
    """Append the column ``value`` (null: no line) under ``run_id``; a repeated id adds nothing."""
    spark = lines.sparkSession
    spark.dataSource.register(SegmentSource)
    (lines.select(F.col("value").cast("string")).write.format(FORMAT).option("path", qualified(spark, path))
     .option("run_id", run_id).option("partitions", str(partitions)).mode("append").save())


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """``value, log_partition, offset`` of every line."""
    spark.dataSource.register(SegmentSource)
    return spark.read.format(FORMAT).option("path", qualified(spark, path)).load()


def stream_lines(spark: SparkSession, path: str, starting_offsets: str = "earliest", range_bytes: int | None = None) -> DataFrame:
    """The log as a stream: from its beginning, or (``latest``) what is appended from the start of a new query on."""
    spark.dataSource.register(SegmentSource)
    reader = spark.readStream.format(FORMAT).option("path", qualified(spark, path)).option("startingOffsets", starting_offsets)
    return (reader.option("rangeBytes", str(range_bytes)) if range_bytes else reader).load()


def append_rows(rows: DataFrame, path: str, run_id: str) -> None:
    """Append the rows of a result, as JSON lines, once for each ``run_id``."""
    append_lines(rows.select(F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"}).alias("value")), path, run_id)


def read_rows(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    return read_lines(spark, path).select(F.from_json("value", schema).alias("r")).select("r.*")
