"""SRC-8 / SRC-9: a partitioned log of text lines with explicit offsets, as a Python streaming data source.

The log is a folder on the shared file system, one subfolder per segment::

    <path>/p=<partition>/base=<first offset>/n=<lines>/*.txt

so the lines of partition ``p`` have the offsets base, base + 1, … in file order, and a listing shows what offsets exist;
no line is read for it. :func:`append_segments` adds a batch of lines with one Spark job, whose files appear one by one, and
then their ends to ``<path>/_ends/…``, so that a running query sees all of them or none (a log without such ends is read as
listed); segments are removed by whoever owns the log's retention (offsets below the first segment have *expired* then).

``spark.readStream.format("segment_log")`` gives ``partition, offset, value``. Options:

* ``path``;
* ``startingOffsets``: ``earliest``, ``latest`` (default), or JSON ``{"0": 17, …}``; partitions that it leaves out start at
  their earliest offset;
* ``group``: a query without a checkpoint starts where this consumer group committed last, whatever ``startingOffsets``
  says; a group that never committed starts as that option says;
* ``failOnDataLoss`` (default true): expired offsets stop the query; false resets them to the earliest one there is.

A running or restarted query owns its offsets through its checkpoint. What is behind the last finished batch is also
committed to ``<path>/_groups/<group>/…`` for other programs and for restarts without the checkpoint (at least once: the
commit follows the batch). A trigger reads all lines that are there (Python sources have no admission control).
"""

from __future__ import annotations

import itertools
import json
import time
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

NAME = "segment_log"
SCHEMA = "partition int, offset bigint, value string"
READ_LINES = 1 << 16
TASK_LINES = 1 << 20  # lines of one partition's neighbouring segments that a task reads


@dataclass(frozen=True)
class Segment:
    partition: int
    base: int
    lines: int
    folder: str

    @property
    def end(self) -> int:
        return self.base + self.lines


def _file_system(path: str):
    """(pyarrow file system, path in it) of a URI or a plain path."""
    from pyarrow import fs
    if path.startswith("file:") and not path.startswith("file://"):
        path = path[len("file:"):]
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def _folders(files, path: str, prefix: str) -> list[tuple[int, str]]:
    """(number, path) of the subfolders ``<prefix>=<number>``."""
    from pyarrow import fs
    found = files.get_file_info(fs.FileSelector(path, allow_not_found=True))
    return sorted((int(f.base_name.split("=", 1)[1]), f.path) for f in found
                  if f.type == fs.FileType.Directory and f.base_name.startswith(prefix + "="))


def segments(path: str) -> dict[int, list[Segment]]:
    """The segments of every partition in offset order."""
    files, root = _file_system(path)
    out: dict[int, list[Segment]] = {}
    for p, at in _folders(files, root, "p"):
        out[p] = [Segment(p, base, n, seg) for base, inner in _folders(files, at, "base")
                  for n, seg in _folders(files, inner, "n")]
    return {p: s for p, s in out.items() if s}


def earliest(path: str) -> dict[int, int]:
    return {p: s[0].base for p, s in segments(path).items()}


def latest(path: str) -> dict[int, int]:
    return {p: s[-1].end for p, s in segments(path).items()}


def expire(path: str, keep_from: dict[int, int]) -> None:
    """Retention, for the owner of the log: remove the segments that end at or before ``keep_from``. What is left begins at a
    segment's first offset; a partition of which nothing is left keeps its end as an empty segment."""
    files, root = _file_system(path)
    for p, mine in segments(path).items():
        gone = [s for s in mine if s.lines and s.end <= keep_from.get(p, 0)]
        if len(gone) == len([s for s in mine if s.lines]):
            files.create_dir(f"{root}/p={p}/base={mine[-1].end}/n=0", recursive=True)
        for s in gone:
            files.delete_dir(s.folder)


def _newest(path: str, folder: str) -> dict[int, int] | None:
    """The offsets that were added last to ``folder`` of the log; None if there are none."""
    from pyarrow import fs
    files, root = _file_system(path)
    at = f"{root}/{folder}"
    found = [f for f in files.get_file_info(fs.FileSelector(at, allow_not_found=True)) if f.base_name.endswith(".json")]
    if not found:
        return None
    with files.open_input_stream(max(found, key=lambda f: f.base_name).path) as f:
        return {int(p): int(o) for p, o in json.loads(f.read()).items()}


def _add(path: str, folder: str, offsets: dict[int, int]) -> None:
    """A reader takes the newest whole file, so a writer that dies leaves the one before."""
    files, root = _file_system(path)
    at = f"{root}/{folder}"
    files.create_dir(at, recursive=True)
    name = f"{at}/{time.time_ns():020d}"
    with files.open_output_stream(name + ".tmp") as f:
        f.write(json.dumps({str(p): o for p, o in offsets.items()}).encode())
    files.move(name + ".tmp", name + ".json")


def group_offsets(path: str, group: str) -> dict[int, int] | None:
    """What ``group`` committed last; None if it never did."""
    return _newest(path, f"_groups/{group}")


def commit_group(path: str, group: str, offsets: dict[int, int]) -> None:
    _add(path, f"_groups/{group}", offsets)


def appended(path: str) -> dict[int, int]:
    """The ends of the partitions as of the last finished append."""
    ends = _newest(path, "_ends")
    return latest(path) if ends is None else ends


def _lines(files, folder: str) -> Iterator[str]:
    from pyarrow import fs
    found = files.get_file_info(fs.FileSelector(folder))
    for name in sorted(f.path for f in found if f.base_name.endswith(".txt")):
        with files.open_input_stream(name) as stream:
            rest = b""
            while chunk := stream.read(1 << 20):
                *whole, rest = (rest + chunk).split(b"\n")
                for line in whole:
                    yield line.decode()
            if rest:
                yield rest.decode()


@dataclass
class _Range(InputPartition):
    """Pieces of neighbouring segments of one partition: (folder, first offset of the segment, start, end)."""

    partition: int
    pieces: list[tuple[str, int, int, int]]


class _Reader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        self.path = options["path"].rstrip("/")
        self.starting = options.get("startingoffsets", "latest").strip()
        self.group = options.get("group")
        self.strict = options.get("failondataloss", "true").strip().lower() != "false"

    def _expired(self, partition: int, wanted: int, first: int) -> int:
        if wanted >= first:
            return wanted
        if self.strict:
            raise ValueError(f"offset {wanted} of partition {partition} has expired, the first one left is {first}")
        return first

    def initialOffset(self) -> dict:
        first, last = earliest(self.path), appended(self.path)
        stored = group_offsets(self.path, self.group) if self.group else None
        if stored is not None:
            start = {p: self._expired(p, stored.get(p, first[p]), first[p]) for p in first}
        elif self.starting == "earliest":
            start = first
        elif self.starting == "latest":
            start = last
        else:
            named = {int(p): int(o) for p, o in json.loads(self.starting).items()}
            start = {p: self._expired(p, named.get(p, first[p]), first[p]) for p in first}
        return {str(p): o for p, o in start.items()}

    def latestOffset(self) -> dict:
        return {str(p): o for p, o in appended(self.path).items()}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        """A task reads neighbouring segments of one partition, up to ``TASK_LINES`` lines or one larger segment. Partitions that
        appeared later start at their first line."""
        out: list[InputPartition] = []
        for p, mine in segments(self.path).items():
            stop = int(end.get(str(p), mine[0].base))
            begin = int(start.get(str(p), mine[0].base))
            if begin < stop:
                begin = self._expired(p, begin, mine[0].base)
            held, lines = [], 0
            for s in mine:
                lo, hi = max(begin, s.base), min(stop, s.end)
                if lo >= hi:
                    continue
                if held and lines + hi - lo > TASK_LINES:
                    out.append(_Range(p, held))
                    held, lines = [], 0
                held.append((s.folder, s.base, lo, hi))
                lines += hi - lo
            if held:
                out.append(_Range(p, held))
        return out

    def read(self, partition: InputPartition):
        import pyarrow as pa
        files, _ = _file_system(self.path)
        schema = pa.schema([("partition", pa.int32()), ("offset", pa.int64()), ("value", pa.string())])
        for folder, base, start, end in partition.pieces:
            lines = itertools.islice(_lines(files, folder), start - base, end - base)
            at = start
            while held := list(itertools.islice(lines, READ_LINES)):
                yield pa.RecordBatch.from_arrays([pa.array([partition.partition] * len(held), pa.int32()),
                                                  pa.array(range(at, at + len(held)), pa.int64()),
                                                  pa.array(held, pa.string())], schema=schema)
                at += len(held)
            if at < end:
                raise ValueError(f"segment {folder} ends at {at}, not at {end}")

    def commit(self, end: dict) -> None:
        if self.group:
            commit_group(self.path, self.group, {int(p): o for p, o in end.items()})


class SegmentLogSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _Reader({k.lower(): v for k, v in self.options.items()})


def segment_stream(spark: SparkSession, path: str, starting_offsets: str | dict = "earliest", group: str | None = None,
                   fail_on_data_loss: bool = True) -> DataFrame:
    """``partition, offset, value`` of the log under ``path``."""
    spark.dataSource.register(SegmentLogSource)
    start = starting_offsets if isinstance(starting_offsets, str) else json.dumps(
        {str(p): int(o) for p, o in starting_offsets.items()})
    r = (spark.readStream.format(NAME).option("path", path).option("startingOffsets", start)
         .option("failOnDataLoss", str(fail_on_data_loss).lower()))
    return (r.option("group", group) if group else r).load()


def append_segments(lines: DataFrame, path: str, partition: Column, order: list[str], segment: Column,
                    value_col: str = "value") -> None:
    """Append the lines to the log: those of equal ``partition`` (a number) keep their ``order``, and those of equal
    ``segment`` (which must not fall in that order, e.g. their day) lie in one segment each.

    Rows are numbered inside (partition, segment) only; the segments' first offsets are running sums over one row per
    segment. The log's present ends are read from its listing, one number per partition.
    """
    spark = lines.sparkSession
    rows = lines.select(F.col(value_col).alias("value"), partition.cast("int").alias("p"), segment.alias("s"), *order)
    sizes = rows.groupBy("p", "s").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("p").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    ends = latest(path)
    if _newest(path, "_ends") is None:
        _add(path, "_ends", ends)  # before the first files appear
    known = spark.createDataFrame(list(ends.items()), "p int, end bigint")
    based = (sizes.join(F.broadcast(known), "p", "left")
             .select("p", "s", "n", (F.coalesce("end", F.lit(0)) + F.coalesce(F.sum("n").over(before), F.lit(0))).alias("base")))
    (rows.join(based, ["p", "s"]).select("value", "p", "base", "n", *order)
     .repartition("p", "base", "n").sortWithinPartitions("p", "base", "n", *order)
     .select("value", "p", "base", "n").write.mode("append").partitionBy("p", "base", "n").text(path))
    _add(path, "_ends", latest(path))


def commit_progress(query, path: str, group: str) -> None:
    """Commit the end of a query's last finished batch for ``group`` (the reader itself commits a batch when the next one
    begins)."""
    progress = query.lastProgress
    for source in json.loads(progress.json)["sources"] if progress else []:
        if source["endOffset"]:
            commit_group(path, group, {int(p): int(o) for p, o in source["endOffset"].items()})
