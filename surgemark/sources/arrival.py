"""Lines of recordings and captures, numbered in order of arrival: the ``arrivals`` data source.

``spark.read.format("arrivals").load(path)`` and ``spark.readStream...`` give (seq, value), one
row for each line. ``seq`` is the place of the line's first byte in all files laid end to end,
so it rises with arrival, is the same in every read, and needs no counting ahead: splits of a
file (option ``splitBytes``) are read in parallel. A task reads several splits and files if they
are small, up to ``taskBytes``, so the number of tasks follows the bytes and not the files.

Files are ordered by the time they were last written; the part files of one Spark job, told by
the job's id in their names, stay together in their order, timed by the earliest of them. What
a stream has admitted is kept in a log beside the recording (``<path>/_arrivals``, or the option
``log``): a file that turns up later comes after all that were admitted, whatever its time, and
batch reads follow the same log. Only one stream should use a log. An admitted file is complete;
what is appended to it later is not read. Hidden files (``_``, ``.``) are left out.

Offsets of the stream are numbers of admitted files. A restarted stream plans a batch again from
the log, so its lines keep their numbers.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

SPLIT_BYTES = 64 << 20
TASK_BYTES = 8 << 20
OPEN_BYTES = 16 << 10         # what opening one more split counts for
CHUNK_BYTES = 4 << 20
DEFLATED = 1_100              # more bytes than one compressed byte can stand for
PART = re.compile(r"part-(\d+)-([0-9a-f]{8}-[0-9a-f-]{27})(?:-\w*?(\d+))?")
SCHEMA = pa.schema([("seq", pa.int64()), ("value", pa.string())])


def filesystem(uri: str):
    """The file system of a folder and the folder's path in it."""
    from pyarrow import fs

    if "://" not in uri:
        uri = "file://" + re.sub(r"^file:", "", uri)
    return fs.FileSystem.from_uri(uri)


@dataclass(frozen=True)
class File:
    path: str
    size: int
    base: int                 # number of its first line

    @property
    def packed(self) -> bool:
        return self.path.endswith((".gz", ".bz2", ".zst"))

    @property
    def following(self) -> int:
        return self.base + (self.size * DEFLATED if self.packed else self.size)


@dataclass(frozen=True)
class Split:
    path: str
    base: int
    start: int
    end: int | None           # None: the whole of a packed file
    size: int


@dataclass
class Task(InputPartition):
    splits: list[Split]


def by_arrival(found: list[tuple[str, int, int]]) -> list[tuple[str, int]]:
    """(path, size) in order of arrival, from (path, size, time)."""
    jobs: dict[str, int] = {}
    keyed = []
    for path, size, time in found:
        part = PART.match(path.rsplit("/", 1)[-1])
        job = part[2] if part else path
        jobs[job] = min(time, jobs.get(job, time))
        keyed.append((job, int(part[1]) if part else 0, int(part[3] or 0) if part else 0, path, size))
    keyed.sort(key=lambda k: (jobs[k[0]], *k[:4]))
    return [(path, size) for *_, path, size in keyed]


class Arrivals:
    """The admitted files of a recording, in order, and those not admitted yet.

    Tasks that only read splits leave the log alone (``admitted=False``)."""

    def __init__(self, options: dict, admitted: bool = True):
        self.system, self.root = filesystem(options["path"])
        self.log = filesystem(options["log"])[1] if options.get("log") else f"{self.root}/_arrivals"
        self.split = int(options.get("splitbytes", SPLIT_BYTES))
        self.task = int(options.get("taskbytes", TASK_BYTES))
        self.files: list[File] = []
        for info in sorted(self._listed(self.log), key=lambda i: i.path) if admitted else ():
            with self.system.open_input_stream(info.path) as f:
                self.files += [File(*e) for e in json.loads(f.read())]

    def _listed(self, folder: str, recursive: bool = False) -> list:
        from pyarrow import fs

        found = self.system.get_file_info(fs.FileSelector(folder, allow_not_found=True, recursive=recursive))
        return [i for i in found if i.is_file and i.base_name.endswith(".json")] if folder == self.log else found

    def waiting(self) -> list[File]:
        """Files that are not admitted, numbered after those that are."""
        from pyarrow import fs

        if self.system.get_file_info(self.root).type == fs.FileType.File:
            infos = [self.system.get_file_info(self.root)]
        else:
            skip = len(self.root.rstrip("/")) + 1
            infos = [i for i in self._listed(self.root, True) if i.is_file and not any(
                p.startswith(("_", ".")) for p in i.path[skip:].split("/"))]
        known = {f.path for f in self.files}
        base = self.files[-1].following if self.files else 0
        out = []
        for path, size in by_arrival([(i.path, i.size, i.mtime_ns) for i in infos if i.path not in known]):
            out.append(File(path, size, base))
            base = out[-1].following
        return out

    def admit(self) -> int:
        """Admit the waiting files; the number of all admitted ones."""
        new = self.waiting()
        if new:
            self.system.create_dir(self.log, recursive=True)
            name = f"{self.log}/{len(self.files):012d}.json"
            with self.system.open_output_stream(name + ".new") as f:
                f.write(json.dumps([(x.path, x.size, x.base) for x in new]).encode())
            self.system.move(name + ".new", name)
            self.files += new
        return len(self.files)

    def splits(self, files: list[File]) -> list[Split]:
        out = []
        for f in files:
            if f.packed:
                out.append(Split(f.path, f.base, 0, None, f.size))
            else:
                out += [Split(f.path, f.base, at, end, end - at) for at in range(0, f.size, self.split)
                        for end in (min(at + self.split, f.size),)]
        return out

    def tasks(self, files: list[File]) -> list[Task]:
        """Splits in order, as many to a task as ``taskBytes`` allow."""
        out: list[Task] = []
        room = 0
        for split in self.splits(files):
            if not out or room < split.size:
                out.append(Task([]))
                room = self.task
            out[-1].splits.append(split)
            room -= split.size + OPEN_BYTES
        return out or [Task([])]

    def read(self, split: Split) -> Iterator[pa.RecordBatch]:
        """Lines that start in a split; the last may end beyond it."""
        if split.end is None:
            with self.system.open_input_stream(split.path, compression="detect") as f:
                yield from self._lines(f, 0, None, split.base)
            return
        with self.system.open_input_file(split.path) as f:
            start = split.start
            if start:                          # the line that runs into the split belongs to the one before
                f.seek(start - 1)
                while (piece := f.read(CHUNK_BYTES)) and b"\n" not in piece:
                    start += len(piece)
                if not piece:
                    return
                start += piece.index(b"\n")
                f.seek(start)
            yield from self._lines(f, start, split.end, split.base)

    def _lines(self, f, at: int, end: int | None, base: int) -> Iterator[pa.RecordBatch]:
        rest = b""
        while end is None or at < end:
            piece = f.read(CHUNK_BYTES)
            *lines, rest = (rest + piece).split(b"\n")
            if not piece and rest:
                lines, rest = [*lines, rest], b""
            places = []
            for line in lines:
                if end is not None and at >= end:
                    break
                places.append(base + at)
                at += len(line) + 1
            if places:
                yield _batch(places, lines[:len(places)])
            if not piece:
                return


def _batch(places: list[int], lines: list[bytes]) -> pa.RecordBatch:
    text = [line.removesuffix(b"\r").decode(errors="replace") for line in lines]
    return pa.RecordBatch.from_arrays([pa.array(places, pa.int64()), pa.array(text, pa.string())], schema=SCHEMA)


def read_task(options: dict, task: Task) -> Iterator[pa.RecordBatch]:
    found = Arrivals(options, admitted=False)
    for split in task.splits:
        yield from found.read(split)


class ArrivalReader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = options

    def partitions(self) -> list[Split]:
        found = Arrivals(self.options)
        return found.tasks([*found.files, *found.waiting()])

    def read(self, task: Task) -> Iterator[pa.RecordBatch]:
        return read_task(self.options, task)


class ArrivalStreamReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.options = options
        self.found: Arrivals | None = None

    def _arrivals(self) -> Arrivals:
        if self.found is None:
            self.found = Arrivals(self.options)
        return self.found

    def initialOffset(self) -> dict:
        return {"files": 0}

    def latestOffset(self) -> dict:
        return {"files": self._arrivals().admit()}

    def partitions(self, start: dict, end: dict) -> list[Split]:
        found = self._arrivals()
        return found.tasks(found.files[start["files"]:end["files"]])

    def read(self, task: Task) -> Iterator[pa.RecordBatch]:
        return read_task(self.options, task)


class ArrivalSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "arrivals"

    def schema(self) -> str:
        return "seq long, value string"

    def _plain(self) -> dict:
        return {k.lower(): v for k, v in self.options.items()}

    def reader(self, schema) -> ArrivalReader:
        return ArrivalReader(self._plain())

    def streamReader(self, schema) -> ArrivalStreamReader:
        return ArrivalStreamReader(self._plain())


def read_lines(spark: SparkSession, path: str, **options) -> DataFrame:
    spark.dataSource.register(ArrivalSource)
    return spark.read.format("arrivals").options(**options).load(path)


def stream_lines(spark: SparkSession, path: str, **options) -> DataFrame:
    spark.dataSource.register(ArrivalSource)
    return spark.readStream.format("arrivals").options(**options).load(path)
