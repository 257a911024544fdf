"""A streaming source for log files that are still being written.

`spark.readStream.format("growing_logs")` reads every line of the files of a folder once it is complete,
also while a file grows.  An offset maps each file to the byte up to which it was read, always the end
of a line, so a line written in two goes is read once, whole.  A micro-batch takes all complete lines,
or at most `linesPerBatch` of them, dealt evenly over the files that have new ones; its byte ranges are
cut into parts of `partitionBytes`, each read by a task of its own from its first line start to the line that
crosses its end.

A micro-batch costs a good part of a second however few lines it has.  With `batchesPerTrigger` one takes up to so
many batches of `linesPerBatch` lines, if so many wait, and reads them side by side, each by a task of its own; the
column `batch` numbers them from 0.  The lines of the micro-batch are dealt evenly over the files and cut into
batches file after file, so the batches follow from its two offsets alone, also when it is replayed.

A file is known by its log and its first line, not by its name.  The log is the name without what rotation
appends (`kdc.log`, `kdc.log.1` and `kdc.log-20240131` are one log), so a file that is renamed, or copied
and then cut to nothing, is read on where it was left, and what takes its name is a new file.  A first line
says when it was written; a log whose files all begin with the same line cannot be told apart.  The last
line of a rotated file may lack its end; it is read as it is once the next file has a line.

Options: `path`, `glob` (names to read, `*`), `linesPerBatch`, `batchesPerTrigger`, `partitionBytes`,
`failOnDataLoss` (`true`: a file that is gone before it was read fails the stream, `false`: it is passed over).
Files are read through pyarrow's file systems.  To find the ends of lines the driver reads the first line and the last
block of each file, with `linesPerBatch` the bytes of the lines of that batch, and with `batchesPerTrigger` twice.
"""

from __future__ import annotations

import fnmatch
import hashlib
import re
import sys
from collections.abc import Iterator
from contextlib import contextmanager

from pyarrow import RecordBatch, array, fs, int32, string
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

FORMAT = "growing_logs"
BATCH = "batch"
_BLOCK = 1 << 18
_ROTATED = re.compile(r"(?:[.-]\d[\d-]*)+$")
_PARTITION_BYTES = 32 << 20
_BATCH_LINES = 8192


class _File:
    """One file as it was when the folder was listed."""

    def __init__(self, system: fs.FileSystem, path: str, size: int) -> None:
        self.path, self.size = path, size
        self.name = path.rsplit("/", 1)[-1]
        self.log = _ROTATED.sub("", self.name)
        self._source = system.open_input_file(path)
        first = self.line_ends(0, 1)
        head = first or min(size, _BLOCK)
        self.has_line = first > 0
        digest = hashlib.sha256(self.read(0, min(head, _BLOCK))).hexdigest()[:24]
        self.identity = f"{self.log}:{digest}"

    def read(self, start: int, stop: int) -> bytes:
        return self._source.read_at(min(stop, self.size) - start, start)

    def line_ends(self, start: int, lines: int) -> int:
        """Where the `lines`-th line from `start` ends, or the last complete one before; `start` if none."""
        found = start
        while start < self.size and lines > 0:
            block = self.read(start, start + _BLOCK)
            if not block:
                break
            ends = block.count(b"\n")
            if ends >= lines:
                at = -1
                for _ in range(lines):
                    at = block.index(b"\n", at + 1)
                return start + at + 1
            if ends:
                found = start + block.rindex(b"\n") + 1
                lines -= ends
            start += len(block)
        return found

    def advance(self, start: int, lines: int, last: int) -> tuple[int, int]:
        """The end of the `lines`-th line from `start`, at most `last`, and how many lines that is; an unfinished line
        before `last` is one."""
        found, tail = 0, b"\n"
        while start < last:
            block = self.read(start, min(last, start + _BLOCK))
            if not block:
                return last, found + 1
            ends = block.count(b"\n")
            if found + ends >= lines:
                at = -1
                for _ in range(lines - found):
                    at = block.index(b"\n", at + 1)
                return start + at + 1, lines
            found, start, tail = found + ends, start + len(block), block[-1:]
        return start, found + (tail != b"\n")

    def last_line_end(self, start: int) -> int:
        """The end of the last complete line after `start`; `start` if there is none."""
        stop = self.size
        while stop > start:
            begin = max(start, stop - _BLOCK)
            at = self.read(begin, stop).rfind(b"\n")
            if at >= 0:
                return begin + at + 1
            stop = begin
        return start

    def close(self) -> None:
        self._source.close()


class GrowingFolder:
    """The files of a folder, and what of them is new."""

    def __init__(self, options: dict[str, str]) -> None:
        if not options.get("path"):
            raise ValueError(f"{FORMAT} needs a path")
        self.path, self.glob = options["path"], options.get("glob", "*")
        lines = options.get("linespersbatch") or options.get("linesPerBatch")
        self.lines = int(lines) if lines else None
        self.batches = int(options.get("batchesPerTrigger") or 1)
        self.partition_bytes = int(options.get("partitionBytes") or _PARTITION_BYTES)
        self.strict = str(options.get("failOnDataLoss", "true")).lower() != "false"
        if (self.lines is not None and self.lines < 1) or self.batches < 1 or self.partition_bytes < 1:
            raise ValueError("linesPerBatch, batchesPerTrigger and partitionBytes are at least 1")
        if self.batches > 1 and self.lines is None:
            raise ValueError("batchesPerTrigger needs linesPerBatch")

    def system(self) -> tuple[fs.FileSystem, str]:
        if re.match(r"[a-z0-9]+:", self.path, re.IGNORECASE):
            return fs.FileSystem.from_uri(self.path)
        return fs.LocalFileSystem(), self.path

    def files(self) -> dict[str, _File]:
        """Files that have a line, by identity; of a copy and its original the longer one."""
        system, root = self.system()
        found: dict[str, _File] = {}
        for info in system.get_file_info(fs.FileSelector(root, allow_not_found=True)):
            hidden = info.base_name.startswith((".", "_"))
            if info.type != fs.FileType.File or hidden or not fnmatch.fnmatch(info.base_name, self.glob):
                continue
            try:
                file = _File(system, info.path, info.size)
            except FileNotFoundError:  # renamed between the listing and now: met again under its new name
                continue
            other = found.get(file.identity)
            if not file.has_line or (other is not None and other.size >= file.size):
                file.close()
                continue
            if other is not None:
                other.close()
            found[file.identity] = file
        return found

    def ends(self, position: dict[str, int]) -> dict[str, int]:
        """The position after the next micro-batch."""
        files = self.files()
        live = {f.log for f in files.values() if f.name == f.log}
        last: dict[str, int] = {}
        for identity, file in files.items():
            start = position.get(identity, 0)
            finished = file.name != file.log and file.log in live
            last[identity] = max(start, file.size) if finished else file.last_line_end(start)
        ends = {i: position.get(i, 0) for i in files}
        pending = sorted(i for i in files if last[i] > ends[i])
        if self.lines is None:
            ends |= {i: last[i] for i in pending}
        left = (self.lines or 0) * self.batches
        while left > 0 and pending:
            share = max(1, left // len(pending))
            for identity in pending[: left if share == 1 else None]:
                ends[identity], found = files[identity].advance(ends[identity], share, last[identity])
                left -= found
            pending = [i for i in pending if last[i] > ends[i]]
        for file in files.values():
            file.close()
        return dict(sorted(ends.items()))

    @contextmanager
    def _new(self, start: dict[str, int], end: dict[str, int]) -> Iterator[list[tuple[str, _File, int, int]]]:
        """(identity, file, from, to) of each file that has new bytes between two positions."""
        wanted = {i: (start.get(i, 0), stop) for i, stop in end.items() if stop > start.get(i, 0)}
        files = self.files() if wanted else {}
        found = []
        try:
            for identity, (begin, stop) in wanted.items():
                file = files.get(identity)
                if file is not None and file.size >= stop:
                    found.append((identity, file, begin, stop))
                elif self.strict:
                    raise RuntimeError(f"lines of {identity} are gone; failOnDataLoss=false passes over them")
            yield found
        finally:
            for file in files.values():
                file.close()

    def _parts(self, identity: str, file: _File, begin: int, stop: int) -> list[tuple]:
        return [
            (identity, file.path, begin, first, min(first + self.partition_bytes, stop), stop)
            for first in range(begin, stop, self.partition_bytes)
        ]

    def parts(self, start: dict[str, int], end: dict[str, int]) -> list[tuple]:
        """(identity, path, begin of the batch, from, to, end of the batch) of each task's bytes."""
        with self._new(start, end) as found:
            return [part for new in found for part in self._parts(*new)]

    def cut(self, start: dict[str, int], end: dict[str, int]) -> list[list[tuple]]:
        """The parts of each batch of at most `linesPerBatch` lines between two positions."""
        batches, left = [], 0
        with self._new(start, end) as found:
            for identity, file, begin, stop in found:
                while begin < stop:
                    if not left:
                        batches.append([])
                        left = self.lines
                    at, lines = file.advance(begin, left, stop)
                    batches[-1] += self._parts(identity, file, begin, at)
                    begin, left = at, left - lines
        return batches

    def tasks(self, start: dict[str, int], end: dict[str, int]) -> list[tuple[int, list[tuple]]]:
        """(batch, parts) of each task: parts of one batch, and of at most `partitionBytes` if there are several."""
        if self.batches == 1:
            return [(0, [part]) for part in self.parts(start, end)]
        tasks = []
        for number, parts in enumerate(self.cut(start, end)):
            room = 0
            for part in parts:
                size = part[4] - part[3]
                if size > room:
                    tasks.append((number, []))
                    room = self.partition_bytes
                tasks[-1][1].append(part)
                room -= size
        return tasks

    def open(self, identity: str, path: str) -> _File | None:
        """The file, also if it has been renamed since it was planned."""
        system, _ = self.system()
        try:
            file = _File(system, path, system.get_file_info(path).size)
            if file.identity == identity:
                return file
            file.close()
        except FileNotFoundError:
            pass
        files = self.files()
        wanted = files.pop(identity, None)
        for file in files.values():
            file.close()
        if wanted is None and self.strict:
            raise RuntimeError(f"{identity} is gone; failOnDataLoss=false passes over it")
        return wanted


def part_lines(file: _File, begin: int, first: int, last: int, stop: int) -> Iterator[bytes]:
    """Lines that start in [first, last); lines of the batch lie in [begin, stop)."""
    at = first
    if first > begin and file.read(first - 1, first) != b"\n":
        at = file.line_ends(first, 1)
        if at == first:  # the rest of the file is one line, which starts before
            return
    rest = b""
    while at < stop:
        block = file.read(at, min(stop, at + _BLOCK))
        if not block:
            break
        *lines, tail = block.split(b"\n")
        for line in lines:
            starts = at - len(rest)
            if starts >= last:
                return
            yield rest + line
            at += len(line) + 1
            rest = b""
        rest += tail
        at += len(tail)
    if rest and at - len(rest) < last:
        yield rest


class _Reader(DataSourceStreamReader):
    """Remembers where the next batch begins: the end of the last one that Spark has planned or replayed."""

    def __init__(self, folder: GrowingFolder, numbered: bool) -> None:
        self.folder, self.numbered = folder, numbered
        self.position: dict[str, int] = {}

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        return self.folder.ends(self.position)

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        self.position = end
        return [InputPartition(t) for t in self.folder.tasks(start, end)]

    def read(self, partition: InputPartition) -> Iterator[RecordBatch]:
        number, parts = partition.value
        for part in parts:
            yield from self._part(number, *part)

    def _part(
        self, number: int, identity: str, path: str, begin: int, first: int, last: int, stop: int
    ) -> Iterator[RecordBatch]:
        file = self.folder.open(identity, path)
        if file is None:
            return
        texts: list[str] = []

        def batch() -> RecordBatch:
            columns = [array(texts, string()), array([file.name] * len(texts), string())]
            if self.numbered:
                columns.append(array([number] * len(texts), int32()))
            return RecordBatch.from_arrays(columns, names=["value", "log_file", BATCH][: len(columns)])

        for line in part_lines(file, begin, first, last, stop):
            texts.append(line.removesuffix(b"\r").decode("utf-8", "replace"))
            if len(texts) >= _BATCH_LINES:
                yield batch()
                texts.clear()
        if texts:
            yield batch()
        file.close()


class GrowingLogs(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "value string, log_file string" + (f", {BATCH} int" if self._numbered() else "")

    def _numbered(self) -> bool:
        return bool(self.options.get("batchesPerTrigger"))

    def streamReader(self, schema) -> _Reader:
        return _Reader(GrowingFolder(self.options), self._numbered())


def scan_growing(
    spark: SparkSession,
    folder: str,
    lines_per_batch: int | None = None,
    glob: str | None = None,
    partition_bytes: int | None = None,
    fail_on_data_loss: bool = True,
    batches_per_trigger: int | None = None,
) -> DataFrame:
    """Lines of the log files of a folder as they are written: `value` and `log_file`, and with `batches_per_trigger`
    also `batch`."""
    # executors need not have this package: what they run is sent along
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(GrowingLogs)
    options = {
        "linesPerBatch": lines_per_batch, "batchesPerTrigger": batches_per_trigger, "glob": glob,
        "partitionBytes": partition_bytes,
    }
    reader = spark.readStream.format(FORMAT).option("failOnDataLoss", str(fail_on_data_loss).lower())
    for name, value in options.items():
        if value is not None:
            reader = reader.option(name, str(value))
    return reader.load(folder)

