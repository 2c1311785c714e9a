"""CSV files that arrive zipped, read member by member."""

from __future__ import annotations

import fnmatch
import io
import zipfile
import zlib
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

LINES_SCHEMA = "archive string, member string, line_no bigint, line string, error string"
UNREADABLE = (zipfile.BadZipFile, zlib.error, RuntimeError, NotImplementedError, EOFError, OSError, ValueError)
#: Unpacked bytes that make one record batch, and most of them in one task unless a member has more.
CHUNK, TASK_BYTES = 1 << 20, 64 << 20


def file_system(path: str) -> tuple[fs.FileSystem, str, str]:
    """The file system of a path or URI, the path in it, and what to put before its paths."""
    if path.startswith("file:"):
        path = "/" + path[len("file:") :].lstrip("/")
    if "://" not in path:
        return fs.LocalFileSystem(), path.rstrip("/") or "/", "file:"
    system, inner = fs.FileSystem.from_uri(path)
    scheme = path.split("://", 1)[0]
    host = "" if scheme in ("s3", "gs", "gcs", "abfs") else path.split("://", 1)[1].split("/", 1)[0]
    return system, inner.rstrip("/"), f"{scheme}://{host}"


class Ranges(io.RawIOBase):
    """A stored file as Python's own kind of file; only the bytes asked for are read."""

    def __init__(self, system: fs.FileSystem, path: str):
        self.file = system.open_input_file(path)
        self.size = self.file.size()

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def tell(self) -> int:
        return self.file.tell()

    def seek(self, offset: int, whence: int = io.SEEK_SET) -> int:
        place = offset + (0, self.file.tell(), self.size)[whence]
        if place < 0:
            raise OSError(f"no place {place}")
        return self.file.seek(place)

    def readinto(self, buffer) -> int:
        return self.file.readinto(buffer)

    def close(self) -> None:
        self.file.close()
        super().close()


def open_ranges(system: fs.FileSystem, path: str) -> io.BufferedReader:
    return io.BufferedReader(Ranges(system, path), 1 << 16)


@dataclass
class Members(InputPartition):
    """Members that one task reads: where they begin in which archive, and archives without a directory."""

    members: list[tuple[str, zipfile.ZipInfo]] = field(default_factory=list)
    failed: list[tuple[str, str]] = field(default_factory=list)


def directory(system: fs.FileSystem, path: str) -> list[zipfile.ZipInfo] | str:
    """The members that an archive lists, or why it cannot be read. Reads the end of the file only."""
    try:
        with open_ranges(system, path) as raw, zipfile.ZipFile(raw) as archive:
            return [m for m in archive.infolist() if not m.is_dir()]
    except UNREADABLE as e:
        return f"{type(e).__name__}: {e}"


def open_member(raw, info: zipfile.ZipInfo) -> zipfile.ZipExtFile:
    """Unpacks one member as a stream from its own place in the archive."""
    raw.seek(info.header_offset)
    head = raw.read(30)
    if len(head) < 30 or head[:4] != b"PK\x03\x04":
        raise zipfile.BadZipFile(f"no member begins at byte {info.header_offset}")
    if info.flag_bits & 1:
        raise RuntimeError("the member is encrypted")
    raw.seek(info.header_offset + 30 + int.from_bytes(head[26:28], "little") + int.from_bytes(head[28:30], "little"))
    return zipfile.ZipExtFile(raw, "r", info)


def line_batch(block: bytes, number: int) -> tuple[pa.Array, pa.Array | None]:
    """The lines of a block as text, and what is wrong with those that are not UTF-8."""
    if number == 0 and block.startswith(b"\xef\xbb\xbf"):
        block = block[3:]
    ends = np.flatnonzero(np.frombuffer(block, np.uint8) == 10) + 1
    offsets = np.concatenate([[0], ends, [len(block)] if not block.endswith(b"\n") and block else []]).astype(np.int64)
    try:
        block.decode("utf-8")
    except UnicodeDecodeError:
        lines, errors = [], []
        for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
            try:
                lines.append(block[a:b].decode("utf-8").rstrip("\r\n"))
                errors.append(None)
            except UnicodeDecodeError as e:
                lines.append(None)
                errors.append(f"UnicodeDecodeError: {e}")
        return pa.array(lines, pa.string()), pa.array(errors, pa.string())
    lines = pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets), pa.py_buffer(block))
    return pc.utf8_rtrim(lines, characters="\r\n").cast(pa.string()), None


def record_batch(archive, member, first, lines, errors=None) -> pa.RecordBatch:
    n = len(lines)
    return pa.RecordBatch.from_arrays(
        [
            pa.repeat(pa.scalar(archive, pa.string()), n), pa.repeat(pa.scalar(member, pa.string()), n),
            pa.array(range(first, first + n), pa.int64()) if first is not None else pa.nulls(n, pa.int64()),
            lines, pa.nulls(n, pa.string()) if errors is None else errors,
        ],
        ["archive", "member", "line_no", "line", "error"],
    )


def member_lines(raw, archive: str, info: zipfile.ZipInfo):
    """Record batches of a member's lines; one row with the error, after the lines before it."""
    number, open_ = 0, []
    try:
        with open_member(raw, info) as stream:
            while data := stream.read1(CHUNK):
                cut = data.rfind(b"\n") + 1
                if not cut or sum(map(len, open_)) + cut < CHUNK // 2:
                    open_.append(data)
                    continue
                lines, errors = line_batch(b"".join([*open_, data[:cut]]), number)
                open_ = [data[cut:]]
                yield record_batch(archive, info.filename, number, lines, errors)
                number += len(lines)
        if rest := b"".join(open_):
            yield record_batch(archive, info.filename, number, *line_batch(rest, number))
    except UNREADABLE as e:
        whole = b"".join(open_)
        whole = whole[: whole.rfind(b"\n") + 1]
        if whole:
            yield record_batch(archive, info.filename, number, *line_batch(whole, number))
        failed = pa.array([f"{type(e).__name__}: {e}"])
        yield record_batch(archive, info.filename, None, pa.nulls(1, pa.string()), failed)


class ZippedLinesReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.glob = options["path"], options.get("glob", "*.zip")
        self.tasks, self.most = int(options.get("tasks", 1)), int(options.get("task_bytes", TASK_BYTES))

    def partitions(self) -> list[InputPartition]:
        system, base, _ = file_system(self.path)
        info = system.get_file_info(base)
        if info.type == fs.FileType.NotFound:
            raise FileNotFoundError(self.path)
        found = system.get_file_info(fs.FileSelector(base, recursive=True)) if info.type == fs.FileType.Directory else [info]
        paths = sorted(
            f.path for f in found
            if f.type == fs.FileType.File and fnmatch.fnmatch(f.base_name, self.glob) and f.base_name[0] not in "._"
        )
        with ThreadPoolExecutor(32) as pool:
            listed = list(pool.map(lambda p: directory(system, p), paths))
        total = sum(m.file_size for members in listed if not isinstance(members, str) for m in members)
        most = min(self.most, max(CHUNK, total // max(1, self.tasks)))
        out, size = [Members()], 0
        for path, members in zip(paths, listed):
            if isinstance(members, str):
                out[0].failed.append((path, members))
                continue
            for member in members:
                if size and size + member.file_size > most:
                    out.append(Members())
                    size = 0
                out[-1].members.append((path, member))
                size += member.file_size + CHUNK // 4  # opening costs something too
        return out

    def read(self, partition: Members):
        system, _, before = file_system(self.path)
        for path, error in partition.failed:
            yield record_batch(before + path, None, None, pa.nulls(1, pa.string()), pa.array([error]))
        for path, member in partition.members:
            try:
                raw = open_ranges(system, path)
            except OSError as e:
                failed = pa.array([f"{type(e).__name__}: {e}"])
                yield record_batch(before + path, member.filename, None, pa.nulls(1, pa.string()), failed)
                continue
            with raw:
                yield from member_lines(raw, before + path, member)


class ZippedLines(DataSource):
    """Lines of the files inside zip archives; options ``path``, ``glob``, ``tasks``, ``task_bytes``."""

    @classmethod
    def name(cls) -> str:
        return "zipped_lines"

    def schema(self) -> str:
        return LINES_SCHEMA

    def reader(self, schema: StructType) -> ZippedLinesReader:
        return ZippedLinesReader(dict(self.options))


def read_zipped_lines(
    spark: SparkSession, path: str, glob: str = "*.zip", task_bytes: int = TASK_BYTES
) -> DataFrame:
    """One row per text line of every file inside every archive under ``path``.

    The member is the unit of parallel work: planning reads each archive's directory, and a task
    reads the bytes of its members only, so an archive may be of any size. Small members share a
    task up to ``task_bytes`` of unpacked text; a larger one has its own, as a packed stream cannot be
    entered in the middle. Lines are unpacked as a stream of record batches of about a MB.

    An archive or member that cannot be read to its end gives one row with ``error`` set, after
    the lines read so far; all other members and archives are still read. A line that is not UTF-8
    is a row with its number and the error. As in any file scan the driver holds one entry per
    member; executors need this package and a file system that pyarrow can open. ``path`` is a folder, searched with
    its subfolders, or one archive; names that begin with a dot or an underscore are left out.
    """
    spark.dataSource.register(ZippedLines)
    options = {"glob": glob, "tasks": spark.sparkContext.defaultParallelism, "task_bytes": task_bytes}
    return spark.read.format(ZippedLines.name()).options(**options).load(path)


def read_zipped_csv(
    spark: SparkSession,
    path: str,
    schema: StructType,
    sep: str = ",",
    header: bool = True,
    corrupt_column: str = "_corrupt_record",
    glob: str = "*.zip",
    spread_lines: bool = False,
    task_bytes: int = TASK_BYTES,
) -> DataFrame:
    """Rows of zipped CSV files, parsed by Spark's CSV expression after unpacking.

    Parsing costs several times more than unpacking. When a few members hold most of the
    lines, ``spread_lines`` shuffles the unpacked lines evenly first, so that only the
    unpacking stays with one task per member.

    Adds ``archive``, ``member`` and the corrupt-record column. Unreadable archives stay
    visible as a row whose corrupt-record column holds the error. Land the result with
    ``write_table``: later scans are then columnar and splittable.
    """
    lines = read_zipped_lines(spark, path, glob, task_bytes)
    if header:
        lines = lines.where((F.col("line_no") != 0) | F.col("error").isNotNull())
    lines = lines.where(F.col("error").isNotNull() | (F.trim("line") != ""))
    if spread_lines:
        lines = lines.hint("rebalance")
    full = StructType([*schema.fields]).add(corrupt_column, "string")
    parsed = F.from_csv(
        "line",
        full.toDDL(),
        {"sep": sep, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt_column},
    )
    return (
        lines.withColumn("parsed", parsed)
        .select("archive", "member", "error", "parsed.*")
        .withColumn(corrupt_column, F.coalesce("error", corrupt_column))
        .drop("error")
    )
