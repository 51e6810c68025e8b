"""Source trees: a data source that lists them on executors, and reading and writing their files.

Spark's own file sources skip names that start with ``_`` or ``.``, which would lose every ``__init__.py``. The listing
is a Python data source instead: planning opens only the upper directories, until there are enough of them to share out,
and each task walks its own. Plain paths and ``file:`` ones are read by ``os``, whatever bytes their names hold, and have
to be mounted on every executor; other schemes go through Arrow's file systems (``s3``, ``gs``, ``hdfs``, ...).
"""

from __future__ import annotations

import os
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from pathlib import PurePath
from urllib.parse import unquote, urlparse

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from trawlnet.functions.text import basename, decode_utf8, has_extension
from trawlnet.session import cut_lineage

# Fixed value: the file types that are indexed by default.
EXTENSIONS = (".py", ".md", ".ts", ".js")

_BATCH_ROWS = 10_000
_BATCH_BYTES = 32 << 20
_TASK_BYTES = 64 << 20
# Planning opens directories until it has so many to share out for each core, and never more than so many.
_SHARES_PER_CORE = 8
_MOST_PLANNED = 4_096


def _width(spark: SparkSession) -> int:
    return spark.sparkContext.defaultParallelism


class LocalFiles:
    """Directories and files by ``os``. File names are bytes: one that is not UTF-8 must neither fail nor be lost."""

    def __init__(self, root: str):
        place = unquote(urlparse(root).path) if root.startswith("file:") else root
        self.root = os.fsencode(PurePath(place))

    def is_directory(self) -> bool:
        return os.path.isdir(self.root)

    def entries(self, directory: bytes) -> Iterator[tuple[bytes, bool, int]]:
        """Path, whether it is a directory, and size. Links to directories are not followed, links to files are; what
        cannot be opened or is gone gives nothing."""
        try:
            found = os.scandir(directory)
        except OSError:
            return
        with found:
            for entry in found:
                path = entry.name if directory == b"." else entry.path
                try:
                    if entry.is_dir(follow_symlinks=False):
                        yield path, True, 0
                    elif entry.is_file():
                        yield path, False, entry.stat().st_size
                except OSError:
                    continue

    def read(self, path: bytes) -> bytes:
        with open(path, "rb") as f:
            return f.read()

    def write(self, name: str, content: bytes) -> None:
        path = os.path.join(self.root, os.fsencode(name))
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "wb") as f:
            f.write(content)


class ArrowFiles:
    """The same by an Arrow file system, for places that ``os`` does not reach."""

    def __init__(self, root: str):
        from pyarrow import fs

        self.fs, inner = fs.FileSystem.from_uri(root)
        self.select, self.kind = fs.FileSelector, fs.FileType
        self.scheme = root.rstrip("/").removesuffix(inner.rstrip("/"))
        self.root = (self.scheme + inner.rstrip("/")).encode()

    def _inner(self, path: bytes) -> str:
        return path.decode().removeprefix(self.scheme)

    def is_directory(self) -> bool:
        return self.fs.get_file_info(self._inner(self.root)).type == self.kind.Directory

    def entries(self, directory: bytes) -> Iterator[tuple[bytes, bool, int]]:
        try:
            found = self.fs.get_file_info(self.select(self._inner(directory)))
        except OSError:
            return
        for info in found:
            if info.type in (self.kind.Directory, self.kind.File):
                yield (self.scheme + info.path).encode(), info.type == self.kind.Directory, info.size or 0

    def read(self, path: bytes) -> bytes:
        with self.fs.open_input_stream(self._inner(path)) as f:
            return f.read()

    def write(self, name: str, content: bytes) -> None:
        path = f"{self._inner(self.root)}/{name}"
        self.fs.create_dir(path.rsplit("/", 1)[0])
        with self.fs.open_output_stream(path) as f:
            f.write(content)


def files_of(root: str, arrow: bool = False) -> LocalFiles | ArrowFiles:
    scheme = urlparse(root).scheme if "://" in root else ""
    return ArrowFiles(root) if arrow or scheme not in ("", "file") else LocalFiles(root)


def require_directory(path: str) -> str:
    """Fail before planning when a whole job is pointed at something that is not a directory."""
    files = files_of(path)
    if not files.is_directory():
        raise NotADirectoryError(f"not a directory: {path}")
    return os.fsdecode(files.root)


@dataclass
class TreeShare(InputPartition):
    """Directories of one task: those of ``whole`` with all below them, those of ``upper`` without."""

    whole: list[bytes] = field(default_factory=list)
    upper: list[bytes] = field(default_factory=list)


class TreeSource(DataSource):
    """``spark.read.format("source_tree").option("root", ...)``: ``raw, size`` of every file below a directory."""

    @classmethod
    def name(cls) -> str:
        return "source_tree"

    def schema(self) -> str:
        return "raw binary, size long"

    def reader(self, schema) -> TreeReader:
        return TreeReader(dict(self.options))


class TreeReader(DataSourceReader):
    def __init__(self, options: dict):
        self.root, self.shares = options["root"], int(options.get("shares", 64))
        self.arrow = options.get("arrow") == "true"

    def partitions(self) -> list[TreeShare]:
        """Directories from the root downwards until there are enough to share out. Names of files are not kept: the
        files of an opened directory are listed by a task like all others."""
        files = files_of(self.root, self.arrow)
        frontier, upper = [files.root], []
        while frontier and len(frontier) < self.shares and len(upper) < _MOST_PLANNED:
            below = [path for directory in frontier for path, is_dir, _ in files.entries(directory) if is_dir]
            upper += frontier
            frontier = below
        shares = [TreeShare() for _ in range(max(1, min(self.shares, len(frontier) + len(upper))))]
        for i, directory in enumerate(frontier):
            shares[i % len(shares)].whole.append(directory)
        for i, directory in enumerate(upper):
            shares[-1 - i % len(shares)].upper.append(directory)
        return shares

    def read(self, partition: TreeShare) -> Iterator[pa.RecordBatch]:
        files = files_of(self.root, self.arrow)
        paths, sizes = [], []
        waiting = [(d, False) for d in partition.upper] + [(d, True) for d in partition.whole]
        while waiting:
            directory, deep = waiting.pop()
            for path, is_dir, size in files.entries(directory):
                if not is_dir:
                    paths.append(path)
                    sizes.append(size)
                    if len(paths) >= _BATCH_ROWS:
                        yield _listed(paths, sizes)
                        paths, sizes = [], []
                elif deep:
                    waiting.append((path, True))
        yield _listed(paths, sizes)


def _listed(paths: list[bytes], sizes: list[int]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(paths, pa.binary()), pa.array(sizes, pa.int64())], names=["raw", "size"])


def list_tree(spark: SparkSession, root: str, arrow: bool = False) -> DataFrame:
    """``path, raw, size`` of every file below ``root``, listed in one job; empty when it is not a directory. ``raw`` is
    the path as bytes, ``path`` its readable form. Hidden directories are entered."""
    spark.dataSource.register(TreeSource)
    shares = _SHARES_PER_CORE * _width(spark)
    listed = spark.read.format("source_tree").options(root=root, shares=shares, arrow=str(arrow).lower()).load()
    return listed.select(decode_utf8(F.col("raw")).alias("path"), "raw", "size")


def read_files(files: DataFrame, root: str, arrow: bool = False) -> DataFrame:
    """``path, content`` of the listed files below ``root``; unreadable and vanished ones yield nothing."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = files_of(root, arrow)
        paths, contents, held = [], [], 0
        for batch in batches:
            for path in batch.column("raw").to_pylist():
                try:
                    content = place.read(path)
                except OSError:
                    continue
                paths.append(path)
                contents.append(content)
                held += len(content)
                if held >= _BATCH_BYTES:
                    yield _contents(paths, contents)
                    paths, contents, held = [], [], 0
        yield _contents(paths, contents)

    content = files.select("raw").mapInArrow(read, "raw binary, content binary")
    return content.select(decode_utf8(F.col("raw")).alias("path"), "content")


def _contents(paths, contents) -> pa.RecordBatch:
    return pa.record_batch([pa.array(paths, pa.binary()), pa.array(contents, pa.binary())], names=["raw", "content"])


def scan_tree(spark: SparkSession, root: str, extensions: Sequence[str] = EXTENSIONS, arrow: bool = False) -> DataFrame:
    """``path, text`` of the tree's files with a listed extension; other files are never opened."""
    # sizes and contents see one listing, and the tree is walked once
    wanted = cut_lineage(list_tree(spark, root, arrow).where(has_extension(basename(F.col("path")), extensions)))
    held = wanted.agg(F.sum("size")).first()[0] or 0
    # one directory may hold most files; the explicit number keeps AQE from merging tasks by the
    # size of the paths when it is the contents that count
    spread = wanted.repartition(max(_width(spark), held // _TASK_BYTES), "raw")
    return read_files(spread, root, arrow).select("path", decode_utf8(F.col("content")).alias("text"))


def scan_file(spark: SparkSession, path: str) -> DataFrame:
    """``path, text`` of one file, whatever its extension; no row when it cannot be read."""
    one = spark.createDataFrame([(bytearray(files_of(path).root),)], "raw binary")
    return read_files(one, path).select("path", decode_utf8(F.col("content")).alias("text"))


def write_tree(files: DataFrame, root: str, arrow: bool = False) -> int:
    """Write ``name, content`` rows as files below ``root`` and return their number. A retried task writes its files
    again, so the result is the same."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, n = files_of(root, arrow), 0
        for batch in batches:
            for name, content in zip(batch.column("name"), batch.column("content"), strict=True):
                place.write(name.as_py(), content.as_py())
            n += batch.num_rows
        yield pa.record_batch([pa.array([n], pa.int64())], names=["n"])

    return files.select("name", "content").mapInArrow(write, "n long").agg(F.sum("n")).first()[0] or 0
