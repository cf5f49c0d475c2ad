"""Documents as files: a Spark data source that writes one file a row, and a transport that answers from such files.

Tasks write into a folder of their own attempt below `_staging`; only when all have succeeded the driver moves what
they wrote to its place, and when one fails nothing of the job is left. Files that are there already are skipped
(or replaced, or an error), so that a job that is run again writes only what is missing. Any store that pyarrow can
open by URI will do; a plain path is a local or mounted folder.
"""

from __future__ import annotations

import os
import time
import uuid
import zlib
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import partial
from itertools import batched

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyarrow import parquet as pq
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

STAGING = "_staging"
#: What a file that exists already means.
EXISTING = ("skip", "replace", "error")
#: Moves that the driver has going at once; further attempts to delete what is staged.
MOVERS, AGAIN = 16, 20
#: Files that a task stages in one folder, whose names the driver has at once; files in a batch of a listing.
PART = 10_000


def opened(path: str) -> tuple[arrow_fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    return arrow_fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (arrow_fs.LocalFileSystem(), path)


def inside(name: str | None) -> str:
    """A relative name that cannot leave its folder; anything else is an error."""
    parts = (name or "").split("/")
    if not name or name.startswith("/") or "\\" in name or any(p in ("", ".", "..", STAGING) for p in parts):
        raise ValueError(f"not a file name inside the folder: {name!r}")
    return name


@dataclass
class Staged(WriterCommitMessage):
    """What one task has written, to be moved: folders 0, 1, ... of PART files at most."""

    folder: str
    parts: int
    files: int
    skipped: int


class FileWriter(DataSourceWriter):
    """Writes rows (file, body): body is a string or binary, null counts as empty."""

    def __init__(self, options: dict) -> None:
        self.path, self.existing, self.job = options["path"].rstrip("/"), options.get("existing", "skip"), uuid.uuid4().hex
        if self.existing not in EXISTING:
            raise ValueError(f"existing is one of {', '.join(EXISTING)}")
        fs, root = opened(self.path)
        fs.create_dir(f"{root}/{STAGING}/{self.job}", recursive=True)  # once it is gone, tasks that are late fail

    def _there(self, fs: arrow_fs.FileSystem, target: str) -> bool:
        return fs.get_file_info(target).type == arrow_fs.FileType.File

    def write(self, iterator: Iterator) -> Staged:
        fs, root = opened(self.path)
        folder = f"{STAGING}/{self.job}/{TaskContext.get().taskAttemptId()}"
        written = skipped = parts = 0
        fs.create_dir(f"{root}/{folder}", recursive=False)
        for row in iterator:
            name = inside(row["file"])
            if self.existing != "replace" and self._there(fs, f"{root}/{name}"):
                if self.existing == "error":
                    raise FileExistsError(name)
                skipped += 1
                continue
            if written == parts * PART:
                part, made = f"{root}/{folder}/{parts}", set()
                fs.create_dir(part, recursive=False)
                parts += 1
            target = f"{part}/{name}"
            for k in range(name.count("/")):
                parent = f"{part}/{name.rsplit('/', name.count('/') - k)[0]}"
                if parent not in made:
                    fs.create_dir(parent, recursive=False)
                    made.add(parent)
            body = row["body"]
            with fs.open_output_stream(target) as out:
                out.write(body.encode() if isinstance(body, str) else bytes(body or b""))
            written += 1
        return Staged(folder, parts, written, skipped)

    def commit(self, messages: list[Staged | None]) -> None:
        fs, root = opened(self.path)
        fs.create_dir(root, recursive=True)
        with ThreadPoolExecutor(MOVERS) as pool:
            for folder in (f"{m.folder}/{k}" for m in messages if m for k in range(m.parts)):
                listed = fs.get_file_info(arrow_fs.FileSelector(f"{root}/{folder}", recursive=True))
                names = [f.path.split(f"{folder}/", 1)[1] for f in listed if f.type == arrow_fs.FileType.File]
                for parent in sorted({n.rpartition("/")[0] for n in names}):
                    fs.create_dir(f"{root}/{parent}", recursive=True)
                list(pool.map(lambda n, folder=folder: self._move(fs, f"{root}/{folder}/{n}", f"{root}/{n}"), names))
        self.abort(messages)

    def _move(self, fs: arrow_fs.FileSystem, source: str, target: str) -> None:
        if self.existing == "replace" and self._there(fs, target) and not isinstance(fs, arrow_fs.LocalFileSystem):
            fs.delete_file(target)  # a local move replaces at once
        if self.existing == "replace" or not self._there(fs, target):
            fs.move(source, target)

    def abort(self, messages: list[Staged | None]) -> None:
        """Remove what is staged; also the end of a commit, when it is what two rows of one name have left over."""
        fs, root = opened(self.path)
        for left in range(AGAIN, -1, -1):  # tasks that still run may add a file meanwhile
            try:
                if fs.get_file_info(f"{root}/{STAGING}/{self.job}").type != arrow_fs.FileType.NotFound:
                    fs.delete_dir(f"{root}/{STAGING}/{self.job}")
                break
            except OSError:
                if not left:
                    raise
                time.sleep(0.05)
        if fs.get_file_info(f"{root}/{STAGING}").type != arrow_fs.FileType.NotFound and not fs.get_file_info(arrow_fs.FileSelector(f"{root}/{STAGING}")):
            fs.delete_dir(f"{root}/{STAGING}")


class FileSink(DataSource):
    """format("gavel-files") with options path and existing (skip, replace or error); rows are (file, body)."""

    @classmethod
    def name(cls) -> str:
        return "gavel-files"

    def schema(self) -> str:
        return "file string, body binary"

    def writer(self, schema, overwrite: bool) -> FileWriter:
        return FileWriter(dict(self.options) | ({"existing": "replace"} if overwrite else {}))


def _entries(fs: arrow_fs.FileSystem, folder: str) -> Iterator[tuple[str, int | None]]:
    """Names in a folder with bytes, None for a folder; none if it is gone. A local folder is read entry by entry."""
    if not isinstance(fs, arrow_fs.LocalFileSystem):
        for f in fs.get_file_info(arrow_fs.FileSelector(folder, allow_not_found=True)):
            yield f.base_name, None if f.type == arrow_fs.FileType.Directory else f.size
    elif os.path.isdir(folder):
        with os.scandir(folder) as found:
            for f in found:
                yield f.name, None if f.is_dir() else f.stat().st_size


def _top(path: str) -> Iterator[tuple[str, int | None]]:
    """What stands in path itself; what is staged there does not count."""
    return (x for x in _entries(*opened(path.rstrip("/"))) if x[0] != STAGING)


def _within(fs: arrow_fs.FileSystem, root: str, name: str, size: int | None) -> Iterator[tuple[str, int]]:
    if size is None:
        for entry, its in _entries(fs, f"{root}/{name}"):
            yield from _within(fs, root, f"{name}/{entry}", its)
    elif size:
        yield name, size


def _walked(path: str, tops: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    fs, root = opened(path.rstrip("/"))
    rows = (x for b in tops for name, size in zip(*(c.to_pylist() for c in b.columns), strict=True) for x in _within(fs, root, name, size))
    for some in batched(rows, PART):
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in some], pa.string()), pa.array([x[1] for x in some], pa.int64())], ["file", "bytes"])


def below(spark: SparkSession, path: str) -> DataFrame:
    """file, bytes for every file below path that is not empty; none where there is no such folder.

    Tasks list, so that no name is in the driver: one lists path itself, and the folders that it finds are dealt to all
    cores. Each is read as a stream (in stores that are not local, whole). To Spark the size is unknown, so that a join
    broadcasts no listing but one that it has found to be small.
    """
    tops = spark.createDataFrame(spark.sparkContext.parallelize([path], 1).flatMap(_top), "name string, bytes long", verifySchema=False)
    return tops.repartition(spark.sparkContext.defaultParallelism).mapInArrow(partial(_walked, path), "file string, bytes long")


def mirrored(url: str) -> str:
    """Name of the file that stands for a URL in a mirror."""
    bare = url.split("://", 1)[-1].split("#", 1)[0]
    return bare + "index" if bare.endswith("/") else bare


def _answer(root: str, url: str, method: str = "GET", timeout: float = 0) -> tuple[int, dict, str]:
    fs, folder = opened(root)
    path = f"{folder.rstrip('/')}/{inside(mirrored(url))}"
    if fs.get_file_info(path).type != arrow_fs.FileType.File:
        return 404, {}, ""
    if method == "HEAD":
        return 200, {}, ""
    with fs.open_input_stream(path) as f:
        body = f.read().decode("utf-8", "replace")
    return 200, {"Content-Type": "application/json" if body[:1] in "{[" else "text/html"}, body


def mirror(root: str) -> Callable:
    """A transport that answers from files written below root, a harvest's copy of its sources: a repeated run asks nobody."""
    return partial(_answer, root)


def pack_of(url: Column, packs: int) -> Column:
    """Number of the pack that holds a URL: all pages of one path are in one."""
    path = F.regexp_replace(F.regexp_replace(url, r"^[A-Za-z][A-Za-z0-9+.-]*://", ""), r"[?#].*$", "")
    return F.pmod(F.crc32(path.cast("binary")), F.lit(packs)).cast("int")


def write_packs(pages: DataFrame, path: str, packs: int) -> None:
    """Write pages (url, body) below path in so many packs, each read whole: for sites of more pages than files are good for."""
    rows = pages.select("url", "body", pack_of(F.col("url"), packs).alias("pack"))
    rows.repartitionById(packs, "pack").write.partitionBy("pack").parquet(path)


class _Packs:
    """A transport that answers from packs; it keeps the one that was asked for last."""

    def __init__(self, packs: int, root: str) -> None:
        self.packs, self.root, self.at, self.pages = packs, root.rstrip("/"), None, {}

    def __call__(self, url: str, method: str = "GET", timeout: float = 0) -> tuple[int, dict, str]:
        bare = url.split("#", 1)[0]
        pack = zlib.crc32(bare.split("://", 1)[-1].split("?", 1)[0].encode()) % self.packs
        if pack != self.at:
            fs, folder = opened(f"{self.root}/pack={pack}")
            there = fs.get_file_info(folder).type != arrow_fs.FileType.NotFound
            found = pq.read_table(folder, filesystem=fs, columns=["url", "body"], partitioning=None).to_pydict() if there else {"url": [], "body": []}
            self.at, self.pages = pack, dict(zip(found["url"], found["body"], strict=True))
        if bare not in self.pages:
            return 404, {}, ""
        body = self.pages[bare] or ""
        return 200, {"Content-Type": "application/json" if body[:1] in "{[" else "text/html"}, "" if method == "HEAD" else body


def unpacked(spec: str) -> Callable:
    """A transport from packs: "<number>:<folder>"."""
    packs, _, root = spec.partition(":")
    return _Packs(int(packs), root)


def register(spark) -> None:
    """Make the sink known to a session."""
    spark.dataSource.register(FileSink)
