"""A folder's files as a data source of its own, listed in tasks.

Spark's file sources drop files of no bytes when they list a folder. This one shows every file, by path and
size. Each task lists the folder and goes on with its share of the subfolders, by a hash of their names; no
name passes the driver. As in Spark's sources, only subfolders named ``key=value`` are entered, other names that
begin with ``_`` or ``.`` are left out, and a path may hold the wildcards ``* ? [ ]``.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from fnmatch import fnmatchcase
from urllib.parse import quote

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "path string, length long"
TASKS = 16

# What a path in a URI may hold as it is.
PLAIN = "/=:@!$&'()*+,;~"

_WILD = re.compile(r"[*?\[]")


def _opened(path: str) -> tuple[fs.FileSystem, str, str]:
    """File system, path within it, and what to put before such paths for a URI."""
    scheme = re.match(r"([a-z][a-z0-9+.-]*):/", path)
    if scheme is None or scheme[1] == "file":
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/"), "file://"
    system, inner = fs.FileSystem.from_uri(path)
    host = re.match(r"[a-z0-9+.-]+://[^/]*", path)[0] if inner.startswith("/") else f"{scheme[1]}://"
    return system, inner, host


def _hidden(name: str) -> bool:
    return name.startswith(".") or (name.startswith("_") and "=" not in name)


def _children(system: fs.FileSystem, folder: str) -> Iterator[fs.FileInfo]:
    for info in system.get_file_info(fs.FileSelector(folder)):
        if not _hidden(info.base_name):
            yield info


def _matches(system: fs.FileSystem, path: str) -> Iterator[fs.FileInfo]:
    """What a path with wildcards stands for, folder by folder."""
    steps = path.strip("/").split("/")
    wild = next((i for i, step in enumerate(steps) if _WILD.search(step)), None)
    root = "/" if path.startswith("/") else ""
    if wild is None:
        info = system.get_file_info(root + "/".join(steps))
        if info.type != fs.FileType.NotFound:
            yield info
        return
    for info in _children(system, root + "/".join(steps[:wild])):
        if not fnmatchcase(info.base_name, steps[wild]):
            continue
        if wild + 1 == len(steps):
            yield info
        elif info.type == fs.FileType.Directory:
            yield from _matches(system, "/".join([info.path, *steps[wild + 1 :]]))


def _files(system: fs.FileSystem, folder: str) -> Iterator[fs.FileInfo]:
    for info in _children(system, folder):
        if info.type == fs.FileType.File:
            yield info
        elif "=" in info.base_name:
            yield from _files(system, info.path)


def listed(path: str, task: int = 0, tasks: int = 1) -> Iterator[tuple[str, int]]:
    """``(uri, bytes)`` of the files that fall to a task: by their folder below the path, or by their own name."""
    system, inner, before = _opened(path)

    def row(info: fs.FileInfo) -> tuple[str, int]:
        return before + quote(info.path, PLAIN), info.size

    for top in _matches(system, inner):
        entries = _children(system, top.path) if top.type == fs.FileType.Directory else [top]
        for info in entries:
            if zlib.crc32(info.path.encode()) % tasks != task:
                continue
            if info.type == fs.FileType.File:
                yield row(info)
            elif "=" in info.base_name:
                yield from map(row, _files(system, info.path))


class _Share(InputPartition):
    def __init__(self, path: str, task: int):
        super().__init__((path, task))


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.paths = json.loads(options["paths"])
        self.tasks = int(options["tasks"])

    def partitions(self) -> list[InputPartition]:
        return [_Share(path, task) for path in self.paths for task in range(self.tasks)]

    def read(self, partition: InputPartition) -> Iterator[tuple[str, int]]:
        path, task = partition.value
        return listed(path, task, self.tasks)


class FolderListing(DataSource):
    @classmethod
    def name(cls) -> str:
        return "folder_listing"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)


def folder_listing(spark: SparkSession, path: str | list[str], tasks: int = TASKS) -> DataFrame:
    """``(path, length)`` of every file, those of no bytes included; contents are not read."""
    spark.dataSource.register(FolderListing)
    paths = json.dumps([path] if isinstance(path, str) else list(path))
    return spark.read.format("folder_listing").option("paths", paths).option("tasks", tasks).load()


def empty_files(spark: SparkSession, path: str | list[str], suffix: str = "") -> DataFrame:
    """``(path)`` of the files of no bytes whose name ends in ``suffix``."""
    return folder_listing(spark, path).where((F.col("length") == 0) & F.col("path").endswith(suffix)).select("path")
