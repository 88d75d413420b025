"""A folder reader that keeps every regular file, ``__init__.py`` and empty files included.

Spark's own file listing treats names with a leading underscore as hidden and drops empty files. This Python
data source lists the folder itself and reads the bytes on the executors, many files per task. The folder must
be one that every executor sees (a mounted path).

    spark.dataSource.register(SourceTree)
    spark.read.format("source_tree").option("maxPartitionBytes", 1 << 27).load(root)
"""

from __future__ import annotations

import os
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

_PARTITION_BYTES = 128 << 20
_PARTITION_FILES = 10_000


class FilePart(InputPartition):
    def __init__(self, root: str, paths: list[str], limit: int):
        self.root, self.paths, self.limit = root, paths, limit


class SourceTree(DataSource):
    @classmethod
    def name(cls) -> str:
        return "source_tree"

    def schema(self) -> str:
        return "path string, length bigint, content binary"

    def reader(self, schema) -> DataSourceReader:
        return SourceTreeReader(self.options)


class SourceTreeReader(DataSourceReader):
    """Options: ``path`` (the root), ``maxPartitionBytes``, ``maxFileBytes`` (bigger files come without bytes)."""

    def __init__(self, options):
        self.root = options["path"]
        self.part_bytes = int(options.get("maxPartitionBytes", _PARTITION_BYTES))
        self.limit = int(options.get("maxFileBytes", 10 << 20))

    def partitions(self) -> list[InputPartition]:
        """Names and sizes only; links are not followed, dot names are left out."""
        parts, paths, size = [], [], 0
        for path, length in self._listing():
            if paths and (size + length > self.part_bytes or len(paths) >= _PARTITION_FILES):
                parts.append(FilePart(self.root, paths, self.limit))
                paths, size = [], 0
            paths.append(path)
            size += min(length, self.limit)
        if paths:
            parts.append(FilePart(self.root, paths, self.limit))
        return parts or [FilePart(self.root, [], self.limit)]

    def _listing(self) -> Iterator[tuple[str, int]]:
        folders = [""]
        while folders:
            folder = folders.pop()
            for entry in sorted(os.scandir(os.path.join(self.root, folder)), key=lambda e: e.name):
                path = f"{folder}/{entry.name}" if folder else entry.name
                if entry.name.startswith(".") or entry.is_symlink():
                    continue
                if entry.is_dir():
                    folders.append(path)
                elif entry.is_file():
                    yield path, entry.stat().st_size

    def read(self, partition: FilePart) -> Iterator[tuple]:
        """A file that cannot be read, or is over the size limit, keeps its row with null content."""
        for path in partition.paths:
            full = os.path.join(partition.root, path)
            try:
                length = os.path.getsize(full)
                content = None
                if length <= partition.limit:
                    with open(full, "rb") as file:
                        content = file.read()
                yield path, length, content
            except OSError:
                yield path, None, None
