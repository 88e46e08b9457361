"""Header lines of SAM text: a data source with a partition per group of files, which stops at a file's first record.

However many records a file holds, its header's bytes are all that is read of it. Paths
may be of any file system that pyarrow knows; .gz files are unpacked as they are read.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from urllib.parse import unquote

from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Bytes asked for at a time, and partitions at most.
CHUNK_BYTES, MOST_PARTITIONS = 1 << 16, 1000


def sample_name(path: str, field: str = "sample") -> str:
    """The name in a folder ``field=name`` of the path, else the file's name without folder and endings."""
    *folders, name = path.split("/")
    for x in reversed(folders):
        if x.startswith(f"{field}="):
            return unquote(x.partition("=")[2])
    name = name.removesuffix(".gz")
    return next((name.removesuffix(e) for e in (".sam", ".bed", ".bedgraph", ".bg", ".txt", ".tsv") if name.endswith(e)), name)


def header_lines(system: fs.FileSystem, path: str, chunk: int = CHUNK_BYTES) -> Iterator[str]:
    """A file's lines up to the first that doesn't start with @."""
    with system.open_input_stream(path, compression="gzip" if path.endswith(".gz") else None, buffer_size=chunk) as file:
        rest = b""
        while True:
            more = file.read(chunk)
            *lines, rest = (rest + more).split(b"\n") if more else [rest, b""]
            for line in lines:
                if not line.startswith(b"@"):
                    return
                yield line.decode("utf-8", "replace").removesuffix("\r")
            if not more or rest and not rest.startswith(b"@"):
                return


class Files(InputPartition):
    def __init__(self, root: str, paths: list[str]):
        self.root, self.paths = root, paths


class HeaderReader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self) -> list[InputPartition]:
        """The files under the path; names that start with _ or . are none of its files."""
        system, root = fs.FileSystem.from_uri(self.path)
        folder, _, pattern = root.rpartition("/") if "*" in root else (root, "", "")
        info = system.get_file_info(folder)
        found = system.get_file_info(fs.FileSelector(folder, recursive=not pattern)) if info.type == fs.FileType.Directory else [info]
        begin, _, end = pattern.partition("*")
        paths = sorted(x.path for x in found if x.type == fs.FileType.File and x.base_name[0] not in "_." and x.base_name.startswith(begin) and x.base_name.endswith(end))
        if not paths:
            raise FileNotFoundError(self.path)
        groups = min(len(paths), MOST_PARTITIONS)
        return [Files(self.path, paths[i::groups]) for i in range(groups)]

    def read(self, partition: Files) -> Iterator[tuple[str, str]]:
        system, _ = fs.FileSystem.from_uri(partition.root)
        for path in partition.paths:
            for line in header_lines(system, path):
                yield sample_name(path), line


class Headers(DataSource):
    """``spark.read.format("sam_headers").load(uri)``: (sample, line) of every file's header."""

    @classmethod
    def name(cls) -> str:
        return "sam_headers"

    def schema(self) -> str:
        return "sample string, line string"

    def reader(self, schema) -> DataSourceReader:
        return HeaderReader(self.options["path"])


def read_headers(spark: SparkSession, path: str) -> DataFrame:
    """(sample, line) of the header lines under ``path``: a file, a folder or a pattern for names in one."""
    cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need not have this package
    spark.dataSource.register(Headers)
    return spark.read.format("sam_headers").load(path if "://" in path or path.startswith("file:") else f"file://{path}")
