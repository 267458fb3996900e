"""A data source of file lengths and first bytes, whatever the size of the files.

Spark's binary reader takes whole files, none of 2 GiB or more. This source opens each file,
reads its first bytes and closes it. The driver lists the folder itself; every subfolder is
listed by a task, and files of the folder are dealt to tasks in shares of ``SHARE``.

Folders are reached through the file systems that pyarrow knows (local and mounted folders,
object stores, HDFS where its client library is installed).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from panelweave.workers import ship

SHARE = 1000
HEADS = "file string, length long, head binary"


def open_folder(folder: str):
    """The file system of a folder and the folder's path in it."""
    from pyarrow import fs

    if folder.startswith("file:") and not folder.startswith("file://"):
        folder = "file://" + folder[len("file:") :]
    return fs.FileSystem.from_uri(folder.rstrip("/") or "/")


def _shown(path: str) -> bool:
    """Names that begin with ``_`` or ``.`` are bookkeeping of the writers, as Spark has it."""
    return path.rsplit("/", 1)[-1][:1] not in ("_", ".")


@dataclass
class Share(InputPartition):
    """Folders to list, and listed files with their lengths."""

    folders: list[str] = field(default_factory=list)
    files: list[tuple[str, int]] = field(default_factory=list)


class HeadReader(DataSourceReader):
    def __init__(self, folder: str, size: int):
        self.folder, self.size = folder, size

    def partitions(self) -> list[Share]:
        from pyarrow import fs

        system, root = open_folder(self.folder)
        entries = [e for e in system.get_file_info(fs.FileSelector(root)) if _shown(e.path)]
        files = [(e.path, e.size) for e in entries if e.type == fs.FileType.File]
        shares = [Share(folders=[e.path]) for e in entries if e.type == fs.FileType.Directory]
        return shares + [Share(files=files[k : k + SHARE]) for k in range(0, len(files), SHARE)] or [Share()]

    def read(self, partition: Share) -> Iterator[tuple]:
        from pyarrow import fs

        system, root = open_folder(self.folder)
        files, folders = list(partition.files), list(partition.folders)
        while folders:
            for entry in system.get_file_info(fs.FileSelector(folders.pop())):
                if not _shown(entry.path):
                    continue
                if entry.type == fs.FileType.Directory:
                    folders.append(entry.path)
                else:
                    files.append((entry.path, entry.size))
        for path, length in files:
            with system.open_input_file(path) as source:
                head = source.read(self.size)
            yield path[len(root.rstrip("/")) + 1 :], length, head


class FileHeads(DataSource):
    @classmethod
    def name(cls) -> str:
        return "file_heads"

    def schema(self) -> str:
        return HEADS

    def reader(self, schema) -> HeadReader:
        return HeadReader(self.options["path"], int(self.options.get("bytes", "4")))


def file_heads(spark: SparkSession, folder: str, n_bytes: int = 4) -> DataFrame:
    """``file`` (its path below the folder), ``length`` and the first bytes of every file."""
    ship(spark)
    spark.dataSource.register(FileHeads)
    return spark.read.format("file_heads").option("bytes", n_bytes).load(folder)
