"""Task packages as a data source: ``spark.read.format("task_packages").load(folder)`` after ``register(spark)``.

The listing walks the folders in the order of their names, prunes those that hold no packages and never goes below a
package's root, the first folder with a task.toml; of packages of one name the first in this order counts. Contents are
read by the tasks, for packages alone: a partition has up to ``packagesPerPartition`` packages (option, 16). The folder can
be a path or an address that Arrow's file systems reach (file, hdfs, s3, gs); ``readers.task_files`` goes through Spark's
own reader instead. Columns: task, root, rel_path, size, text; bytes that are no UTF-8 are replaced. An empty or missing
folder gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from assay.session import ship

# Folders without packages, and the file that makes a folder one.
PRUNED = (".git", "node_modules", "__pycache__", "tasks_cache")
MARK = "task.toml"
#: Nested once more in a folder of this name, a package goes by the folder above.
NESTED = "filesystem"


def _open(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def _children(store, folder: str) -> tuple[list[str], list]:
    """Names of the folders in a folder, and its files, both in the order of names."""
    from pyarrow import fs

    found = sorted(store.get_file_info(fs.FileSelector(folder, allow_not_found=True)), key=lambda x: x.base_name)
    return [x.path for x in found if x.type == fs.FileType.Directory and x.base_name not in PRUNED], [x for x in found if x.type == fs.FileType.File]


def package_roots(path: str) -> Iterator[tuple[str, str]]:
    """(name, folder) of every package below a path, first names alone."""
    store, top = _open(path)
    seen: set[str] = set()

    def walk(folder: str) -> Iterator[tuple[str, str]]:
        folders, files = _children(store, folder)
        if any(f.base_name == MARK for f in files):
            parts = folder.rstrip("/").split("/")
            name = parts[-2] if parts[-1] == NESTED and len(parts) > 1 else parts[-1]
            if name not in seen:
                seen.add(name)
                yield name, folder
            return
        for f in folders:
            yield from walk(f)

    yield from walk(top.rstrip("/") or "/")


@dataclass
class Packages(InputPartition):
    roots: list[tuple[str, str]]


class PackageReader(DataSourceReader):
    def __init__(self, path: str, size: int):
        self.path, self.size = path, size

    def partitions(self) -> list[Packages]:
        roots = list(package_roots(self.path))
        return [Packages(roots[k : k + self.size]) for k in range(0, len(roots), self.size)] or [Packages([])]

    def read(self, partition: Packages) -> Iterator[tuple[str, str, str, int, str]]:
        store, _ = _open(self.path)
        for name, root in partition.roots:
            todo = [root]
            while todo:
                folders, files = _children(store, todo.pop())
                todo += reversed(folders)
                for f in files:
                    with store.open_input_file(f.path) as handle:
                        yield name, root, f.path[len(root) :].lstrip("/"), f.size, handle.read().decode("utf-8", "replace")


class PackageSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "task_packages"

    def schema(self) -> str:
        return "task string, root string, rel_path string, size long, text string"

    def reader(self, schema) -> PackageReader:
        return PackageReader(self.options["path"], max(1, int(self.options.get("packagesPerPartition", 16))))


def register(spark: SparkSession) -> SparkSession:
    """Make the source known to a session."""
    ship(spark).dataSource.register(PackageSource)
    return spark
