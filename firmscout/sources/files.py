"""Finding the files of a snapshot, on whatever file system Spark is set up for."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import SparkSession

from firmscout.sources.headers import plain_name

# File names of the tables, preferred one first.
TABLE_FILES = {
    "enterprise": ["enterprises.csv", "enterprise.csv"],
    "establishment": ["establishments.csv", "establishment.csv"],
    "address": ["addresses.csv", "address.csv"],
    "activity": ["activities.csv", "activity.csv"],
    "contact": ["contacts.csv", "contact.csv"],
    "denomination": ["denominations.csv", "denomination.csv"],
}
# Stems by which the tables are known in English, Dutch and French.
TABLE_STEMS = {
    "enterprises": ["enterprise", "ondernem", "entreprise"],
    "establishments": ["establishment", "vestiging", "unite_etablissement", "etablissement"],
    "activities": ["activit", "nace"],
}
SUFFIX = ".csv"


class Folder:
    """A directory as Hadoop's file system lists it. A table may be a file or a directory of part files."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path
        self._hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
        self._fs = self._hadoop.getFileSystem(spark._jsc.hadoopConfiguration())

    def exists(self) -> bool:
        return self._fs.exists(self._hadoop)

    def is_directory(self) -> bool:
        return self.exists() and self._fs.getFileStatus(self._hadoop).isDirectory()

    def entries(self) -> dict[str, bool]:
        """Names in order, each with whether it is a directory."""
        if not self.is_directory():
            return {}
        found = {s.getPath().getName(): s.isDirectory() for s in self._fs.listStatus(self._hadoop)}
        return dict(sorted(found.items()))

    def child(self, name: str) -> Folder:
        return Folder(self.spark, f"{self.path.rstrip('/')}/{name}")

    def tables(self) -> list[str]:
        return [name for name in self.entries() if name.lower().endswith(SUFFIX)]


def snapshot_folder(spark: SparkSession, path: str) -> Folder:
    """The folder that holds the tables: the given one, or its only subfolder if just that has tables."""
    folder = Folder(spark, path)
    if not folder.tables():
        inner = [name for name, is_directory in folder.entries().items() if is_directory]
        if len(inner) == 1 and folder.child(inner[0]).tables():
            return folder.child(inner[0])
    return folder


def table_path(folder: Folder, names: Iterable[str]) -> str:
    """Path of the first name present, then of the first one with the suffix doubled."""
    names = list(names)
    present = folder.entries()
    for name in [*names, *[n + SUFFIX for n in names]]:
        if name in present:
            return folder.child(name).path
    found = ", ".join(present) or "nothing"
    raise FileNotFoundError(f"{folder.path}: expected one of {', '.join(names)}, found {found}")


def path_by_stem(spark: SparkSession, path: str, kind: str) -> str:
    """The table of a kind, by the stems its file name may contain; a file path stands for itself."""
    folder = Folder(spark, path)
    if not folder.exists():
        raise FileNotFoundError(f"no such path: {path}")
    if not folder.is_directory() or path.rstrip("/").lower().endswith(SUFFIX):
        return path
    for name in folder.tables():
        if any(stem in plain_name(name) for stem in TABLE_STEMS[kind]):
            return folder.child(name).path
    raise FileNotFoundError(f"no {kind} table in {path}")
