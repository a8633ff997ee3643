"""Files and folders of whatever store a path names, through Hadoop's file
system interface, and the partition lists of paths and tables.

Only names and small records pass through here, never rows: the number of
entries is that of a table's partitions.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def is_path(name: str) -> bool:
    """Whether a target is a path rather than a catalog table."""
    return "/" in name or ":" in name


class Store:
    """The store that ``path`` lies in."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm = spark._jvm
        self._fs = self._path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def folders(self, path: str) -> list[str]:
        """Names of the folders in ``path``; none where it does not exist."""
        if not self.exists(path):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._path(path)) if s.isDirectory())

    def holds_files(self, path: str) -> bool:
        """Whether ``path`` has a data file at any depth."""
        for s in self._fs.listStatus(self._path(path)):
            name = s.getPath().getName()
            if name[:1] in "_." or (s.isFile() and not s.getLen()):
                continue
            if s.isFile() or self.holds_files(f"{path}/{name}"):
                return True
        return False

    def size(self, path: str) -> int:
        """Bytes of everything in ``path``."""
        return self._fs.getContentSummary(self._path(path)).getLength()

    def rename(self, old: str, new: str) -> None:
        if not self._fs.rename(self._path(old), self._path(new)):
            raise OSError(f"could not rename {old} to {new}")

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)

    def make(self, path: str) -> None:
        self._fs.mkdirs(self._path(path))

    def write_text(self, path: str, text: str) -> None:
        """Write a small record whole or not at all: it appears by a rename."""
        part = f"{path}.part"
        out = self._fs.create(self._path(part), True)
        out.write(bytearray(text.encode()))
        out.close()
        self.rename(part, path)

    def read_text(self, path: str) -> str:
        stream = self._fs.open(self._path(path))
        try:
            return bytes(self._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
        finally:
            stream.close()


# ------------------------------------------------------------------ partition lists
def partition_specs(spark: SparkSession, name: str, filled: bool = True) -> list[dict[str, str | None]]:
    """Every partition of a path or catalog table as {column: text}, null for
    the null partition, from the store's folders or the catalog's list; no
    data file is opened.  Empty for what is not partitioned.

    ``filled`` leaves out the folders of a path that hold no data file.
    """
    if not is_path(name):
        if not any(c.isPartition for c in spark.catalog.listColumns(name)):
            return []
        return [_spec(r[0].split("/"), lambda x: _unescaped(spark, x)) for r in spark.sql(f"SHOW PARTITIONS {name}").collect()]
    store, root = Store(spark, name), name.rstrip("/")
    found, level = [], [[]]
    while level:
        below = []
        for parts in level:
            folder = "/".join([root, *parts])
            inner = [f for f in store.folders(folder) if "=" in f and f[:1] not in "_."]
            if inner:
                below += [[*parts, f] for f in inner]
            elif parts and (not filled or store.holds_files(folder)):
                found.append(parts)
        level = below
    return [_spec(parts, lambda x: _unescaped(spark, x)) for parts in found]


def _spec(parts: list[str], unescaped) -> dict[str, str | None]:
    out = {}
    for part in parts:
        column, _, value = part.partition("=")
        out[unescaped(column)] = None if value == NULL_PARTITION else unescaped(value)
    return out


def _unescaped(spark: SparkSession, text: str) -> str:
    if "%" not in text:
        return text
    return spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName(text)
