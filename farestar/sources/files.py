"""Folders of the lake, on whatever file system its paths name."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Files:
    """The few file operations that DataFrames do not offer; none reads data."""

    def __init__(self, spark: SparkSession):
        self._paths = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _at(self, path: str):
        place = self._paths(path)
        return place.getFileSystem(self._conf), place

    def exists(self, path: str) -> bool:
        system, place = self._at(path)
        return system.exists(place)

    def rename(self, path: str, to: str) -> None:
        system, place = self._at(path)
        if not system.rename(place, self._paths(to)):
            raise OSError(f"cannot rename {path} to {to}")

    def delete(self, path: str) -> None:
        system, place = self._at(path)
        system.delete(place, True)

    def matching(self, pattern: str) -> list[str]:
        system, place = self._at(pattern)
        return [status.getPath().toString() for status in system.globStatus(place) or ()]

    def size(self, folder: str) -> tuple[int, int]:
        """Number and bytes of the data files in a folder, or of a single file."""
        system, place = self._at(folder)
        found = [
            status for status in system.listStatus(place)
            if status.getPath().getName()[0] not in "_."
        ]
        return len(found), sum(status.getLen() for status in found)

    def stamp(self, path: str) -> str | None:
        """Names, sizes and times of the data files at a path, as text; None if it does not exist."""
        system, place = self._at(path)
        if not system.exists(place):
            return None
        return " ".join(sorted(
            f"{status.getPath().getName()}:{status.getLen()}:{status.getModificationTime()}"
            for status in system.listStatus(place) if status.getPath().getName()[0] not in "_."
        ))
