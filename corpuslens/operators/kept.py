"""Tables that several reports share."""

from pyspark import StorageLevel
from pyspark.sql import DataFrame


class Kept:
    """Rows kept on the executors, in memory or on their disks, until ``release``.

    They keep their lineage: parts that are lost with an executor are computed again.
    """

    def __init__(self) -> None:
        self._kept: list[DataFrame] = []

    def keep(self, rows: DataFrame) -> DataFrame:
        self._kept.append(rows.persist(StorageLevel.MEMORY_AND_DISK))
        return rows

    def release(self) -> None:
        while self._kept:
            self._kept.pop().unpersist()

    def __enter__(self):
        return self

    def __exit__(self, *raised) -> None:
        self.release()
