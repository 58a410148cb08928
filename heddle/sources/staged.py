"""Partitioned tables that are written aside and put in place only when they are found good."""

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


class Staged:
    """A folder beside a partitioned table, for partitions that are to replace the table's own.

    As a context it deletes the folder at its end, so whatever isn't promoted by
    then is gone and the table as it was.
    """

    def __init__(self, spark: SparkSession, target: str, by: tuple[str, ...]):
        self.spark, self.target, self.by = spark, target.rstrip("/"), tuple(by)
        self.path = f"{self.target}.staged-{uuid.uuid4().hex}"
        self.old = f"{self.path}-old"

    def __enter__(self) -> "Staged":
        return self

    def __exit__(self, *error) -> None:
        for path in (self.path, self.old):
            self._files.delete(self._path(path), True)

    def _path(self, text: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(text)

    @property
    def _files(self):
        return self._path(self.target).getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def write(self, df: DataFrame) -> None:
        """``df`` in folders by the partition columns, in files of the advisory size."""
        df.hint("rebalance", *self.by).write.partitionBy(*self.by).parquet(self.path)

    def read(self, schema: StructType) -> DataFrame:
        return self.spark.read.schema(schema).parquet(self.path)

    def partitions(self) -> list[str]:
        """The staged partitions' folders, relative to the table's."""
        found = [""]
        for name in self.by:
            beneath = [(above, s.getPath().getName()) for above in found for s in self._files.listStatus(self._path(self.path + above))]
            found = [f"{above}/{folder}" for above, folder in beneath if folder.startswith(f"{name}=")]
        return found

    def promote(self) -> list[str]:
        """Put the staged partitions into the table, each in place of the one that was there.

        A partition that is replaced moves aside first and back again if a later
        step fails, so that a failure leaves the table as it was. Nothing is copied.
        """
        files, moved = self._files, []

        def move(source: str, to: str) -> None:
            files.mkdirs(self._path(to).getParent())
            if not files.rename(self._path(source), self._path(to)):
                raise OSError(f"could not move {source} to {to}")
            moved.append((source, to))

        found = self.partitions()
        try:
            for folder in found:
                if files.exists(self._path(self.target + folder)):
                    move(self.target + folder, self.old + folder)
                move(self.path + folder, self.target + folder)
        except Exception:
            for source, to in reversed(moved):
                files.rename(self._path(to), self._path(source))
            raise
        return found
