"""Tables in the cluster's shared folder, which cut lineage and outlive executors.

Iterative plans and plans that read one costly result twice write it here as
Parquet and read it again. A lost executor then costs only its running tasks.
"""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names.

    Where the setting is absent (a local session, as in tests) a folder of this
    process is taken; on a cluster its absence is an error, as executors would
    not see a folder of the driver's machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    known = spark.sparkContext.getCheckpointDir()
    if known:
        return known.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    own = "file://" + tempfile.mkdtemp(prefix="heddle-")
    spark.sparkContext.setCheckpointDir(own)
    return own


class Scratch:
    """The durable tables of one query run."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/heddle-{name}-{uuid.uuid4().hex}"
        self.count = 0

    def keep(self, df: DataFrame, name: str = "t") -> DataFrame:
        """Write ``df`` and return it as a scan of what was written."""
        self.count += 1
        path = f"{self.root}/{self.count}-{name}"
        df.write.parquet(path)
        kept = self.spark.read.schema(df.schema).parquet(path)
        kept._heddle_path = path
        return kept

    def drop(self, kept: DataFrame) -> None:
        """Delete a table that nothing reads any more."""
        remove(self.spark, kept._heddle_path)

    def clear(self) -> None:
        """Delete all tables of this run, once nothing reads them any more."""
        remove(self.spark, self.root)


def remove(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
