"""Intermediate tables in the folder that the cluster shares."""

import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """A new folder of this application below ``spark.checkpoint.dir``.

    Where the setting is absent, a local session gets a folder of its own, once, through
    ``setCheckpointDir``; any other master must name one, since a folder of one machine is
    unknown to the others. Folders hold the application's id, so that they can be removed
    when it has ended.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root is None:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the cluster shares")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="corpuslens-"))
        root = spark.sparkContext.getCheckpointDir()
    return f"{root}/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"


def stored(rows: DataFrame) -> DataFrame:
    """``rows``, written and read back: later steps survive the loss of any executor."""
    folder = shared_folder(rows.sparkSession)
    rows.write.option("compression", "zstd").parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)


def on_file(docs: DataFrame) -> DataFrame:
    """``docs`` if its rows are read from files, else written to some."""
    try:
        docs.select(docs.metadataColumn("_metadata")["row_index"])
    except AnalysisException:
        return stored(docs)
    return docs
