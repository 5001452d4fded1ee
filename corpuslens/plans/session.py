"""Session settings."""

from pyspark.sql import SparkSession

from corpuslens.sources.tables import PARTITIONS

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(
    cores: str = "*", memory: str = "16g", partitions: int = 8, settings: dict[str, str] | None = None
) -> SparkSession:
    """A session for tests and the bench; on a cluster the submitter sets these."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("corpuslens")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config(PARTITIONS, str(partitions))
    )
    for name, value in (SETTINGS | (settings or {})).items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
